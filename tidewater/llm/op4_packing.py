"""Best-two-fit packing of tokenised documents into sequences of bounded length.

1. ``tokenise``: every whole text becomes token ids plus an end id; only longer documents are cut.
2. The pieces' lengths are counted. The histogram has at most ``capacity`` rows whatever the input's size, so the
   packing itself is solved on the driver over *counts*: a bin is filled greedily with the longest piece that fits;
   then its smallest piece is replaced with two unpacked ones where those fit the expanded gap more tightly. A bin
   pattern is used as often as the counts allow, so the plan is a short list of (pattern, times).
3. Every piece gets its rank within its length, and the plan's rank ranges name its sequence and offset. Ranks are
   numbered per (length, salt), and the salts' counts shift them: a length that a third of all pieces share is
   spread over ``salts`` tasks.

Defined cases: a null or empty text is the end id alone. Repeated rows are packed once each. A null doc_id is packed
like any other. Extra columns are ignored.
"""

from __future__ import annotations

import json
import os
import sys
import types
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidewater.llm.common import WorkTables, own_columns, table

CAPACITY, END_ID, SALTS = 4096, 1, 64
#: Bound of a worker's word cache between blocks of texts; a block's own chunks are all held while it is encoded.
CACHE_WORDS = 700_000


class MergeRanks:
    """The tokenizer file's merges as tiktoken ranks, which encode short words several times faster.

    The word end ``</w>`` becomes a mark byte behind each word, joined to the last byte by the lowest ranks. Merging the
    adjacent pair of the lowest rank gives the same tokens as the merge list if every merge's parts come earlier in the
    list and no two merges make one token; ``of_file`` returns None for a file where that does not hold.
    """

    MARK = b"\x01"

    def __init__(self, ranks: dict[bytes, int], ids: np.ndarray, ends: np.ndarray):
        import tiktoken

        self.encoding = tiktoken.Encoding("words", pat_str="[^\x01]+\x01", mergeable_ranks=ranks, special_tokens={})
        self.ids, self.ends = ids, ends

    @classmethod
    def of_file(cls, tokenizer_file: str) -> MergeRanks | None:
        with open(tokenizer_file, encoding="utf-8") as file:
            model = json.load(file)["model"]
        # Byte-level alphabet: printable Latin-1 stands for itself, the other bytes for the code points from 256 on.
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        byte_of = {chr(c): c for c in plain} | {chr(256 + i): c for i, c in enumerate(c for c in range(256) if c not in plain)}
        raw = lambda token: bytes(byte_of[c] for c in token.removesuffix("</w>")) + cls.MARK * token.endswith("</w>")
        ranks = {bytes([c]): c for c in range(256)} | {bytes([c]) + cls.MARK: 256 + c for c in range(256) if c != cls.MARK[0]}
        for i, merge in enumerate(model["merges"]):
            one, two = (raw(x) for x in (merge.split(" ") if isinstance(merge, str) else merge))
            if one + two in ranks or one not in ranks or two not in ranks:
                return None
            ranks[one + two] = 512 + i
        ids, ends = np.zeros(512 + len(model["merges"]), "<u4"), np.zeros(512 + len(model["merges"]), bool)
        known = {raw(t): i for t, i in model["vocab"].items() if all(c in byte_of for c in t.removesuffix("</w>"))}
        for token, rank in ranks.items():
            ids[rank], ends[rank] = known.get(token, 0), token.endswith(cls.MARK)
        return cls(ranks, ids, ends)

    def encode(self, words: list[str]) -> list[bytes]:
        """The ids of each word (of one pre-token), little-endian."""
        if not words:
            return []
        ranks = np.array(self.encoding.encode_ordinary("\x01".join(words) + "\x01"), np.int64)
        stops = ((np.flatnonzero(self.ends[ranks]) + 1) * 4).tolist()
        ids = self.ids[ranks].tobytes()
        return [ids[i:j] for i, j in zip([0, *stops], stops, strict=False)]


class WordTokens:
    """Token ids of white-space free chunks, as little-endian 32-bit words, kept from one batch to the next.

    The tokenizer's pre-tokens never cross ASCII white space, and white space itself has no ids, so a text's ids are
    its chunks' ids in a row. A chunk of Latin letters with ASCII punctuation behind is two pre-tokens, letters (in
    lower case) and punctuation, which ``MergeRanks`` encodes; any other chunk goes to the tokenizer as it stands.
    """

    def __init__(self, tokenizer_file: str):
        import regex
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer, self.ranks = Tokenizer.from_file(tokenizer_file), MergeRanks.of_file(tokenizer_file)
        self.chunks: dict[bytes, bytes] = {}
        self.split = regex.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([!-&(-/:-@\[-`{-~]*)").fullmatch

    @classmethod
    def of_worker(cls, tokenizer_file: str) -> WordTokens:
        """One instance per Python worker process, which outlives a task."""
        home = sys.modules.setdefault("_word_tokens_of_this_worker", types.ModuleType("_word_tokens_of_this_worker"))
        if getattr(home, "file", None) != tokenizer_file:
            home.file, home.made = tokenizer_file, cls(tokenizer_file)
        return home.made

    def _learn(self, missing: set[bytes]) -> None:
        cut, odd = [], []
        for chunk in missing:
            found = self.split(chunk.decode("utf-8", "replace")) if self.ranks else None
            if found:
                cut.append((chunk, found[1].lower(), found[2]))
            else:
                odd.append(chunk)
        parts = list({p for _, *both in cut for p in both if p})
        ids = dict(zip(parts, self.ranks.encode(parts) if parts else [], strict=True))
        ids[""] = b""
        for chunk, letters, marks in cut:
            self.chunks[chunk] = ids[letters] + ids[marks]
        for chunk, got in zip(odd, self.tokenizer.encode_batch([c.decode("utf-8", "replace") for c in odd], add_special_tokens=False), strict=True):
            self.chunks[chunk] = np.array(got.ids, "<u4").tobytes()

    def encode(self, texts: list[bytes]) -> Iterator[bytes]:
        """The ids of each text, little-endian. Texts are taken in blocks, so that new words are learnt together."""
        for at in range(0, len(texts), 64):
            split = [t.split() for t in texts[at : at + 64]]
            used: set[bytes] = set()
            for chunks in split:
                used.update(chunks)
            missing = {c for c in used if c not in self.chunks}
            if len(self.chunks) + len(missing) > CACHE_WORDS:
                # Only here, before the block: all its chunks are then learnt anew.
                self.chunks.clear()
                missing = used
            if missing:
                self._learn(missing)
            for chunks in split:
                yield b"".join([self.chunks[c] for c in chunks])


def tokenise(docs: DataFrame, tokenizer_file: str, capacity: int = CAPACITY, end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32[, ids]): the pieces of every document row."""
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = WordTokens.of_worker(tokenizer_file)
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                batch = whole.slice(at, 256)
                texts = [t or b"" for t in batch.column(1).cast(pa.binary()).to_pylist()]
                rows: list[tuple] = []
                for doc_id, ids in zip(batch.column(0).to_pylist(), words.encode(texts), strict=True):
                    ids += end
                    for piece, start in enumerate(range(0, len(ids), 4 * capacity)):
                        part = ids[start : start + 4 * capacity]
                        rows.append((doc_id, piece, start // 4, len(part) // 4, zlib.crc32(part), part if with_ids else None))
                cols = list(zip(*rows, strict=True))
                kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)][: 5 + with_ids], names[: 5 + with_ids])

    names = ["doc_id", "piece", "start", "length", "ids_crc32", "ids"]
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids binary" * with_ids
    return own_columns(docs, "doc_id", "text").mapInArrow(run, schema)


def plan_bins(counts: np.ndarray, capacity: int) -> np.ndarray:
    """Packs ``counts[n]`` pieces of each length n; returns rows (length, first rank, copies, times, first sequence, offset).

    A row places ``times * copies`` pieces of one length, ranks ``first rank`` on: the i-th goes to sequence
    ``first sequence + i // copies``, at ``offset + (i % copies) * length``. Every step uses up a length or leaves less
    of it than one bin takes, so the number of rows depends on ``capacity`` alone.
    """
    left, used = counts.astype(np.int64).copy(), np.zeros(len(counts), np.int64)
    sizes, rows, sequence = np.arange(len(counts)), [], 0
    while left.any():
        at_most = np.maximum.accumulate(np.where(left > 0, sizes, 0))  # the longest unpacked length up to each size
        bin_: dict[int, int] = {}
        gap = capacity
        while gap > 0 and (n := int(at_most[gap])):
            take = min(gap // n, int(left[n]) - bin_.get(n, 0))
            if take:
                bin_[n], gap = bin_.get(n, 0) + take, gap - take * n
            if not gap:
                break
            free = np.where(left > 0, sizes, 0)
            free[[k for k, v in bin_.items() if left[k] <= v]] = 0
            at_most = np.maximum.accumulate(free)
        smallest = min(bin_)
        if gap and smallest > 1:
            free = left.copy()
            for n, k in bin_.items():
                free[n] -= k
            room = gap + smallest
            top = np.maximum.accumulate(np.where(free > 0, sizes, 0))
            first = np.flatnonzero(free[: room] > 0)
            if first.size:
                second = top[room - first]
                twin = (second == first) & (free[first] < 2)  # one piece can't be both
                second = np.where(twin, top[np.maximum(np.minimum(room - first, first - 1), 0)], second)
                total = np.where(second > 0, first + second, 0)
                best = int(np.argmax(total))
                if total[best] > smallest:
                    bin_[smallest] -= 1
                    for n in (int(first[best]), int(second[best])):
                        bin_[n] = bin_.get(n, 0) + 1
        bin_ = {n: k for n, k in bin_.items() if k}
        times, offset = min(int(left[n]) // k for n, k in bin_.items()), 0
        for n, k in sorted(bin_.items(), reverse=True):
            rows.append((n, used[n], k, times, sequence, offset))
            used[n] += times * k
            left[n] -= times * k
            offset += n * k
        sequence += times
    return np.array(rows, np.int64).reshape(-1, 6)


def _place(lengths: np.ndarray, ranks: np.ndarray, plan: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sequence and offset of pieces, by binary search in the plan sorted by (length, first rank)."""
    keys = plan[:, 0] << 48 | plan[:, 1]
    _, first, copies, _, sequence, offset = plan[np.searchsorted(keys, lengths << 48 | ranks, "right") - 1].T
    i = ranks - first
    return sequence + i // copies, offset + (i % copies) * lengths


def pack(docs: DataFrame, tokenizer_file: str, capacity: int = CAPACITY, end_id: int = END_ID, salts: int = SALTS, with_ids: bool = False) -> DataFrame:
    """The pieces of all documents with their sequence_id and offset; with ``with_ids`` also their ids."""
    work = WorkTables(docs.sparkSession)
    pieces = tokenise(docs, tokenizer_file, capacity, end_id, with_ids).withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(salts)).cast("int"))
    pieces = work.put(pieces, "pieces")
    # At most capacity x salts counts, whatever the number of documents.
    counted = np.array([tuple(r) for r in pieces.groupBy("length", "salt").count().collect()], np.int64).reshape(-1, 3)
    by_salt = np.zeros((capacity + 1, salts), np.int64)
    by_salt[counted[:, 0], counted[:, 1]] = counted[:, 2]
    before = np.cumsum(by_salt, axis=1) - by_salt
    plan = plan_bins(by_salt.sum(axis=1), capacity)
    plan = plan[np.lexsort((plan[:, 1], plan[:, 0]))]
    known = docs.sparkSession.sparkContext.broadcast((before, plan))
    names = ["doc_id", "piece", "start", "length", "ids_crc32", *(["ids"] if with_ids else [])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shift, bins = known.value
        for batch in batches:
            length, salt, nth = (batch.column(batch.schema.get_field_index(c)).to_numpy(zero_copy_only=False) for c in ("length", "salt", "nth"))
            if batch.num_rows:
                sequence, offset = _place(length, nth - 1 + shift[length, salt], bins)
            else:
                sequence = offset = np.zeros(0, np.int64)
            own = [batch.column(batch.schema.get_field_index(c)) for c in names]
            yield pa.RecordBatch.from_arrays([*own, pa.array(sequence, pa.int64()), pa.array(offset, pa.int64())], [*names, "sequence_id", "offset"])

    order = Window.partitionBy("length", "salt").orderBy("doc_id", "piece", "start", "ids_crc32")
    ranked = pieces.withColumn("nth", F.row_number().over(order).cast("long"))
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids binary" * with_ids + ", sequence_id long, offset long"
    return ranked.mapInArrow(run, schema)


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), tokenizer_path())
