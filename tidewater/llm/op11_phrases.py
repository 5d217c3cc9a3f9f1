"""Phrase mining: collocations counted in a HAT-trie and scored by their weakest cut.

Rare phrases are kept out of the tries first. Every phrase falls into one of 2^32 buckets by its hash; tasks count the
buckets of their texts' phrases, Spark deals the counts by ranges of buckets and adds them up. A frequent phrase's bucket
reaches ``min_count``, and buckets that do leave a bitmap of ``FILTER_BITS`` bits (8 MiB, whatever the data). Lengths are
counted in steps (1 and 2, 3, 4 and 5, ...): a step skips phrases with a part that the bitmap of the steps before it rules
out. The bitmap never hides a frequent phrase; where it is crowded, more rare ones are counted and then dropped.

Then the phrases of all lengths that the bitmap leaves are counted exactly. Since a frequent phrase is in most tasks, each
of which sends its count, up to ``JOINED`` partitions share a task. A task holds the phrases of its texts in a HAT-trie: a
shallow trie over word ids (the first with its language) whose leaves are hash containers; a container that outgrows
``BURST`` entries bursts into a node with one container per next word. When the trie holds ``ENTRIES`` phrases, its largest
subtrees are spilled whole, each as a run sorted by words, until half of it is left; the rest follows at the task's end.
Spark deals the runs into ranges of (language, phrase), so that a prefix lies in one partition, or in several if it is
frequent, and merges them there by adding up equal phrases.

A candidate's score is that of its lowest-scoring cut, floor(1000 * a * n / (l * r)), in 38-digit whole numbers; its parts'
counts are joined from the tables of shorter phrases. Candidates inside a longer one that is as frequent are dropped: it is
enough to look at those one word longer, since any phrase between two equally frequent ones is as frequent.

Defined cases: a null text is empty; empty texts and pieces have no words. A null language is ``und``. Repeated rows and
rows that share or lack a doc_id all count. Words are told apart by 64-bit hashes inside a task, and by their text across
tasks. Equal scores and counts are ranked by phrase in byte order. An empty table gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator
from functools import reduce
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidewater.llm.common import WorkTables, own_columns, table, text_or_empty
from tidewater.llm.wordrows import BASE, Words, chunks, mixed, rolling

LONGEST, MIN_COUNT, TOP, COVER_PERCENT = 5, 100, 2000, 100
BURST, ENTRIES, RUN_ROWS = 4096, 400_000, 50_000
FILTER_BITS = 1 << 26
DIGIT = 2**32 - 1
#: Phrases whose buckets a task holds before it sends their counts, bits of a bucket's number within its range, and bytes of texts worked on
#: together there: few enough that their numbers stay in the processor's cache.
HELD, RANGE_BITS, CHUNK = 4_000_000, 20, 256_000
#: Partitions of texts that one trie counts at most.
JOINED = 16

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
BREAK = np.zeros(256, bool)
BREAK[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
GAP = BREAK.copy()
GAP[[0x20, 0x09]] = True


class Node:
    """A trie node: the count of the phrase that ends here, and the subtree (node or container) of each next word."""

    __slots__ = ("children", "count")

    def __init__(self):
        self.children: dict = {}
        self.count = 0


class HatTrie:
    """Counts of phrases: nodes near the root, hash containers of the remaining words below.

    A phrase is its head (the first word with its language) and its rest, the other words' numbers (from 1, below 2^32) as
    digits of one number, the next word lowest; no rest is 0.
    """

    def __init__(self, burst: int = BURST):
        self.children, self.burst, self.entries = {}, burst, 0

    def add(self, heads: list[int], rests: list[int], counts: list[int]) -> None:
        children, burst, new = self.children, self.burst, 0
        for head, rest, count in zip(heads, rests, counts, strict=True):
            child = children.get(head)
            if child is None:
                children[head] = {rest: count}
                new += 1
            elif type(child) is dict:
                old = child.get(rest)
                if old is None:
                    child[rest] = count
                    new += 1
                    if len(child) > burst:
                        children[head] = _burst(child)
                else:
                    child[rest] = old + count
            else:
                new += self._below(child, rest, count)
        self.entries += new

    def _below(self, node: Node, rest: int, count: int) -> bool:
        while rest:
            word, rest = rest & DIGIT, rest >> 32
            child = node.children.get(word)
            if child is None:
                child = node.children[word] = {}
            if type(child) is dict:
                new = rest not in child
                child[rest] = child.get(rest, 0) + count
                if len(child) > self.burst:
                    node.children[word] = _burst(child)
                return new
            node = child
        node.count += count
        return node.count == count

    def spill(self, down_to: int) -> Iterator[tuple[int, list[tuple[int, int]]]]:
        """Takes out whole subtrees of heads, the largest first, until at most ``down_to`` entries are left."""
        sizes = {head: len(child) if type(child) is dict else sum(1 for _ in _walk(child, 0, 0)) for head, child in self.children.items()}
        for head in sorted(sizes, key=sizes.get, reverse=True):
            if self.entries <= down_to:
                return
            self.entries -= sizes[head]
            yield head, list(_walk(self.children.pop(head), 0, 0))


def _burst(container: dict[int, int]) -> Node:
    node = Node()
    for rest, count in container.items():
        if rest:
            node.children.setdefault(rest & DIGIT, {})[rest >> 32] = count
        else:
            node.count = count
    return node


def _walk(tree: Node | dict, above: int, shift: int) -> Iterable[tuple[int, int]]:
    """(rest, count) of a subtree whose ``shift`` / 32 words down to here are ``above``."""
    if type(tree) is dict:
        return tree.items() if not shift else [(above | rest << shift, count) for rest, count in tree.items()]
    own = [(above, tree.count)] if tree.count else []
    return chain(own, *(_walk(child, above | word << shift, shift + 32) for word, child in tree.children.items()))


def language_hash(lang: str) -> int:
    import xxhash

    return xxhash.xxh3_64_intdigest(lang.encode())


def phrase_hashes(hashes: np.ndarray, width: int, language: np.ndarray) -> np.ndarray:
    """The hash of every ``width`` words in their language; ``language`` has the first word's language hash."""
    return mixed(rolling(hashes, width) * np.uint64(BASE) + language[: max(0, len(hashes) - width + 1)])


def _has(bits: np.ndarray, h: np.ndarray) -> np.ndarray:
    slot = h % np.uint64(len(bits) * 64)
    return (bits[(slot >> np.uint64(6)).astype(np.int64)] >> (slot & np.uint64(63))) & np.uint64(1) > 0


class Texts:
    """The words of some texts, lower-cased and with their languages, and the phrases in them that may be frequent."""

    def __init__(self, langs: list[str], data: np.ndarray, offsets: np.ndarray):
        self.data = LOWER[data]
        self.words = Words(self.data, offsets, GAP)
        edge = np.concatenate([BREAK[self.data], [False]])
        self.piece = np.cumsum(edge)[self.words.starts] + np.repeat(np.arange(len(langs)), self.words.count)  # grows at breaks and texts
        self.names, which = np.unique(np.array(langs, object), return_inverse=True)
        by_text = np.array([language_hash(name) for name in self.names], np.uint64)[which]
        self.language, self.which = np.repeat(by_text, self.words.count), np.repeat(which, self.words.count)

    def phrases(self, longest: int, bits: np.ndarray | None, known: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(size, first words, hashes) by size, without phrases with a part of up to ``known`` words that ``bits`` rules out."""
        count, before = len(self.words.starts), None
        for size in range(1, min(longest, count) + 1):
            holds = self.piece[: count - size + 1] == self.piece[size - 1 :]
            if before is not None:
                holds &= before[:-1] & before[1:]
            at = np.flatnonzero(holds)
            hashes = phrase_hashes(self.words.hashes, size, self.language)[at]
            if size <= known:
                may = _has(bits, hashes)
                holds[at[~may]] = False
                at, hashes = at[may], hashes[may]
            before = holds
            yield size, at, hashes


def _distinct(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The index of one of each equal values, in their order, and their number."""
    order = np.argsort(values)
    ordered = values[order]
    edge = np.flatnonzero(np.concatenate([np.ones(min(1, len(values)), bool), ordered[1:] != ordered[:-1]]))
    return order[edge], np.diff(edge, append=len(values))


class PhraseCounter:
    """A task's HAT-trie with its languages and words, both numbered as they come."""

    def __init__(self, longest: int, bits: np.ndarray, burst: int, entries: int):
        self.longest, self.bits, self.burst, self.limit = longest, bits, burst, entries
        self.totals: Counter[str] = Counter()
        self._clear()

    def _clear(self) -> None:
        self.trie, self.langs, self.lang_names, self.ids, self.words = HatTrie(self.burst), {}, [], {}, [b""]  # no word has number 0

    def add(self, langs: list[str], data: np.ndarray, offsets: np.ndarray) -> None:
        texts = Texts(langs, data, offsets)
        for name, n in zip(texts.names.tolist(), np.bincount(texts.which, minlength=len(texts.names)).tolist(), strict=True):
            if n:
                self.totals[name] += n
        found = []
        for size, at, hashes in texts.phrases(self.longest, self.bits, self.longest):
            one, times = _distinct(hashes)
            found.append((size, at[one], times))
        if not found or not len(found[0][1]):  # every longer phrase starts with a word that is left
            return
        numbers = self._numbers(texts, found[0][1])
        lang_ids = np.array([self._language(name) for name in texts.names])
        for size, at, times in found:
            rests = np.zeros(len(at), np.int64 if size <= 2 else object)
            for j in range(1, size):
                rests |= numbers[at + j].astype(rests.dtype) << 32 * (j - 1)
            self.trie.add((lang_ids[texts.which[at]] << 32 | numbers[at]).tolist(), rests.tolist(), times.tolist())

    def _language(self, name: str) -> int:
        if name not in self.langs:
            self.langs[name] = len(self.langs)
            self.lang_names.append(name)
        return self.langs[name]

    def _numbers(self, texts: Texts, at: np.ndarray) -> np.ndarray:
        """The number of each word that is equal to one of those ``at`` some places; 0 for the others."""
        words, data = texts.words, texts.data.tobytes()
        own, first = np.unique(words.hashes[at], return_index=True)
        ids = list(map(self.ids.get, own.tolist()))
        starts, ends = words.starts[at[first]].tolist(), words.ends[at[first]].tolist()
        for i, h in enumerate(own.tolist()):
            if ids[i] is None:
                ids[i] = self.ids[h] = len(self.words)
                self.words.append(data[starts[i] : ends[i]])
        place = np.minimum(np.searchsorted(own, words.hashes), len(own) - 1)
        return np.where(own[place] == words.hashes, np.array(ids, np.int64)[place], 0)

    def runs(self, last: bool = False) -> Iterator[pa.RecordBatch]:
        """Whole subtrees as sorted runs once the trie is full; all of it, if this is the last call."""
        if not last and self.trie.entries <= self.limit:
            return
        words, langs, phrases, counts = self.words, [], [], []
        for head, subtree in self.trie.spill(0 if last or len(words) > 4 * self.limit else self.limit // 2):
            first, lang = words[head & DIGIT], self.lang_names[head >> 32]
            run = sorted([(b" ".join([first, *_words(rest, words)]), n) for rest, n in subtree])
            langs += [lang] * len(run)
            phrases += [phrase for phrase, _ in run]
            counts += [n for _, n in run]
            if len(counts) >= RUN_ROWS:
                yield _run_batch(langs, phrases, counts)
                langs, phrases, counts = [], [], []
        yield _run_batch(langs, phrases, counts)
        if not self.trie.entries:
            self._clear()


def _words(rest: int, words: list[bytes]) -> Iterator[bytes]:
    while rest:
        yield words[rest & DIGIT]
        rest >>= 32


def _run_batch(langs: list[str], phrases: list[bytes], counts: list[int]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(phrases, pa.binary()).cast(pa.string()), pa.array(counts, pa.int64())], ["lang", "phrase", "n"])


def _runs(longest: int, sent: Broadcast, burst: int, entries: int):
    """(lang, phrase, n): runs of the phrases that may be frequent; the empty phrase counts all words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = PhraseCounter(longest, sent.value, burst, entries)
        for batch in batches:
            for own, data, offsets in chunks(batch, 1):
                counter.add(own.column(0).to_pylist(), data, offsets)
                yield from counter.runs()
        yield from counter.runs(True)
        yield _run_batch(list(counter.totals), [b""] * len(counter.totals), list(counter.totals.values()))

    return run


def _range_batch(buckets: list[np.ndarray]) -> pa.RecordBatch:
    """One row for each range that has some of the buckets, with these in order and how often each occurs."""
    ordered = np.sort(np.concatenate(buckets))
    edge = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
    own, times = ordered[edge], np.diff(edge, append=len(ordered)).astype(np.uint32)
    ranges, first = np.unique(own >> np.uint32(RANGE_BITS), return_index=True)
    ends = pa.py_buffer((np.append(first, len(own)) * 4).astype(np.int32))
    blobs = [pa.Array.from_buffers(pa.binary(), len(ranges), [None, ends, pa.py_buffer(column)]) for column in (own, times)]
    return pa.RecordBatch.from_arrays([pa.array(ranges.astype(np.int32)), *blobs], ["range", "buckets", "times"])


def _bucket_rows(first: int, last: int, sent: Broadcast | None):
    """(range, buckets, times) of the phrases of ``first`` to ``last`` words whose shorter parts may be frequent."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, held, count = sent.value if sent else None, [], 0
        for batch in batches:
            for own, data, offsets in chunks(batch, 1, CHUNK):
                for size, _, hashes in Texts(own.column(0).to_pylist(), data, offsets).phrases(last, bits, first - 1):
                    if size >= first:
                        held.append((hashes & np.uint64(DIGIT)).astype(np.uint32))
                        count += len(hashes)
                if count >= HELD:
                    yield _range_batch(held)
                    held, count = [], 0
        if count:
            yield _range_batch(held)

    return run


def _frequent_buckets(min_count: int, bits: int):
    """(word, bit), as in ``_slots``, of the buckets that reach ``min_count``; rows come sorted by range."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, times = np.zeros(0, np.uint64), np.zeros(0, np.uint64)
        for batch in batches:
            if not batch.num_rows:
                continue
            more = [np.frombuffer(b"".join(batch.column(i).to_pylist()), np.uint32).astype(np.uint64) for i in (1, 2)]
            both = np.sort(np.concatenate([own << np.uint64(32) | np.minimum(times, np.uint64(DIGIT)), more[0] << np.uint64(32) | more[1]]))
            buckets = both >> np.uint64(32)
            edge = np.flatnonzero(np.concatenate([[True], buckets[1:] != buckets[:-1]]))
            own, times = buckets[edge], np.add.reduceat(both & np.uint64(DIGIT), edge)
            done = int(np.searchsorted(own, np.uint64(batch.column(0)[-1].as_py() << RANGE_BITS)))  # the last range may go on
            yield _bits_batch(own[:done][times[:done] >= min_count], bits)
            own, times = own[done:], times[done:]
        yield _bits_batch(own[times >= min_count], bits)

    return run


def _bits_batch(hashes: np.ndarray, bits: int) -> pa.RecordBatch:
    slot = hashes % np.uint64(bits)
    columns = [(slot >> np.uint64(6)).astype(np.int64), (np.uint64(1) << (slot & np.uint64(63))).view(np.int64)]
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["word", "bit"])


def _slots(size: int, bits: int):
    """(word, bit): the place of each phrase in the bitmap, as a 64-bit word's number and the word with that one bit."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for own, data, offsets in chunks(batch, 1):
                words = Words(data, offsets, GAP)
                names, which = np.unique(np.array(own.column(0).to_pylist(), object), return_inverse=True)
                language = np.array([language_hash(name) for name in names], np.uint64)[which]
                yield _bits_batch(phrase_hashes(words.hashes, size, np.repeat(language, words.count))[words.first], bits)

    return run


def _bitmap(slots: DataFrame, bits: int) -> np.ndarray:
    out = np.zeros(bits // 64, np.uint64)
    words = slots.groupBy("word").agg(F.bit_or("bit").alias("bit")).toArrow()
    out[words["word"].to_numpy()] = words["bit"].to_numpy().view(np.uint64)
    return out


def filter_of(phrases: DataFrame, size: int, bits: int = FILTER_BITS) -> np.ndarray:
    """The bitmap of given phrases (lang, phrase, ...) of a length; at most ``bits`` / 8 bytes come to the driver."""
    return _bitmap(phrases.select("lang", "phrase").mapInArrow(_slots(size, bits), "word long, bit long"), bits)


def frequent_filter(texts: DataFrame, min_count: int, longest: int, work: WorkTables, bits: int = FILTER_BITS) -> np.ndarray:
    """The bitmap of the buckets of phrases up to ``longest`` words that reach ``min_count``."""
    if bits < 64 or bits & (bits - 1) or bits > DIGIT:
        raise ValueError("bits must be a power of two from 64 to 2^31")
    spark, out = texts.sparkSession, np.zeros(bits // 64, np.uint64)
    for first, last in [(1, 2), (3, 3), *((size, size + 1) for size in range(4, longest + 1, 2))]:
        if first > longest:
            break
        last = min(last, longest)
        sent = spark.sparkContext.broadcast(out) if first > 1 else None
        counts = texts.mapInArrow(_bucket_rows(first, last, sent), "range int, buckets binary, times binary").repartition("range").sortWithinPartitions("range")
        found = work.put(counts.mapInArrow(_frequent_buckets(min_count, bits), "word long, bit long"), "buckets")
        out = out | _bitmap(found, bits)
        work.drop(found)
        if sent is not None:
            sent.unpersist()
    return out


def trie_tasks(partitions: int, cores: int) -> int:
    """Twice as many as there are cores, or as many as hold ``JOINED`` partitions each."""
    return max(1, min(partitions, max(2 * cores, -(-partitions // JOINED))))


def count_phrases(texts: DataFrame, min_count: int, longest: int, work: WorkTables, burst: int = BURST, entries: int = ENTRIES, bits: int = FILTER_BITS) -> tuple[DataFrame, list[DataFrame]]:
    """(lang, n) of all words, and per length the (lang, phrase, f) of the phrases with f >= ``min_count``.

    ``texts`` is (lang, text) without nulls.
    """
    sent = texts.sparkSession.sparkContext.broadcast(frequent_filter(texts, min_count, longest, work, bits))
    joined = texts.coalesce(trie_tasks(texts.rdd.getNumPartitions(), texts.sparkSession.sparkContext.defaultParallelism))
    runs = work.put(joined.mapInArrow(_runs(longest, sent, burst, entries), "lang string, phrase string, n long"), "runs", compression="zstd")
    sent.unpersist()
    totals = work.put(runs.filter("phrase = ''").groupBy("lang").agg(F.sum("n").alias("n")), "totals")
    merged = runs.filter("phrase <> ''").repartitionByRange("lang", "phrase").groupBy("lang", "phrase").agg(F.sum("n").alias("f"))
    frequent = work.put(merged.filter(F.col("f") >= min_count).withColumn("size", F.size(F.split("phrase", " "))), "frequent")
    work.drop(runs)
    return totals, [frequent.filter(F.col("size") == size).drop("size") for size in range(1, longest + 1)]


def scored(totals: DataFrame, frequent: list[DataFrame], cover_percent: int, work: WorkTables) -> DataFrame:
    """(lang, phrase, a, l, r, n, score) of the candidates that no longer candidate covers."""
    parts = work.put(reduce(DataFrame.union, frequent[:-1]), "parts")
    longer = reduce(DataFrame.union, [f.withColumn("size", F.lit(i)) for i, f in enumerate(frequent[1:], 2)])
    words = F.split("phrase", " ")
    inner = longer.filter("size > 2").select("lang", F.explode(F.array(F.array_join(F.slice(words, 1, F.col("size") - 1), " "), F.array_join(F.slice(words, 2, F.col("size") - 1), " "))).alias("phrase"), F.col("f").alias("over"))
    covers = work.put(inner.groupBy("lang", "phrase").agg(F.max("over").alias("over")), "covers")
    free = longer.join(covers, ["lang", "phrase"], "left").filter(F.col("over").isNull() | (100 * F.col("over") < cover_percent * F.col("f")))
    cuts = free.select("lang", "phrase", F.col("f").alias("a"), words.alias("words"), F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k"))
    cuts = cuts.select("lang", "phrase", "a", "k", F.array_join(F.expr("slice(words, 1, k)"), " ").alias("left"), F.array_join(F.expr("slice(words, k + 1, size(words) - k)"), " ").alias("right"))
    cuts = work.put(cuts.join(parts.select("lang", F.col("phrase").alias("left"), F.col("f").alias("l")), ["lang", "left"]).drop("left"), "left")
    cuts = work.put(cuts.join(parts.select("lang", F.col("phrase").alias("right"), F.col("f").alias("r")), ["lang", "right"]).drop("right"), "right")
    whole = lambda name: f"CAST({name} AS DECIMAL(19,0))"
    score = F.expr(f"(CAST({whole('a')} * {whole('n')} AS DECIMAL(34,0)) * 1000BD) div ({whole('l')} * {whole('r')})")
    cuts = cuts.join(totals, "lang").withColumn("score", score)
    lowest = F.min(F.struct("score", "k", "l", "r")).alias("low")
    best = cuts.groupBy("lang", "phrase", "a", "n").agg(lowest)
    return best.select("lang", "phrase", "a", "low.l", "low.r", "n", "low.score")


def collocations(docs: DataFrame, min_count: int = MIN_COUNT, longest: int = LONGEST, top: int = TOP, cover_percent: int = COVER_PERCENT, **sizes: int) -> DataFrame:
    """Each language's first ``top`` phrases: (lang, rank, phrase, a, l, r, n, score)."""
    work = WorkTables(docs.sparkSession, clean=True)
    texts = own_columns(docs, "lang", "text").select(F.coalesce("lang", F.lit("und")).alias("lang"), text_or_empty().alias("text"))
    totals, frequent = count_phrases(texts, min_count, longest, work, **sizes)
    found = work.put(scored(totals, frequent, cover_percent, work), "scored")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def op11_phrase_mining(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


ORACLE = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
), tokens AS (
  SELECT lang, regexp_split_to_array(trim(piece, chr(32) || chr(9)), '[\x20\x09]+') AS w
  FROM pieces WHERE trim(piece, chr(32) || chr(9)) <> ''
), places AS (
  SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM tokens
), f AS (
  SELECT lang, size, array_to_string(w[i:i + size - 1], ' ') AS phrase, count(*) AS f
  FROM places, (SELECT unnest(range(1, 6)) AS size) WHERE i + size - 1 <= len(w) GROUP BY ALL
), totals AS (
  SELECT lang, sum(f)::BIGINT AS n FROM f WHERE size = 1 GROUP BY lang
), candidates AS (
  SELECT lang, size, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE size >= 2 AND f >= 100
), kept AS (
  SELECT c.* FROM candidates c WHERE NOT EXISTS (
    SELECT 1 FROM candidates b WHERE b.lang = c.lang AND b.size > c.size AND 100 * b.a >= 100 * c.a
      AND contains(' ' || b.phrase || ' ', ' ' || c.phrase || ' '))
), cuts AS (
  SELECT lang, phrase, a, w, size, unnest(range(1, size)) AS k FROM kept
), scores AS (
  SELECT c.lang, c.phrase, c.a, x.f AS l, y.f AS r, t.n, c.k,
         (1000::HUGEINT * c.a * t.n // (x.f::HUGEINT * y.f))::BIGINT AS score
  FROM cuts c
  JOIN f x ON x.lang = c.lang AND x.phrase = array_to_string(c.w[1:c.k], ' ')
  JOIN f y ON y.lang = c.lang AND y.phrase = array_to_string(c.w[c.k + 1:c.size], ' ')
  JOIN totals t ON t.lang = c.lang
), lowest AS (
  SELECT * FROM scores QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM lowest QUALIFY rank <= 2000
"""
