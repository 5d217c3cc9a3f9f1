"""Line dedup over sharded cuckoo filters backed by exact reference-count tables.

State (``LineIndex``) is three tables, each keyed by ``shard`` (low bits of the line key's digest):

* ``refs(shard, key, doc_id)``: which document holds which line key; exact, one row per pair;
* ``counts(shard, key, n_docs, last_doc)``: the keys held by at least ``min_docs`` documents;
* ``filters(shard, bits)``: one cuckoo filter per shard over the keys of ``counts``.

``insert`` and ``delete`` change ``refs`` and re-derive only the touched shards' counts; the filters of those shards
take the keys that came in and give up the keys that went out, so a deletion undoes an insertion exactly.
``resolve`` probes every line of a document table against its shard's filter; what passes is confirmed by an exact
join to ``counts``, so a filter's false positive never drops a line.

Defined cases: a null or empty text is one empty line. Documents are told apart by ``doc_id``, and rows that share one
count as one holder. A row without ``doc_id`` holds no line and loses none. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tidewater.llm.common import WorkTables, own_columns, table

#: Fixed values of the line key: the stripped bytes [\x20\x09-\x0D].
BLANK = b" \t\n\x0b\x0c\r"
SLOTS, KICKS = 4, 500


def line_keys(text: bytes | None, min_chars: int) -> list[bytes | None]:
    """For each line of a text the digest of its key, or None where the key is shorter than ``min_chars`` code points."""
    out = []
    for line in (text or b"").split(b"\n"):
        key = line.strip(BLANK)
        long_enough = len(key) >= min_chars and (len(key) >= 4 * min_chars or len(key.decode("utf-8", "replace")) >= min_chars)
        out.append(hashlib.blake2b(key.lower(), digest_size=16).digest() if long_enough else None)
    return out


class CuckooFilter:
    """Partial-key cuckoo filter over 16-byte digests: 16-bit tags, four to a bucket, two buckets to a key.

    ``table`` is a (buckets, 4) array; its bytes are the stored form. Insertion doubles the table when it is full.
    """

    def __init__(self, cells: np.ndarray):
        self.cells = cells

    @classmethod
    def sized(cls, n: int) -> CuckooFilter:
        buckets = 1 << max(2, int(np.ceil(np.log2(max(1, n) / (SLOTS * 0.8)))))
        return cls(np.zeros((buckets, SLOTS), np.uint16))

    @classmethod
    def of(cls, keys: list[bytes]) -> CuckooFilter:
        made, n = cls.sized(len(keys)), len(keys)
        while not all(made.add(k) for k in keys):
            n *= 2
            made = cls.sized(n)
        return made

    @classmethod
    def load(cls, bits: bytes) -> CuckooFilter:
        return cls(np.frombuffer(bits, np.uint16).reshape(-1, SLOTS).copy())

    def dump(self) -> bytes:
        return self.cells.tobytes()

    def _spots(self, digests: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Tag (never 0) and both buckets of each digest, given as an (n, 2) array of 64-bit words."""
        mask = np.uint64(len(self.cells) - 1)
        tag = (digests[:, 1] % np.uint64(65535) + np.uint64(1)).astype(np.uint16)
        one = (digests[:, 1] >> np.uint64(20)) & mask
        return tag, one, one ^ self._hop(tag)

    def _hop(self, tag: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return (tag.astype(np.uint64) * np.uint64(0x5BD1E995)) & np.uint64(len(self.cells) - 1)

    def contains(self, digests: np.ndarray) -> np.ndarray:
        tag, one, two = self._spots(digests)
        return (self.cells[one] == tag[:, None]).any(1) | (self.cells[two] == tag[:, None]).any(1)

    def add(self, key: bytes) -> bool:
        """False if no place was found; the caller then rebuilds a larger filter from the exact table."""
        tag, one, two = (x[0] for x in self._spots(words([key])))
        for bucket in (one, two):
            if (free := np.flatnonzero(self.cells[bucket] == 0)).size:
                self.cells[bucket, free[0]] = tag
                return True
        bucket = two
        for kick in range(KICKS):
            slot = (int(tag) + kick) % SLOTS
            self.cells[bucket, slot], tag = tag, self.cells[bucket, slot]
            bucket = bucket ^ self._hop(np.array([tag]))[0]
            if (free := np.flatnonzero(self.cells[bucket] == 0)).size:
                self.cells[bucket, free[0]] = tag
                return True
        return False

    def remove(self, key: bytes) -> bool:
        """Takes one copy of the key's tag out. Only for keys that were added."""
        tag, one, two = (x[0] for x in self._spots(words([key])))
        for bucket in (one, two):
            if (found := np.flatnonzero(self.cells[bucket] == tag)).size:
                self.cells[bucket, found[0]] = 0
                return True
        return False


def words(keys: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(keys), np.uint64).reshape(-1, 2)


def _emit_keys(min_chars: int, shards: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, keys = [], []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist(), strict=True):
                if doc_id is not None and text and (own := set(line_keys(text, min_chars)) - {None}):
                    ids += [doc_id] * len(own)
                    keys += own
            shard = (words(keys)[:, 0] % np.uint64(shards)).astype(np.int32) if keys else np.zeros(0, np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(shard, pa.int32()), pa.array(keys, pa.binary()), pa.array(ids, pa.int64())], ["shard", "key", "doc_id"])

    return run


def line_refs(docs: DataFrame, min_chars: int = 20, shards: int = 256) -> DataFrame:
    """(shard, key, doc_id): the distinct long line keys of each document row."""
    return own_columns(docs, "doc_id", "text").mapInArrow(_emit_keys(min_chars, shards), "shard int, key binary, doc_id long")


def shared_counts(refs: DataFrame, min_docs: int) -> DataFrame:
    """Keys in at least ``min_docs`` documents; partial sums run before the shuffle, so a line in every document is cheap."""
    counted = refs.groupBy("shard", "key").agg(F.count(F.lit(1)).alias("n_docs"), F.max("doc_id").alias("last_doc"))
    return counted.filter(F.col("n_docs") >= min_docs)


def _build_filter(rows: pd.DataFrame) -> pd.DataFrame:
    keys = sorted(map(bytes, rows["key"]))
    return pd.DataFrame({"shard": [rows["shard"].iloc[0]], "bits": [CuckooFilter.of(keys).dump()]})


def build_filters(counts: DataFrame) -> DataFrame:
    """One filter per shard; a group holds the distinct shared keys of one shard, which the number of shards bounds."""
    return counts.select("shard", "key").groupBy("shard").applyInPandas(_build_filter, "shard int, bits binary")


def _patch_filter(key, old: pd.DataFrame, change: pd.DataFrame) -> pd.DataFrame:
    """Removes the keys that fell below the threshold and adds those that reached it; rebuilds if the filter is full."""
    change = change.sort_values(["now", "key"])
    gone, new = ([bytes(k) for k in change["key"][(change["was"] == w) & (change["now"] == n)]] for w, n in ((True, False), (False, True)))
    held = CuckooFilter.load(bytes(old["bits"].iloc[0])) if len(old) else CuckooFilter.sized(len(new))
    done = all([held.remove(k) for k in gone]) and all(held.add(k) for k in new)
    if not done:
        held = CuckooFilter.of(sorted(bytes(k) for k in change["key"][change["now"]]))
    return pd.DataFrame({"shard": [key[0]], "bits": [held.dump()]})


@dataclass(frozen=True)
class LineIndex:
    """The state of incremental line dedup. Every change returns a new index over new work tables."""

    spark: SparkSession
    min_chars: int = 20
    min_docs: int = 3
    shards: int = 256
    refs: DataFrame | None = None
    counts: DataFrame | None = None
    filters: DataFrame | None = None

    def insert(self, docs: DataFrame) -> LineIndex:
        """Adds documents. A document that the index already holds gains the lines that it did not have."""
        refs = line_refs(docs, self.min_chars, self.shards)
        work = WorkTables(self.spark)
        if self.refs is None:
            refs = work.put(refs.distinct(), "refs")
            counts = work.put(shared_counts(refs, self.min_docs), "counts")
            return replace(self, refs=refs, counts=counts, filters=work.put(build_filters(counts), "filters"))
        return self._changed(work, self.refs.union(refs).distinct())

    def delete(self, doc_ids: DataFrame) -> LineIndex:
        """Takes the documents named in ``doc_ids.doc_id`` out again, as if they had never been inserted."""
        gone = doc_ids.select(F.col("doc_id").cast("long")).distinct()
        return self if self.refs is None else self._changed(WorkTables(self.spark), self.refs.join(gone, "doc_id", "left_anti").select("shard", "key", "doc_id"))

    def _changed(self, work: WorkTables, refs: DataFrame) -> LineIndex:
        refs = work.put(refs, "refs")
        counts = work.put(shared_counts(refs, self.min_docs), "counts")
        change = self.counts.select("shard", "key", F.lit(True).alias("was")).join(counts.select("shard", "key", F.lit(True).alias("now")), ["shard", "key"], "full")
        change = change.select("shard", "key", *[F.coalesce(c, F.lit(False)).alias(c) for c in ("was", "now")])
        filters = self.filters.groupBy("shard").cogroup(change.groupBy("shard")).applyInPandas(_patch_filter, "shard int, bits binary")
        return replace(self, refs=refs, counts=counts, filters=work.put(filters, "filters"))

    def dropped_keys(self, salts: int = 16) -> DataFrame:
        """(doc_id, keys): the line keys that each indexed document loses.

        The references are probed shard by shard against the cuckoo filter. A shard's rows are split over ``salts``
        tasks, each with its own copy of the (bounded) filter, so a hot line does not fill one task.
        """
        spread = F.pmod(F.xxhash64("doc_id"), F.lit(salts)).cast("int")
        probes = self.refs.withColumn("salt", spread)
        copies = self.filters.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        passed = copies.groupBy("shard", "salt").cogroup(probes.groupBy("shard", "salt")).applyInArrow(_probe, "shard int, key binary, doc_id long")
        losers = passed.join(self.counts, ["shard", "key"]).filter(F.col("doc_id") != F.col("last_doc"))
        return losers.groupBy("doc_id").agg(F.collect_list("key").alias("keys"))

    def resolve(self, docs: DataFrame) -> DataFrame:
        """(doc_id, text, n_lines, n_dropped, kept_sha256) of each document row without its dropped lines."""
        rows = own_columns(docs, "doc_id", "text").join(self.dropped_keys(), "doc_id", "left")
        return rows.mapInArrow(_keep_lines(self.min_chars), "doc_id long, text string, n_lines long, n_dropped long, kept_sha256 string")


def _probe(filters: pa.Table, lines: pa.Table) -> pa.Table:
    lines = lines.select(["shard", "key", "doc_id"])
    if not filters.num_rows or not lines.num_rows:
        return lines.slice(0, 0)
    held = CuckooFilter.load(filters["bits"][0].as_py())
    return lines.filter(pa.array(held.contains(words(lines["key"].to_pylist()))))


def _keep_lines(min_chars: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, n_lines, n_dropped, sums = [], [], [], []
            for text, keys in zip(batch.column(1).cast(pa.binary()).to_pylist(), batch.column(2).to_pylist(), strict=True):
                lines = (text or b"").split(b"\n")
                kept = lines
                if keys:
                    lost = set(keys)
                    kept = [x for x, k in zip(lines, line_keys(text, min_chars), strict=True) if k not in lost]
                whole = b"\n".join(kept)
                texts.append(whole)
                n_lines.append(len(lines))
                n_dropped.append(len(lines) - len(kept))
                sums.append(hashlib.sha256(whole).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(texts, pa.binary()).cast(pa.string()), pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64()), pa.array(sums, pa.string())],
                ["doc_id", "text", "n_lines", "n_dropped", "kept_sha256"],
            )

    return run


def without_lines(docs: DataFrame, lost: DataFrame, min_chars: int = 20) -> DataFrame:
    """``docs`` with all its columns, ``text`` without the keys of ``lost`` and ``n_chars``, if there, its new length.

    A row that loses no line keeps its text and n_chars as they are.
    """
    names = docs.columns
    row = docs.select("doc_id", "text", F.struct(*[F.col(f"`{c}`") for c in names]).alias("row")).join(lost, "doc_id", "left")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for text, keys in zip(batch.column(1).cast(pa.binary()).to_pylist(), batch.column(3).to_pylist(), strict=True):
                lines = (text or b"").split(b"\n") if keys else []
                gone = set(keys or ())
                texts.append(b"\n".join([x for x, k in zip(lines, line_keys(text, min_chars), strict=True) if k not in gone]) if keys else None)
            yield pa.RecordBatch.from_arrays([batch.column(2), pa.array(texts, pa.binary()).cast(pa.string())], ["row", "cut"])

    shape = StructType([*row.select("row").schema, StructField("cut", StringType())])
    out = row.mapInArrow(cut, shape)
    new = {"text": F.coalesce("cut", "row.text"), "n_chars": F.when(F.col("cut").isNull(), F.col("row.n_chars")).otherwise(F.length("cut").cast("long")) if "n_chars" in names else None}
    return out.select(*[new[c].alias(c) if c in new else F.col(f"row.`{c}`").alias(c) for c in names])


def dedup_lines(docs: DataFrame, min_chars: int = 20, min_docs: int = 3, shards: int = 256) -> DataFrame:
    """Indexes all rows of ``docs`` and resolves them against that index."""
    return LineIndex(docs.sparkSession, min_chars, min_docs, shards).insert(docs).resolve(docs)


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_lines(table(spark, sf_dir, "documents")).drop("text")


ORACLE = r"""
WITH lines AS (
  SELECT doc_id, pos, line, regexp_replace(regexp_replace(
           translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '^[\x20\x09-\x0D]+', ''), '[\x20\x09-\x0D]+$', '') AS key
  FROM (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
               unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS pos FROM documents)
), shared AS (
  SELECT key, max(doc_id) AS last_doc FROM lines WHERE length(key) >= 20
  GROUP BY key HAVING count(DISTINCT doc_id) >= 3
), marked AS (
  SELECT l.doc_id, l.pos, l.line, s.last_doc IS NOT NULL AND s.last_doc <> l.doc_id AS gone
  FROM lines l LEFT JOIN shared s ON s.key = l.key
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""
