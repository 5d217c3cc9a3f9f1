"""Dedup of long repeated byte strings by distributed prefix doubling over content-defined positions.

A full suffix array holds a rank for every byte. Only strings of ``length`` bytes matter here, so positions are thinned
first, without loss: a cut is the place of the least ``gram``-byte hash of some window of half a string. The cuts between
those of a string's first and last window depend on the string's bytes alone, so equal strings are cut alike, and hold at
least one whole piece (the bytes from one cut to the next).

1. Doubling: the rank of a piece stands for its bytes. In every round Spark joins each position with the one 2^k pieces
   on, sorts the distinct pairs of their ranks and reranks: a position then stands for 2^(k+1) pieces. Positions whose rank
   is unique leave, and so do those whose pieces are longer than a string; the rounds end when none is left.
2. A string can be repeated only if the runs of 2^k pieces that cover its whole pieces, one from its first cut and one up
   to its last, both still have a rank. Starts of such strings, grouped by their first cut, go on with the rank of
   the piece there.
3. What doubling leaves open are the bytes before the first and after the last cut. Equal rank, and equal bytes of all
   that a group of starts reaches, at two places: all their starts are repeated. Groups of a rank with several such reaches
   go on in blocks of ``block`` starts (one place stands for all equal ones), by the bytes that all starts of the block
   share with the bytes that any of them needs; the starts of blocks that still differ, one by one, by their whole bytes.

A settled string stays in its class through one place, since others may yet match it there. Ranks only gather candidates
(pieces are told apart by 64-bit hashes); names of bytes, which decide, have 128 bits. Classes are counted, never
collected, so a passage in a third of all documents is one large count; their names are written before they are joined back
to their places, so that Spark knows their size and splits the tasks of hot names.

Defined cases: a null or empty text has no bytes and removes none. Rows that share a doc_id and repeated rows are separate
texts, which repeat each other's strings. A row without a doc_id is treated like any other. Bytes are removed even
inside a character; ``text`` then leaves out what is no valid UTF-8, while the digest is over all remaining bytes.
Extra columns are ignored. A task holds some 100 bytes for each byte of its longest text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.llm.common import WorkTables, own_columns, table
from tidewater.llm.wordrows import chunks, sent, span_hashes

LENGTH, GRAM, BLOCK = 400, 32, 24
#: Bytes of texts worked on together (one text at least): few enough that their numbers stay in the processor's cache.
CHUNK = 256_000
#: A place in a chunk of texts takes the low bits of a number, the hash of the gram there the high ones.
PLACE_BITS = 31


def gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    """A mixed 64-bit rolling hash of each ``gram`` bytes, built by doubling: h(2k) from h(k) at two places."""
    h, width = data.astype(np.uint64) + np.uint64(1), 1
    h = (h * np.uint64(0x9E3779B97F4A7C15)) ^ (h << np.uint64(7))
    while width < gram:
        step = min(width, gram - width)
        h = h[: len(h) - step] * np.uint64(0xD6E8FEB86659FD93) + (h[step:] ^ (h[step:] >> np.uint64(29))) * np.uint64(0xCA5A826395121157)
        h ^= h >> np.uint64(32)
        width += step
    return h


@dataclass
class Cuts:
    """The cuts of some texts in one row of bytes.

    ``place`` and ``text`` of each cut, ``first`` cut of each text, and per window of each text (``windows`` is the number
    of its first one) the number of its cut.
    """

    place: np.ndarray
    text: np.ndarray
    first: np.ndarray
    of_window: np.ndarray
    windows: np.ndarray


def half(length: int, gram: int) -> int:
    """The width of a window in grams: a string's first and last one do not meet, so that a whole piece lies between."""
    return (length - gram + 1) // 2


def find_cuts(data: np.ndarray, offsets: np.ndarray, length: int, gram: int) -> Cuts:
    """Texts shorter than ``length`` have none. Of equal least grams the leftmost counts."""
    width, sizes = half(length, gram), np.diff(offsets)
    inside = np.where(sizes >= length, sizes - gram - width + 2, 0)
    windows = np.cumsum(inside) - inside
    local = np.arange(inside.sum()) - np.repeat(windows, inside)
    if not len(local):
        none = np.zeros(0, np.int64)
        return Cuts(none, none, np.zeros(len(sizes), np.int64), none, windows)
    h = gram_hashes(data, gram)
    low = np.uint64((1 << PLACE_BITS) - 1)
    least, have = (h & ~low) | np.arange(len(h), dtype=np.uint64), 1
    while have < width:  # sliding minimum by doubling
        step = min(have, width - have)
        least = np.minimum(least[: len(least) - step], least[step:])
        have += step
    at = (least[np.repeat(offsets[:-1], inside) + local] & low).astype(np.int64)
    new = np.concatenate([[True], at[1:] != at[:-1]])
    place = at[new]
    text = np.searchsorted(offsets, place, "right") - 1
    return Cuts(place, text, np.searchsorted(text, np.arange(len(sizes))), np.cumsum(new) - 1, windows)


def _name(data: bytes, *more: int) -> tuple[int, int]:
    """A 128-bit name of some bytes (and small numbers), as two signed 64-bit words."""
    import xxhash

    whole = xxhash.xxh3_128_digest(data + b"".join(m.to_bytes(4, "little") for m in more))
    return int.from_bytes(whole[:8], "little", signed=True), int.from_bytes(whole[8:], "little", signed=True)


def _batch(rows: list[tuple], fields: list[tuple[str, pa.DataType]]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [()] * len(fields)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, (_, k) in zip(columns, fields, strict=True)], [n for n, _ in fields])


def _piece_rows(length: int, gram: int):
    """(id, i, size, r): the pieces of a text that fit into a string, by number, with the hash of their bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for own, data, offsets in chunks(batch, 1, CHUNK):
                cuts = find_cuts(data, offsets, length, gram)
                start, end = cuts.place[:-1], cuts.place[1:]
                holds = np.flatnonzero((cuts.text[1:] == cuts.text[:-1]) & (end - start <= length - gram))
                start, end, text = start[holds], end[holds], cuts.text[holds]
                ids = own.column(0).to_numpy()[text]
                yield from sent(["id", "i", "size", "r"], ids, (holds - cuts.first[text]).astype(np.int32), (end - start).astype(np.int32), span_hashes(data, start, end))

    return run


def doubled(pieces: DataFrame, limit: int, work: WorkTables) -> list[DataFrame]:
    """(id, i, level, rank) by level: positions whose next 2^level pieces, at most ``limit`` bytes, occur elsewhere too."""
    levels, pairs, by = [], pieces, ["r"]
    while True:
        classes = pairs.groupBy(*by).agg(F.count(F.lit(1)).alias("places")).filter("places > 1")
        # Sorted by range, so that the row numbers are the order of the pairs.
        ranks = work.put(classes.orderBy(*by).select(*by, F.monotonically_increasing_id().alias("rank")), "ranks")
        alive = work.put(pairs.join(ranks, by).select("id", "i", "size", "rank"), "alive")
        work.drop(pairs)
        work.drop(ranks)
        levels.append(alive.select("id", "i", F.lit(len(levels)).alias("level"), "rank"))
        step = 1 << (len(levels) - 1)
        after = alive.select("id", (F.col("i") - step).alias("i"), F.col("size").alias("more"), F.col("rank").alias("r2"))
        longer = alive.withColumnRenamed("rank", "r1").join(after, ["id", "i"]).withColumn("size", F.col("size") + F.col("more"))
        pairs, by = work.put(longer.filter(F.col("size") <= limit).select("id", "i", "size", "r1", "r2"), "pairs"), ["r1", "r2"]
        if pairs.isEmpty():
            return levels


def _open_groups(cuts: Cuts, lists: pa.ListArray, sizes: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """(cut, first start, last start, rank): starts whose whole pieces have ranks, grouped by their first cut.

    ``lists`` holds (i, level, rank) of each text; starts are counted from the text's first byte.
    """
    found = lists.flatten()
    i, level, rank = (found.field(k).to_numpy(zero_copy_only=False) for k in range(3))
    if not len(i):
        return (np.zeros(0, np.int64),) * 4
    cut = cuts.first[np.repeat(np.arange(len(lists)), lists.value_lengths().to_numpy())] + i
    ranked = np.zeros((level.max() + 1, len(cuts.place)), bool)
    ranked[level, cut] = True
    own = np.zeros(len(cuts.place), np.int64)
    own[cut[level == 0]] = rank[level == 0]

    inside = np.where(sizes >= length, sizes - length + 1, 0)
    start = np.arange(inside.sum()) - np.repeat(np.cumsum(inside) - inside, inside)
    window = np.repeat(cuts.windows, inside) + start
    first, last = cuts.of_window[window], cuts.of_window[window + length - gram + 1 - half(length, gram)]
    # The largest power of two within the number of whole pieces; two runs of it cover them.
    power = np.array([0, *((n.bit_length() - 1) for n in range(1, length + 1))])[last - first]
    has = power < len(ranked)
    power = np.where(has, power, 0)
    has &= ranked[power, first] & ranked[power, last - (1 << power)]
    first, start = first[has], start[has]
    edge = np.flatnonzero(np.diff(first, prepend=-1, append=-1)) if len(first) else np.zeros(1, np.int64)
    return first[edge[:-1]], start[edge[:-1]], start[edge[1:] - 1], own[first[edge[:-1]]]


def _reach_rows(length: int, gram: int):
    """Each group of open starts with its rank ``g`` and the name (w1, w2) of all bytes that the starts reach."""
    import xxhash

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for own, data, offsets in chunks(batch, 1, CHUNK):
                cuts = find_cuts(data, offsets, length, gram)
                cut, first, last, rank = _open_groups(cuts, own.column(2), np.diff(offsets), length, gram)
                text, whole = cuts.text[cut], data.tobytes()
                base, at = offsets[text], cuts.place[cut]
                lo, hi = base + first, base + last + length
                around = np.stack([at - lo, at - base - last], axis=1).astype("<u4").tobytes()
                digests = [xxhash.xxh3_128_digest(whole[a:b] + around[8 * k : 8 * k + 8]) for k, (a, b) in enumerate(zip(lo.tolist(), hi.tolist(), strict=True))]
                w = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
                small = ((at - base).astype(np.int32), first.astype(np.int32), last.astype(np.int32))
                yield from sent(["id", "at", "first", "last", "g", "w1", "w2"], own.column(0).to_numpy()[text], *small, rank, np.ascontiguousarray(w[:, 0]), np.ascontiguousarray(w[:, 1]))

    return run


_BLOCK = pa.struct([("lo", pa.int32()), ("hi", pa.int32()), ("c1", pa.int64()), ("c2", pa.int64()), ("s1", pa.int64()), ("s2", pa.int64())])
_BLOCKS = [("id", pa.int64()), ("at", pa.int32()), ("settled", pa.bool_()), ("first", pa.int32()), ("bytes", pa.binary()), ("blocks", pa.list_(_BLOCK))]


def _block_rows(length: int, block: int):
    """The starts before each given cut in blocks by their distance before it, with both names of a block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            for did, text, places in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist(), batch.column(2).to_pylist(), strict=True):
                for p in places:
                    at, first, last, blocks = p["at"], p["first"], p["last"], []
                    for k in range((at - last) // block, (at - first) // block + 1):
                        lo, hi = max(first, at - (k + 1) * block + 1), min(last, at - k * block)
                        # Shared by all starts of the block, wherever a text's own part of it ends.
                        core = _name(text[at - k * block : at - (k + 1) * block + 1 + length], k)
                        blocks.append((lo, hi, *core, *_name(text[lo : hi + length], k, at - lo, at - hi)))
                    rows.append((did, at, p["settled"], first, text[first : last + length], [dict(zip(("lo", "hi", "c1", "c2", "s1", "s2"), b, strict=True)) for b in blocks]))
            yield _batch(rows, _BLOCKS)

    return run


_STARTS = [("id", pa.int64()), ("start", pa.int32()), ("settled", pa.bool_()), ("n1", pa.int64()), ("n2", pa.int64())]


def _start_rows(length: int):
    """Every start of a block that still differs, with the name of its whole string."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            for did, settled, first, lo, hi, data in zip(*(batch.column(i).to_pylist() for i in range(6)), strict=True):
                for start in range(lo, hi + 1):
                    rows.append((did, start, settled, *_name(data[start - first : start - first + length])))
            yield _batch(rows, _STARTS)

    return run


def _agreed(members: DataFrame, rank: list[str], pair: list[str], place: list[str], work: WorkTables) -> tuple[DataFrame, DataFrame]:
    """Counts classes of equal (rank, pair): those in two places or more, and one place for each pair of a split rank."""
    rep = F.min(F.struct(*place, "settled")).alias("rep")
    classes = work.put(members.groupBy(*rank, *pair).agg(F.count(F.lit(1)).alias("places"), rep), "classes")
    agreed = work.put(classes.filter("places > 1").select(*rank, *pair), "agreed")
    split = work.put(classes.groupBy(*rank).agg(F.count(F.lit(1)).alias("pairs")).filter("pairs > 1").select(*rank), "split")
    alive = classes.join(split, rank).select("rep.*", "places").withColumn("settled", F.col("settled") | (F.col("places") > 1)).drop("places")
    return agreed, alive


def repeated_starts(rows: DataFrame, length: int, gram: int, block: int, work: WorkTables) -> DataFrame:
    """(id, lo, hi): runs of starts of ``length``-byte strings that occur at another place too.

    ``rows`` is (id, text), ids unique.
    """
    pieces = work.put(rows.mapInArrow(_piece_rows(length, gram), "id long, i int, size int, r long"), "pieces")
    ranks = reduce(DataFrame.union, doubled(pieces, length - gram, work))
    ranks = ranks.groupBy("id").agg(F.collect_list(F.struct("i", "level", "rank")).alias("ranks"))
    open_ = rows.join(ranks, "id").select("id", "text", "ranks")
    places = work.put(open_.mapInArrow(_reach_rows(length, gram), "id long, at int, first int, last int, g long, w1 long, w2 long"), "places")
    agreed, alive = _agreed(places.withColumn("settled", F.lit(False)), ["g"], ["w1", "w2"], ["id", "at", "first", "last"], work)
    settled = places.join(agreed, ["g", "w1", "w2"]).select("id", F.col("first").alias("lo"), F.col("last").alias("hi"))
    found = [work.put(settled, "whole")]
    work.drop(places)

    own = alive.groupBy("id").agg(F.collect_list(F.struct("at", "first", "last", "settled")).alias("places"))
    shape = "id long, at int, settled boolean, first int, bytes binary, blocks array<struct<lo:int,hi:int,c1:long,c2:long,s1:long,s2:long>>"
    reaches = work.put(rows.join(own, "id").select("id", "text", "places").mapInArrow(_block_rows(length, block), shape), "blocks")
    blocks = reaches.select("id", "at", "settled", F.inline("blocks"))
    agreed, alive = _agreed(blocks, ["c1", "c2"], ["s1", "s2"], ["id", "at", "lo", "hi"], work)
    found.append(work.put(blocks.filter(~F.col("settled")).join(agreed, ["c1", "c2", "s1", "s2"]).select("id", "lo", "hi"), "block"))

    single = alive.join(reaches.select("id", "at", "first", "bytes"), ["id", "at"]).select("id", "settled", "first", "lo", "hi", "bytes")
    starts = work.put(single.mapInArrow(_start_rows(length), "id long, start int, settled boolean, n1 long, n2 long"), "starts")
    work.drop(reaches)
    twice = starts.groupBy("n1", "n2").agg(F.count(F.lit(1)).alias("places")).filter("places > 1").select("n1", "n2")
    twice = work.put(twice, "twice")
    found.append(starts.filter(~F.col("settled")).join(twice, ["n1", "n2"]).select("id", F.col("start").alias("lo"), F.col("start").alias("hi")))
    return found[0].union(found[1]).union(found[2])


def _cut(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for doc_id, text, runs in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist(), batch.column(2).to_pylist(), strict=True):
                text, kept, upto, spans = text or b"", [], 0, 0
                end = 0
                for lo, hi in sorted((r["lo"], r["hi"] + length) for r in runs or ()):
                    if lo > end or not spans:
                        kept.append(text[upto:lo])
                        spans += 1
                    end = max(end, hi)
                    upto = end
                kept.append(text[upto:])
                rest = b"".join(kept)
                out.append((doc_id, len(text), len(text) - len(rest), spans, hashlib.sha256(rest).hexdigest(), rest.decode("utf-8", "ignore")))
            yield _batch(out, [("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string()), ("text", pa.string())])

    return run


def remove_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, block: int = BLOCK) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256, text) of each document row without its repeated bytes."""
    work = WorkTables(docs.sparkSession, clean=True)
    rows = work.put(own_columns(docs, "doc_id", "text").withColumn("id", F.monotonically_increasing_id()), "rows", compression="zstd")
    runs = repeated_starts(rows.filter("text IS NOT NULL").select("id", "text"), length, gram, block, work)
    runs = runs.groupBy("id").agg(F.collect_list(F.struct("lo", "hi")).alias("runs"))
    cut = rows.join(runs, "id", "left").select("doc_id", "text", "runs")
    return cut.mapInArrow(_cut(length), "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, text string")


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents")).drop("text")
