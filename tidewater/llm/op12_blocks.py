"""Dedup of long repeated word sequences by fixed-block anchors.

A window is ``length`` consecutive words of one text. The reference index holds each text's non-overlapping blocks of
``(length + 1) // 2`` words, counted from its start, so that every window has a whole block inside, wherever it starts.

1. Index: the blocks of all texts by hash, with the number of their places.
2. Probe: every rolling window of a block's width, of every text, is looked up in the index, in ``SLICES`` rounds of one
   part of the hashes each, so that only that part of all windows is on its way at a time. A hit is a place whose block's
   words stand at another place too, at least one of the two a reference block.
3. Extend: all windows around a hit lie in its context, the hit with ``length - block`` words on either side as far as the
   text goes. Hits of equal context extend over all of it at once: contexts are counted, and one that has two places
   marks all windows in it. What is left are blocks with several contexts. One place of each context (so copies count
   once) goes on with its words to the left and to the right, half of the context's margin each: a repeat reaches over at
   least one of these halves. Contexts that share a half with another give the names of their windows on that side, and a
   window that two contexts share marks a place whose context was its only one. The union of all marked windows is the
   maximal exact repeats.

Each round counts names (128 bits: the block's hash with the hash of the words around it) and never forms pairs: a passage
in a third of all texts is one name with a large count. Joins read written tables on both sides, so that Spark splits the
tasks of hot names.

Defined cases: a null, empty or wordless text has no words and loses none. Rows that share a doc_id and repeated rows are
separate texts. A row without a doc_id is treated like any other. Words are compared as they are, byte by byte; a text that
is cut is its kept words joined by one space. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce
from itertools import compress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.llm.common import WorkTables, own_columns, table
from tidewater.llm.wordrows import BASE, Words, chunks, mixed, rolling, sent

LENGTH, SLICES = 35, 4


def width_of(length: int) -> int:
    """The longest block that fits, aligned, into every window wherever the window starts."""
    return (length + 1) // 2


def _block_rows(length: int, part: int | None = None, parts: int = 1):
    """(h, id, pos): a text's reference blocks, or all its other windows of that width in one part of the hashes.

    Texts without a window have none.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width = width_of(length)
        for batch in batches:
            for own, data, offsets in chunks(batch, 1):
                words = Words(data, offsets)
                inside = np.where(words.count >= length, words.count - width + 1, 0)
                position = np.arange(inside.sum()) - np.repeat(np.cumsum(inside) - inside, inside)
                h = rolling(words.hashes, width)[np.repeat(words.first, inside) + position]
                aligned = position % width == 0
                wanted = np.flatnonzero(aligned if part is None else ~aligned & (((h >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32) == part))
                ids = np.repeat(own.column(0).to_numpy(), inside)
                yield from sent(["h", "id", "pos"], h[wanted], ids[wanted], position[wanted].astype(np.int32))

    return run


def _placed(own: pa.RecordBatch, words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray, dict[str, np.ndarray]]:
    """Per place in the rows (id, text, places): its text's id, first word and word count, and its own fields."""
    lists = own.column(2)
    places = lists.flatten()
    each = np.repeat(np.arange(len(lists)), lists.value_lengths().to_numpy())
    fields = {f.name: places.field(i).to_numpy(zero_copy_only=False) for i, f in enumerate(places.type)}
    return own.column(0).to_numpy()[each], words.first[each], words.count[each], fields


def _contexts(length: int):
    """(h, c, id, pos) of each hit whose context holds a window; ``c`` names the context and the block's place in it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width = width_of(length)
        margin = length - width
        for batch in batches:
            for own, data, offsets in chunks(batch, 1):
                words = Words(data, offsets)
                ids, base, count, hit = _placed(own, words)
                first, end = np.maximum(hit["pos"] - margin, 0), np.minimum(hit["pos"] + width + margin, count)
                holds = np.flatnonzero(end - first >= length)
                ids, base, first, end, pos, h = (x[holds] for x in (ids, base, first, end, hit["pos"], hit["h"]))
                windows = rolling(words.hashes, length)
                # A context is at most two windows long: the first and the last one in it cover it.
                shape = ((pos - first) * 2 * length + (end - first)).astype(np.uint64)
                c = mixed(mixed(windows[base + first] * np.uint64(0x9FB21C651E98DF25) + windows[base + end - length]) + shape * np.uint64(BASE))
                yield from sent(["h", "c", "id", "pos"], h, c, ids, pos)

    return run


_NAMED = ["h", "side", "c", "id", "pos", "alone"]


def _halves(length: int):
    """(h, side, c, id, pos, alone) of each place: the block with half of the margin to its left (0) and right (1).

    A window reaches at least that far to one of the two sides; a side the text is too short for has no row.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width = width_of(length)
        left = (length - width + 1) // 2
        right = length - width - left + 1
        for batch in batches:
            for own, data, offsets in chunks(batch, 1):
                words = Words(data, offsets)
                ids, base, count, place = _placed(own, words)
                pos = place["pos"]
                for side, first, size in ((0, pos - left, width + left), (1, pos, width + right)):
                    holds = np.flatnonzero((first >= 0) & (first + size <= count))
                    c = rolling(words.hashes, size)[base[holds] + first[holds]]
                    yield from sent(_NAMED, place["h"][holds], np.full(len(holds), side, np.int32), c, ids[holds], pos[holds], place["alone"][holds])

    return run


def _window_names(length: int):
    """(h, side as the words left of the block, c, id, pos, alone) of the windows on the sides that are still open."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width = width_of(length)
        left = (length - width + 1) // 2
        for batch in batches:
            for own, data, offsets in chunks(batch, 1):
                words = Words(data, offsets)
                ids, base, count, place = _placed(own, words)
                windows = rolling(words.hashes, length)
                for before in range(length - width + 1):
                    first = place["pos"] - before
                    holds = np.flatnonzero((place["side"] == (before < left)) & (first >= 0) & (first + length <= count))
                    c = windows[base[holds] + first[holds]]
                    yield from sent(_NAMED, place["h"][holds], np.full(len(holds), before, np.int32), c, ids[holds], place["pos"][holds], place["alone"][holds])

    return run


def _per_text(places: DataFrame, *names: str) -> DataFrame:
    """One row per text with its places (no more than it has words)."""
    return places.groupBy("id").agg(F.collect_list(F.struct(*names)).alias("places"))


def _shared(named: DataFrame, work: WorkTables, name: str) -> DataFrame:
    """The names that two places or more have."""
    twice = named.groupBy("h", "side", "c").agg(F.count(F.lit(1)).alias("places")).filter("places > 1").select("h", "side", "c")
    return work.put(twice, name)


def repeated_windows(rows: DataFrame, length: int, work: WorkTables, slices: int = SLICES) -> DataFrame:
    """(id, first, end): runs of words all of whose windows occur elsewhere too; ``rows`` is (id, text), ids unique.

    The end may lie beyond the text's last word.
    """
    width = width_of(length)
    margin = length - width
    shape = "h long, id long, pos int"
    blocks = work.put(rows.mapInArrow(_block_rows(length), shape), "blocks")
    index = work.put(blocks.groupBy("h").agg(F.count(F.lit(1)).alias("places")), "index")
    parts = [work.put(rows.mapInArrow(_block_rows(length, part, slices), shape).join(index.select("h"), "h"), "probed") for part in range(slices)]
    probed = reduce(DataFrame.union, parts)
    touched = work.put(probed.select("h").union(index.filter("places > 1").select("h")).distinct(), "touched")
    hits = probed.select("h", "id", "pos").union(blocks.join(touched, "h").select("h", "id", "pos"))

    with_places = lambda places: rows.join(places, "id").select("id", "text", "places")
    contexts = work.put(with_places(_per_text(hits, "h", "pos")).mapInArrow(_contexts(length), "h long, c long, id long, pos int"), "contexts")
    one = F.min(F.struct("id", "pos")).alias("one")
    classes = work.put(contexts.groupBy("h", "c").agg(F.count(F.lit(1)).alias("places"), one), "classes")
    settled = contexts.join(classes.filter("places > 1").select("h", "c"), ["h", "c"])
    whole = work.put(settled.select("id", F.greatest(F.col("pos") - margin, F.lit(0)).alias("first"), (F.col("pos") + width + margin).alias("end")), "whole")

    several = work.put(classes.groupBy("h").agg(F.count(F.lit(1)).alias("contexts")).filter("contexts > 1").select("h"), "several")
    alive = work.put(classes.join(several, "h").select("h", "one.id", "one.pos", (F.col("places") == 1).alias("alone")), "alive")
    named = "h long, side int, c long, id long, pos int, alone boolean"
    halves = work.put(with_places(_per_text(alive, "h", "pos", "alone")).mapInArrow(_halves(length), named), "halves")
    open_ = halves.join(_shared(halves, work, "shared-halves"), ["h", "side", "c"]).select("id", "h", "pos", "alone", "side")
    windows = work.put(with_places(_per_text(open_, "h", "pos", "alone", "side")).mapInArrow(_window_names(length), named), "windows")
    lone = windows.filter("alone").join(_shared(windows, work, "shared-windows"), ["h", "side", "c"])
    single = lone.select("id", (F.col("pos") - F.col("side")).alias("first"), (F.col("pos") - F.col("side") + length).alias("end"))
    return whole.union(work.put(single, "single"))


_CUT = [("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("spans", pa.list_(pa.list_(pa.int32()))), ("kept_sha256", pa.string()), ("text", pa.string())]


def _cut(with_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            runs, at = batch.column(2), 0
            firsts, ends = (runs.flatten().field(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            lengths = pc.fill_null(runs.value_lengths(), 0).to_pylist()
            for doc_id, text, found in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist(), lengths, strict=True):
                kept = words = (text or b"").split()
                spans = np.zeros((0, 2), np.int32)
                if found:
                    change = np.zeros(len(words) + 2, np.int64)
                    np.add.at(change, firsts[at : at + found] + 1, 1)
                    np.add.at(change, np.minimum(ends[at : at + found], len(words)) + 1, -1)
                    stays = np.cumsum(change) <= 0
                    kept = list(compress(words, stays[1:-1].tolist()))
                    spans = np.flatnonzero(np.diff(stays)).reshape(-1, 2)
                    at += found
                rest = b" ".join(kept)
                out.append((doc_id, len(words), len(words) - len(kept), spans.tolist(), hashlib.sha256(rest).hexdigest(), rest.decode() if with_text else None))
            columns = list(zip(*out, strict=True)) if out else [()] * len(_CUT)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, (_, k) in zip(columns, _CUT, strict=True)], [n for n, _ in _CUT])

    return run


def remove_repeats(docs: DataFrame, length: int = LENGTH, with_text: bool = True) -> DataFrame:
    """(doc_id, n_words, n_removed, spans, kept_sha256, text) of each row; spans are the removed runs [first, end) of words."""
    work = WorkTables(docs.sparkSession, clean=True)
    numbered = own_columns(docs, "doc_id", "text").withColumn("id", F.monotonically_increasing_id())
    rows = work.put(numbered, "rows", compression="zstd")
    texts = rows.filter("text IS NOT NULL").select("id", "text")
    runs = repeated_windows(texts, length, work)
    runs = runs.groupBy("id").agg(F.collect_list(F.struct("first", "end")).alias("runs"))
    cut = rows.join(runs, "id", "left").select("doc_id", "text", "runs")
    shape = "doc_id long, n_words long, n_removed long, spans array<array<int>>, kept_sha256 string, text string"
    return cut.mapInArrow(_cut(with_text), shape)


def op12_block_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents"), with_text=False).select("doc_id", "n_words", "n_removed", "kept_sha256")
