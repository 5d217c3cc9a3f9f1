"""The words of many texts as rows of numbers: places, 64-bit hashes, and hashes of runs of words, without a Python loop."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Rows of an Arrow batch sent back to Spark, and bytes of texts worked on together (one text at least).
BATCH, CHUNK = 200_000, 2_000_000

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
BASE = 0x9E3779B97F4A7C15
_powers: dict[str, np.ndarray] = {}


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def rolling(hashes: np.ndarray, width: int) -> np.ndarray:
    """The hash of every ``width`` consecutive words, built by doubling: a run of 2k words from two runs of k."""
    have, h = 1, hashes
    while have < width and len(h):
        step = min(have, width - have)
        h = mixed(h[: max(0, len(h) - step)] * np.uint64(0x9FB21C651E98DF25) + (h[step:] ^ (h[step:] >> np.uint64(31))))
        have += step
    return h


def _power(name: str, base: int, count: int) -> np.ndarray:
    """base^0, base^1, ... of at least ``count`` powers modulo 2^64, kept for the next call."""
    if name not in _powers or len(_powers[name]) < count:
        _powers[name] = np.concatenate([np.ones(1, np.uint64), np.multiply.accumulate(np.full(count, base % 2**64, np.uint64))])
    return _powers[name]


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of the bytes of each span, from differences of running sums."""
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _power("up", BASE, len(data))[: len(data)], dtype=np.uint64)])
    poly = (sums[ends] - sums[starts]) * _power("down", pow(BASE, -1, 2**64), len(data))[starts]
    return mixed(mixed(poly + (ends - starts).astype(np.uint64) * np.uint64(0x9FB21C651E98DF25)))


class Words:
    """The words of some texts in one row: ``starts``, ``ends``, ``hashes``, and each text's ``first`` word and ``count``.

    A word's hash is that of a polynomial in its bytes, from differences of running sums over all texts.
    """

    def __init__(self, data: np.ndarray, offsets: np.ndarray, space: np.ndarray = SPACE):
        solid = np.concatenate([~space[data], [False]])
        begin = solid.copy()
        begin[1:] &= ~solid[:-1]
        begin[offsets] = solid[offsets]  # a text's first byte never goes on with the word before it
        self.starts = starts = np.flatnonzero(begin)
        last = solid.copy()
        last[:-1] &= ~solid[1:] | begin[1:]
        self.ends = ends = np.flatnonzero(last) + 1
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _power("up", BASE, len(data))[: len(data)], dtype=np.uint64)])
        poly = (sums[ends] - sums[starts]) * _power("down", pow(BASE, -1, 2**64), len(data))[starts]
        self.hashes = mixed(mixed(poly + (ends - starts).astype(np.uint64) * np.uint64(0x9FB21C651E98DF25)))
        edges = np.searchsorted(starts, offsets)
        self.first, self.count = edges[:-1], np.diff(edges)


def chunks(batch: pa.RecordBatch, text: int, size: int = CHUNK) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """The batch in slices of whole texts with each slice's bytes and its texts' offsets in them; a null text has none."""
    column = pc.fill_null(batch.column(text).cast(pa.binary()), b"")
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data, at = column.buffers()[2], 0
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    while at < len(column):
        end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + size, "right")) - 1)
        yield batch.slice(at, end - at), data[offsets[at] : offsets[end]], offsets[at : end + 1] - offsets[at]
        at = end


def sent(names: list[str], *columns: np.ndarray) -> Iterator[pa.RecordBatch]:
    for at in range(0, len(columns[0]), BATCH):
        yield pa.RecordBatch.from_arrays([pa.array(c[at : at + BATCH].view(np.int64) if c.dtype == np.uint64 else c[at : at + BATCH]) for c in columns], names)
