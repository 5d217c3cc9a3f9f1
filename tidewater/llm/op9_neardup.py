"""Near-duplicate groups: SuperMinHash signatures, banding, verification on full sets, distributed union-find.

1. Each text becomes its set of word shingles (64-bit hashes), a 128-bit key of the set and the band keys of its
   SuperMinHash signature. Documents with equal sets collapse to one node before anything is compared.
2. Nodes that share a band key meet in a bucket. Round one compares every node with its bucket's least node only, so a
   bucket of k nodes makes k pairs. Candidates whose set sizes rule a link out are never compared.
3. The confirmed links are merged by ``components`` (hooking to the least neighbour, jumping, contraction): first one
   pair of each node, then those pairs whose ends are still in different components.
4. Buckets that still hold several components are finished exactly: those of up to ``block`` nodes by their untested
   pairs across components, the nodes of larger ones by a prefix join on their rarest shingles (``prefix_pairs``).

With 40 bands of 8 rows a pair at similarity 0.85 misses every bucket with probability (1 - 0.85^8)^40, about 3e-6.

Defined cases: a null, empty or wordless text has an empty set and links with nothing; fewer words than a shingle are
one shingle. Rows that share a doc_id count as one document (linked). A row without a doc_id stands alone: component
null, kept. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidewater.llm.common import WorkTables, own_columns, table

BANDS, ROWS, BLOCK = 40, 8, 64
#: Numbers in the table that orders shingles from rare to frequent.
SLOTS = 1 << 20
MIX_A, MIX_B = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = (x ^ (x >> np.uint64(33))) * MIX_A
    x = (x ^ (x >> np.uint64(33))) * MIX_B
    return x ^ (x >> np.uint64(33))


def shingle_set(text: bytes | None, size: int) -> np.ndarray:
    """Sorted distinct hashes of a text's shingles of ``size`` words (bytes other than [\\x20\\x09-\\x0D], A-Z lowered)."""
    import xxhash

    words = (text or b"").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    width = min(size, len(words))
    total = np.full(len(words) - width + 1, width, np.uint64)
    for i in range(width):
        total = mix(total + hashes[i : len(words) - width + 1 + i])
    return np.unique(total)


def superminhash(sets: list[np.ndarray], slots: int) -> np.ndarray:
    """The SuperMinHash signature of each set, (sets, slots) of uint32: step * 2^23 + 23 random bits.

    Every element deals the steps 0, 1, 2, ... to the slots in its own order (a permutation drawn from its hash), and a
    slot keeps its least (step, random) value. All elements of all sets take a step together; a set stops as soon as
    the largest value in its signature is below the next step, since no later step can change it.
    ``slots`` is a power of two times an odd number; the order is start + step * stride, with a stride prime to it.
    """
    out = np.full((len(sets), slots), np.uint32(0xFFFFFFFF))
    if not sets:
        return out
    sizes = np.array([len(s) for s in sets])
    owner, element = np.repeat(np.arange(len(sets)), sizes), np.concatenate(sets)
    strides = np.array([k for k in range(1, slots) if np.gcd(k, slots) == 1], np.int64)
    seed = mix(element + np.uint64(0x9E3779B97F4A7C15))
    start, stride = (seed % np.uint64(slots)).astype(np.int64), strides[((seed >> np.uint64(32)) % np.uint64(len(strides))).astype(np.int64)]
    flat = out.reshape(-1)
    for step in range(slots):
        random = (mix(element * np.uint64(2 * step + 3) + np.uint64(step)) >> np.uint64(41)).astype(np.uint32)
        np.minimum.at(flat, owner * slots + (start + step * stride) % slots, np.uint32(step << 23) | random)
        going = out.max(axis=1)[owner] >= np.uint32((step + 1) << 23)
        if not going.any():
            break
        if not going.all():
            owner, element, start, stride = (x[going] for x in (owner, element, start, stride))
    return out


def band_keys(signatures: np.ndarray, bands: int, rows: int) -> np.ndarray:
    parts, keys = signatures.reshape(len(signatures), bands, rows).astype(np.uint64), np.arange(1, bands + 1, dtype=np.uint64)[None, :]
    for i in range(rows):
        keys = mix(keys * np.uint64(31) + parts[:, :, i])
    return keys.view(np.int64)


def _signed(size: int, bands: int, rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 128):
                batch = whole.slice(at, 128)
                sets = [shingle_set(t, size) for t in batch.column(1).cast(pa.binary()).to_pylist()]
                full = np.flatnonzero([len(s) > 0 for s in sets])
                keys = band_keys(superminhash([sets[i] for i in full], bands * rows), bands, rows)
                lists: list = [None] * len(sets)
                for i, own in zip(full, keys, strict=True):
                    lists[i] = own
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets], pa.binary()), pa.array(lists, pa.list_(pa.int64()))],
                    ["doc_id", "n_shingles", "set_key", "bands"],
                )

    return run


def _sets(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [shingle_set(t, size).tobytes() for t in batch.column(1).cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(made, pa.binary())], ["node", "elements"])

    return run


def linked(one: np.ndarray, two: np.ndarray, percent: int) -> bool:
    if min(len(one), len(two)) * 100 < percent * max(len(one), len(two)):
        return False
    both = len(np.intersect1d(one, two, assume_unique=True))
    return both > 0 and 100 * both >= percent * (len(one) + len(two) - both)


def _verify(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [[np.frombuffer(x, np.uint64) for x in batch.column(i).to_pylist()] for i in (2, 3)]
            holds = pa.array([linked(a, b, percent) for a, b in zip(*sets, strict=True)], pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(holds)

    return run


def _slots(tokens: np.ndarray, slots: int) -> np.ndarray:
    return (tokens % np.uint64(slots)).astype(np.int64)


def _slot_counts(slots: int):
    """The shingles of a task's sets by slot: at most ``slots`` rows a task, however many shingles it reads."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(slots, np.int64)
        for batch in batches:
            for elements in batch.column(0).to_pylist():
                np.add.at(seen, _slots(np.frombuffer(elements, np.uint64), slots), 1)
        full = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(full, pa.int64()), pa.array(seen[full], pa.int64())], ["slot", "seen"])

    return run


def _prefixes(percent: int, order):
    """The first n - ceil(t n) + 1 shingles of each set, rare slots first, without those that no other set can have."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["token", "node", "n", "component", "rank"]
        for batch in batches:
            found: list[list[np.ndarray]] = []
            for node, n, component, elements in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                tokens = np.frombuffer(elements, np.uint64)
                if len(tokens) != n:  # another text of the same doc_id
                    continue
                seen = order.value[_slots(tokens, len(order.value))]
                first = np.lexsort((tokens, seen))[: n - (percent * n + 99) // 100 + 1]
                rank = np.flatnonzero(seen[first] > 1)
                own = np.full(len(rank), 1, np.int64)
                found.append([tokens[first[rank]].view(np.int64), own * node, own * n, own * component, rank + 1])
            columns = [np.concatenate(c) for c in zip(*found, strict=True)] if found else [np.zeros(0, np.int64)] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names)

    return run


def prefix_pairs(nodes: DataFrame, sets: DataFrame, percent: int, slots: int = SLOTS, work: WorkTables | None = None) -> DataFrame:
    """(a, b): the pairs of ``nodes`` (node, n, component) of two components that can reach ``percent``; exact.

    Each set's shingles are ordered from rare to frequent. Of a pair that links, the larger set's first
    n - ceil(t n) + 1 shingles and the smaller set's first n - ceil(2t / (1 + t) n) + 1 must have one in common, so a
    passage that many documents share, being frequent, brings no pair about by itself. Any order that all sets share
    makes the join exact; this one counts shingles by hash in a table of ``slots`` numbers, so only prefixes are
    shuffled, and what is broadcast has that fixed size (4 bytes a slot).
    """
    spark, work = nodes.sparkSession, work or WorkTables(nodes.sparkSession)
    # One row for each node and text: their shingles are read twice.
    own = work.put(nodes.join(sets, "node").select("node", "n", "component", "elements"), "own")
    counts = own.select("elements").mapInArrow(_slot_counts(slots), "slot long, seen long").groupBy("slot").agg(F.sum("seen").alias("seen")).toArrow()
    order = np.zeros(slots, np.uint32)
    order[counts["slot"].to_numpy()] = np.minimum(counts["seen"].to_numpy(), 2**32 - 1)
    ranked = own.mapInArrow(_prefixes(percent, spark.sparkContext.broadcast(order)), "token long, node long, n long, component long, rank long")
    ranked = work.put(ranked, "prefixes")
    probe = ranked.withColumnRenamed("node", "a")
    index = ranked.filter(f"rank <= n - ({2 * percent} * n + {99 + percent}) div {100 + percent} + 1")
    index = index.select("token", F.col("node").alias("b"), F.col("n").alias("m"), F.col("component").alias("other"), F.col("rank").alias("place"))
    # At the first common shingle nothing has matched yet, so what follows it bounds the overlap.
    reach = f"(1 + least(n - rank, m - place)) * {100 + percent} >= {percent} * (n + m)"
    pairs = probe.join(index, "token").filter(f"(m < n OR (m = n AND b < a)) AND component <> other AND m * 100 >= {percent} * n AND {reach}")
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def components(links: DataFrame, work: WorkTables) -> DataFrame:
    """(node, component): the least node that each linked node reaches. Only one row count a round reaches the driver.

    Each round hooks every node to its least neighbour, jumps once to that one's own, and contracts the links to what
    is left. Two neighbours can't both keep their names, so at most half of the linked nodes stay each round.
    """
    ordered = lambda a, b: [F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]
    edges, roots = work.put(links.select(*ordered("a", "b")).distinct(), "edges"), None
    while edges.limit(1).count():
        near = edges.select(F.col("a").alias("node"), F.col("b").alias("near")).union(edges.select("b", "a"))
        hooked = work.put(near.groupBy("node").agg(F.min("near").alias("near")).select("node", F.least("node", "near").alias("up")), "hooked")
        jumped = work.put(hooked.join(hooked.select(F.col("node").alias("up"), F.col("up").alias("component")), "up").select("node", "component"), "jumped")
        roots = work.put(jumped if roots is None else relabelled(roots, jumped), "roots")
        names = [jumped.select(F.col("node").alias(x), F.col("component").alias(y)) for x, y in (("a", "c"), ("b", "d"))]
        edges = work.put(edges.join(names[0], "a").join(names[1], "b").filter("c <> d").select(*ordered("c", "d")).distinct(), "edges")
    return links.sparkSession.createDataFrame([], "node long, component long") if roots is None else roots


def relabelled(labels: DataFrame, names: DataFrame) -> DataFrame:
    """``labels`` with every component that ``names`` (node, component) renames, and the nodes that only ``names`` has."""
    new = names.select(F.col("node").alias("component"), F.col("component").alias("new"))
    old = labels.join(new, "component", "left").select("node", F.coalesce("new", "component").alias("component"))
    return old.union(names.join(labels, "node", "left_anti").select("node", "component"))


def between(pairs: DataFrame, labels: DataFrame, confirmed: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """(a, b): links between two components of ``labels``, from the confirmed of the given node pairs."""
    side = lambda x, y: labels.select(F.col("node").alias(x), F.col("component").alias(y))
    named = lambda p: p.join(side("a", "c"), "a", "left").join(side("b", "d"), "b", "left").select("a", "b", F.coalesce("c", "a").alias("c"), F.coalesce("d", "b").alias("d"))
    found = confirmed(named(pairs).filter("c <> d").select("a", "b"))
    return named(found).select(F.col("c").alias("a"), F.col("d").alias("b"))


def near_duplicates(docs: DataFrame, size: int = 5, percent: int = 80, bands: int = BANDS, rows: int = ROWS, block: int = BLOCK) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of each document row; links need Jaccard >= percent / 100."""
    work = WorkTables(docs.sparkSession)
    texts = own_columns(docs, "doc_id", "text")
    signed = work.put(texts.mapInArrow(_signed(size, bands, rows), "doc_id long, n_shingles long, set_key binary, bands array<long>"), "signed")
    named = signed.filter("set_key IS NOT NULL AND doc_id IS NOT NULL")
    nodes = named.groupBy("set_key").agg(F.min("doc_id").alias("node"), F.first("n_shingles").alias("n"), F.first("bands").alias("bands"))
    nodes = work.put(nodes, "nodes")
    seats = nodes.select(F.explode("bands").alias("key"), "node", "n")
    buckets = seats.groupBy("key").agg(F.count(F.lit(1)).alias("seats"), F.min(F.struct("node", "n")).alias("first")).filter("seats > 1")
    buckets = work.put(buckets, "buckets")
    met = seats.join(buckets, "key")
    met = work.put(met, "met")
    fits = lambda a, b: F.least(a, b) * 100 >= percent * F.greatest(a, b)
    star = met.filter((F.col("node") != F.col("first.node")) & fits(F.col("n"), F.col("first.n"))).select(F.col("first.node").alias("a"), F.col("node").alias("b")).distinct()
    star = work.put(star, "star")
    # Larger mixed buckets may still compare any of their nodes, so all that met with a chance to link get their sets.
    wanted = met.filter("seats > 2").select("node").union(star.select("a")).union(star.select("b")).distinct()
    sets = work.put(texts.withColumnRenamed("doc_id", "node").join(wanted, "node", "left_semi").mapInArrow(_sets(size), "node long, elements binary"), "sets")

    def confirmed(pairs: DataFrame) -> DataFrame:
        one, two = sets.select(F.col("node").alias("a"), F.col("elements").alias("x")), sets.select(F.col("node").alias("b"), F.col("elements").alias("y"))
        return pairs.join(one, "a").join(two, "b").select("a", "b", "x", "y").mapInArrow(_verify(percent), "a long, b long")

    # One pair a node first; of the others only those that still lie between components.
    tried = work.put(star.groupBy("b").agg(F.min("a").alias("a")).select("a", "b"), "tried")
    labels = components(confirmed(tried), work)
    # A class of equal sets is one node, but rows that share a doc_id with different texts are one document too.
    labels = work.put(relabelled(labels, components(between(star.join(tried, ["a", "b"], "left_anti"), labels, confirmed), work)), "labels")
    label = F.coalesce("component", "node").alias("component")
    open_ = met.filter("seats > 2").join(labels, "node", "left").select("key", "node", "n", "seats", label)
    mixed = open_.groupBy("key").agg(F.min("component").alias("p"), F.max("component").alias("q")).filter("p <> q").select("key")
    open_ = work.put(open_.join(mixed, "key"), "open")
    few = open_.filter(F.col("seats") <= block)
    other = few.select("key", F.col("node").alias("b"), F.col("n").alias("m"), F.col("component").alias("q"))
    pairs = few.withColumnRenamed("node", "a").join(other, "key").filter((F.col("a") < F.col("b")) & (F.col("component") != F.col("q")) & fits(F.col("n"), F.col("m")))
    pairs = pairs.select("a", "b").distinct().join(star, ["a", "b"], "left_anti")
    many = open_.filter(F.col("seats") > block).select("node", "n", "component").distinct()
    rare = prefix_pairs(many, sets, percent, work=work).join(star, ["a", "b"], "left_anti")
    labels = relabelled(labels, components(between(pairs.union(rare).distinct(), labels, confirmed), work))
    named = nodes.join(labels, "node", "left").select("set_key", label)
    out = signed.join(named, "set_key", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(component == F.col("doc_id"), F.lit(True)).alias("kept"))


def op9_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), size=3, percent=85)
