"""Threshold-scaled document sketches, in DataFrame functions only.

A sketch keeps every shingle hash below a fixed fraction of the hash space, whatever the text's length, so the sketches of
any two texts, however unequal, are comparable and merge by union. Likeness and containment are shares of the kept hashes.
The fraction is one in ``SHARE``; texts of a few shingles have few hashes or none, and their likeness is as coarse.

``with_next`` finds each row's successor with one shuffle of the texts: Spark's range partitioner cuts the sorted pairs
(doc_id, hash of the text) into as many parts as the session has shuffle partitions, so that neither equal ids nor rows
without an id gather in one part; only the parts' first keys come to the driver. Rows are windowed by part, and the last
row of a part gets the first row of the next one, of which there are no more than parts.

Defined cases: a null text is empty; an empty or wordless text has an empty sketch (fingerprint ""), like a short text none
of whose hashes is kept; empty sketches are alike to each other (1.0) and to nothing else (0.0); fewer words than a shingle
are one shingle. Rows that share a doc_id follow each other by the hash of their texts; rows without a doc_id come first.
A lone row is its own successor. Extra columns are ignored.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidewater.llm.common import WorkTables, lower_ascii, own_columns, table, text_or_empty

SIZE, SHARE = 5, 4


def bound(share: int) -> int:
    """The hashes below this number are one in ``share`` of all signed 64-bit numbers."""
    return -(2**63) + 2**64 // share


def sketch(text: Column, size: int = SIZE, share: int = SHARE) -> Column:
    """The sorted kept hashes of a text's word shingles."""
    words = F.array_remove(F.split(lower_ascii(text), r"[\x20\x09-\x0D]+"), "")
    shingle = lambda w: lambda i: F.xxhash64(*[F.get(w, i + j) for j in range(size)])
    hashes = lambda w: F.when(F.size(w) >= size, F.transform(F.sequence(F.lit(0), F.greatest(F.size(w) - size, F.lit(0))), shingle(w))).when(
        F.size(w) > 0, F.array(F.xxhash64(F.array_join(w, " ")))
    ).otherwise(F.array().cast("array<bigint>"))
    return F.array_sort(F.array_distinct(F.filter(once(words, hashes), lambda x: x < F.lit(bound(share)))))


def merge(one: Column, two: Column) -> Column:
    """The sketch of the union of two shingle sets, from their sketches."""
    return F.array_sort(F.array_union(one, two))


def once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value bound to a name through a one-element array, so that it is evaluated once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def likeness(one: Column, two: Column) -> Column:
    """Estimated Jaccard likeness of two sketched sets, 0 to 1."""
    both = F.size(F.array_intersect(one, two))
    ratio = once(both, lambda n: n / F.nullif(F.size(one) + F.size(two) - n, F.lit(0)))
    return F.when((F.size(one) == 0) & (F.size(two) == 0), F.lit(1.0)).otherwise(ratio)


def containment(one: Column, two: Column) -> Column:
    """Estimated share of the first set's shingles that the second has, 0 to 1; 1 for an empty first set."""
    return F.when(F.size(one) == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(one, two)) / F.size(one))


def fingerprint(kept: Column) -> Column:
    return F.lower(F.array_join(F.transform(kept, lambda x: F.lpad(F.hex(x), 16, "0")), ""))


def part_of(keys: DataFrame, parts: int) -> Column:
    """The number of a row's part by its (doc_id, h), rising with them; from the first keys of at most ``parts`` ranges.

    The ranges are those of Spark's range partitioner over the slim ``keys``. A row's part is looked up in two steps, in
    every k-th first key and then in the k keys from there.
    """
    cut = keys.repartitionByRange(parts, F.col("doc_id").asc_nulls_first(), "h")
    first = cut.groupBy(F.spark_partition_id().alias("p")).agg(F.min_by(F.struct("doc_id", "h"), F.struct(F.col("doc_id").isNotNull(), F.coalesce("doc_id", F.lit(0)), "h")).alias("k"))
    bounds = [{"d": r.k.doc_id, "h": r.k.h} for r in first.orderBy("p").collect()]
    step = max(1, int(len(bounds) ** 0.5))
    held = lambda some: F.from_json(F.lit(json.dumps(some)), "array<struct<d:bigint,h:bigint>>")
    below = lambda some: F.size(F.filter(some, lambda b: _not_after(b["d"], b["h"], F.col("doc_id"), F.col("h"))))
    coarse = F.greatest(below(held(bounds[::step])), F.lit(1))
    return once(coarse, lambda c: (c - 1) * step + below(F.slice(held(bounds), (c - 1) * step + 1, step)))


def _not_after(d: Column, h: Column, doc_id: Column, own: Column) -> Column:
    """(d, h) <= (doc_id, own), a null id before all others."""
    return F.when(d.isNull(), doc_id.isNotNull() | (h <= own)).otherwise(F.coalesce((d < doc_id) | ((d == doc_id) & (h <= own)), F.lit(False)))


def with_next(rows: DataFrame, result: Callable[[Column], list[Column]], work: WorkTables, parts: int | None = None) -> DataFrame:
    """``result(next text)`` of each row of (doc_id, text); the last row's next text is the first one's."""
    keyed = rows.withColumn("h", F.xxhash64("text"))
    parts = parts or int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keyed = keyed.withColumn("part", part_of(keyed.select("doc_id", "h"), parts))
    order = Window.partitionBy("part").orderBy(F.col("doc_id").asc_nulls_first(), "h", "text")
    linked = keyed.withColumn("next", F.lead("text").over(order)).withColumn("is_first", F.lag(F.lit(1)).over(order).isNull())
    # Rows with a successor in their part are done in the same stage; of a part's first and last row the text stays too.
    edge = F.col("is_first") | F.col("next").isNull()
    names = [f"c{i}" for i in range(len(result(F.col("next"))))]
    done = [F.when(F.col("next").isNotNull(), c).alias(name) for name, c in zip(names, result(F.col("next")), strict=True)]
    held = work.put(linked.select("part", "is_first", F.col("next").isNull().alias("is_last"), "doc_id", F.when(edge, F.col("text")).alias("text"), *done), "linked", compression="zstd")
    heads = held.filter("is_first").select(F.col("part").alias("after"), F.col("text").alias("next"))
    along = Window.orderBy("part")  # one row a part
    following = heads.select(F.col("after").alias("part")).withColumn("next_part", F.lead("part").over(along)).withColumn("least", F.min("part").over(Window.partitionBy()))
    following = following.select("part", F.coalesce("next_part", "least").alias("after"))
    tails = held.filter("is_last").select("part", "doc_id", "text").join(following, "part").join(heads, "after")
    out = [c.alias(name) for name, c in zip(names, result(F.col("next")), strict=True)]
    return held.filter("NOT is_last").select("doc_id", *names).union(tails.select("doc_id", *out))


def op6_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints(table(spark, sf_dir, "documents"))


def fingerprints(docs: DataFrame, parts: int | None = None) -> DataFrame:
    """Each row's fingerprint, that of its text with the second half exchanged for the start of the next, and likenesses."""
    rows = own_columns(docs, "doc_id", "text").select("doc_id", text_or_empty().alias("text"))

    def result(after: Column) -> list[Column]:
        n_chars = F.length("text")
        half = F.floor(n_chars / 2).cast("int")
        edited = F.concat(F.substring("text", F.lit(1), n_chars - half), F.substring(after, F.lit(1), half))
        values = F.struct(sketch(F.col("text")).alias("own"), sketch(edited).alias("edited"), sketch(after).alias("after"))
        compared = once(values, lambda k: F.struct(
            fingerprint(k["own"]).alias("f"), fingerprint(k["edited"]).alias("e"), likeness(k["own"], k["edited"]).alias("ne"), likeness(k["own"], k["after"]).alias("nn"),
        ))
        return [n_chars.cast("long"), F.sha2(edited.cast("binary"), 256), compared]

    found = with_next(rows, result, WorkTables(docs.sparkSession, clean=True), parts)
    return found.select(
        "doc_id", F.col("c0").alias("n_chars"), F.col("c1").alias("edited_sha256"), F.col("c2.f").alias("fingerprint"), F.col("c2.e").alias("edited_fingerprint"), F.col("c2.ne").alias("near_edited"), F.col("c2.nn").alias("near_next"),
    )
