"""The target as a base and deltas: a batch writes its own rows only, readers keep the latest row of each key.

``<path>/base-<n>`` is a Parquet folder partitioned into ``bucket=<b>``
folders, one row per key, that holds all batches up to number n (and, of
error rows, the merge key).
``<path>/delta-<n>-<tag>`` holds the rows of batch number n, in as few files
as their size asks for, with the merge key, the bucket and n. The tag names
job and batch.

* A batch is written to ``<path>/_writing`` (which also cuts its lineage),
  checked there and moved to its name by one rename. What it writes does not
  depend on the target's size, and no folder that readers see is ever changed.
* A reader takes the newest base and the deltas after it: the base's rows
  whose keys no delta has, and each other key's latest row. The base is not
  shuffled while the deltas' keys are small enough for Spark to broadcast.
* ``compact`` writes that result as a new base, again moved by one rename,
  and removes what is older than the base before it, so readers that planned
  on the last base can finish.

A crash leaves either the state before or the state after a rename. Leftovers
in ``_writing`` and folders that a base has replaced are removed by the next
writer. A replayed batch is known by its tag, from its delta or, once
compacted, from ``<path>/_applied/<job>=<batch>`` (the last batch folded for
each job), and is not added again. One writer at a time may work on a target;
the rename must be atomic, as on HDFS and local disks. On a store where it
copies, a reader can meet a folder that is not whole yet.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType
from pyspark.sql.window import Window

from tidewater.config import TargetConfig
from tidewater.functions.keys import merge_key
from tidewater.operators.files import child_names, folder_bytes, make_folder, path_exists, publish, remove_path

TS, MK, BUCKET, SEQ, LIMIT = "approx_creation_timestamp_millis", "_mk", "bucket", "_seq", "_limit"
LAYOUT_MARK = "_tidewater_deltas"
WRITING, APPLIED = "_writing", "_applied"


def check_layout(spark: SparkSession, target: TargetConfig, fresh: bool) -> None:
    """Marks a new target as one of deltas; refuses to read or write a target in the other layout."""
    mark = f"{target.path}/{LAYOUT_MARK}"
    if target.layout == "deltas" and fresh:
        make_folder(spark, mark)
    elif not fresh and path_exists(spark, mark) != (target.layout == "deltas"):
        raise ValueError(f"target {target.path} was not made with layout {target.layout!r}")


def _tag(text: str) -> str:
    return hashlib.sha1(text.encode("utf-8")).hexdigest()[:16]


def _names(spark: SparkSession, target: TargetConfig) -> tuple[list[int], list[tuple[int, str, str]]]:
    """(numbers of the bases, (number, job and batch tag, folder name) of the deltas), both rising."""
    names = child_names(spark, target.path)
    bases = sorted(int(n.removeprefix("base-")) for n in names if n.startswith("base-"))
    found = [n.split("-", 2) + [n] for n in names if n.startswith("delta-")]
    return bases, sorted((int(number), tag, name) for _, number, tag, name in found)


def _open_deltas(spark: SparkSession, target: TargetConfig) -> tuple[int | None, list[tuple[int, str, str]]]:
    bases, deltas = _names(spark, target)
    base = bases[-1] if bases else None
    return base, [d for d in deltas if base is None or d[0] > base]


def _remove_replaced(spark: SparkSession, target: TargetConfig) -> None:
    """Removes unfinished folders, bases older than the last but one, and deltas that the last but one holds."""
    remove_path(spark, f"{target.path}/{WRITING}")
    bases, deltas = _names(spark, target)
    for number in bases[:-2]:
        remove_path(spark, f"{target.path}/base-{number:012d}")
    for number, _, name in deltas:
        if len(bases) > 1 and number <= bases[-2]:
            remove_path(spark, f"{target.path}/{name}")


def append(
    spark: SparkSession,
    rows: DataFrame,
    target: TargetConfig,
    run_key: str,
    batch_id: str,
    finish: Callable[[DataFrame], DataFrame | None] = lambda df: None,
    check: Callable[[DataFrame], None] | None = None,
) -> None:
    """Adds a batch (target columns, merge key, bucket) as one delta, unless it was added before.

    ``finish`` may return other rows for the written batch, ``check`` may reject it; the target is unchanged then. An
    empty batch adds nothing.
    """
    _remove_replaced(spark, target)
    tag = f"{_tag(run_key)}.{_tag(batch_id)}"
    bases, deltas = _names(spark, target)
    if any(tag == other for _, other, _ in deltas) or f"{_tag(run_key)}={_tag(batch_id)}" in child_names(spark, f"{target.path}/{APPLIED}"):
        return
    number = max([0, *bases[-1:], *(n for n, _, _ in deltas[-1:])]) + 1
    rows = rows.withColumn(SEQ, F.lit(number).cast("long"))
    written = f"{target.path}/{WRITING}/rows"
    rows.hint("rebalance").write.mode("overwrite").parquet(written)
    staged = spark.read.schema(rows.schema).parquet(written)
    finished = finish(staged.drop(SEQ))
    if finished is not None:
        written = f"{target.path}/{WRITING}/finished"
        finished.withColumn(SEQ, F.lit(number).cast("long")).select(*rows.columns).write.mode("overwrite").parquet(written)
        staged = spark.read.schema(rows.schema).parquet(written)
    if staged.isEmpty():
        remove_path(spark, f"{target.path}/{WRITING}")
        return
    if check is not None:
        check(staged)
    publish(spark, written, f"{target.path}/delta-{number:012d}-{tag}")
    remove_path(spark, f"{target.path}/{WRITING}")
    if target.compact_ratio is not None and needs_compaction(spark, target):
        compact(spark, target)


def needs_compaction(spark: SparkSession, target: TargetConfig) -> bool:
    """The open deltas hold at least ``compact_ratio`` of the base's bytes (file sizes, no job)."""
    base, deltas = _open_deltas(spark, target)
    if base is None:
        return bool(deltas)
    held = sum(folder_bytes(spark, f"{target.path}/{name}") for _, _, name in deltas)
    return held >= target.compact_ratio * folder_bytes(spark, f"{target.path}/base-{base:012d}")


def newest(deltas: DataFrame, order_guard: bool) -> DataFrame:
    """Each key's row after all deltas in turn, with ``LIMIT``: base rows above that timestamp are newer (NULL: none is).

    Without the guard the last batch wins. With it, a row stays while the batches after it are older; a row without a
    timestamp always replaces and is always replaced, so only the rows after the last such row compete. Rows of one
    batch that share a key (a lookup's fan-out) stay together.
    """
    key = Window.partitionBy(BUCKET, MK)
    if not order_guard:
        ranked = deltas.withColumn(LIMIT, F.lit(None).cast("long")).withColumn("_rank", F.rank().over(key.orderBy(F.desc(SEQ))))
    else:
        reset = F.max(F.when(F.col(TS).isNull(), F.col(SEQ))).over(key)
        timed = deltas.withColumn("_reset", reset).withColumn(LIMIT, F.when(F.col("_reset").isNull(), F.max(TS).over(key)))
        turn = F.when(F.col("_reset").isNull() | (F.col(SEQ) > F.col("_reset")), 0).when(F.col(SEQ) == F.col("_reset"), 1).otherwise(2)
        ranked = timed.withColumn("_rank", F.rank().over(key.orderBy(turn, F.desc(TS), F.desc(SEQ)))).drop("_reset")
    return ranked.filter("_rank = 1").drop("_rank", SEQ)


def merge(base: DataFrame, fresh: DataFrame, order_guard: bool) -> DataFrame:
    """The base's rows that stay and the fresh rows that are not older than the base's row of their key."""
    base = base.withColumn(MK, F.coalesce("keys", MK))
    keys = fresh.select(F.col(BUCKET).alias("_b"), F.col(MK).alias("_k"), F.col(LIMIT).alias("_l"))
    same = (base[BUCKET] == keys["_b"]) & (base[MK] == keys["_k"])
    if not order_guard:
        return base.join(keys, same, "left_anti").unionByName(fresh.drop(LIMIT))
    kept = base.join(keys, same & (keys["_l"].isNull() | base[TS].isNull() | (keys["_l"] >= base[TS])), "left_anti")
    # Only keyed rows have a timestamp, so this side reads bucket, keys and timestamp, not the raw text.
    stored = base.filter(F.col("keys").isNotNull() & F.col(TS).isNotNull()).select(F.col(BUCKET).alias("_b"), F.col("keys").alias("_k"), F.col(TS).alias("_t"))
    older = (fresh[BUCKET] == stored["_b"]) & (fresh[MK] == stored["_k"]) & (stored["_t"] > fresh[LIMIT])
    return kept.unionByName(fresh.join(stored, older, "left_anti").drop(LIMIT))


def read_merged(spark: SparkSession, target: TargetConfig, schema: StructType) -> DataFrame:
    """The target's rows in ``schema`` (target columns and bucket), as of now."""
    number, deltas = _open_deltas(spark, target)
    with_key = StructType([*schema.fields, StructField(MK, StringType())])
    base = None if number is None else spark.read.schema(with_key).parquet(f"{target.path}/base-{number:012d}")
    columns = [f.name for f in schema.fields]
    if not deltas:
        return spark.createDataFrame([], schema) if base is None else base.select(*columns)
    held = StructType([f for f in schema.fields if f.name != BUCKET] + [StructField(MK, StringType()), schema[BUCKET], StructField(SEQ, LongType())])
    fresh = newest(spark.read.schema(held).parquet(*[f"{target.path}/{name}" for _, _, name in deltas]), target.order_guard)
    return (fresh if base is None else merge(base, fresh, target.order_guard)).select(*columns)


def compact(spark: SparkSession, target: TargetConfig) -> bool:
    """Folds the open deltas into a new base; False where there are none."""
    from tidewater.operators.upsert import stored_schema  # the upsert imports this module

    check_layout(spark, target, False)
    _remove_replaced(spark, target)
    _, deltas = _open_deltas(spark, target)
    if not deltas:
        return False
    for _, tag, _ in deltas:  # the last batch of each job stays known
        job, batch = tag.split(".")
        for other in child_names(spark, f"{target.path}/{APPLIED}"):
            if other.startswith(f"{job}=") and other != f"{job}={batch}":
                remove_path(spark, f"{target.path}/{APPLIED}/{other}")
        make_folder(spark, f"{target.path}/{APPLIED}/{job}={batch}")
    written = f"{target.path}/{WRITING}/base"
    rows = read_merged(spark, target, stored_schema(target.with_lookup))
    # The merge key of error rows is stored, so that a read of a few columns needs no raw text to find it.
    rows = rows.withColumn(MK, F.when(F.col("keys").isNull(), merge_key()))
    rows.hint("rebalance", BUCKET).write.mode("overwrite").partitionBy(BUCKET).parquet(written)
    publish(spark, written, f"{target.path}/base-{deltas[-1][0]:012d}")
    _remove_replaced(spark, target)
    return True
