"""Upsert a batch of latest rows into the target table.

The target is a Parquet folder partitioned into ``bucket=<b>`` folders,
``b = pmod(xxhash64(merge key), buckets)``. A batch

1. is written once to a staging folder (the staging table of the original
   job; it also cuts the lineage, so the steps below never re-read the
   source and survive lost executors),
2. names the buckets it touches (at most ``buckets`` small integers),
3. reads only those buckets of the target, drops the rows it replaces
   (left anti join on bucket + key: one shuffle of the touched data) and
   adds its own rows,
4. writes that result to a merge folder and from there overwrites just the
   touched buckets (dynamic partition overwrite).

Replaying a batch gives the same table: the merge key of a keyed row is its
``keys``; an error row (no keys) is keyed by a hash of its event id and raw
text, so a replay replaces it instead of adding it twice. If a crash hits
step 4, the next upsert of the target, whichever batch or job it belongs to,
finds the finished merge folder and repeats that overwrite before it reads
the target. So no later writer works on half-written buckets, and a batch
retried after another writer merges its rows anew instead of putting back
buckets from before. One writer at a time may work on a target. Step 3 never
reads a folder that step 4 writes.

Without the order guard the last batch wins (the original MERGE has no
timestamp condition). With it, a stored row newer than the incoming one
stays.

A batch that takes its lookup columns here (``lookup``) is staged without
them, and a first load looks its rows up on their way into the target: the
records, far larger than the rows that name them, are neither staged nor
shuffled with the rows.

``TargetConfig.layout="deltas"`` writes only the batch's own rows and merges
them at read (``operators/deltas.py``).
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable
from contextlib import nullcontext

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from tidewater.config import TargetConfig
from tidewater.functions.keys import bucket_of, merge_key
from tidewater.functions.record import is_too_deep
from tidewater.operators import deltas
from tidewater.operators.files import child_names, folder_bytes, make_folder, path_exists, publish, remove_path
from tidewater.schemas import LOOKUP_FIELDS, target_schema
from tidewater.session import checkpoint_dir, conf_held, shuffles_dropped

TS = "approx_creation_timestamp_millis"
MK = "_mk"
BUCKET = "bucket"
LAYOUT_PREFIX = "_tidewater_buckets="
# Staging bucket of rows waiting for the deep-value repair.
REPAIR_BUCKET = -1
# Folder of a first load's buckets until all are written (readers pass over its name).
LOADING = "_tidewater_load"
# Lookup records are long texts, which zstd holds in about half of the default codec's bytes.
RECORD_CODEC = {"spark.sql.parquet.compression.codec": "zstd"}
# Staged bytes that are looked up at once, and to a partition of their join.
PASS_BYTES, PIECE_BYTES = 256 << 20, 16 << 20


def stored_schema(with_lookup: bool) -> StructType:
    return StructType(target_schema(with_lookup).fields + [StructField(BUCKET, IntegerType(), False)])


def written_buckets(spark: SparkSession, path: str) -> list[int]:
    """Bucket ids of a folder written partitioned by bucket (from its folder names).

    At most ``buckets`` names, read from the file system listing; no job runs.
    """
    prefix = f"{BUCKET}="
    return sorted(int(n[len(prefix):]) for n in child_names(spark, path) if n.startswith(prefix))


def stored_buckets(spark: SparkSession, path: str) -> int | None:
    """The bucket count recorded in the target folder, if it has been created."""
    for name in child_names(spark, path):
        if name.startswith(LAYOUT_PREFIX):
            return int(name[len(LAYOUT_PREFIX):])
    return None


def _work_root(spark: SparkSession, target: TargetConfig) -> str:
    tag = hashlib.sha1((target.path or "").encode("utf-8")).hexdigest()[:16]
    return f"{checkpoint_dir(spark)}/tidewater-upsert/{tag}"


def read_target(spark: SparkSession, target: TargetConfig) -> DataFrame:
    """The stored target (with its ``bucket`` column); empty if not created yet."""
    schema = stored_schema(target.with_lookup)
    if stored_buckets(spark, target.path) is None:
        return spark.createDataFrame([], schema)
    deltas.check_layout(spark, target, False)
    if target.layout == "deltas":
        return deltas.read_merged(spark, target, schema)
    return spark.read.schema(schema).parquet(target.path)


def _check_layout(spark: SparkSession, target: TargetConfig) -> None:
    """Record bucket count and layout on first use (marker folders, which readers
    ignore because of their leading underscore); refuse others later."""
    deltas.check_layout(spark, target, stored_buckets(spark, target.path) is None)
    stored = stored_buckets(spark, target.path)
    if stored is None:
        make_folder(spark, f"{target.path}/{LAYOUT_PREFIX}{target.buckets}")
    elif stored != target.buckets:
        raise ValueError(f"target {target.path} has {stored} buckets, not {target.buckets}")


def check_unique_keys(staged: DataFrame) -> None:
    """Fail when a batch holds two rows for one key (they would both be inserted)."""
    dup = staged.filter(F.col("keys").isNotNull()).groupBy("keys").count().filter(F.col("count") > 1).limit(1).collect()
    if dup:
        raise ValueError(f"batch holds several rows for keys {dup[0]['keys']}; deduplicate first or pack lookups")


def _merge_rows(old: DataFrame, staged: DataFrame, order_guard: bool, lookup: Callable[[DataFrame], DataFrame]) -> DataFrame:
    if not order_guard:
        kept = old.join(staged.select(BUCKET, MK), [BUCKET, MK], "left_anti")
        return kept.unionByName(lookup(staged))
    inc = staged.select(F.col(BUCKET).alias("_b"), F.col(MK).alias("_k"), F.col(TS).alias("_ts"))
    kept = old.join(
        inc,
        (old[BUCKET] == inc["_b"])
        & (old[MK] == inc["_k"])
        & (inc["_ts"].isNull() | old[TS].isNull() | (inc["_ts"] >= old[TS])),
        "left_anti",
    )
    # Only keyed rows can be newer than an incoming row (error rows carry no
    # timestamp), so this side reads bucket, keys and timestamp, not the raw text.
    cur = old.filter(F.col("keys").isNotNull()).select(
        F.col(BUCKET).alias("_b"), F.col("keys").alias("_k"), F.col(TS).alias("_ts")
    )
    fresh = staged.join(
        cur,
        (staged[BUCKET] == cur["_b"]) & (staged[MK] == cur["_k"]) & (cur["_ts"] > staged[TS]),
        "left_anti",
    )
    return kept.unionByName(lookup(fresh))


def _write_buckets(df: DataFrame, path: str, mode: str = "overwrite", only_written: bool = False) -> None:
    """Write partitioned by bucket; rebalance lets AQE split a hot bucket into several files.

    ``only_written`` replaces just the buckets being written (the target); its
    rows come from a folder that is split by bucket already, so they are
    copied without another shuffle. Otherwise an overwrite replaces the whole
    folder (staging and merge folders, so a replayed batch never finds
    leftovers of an earlier try).
    """
    (
        (df if only_written else df.hint("rebalance", BUCKET))
        .write.mode(mode)
        .option("partitionOverwriteMode", "dynamic" if only_written else "static")
        .partitionBy(BUCKET)
        .parquet(path)
    )


def _bucket_groups(spark: SparkSession, path: str, buckets: list[int], most: int) -> list[list[int]]:
    """The buckets in groups of at most ``most`` bytes (or of one bucket)."""
    groups, held = [], 0
    for b in buckets:
        size = folder_bytes(spark, f"{path}/{BUCKET}={b}")
        if not groups or held + size > most:
            groups.append([])
            held = 0
        groups[-1].append(b)
        held += size
    return groups


def _load_looked_up(staged: DataFrame, staging: str, touched: list[int], target: TargetConfig, lookup: Callable[[DataFrame], DataFrame], most: int) -> None:
    """First load of staged rows that still need their lookup, some buckets at a time.

    The join's tasks write their rows into the buckets themselves: a shuffle
    by bucket would carry a copy of the record with every row. A group's
    staged rows go once it is written. The target gets all buckets at the
    end, by renames, as from an overwrite.
    """
    spark, loading = staged.sparkSession, f"{target.path}/{LOADING}"
    columns = [f.name for f in target_schema(target.with_lookup).fields]
    initial = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    least = int(spark.conf.get(initial, None) or spark.conf.get("spark.sql.shuffle.partitions"))
    for group in _bucket_groups(spark, staging, touched, most):
        folders = [f"{staging}/{BUCKET}={b}" for b in group]
        pieces = max(least, -(-sum(folder_bytes(spark, f) for f in folders) // PIECE_BYTES))
        with conf_held(spark, {initial: str(pieces)}):
            rows = lookup(spark.read.schema(staged.schema).option("basePath", staging).parquet(*folders))
            # Rows of one record lie together, so that compression sees it once.
            rows = rows.select(*columns, BUCKET).sortWithinPartitions(BUCKET, "s3_uri")
            _write_buckets(rows, loading, mode="append", only_written=True)
        for folder in folders:
            remove_path(spark, folder)
    for b in touched:
        publish(spark, f"{loading}/{BUCKET}={b}", f"{target.path}/{BUCKET}={b}")
    remove_path(spark, loading)


def _overwrite_from(spark: SparkSession, merged: str, target: TargetConfig) -> None:
    rows = spark.read.schema(stored_schema(target.with_lookup)).parquet(merged)
    _write_buckets(rows, target.path, only_written=True)


def _finish_pending(spark: SparkSession, target: TargetConfig) -> list[str]:
    """Repeat the overwrite of every batch that crashed in it; returns their work folders.

    Each upsert does so first, so at most one finished merge folder is there.
    """
    root, done = _work_root(spark, target), []
    for run in child_names(spark, root):
        for batch in child_names(spark, f"{root}/{run}"):
            work = f"{root}/{run}/{batch}"
            if path_exists(spark, f"{work}/merged/_SUCCESS"):
                _overwrite_from(spark, f"{work}/merged", target)
                remove_path(spark, work)
                done.append(work)
    return done


def upsert(
    spark: SparkSession,
    batch: DataFrame,
    target: TargetConfig,
    batch_id: int | str | None = None,
    run_key: str = "default",
    check_unique: bool | None = None,
    repair=None,
    lookup: Callable[[DataFrame], DataFrame] | None = None,
    pass_bytes: int = PASS_BYTES,
) -> None:
    """Merge ``batch`` (target columns, at most one row per key) into the target.

    ``check_unique`` (default: the target's setting) fails the batch when it
    holds two rows for one key; callers whose batch comes straight from
    ``latest_per_key`` can skip that extra pass. ``repair`` (a function of
    a DataFrame) returns the staged batch with the rows decoded that the
    native decoder found nested too deeply; it runs only when there are any.

    ``lookup`` (a function of a DataFrame; not for ``deltas``) adds the
    lookup columns, one row for one, to a batch without them. A first load
    calls it for each ``pass_bytes`` of staged rows; each call reads the
    lookup, so a larger lookup should have larger passes.
    """
    if lookup is not None and target.layout == "deltas":
        raise ValueError("a batch for a target of deltas needs its lookup columns before the upsert")
    codec = RECORD_CODEC if target.with_lookup and target.layout == "buckets" else {}
    with conf_held(spark, codec), nullcontext() if lookup is None else shuffles_dropped(spark):
        _upsert(spark, batch, target, batch_id, run_key, check_unique, repair, lookup, pass_bytes)


def _upsert(spark, batch, target, batch_id, run_key, check_unique, repair, lookup, pass_bytes) -> None:
    check_unique = target.check_unique if check_unique is None else check_unique
    columns = [f.name for f in target_schema(target.with_lookup).fields]
    added = [] if lookup is None else LOOKUP_FIELDS.fieldNames()
    given = [c for c in columns if c not in added]
    batch = batch.select(*given)
    work = f"{_work_root(spark, target)}/{run_key}/batch={batch_id if batch_id is not None else uuid.uuid4().hex}"
    staging, merged = f"{work}/staging", f"{work}/merged"
    _check_layout(spark, target)
    if target.layout == "deltas":
        _append_delta(spark, batch.select(*columns), target, run_key, batch_id, check_unique, repair)
        return
    if work in _finish_pending(spark, target):
        return  # this batch had only its overwrite left
    remove_path(spark, f"{target.path}/{LOADING}")  # of a first load that failed
    bucket = bucket_of(F.col(MK), target.buckets)
    if repair is not None:
        # Rows left for the repair step go to a reserved folder, so the
        # folder listing tells whether there are any; no extra job.
        bucket = F.when(is_too_deep(F.col("error")), F.lit(REPAIR_BUCKET)).otherwise(bucket)
    staged_out = batch.withColumn(MK, merge_key()).withColumn(BUCKET, bucket)
    _write_buckets(staged_out.select(*given, MK, BUCKET), staging)
    if repair is not None and REPAIR_BUCKET in written_buckets(spark, staging):
        decoded = repair(spark.read.parquet(staging).select(*given)).withColumn(MK, merge_key())
        staging = f"{work}/decoded"
        _write_buckets(decoded.withColumn(BUCKET, bucket_of(F.col(MK), target.buckets)).select(*given, MK, BUCKET), staging)
    staged = spark.read.parquet(staging)
    if check_unique:
        check_unique_keys(staged)
    touched = written_buckets(spark, staging)
    if not touched:
        if not batch.isEmpty():
            raise RuntimeError(f"staging folder {staging} lists no bucket; is it shared by all executors?")
        remove_path(spark, work)
        return
    if not written_buckets(spark, target.path):
        # First load into an empty target: nothing to merge with, so the
        # staged rows go straight in (a crash here is repaired by a
        # replay, which then merges with whatever was written).
        if lookup is None:
            _write_buckets(staged.select(*columns, BUCKET), target.path, only_written=True)
        else:
            _load_looked_up(staged, staging, touched, target, lookup, pass_bytes)
        remove_path(spark, work)
        return
    old = read_target(spark, target).filter(F.col(BUCKET).isin(touched)).withColumn(MK, merge_key())
    result = _merge_rows(old, staged, target.order_guard, lookup or (lambda rows: rows))
    _write_buckets(result.select(*columns, BUCKET), merged)
    _overwrite_from(spark, merged, target)
    remove_path(spark, work)


def _append_delta(spark, batch, target, run_key, batch_id, check_unique, repair) -> None:
    """The ``deltas`` layout: one folder with the batch's rows, published by one rename."""
    batch_id = batch_id if batch_id is not None else uuid.uuid4().hex
    with_keys = lambda df: df.withColumn(MK, merge_key()).withColumn(BUCKET, bucket_of(F.col(MK), target.buckets))

    def repaired(written: DataFrame) -> DataFrame | None:
        """The written batch with its too deep rows decoded, where there are any."""
        if repair is None or written.filter(is_too_deep(F.col("error"))).isEmpty():
            return None
        return with_keys(repair(written.select(*batch.columns)))

    deltas.append(spark, with_keys(batch), target, run_key, str(batch_id), finish=repaired, check=check_unique_keys if check_unique else None)


def live_rows(df: DataFrame) -> DataFrame:
    """Rows that are not soft-deleted."""
    return df.filter(~F.col("is_deleted"))


def register_target(spark: SparkSession, name: str, target: TargetConfig) -> None:
    """``CREATE TABLE IF NOT EXISTS`` over the target folder, for SQL readers.

    The table is partitioned by ``bucket``; new bucket folders written by
    later batches are picked up with ``MSCK REPAIR TABLE``/``REFRESH``.
    """
    from tidewater.schemas import target_ddl

    if target.layout == "deltas":
        raise ValueError("a target of deltas has no table of files; make a view of read_target, or register a compacted copy")
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({target_ddl(target.with_lookup)}, `{BUCKET}` INT) "
        f"USING parquet PARTITIONED BY (`{BUCKET}`) LOCATION '{target.path}'"
    )
    spark.sql(f"MSCK REPAIR TABLE {name}")
