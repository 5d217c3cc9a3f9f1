"""The plan every batch goes through: decode -> latest per key -> enrich -> upsert."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.config import DecodeOptions, LookupConfig, TargetConfig
from tidewater.functions.record import is_too_deep
from tidewater.operators.enrich import enrich, link
from tidewater.operators.files import remove_path
from tidewater.operators.latest import latest_per_key, newest_decoded
from tidewater.operators.normalize import normalize_changes
from tidewater.operators.upsert import upsert
from tidewater.session import checkpoint_dir
from tidewater.sinks.changelog import batch_folder, write_change_log
from tidewater.sources.lookup import follow_files, may_broadcast, read_lookup


def stage_changes(
    spark: SparkSession,
    records: DataFrame,
    lookup: LookupConfig | None = None,
    decode: DecodeOptions | None = None,
    collapse_errors: bool = False,
    column: str | None = None,
    work: str | None = None,
) -> DataFrame:
    """Change records (text) -> rows ready to upsert, lazily.

    With the default ``deep_fallback`` rows nested too deeply are still
    flagged: the upsert's ``repair`` step (``deep_repair``) decodes them.
    """
    rows = latest_per_key(normalize_changes(records, column, staged_options(decode)), collapse_errors=collapse_errors)
    if lookup is not None:
        rows = looked_up(spark, rows, lookup, f"{work}/rows" if work else None)
    return rows


def apply_change_batch(
    spark: SparkSession,
    records: DataFrame,
    target: TargetConfig | None,
    batch_id: int | str | None = None,
    lookup: LookupConfig | None = None,
    decode: DecodeOptions | None = None,
    collapse_errors: bool = False,
    run_key: str = "default",
    change_log: str | None = None,
) -> None:
    """One micro-batch of change records into the target, the change log or both.

    With a log the records are decoded once, into the log; the target's rows
    are then read back from the batch's folder there.
    """
    if lookup is not None and lookup.follow is not None:
        follow_files(spark, lookup)
    work = f"{checkpoint_dir(spark)}/tidewater-lookup/{uuid.uuid4().hex}"
    if change_log is None:
        staged = stage_changes(spark, records, lookup, decode, collapse_errors, work=work)
    else:
        decoded = logged(spark, normalize_changes(records, None, staged_options(decode)), change_log, run_key, batch_id, decode)
        if target is None:
            return
        staged = latest_per_key(decoded, collapse_errors=collapse_errors)
        staged = staged if lookup is None else looked_up(spark, staged, lookup, f"{work}/rows")
    # Latest-per-key output holds each key once; only a lookup in "rows"
    # mode can repeat a key, so only then is the duplicate check needed.
    fan_out = lookup is not None and lookup.multi == "rows"
    upsert(
        spark,
        staged,
        target,
        batch_id=batch_id,
        run_key=run_key,
        check_unique=target.check_unique and fan_out,
        repair=deep_repair(decode, lookup=None if lookup is None else lambda rows: looked_up(spark, rows, lookup, f"{work}/deep")),
    )
    if lookup is not None:
        remove_path(spark, work)


def logged(
    spark: SparkSession,
    rows: DataFrame,
    change_log: str,
    run_key: str,
    batch_id: int | str | None,
    decode: DecodeOptions | None,
    again: Callable[[DataFrame, DecodeOptions], DataFrame] | None = None,
) -> DataFrame:
    """Writes decoded rows to the change log; returns them as read from there.

    The batch's folder carries the job's and the batch's name, so a replay
    replaces it. Rows nested too deeply for the native decoder are found on
    a work table and decoded from their raw text (``again`` as in
    ``deep_repair``) before anything reaches the log.
    """
    decode = decode or DecodeOptions()
    name = f"{run_key}-{batch_id if batch_id is not None else uuid.uuid4().hex}"
    work = None
    if decode.deep_fallback in ("route", "repair"):
        work = f"{checkpoint_dir(spark)}/tidewater-log/{uuid.uuid4().hex}"
        rows.write.parquet(work)
        staged = spark.read.schema(rows.schema).parquet(work)
        rows, deep = staged, is_too_deep(F.col("error"))
        if not staged.filter(deep).isEmpty():
            texts, inline = staged.filter(deep).select("raw_payload"), replace(decode, deep_fallback="udf")
            found = normalize_changes(texts, None, inline) if again is None else again(texts, inline)
            rows = staged.filter(~deep).unionByName(found)
    write_change_log(rows, change_log, name)
    if work is not None:
        remove_path(spark, work)
    return spark.read.schema(rows.schema).parquet(batch_folder(change_log, name)).select(*rows.columns)


def looked_up(spark: SparkSession, rows: DataFrame, lookup: LookupConfig, work: str | None = None) -> DataFrame:
    """``rows`` joined to the lookup, read inside the batch, so records added since the last batch are seen.

    For a partitioned lookup the batch's URIs are needed first: with a
    ``work`` folder the rows are written there, so they are decoded once;
    in array mode only records of these URIs are packed.
    """
    if lookup.format != "partitioned":
        return enrich(rows, read_lookup(spark, lookup), lookup.multi, may_broadcast(spark, lookup))
    if work is not None:
        rows.write.mode("overwrite").parquet(work)
        rows = spark.read.schema(rows.schema).parquet(work)
    uris = rows.select(link().alias("uri"))
    found = read_lookup(spark, lookup, uris)
    if lookup.multi == "array":
        found = found.join(uris.distinct(), F.col("s3_uri") == F.col("uri"), "left_semi")
    return enrich(rows, found, lookup.multi)


def staged_options(decode: DecodeOptions | None) -> DecodeOptions:
    """The options of a job that stages its batch: flagged rows stay flagged until then."""
    decode = decode or DecodeOptions()
    return replace(decode, deep_fallback="repair") if decode.deep_fallback == "route" else decode


def deep_repair(
    decode: DecodeOptions | None,
    again: Callable[[DataFrame, DecodeOptions], DataFrame] | None = None,
    lookup: Callable[[DataFrame], DataFrame] | None = None,
):
    """The upsert's step for a staged batch that holds flagged rows: the batch with these rows decoded.

    Only the flagged rows' raw text goes through the Arrow UDF (``again``:
    text rows and options -> target rows; change records by default) and the
    lookup. The newest decodable change of each key is then found again, so
    one that proves undecodable does not hide an older one.
    """
    decode = decode or DecodeOptions()
    if decode.deep_fallback not in ("route", "repair"):
        return None
    inline = replace(decode, deep_fallback="udf")

    def repair(staged: DataFrame) -> DataFrame:
        deep = is_too_deep(F.col("error"))
        texts = staged.filter(deep).select("raw_payload")
        rows = normalize_changes(texts, None, inline) if again is None else again(texts, inline)
        rows = rows if lookup is None else lookup(rows)
        whole = staged.filter(~deep).unionByName(rows.select(*staged.columns))
        return newest_decoded(whole) if again is None else whole

    return repair
