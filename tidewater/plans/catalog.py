"""The driver's test queries over the given tables.

Each function takes ``(spark, sf_dir)`` and returns a DataFrame whose
columns match the SQL in ``__spark_entry__.oracle_sql``. JSON texts are
compared through their leaf values, since engines format JSON differently.
Queries that upsert write their target under the shared checkpoint folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.config import BulkConfig, LookupConfig, StreamConfig, TargetConfig
from tidewater.operators.enrich import enrich
from tidewater.operators.latest import latest_per_key
from tidewater.operators.normalize import normalize_changes, normalize_export
from tidewater.operators.deltas import compact
from tidewater.operators.upsert import PASS_BYTES, live_rows, read_target, upsert
from tidewater.operators.views import typed_view
from tidewater.plans import feeds
from tidewater.plans.batch import apply_change_batch, deep_repair, stage_changes, staged_options
from tidewater.plans.bulk import run_bulk
from tidewater.session import apply_job_conf, scratch_path, shuffles_dropped
from tidewater.sinks.changelog import read_change_log, write_change_log
from tidewater.streaming.job import run_stream
from tidewater.sources.lookup import prepare_lookup

# Fixed values of the bulk-load query.
BULK_RUN_ID = "run-0001"
BULK_LOAD_MILLIS = 1700000000000
# Bucket count of the query targets (small tables; a real target sizes it to the data).
LOOKUP_PARTS = 16
QUERY_BUCKETS = 16

LATEST_COLUMNS = ("keys", "event_id", "last_event_name", "approx_creation_timestamp_millis", "is_deleted")


def _changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalize_changes(feeds.change_feed(spark, sf_dir).select("value"))


def envelope_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _changes(spark, sf_dir).select("event_id", "last_event_name", "table_name", "is_deleted")


def decode_images(spark: SparkSession, sf_dir: str) -> DataFrame:
    ch = _changes(spark, sf_dir)
    new, old = F.col("new_image"), F.col("old_image")
    return ch.select(
        "event_id",
        F.get_json_object(new, "$.user_id").alias("new_user_id"),
        F.get_json_object(new, "$.event_type").alias("new_event_type"),
        F.get_json_object(new, "$.value").alias("new_value"),
        F.get_json_object(new, "$.props.k").alias("new_k"),
        F.get_json_object(new, "$.tags[0]").alias("tag0"),
        F.get_json_object(new, "$.tags[1]").alias("tag1"),
        F.get_json_object(new, "$.flag").alias("flag"),
        (new == "{}").alias("new_empty"),
        F.get_json_object(old, "$.value").alias("old_value"),
        (old == "{}").alias("old_empty"),
    )


def normalize_changes_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Normalised changes through the file sink and back."""
    path = scratch_path(spark, "queries", "changelog")
    write_change_log(_changes(spark, sf_dir), path, batch_id=1)
    log = spark.read.parquet(path)
    return log.select(
        "event_id",
        "last_event_name",
        "table_name",
        "approx_creation_timestamp_millis",
        "keys",
        "error",
        "has_parsing_error",
        "is_deleted",
        "raw_payload_size_bytes",
        F.col("change_date").cast("string").alias("change_date"),
    )


def parse_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    ch = normalize_changes(feeds.broken_feed(spark, sf_dir))
    return ch.select(
        "event_id",
        "keys",
        "has_parsing_error",
        F.get_json_object("error", "$.error").alias("error_reason"),
    )


def latest_per_key_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest_per_key(_changes(spark, sf_dir)).select(*LATEST_COLUMNS)


def _upsert_batches(spark: SparkSession, sf_dir: str, order: tuple[int, ...], guard: bool, name: str, compact_after: int | None = None, **layout) -> DataFrame:
    apply_job_conf(spark)
    target = TargetConfig(path=scratch_path(spark, "queries", name), buckets=QUERY_BUCKETS, order_guard=guard, **layout)
    batches = feeds.change_batches(spark, sf_dir)
    for i in order:
        staged = stage_changes(spark, batches[i - 1])
        upsert(spark, staged, target, batch_id=i, check_unique=False, repair=deep_repair(None))
        if i == compact_after:
            compact(spark, target)
    return read_target(spark, target)


def upsert_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _upsert_batches(spark, sf_dir, (1, 2, 3), False, "upsert").select(*LATEST_COLUMNS)


def upsert_out_of_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _upsert_batches(spark, sf_dir, (3, 1, 2), False, "upsert-arrival").select(*LATEST_COLUMNS)


def upsert_order_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _upsert_batches(spark, sf_dir, (3, 1, 2), True, "upsert-guard").select(*LATEST_COLUMNS)


def decode_deep(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values nested beyond the native decoder, valid and not, through a job's staging into a target of deltas."""
    apply_job_conf(spark)
    target = TargetConfig(path=scratch_path(spark, "queries", "deep"), buckets=QUERY_BUCKETS, layout="deltas")
    apply_change_batch(spark, feeds.deep_feed(spark, sf_dir), target, batch_id=0)
    return read_target(spark, target).select("keys", "event_id", "new_image", "has_parsing_error")


def upsert_deltas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three batches as deltas, the first two folded into a base: the result merges a base and a delta."""
    return _upsert_batches(spark, sf_dir, (1, 2, 3), False, "upsert-deltas", 2, layout="deltas").select(*LATEST_COLUMNS)


def upsert_deltas_order_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest batch first, folded into the base that the older ones must not replace."""
    return _upsert_batches(spark, sf_dir, (3, 1, 2), True, "upsert-deltas-guard", 3, layout="deltas").select(*LATEST_COLUMNS)


def soft_deletes(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = _upsert_batches(spark, sf_dir, (1, 2, 3), False, "soft-deletes")
    live = live_rows(target).select("keys", F.lit(True).alias("live"))
    return target.join(live, "keys", "left").select(
        "keys",
        "is_deleted",
        F.coalesce(F.col("live"), F.lit(False)).alias("live"),
        (F.col("new_image") == "{}").alias("new_empty"),
        F.get_json_object("old_image", "$.user_id").alias("old_user_id"),
    )


def bulk_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An export written as files, then read, decoded and loaded by the bulk job."""
    export = scratch_path(spark, "queries", "export")
    feeds.export_lines(spark, sf_dir).write.text(f"{export}/data", compression="gzip")
    cfg = BulkConfig(
        export_path=export,
        table_name=feeds.EXPORT_TABLE,
        key_names=feeds.EXPORT_KEYS,
        target=TargetConfig(path=scratch_path(spark, "queries", "bulk"), buckets=QUERY_BUCKETS),
        run_id=BULK_RUN_ID,
        load_time_millis=BULK_LOAD_MILLIS,
    )
    run_bulk(spark, cfg)
    new = F.col("new_image")
    return read_target(spark, cfg.target).select(
        "keys",
        "event_id",
        "last_event_name",
        "table_name",
        "approx_creation_timestamp_millis",
        "old_image",
        "has_parsing_error",
        "is_deleted",
        "raw_payload_size_bytes",
        F.get_json_object(new, "$.o_custkey").alias("o_custkey"),
        F.get_json_object(new, "$.o_orderstatus").alias("o_orderstatus"),
        F.get_json_object(new, "$.o_totalprice").alias("o_totalprice"),
        F.get_json_object(new, "$.o_orderdate").alias("o_orderdate"),
        F.get_json_object(new, "$.o_orderpriority").alias("o_orderpriority"),
    )


def bulk_lookup_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bulk load joined to the lookup records (several pages may share a URL), into a target with the lookup columns."""
    target = TargetConfig(path=scratch_path(spark, "queries", "bulk-lookup"), buckets=QUERY_BUCKETS, with_lookup=True)
    decoded = lambda lines, opts: normalize_export(lines, feeds.EXPORT_KEYS, feeds.EXPORT_TABLE, BULK_RUN_ID, BULK_LOAD_MILLIS, opts=opts)
    linked = lambda rows: enrich(rows, feeds.page_lookup(spark, sf_dir), "array")
    rows = decoded(feeds.export_lines(spark, sf_dir, with_link=True), staged_options(None))
    apply_job_conf(spark)
    upsert(spark, rows, target, batch_id=BULK_RUN_ID, run_key="bulk", repair=deep_repair(None, decoded), lookup=linked, pass_bytes=max(PASS_BYTES, feeds.table_bytes(spark, sf_dir, "pages")))
    return _linked(read_target(spark, target))


def _linked(rows: DataFrame) -> DataFrame:
    """Each order with its own page among the records of the page's URL."""
    own = F.get_json_object("new_image", "$.o_custkey").cast("long")
    records = F.from_json("raw_s3_payload", "array<struct<page_id:bigint>>")
    return rows.select(
        "keys",
        "s3_uri",
        F.get(F.filter(records, lambda r: r["page_id"] == own), 0)["page_id"].cast("string").alias("page_id"),
        (F.col("raw_s3_payload") == "{}").alias("payload_empty"),
        F.get_json_object("new_image", "$.s3_uri").alias("link"),
    )


def bulk_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The bulk job with its lookup option, over export files and a prepared lookup table."""
    export, pages = (scratch_path(spark, "queries", name) for name in ("linked-export", "pages"))
    with shuffles_dropped(spark):
        feeds.export_lines(spark, sf_dir, with_link=True).write.text(f"{export}/data", compression="gzip")
        feeds.page_lookup(spark, sf_dir).write.parquet(pages, compression="zstd")
    cfg = BulkConfig(
        export_path=export,
        table_name=feeds.EXPORT_TABLE,
        key_names=feeds.EXPORT_KEYS,
        target=TargetConfig(path=scratch_path(spark, "queries", "bulk-job"), buckets=QUERY_BUCKETS, with_lookup=True),
        run_id=BULK_RUN_ID,
        load_time_millis=BULK_LOAD_MILLIS,
        lookup=LookupConfig(path=pages, format="parquet", multi="array"),
    )
    run_bulk(spark, cfg)
    return _linked(read_target(spark, cfg.target))


def stream_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stream_lookup(spark, sf_dir, False)


def stream_lookup_pruned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same over a lookup prepared in partitions, of which a batch reads those that its URIs name."""
    return _stream_lookup(spark, sf_dir, True)


def _stream_lookup(spark: SparkSession, sf_dir: str, partitioned: bool) -> DataFrame:
    """The streaming job with its lookup option, stopped and run again.

    The first run sees the first third of the time and the lookup records of
    every other linked page; the other records are added before the second
    run, whose changes find them. A change whose URL several pages share
    becomes one row for each, so the target takes repeated keys.
    """
    source, pages = (scratch_path(spark, "queries", name) for name in ("linked-source", "growing-pages"))
    feed = feeds.lookup_feed(spark, sf_dir, timed=True).withColumn("_first", feeds.batch_of(F.col("ts")) == 1)
    lookup = feeds.page_lookup(spark, sf_dir).withColumn("_first", F.get_json_object("raw_s3_payload", "$.page_id").cast("long") % 4 == 0)
    cfg = StreamConfig(
        source_format="text",
        source_path=f"{source}/run-*",
        target=TargetConfig(path=scratch_path(spark, "queries", "linked-target"), buckets=QUERY_BUCKETS, with_lookup=True, check_unique=False),
        checkpoint_location=scratch_path(spark, "queries", "linked-checkpoint"),
        lookup=LookupConfig(path=pages, format="partitioned" if partitioned else "parquet"),
        available_now=True,
    )
    for run, part in ((1, F.col("_first")), (2, ~F.col("_first"))):
        rows = lookup.filter(part).drop("_first")
        if partitioned:
            prepare_lookup(rows, pages, LOOKUP_PARTS)
        else:
            rows.write.mode("append").parquet(pages)
        feed.filter(part).select("value").write.text(f"{source}/run-{run}")
        _finish(run_stream(spark, cfg))
    return read_target(spark, cfg.target).select(
        "keys",
        "event_id",
        "s3_uri",
        F.get_json_object("raw_s3_payload", "$.page_id").alias("page_id"),
        (F.col("raw_s3_payload") == "{}").alias("payload_empty"),
    )


def stream_lookup_followed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The streaming job over a folder of JSON files that it follows, packed as arrays; run, stopped and run again.

    The second run finds files that came since; it reads only those.
    """
    source, files = (scratch_path(spark, "queries", name) for name in ("filed-source", "page-files"))
    cfg = StreamConfig(
        source_format="text",
        source_path=f"{source}/run-*",
        target=TargetConfig(path=scratch_path(spark, "queries", "filed-target"), buckets=QUERY_BUCKETS, with_lookup=True),
        checkpoint_location=scratch_path(spark, "queries", "filed-checkpoint"),
        lookup=LookupConfig(path=scratch_path(spark, "queries", "filed-lookup"), format="partitioned", follow=files, parts=LOOKUP_PARTS, multi="array"),
        available_now=True,
    )
    for run in (1, 2):
        feeds.write_page_files(spark, sf_dir, f"{files}/run-{run}", run - 1)
        first = feeds.batch_of(F.col("ts")) == 1
        feeds.file_feed(spark, sf_dir, files).filter(first if run == 1 else ~first).select("value").write.text(f"{source}/run-{run}")
        _finish(run_stream(spark, cfg))
    return read_target(spark, cfg.target).select(
        "keys",
        "event_id",
        F.col("s3_uri").isNotNull().alias("matched"),
        F.coalesce(F.json_array_length("raw_s3_payload"), F.lit(0)).alias("n_records"),
        F.regexp_replace("raw_s3_payload", r"\s", "").alias("records"),
    )


def _finish(query) -> None:
    query.awaitTermination()
    if query.exception() is not None:
        raise RuntimeError(f"stream failed: {query.exception()}")


def _lookup_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest_per_key(normalize_changes(feeds.lookup_feed(spark, sf_dir)))


def lookup_left_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = enrich(_lookup_changes(spark, sf_dir), feeds.page_lookup(spark, sf_dir))
    return joined.select(
        "keys",
        "event_id",
        "s3_uri",
        F.get_json_object("raw_s3_payload", "$.page_id").alias("page_id"),
        (F.col("raw_s3_payload") == "{}").alias("payload_empty"),
        (F.col("new_image") == "{}").alias("new_empty"),
    )


def _page_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two lookup records per page URL."""
    pages = feeds.table(spark, sf_dir, "pages").select("page_id", "url", F.explode(F.array(F.lit(1), F.lit(2))).alias("part"))
    return pages.select(F.col("url").alias("s3_uri"), F.to_json(F.struct("page_id", "part")).alias("raw_s3_payload"))


def lookup_fanout_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = enrich(_lookup_changes(spark, sf_dir), _page_parts(spark, sf_dir), multi="rows")
    return joined.select(
        "keys",
        "event_id",
        "s3_uri",
        F.get_json_object("raw_s3_payload", "$.page_id").alias("page_id"),
        F.get_json_object("raw_s3_payload", "$.part").alias("part"),
    )


def lookup_fanout_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = enrich(_lookup_changes(spark, sf_dir), _page_parts(spark, sf_dir), multi="array")
    return joined.select(
        "keys",
        "event_id",
        "s3_uri",
        F.coalesce(F.json_array_length("raw_s3_payload"), F.lit(0)).alias("n_records"),
        F.regexp_replace("raw_s3_payload", r"\s", "").alias("records"),
    )


def typed_view_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = _upsert_batches(spark, sf_dir, (1, 2, 3), False, "typed-view")
    view = typed_view(
        target,
        {
            "user_id": ("$.user_id", "bigint"),
            "event_type": ("$.event_type", "string"),
            "value": ("$.value", "decimal(18,2)"),
            "k": ("$.props.k", "bigint"),
            "flag": ("$.flag", "boolean"),
        },
    )
    return view.withColumn("value", F.col("value").cast("double"))


def stream_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _streamed(spark, sf_dir)


def stream_deltas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same stream into a target of deltas that compacts itself."""
    return _streamed(spark, sf_dir, layout="deltas", compact_ratio=0.5)


def stream_change_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same stream with both outputs: every change from the log, and whether the target holds it."""
    log = scratch_path(spark, "queries", "stream-log")
    stored = _streamed(spark, sf_dir, change_log=log).select("keys", F.col("event_id").alias("stored_id"))
    return read_change_log(spark, log).join(stored, "keys", "left").select(
        "event_id",
        "keys",
        "last_event_name",
        F.col("change_date").cast("string").alias("change_date"),
        (F.col("event_id") == F.col("stored_id")).alias("is_latest"),
    )


def _streamed(spark: SparkSession, sf_dir: str, change_log: str | None = None, **layout) -> DataFrame:
    """The feed written as three sets of text files, streamed into the target.

    Each set keeps the feed's partitioning (no single-task write), a file to
    a piece; every trigger takes about one set. Files are taken in modification order, so
    the order guard makes the newest change win whatever the cut.
    """
    source_dir = scratch_path(spark, "queries", "stream-source")
    feed = feeds.change_feed(spark, sf_dir).withColumn("_batch", feeds.batch_of(F.col("ts")))
    for i in (1, 2, 3):
        feed.filter(F.col("_batch") == i).select("value").write.mode("append").text(f"{source_dir}/batch-{i}")
    cfg = StreamConfig(
        source_format="text",
        source_path=f"{source_dir}/batch-*",
        source_options={"maxFilesPerTrigger": str(feeds.pieces(spark, sf_dir, "events"))},
        target=TargetConfig(path=scratch_path(spark, "queries", "stream-target"), buckets=QUERY_BUCKETS, order_guard=True, **layout),
        checkpoint_location=scratch_path(spark, "queries", "stream-checkpoint"),
        available_now=True,
        change_log=change_log,
    )
    _finish(run_stream(spark, cfg))
    return read_target(spark, cfg.target).select(*LATEST_COLUMNS)
