"""Test feeds made from the driver's tables, as the raw JSON text the jobs read.

Every query over the given tables starts here, so the real parse and
decode path runs on data whose size grows with the tables. The texts are
built with ``to_json`` over column expressions (no Python per row).

Feed from ``events`` (key ``user_id``): ``signup`` -> INSERT, ``error`` ->
REMOVE, anything else -> MODIFY. REMOVE has no new image, INSERT no old one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.operators.files import folder_bytes

# Fixed values of the generated records.
FEED_REGION = "local-1"
FEED_TABLE = "events"
FEED_SOURCE = "aws:dynamodb"
FEED_FORMAT = "application/json"
EXPORT_TABLE = "orders"
EXPORT_KEYS = ("o_orderkey",)
# Split points of the three batches of the upsert queries.
BATCH_BOUNDS = ("2024-01-11 00:00:00", "2024-01-21 00:00:00")
# Every 97th record is broken in one of three ways (see ``broken_feed``).
BREAK_EVERY = 97
# Every 53rd value is nested deeper than the native decoder goes (see ``deep_feed``).
DEEP_EVERY, DEEP_LEVELS = 53, 12
# Bytes of a table to a task; decoded, an event takes about 50 times its bytes there.
PIECE_BYTES = 2 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def table_bytes(spark: SparkSession, sf_dir: str, name: str) -> int:
    return folder_bytes(spark, f"{sf_dir.rstrip('/')}/{name}.parquet")


def pieces(spark: SparkSession, sf_dir: str, name: str) -> int:
    """The number of tasks a feed made of a table is dealt over: the session's cores, or more by the table's bytes."""
    return max(spark.sparkContext.defaultParallelism, -(-table_bytes(spark, sf_dir, name) // PIECE_BYTES))


def spread(df: DataFrame, key: str, number: int) -> DataFrame:
    """Hash-partition the rows that a feed is made of, before their texts are built and decoded.

    A real change stream arrives in many shards and an export in many files;
    a given table is one file, whose splits say nothing of its rows: a row
    group, however many rows it has, goes to one task. And a task's texts
    and images take many times the table's bytes, so their number follows these.
    """
    return df.repartition(number, key)


def _n(value: Column) -> Column:
    return F.struct(value.cast("string").alias("N"))


def _s(value: Column) -> Column:
    return F.struct(value.cast("string").alias("S"))


def event_name(event_type: Column) -> Column:
    return F.when(event_type == "signup", "INSERT").when(event_type == "error", "REMOVE").otherwise("MODIFY")


def event_millis(ts: Column) -> Column:
    """Milliseconds since the epoch of a TIMESTAMP_NTZ, without the session zone."""
    return F.expr(f"timestampdiff(MILLISECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', {ts._jc.toString()})")


def _value_text(value: Column) -> Column:
    return value.cast("decimal(18,2)").cast("string")


def new_image(events: DataFrame, s3_uri: Column | None = None) -> Column:
    """Typed image ``{user_id:N, event_type:S, value:N, props:M{k:N}, tags:L, flag:BOOL, note:NULL}``."""
    k = F.get_json_object("props", "$.k")
    fields = [
        _n(F.col("user_id")).alias("user_id"),
        _s(F.col("event_type")).alias("event_type"),
        _n(_value_text(F.col("value"))).alias("value"),
        F.struct(F.struct(_n(k).alias("k")).alias("M")).alias("props"),
        F.struct(F.array(F.struct(F.col("event_type").alias("S"), F.lit(None).cast("string").alias("N")),
                         F.struct(F.lit(None).cast("string").alias("S"), k.alias("N"))).alias("L")).alias("tags"),
        F.struct((F.col("event_type") == "purchase").alias("BOOL")).alias("flag"),
        F.struct(F.lit(True).alias("NULL")).alias("note"),
    ]
    if s3_uri is not None:
        fields.append(F.struct(s3_uri.alias("S")).alias("s3_uri"))
    return F.struct(*fields)


def old_image() -> Column:
    return F.struct(_n(F.col("user_id")).alias("user_id"), _n(_value_text(F.col("value"))).alias("value"))


def size_bytes() -> Column:
    return (F.lit(100) + F.length("event_type") + F.length("props")).cast("int")


def change_record(events: DataFrame, s3_uri: Column | None = None) -> Column:
    """One change record per event, as JSON text."""
    name = event_name(F.col("event_type"))
    body = F.struct(
        event_millis(F.col("ts")).alias("ApproximateCreationDateTime"),
        F.struct(_n(F.col("user_id")).alias("user_id")).alias("Keys"),
        F.when(name != "REMOVE", new_image(events, s3_uri)).alias("NewImage"),
        F.when(name != "INSERT", old_image()).alias("OldImage"),
        size_bytes().alias("SizeBytes"),
    )
    return F.to_json(
        F.struct(
            F.lit(FEED_REGION).alias("awsRegion"),
            F.col("event_id").cast("string").alias("eventID"),
            name.alias("eventName"),
            F.lit(FEED_FORMAT).alias("recordFormat"),
            F.lit(FEED_TABLE).alias("tableName"),
            body.alias("dynamodb"),
            F.lit(FEED_SOURCE).alias("eventSource"),
        )
    )


def change_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``value`` (record text) and ``ts`` of every event."""
    ev = spread(table(spark, sf_dir, "events"), "event_id", pieces(spark, sf_dir, "events"))
    return ev.select(change_record(ev).alias("value"), "ts")


def batch_of(ts: Column) -> Column:
    """Batch number 1, 2 or 3 of an event, by time."""
    return F.when(ts < F.lit(BATCH_BOUNDS[0]).cast("timestamp_ntz"), 1).when(
        ts < F.lit(BATCH_BOUNDS[1]).cast("timestamp_ntz"), 2
    ).otherwise(3)


def change_batches(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """The feed cut into three batches by time, each a one-column frame."""
    feed = change_feed(spark, sf_dir).withColumn("_batch", batch_of(F.col("ts")))
    return [feed.filter(F.col("_batch") == i).select("value") for i in (1, 2, 3)]


def broken_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feed with every 97th record broken: cut short, an unknown tag, or no Keys."""
    ev = spread(table(spark, sf_dir, "events"), "event_id", pieces(spark, sf_dir, "events"))
    text = change_record(ev)
    kind = F.floor(F.col("event_id") / BREAK_EVERY) % 3
    broken = (
        F.when(kind == 0, F.expr("substring(_text, 1, length(_text) - 1)"))
        .when(kind == 1, F.regexp_replace("_text", '"Keys":\\{"user_id":\\{"N"', '"Keys":{"user_id":{"X"'))
        .otherwise(F.regexp_replace("_text", '"Keys":\\{"user_id":\\{"N":"[0-9]+"\\}\\},', ""))
    )
    return ev.select(text.alias("_text"), "event_id").select(
        F.when(F.col("event_id") % BREAK_EVERY == 0, broken).otherwise(F.col("_text")).alias("value")
    )


def deep_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Changes of ``events`` where every 53rd image nests its value 12 levels deep, half of those undecodably.

    Every value ends in a control character and a non-ASCII one, both escaped in the record's text.
    """
    value = """concat('{"S":"', event_type, '\\\\u001f\\\\u00e9"}')"""
    leaf = f"""CASE WHEN (event_id div {DEEP_EVERY}) % 2 = 0 THEN {value} ELSE '{{"Q":"1"}}' END"""
    deep = f"""concat(repeat('{{"M":{{"d":', {DEEP_LEVELS}), {leaf}, repeat('}}}}', {DEEP_LEVELS}))"""
    text = f"""concat('{{"eventID":"', event_id, '","eventName":"MODIFY","tableName":"events","dynamodb":{{"ApproximateCreationDateTime":', _ms,
      ',"SizeBytes":9,"Keys":{{"user_id":{{"N":"', user_id, '"}}}},"NewImage":{{"user_id":{{"N":"', user_id, '"}},"d":', CASE WHEN event_id % {DEEP_EVERY} = 0 THEN {deep} ELSE {value} END, '}}}}}}')"""
    events = table(spark, sf_dir, "events").withColumn("_ms", event_millis(F.col("ts")))
    return spread(events, "event_id", pieces(spark, sf_dir, "events")).select(F.expr(text).alias("value"))


def lookup_feed(spark: SparkSession, sf_dir: str, timed: bool = False) -> DataFrame:
    """Change records whose new image names a page URL in ``s3_uri`` (with the event's ``ts`` if ``timed``).

    User ``u`` points at page ``2u``; pages past the end of the table give
    URIs that match nothing.
    """
    ev = table(spark, sf_dir, "events")
    pages = table(spark, sf_dir, "pages").select(F.col("page_id"), F.col("url"))
    joined = spread(ev.join(pages, ev.user_id * 2 == pages.page_id, "left"), "event_id", pieces(spark, sf_dir, "events"))
    uri = F.coalesce(F.col("url"), F.concat(F.lit("missing://page/"), (F.col("user_id") * 2).cast("string")))
    return joined.select(change_record(ev, uri).alias("value"), *(["ts"] if timed else []))


PAGES_A_FILE = 20


def write_page_files(spark: SparkSession, sf_dir: str, path: str, parity: int) -> None:
    """``pages`` as JSON-lines files of consecutive pages; those of even or odd number.

    The number of tasks is given: left to AQE, the few bytes of the lines would all go to one, which makes file by file.
    """
    number = F.floor(F.col("page_id") / PAGES_A_FILE)
    pages = table(spark, sf_dir, "pages").select("page_id", number.alias("file"))
    lines = pages.filter(F.col("file") % 2 == parity).repartition(pieces(spark, sf_dir, "pages"), "file").select(F.to_json(F.struct("page_id")).alias("value"), "file")
    lines.write.partitionBy("file").text(path)


def file_feed(spark: SparkSession, sf_dir: str, path: str) -> DataFrame:
    """Change records (with ``ts``) whose image names the file under ``path`` that holds page ``2u``, if there is one yet."""
    ev = table(spark, sf_dir, "events")
    lines = spark.read.option("recursiveFileLookup", "true").text(path).select(F.input_file_name().alias("uri"), "value")
    pages = lines.select("uri", F.get_json_object("value", "$.page_id").cast("long").alias("page_id"))
    files = pages.groupBy("uri").agg(F.floor(F.min("page_id") / PAGES_A_FILE).alias("file"))
    joined = ev.join(files, F.floor(ev.user_id * 2 / PAGES_A_FILE) == files.file, "left")
    joined = spread(joined, "event_id", pieces(spark, sf_dir, "events"))
    uri = F.coalesce(F.col("uri"), F.concat(F.lit("missing://page/"), (F.col("user_id") * 2).cast("string")))
    return joined.select(change_record(ev, uri).alias("value"), "ts")


def page_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``pages`` as lookup records: URI and the record as JSON text."""
    pages = table(spark, sf_dir, "pages")
    return pages.select(
        F.col("url").alias("s3_uri"),
        F.to_json(F.struct("page_id", "url", "html")).alias("raw_s3_payload"),
    )


def export_lines(spark: SparkSession, sf_dir: str, with_link: bool = False) -> DataFrame:
    """``orders`` as table-export lines ``{"Item": {...}}``.

    ``with_link`` adds an ``s3_uri`` attribute: the URL of page ``o_custkey``,
    or a URI that matches nothing when there is no such page.
    """
    o = table(spark, sf_dir, "orders")
    link = []
    if with_link:
        pages = table(spark, sf_dir, "pages").select("page_id", "url")
        o = o.join(pages, o.o_custkey == pages.page_id, "left")
        uri = F.coalesce(F.col("url"), F.concat(F.lit("missing://page/"), F.col("o_custkey").cast("string")))
        link = [_s(uri).alias("s3_uri")]
    o = spread(o, "o_orderkey", pieces(spark, sf_dir, "orders"))
    item = F.struct(
        _n(F.col("o_orderkey")).alias("o_orderkey"),
        _n(F.col("o_custkey")).alias("o_custkey"),
        _s(F.col("o_orderstatus")).alias("o_orderstatus"),
        _n(_value_text(F.col("o_totalprice"))).alias("o_totalprice"),
        _s(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("o_orderdate"),
        _s(F.col("o_orderpriority")).alias("o_orderpriority"),
        *link,
    )
    return o.select(F.to_json(F.struct(item.alias("Item"))).alias("value"))
