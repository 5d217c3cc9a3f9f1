"""Change records and export records -> decoded fields.

A record is read with ``from_json`` into a fixed struct whose object-valued
fields are kept as their raw JSON text (exactly what the original jobs'
envelope parse did); the images are then decoded from that text. The
functions add columns in stages: first the texts, then one decoder instance
for all of a record's images, then the checks that read the decoded text.
Keeping the stages apart keeps the (large) decoder expression out of the
checks, so it is planned and run once. Values nested deeper than the native
decoder goes are decoded in Python: by an Arrow UDF in this plan, or, in the
jobs, only for the rows that the native decoder flagged (``plans/batch.py``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.config import DecodeOptions
from tidewater.functions import attributes as A
from tidewater.functions.pyjson import deep_image_udf

# Error reasons written to the ``error`` column.
ERR_MALFORMED = "malformed record"
ERR_NO_BODY = "missing change body"
ERR_NO_KEYS = "missing Keys"
ERR_BAD_VALUE = "invalid attribute value"
ERR_TOO_DEEP = "attribute values nested too deeply"
ERR_NO_ITEM = "missing Item"
ERR_MISSING_KEY = "missing key attribute"

CORRUPT = "_corrupt_record"
BODY = (
    "struct<ApproximateCreationDateTime:decimal(38,6),Keys:string,NewImage:string,"
    "OldImage:string,SizeBytes:decimal(38,6)>"
)
# Envelope and body in one parse: the images stay JSON text for the decoder.
ENVELOPE_WITH_BODY = (
    "struct<awsRegion:string,eventID:string,eventName:string,userIdentity:string,recordFormat:string,"
    f"tableName:string,dynamodb:{BODY},eventSource:string,{CORRUPT}:string>"
)
EXPORT = f"struct<Item:string,{CORRUPT}:string>"
_CORRUPT_OPTS = {"columnNameOfCorruptRecord": CORRUPT}

def parse_change(text: Column) -> Column:
    """Record text -> envelope fields with the ``dynamodb`` body as a struct, in one parse."""
    return F.from_json(text, ENVELOPE_WITH_BODY, _CORRUPT_OPTS)


def parse_export(text: Column) -> Column:
    return F.from_json(text, EXPORT, _CORRUPT_OPTS)


def malformed(parsed: Column) -> Column:
    """The record is not a JSON object."""
    return parsed.isNull() | parsed[CORRUPT].isNotNull()


def malformed_change(parsed: Column) -> Column:
    """Not a JSON object. (A record with one field of the wrong type also
    sets the corrupt-record column, but keeps the fields it could read.)"""
    all_null = F.lit(True)
    for name in ("awsRegion", "eventID", "eventName", "userIdentity", "recordFormat", "tableName", "dynamodb", "eventSource"):
        all_null = all_null & parsed[name].isNull()
    return parsed.isNull() | (parsed[CORRUPT].isNotNull() & all_null)


def is_object_text(text: Column) -> Column:
    return F.coalesce(text.startswith("{"), F.lit(False))


def whole_number(value: Column, type_name: str) -> Column:
    """A decimal as an integral SQL number; NULL if fractional or out of range
    (``try_cast``: under ANSI mode a plain cast would fail the whole job)."""
    return F.when(value == F.floor(value), value.try_cast(type_name))


def ensure_planner_room(df: DataFrame, opts: DecodeOptions) -> None:
    """Let the analyzer and optimizer run enough passes for the unrolled decoder.

    Each nested level needs a few resolution passes (its lambda can only be
    resolved once the level above is), so the default of 100 passes is too
    few past about a dozen levels. Limits are only ever raised.
    """
    need = 100 + 12 * opts.max_depth
    conf = df.sparkSession.conf
    for key in ("spark.sql.analyzer.maxIterations", "spark.sql.optimizer.maxIterations"):
        if int(conf.get(key, "100")) < need:
            conf.set(key, str(need))


def _with_fallback(df: DataFrame, text_col: str, source_col: str, opts: DecodeOptions, by_name: bool = False) -> DataFrame:
    """Re-decode, with the Arrow UDF, only texts that hit the depth limit.

    The UDF sees NULL for every other row, so the Python side does work
    only for the deep ones; the native decode is not repeated.
    """
    if opts.deep_fallback not in ("udf", "route"):
        return df
    deep = A.has_marker(F.col(text_col), A.DEEP)
    fixed = deep_image_udf(opts.strict_types, by_name)(F.when(deep, F.col(source_col)))
    return df.withColumn(text_col, F.when(deep, F.coalesce(fixed, F.lit(A.BAD))).otherwise(F.col(text_col)))


def _value_problem(texts: list[Column]) -> Column:
    joined = F.concat_ws("", *texts)
    return F.when(A.has_marker(joined, A.BAD), F.lit(ERR_BAD_VALUE)).when(
        A.has_marker(joined, A.DEEP), F.lit(ERR_TOO_DEEP)
    )


def decode_change_bodies(df: DataFrame, body_col: str, opts: DecodeOptions) -> DataFrame:
    """Add ``_ts, _keys, _new, _old, _size, _reason`` for a column of parsed bodies (``BODY``).

    ``_reason`` is NULL for a good record; for a bad one every other added
    field is NULL. An absent image is ``{}``.
    """
    ensure_planner_room(df, opts)
    body_ok = F.col(body_col).isNotNull()
    b = F.col(body_col)
    staged = df.select(
        "*",
        body_ok.alias("_body_ok"),
        F.when(body_ok, b).alias("_b"),
    ).select(
        "*",
        F.col("_b.Keys").alias("_keys_txt"),
        F.col("_b.NewImage").alias("_new_txt"),
        F.col("_b.OldImage").alias("_old_txt"),
    )
    decoded = staged.withColumn("_texts", A.decode_maps(("_keys_txt", "_new_txt", "_old_txt"), opts, sorted_first=True))
    decoded = decoded.select(
        "*",
        F.col("_texts")[0].alias("_k"),
        F.col("_texts")[1].alias("_n"),
        F.col("_texts")[2].alias("_o"),
    ).drop("_texts")
    for text_col, source_col in (("_k", "_keys_txt"), ("_n", "_new_txt"), ("_o", "_old_txt")):
        decoded = _with_fallback(decoded, text_col, source_col, opts, by_name=text_col == "_k")
    keys_absent = F.col("_b.Keys").isNull()
    keys_text = F.when(keys_absent, F.lit("{}")).otherwise(F.coalesce("_k", F.lit(A.BAD)))
    new_text = F.when(F.col("_new_txt").isNull(), F.lit("{}")).otherwise(F.coalesce("_n", F.lit(A.BAD)))
    old_text = F.when(F.col("_old_txt").isNull(), F.lit("{}")).otherwise(F.coalesce("_o", F.lit(A.BAD)))
    checked = decoded.select(
        "*",
        keys_text.alias("_k1"),
        new_text.alias("_n1"),
        old_text.alias("_o1"),
    )
    reason = (
        F.when(~F.col("_body_ok"), F.lit(ERR_NO_BODY))
        .when(keys_absent & F.lit(not opts.allow_empty_keys), F.lit(ERR_NO_KEYS))
        .otherwise(_value_problem([F.col("_k1"), F.col("_n1"), F.col("_o1")]))
    )
    ok = F.col("_reason").isNull()
    # A row that is only too deep keeps keys, timestamp and size; a job
    # decodes it again from its raw text once its batch is staged.
    keep = ok | (F.col("_reason") == ERR_TOO_DEEP) & F.lit(opts.deep_fallback == "repair")
    return (
        checked.withColumn("_reason", reason)
        .select(
            "*",
            F.when(keep, whole_number(F.col("_b.ApproximateCreationDateTime"), "bigint")).alias("_ts"),
            F.when(keep, F.col("_k1")).alias("_keys"),
            F.when(ok, F.col("_n1")).alias("_new"),
            F.when(ok, F.col("_o1")).alias("_old"),
            F.when(keep, whole_number(F.col("_b.SizeBytes"), "int")).alias("_size"),
        )
        .drop("_body_ok", "_b", "_keys_txt", "_new_txt", "_old_txt", "_k", "_n", "_o", "_k1", "_n1", "_o1")
    )


def decode_export_items(df: DataFrame, item_col: str, key_names: tuple[str, ...], opts: DecodeOptions) -> DataFrame:
    """Add ``_keys, _new, _reason`` for a column of ``Item`` texts.

    Keys hold the configured attributes only, sorted by name and decoded by
    the same decoder instance as the item, so they equal keys decoded from
    change records whatever order the names were configured in.
    """
    ensure_planner_room(df, opts)
    item = F.col(item_col)
    item_ok = is_object_text(item)
    staged = df.select("*", F.when(item_ok, item).alias("_item_txt"), A.key_map(item_col, tuple(key_names)).alias("_key_map"))
    # one parse gives both the keys object and the check that every key is there
    staged = staged.select(
        "*",
        F.coalesce(F.size("_key_map") < F.lit(len(set(key_names))), F.lit(True)).alias("_key_missing"),
        F.to_json("_key_map").alias("_keys_txt"),
    ).drop("_key_map")
    decoded = staged.withColumn("_texts", A.decode_maps(("_keys_txt", "_item_txt"), opts, sorted_first=True))
    decoded = decoded.select("*", F.col("_texts")[0].alias("_k"), F.col("_texts")[1].alias("_n")).drop("_texts")
    for text_col, source_col in (("_k", "_keys_txt"), ("_n", "_item_txt")):
        decoded = _with_fallback(decoded, text_col, source_col, opts, by_name=text_col == "_k")
    reason = (
        F.when(F.col("_item_txt").isNull(), F.lit(ERR_NO_ITEM))
        .when(F.col("_key_missing"), F.lit(ERR_MISSING_KEY))
        .otherwise(_value_problem([F.coalesce("_k", F.lit(A.BAD)), F.coalesce("_n", F.lit(A.BAD))]))
    )
    ok = F.col("_reason").isNull()
    keep = ok | (F.col("_reason") == ERR_TOO_DEEP) & F.lit(opts.deep_fallback == "repair")
    return (
        decoded.withColumn("_reason", reason)
        .select("*", F.when(keep, F.col("_k")).alias("_keys"), F.when(ok, F.col("_n")).alias("_new"))
        .drop("_item_txt", "_key_missing", "_keys_txt", "_k", "_n")
    )


def is_too_deep(error: Column) -> Column:
    """The row's only problem was nesting deeper than the native decoder goes."""
    return F.coalesce(error.startswith(F.lit(f'{{"error":"{ERR_TOO_DEEP}"')), F.lit(False))


def error_json(reason: Column, data: Column) -> Column:
    """``{"error": reason, "data": text}`` or NULL when there is no error."""
    return F.when(reason.isNotNull(), F.to_json(F.struct(reason.alias("error"), data.alias("data"))))
