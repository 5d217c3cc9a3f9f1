"""Lookup files: JSON records kept whole, keyed by the URI of their file.

A large store is prepared once as a table partitioned by a hash of the URI
(``prepare_lookup``, which later adds new records); a batch then reads only
the partitions its own URIs name. ``follow_files`` keeps such a table up to
date with a folder of JSON files, reading each file once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.config import LookupConfig
from tidewater.operators.files import child_names, folder_bytes, make_folder


def lookup_bytes(spark: SparkSession, path: str) -> int:
    """Total size of the files under ``path`` (from the file system, no job)."""
    return int(folder_bytes(spark, path))


PART = "lookup_part"
PARTS_MARK = "_tidewater_lookup_parts="


def lookup_part(uri, parts: int):
    """The partition of a URI in a prepared lookup."""
    return F.pmod(F.xxhash64(uri), F.lit(parts)).cast("int")


def prepared_parts(spark: SparkSession, path: str) -> int | None:
    """The number of partitions a prepared lookup was made with; None if there is none at ``path``."""
    found = [n for n in child_names(spark, path) if n.startswith(PARTS_MARK)]
    return int(found[0].removeprefix(PARTS_MARK)) if found else None


def prepare_lookup(lookup: DataFrame, path: str, parts: int) -> None:
    """Adds ``(s3_uri, raw_s3_payload)`` rows to the prepared lookup at ``path``, making it on first use."""
    _make_parts(lookup.sparkSession, path, parts)
    _in_parts(lookup, parts).write.mode("append").partitionBy(PART).parquet(path)


def _make_parts(spark: SparkSession, path: str, parts: int) -> None:
    held = prepared_parts(spark, path)
    if held is None:
        make_folder(spark, f"{path}/{PARTS_MARK}{parts}")
    elif held != parts:
        raise ValueError(f"lookup {path} has {held} partitions, not {parts}")


def _in_parts(lookup: DataFrame, parts: int) -> DataFrame:
    rows = lookup.select("s3_uri", "raw_s3_payload", lookup_part(F.col("s3_uri"), parts).alias(PART))
    return rows.hint("rebalance", PART)


ADDED = "added"


def follow_files(spark: SparkSession, cfg: LookupConfig) -> None:
    """Adds the JSON files that came to ``cfg.follow`` since the last call to the prepared lookup at ``cfg.path``.

    A file stream keeps the names of the files it has read in its checkpoint
    (inside the lookup's folder), so each file is read once; a changed file
    is not read again. Each of its batches writes subfolders of its own
    number and a batch repeated after a crash replaces them, so no record is
    added twice. One caller at a time.
    """
    _make_parts(spark, cfg.path, cfg.parts)

    def add(files: DataFrame, batch_id: int) -> None:
        rows = _in_parts(files, cfg.parts).withColumn(ADDED, F.lit(batch_id))
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(PART, ADDED).parquet(cfg.path)

    lines = spark.readStream.option("recursiveFileLookup", "true").text(cfg.follow)
    records = _file_records(lines, cfg.verbatim)
    query = records.writeStream.foreachBatch(add).option("checkpointLocation", f"{cfg.path}/_follow").trigger(availableNow=True).start()
    query.awaitTermination()


def named_parts(uris: DataFrame, parts: int) -> list[int]:
    """The partitions of the URIs (one column ``uri``, nulls name none): at most ``parts`` small integers."""
    named = uris.filter("uri IS NOT NULL").select(lookup_part(F.col("uri"), parts).alias(PART)).distinct()
    return sorted(r[PART] for r in named.collect())


def may_broadcast(spark: SparkSession, cfg: LookupConfig) -> bool:
    """Broadcast only a lookup whose size on disk is within the configured bound."""
    return cfg.broadcast and lookup_bytes(spark, cfg.path) <= cfg.broadcast_limit_bytes


def read_lookup(spark: SparkSession, cfg: LookupConfig, uris: DataFrame | None = None) -> DataFrame:
    """``(s3_uri, raw_s3_payload)`` rows, one per lookup record.

    ``uris`` (one column ``uri``) are those a batch asks for; of a prepared
    lookup only the partitions they name are listed and read. It is read
    once here, so it should be a written table.

    JSON files are read as text: one record per line, no schema inference
    pass, no attribute lost to inference. The payload is the record's
    canonical JSON text (or the line itself with ``verbatim``); a line that
    is not JSON is kept as ``{"_corrupt_record": line}`` like Spark's JSON
    reader does. The URI is the file's URI as ``input_file_name()`` gives it.
    """
    if cfg.format == "partitioned":
        parts = prepared_parts(spark, cfg.path)
        if parts is None:
            raise ValueError(f"no prepared lookup at {cfg.path}")
        named = {f"{PART}={n}" for n in (range(parts) if uris is None else named_parts(uris, parts))}
        folders = [f"{cfg.path}/{name}" for name in child_names(spark, cfg.path) if name in named]
        if not folders:
            return spark.createDataFrame([], "s3_uri string, raw_s3_payload string")
        # Followed files lie one level deeper; their batch number is no column.
        return spark.read.schema("s3_uri string, raw_s3_payload string").option("recursiveFileLookup", "true").parquet(*folders)
    if cfg.format == "parquet":
        return spark.read.parquet(cfg.path).select("s3_uri", "raw_s3_payload")
    return _file_records(spark.read.text(cfg.path), cfg.verbatim)


def _file_records(lines: DataFrame, verbatim: bool) -> DataFrame:
    lines = lines.select(F.input_file_name().alias("s3_uri"), F.col("value"))
    lines = lines.filter(F.trim("value") != "")
    if verbatim:
        payload = F.col("value")
    else:
        parsed = F.try_parse_json("value")
        payload = F.when(parsed.isNotNull(), F.to_json(parsed)).otherwise(
            F.to_json(F.struct(F.col("value").alias("_corrupt_record")))
        )
    return lines.select("s3_uri", payload.alias("raw_s3_payload"))
