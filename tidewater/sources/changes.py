"""Change-stream and export sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidewater.config import BulkConfig, StreamConfig


def read_change_stream(spark: SparkSession, cfg: StreamConfig) -> DataFrame:
    """A streaming frame of change records, one text column.

    Any Structured Streaming source fits (``kafka``, ``kinesis`` where the
    connector is installed, ``text`` files in tests); a source with more
    than one column must be narrowed with ``source_column``. Kafka is read
    from the earliest offset unless the options say otherwise.
    """
    options = {"startingOffsets": "earliest"} if cfg.source_format == "kafka" else {}
    reader = spark.readStream.format(cfg.source_format).options(**{**options, **cfg.source_options})
    df = reader.load(cfg.source_path) if cfg.source_path else reader.load()
    if cfg.source_format == "kafka":
        df = df.selectExpr("CAST(value AS STRING) AS value")
    elif cfg.source_column:
        df = df.select(df[cfg.source_column].cast("string").alias("value"))
    return df


def read_export(spark: SparkSession, cfg: BulkConfig) -> DataFrame:
    """Every line of every file under ``<export>/data/`` (gzip is read transparently).

    Read as text: the export is parsed once, by the decoder, with nothing
    inferred (inference would drop attributes that are only ever empty
    maps and reorder the rest, and would scan the export twice).
    """
    return spark.read.option("recursiveFileLookup", "true").text(cfg.data_path)
