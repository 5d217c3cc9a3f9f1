"""File sink: an append-only log of normalised changes, as Parquet."""

from __future__ import annotations

from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.schemas import TARGET_SCHEMA


def change_date() -> F.Column:
    return F.to_date(F.timestamp_millis(F.col("approx_creation_timestamp_millis")))


def write_change_log(df: DataFrame, path: str, batch_id: int | str | None = None) -> None:
    """Add rows to ``path``, partitioned by the UTC date of the change.

    Rows without a timestamp (parse errors) land in the NULL date folder.
    With ``batch_id`` (``foreachBatch``) the rows go to a folder of that
    batch, which a replay overwrites; without, they are appended. The
    rebalance by date keeps the number of files near the number of dates and
    lets AQE split a large date. Readers prune by ``change_date``.
    """
    writer = df.withColumn("change_date", change_date()).hint("rebalance", "change_date").write.partitionBy("change_date")
    if batch_id is None:
        writer.mode("append").parquet(path)
    else:
        writer.mode("overwrite").option("partitionOverwriteMode", "static").parquet(batch_folder(path, batch_id))


def batch_folder(path: str, batch_id: int | str) -> str:
    """The folder of one batch; an id's characters that a path can't hold are escaped as Spark reads them back."""
    return f"{path}/batch={quote(str(batch_id), safe='')}"


def read_change_log(spark: SparkSession, path: str) -> DataFrame:
    """The log's rows (target columns) with the ``batch`` (string) that wrote them and their ``change_date``."""
    schema = f"{', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in TARGET_SCHEMA.fields)}, batch string, change_date date"
    return spark.read.schema(schema).parquet(path)


def change_log_stream(df: DataFrame, path: str, checkpoint_location: str, trigger_interval: str | None = None):
    """Streaming form of the same sink (exactly-once through the file sink log)."""
    writer = (
        df.withColumn("change_date", change_date())
        .writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint_location)
        .partitionBy("change_date")
    )
    if trigger_interval:
        writer = writer.trigger(processingTime=trigger_interval)
    return writer.start()
