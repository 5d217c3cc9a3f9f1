"""The streaming job: change records -> foreachBatch(upsert, change log or both)."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tidewater.config import StreamConfig
from tidewater.operators.normalize import single_text_column
from tidewater.plans.batch import apply_change_batch
from tidewater.session import apply_job_conf
from tidewater.sources.changes import read_change_stream


def batch_function(cfg: StreamConfig):
    """The ``foreachBatch`` callback.

    An empty batch does nothing (``isEmpty`` stops at the first row, unlike
    a count). The batch id names the batch's work folders, so a batch that
    Spark replays after a failure is merged the same way again.
    """
    run_key = hashlib.sha1(cfg.checkpoint_location.encode("utf-8")).hexdigest()[:16]

    def process(batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():
            return
        apply_change_batch(
            batch.sparkSession,
            batch,
            cfg.target,
            batch_id=batch_id,
            lookup=cfg.lookup,
            decode=cfg.decode,
            collapse_errors=cfg.collapse_errors,
            run_key=run_key,
            change_log=cfg.change_log,
        )

    return process


def run_stream(spark: SparkSession, cfg: StreamConfig, source: DataFrame | None = None) -> StreamingQuery:
    """Start the job; returns the running query.

    The input must have exactly one column (the record text); this is
    checked before the query starts.
    """
    apply_job_conf(spark)
    stream = read_change_stream(spark, cfg) if source is None else source
    single_text_column(stream)
    writer = stream.writeStream.foreachBatch(batch_function(cfg)).option("checkpointLocation", cfg.checkpoint_location)
    if cfg.query_name:
        writer = writer.queryName(cfg.query_name)
    if cfg.available_now:
        writer = writer.trigger(availableNow=True)
    elif cfg.trigger_interval:
        writer = writer.trigger(processingTime=cfg.trigger_interval)
    return writer.start()
