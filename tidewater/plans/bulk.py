"""Bulk load of a full table export into the target."""

from __future__ import annotations

import time
import uuid

from pyspark.sql import DataFrame, SparkSession

from tidewater.config import BulkConfig, DecodeOptions
from tidewater.operators.files import remove_path
from tidewater.operators.normalize import normalize_export
from tidewater.operators.upsert import PASS_BYTES, upsert
from tidewater.plans.batch import deep_repair, logged, looked_up, staged_options
from tidewater.session import apply_job_conf, checkpoint_dir
from tidewater.sources.changes import read_export
from tidewater.sources.lookup import follow_files, lookup_bytes


def _decoded(lines: DataFrame, cfg: BulkConfig, load_time: int | None, opts: DecodeOptions) -> DataFrame:
    return normalize_export(lines, cfg.key_names, cfg.table_name, cfg.run_id, load_time, opts=opts)


def _looked_up(rows: DataFrame, cfg: BulkConfig, work: str | None = None) -> DataFrame:
    return rows if cfg.lookup is None else looked_up(rows.sparkSession, rows, cfg.lookup, work)


def bulk_rows(spark: SparkSession, cfg: BulkConfig, lines: DataFrame | None = None) -> DataFrame:
    """Export lines -> target rows (no dedup: an export holds each key once)."""
    lines = read_export(spark, cfg) if lines is None else lines
    return _looked_up(_decoded(lines, cfg, cfg.load_time_millis, cfg.decode), cfg)


def run_bulk(spark: SparkSession, cfg: BulkConfig, lines: DataFrame | None = None) -> None:
    """Load the export into the target, the change log or both; the run id names the batch, so a rerun is safe."""
    apply_job_conf(spark)
    if cfg.lookup is not None and cfg.lookup.follow is not None:
        follow_files(spark, cfg.lookup)
    lines = read_export(spark, cfg) if lines is None else lines
    # One load time for all rows, also for those decoded again after staging.
    load_time = cfg.load_time_millis if cfg.load_time_millis is not None else int(time.time()) * 1000
    again = lambda texts, opts: _decoded(texts, cfg, load_time, opts)
    work = f"{checkpoint_dir(spark)}/tidewater-lookup/{uuid.uuid4().hex}"
    rows = _decoded(lines, cfg, load_time, staged_options(cfg.decode))
    if cfg.change_log is not None:
        rows = logged(spark, rows, cfg.change_log, f"bulk-{cfg.table_name}", cfg.run_id, cfg.decode, again)
        if cfg.target is None:
            return
    if cfg.lookup is not None and cfg.lookup.multi == "array" and cfg.target.layout == "buckets":
        # One row for each row given, so the key check needs no lookup: staged first, looked up on the way into the target.
        upsert(
            spark,
            rows,
            cfg.target,
            batch_id=cfg.run_id,
            run_key="bulk",
            repair=deep_repair(cfg.decode, again),
            lookup=lambda rows: _looked_up(rows, cfg),
            pass_bytes=max(PASS_BYTES, lookup_bytes(spark, cfg.lookup.path)),
        )
        return
    upsert(
        spark,
        _looked_up(rows, cfg, f"{work}/rows"),
        cfg.target,
        batch_id=cfg.run_id,
        run_key="bulk",
        repair=deep_repair(cfg.decode, again, lambda rows: _looked_up(rows, cfg, f"{work}/deep")),
    )
    if cfg.lookup is not None:
        remove_path(spark, work)
