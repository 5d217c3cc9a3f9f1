import json
import os
import re

import pytest
from pyspark.sql import functions as F

from helpers import record
from tidewater.config import DecodeOptions, StreamConfig, TargetConfig
from tidewater.operators.latest import latest_per_key
from tidewater.operators.normalize import normalize_changes
from tidewater.operators.upsert import read_target
from tidewater.plans import feeds
from tidewater.streaming.job import run_stream

from conftest import SF


def change(key, ts, event_id):
    return record({"ApproximateCreationDateTime": ts, "Keys": {"id": {"S": key}}, "NewImage": {"v": {"N": str(ts)}}},
                  event_id=event_id)


def test_stream_replay_and_restart(spark, tmp_dir):
    src = f"{tmp_dir}/src"
    os.makedirs(src)
    with open(f"{src}/1.txt", "w") as f:
        f.write("\n".join([change("a", 1, "e1"), change("b", 1, "e2")]) + "\n")
    cfg = StreamConfig(source_format="text", source_path=src, source_options={"maxFilesPerTrigger": "1"},
                       target=TargetConfig(path=f"{tmp_dir}/t", buckets=2, order_guard=True),
                       checkpoint_location=f"{tmp_dir}/ckpt", available_now=True)
    q = run_stream(spark, cfg)
    q.awaitTermination()
    assert q.exception() is None
    with open(f"{src}/2.txt", "w") as f:
        f.write(change("a", 5, "e3") + "\n")
    with open(f"{src}/3.txt", "w") as f:
        f.write("")  # an empty file is an empty batch
    q = run_stream(spark, cfg)  # restart from the checkpoint: only new files
    q.awaitTermination()
    assert q.exception() is None
    rows = {r["keys"]: r["event_id"] for r in read_target(spark, cfg.target).collect()}
    assert rows == {'{"id": "a"}': "e3", '{"id": "b"}': "e2"}


def test_stream_input_must_have_one_column(spark, tmp_dir):
    cfg = StreamConfig(source_format="rate", target=TargetConfig(path=f"{tmp_dir}/t"),
                       checkpoint_location=f"{tmp_dir}/ckpt", trigger_interval=None)
    with pytest.raises(ValueError, match="exactly one column"):
        run_stream(spark, cfg)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_latest_is_limited_before_the_shuffle(spark):
    feed = feeds.change_feed(spark, SF).select("value")
    df = latest_per_key(normalize_changes(feed, opts=DecodeOptions(deep_fallback="error")))
    plan = _plan(df)
    lines = [ln.strip(" +-:") for ln in plan.split("\n") if "WindowGroupLimit" in ln or "Exchange" in ln]
    # final limit, the shuffle on the window key, then the partial limit below it
    i = next(n for n, ln in enumerate(lines) if ln.startswith("Exchange hashpartitioning(_w0"))
    assert lines[i - 1].startswith("WindowGroupLimit") and lines[i - 1].endswith("Final"), lines
    assert lines[i + 1].startswith("WindowGroupLimit") and lines[i + 1].endswith("Partial"), lines
    assert "ArrowEvalPython" not in plan and "BatchEvalPython" not in plan


def test_decode_is_not_copied_into_filters(spark):
    feed = feeds.change_feed(spark, SF).select("value")
    df = latest_per_key(normalize_changes(feed))
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    # the decoder's outer transform over (keys, new, old) appears exactly once
    assert plan.count("transform(array(") == 1, plan[:2000]


def test_target_read_prunes_buckets_and_columns(spark, tmp_dir):
    from tidewater.plans.batch import apply_change_batch

    target = TargetConfig(path=f"{tmp_dir}/t", buckets=4)
    apply_change_batch(spark, spark.createDataFrame([(change(str(i), 1, f"e{i}"),) for i in range(20)], "value string"),
                       target, batch_id=0)
    df = read_target(spark, target).filter(F.col("bucket").isin([1, 2])).select("keys")
    plan = _plan(df)
    assert re.search(r"PartitionFilters: \[bucket#\d+ IN \(1,2\)\]", plan), plan
    assert "ReadSchema: struct<keys:string>" in plan


def test_stream_over_same_files_twice_leaves_target_unchanged(spark, tmp_dir):
    src = f"{tmp_dir}/src"
    os.makedirs(src)
    with open(f"{src}/1.txt", "w") as f:
        f.write("\n".join([change("a", 1, "e1"), change("a", 2, "e2"), "{bad"]) + "\n")
    target = TargetConfig(path=f"{tmp_dir}/t", buckets=2)
    snapshots = []
    for run in ("first", "second"):
        cfg = StreamConfig(source_format="text", source_path=src, target=target,
                           checkpoint_location=f"{tmp_dir}/ckpt-{run}", available_now=True)
        q = run_stream(spark, cfg)
        q.awaitTermination()
        assert q.exception() is None
        snapshots.append(sorted(((r["keys"], r["event_id"], r["error"]) for r in read_target(spark, target).collect()), key=repr))
    assert snapshots[0] == snapshots[1] and len(snapshots[0]) == 2


def test_processing_time_trigger_and_change_log_stream(spark, tmp_dir):
    from tidewater.operators.normalize import normalize_changes as norm
    from tidewater.sinks.changelog import change_log_stream

    src = f"{tmp_dir}/src"
    os.makedirs(src)
    with open(f"{src}/1.txt", "w") as f:
        f.write("\n".join([change("a", 1, "e1"), change("b", 86_400_000 * 3, "e2")]) + "\n")
    cfg = StreamConfig(source_format="text", source_path=src, target=TargetConfig(path=f"{tmp_dir}/t", buckets=2),
                       checkpoint_location=f"{tmp_dir}/ckpt", trigger_interval="1 second")
    q = run_stream(spark, cfg)
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    assert read_target(spark, cfg.target).count() == 2
    # the file sink as a stream: normalised changes appended, partitioned by change date
    stream = spark.readStream.format("text").load(src)
    log = change_log_stream(norm(stream), f"{tmp_dir}/log", f"{tmp_dir}/log-ckpt", trigger_interval="1 second")
    try:
        log.processAllAvailable()
    finally:
        log.stop()
    dates = sorted(str(r["change_date"]) for r in spark.read.parquet(f"{tmp_dir}/log").collect())
    assert dates == ["1970-01-01", "1970-01-04"]
