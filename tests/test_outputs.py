"""The jobs' change log, alone and beside a target, and lookups that follow a folder of files."""

import json
import os

import pytest
from pyspark.sql import functions as F

from helpers import record
from tidewater.config import BulkConfig, DecodeOptions, LookupConfig, StreamConfig, TargetConfig
from tidewater.jobs import configs
from tidewater.operators.upsert import read_target
from tidewater.plans import batch as B
from tidewater.plans.bulk import run_bulk
from tidewater.sinks.changelog import read_change_log
from tidewater.sources import lookup as L
from tidewater.streaming.job import run_stream


def change(key, ts, levels=0, uri=None):
    value = {"S": f"{key}{ts}"}
    for _ in range(levels):
        value = {"M": {"d": value}}
    image = {"id": {"S": key}, "v": value} | ({"s3_uri": {"S": uri}} if uri else {})
    return (record({"ApproximateCreationDateTime": ts, "Keys": {"id": {"S": key}}, "NewImage": image}, event_id=f"{key}{ts}"),)


def changes(spark, rows):
    return spark.createDataFrame(rows, "value string")


DAY = 86_400_000
ROWS = [change("a", DAY), change("a", 2 * DAY, 12), change("b", DAY), ("{bad",)]


def logged_ids(spark, log):
    return sorted((r.event_id or "", r.has_parsing_error) for r in read_change_log(spark, log).collect())


def test_log_and_target_of_one_batch(spark, tmp_dir):
    """The log holds every change, deep ones decoded; the target the latest; a replay changes neither."""
    target, log = TargetConfig(path=f"{tmp_dir}/t", buckets=2), f"{tmp_dir}/log"
    for _ in range(2):
        B.apply_change_batch(spark, changes(spark, ROWS), target, batch_id=0, change_log=log)
    rows = read_change_log(spark, log)
    assert logged_ids(spark, log) == [("", True), ("a172800000", False), ("a86400000", False), ("b86400000", False)]
    assert {(r.event_id, str(r.change_date)) for r in rows.collect()} == {(None, "None"), ("a172800000", "1970-01-03"), ("a86400000", "1970-01-02"), ("b86400000", "1970-01-02")}
    assert "a172800000" in rows.filter("event_id = 'a172800000'").first().new_image
    assert sorted(r.event_id or "" for r in read_target(spark, target).collect()) == ["", "a172800000", "b86400000"]
    B.apply_change_batch(spark, changes(spark, ROWS[:1]), target, batch_id=1, change_log=log)
    assert rows.sparkSession.read.parquet(log).groupBy("batch").count().count() == 2


def test_records_are_decoded_once(spark, tmp_dir, monkeypatch):
    """The target's rows come from the log, not from a second pass over the records."""
    seen = []
    monkeypatch.setattr(B, "latest_per_key", lambda rows, **kw: seen.append(rows) or rows)
    target = TargetConfig(path=f"{tmp_dir}/t", buckets=2, check_unique=False)
    B.apply_change_batch(spark, changes(spark, ROWS[2:]), target, batch_id=0, change_log=f"{tmp_dir}/log")
    assert all(f"{tmp_dir}/log/batch=" in f for f in seen[0].inputFiles()) and seen[0].inputFiles()


def test_replay_after_a_crash_between_the_outputs(spark, tmp_dir, monkeypatch):
    target, log = TargetConfig(path=f"{tmp_dir}/t", buckets=2), f"{tmp_dir}/log"

    def fail(*args, **kwargs):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(B, "upsert", fail)
        with pytest.raises(RuntimeError, match="lost"):
            B.apply_change_batch(spark, changes(spark, ROWS), target, batch_id=0, change_log=log)
    B.apply_change_batch(spark, changes(spark, ROWS), target, batch_id=0, change_log=log)
    assert len(logged_ids(spark, log)) == 4 and read_target(spark, target).count() == 3


@pytest.mark.parametrize("fallback", ["error", "udf"])
def test_log_with_other_fallbacks(spark, tmp_dir, fallback):
    B.apply_change_batch(spark, changes(spark, ROWS), None, batch_id=0, decode=DecodeOptions(deep_fallback=fallback), change_log=f"{tmp_dir}/log")
    assert dict(logged_ids(spark, f"{tmp_dir}/log"))["a172800000"] == (fallback == "error")


def test_stream_into_the_log_only(spark, tmp_dir):
    cfg = StreamConfig(source_format="text", source_path=f"{tmp_dir}/in/*", target=None, checkpoint_location=f"{tmp_dir}/ckpt", available_now=True, change_log=f"{tmp_dir}/log")
    for run in (1, 2):
        changes(spark, [change("a", run)]).write.text(f"{tmp_dir}/in/{run}")
        run_stream(spark, cfg).awaitTermination()
    assert logged_ids(spark, cfg.change_log) == [("a1", False), ("a2", False)]


def test_bulk_into_both(spark, tmp_dir):
    lines = [json.dumps({"Item": {"id": {"N": str(i)}}}) for i in range(3)] + ["{bad"]
    cfg = BulkConfig(export_path=f"{tmp_dir}/x", table_name="t", key_names="id", run_id="run/1=a", load_time_millis=0,
                     target=TargetConfig(path=f"{tmp_dir}/t", buckets=2), change_log=f"{tmp_dir}/log")
    for _ in range(2):
        run_bulk(spark, cfg, changes(spark, [(t,) for t in lines]))
    log = read_change_log(spark, cfg.change_log)
    assert log.count() == 4 and {r.batch for r in log.collect()} == {"bulk-t-run/1=a"}
    assert read_target(spark, cfg.target).count() == 4


def test_outputs_from_the_command_line():
    stream = ["stream", "--source-format", "text", "--checkpoint", "/c"]
    both = [*stream, "--target-path", "/t", "--S3OutputPath", "/log"]
    outputs = lambda argv: (lambda cfg: (cfg.target and cfg.target.path, cfg.change_log))(configs(argv)[1])
    assert outputs(both) == ("/t", "/log")
    assert outputs([*both, "--OutputMode", "S3"]) == (None, "/log")
    assert outputs([*both, "--output-mode", "target"]) == ("/t", None)
    assert outputs([*stream, "--change-log", "/log"]) == (None, "/log")
    assert outputs([*stream, "--target-path", "/t"]) == ("/t", None)
    for wrong in ([*stream, "--target-path", "/t", "--output-mode", "files"], stream, [*both, "--output-mode", "none"]):
        with pytest.raises((ValueError, SystemExit)):
            configs(wrong)
    lookup = configs([*both, "--lookup-path", "/lk", "--lookup-follow", "/files", "--lookup-parts", "8"])[1].lookup
    assert (lookup.format, lookup.follow, lookup.parts) == ("partitioned", "/files", 8)


def put(folder, name, *records):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}", "w") as f:
        f.write("\n".join(json.dumps(r) for r in records) + "\n")
    return f"file://{folder}/{name}"


def test_followed_files_are_read_once(spark, tmp_dir):
    cfg = LookupConfig(path=f"{tmp_dir}/lk", format="partitioned", follow=f"{tmp_dir}/files", parts=4)
    one = put(cfg.follow, "one.json", {"n": 1}, {"n": 2})
    L.follow_files(spark, cfg)
    L.follow_files(spark, cfg)
    before = set(L.read_lookup(spark, cfg).inputFiles())
    two = put(f"{cfg.follow}/deeper", "two.json", {"n": 3})
    L.follow_files(spark, cfg)
    found = L.read_lookup(spark, cfg)
    assert sorted((r.s3_uri, r.raw_s3_payload) for r in found.collect()) == sorted([(one, '{"n":1}'), (one, '{"n":2}'), (two, '{"n":3}')])
    added = spark.read.parquet(*(set(found.inputFiles()) - before))
    assert [r.s3_uri for r in added.collect()] == [two]
    assert found.columns == ["s3_uri", "raw_s3_payload"]
    # Records put there by hand stand beside followed ones.
    L.prepare_lookup(spark.createDataFrame([("u", "{}")], "s3_uri string, raw_s3_payload string"), cfg.path, 4)
    assert L.read_lookup(spark, cfg).count() == 4


def test_a_repeated_batch_of_files_adds_nothing_twice(spark, tmp_dir):
    """The stream's commit of its last batch is lost: the batch runs again and replaces its own files."""
    cfg = LookupConfig(path=f"{tmp_dir}/lk", format="partitioned", follow=f"{tmp_dir}/files", parts=2)
    put(cfg.follow, "one.json", {"n": 1})
    L.follow_files(spark, cfg)
    commits = f"{cfg.path}/_follow/commits"
    for name in ("0", ".0.crc"):
        if os.path.exists(f"{commits}/{name}"):
            os.remove(f"{commits}/{name}")
    L.follow_files(spark, cfg)
    assert L.read_lookup(spark, cfg).count() == 1


def test_batches_see_files_that_came_since(spark, tmp_dir):
    cfg = LookupConfig(path=f"{tmp_dir}/lk", format="partitioned", follow=f"{tmp_dir}/files", parts=2, multi="array")
    target = TargetConfig(path=f"{tmp_dir}/t", buckets=2, with_lookup=True)
    uri = put(cfg.follow, "one.json", {"n": 1}, {"n": 2})
    later = f"file://{cfg.follow}/later.json"
    B.apply_change_batch(spark, changes(spark, [change("a", 1, 0, uri), change("b", 1, 0, later)]), target, batch_id=0, lookup=cfg)
    stored = lambda: {json.loads(r["keys"])["id"]: r.raw_s3_payload for r in read_target(spark, target).select("keys", F.regexp_replace("raw_s3_payload", " ", "").alias("raw_s3_payload")).collect()}
    assert stored() == {"a": '[{"n":1},{"n":2}]', "b": "{}"}
    put(cfg.follow, "later.json", {"n": 3})
    B.apply_change_batch(spark, changes(spark, [change("b", 2, 0, later)]), target, batch_id=1, lookup=cfg)
    assert stored() == {"a": '[{"n":1},{"n":2}]', "b": '[{"n":3}]'}


def test_output_and_follow_settings_are_checked():
    with pytest.raises(ValueError, match="change_log"):
        StreamConfig(source_format="text", target=None, checkpoint_location="/c")
    with pytest.raises(ValueError, match="lookup join"):
        StreamConfig(source_format="text", target=None, checkpoint_location="/c", change_log="/l", lookup=LookupConfig(path="/x"))
    with pytest.raises(ValueError, match="follow"):
        LookupConfig(path="/x", follow="/y")
