import json

import pytest
from pyspark.sql import functions as F

from helpers import record
from tidewater.config import TargetConfig
from tidewater.functions.keys import merge_key
from tidewater.operators.latest import latest_per_key
from tidewater.operators.normalize import normalize_changes
from tidewater.operators.upsert import read_target, upsert
from tidewater.plans.batch import apply_change_batch, stage_changes


def change(key, ts, event_id, name="MODIFY", value="v"):
    body = {"ApproximateCreationDateTime": ts, "Keys": {"id": {"S": key}}, "SizeBytes": 10}
    if name != "REMOVE":
        body["NewImage"] = {"id": {"S": key}, "value": {"S": value}}
    return record(body, event_id=event_id, name=name)


def frame(spark, texts):
    return spark.createDataFrame([(t,) for t in texts], "value string")


def target_rows(spark, target):
    return {r["keys"]: r.asDict() for r in read_target(spark, target).collect()}


def test_latest_keeps_newest_and_breaks_ties_by_event_id(spark):
    texts = [change("a", 1, "e1"), change("a", 3, "e2"), change("a", 2, "e3"),
             change("b", 5, "e4"), change("b", 5, "e5")]
    rows = latest_per_key(normalize_changes(frame(spark, texts))).collect()
    got = {json.loads(r["keys"])["id"]: r["event_id"] for r in rows}
    assert got == {"a": "e2", "b": "e5"}


def test_latest_keeps_every_error_row(spark):
    texts = [change("a", 1, "e1"), "{bad1", "{bad2", "{bad2", record({"Keys": {"k": {"X": 1}}}, event_id="x")]
    rows = latest_per_key(normalize_changes(frame(spark, texts))).collect()
    errors = [r for r in rows if r["has_parsing_error"]]
    # identical bad records are one record; distinct ones are all kept
    assert len(errors) == 3 and len(rows) == 4
    collapsed = latest_per_key(normalize_changes(frame(spark, texts)), collapse_errors=True).collect()
    assert len([r for r in collapsed if r["has_parsing_error"]]) == 1


def test_merge_key_is_keys_or_error_fingerprint(spark):
    rows = normalize_changes(frame(spark, [change("a", 1, "e1"), "{bad"])).select(merge_key().alias("mk"), "keys").collect()
    keyed = [r for r in rows if r["keys"] is not None][0]
    assert keyed["mk"] == keyed["keys"]
    bad = [r for r in rows if r["keys"] is None][0]
    assert bad["mk"].startswith("\u0000error:")


def test_upsert_insert_update_delete_and_replay(spark, tmp_dir):
    target = TargetConfig(path=f"{tmp_dir}/target", buckets=4)
    apply_change_batch(spark, frame(spark, [change("a", 1, "e1", "INSERT"), change("b", 1, "e2", "INSERT"), "{bad"]), target, batch_id=0)
    first = target_rows(spark, target)
    assert len(first) == 3
    batch1 = frame(spark, [change("a", 2, "e3", value="new"), change("b", 2, "e4", "REMOVE"), change("c", 2, "e5", "INSERT")])
    apply_change_batch(spark, batch1, target, batch_id=1)
    rows = target_rows(spark, target)
    assert json.loads(rows['{"id": "a"}']["new_image"])["value"] == "new"
    assert rows['{"id": "b"}']["is_deleted"] and rows['{"id": "b"}']["new_image"] == "{}"
    assert '{"id": "c"}' in rows and len(rows) == 4
    # replaying batches (as after a failure) leaves the table unchanged
    apply_change_batch(spark, batch1, target, batch_id=1)
    apply_change_batch(spark, frame(spark, ["{bad"]), target, batch_id=2)
    again = target_rows(spark, target)
    assert {k: v["event_id"] for k, v in again.items()} == {k: v["event_id"] for k, v in rows.items()}
    assert read_target(spark, target).count() == 4
    # a later INSERT revives a soft-deleted key
    apply_change_batch(spark, frame(spark, [change("b", 3, "e6", "INSERT")]), target, batch_id=3)
    assert target_rows(spark, target)['{"id": "b"}']["is_deleted"] is False


def test_only_touched_buckets_are_rewritten(spark, tmp_dir):
    import glob
    import os

    target = TargetConfig(path=f"{tmp_dir}/target", buckets=8)
    apply_change_batch(spark, frame(spark, [change(str(i), 1, f"e{i}") for i in range(40)]), target, batch_id=0)
    before = {d: sorted(os.listdir(d)) for d in glob.glob(f"{tmp_dir}/target/bucket=*")}
    apply_change_batch(spark, frame(spark, [change("7", 2, "e100")]), target, batch_id=1)
    after = {d: sorted(os.listdir(d)) for d in glob.glob(f"{tmp_dir}/target/bucket=*")}
    changed = [d for d in before if before[d] != after[d]]
    assert len(changed) == 1
    assert read_target(spark, target).count() == 40


def test_order_guard(spark, tmp_dir):
    late = TargetConfig(path=f"{tmp_dir}/arrival", buckets=2)
    guard = TargetConfig(path=f"{tmp_dir}/guard", buckets=2, order_guard=True)
    for t in (late, guard):
        apply_change_batch(spark, frame(spark, [change("a", 10, "new")]), t, batch_id=0)
        apply_change_batch(spark, frame(spark, [change("a", 5, "old"), change("b", 1, "b1")]), t, batch_id=1)
    assert target_rows(spark, late)['{"id": "a"}']["event_id"] == "old"
    assert target_rows(spark, guard)['{"id": "a"}']["event_id"] == "new"
    assert '{"id": "b"}' in target_rows(spark, guard)


def test_duplicate_keys_rejected(spark, tmp_dir):
    target = TargetConfig(path=f"{tmp_dir}/target", buckets=2)
    rows = normalize_changes(frame(spark, [change("a", 1, "e1"), change("a", 2, "e2")]))
    with pytest.raises(Exception, match="several rows"):
        upsert(spark, rows, target, batch_id=0)


def test_bucket_count_is_fixed(spark, tmp_dir):
    apply_change_batch(spark, frame(spark, [change("a", 1, "e1")]), TargetConfig(path=f"{tmp_dir}/t", buckets=2), batch_id=0)
    with pytest.raises(ValueError, match="buckets"):
        apply_change_batch(spark, frame(spark, [change("a", 2, "e2")]), TargetConfig(path=f"{tmp_dir}/t", buckets=3), batch_id=1)


def test_interrupted_overwrite_is_finished_on_replay(spark, tmp_dir, monkeypatch):
    from tidewater.operators import upsert as U

    target = TargetConfig(path=f"{tmp_dir}/target", buckets=4)
    apply_change_batch(spark, frame(spark, [change("a", 1, "e1")]), target, batch_id=0)
    real = U._write_buckets
    calls = {"n": 0}

    def failing(df, path, mode="overwrite", only_written=False):
        if path == target.path:
            calls["n"] += 1
            raise RuntimeError("crash during the final overwrite")
        return real(df, path, mode, only_written)

    monkeypatch.setattr(U, "_write_buckets", failing)
    batch = stage_changes(spark, frame(spark, [change("a", 2, "e2"), change("b", 2, "e3")]))
    with pytest.raises(RuntimeError):
        U.upsert(spark, batch, target, batch_id=1)
    monkeypatch.setattr(U, "_write_buckets", real)
    # the replay must not need the source again: give it an empty batch
    U.upsert(spark, batch.limit(0), target, batch_id=1)
    rows = target_rows(spark, target)
    assert rows['{"id": "a"}']["event_id"] == "e2" and '{"id": "b"}' in rows


def test_other_writers_finish_a_crashed_overwrite_first(spark, tmp_dir, monkeypatch):
    from tidewater.operators import upsert as U

    target = TargetConfig(path=f"{tmp_dir}/target", buckets=2)
    apply_change_batch(spark, frame(spark, [change(k, 1, f"{k}1") for k in "abcd"]), target, batch_id=0)
    real = U._write_buckets

    def failing(df, path, mode="overwrite", only_written=False):
        if path == target.path:
            raise RuntimeError("crash during the final overwrite")
        return real(df, path, mode, only_written)

    crashed = stage_changes(spark, frame(spark, [change("a", 2, "a2"), change("e", 2, "e2")]))
    monkeypatch.setattr(U, "_write_buckets", failing)
    with pytest.raises(RuntimeError):
        U.upsert(spark, crashed, target, batch_id=1)
    monkeypatch.setattr(U, "_write_buckets", real)
    # another job's batch: the crashed one's rows are there, and so are its own
    apply_change_batch(spark, frame(spark, [change(k, 3, f"{k}3") for k in "bcdf"]), target, batch_id="run", run_key="bulk")
    rows = {json.loads(k)["id"]: v["event_id"] for k, v in target_rows(spark, target).items()}
    expected = {"a": "a2", "b": "b3", "c": "c3", "d": "d3", "e": "e2", "f": "f3"}
    assert rows == expected
    # the crashed batch retried after it does not put back what the other job replaced
    U.upsert(spark, crashed, target, batch_id=1)
    rows = {json.loads(k)["id"]: v["event_id"] for k, v in target_rows(spark, target).items()}
    assert rows == expected


def test_soft_delete_reader(spark, tmp_dir):
    from tidewater.operators.upsert import live_rows

    target = TargetConfig(path=f"{tmp_dir}/target", buckets=2)
    apply_change_batch(spark, frame(spark, [change("a", 1, "e1"), change("b", 1, "e2", "REMOVE")]), target, batch_id=0)
    assert [r["keys"] for r in live_rows(read_target(spark, target)).collect()] == ['{"id": "a"}']


def _deep(depth, leaf):
    value = {"S": leaf}
    for i in range(depth):
        value = {"M": {"m": value}} if i % 2 else {"L": [value]}
    return value


def test_deep_rows_are_ranked_then_repaired(spark, tmp_dir):
    from tidewater.config import DecodeOptions
    from tidewater.functions.pyjson import decode_map_text

    deep_img = {"id": {"S": "a"}, "d": _deep(12, "x")}
    texts = [
        change("a", 1, "e1"),
        record({"ApproximateCreationDateTime": 2, "Keys": {"id": {"S": "a"}}, "NewImage": deep_img}, event_id="e2"),
        record({"ApproximateCreationDateTime": 3, "Keys": {"id": {"S": "b"}},
                "NewImage": {"d": _deep(12, "y"), "bad": {"Q": "1"}}}, event_id="e3"),
    ]
    # without an upsert: the deep row keeps keys and timestamp and is flagged
    rows = {r["event_id"]: r for r in normalize_changes(frame(spark, texts), opts=DecodeOptions(deep_fallback="repair")).collect()}
    assert rows["e2"]["keys"] == '{"id": "a"}' and rows["e2"]["approx_creation_timestamp_millis"] == 2
    assert json.loads(rows["e2"]["error"])["error"] == "attribute values nested too deeply"
    # through the upsert: ranked as the latest of "a", then decoded in Python
    target = TargetConfig(path=f"{tmp_dir}/t", buckets=2)
    apply_change_batch(spark, frame(spark, texts), target, batch_id=0, decode=DecodeOptions(max_depth=4, deep_fallback="repair"))
    out = {r["event_id"]: r for r in read_target(spark, target).collect()}
    assert set(out) == {"e2", "e3"}
    assert out["e2"]["error"] is None and out["e2"]["new_image"] == decode_map_text(json.dumps(deep_img))
    assert out["e3"]["has_parsing_error"] and out["e3"]["keys"] is None


def test_register_target_for_sql(spark, tmp_dir):
    from tidewater.operators.upsert import register_target

    target = TargetConfig(path=f"{tmp_dir}/t", buckets=2)
    apply_change_batch(spark, frame(spark, [change("a", 1, "e1"), change("b", 1, "e2")]), target, batch_id=0)
    register_target(spark, "cdc_target_test", target)
    assert spark.sql("SELECT count(*) AS n FROM cdc_target_test WHERE NOT is_deleted").first()["n"] == 2
    spark.sql("DROP TABLE cdc_target_test")
