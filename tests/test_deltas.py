"""The target as a base and deltas: equal to the bucket layout, constant writes, crashes, replays."""

import json
import os
import random

import pytest
from pyspark.sql import functions as F

from tidewater.config import DecodeOptions, TargetConfig
from tidewater.operators import deltas
from tidewater.operators.upsert import read_target, register_target, upsert
from tidewater.plans.batch import apply_change_batch, stage_changes
from test_latest_upsert import _deep, change, frame, target_rows

from helpers import record


def names(target):
    return sorted(n for n in os.listdir(target.path) if not n.startswith((".", "_")))


def events(spark, target):
    return {json.loads(k)["id"]: r["event_id"] for k, r in target_rows(spark, target).items() if k}


def snapshot(spark, target):
    columns = [c for c in read_target(spark, target).columns if c != "bucket"]
    return sorted((tuple(r[c] for c in columns) for r in read_target(spark, target).collect()), key=repr)


@pytest.mark.parametrize("guard", [False, True])
def test_equals_bucket_layout_over_random_batches(spark, tmp_dir, guard):
    """Late, undated and malformed changes, replays and compactions in any order."""
    rng = random.Random(7 + guard)
    plain = TargetConfig(path=f"{tmp_dir}/plain", buckets=3, order_guard=guard)
    logged = TargetConfig(path=f"{tmp_dir}/logged", buckets=3, order_guard=guard, layout="deltas")
    for batch in range(9):
        texts = []
        for key in rng.sample("abcdefgh", 5):
            ts = rng.choice([None, *range(1, 12)])
            texts.append(change(key, ts, f"{key}-{batch}", rng.choice(["INSERT", "MODIFY", "REMOVE"])))
        texts += rng.sample(["{bad", "{worse", "[1]"], 2)
        for target in (plain, logged):
            apply_change_batch(spark, frame(spark, texts), target, batch_id=batch)
        if rng.random() < 0.4:
            deltas.compact(spark, logged)
        if rng.random() < 0.3:
            apply_change_batch(spark, frame(spark, texts), logged, batch_id=batch)  # a replay adds nothing
        assert snapshot(spark, logged) == snapshot(spark, plain), batch


def test_bytes_written_do_not_depend_on_the_target(spark, tmp_dir):
    sizes = []
    for held in (20, 2000):
        target = TargetConfig(path=f"{tmp_dir}/{held}", buckets=4, layout="deltas")
        apply_change_batch(spark, frame(spark, [change(f"k{i}", 1, f"e{i}") for i in range(held)]), target, batch_id=0)
        deltas.compact(spark, target)
        before = {n: deltas.folder_bytes(spark, f"{target.path}/{n}") for n in names(target)}
        apply_change_batch(spark, frame(spark, [change("k7", 2, "new"), change("z", 2, "z")]), target, batch_id=1)
        added = [n for n in names(target) if n not in before]
        assert len(added) == 1 and all(deltas.folder_bytes(spark, f"{target.path}/{n}") == size for n, size in before.items())
        sizes.append(deltas.folder_bytes(spark, f"{target.path}/{added[0]}"))
        assert read_target(spark, target).count() == held + 1
    assert sizes[0] == sizes[1]


def test_crash_before_and_after_a_rename(spark, tmp_dir, monkeypatch):
    target = TargetConfig(path=f"{tmp_dir}/t", buckets=2, layout="deltas")
    apply_change_batch(spark, frame(spark, [change(k, 1, f"{k}1") for k in "abc"]), target, batch_id=0)
    real = deltas.publish
    batch = frame(spark, [change("a", 2, "a2"), change("d", 2, "d2")])

    def before(*args):
        raise RuntimeError("crash before the rename")

    def after(*args):
        real(*args)
        raise RuntimeError("crash after the rename")

    monkeypatch.setattr(deltas, "publish", before)
    with pytest.raises(RuntimeError):
        apply_change_batch(spark, batch, target, batch_id=1)
    assert events(spark, target) == {"a": "a1", "b": "b1", "c": "c1"}
    monkeypatch.setattr(deltas, "publish", after)
    with pytest.raises(RuntimeError):
        apply_change_batch(spark, batch, target, batch_id=1)
    monkeypatch.setattr(deltas, "publish", real)
    # another job writes, then the crashed batch is replayed: it is there already and does not win again
    apply_change_batch(spark, frame(spark, [change("a", 3, "a3")]), target, batch_id="x", run_key="bulk")
    apply_change_batch(spark, batch, target, batch_id=1)
    expected = {"a": "a3", "b": "b1", "c": "c1", "d": "d2"}
    assert events(spark, target) == expected
    # a compaction that crashes before or after its rename leaves the same rows, and so does a replay after it
    for crash in (before, after):
        monkeypatch.setattr(deltas, "publish", crash)
        with pytest.raises(RuntimeError):
            deltas.compact(spark, target)
        assert events(spark, target) == expected
    monkeypatch.setattr(deltas, "publish", real)
    assert deltas.compact(spark, target) is False  # the one that crashed after its rename was whole
    apply_change_batch(spark, batch, target, batch_id=1)
    apply_change_batch(spark, frame(spark, [change("a", 3, "a3")]), target, batch_id="x", run_key="bulk")
    assert events(spark, target) == expected and len([n for n in names(target) if n.startswith("base")]) == 1


def test_readers_of_the_last_base_can_finish(spark, tmp_dir):
    target = TargetConfig(path=f"{tmp_dir}/t", buckets=2, layout="deltas")
    apply_change_batch(spark, frame(spark, [change("a", 1, "a1"), change("b", 1, "b1")]), target, batch_id=0)
    deltas.compact(spark, target)
    apply_change_batch(spark, frame(spark, [change("a", 2, "a2")]), target, batch_id=1)
    planned = read_target(spark, target).select("event_id")
    deltas.compact(spark, target)
    apply_change_batch(spark, frame(spark, [change("c", 3, "c3")]), target, batch_id=2)
    assert sorted(r.event_id for r in planned.collect()) == ["a2", "b1"]
    deltas.compact(spark, target)
    assert [n[:5] for n in names(target)].count("base-") == 2  # the last two
    assert events(spark, target) == {"a": "a2", "b": "b1", "c": "c3"}


def test_compaction_by_ratio(spark, tmp_dir):
    target = TargetConfig(path=f"{tmp_dir}/t", buckets=2, layout="deltas", compact_ratio=3.0)
    kinds = []
    for i in range(6):
        apply_change_batch(spark, frame(spark, [change(f"k{i}", i, f"e{i}")]), target, batch_id=i)
        kinds.append(len(deltas._open_deltas(spark, target)[1]))
    assert kinds[0] == 0 and 0 in kinds[1:] and max(kinds) > 0  # the first base at once, later ones once the deltas weigh enough
    assert read_target(spark, target).count() == 6


def test_rejected_and_empty_batches_leave_the_target_alone(spark, tmp_dir):
    target = TargetConfig(path=f"{tmp_dir}/t", buckets=2, layout="deltas")
    assert read_target(spark, target).collect() == []
    twice = stage_changes(spark, frame(spark, [change("a", 1, "e1")]))
    with pytest.raises(Exception, match="several rows"):
        upsert(spark, twice.union(twice), target, batch_id=0)
    upsert(spark, twice.limit(0), target, batch_id=1)
    assert names(target) == [] and read_target(spark, target).collect() == [] and deltas.compact(spark, target) is False
    with pytest.raises(ValueError, match="layout"):
        upsert(spark, twice, TargetConfig(path=target.path, buckets=2), batch_id=2)
    with pytest.raises(ValueError, match="layout"):
        read_target(spark, TargetConfig(path=target.path, buckets=2))
    with pytest.raises(ValueError):
        register_target(spark, "no_table", target)
    upsert(spark, twice, TargetConfig(path=f"{tmp_dir}/b", buckets=2), batch_id=0)
    with pytest.raises(ValueError, match="layout"):
        upsert(spark, twice, TargetConfig(path=f"{tmp_dir}/b", buckets=2, layout="deltas"), batch_id=1)


def test_deep_rows_are_repaired(spark, tmp_dir):
    deep = record({"ApproximateCreationDateTime": 2, "Keys": {"id": {"S": "a"}}, "NewImage": {"d": _deep(12, "x")}}, event_id="e2")
    target = TargetConfig(path=f"{tmp_dir}/t", buckets=2, layout="deltas")
    opts = DecodeOptions(max_depth=4, deep_fallback="repair")
    apply_change_batch(spark, frame(spark, [change("a", 1, "e1"), change("b", 1, "b1"), deep]), target, batch_id=0, decode=opts)
    rows = target_rows(spark, target)
    assert rows['{"id": "a"}']["event_id"] == "e2" and '"x"' in rows['{"id": "a"}']["new_image"] and len(rows) == 2


def test_read_plan(spark, tmp_dir):
    """A narrow read takes no raw text from the base, and small deltas leave the base unshuffled."""
    target = TargetConfig(path=f"{tmp_dir}/t", buckets=4, layout="deltas")
    apply_change_batch(spark, frame(spark, [change(f"k{i}", 1, f"e{i}") for i in range(50)]), target, batch_id=0)
    deltas.compact(spark, target)
    apply_change_batch(spark, frame(spark, [change("k1", 2, "n")]), target, batch_id=1)
    read = read_target(spark, target).filter(F.col("bucket") == 1).select("keys", "event_id")
    read.collect()
    plan = read._jdf.queryExecution().executedPlan().toString()
    base_scans = [line for line in plan.split("\n") if "FileScan" in line and "base-" in line]
    assert base_scans and all("raw_payload" not in line.split("ReadSchema")[1] for line in base_scans)
    assert all("PartitionFilters: [isnotnull(bucket" in line for line in base_scans) and "BroadcastHashJoin" in plan


def test_command_line(spark, tmp_dir):
    from tidewater.jobs import configs

    job, target = configs(["compact", "--target-path", tmp_dir, "--buckets", "8"])
    assert (job, target.layout, target.path, target.buckets) == ("compact", "deltas", tmp_dir, 8)
    _, cfg = configs(["bulk", "--export-path", "e", "--table-name", "t", "--keys", "k", "--run-id", "r", "--target-path", "p", "--layout", "deltas", "--compact-ratio", "0.5"])
    assert cfg.target.layout == "deltas" and cfg.target.compact_ratio == 0.5
    with pytest.raises(ValueError):
        TargetConfig(path="p", compact_ratio=0.5)
