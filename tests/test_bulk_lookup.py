"""Bulk loads that take their lookup columns on the way into the target."""

import json
import os
import time

import pytest

from test_shared_urls import write_tables
from tidewater.config import BulkConfig, LookupConfig, TargetConfig
from tidewater.functions.record import ERR_TOO_DEEP
from tidewater.operators import upsert as U
from tidewater.operators.files import child_names
from tidewater.operators.upsert import read_target
from tidewater.plans import catalog
from tidewater.plans.bulk import run_bulk
from tidewater.session import conf_held, shuffles_dropped


def nested(levels):
    value = {"S": "leaf"}
    for _ in range(levels):
        value = {"M": {"d": value}}
    return value


def export(folder, ids, mark="a", deep=()):
    """Lines of items, each linked to the URI of its number modulo 5 (of which u4 has no record); a broken line at the end."""
    os.makedirs(f"{folder}/data")
    with open(f"{folder}/data/part-0.json", "w") as f:
        for i in ids:
            item = {"id": {"N": str(i)}, "mark": {"S": mark}, "s3_uri": {"S": f"u{i % 5}"}} | ({"deep": nested(12)} if i in deep else {})
            f.write(json.dumps({"Item": item}) + "\n")
        f.write(f"broken {mark}\n")
    return str(folder)


def lookup(spark, folder):
    """One record for u0 and u1, two for u2 and u3."""
    rows = [(f"u{i}", json.dumps({"u": i, "part": p})) for i in range(4) for p in range(1 + i // 2)]
    spark.createDataFrame(rows, "s3_uri string, raw_s3_payload string").write.parquet(folder)
    return LookupConfig(path=folder, format="parquet", multi="array")


def config(spark, tmp_dir, name, ids, run_id="r", target=None, **given):
    target = target or TargetConfig(path=f"{tmp_dir}/target-{name}", buckets=4, with_lookup=True)
    cfg = lookup(spark, f"{tmp_dir}/lookup-{name}-{run_id}")
    return BulkConfig(export_path=export(f"{tmp_dir}/export-{name}-{run_id}", ids, **given), table_name="t", key_names="id", run_id=run_id, target=target, load_time_millis=1, lookup=cfg)


def loaded(spark, target):
    """Per id: mark, URI and number of records; the error rows under their raw text."""
    rows = read_target(spark, target).collect()
    found = {}
    for r in rows:
        image, records = json.loads(r["new_image"]), json.loads(r["raw_s3_payload"])
        found[int(image["id"]) if image else r["raw_payload"]] = (image.get("mark"), r["s3_uri"], sum(x["u"] == int(r["s3_uri"][1:]) for x in records) if records else 0)
    assert len(found) == len(rows)
    return found


def expected(ids, mark="a"):
    return {i: (mark, f"u{i % 5}", 1 + i % 5 // 2) if i % 5 < 4 else (mark, None, 0) for i in ids} | {f"broken {mark}": (None, None, 0)}


@pytest.fixture()
def staged_columns(monkeypatch):
    """The columns of every staged batch, as the key check sees them."""
    seen, check = [], U.check_unique_keys
    monkeypatch.setattr(U, "check_unique_keys", lambda staged: (seen.append(staged.columns), check(staged)))
    return seen


@pytest.mark.parametrize("name", ["bulk_lookup", "bulk_lookup_join"])
def test_records_are_not_staged(spark, tmp_dir, staged_columns, name):
    assert getattr(catalog, name)(spark, write_tables(tmp_dir)).count() == 14
    assert len(staged_columns) == 1 and "raw_payload" in staged_columns[0] and "raw_s3_payload" not in staged_columns[0]


def test_export_of_the_query_is_compressed(spark, tmp_dir, monkeypatch):
    exports = []
    monkeypatch.setattr(catalog, "run_bulk", lambda spark, cfg: (exports.append(cfg.export_path), run_bulk(spark, cfg)))
    catalog.bulk_lookup(spark, write_tables(tmp_dir))
    files = [f for f in os.listdir(f"{exports[0]}/data") if f.startswith("part-")]
    assert files and all(f.endswith(".gz") for f in files)


def test_each_pass_writes_its_buckets(spark, tmp_dir, monkeypatch):
    passes, groups = [], U._bucket_groups
    monkeypatch.setattr(U, "_bucket_groups", lambda spark, path, buckets, most: passes.append(groups(spark, path, buckets, 1)) or passes[-1])
    cfg = config(spark, tmp_dir, "passes", range(40))
    run_bulk(spark, cfg)
    assert passes == [[[0], [1], [2], [3]]] and loaded(spark, cfg.target) == expected(range(40))
    assert U.LOADING not in child_names(spark, cfg.target.path)
    run_bulk(spark, cfg)  # again, now into the target that holds it
    assert len(passes) == 1 and loaded(spark, cfg.target) == expected(range(40))


def test_groups_hold_at_most_their_bytes(spark, tmp_dir):
    for b, size in enumerate((5, 5, 20, 1, 2, 3)):
        os.makedirs(f"{tmp_dir}/bucket={b}")
        with open(f"{tmp_dir}/bucket={b}/x", "w") as f:
            f.write("x" * size)
    assert U._bucket_groups(spark, tmp_dir, list(range(6)), 10) == [[0, 1], [2], [3, 4, 5]]


def test_second_load_replaces_its_keys(spark, tmp_dir):
    first = config(spark, tmp_dir, "second", range(20))
    run_bulk(spark, first)
    run_bulk(spark, config(spark, tmp_dir, "second", range(10, 30), run_id="r2", target=first.target, mark="b"))
    assert loaded(spark, first.target) == expected(range(20)) | expected(range(10, 30), "b")


@pytest.mark.parametrize("guarded, kept", [(True, "a"), (False, "b")])
def test_second_load_with_order_guard(spark, tmp_dir, guarded, kept):
    target = TargetConfig(path=f"{tmp_dir}/target", buckets=2, with_lookup=True, order_guard=guarded)
    run_bulk(spark, config(spark, tmp_dir, "guard", range(5), target=target))
    older = config(spark, tmp_dir, "guard", range(5), run_id="r2", target=target, mark="b")
    run_bulk(spark, BulkConfig(**{**older.__dict__, "load_time_millis": 0}))
    assert loaded(spark, target) == expected(range(5)) | expected(range(5), kept) | expected([], "b")


def test_repaired_rows_are_looked_up(spark, tmp_dir):
    cfg = config(spark, tmp_dir, "deep", range(20), deep=(3, 4, 11))
    run_bulk(spark, cfg)
    assert loaded(spark, cfg.target) == expected(range(20))
    rows = read_target(spark, cfg.target).collect()
    assert sum("leaf" in (r["new_image"] or "") for r in rows) == 3 and not any(ERR_TOO_DEEP in (r["error"] or "") for r in rows)


def test_failed_first_load_shows_no_rows_and_a_rerun_ends_it(spark, tmp_dir, monkeypatch):
    cfg, write, calls = config(spark, tmp_dir, "failed", range(40)), U._write_buckets, []

    def failing(df, path, *args, **kwargs):
        calls.append(path)
        if sum(p.endswith(U.LOADING) for p in calls) == 2:
            raise RuntimeError("lost")
        write(df, path, *args, **kwargs)

    with monkeypatch.context() as m:
        m.setattr(U, "_write_buckets", failing)
        m.setattr(U, "_bucket_groups", lambda spark, path, buckets, most: [[b] for b in buckets])
        with pytest.raises(RuntimeError, match="lost"):
            run_bulk(spark, cfg)
    assert read_target(spark, cfg.target).count() == 0
    run_bulk(spark, cfg)
    assert loaded(spark, cfg.target) == expected(range(40)) and U.LOADING not in child_names(spark, cfg.target.path)


def test_fan_out_to_rows_is_still_refused(spark, tmp_dir):
    cfg = config(spark, tmp_dir, "rows", range(5))
    rows = BulkConfig(**{**cfg.__dict__, "lookup": LookupConfig(path=cfg.lookup.path, format="parquet", multi="rows")})
    with pytest.raises(ValueError, match="several rows"):
        run_bulk(spark, rows)


def test_repeated_key_is_still_refused(spark, tmp_dir):
    cfg = config(spark, tmp_dir, "twice", [0, 1, 2, 1])
    with pytest.raises(ValueError, match="several rows"):
        run_bulk(spark, cfg)
    assert read_target(spark, cfg.target).count() == 0


def test_target_of_deltas_takes_its_lookup(spark, tmp_dir):
    target = TargetConfig(path=f"{tmp_dir}/target", buckets=2, with_lookup=True, layout="deltas")
    run_bulk(spark, config(spark, tmp_dir, "deltas", range(10), target=target))
    assert loaded(spark, target) == expected(range(10))
    with pytest.raises(ValueError, match="deltas"):
        U.upsert(spark, spark.range(1), target, lookup=lambda rows: rows)


def shuffle_files(spark):
    found = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {f.getName() for f in (found.apply(i) for i in range(found.size())) if f.getName().startswith("shuffle_")}


def test_shuffle_files_go_with_their_query(spark, tmp_dir):
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before, own = shuffle_files(spark), spark.conf.get(key)
    kept = spark.range(1000).repartition(3, "id")
    kept.write.parquet(f"{tmp_dir}/kept")
    assert shuffle_files(spark) - before
    held = shuffle_files(spark)
    with shuffles_dropped(spark):
        spark.range(1000).repartition(5, "id").write.parquet(f"{tmp_dir}/dropped")
    until = time.time() + 20
    while shuffle_files(spark) - held and time.time() < until:
        time.sleep(0.1)
    assert not shuffle_files(spark) - held and spark.conf.get(key) == own
    assert spark.read.parquet(f"{tmp_dir}/dropped").count() == 1000


def test_settings_are_put_back(spark):
    spark.conf.unset("x.unset")
    spark.conf.set("x.set", "1")
    with pytest.raises(KeyError), conf_held(spark, {"x.set": "2", "x.unset": "3"}):
        assert (spark.conf.get("x.set"), spark.conf.get("x.unset")) == ("2", "3")
        raise KeyError
    assert (spark.conf.get("x.set"), spark.conf.get("x.unset", None)) == ("1", None)
