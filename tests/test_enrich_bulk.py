import gzip
import json
import os

import pytest

from helpers import record
from tidewater.config import BulkConfig, DecodeOptions, LookupConfig, TargetConfig
from tidewater.operators.enrich import enrich
from tidewater.operators.normalize import normalize_changes, normalize_export
from tidewater.operators.upsert import read_target
from tidewater.plans.batch import stage_changes
from tidewater.plans.bulk import run_bulk
from tidewater.sources.lookup import read_lookup


def linked(key, uri, name="MODIFY", event_id=None):
    body = {"ApproximateCreationDateTime": 1, "Keys": {"id": {"S": key}}}
    if name != "REMOVE":
        body["NewImage"] = {"id": {"S": key}} | ({"s3_uri": {"S": uri}} if uri else {})
    return record(body, event_id=event_id or key, name=name)


def write_lookup(folder, files):
    os.makedirs(folder, exist_ok=True)
    for name, recs in files.items():
        with open(os.path.join(folder, name), "w") as f:
            f.write("\n".join(json.dumps(r) for r in recs) + "\n")


def test_lookup_join_match_miss_fanout_remove(spark, tmp_dir):
    write_lookup(f"{tmp_dir}/lk", {"one.json": [{"a": 1}], "two.json": [{"b": 1}, {"b": 2}]})
    uri_one = f"file://{tmp_dir}/lk/one.json"
    uri_two = f"file://{tmp_dir}/lk/two.json"
    texts = [linked("x", uri_one), linked("y", "file:///nowhere.json"), linked("z", uri_two), linked("r", None, "REMOVE"), linked("n", None)]
    changes = normalize_changes(spark.createDataFrame([(t,) for t in texts], "value string"))
    lookup = read_lookup(spark, LookupConfig(path=f"{tmp_dir}/lk"))
    rows = [r.asDict() for r in enrich(changes, lookup).collect()]
    by = {}
    for r in rows:
        by.setdefault(r["event_id"], []).append(r)
    assert [json.loads(r["raw_s3_payload"]) for r in by["x"]] == [{"a": 1}] and by["x"][0]["s3_uri"] == uri_one
    assert by["y"][0]["s3_uri"] is None and by["y"][0]["raw_s3_payload"] == "{}"
    assert sorted(json.loads(r["raw_s3_payload"])["b"] for r in by["z"]) == [1, 2]
    assert by["r"][0]["raw_s3_payload"] == "{}" and by["r"][0]["new_image"] == "{}"
    packed = {r["event_id"]: r for r in enrich(changes, lookup, multi="array").collect()}
    assert sorted(x["b"] for x in json.loads(packed["z"]["raw_s3_payload"])) == [1, 2]
    assert packed["y"]["raw_s3_payload"] == "{}"


def test_lookup_in_batch_plan_with_target(spark, tmp_dir):
    write_lookup(f"{tmp_dir}/lk", {"p.json": [{"page": 7}]})
    uri = f"file://{tmp_dir}/lk/p.json"
    cfg = LookupConfig(path=f"{tmp_dir}/lk")
    texts = [linked("x", uri)]
    staged = stage_changes(spark, spark.createDataFrame([(t,) for t in texts], "value string"), lookup=cfg)
    assert [json.loads(r["raw_s3_payload"]) for r in staged.collect()] == [{"page": 7}]


def test_lookup_corrupt_and_verbatim(spark, tmp_dir):
    os.makedirs(f"{tmp_dir}/lk")
    with open(f"{tmp_dir}/lk/f.json", "w") as f:
        f.write('{"b":2, "a":1}\n\nnot json\n')
    rows = read_lookup(spark, LookupConfig(path=f"{tmp_dir}/lk")).collect()
    payloads = sorted(r["raw_s3_payload"] for r in rows)
    assert payloads == ['{"_corrupt_record":"not json"}', '{"a":1,"b":2}']
    verbatim = sorted(r["raw_s3_payload"] for r in read_lookup(spark, LookupConfig(path=f"{tmp_dir}/lk", verbatim=True)).collect())
    assert verbatim == ['not json', '{"b":2, "a":1}']


def export_line(item):
    return json.dumps({"Item": item})


def test_bulk_keys_in_canonical_order_and_missing_key(spark):
    lines = [
        export_line({"sk": {"N": "2"}, "pk": {"S": "a"}, "v": {"M": {"x": {"BOOL": True}}}}),
        export_line({"pk": {"S": "b"}}),
        "{bad",
    ]
    df = spark.createDataFrame([(t,) for t in lines], "value string")
    rows = normalize_export(df, ("pk", "sk"), "tbl", "run-1", load_time_millis=5000).collect()
    good, missing, bad = rows
    assert good["keys"] == '{"pk": "a", "sk": "2"}'
    assert json.loads(good["new_image"]) == {"pk": "a", "sk": "2", "v": {"x": True}}
    assert good["last_event_name"] == "BULK_LOAD" and good["old_image"] == "{}" and good["event_id"] == "run-1"
    assert good["approx_creation_timestamp_millis"] == 5000 and good["raw_payload_size_bytes"] == 4 * len(lines[0])
    assert json.loads(missing["error"])["error"] == "missing key attribute" and missing["keys"] is None
    assert json.loads(bad["error"]) == {"error": "malformed record", "data": "{bad"}


def test_bulk_and_stream_keys_agree(spark):
    stream = record({"Keys": {"sk": {"N": "2"}, "pk": {"S": "a"}}}, event_id="e")
    s = normalize_changes(spark.createDataFrame([(stream,)], "value string")).first()
    b = normalize_export(spark.createDataFrame([(export_line({"pk": {"S": "a"}, "sk": {"N": "2"}}),)], "value string"),
                         ("sk", "pk"), "t", "r").first()
    assert s["keys"] == b["keys"]


def test_run_bulk_reads_gzip_export(spark, tmp_dir):
    os.makedirs(f"{tmp_dir}/export/data")
    with gzip.open(f"{tmp_dir}/export/data/part-0.json.gz", "wt") as f:
        for i in range(5):
            f.write(export_line({"id": {"N": str(i)}, "name": {"S": f"n{i}"}}) + "\n")
    cfg = BulkConfig(export_path=f"{tmp_dir}/export", table_name="t", key_names="id ,", run_id="r1",
                     target=TargetConfig(path=f"{tmp_dir}/target", buckets=2), load_time_millis=1)
    assert cfg.key_names == ("id",)
    run_bulk(spark, cfg)
    run_bulk(spark, cfg)  # a rerun of the same load leaves the table as it is
    rows = read_target(spark, cfg.target).collect()
    assert sorted(json.loads(r["keys"])["id"] for r in rows) == ["0", "1", "2", "3", "4"]


def test_config_checks():
    with pytest.raises(ValueError):
        BulkConfig(export_path="", table_name="t", key_names="a", run_id="r", target=TargetConfig(path="/x"))
    with pytest.raises(ValueError):
        BulkConfig(export_path="/e", table_name="t", key_names=" , ", run_id="r", target=TargetConfig(path="/x"))
    with pytest.raises(ValueError):
        TargetConfig()
    with pytest.raises(ValueError):
        LookupConfig(path="/x", multi="many")
    with pytest.raises(ValueError):
        DecodeOptions(deep_fallback="drop")


def test_command_line_accepts_original_parameter_names():
    from tidewater.jobs import configs

    job, cfg = configs(["bulk", "--S3DynamoDbExportPath", "/e", "--DynamoDbTableName", "t",
                        "--DynamoDbTableKeys", " pk , sk ", "--JOB_RUN_ID", "r", "--target-path", "/x",
                        "--S3JoinPath", "/lk"])
    assert job == "bulk" and cfg.key_names == ("pk", "sk") and cfg.data_path == "/e/data/"
    assert cfg.lookup.path == "/lk" and cfg.target.with_lookup
    job, cfg = configs(["stream", "--source-format", "kafka", "--source-option", "subscribe=c",
                        "--TempDir", "/tmp/x", "--target-path", "/t"])
    assert cfg.source_options == {"subscribe": "c"} and cfg.checkpoint_location == "/tmp/x/checkpoint"
    job, cfg = configs(["stream", "--source-format", "kafka", "--TempDir", "/tmp/x", "--JOB_NAME", "j", "--target-path", "/t"])
    assert cfg.checkpoint_location == "/tmp/x/j/checkpoint" and cfg.query_name == "j"
    with pytest.raises(ValueError):
        configs(["stream", "--source-format", "kafka", "--source-option", "bad", "--TempDir", "/c", "--target-path", "/t"])


def test_broadcast_only_within_size_bound(spark, tmp_dir):
    from tidewater.sources.lookup import lookup_bytes, may_broadcast

    write_lookup(f"{tmp_dir}/lk", {"a.json": [{"x": "y" * 100}]})
    size = lookup_bytes(spark, f"{tmp_dir}/lk")
    assert size > 100
    assert may_broadcast(spark, LookupConfig(path=f"{tmp_dir}/lk", broadcast=True, broadcast_limit_bytes=size))
    assert not may_broadcast(spark, LookupConfig(path=f"{tmp_dir}/lk", broadcast=True, broadcast_limit_bytes=size - 1))
    assert not may_broadcast(spark, LookupConfig(path=f"{tmp_dir}/lk"))


def test_stream_batch_with_lookup_into_14_column_target(spark, tmp_dir):
    from tidewater.plans.batch import apply_change_batch
    from tidewater.schemas import TARGET_WITH_LOOKUP_SCHEMA

    write_lookup(f"{tmp_dir}/lk", {"p.json": [{"page": 7}], "two.json": [{"n": 1}, {"n": 2}]})
    uri = f"file://{tmp_dir}/lk/p.json"
    target = TargetConfig(path=f"{tmp_dir}/t", buckets=2, with_lookup=True)
    texts = [linked("x", uri), linked("y", "file:///none.json"), linked("r", None, "REMOVE")]
    apply_change_batch(spark, spark.createDataFrame([(t,) for t in texts], "value string"), target, batch_id=0,
                       lookup=LookupConfig(path=f"{tmp_dir}/lk"))
    df = read_target(spark, target)
    assert [f.name for f in df.schema.fields][:14] == [f.name for f in TARGET_WITH_LOOKUP_SCHEMA.fields]
    rows = {json.loads(r["keys"])["id"]: r for r in df.collect()}
    assert json.loads(rows["x"]["raw_s3_payload"]) == {"page": 7} and rows["x"]["s3_uri"] == uri
    assert rows["y"]["s3_uri"] is None and rows["y"]["raw_s3_payload"] == "{}"
    assert rows["r"]["is_deleted"] and rows["r"]["raw_s3_payload"] == "{}"
    # a file with two records fans out to two rows for one key: the upsert refuses it
    fan = [linked("z", f"file://{tmp_dir}/lk/two.json")]
    with pytest.raises(Exception, match="several rows"):
        apply_change_batch(spark, spark.createDataFrame([(t,) for t in fan], "value string"), target, batch_id=1,
                           lookup=LookupConfig(path=f"{tmp_dir}/lk"))
    # packed into one array it goes through
    apply_change_batch(spark, spark.createDataFrame([(t,) for t in fan], "value string"), target, batch_id=2,
                       lookup=LookupConfig(path=f"{tmp_dir}/lk", multi="array"))
    z = [r for r in read_target(spark, target).collect() if r["keys"] == '{"id": "z"}'][0]
    assert sorted(x["n"] for x in json.loads(z["raw_s3_payload"])) == [1, 2]


def test_bulk_load_time_is_now_unless_given(spark):
    import time

    before = int(time.time() * 1000)
    df = spark.createDataFrame([(export_line({"id": {"S": "a"}}),)], "value string")
    at = normalize_export(df, ("id",), "t", "r").first()["approx_creation_timestamp_millis"]
    # the load time has second precision
    assert before // 1000 * 1000 <= at <= int(time.time() * 1000)


def test_change_log_batch_is_replaced_on_replay(spark, tmp_dir):
    from tidewater.sinks.changelog import write_change_log

    changes = normalize_changes(spark.createDataFrame([(linked("x", None),), (linked("y", None),)], "value string"))
    for batch in (1, 2, 1):
        write_change_log(changes, f"{tmp_dir}/log", batch_id=batch)
    assert spark.read.parquet(f"{tmp_dir}/log").groupBy("batch").count().orderBy("batch").collect() == [(1, 2), (2, 2)]
