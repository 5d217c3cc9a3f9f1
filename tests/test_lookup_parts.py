"""A lookup prepared in partitions: batches read those their URIs name."""

import json

import pytest
from pyspark.sql import functions as F

from helpers import record
from tidewater.config import LookupConfig, TargetConfig
from tidewater.operators.upsert import read_target
from tidewater.plans.batch import apply_change_batch
from tidewater.sources import lookup as L


def linked(key, uri, ts=1, levels=0):
    value = {"S": "x"}
    for _ in range(levels):
        value = {"M": {"d": value}}
    image = {"id": {"S": key}, "s3_uri": {"S": uri} if uri else {"NULL": True}, "v": value}
    return (record({"ApproximateCreationDateTime": ts, "Keys": {"id": {"S": key}}, "NewImage": image}, event_id=f"{key}{ts}"),)


def changes(spark, rows):
    return spark.createDataFrame(rows, "value string")


def prepared(spark, path, n=200, parts=16):
    L.prepare_lookup(spark.range(n).select(F.format_string("s3://b/%d", "id").alias("s3_uri"), F.format_string('{"n":%d}', "id").alias("raw_s3_payload")), path, parts)
    return LookupConfig(path=path, format="partitioned")


def test_only_named_partitions_are_read(spark, tmp_dir):
    cfg = prepared(spark, f"{tmp_dir}/lk")
    uris = spark.createDataFrame([("s3://b/7",), ("s3://b/7",), ("s3://nowhere",), (None,)], "uri string")
    named = L.named_parts(uris, 16)
    found = L.read_lookup(spark, cfg, uris)
    folders = {f.split(f"{L.PART}=")[1].split("/")[0] for f in found.inputFiles()}
    assert 1 <= len(named) <= 2 and folders <= {str(n) for n in named}
    assert found.filter("s3_uri = 's3://b/7'").count() == 1 and found.count() < 60
    assert L.read_lookup(spark, cfg).count() == 200
    assert L.read_lookup(spark, cfg, uris.filter("uri IS NULL")).collect() == []


def test_records_added_later_are_found(spark, tmp_dir):
    cfg = prepared(spark, f"{tmp_dir}/lk", 10)
    more = spark.createDataFrame([("s3://b/new", '{"n":-1}')], "s3_uri string, raw_s3_payload string")
    before = {f for f in L.read_lookup(spark, cfg).inputFiles()}
    L.prepare_lookup(more, cfg.path, 16)
    added = {f for f in L.read_lookup(spark, cfg).inputFiles()} - before
    assert len(added) == 1 and L.read_lookup(spark, cfg).count() == 11
    with pytest.raises(ValueError, match="partitions"):
        L.prepare_lookup(more, cfg.path, 8)
    with pytest.raises(ValueError, match="no prepared lookup"):
        L.read_lookup(spark, LookupConfig(path=f"{tmp_dir}/none", format="partitioned"))


@pytest.mark.parametrize("multi", ["rows", "array"])
def test_batch_with_partitioned_lookup(spark, tmp_dir, multi):
    """Rows too deep for the native decoder find their records too, in either mode."""
    cfg = LookupConfig(path=prepared(spark, f"{tmp_dir}/lk").path, format="partitioned", multi=multi)
    target = TargetConfig(path=f"{tmp_dir}/t", buckets=2, with_lookup=True, layout="deltas")
    rows = [linked("a", "s3://b/3"), linked("b", "s3://nowhere"), linked("c", None), linked("d", "s3://b/9", 1, 12), linked("a", "s3://b/4", 2, 12), ("{bad",)]
    apply_change_batch(spark, changes(spark, rows), target, batch_id=0, lookup=cfg)
    out = {r["keys"]: r for r in read_target(spark, target).collect()}
    whole = lambda text: f"[{text}]" if multi == "array" else text
    assert {json.loads(k)["id"]: (r.s3_uri, r.raw_s3_payload) for k, r in out.items() if k} == {
        "a": ("s3://b/4", whole('{"n":4}')), "b": (None, "{}"), "c": (None, "{}"), "d": ("s3://b/9", whole('{"n":9}')),
    }
    assert len(out) == 5 and out[None].has_parsing_error
