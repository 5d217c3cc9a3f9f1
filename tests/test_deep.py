"""One decode result at any nesting depth."""

import json

import pytest
from pyspark.sql import functions as F

from helpers import image_of, record
from tidewater.config import DecodeOptions, TargetConfig
from tidewater.operators.upsert import read_target
from tidewater.plans.batch import apply_change_batch, stage_changes

ODD = [
    {"S": "x"}, {"S": 5}, {"S": None}, {"S": {"a": [1, 2]}}, {"N": "1.50"}, {"N": 5}, {"N": "x"}, {"BOOL": True}, {"BOOL": "true"}, {"BOOL": 1}, {"NULL": False},
    {"B": "AA=="}, {"SS": ["a", "b"]}, {"SS": "a"}, {"L": []}, {"M": {}}, {"X": "1"}, {},
]


def nested(value, levels):
    for _ in range(levels):
        value = {"M": {"d": value}}
    return value


@pytest.mark.parametrize("strict", [False, True])
def test_every_tag_decodes_alike_at_depth(spark, strict):
    opts = DecodeOptions(strict_types=strict)
    for value in ODD:
        flat = image_of(spark, {"a": value}, opts)["new_image"]
        deep = image_of(spark, {"a": nested(value, 12)}, opts)["new_image"]
        if flat is None or deep is None:
            assert flat is None and deep is None, value
        else:
            inner = flat.removeprefix('{"a": ').removesuffix("}")
            assert deep == '{"a": ' + '{"d": ' * 12 + inner + "}" * 12 + "}", value


def test_deep_bad_change_does_not_replace_a_good_one(spark, tmp_dir):
    def change(ts, value):
        body = {"Keys": {"id": {"S": "b"}}, "NewImage": {"v": value}, "ApproximateCreationDateTime": ts, "SizeBytes": 1}
        return (json.dumps({"eventID": f"e{ts}", "eventName": "MODIFY", "tableName": "t", "dynamodb": body}),)

    target = TargetConfig(path=f"{tmp_dir}/t", buckets=2)
    apply_change_batch(spark, spark.createDataFrame([change(1, {"S": "good"}), change(2, nested({"X": "bad"}, 12))], "value string"), target, batch_id=0)
    rows = read_target(spark, target).collect()
    assert [r.event_id for r in rows if r.keys] == ["e1"] and sum(r.has_parsing_error for r in rows) == 1


def texts_at(spark, value_text, levels, opts=None):
    """The new image of a record whose value is given as JSON text, ``levels`` deep; through the batch job."""
    nested_text = '{"M":{"d":' * levels + value_text + "}}" * levels
    text = '{"eventID":"e","eventName":"MODIFY","dynamodb":{"Keys":{"k":{"S":"1"}},"NewImage":{"a":' + nested_text + "}}}"
    return spark.createDataFrame([(text,), (record({"Keys": {"k": {"S": "2"}}, "NewImage": {"a": {"S": "ok"}}}),)], "value string")


ODD_TEXTS = [
    r'{"S":"\\ud800"}', r'{"S":"\\udc00x\\ud83d\\ude00"}', r'{"S":"\\u001f\\u0000\\b\\/\\\\u001f\\u007f"}', '{"N":"1\\n"}', '{"N":"1\\n2"}', '{"M":{"x":{"S":"1"},"x":{"S":"2"}}}',
    '{"S":"1","S":"2"}', '{"S":{"b":1,"b":[true,null,1.50,"\\\\u0001"]}}', '{"SS":["\\\\u001f","b"]}', '{"S":1e5}', '{"S":12345678901234567890}',
]


@pytest.mark.parametrize("strict", [False, True])
def test_odd_texts_decode_alike_at_depth(spark, tmp_dir, strict):
    """Lone surrogates, control characters, final newlines and duplicate names: the same text at any depth."""
    opts = DecodeOptions(strict_types=strict)
    for i, value in enumerate(ODD_TEXTS):
        found = []
        for levels in (0, 12):
            target = TargetConfig(path=f"{tmp_dir}/{i}-{levels}", buckets=2, layout="deltas")
            apply_change_batch(spark, texts_at(spark, value, levels), target, batch_id=0, decode=opts)
            rows = {r["keys"]: r for r in read_target(spark, target).collect()}
            assert rows['{"k": "2"}']["new_image"] == '{"a": "ok"}'
            found.append(rows['{"k": "1"}']["new_image"] if len(rows) == 2 and '{"k": "1"}' in rows else None)
        flat, deep = found
        expected = None if flat is None else '{"a": ' + '{"d": ' * 12 + flat.removeprefix('{"a": ').removesuffix("}") + "}" * 12 + "}"
        assert deep == expected, value


def test_no_record_ends_the_job(spark, tmp_dir):
    """Nesting beyond any parser's stack is an error row, bytes that are no UTF-8 are replaced alike at any depth."""
    def row(key, value, levels=0):
        nest = b'{"M":{"d":' * levels + value + b"}}" * levels
        return (b'{"eventID":"e","dynamodb":{"Keys":{"k":{"S":"' + key + b'"}},"NewImage":{"a":' + nest + b"}}}",)

    rows = [row(b"1", b'{"S":"good"}'), row(b"2", b'{"S":"x"}', 5000), row(b"3", b'{"S":"\xff\xc3("}'), row(b"4", b'{"S":"\xff\xc3("}', 12)]
    records = spark.createDataFrame(rows, "value binary").select(F.col("value").cast("string").alias("value"))
    for layout in ("buckets", "deltas"):
        target = TargetConfig(path=f"{tmp_dir}/{layout}", buckets=2, layout=layout)
        apply_change_batch(spark, records, target, batch_id=0)
        out = {r["keys"]: r for r in read_target(spark, target).select("keys", "new_image", "has_parsing_error").collect()}
        assert len(out) == 4 and out[None].has_parsing_error and out['{"k": "1"}'].new_image == '{"a": "good"}'
        flat, deep = out['{"k": "3"}'].new_image, out['{"k": "4"}'].new_image
        assert flat == '{"a": "\ufffd\ufffd("}' and deep == '{"a": ' + '{"d": ' * 12 + '"\ufffd\ufffd("' + "}" * 12 + "}"


def test_shallow_rows_do_not_leave_the_jvm(spark):
    records = spark.createDataFrame([(record({"Keys": {"k": {"S": "1"}}, "NewImage": {"a": {"S": "x"}}}),)], "value string")
    plan = stage_changes(spark, records)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Python" not in plan


@pytest.mark.parametrize("layout", ["buckets", "deltas"])
def test_newest_decodable_row_wins(spark, tmp_dir, layout):
    """Deep rows compete with shallow ones by time, also several of one key, whatever of them decodes."""
    def change(key, ts, value):
        return (record({"Keys": {"k": {"S": key}}, "NewImage": {"v": value}, "ApproximateCreationDateTime": ts}, event_id=f"{key}{ts}"),)

    good, bad = nested({"S": "x"}, 12), nested({"Q": "x"}, 12)
    rows = [change("a", 1, {"S": "s"}), change("a", 2, good), change("a", 3, bad), change("b", 5, {"S": "s"}), change("b", 4, good), change("c", 1, bad), change("d", 1, good), change("d", 2, good)]
    target = TargetConfig(path=f"{tmp_dir}/t", buckets=2, layout=layout)
    apply_change_batch(spark, spark.createDataFrame(rows, "value string"), target, batch_id=0)
    out = read_target(spark, target).collect()
    assert {r["keys"]: r.event_id for r in out if r["keys"]} == {'{"k": "a"}': "a2", '{"k": "b"}': "b5", '{"k": "d"}': "d2"}
    assert sorted(r.event_id for r in out if r.has_parsing_error) == ["a3", "c1"] and len(out) == 5
