import json
import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from helpers import image_of, normalize_texts, record
from tidewater.config import DecodeOptions
from tidewater.functions.pyjson import decode_map_text


# Sample records of this suite, one for each event name: body, and the texts of keys and images they must give.
KEYS = {"pk": {"S": "k1"}}
BEFORE = {"pk": {"S": "k1"}, "n": {"N": "4.50"}, "deep": {"M": {"list": {"L": [{"S": "a"}, {"NULL": True}]}}}}
AFTER = {"pk": {"S": "k1"}, "n": {"N": "5"}, "open": {"BOOL": False}, "none": {"M": {}}, "no": {"L": []}}
BEFORE_TEXT = '{"pk": "k1", "n": "4.50", "deep": {"list": ["a", null]}}'
AFTER_TEXT = '{"pk": "k1", "n": "5", "open": false, "none": {}, "no": []}'
SAMPLES = {
    "INSERT": ({"NewImage": BEFORE}, BEFORE_TEXT, "{}"),
    "MODIFY": ({"NewImage": AFTER, "OldImage": BEFORE}, AFTER_TEXT, BEFORE_TEXT),
    "REMOVE": ({"OldImage": AFTER}, "{}", AFTER_TEXT),
}


@pytest.mark.parametrize("name", sorted(SAMPLES))
def test_sample_records(spark, name):
    images, new, old = SAMPLES[name]
    text = record({"ApproximateCreationDateTime": 1700000000123, "Keys": KEYS, "SizeBytes": 77} | images, event_id="e1", name=name)
    row = normalize_texts(spark, [text])[0]
    assert (row["event_id"], row["last_event_name"], row["is_deleted"]) == ("e1", name, name == "REMOVE")
    assert (row["approx_creation_timestamp_millis"], row["raw_payload_size_bytes"]) == (1700000000123, 77)
    assert (row["keys"], row["new_image"], row["old_image"]) == ('{"pk": "k1"}', new, old)
    assert row["raw_payload"] == text and row["error"] is None and not row["has_parsing_error"]


def test_keys_are_canonical(spark):
    rows = normalize_texts(spark, [record({"Keys": {"b": {"N": "1"}, "a": {"S": "x"}}}, event_id="1"),
                                   record({"Keys": {"a": {"S": "x"}, "b": {"N": "1"}}}, event_id="2")])
    assert rows[0]["keys"] == rows[1]["keys"] == '{"a": "x", "b": "1"}'


def test_scalar_tags(spark):
    img = {"s": {"S": "x"}, "n": {"N": "-4.50e3"}, "t": {"BOOL": True}, "f": {"BOOL": False}, "z": {"NULL": True}}
    row = image_of(spark, img)
    assert row["error"] is None
    assert json.loads(row["new_image"]) == {"s": "x", "n": "-4.50e3", "t": True, "f": False, "z": None}
    assert row["new_image"] == '{"s": "x", "n": "-4.50e3", "t": true, "f": false, "z": null}'


def test_binary_and_sets(spark):
    img = {"b": {"B": "AQI="}, "ss": {"SS": ["a", "b"]}, "ns": {"NS": ["1", "2.5"]}, "bs": {"BS": ["AQ=="]}}
    row = image_of(spark, img)
    assert row["error"] is None
    assert json.loads(row["new_image"]) == {"b": "AQI=", "ss": ["a", "b"], "ns": ["1", "2.5"], "bs": ["AQ=="]}
    strict = image_of(spark, img, DecodeOptions(strict_types=True))
    assert strict["has_parsing_error"] and strict["new_image"] is None


def test_empty_containers_and_names(spark):
    row = image_of(spark, {"m": {"M": {}}, "l": {"L": []}, "": {"S": ""}})
    assert json.loads(row["new_image"]) == {"m": {}, "l": [], "": ""}


def test_escapes(spark):
    name = 'q"b\\n\nü€'
    value = 'v"\\\n\té\U0001F600'
    row = image_of(spark, {name: {"S": value}, "n": {"M": {name: {"L": [{"S": value}]}}}})
    assert row["error"] is None
    assert json.loads(row["new_image"]) == {name: value, "n": {name: [value]}}


@pytest.mark.parametrize(
    "bad",
    [
        {"x": {"X": 1}},
        {"x": {"N": "abc"}},
        {"x": {"BOOL": "yes"}},
        {"x": {}},
        {"x": {"S": "a", "N": "1"}},
        {"x": {"M": {"y": {"Q": "1"}}}},
        {"x": {"L": [{"S": "ok"}, {"X": "no"}]}},
        {"x": {"L": "not a list"}},
        {"x": "plain"},
    ],
)
def test_invalid_values_become_error_rows(spark, bad):
    row = image_of(spark, bad)
    assert row["has_parsing_error"]
    assert json.loads(row["error"])["error"] == "invalid attribute value"
    assert row["keys"] is None and row["new_image"] is None and row["approx_creation_timestamp_millis"] is None


def test_non_string_scalar_payload_is_taken_as_text(spark):
    # The store never writes this; like the original decoder, it is not an error.
    row = image_of(spark, {"x": {"S": 5}})
    assert row["error"] is None and json.loads(row["new_image"]) == {"x": "5"}


def test_malformed_inputs_each_give_one_error_row(spark):
    texts = ["{bad", None, "[]", "3", record("not an object"), record({"Keys": []})]
    rows = normalize_texts(spark, texts)
    assert len(rows) == len(texts)
    assert all(r["has_parsing_error"] for r in rows)
    reasons = [json.loads(r["error"])["error"] for r in rows]
    assert reasons[:4] == ["malformed record"] * 4
    assert reasons[4] == "missing change body"
    assert json.loads(rows[0]["error"])["data"] == "{bad"


def test_missing_keys(spark):
    text = record({"NewImage": {"a": {"S": "x"}}})
    row = normalize_texts(spark, [text])[0]
    assert row["has_parsing_error"] and json.loads(row["error"])["error"] == "missing Keys"
    lax = normalize_texts(spark, [text], DecodeOptions(allow_empty_keys=True))[0]
    assert lax["keys"] == "{}" and not lax["has_parsing_error"]


def test_absent_images_are_empty_objects(spark):
    row = normalize_texts(spark, [record({"Keys": {"k": {"N": "1"}}})])[0]
    assert row["new_image"] == "{}" and row["old_image"] == "{}" and not row["has_parsing_error"]


def test_timestamp_and_size_never_wrong(spark):
    body = {"Keys": {"k": {"N": "1"}}, "ApproximateCreationDateTime": 1684189640.5, "SizeBytes": 2**40}
    row = normalize_texts(spark, [record(body)])[0]
    assert row["approx_creation_timestamp_millis"] is None
    assert row["raw_payload_size_bytes"] is None
    body = {"Keys": {"k": {"N": "1"}}, "ApproximateCreationDateTime": 10**30, "SizeBytes": -(2**40)}
    row = normalize_texts(spark, [record(body)])[0]
    assert row["approx_creation_timestamp_millis"] is None and row["raw_payload_size_bytes"] is None
    body = {"Keys": {"k": {"N": "1"}}, "ApproximateCreationDateTime": 1684189640771, "SizeBytes": 163}
    row = normalize_texts(spark, [record(body)])[0]
    assert row["approx_creation_timestamp_millis"] == 1684189640771 and row["raw_payload_size_bytes"] == 163


def test_remove_is_deleted_and_null_name_is_not(spark):
    rows = normalize_texts(spark, [record({"Keys": {"k": {"N": "1"}}}, name="REMOVE"),
                                   json.dumps({"eventID": "x", "dynamodb": {"Keys": {"k": {"N": "1"}}}})])
    assert rows[0]["is_deleted"] is True and rows[1]["is_deleted"] is False


def _nest(depth):
    value = {"S": "leaf"}
    for i in range(depth):
        value = {"M": {"m": value}} if i % 2 else {"L": [value]}
    return {"deep": value}


@pytest.mark.parametrize("depth", [3, 4, 5, 9, 20])
def test_depth_limit_and_fallback(spark, depth):
    image = _nest(depth)
    expected = json.loads(decode_map_text(json.dumps(image)))
    opts = DecodeOptions(max_depth=4, deep_fallback="udf")
    row = image_of(spark, image, opts)
    assert row["error"] is None
    assert json.loads(row["new_image"]) == expected
    strict = image_of(spark, image, DecodeOptions(max_depth=4, deep_fallback="error"))
    if depth + 1 > 4:
        assert json.loads(strict["error"])["error"] == "attribute values nested too deeply"
    else:
        assert json.loads(strict["new_image"]) == expected


_names = st.text(min_size=0, max_size=6)
_leaves = st.one_of(
    st.text(max_size=8).map(lambda s: {"S": s}),
    st.integers(-10**12, 10**12).map(lambda n: {"N": str(n)}),
    st.booleans().map(lambda b: {"BOOL": b}),
    st.just({"NULL": True}),
)
_values = st.recursive(
    _leaves,
    lambda kids: st.one_of(
        st.lists(kids, max_size=3).map(lambda xs: {"L": xs}),
        st.dictionaries(_names, kids, max_size=3).map(lambda d: {"M": d}),
    ),
    max_leaves=12,
)


def _escape_case(text):
    # Spark writes control characters as \u001F, Python as \u001f.
    return re.sub(r"\\u[0-9A-Fa-f]{4}", lambda m: m.group(0).lower(), text)


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.dictionaries(_names, _values, max_size=4), min_size=20, max_size=40))
def test_native_decoder_equals_python_decoder(spark, images):
    bodies = [{"Keys": {"k": {"N": str(i)}}, "NewImage": img} for i, img in enumerate(images)]
    rows = normalize_texts(spark, [record(b, event_id=str(i)) for i, b in enumerate(bodies)])
    by_id = {r["event_id"]: r for r in rows}
    for i, img in enumerate(images):
        expected = decode_map_text(json.dumps(img))
        got = by_id[str(i)]["new_image"]
        assert json.loads(got) == json.loads(expected)
        assert _escape_case(got) == _escape_case(expected)
