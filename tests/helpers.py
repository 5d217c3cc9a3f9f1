import json

from tidewater.config import DecodeOptions
from tidewater.operators.normalize import normalize_changes


def record(body, event_id="e1", name="MODIFY", table="t"):
    rec = {"eventID": event_id, "eventName": name, "tableName": table, "dynamodb": body}
    return json.dumps(rec)


def normalize_texts(spark, texts, opts=None):
    df = spark.createDataFrame([(t,) for t in texts], "value string")
    return [r.asDict() for r in normalize_changes(df, opts=opts or DecodeOptions()).collect()]


def image_of(spark, image, opts=None):
    """Decode one NewImage through the full record path; returns the row."""
    body = {"ApproximateCreationDateTime": 1, "Keys": {"id": {"S": "k"}}, "NewImage": image, "SizeBytes": 1}
    return normalize_texts(spark, [record(body)], opts)[0]
