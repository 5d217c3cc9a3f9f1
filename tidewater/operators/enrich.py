"""Join each change to the lookup record(s) its new image points at."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.functions.attributes import ITEM_SEP

FILL_COLUMNS = ("raw_s3_payload", "new_image", "old_image")


def pack_lookup(lookup: DataFrame) -> DataFrame:
    """All records of one URI as one JSON array (``multi="array"``).

    The group is one file's records, in the order of their text, so a replay
    gives the same array; the partial aggregate runs before the shuffle.
    """
    return lookup.groupBy("s3_uri").agg(
        F.concat(F.lit("["), F.array_join(F.array_sort(F.collect_list("raw_s3_payload")), ITEM_SEP), F.lit("]")).alias(
            "raw_s3_payload"
        )
    )


def link() -> F.Column:
    """The URI that a change's new image points at."""
    return F.get_json_object("new_image", "$.s3_uri")


def no_link() -> F.Column:
    return F.concat(F.lit("\0"), F.xxhash64("keys", "event_id", "error").cast("string"))


def enrich(changes: DataFrame, lookup: DataFrame, multi: str = "rows", broadcast: bool = False) -> DataFrame:
    """Left join on ``new_image.s3_uri = lookup.s3_uri``.

    Every change is kept. ``s3_uri`` comes from the lookup side, so it is
    NULL when nothing matched; ``raw_s3_payload`` and both images are ``{}``
    instead of NULL. With several lookup records per URI, ``multi="rows"``
    yields one row per record, ``multi="array"`` one row holding them all.

    The join strategy is left to AQE: a lookup under the broadcast
    threshold (by its measured size) is broadcast, a larger one is
    shuffled, and a hot URI is split by the skew-join handling. Rows without
    a link join on a text that no URI equals (it starts with NUL) and that
    differs by key, so they don't share one partition.
    ``broadcast=True`` adds the hint; the jobs pass it only after checking
    the lookup's size on disk against ``LookupConfig.broadcast_limit_bytes``.
    """
    right = pack_lookup(lookup) if multi == "array" else lookup.select("s3_uri", "raw_s3_payload")
    right = right.select(F.col("s3_uri").alias("_lookup_uri"), F.col("raw_s3_payload"))
    if broadcast:
        right = F.broadcast(right)
    left = changes.withColumn("_link", F.coalesce(link(), no_link()))
    joined = left.join(right, left["_link"] == right["_lookup_uri"], "left")
    out = joined.withColumn("s3_uri", F.col("_lookup_uri")).drop("_link", "_lookup_uri")
    return out.na.fill("{}", list(FILL_COLUMNS))
