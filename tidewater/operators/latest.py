"""Latest change per key.

``row_number() = 1`` over a window partitioned by the merge key is planned
by Spark as a partial ``WindowGroupLimit`` before the shuffle: every map
task keeps only its newest row per key, so a key with a huge number of
changes costs one row per task in the exchange, not all its rows.

Rows without keys (parse errors) are partitioned by their own fingerprint
(see ``merge_key``), so they are all kept; ranking them by ``keys`` would
put them in one NULL partition and keep only one. ``collapse_errors=True``
restores that old behaviour. There is deliberately no filter on ``keys``
here: a filter on a decoded column is pushed below the decoding projection
and would copy the decoder into it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewater.functions.keys import error_key, merge_key
from tidewater.functions.record import is_too_deep

TS = "approx_creation_timestamp_millis"


def latest_per_key(df: DataFrame, collapse_errors: bool = False) -> DataFrame:
    """Keep, per key, the row with the newest timestamp.

    Ties on the timestamp are broken by ``event_id`` (highest wins), so the
    result does not depend on how the input was partitioned. Rows flagged as
    too deep are all kept beside it: whether they count is known only once
    they are decoded (``newest_decoded``).
    """
    part = F.when(is_too_deep(F.col("error")), error_key()).otherwise(F.col("keys") if collapse_errors else merge_key())
    order = Window.partitionBy(part).orderBy(F.col(TS).desc_nulls_last(), F.col("event_id").desc_nulls_last())
    return df.withColumn("_seq", F.row_number().over(order)).filter(F.col("_seq") == 1).drop("_seq")


def newest_decoded(df: DataFrame) -> DataFrame:
    """The newest row of each key of a batch that ``latest_per_key`` left more than one, all of them decoded by now.

    The rows that a lookup made of one change share its timestamp and event, and stay together.
    """
    order = Window.partitionBy(merge_key()).orderBy(F.col(TS).desc_nulls_last(), F.col("event_id").desc_nulls_last())
    return df.withColumn("_seq", F.rank().over(order)).filter(F.col("_seq") == 1).drop("_seq")
