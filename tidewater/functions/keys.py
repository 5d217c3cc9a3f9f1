"""The merge key: what identifies a row in the target."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: prefix of the merge key of a row without keys. It starts with
# a control character, so it never equals decoded keys text.
ERROR_KEY_PREFIX = "\u0000error:"


def error_key() -> Column:
    """A hash of a record's event id and raw text."""
    fingerprint = F.sha2(F.concat_ws("\u0000", F.coalesce(F.col("event_id"), F.lit("")), F.col("raw_payload")), 256)
    return F.concat(F.lit(ERROR_KEY_PREFIX), fingerprint)


def merge_key() -> Column:
    """``keys``; for a row without keys (a parse error), a hash of its event
    id and raw text, so every distinct bad record stays a row of its own and
    a replayed one replaces itself instead of being added again."""
    return F.coalesce(F.col("keys"), error_key())


def bucket_of(key: Column, buckets: int) -> Column:
    """Target bucket of a merge key."""
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")
