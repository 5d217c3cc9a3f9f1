"""Chat formatting with cumulative-snapshot collapse.

A logged conversation is often stored again and again as it grows. Each conversation becomes its ordered turns and the
rolling hashes of its turn prefixes (each hash covers the one before it and the turn's role and text). A conversation
whose whole hash is a proper prefix hash of another one is a snapshot of it; an anti-join keeps the maximal ones, and
of equal conversations the one with the smallest conv_id. Those are rendered.

Only a conversation's own turns meet in one row. Equal conversations are collapsed by their hash before the anti-join,
so its left side has every key once, and the prefix side is distinct: a first turn or a whole conversation that a third
of all rows share is one row on either side.

Defined cases: turns without conv_id belong to no conversation and are left out. Exactly repeated rows are one turn;
turns of one number follow in the order of role and text, a null number first. A null role or text is an empty string
and equal to it; an empty turn is a turn. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, StructField, StructType

from tidewater.llm.common import WorkTables, own_columns, table

TEMPLATE = "<|{role}|>\n{text}\n"


def _rolling(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds the hash of every turn prefix; one pass over the turns, however many a conversation has."""
    for batch in batches:
        all_hashes = []
        for turns in batch.column(1).to_pylist():
            sofar, hashes = hashlib.blake2b(digest_size=16), []
            for t in turns:
                role, text = t["role"].encode(), t["text"].encode()
                sofar.update(b"%d/%d/" % (len(role), len(text)) + role + text)
                hashes.append(sofar.digest())
            all_hashes.append(hashes)
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(all_hashes, pa.list_(pa.binary()))], ["conv_id", "turns", "hashes"])


def render(turns: Column, template: str = TEMPLATE) -> Column:
    """The turns in a chat template with the fields {role} and {text}."""
    before, between, after = template.partition("{role}")[0], template.partition("{role}")[2].partition("{text}")[0], template.partition("{text}")[2]
    return F.array_join(F.transform(turns, lambda t: F.concat(F.lit(before), t["role"], F.lit(between), t["text"], F.lit(after))), "")


def conversations(rows: DataFrame) -> DataFrame:
    """(conv_id, turns, hashes) of each conversation."""
    clean = own_columns(rows, "conv_id", "turn", "role", "text").filter("conv_id IS NOT NULL")
    turn = F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    whole = clean.groupBy("conv_id").agg(F.array_sort(F.collect_set(turn)).alias("turns"))
    return whole.mapInArrow(_rolling, StructType([*whole.schema, StructField("hashes", ArrayType(BinaryType()))]))


def collapse(rows: DataFrame) -> DataFrame:
    """(conv_id, n_turns, n_copies, turns) of the maximal conversations; n_copies counts equal ones besides."""
    work = WorkTables(rows.sparkSession)
    known = work.put(conversations(rows), "conversations")
    whole = F.element_at("hashes", -1).alias("whole")
    prefixes = known.select(F.explode(F.expr("slice(hashes, 1, size(hashes) - 1)")).alias("whole")).distinct()
    single = known.select("conv_id", whole).groupBy("whole").agg(F.min("conv_id").alias("conv_id"), (F.count(F.lit(1)) - 1).alias("n_copies"))
    kept = single.join(prefixes, "whole", "left_anti").select("conv_id", "n_copies")
    return known.join(kept, "conv_id").select("conv_id", F.size("turns").cast("long").alias("n_turns"), "n_copies", "turns")


def op3_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = collapse(table(spark, sf_dir, "conversations"))
    return kept.select("conv_id", "n_turns", "n_copies", render(F.col("turns")).alias("rendered"))


ORACLE = """
WITH turns AS (
  SELECT DISTINCT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL
), steps AS (
  SELECT *, sha256(role || chr(31) || length(text) || chr(31) || text) AS step,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS nth FROM turns
), prefixes AS (
  SELECT conv_id, nth, string_agg(step, '') OVER (PARTITION BY conv_id ORDER BY nth) AS prefix,
         count(*) OVER (PARTITION BY conv_id) AS n_turns FROM steps
), wholes AS (
  SELECT prefix, min(conv_id) AS conv_id, min(n_turns) AS n_turns, count(*) - 1 AS n_copies
  FROM prefixes WHERE nth = n_turns GROUP BY prefix
), kept AS (
  SELECT * FROM wholes WHERE prefix NOT IN (SELECT prefix FROM prefixes WHERE nth < n_turns)
)
SELECT k.conv_id, k.n_turns, k.n_copies,
       string_agg('<|' || s.role || '|>' || chr(10) || s.text || chr(10), '' ORDER BY s.nth) AS rendered
FROM kept k JOIN steps s USING (conv_id) GROUP BY k.conv_id, k.n_turns, k.n_copies
"""
