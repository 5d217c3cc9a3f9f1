"""Corpus pipeline: quality filter, line dedup, near-duplicate removal, decontamination, packing.

Every stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept; ``run`` writes each stage's rows as
Parquet to the shared folder and rereads them for the next one. All stages but the last return the columns of
``documents``. A row's ``n_chars`` follows its text where a stage changes it.

Defined cases: those of the operators; an empty table passes every stage as an empty table.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.llm import op2_lines, op4_packing, op7_quality, op8_decontaminate, op9_neardup
from tidewater.llm.common import WorkTables, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that the quality classifier rejects."""
    return op7_quality.keep_good(docs, table(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the lines that three or more documents share, except in the last of them."""
    lost = op2_lines.LineIndex(spark).insert(docs).dropped_keys()
    return op2_lines.without_lines(docs, lost)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the smallest doc_id of each group of near duplicates (five-word shingles, similarity 0.8)."""
    found = op9_neardup.near_duplicates(docs)
    gone = found.filter(~F.col("kept")).select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(docs.columns)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that hold a window of a benchmark item."""
    hits = op8_decontaminate.find_hits(docs, table(spark, sf_dir, "benchmark"))
    gone = hits.filter(F.col("at").isNotNull()).select(F.col("doc_id").alias("gone_id"), F.col("row").alias("gone_row")).distinct()
    same = F.col("doc_id").eqNullSafe(F.col("gone_id")) & (op8_decontaminate.row_of() == F.col("gone_row"))
    return docs.join(gone, same, "left_anti").select(docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs the remaining documents into token sequences; one row per piece."""
    return op4_packing.pack(docs, op4_packing.tokenizer_path())


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontaminated", decontaminated),
    ("packed", packed),
]

#: The classifier and the packing have no SQL form; tests/llm/test_pipeline.py compares the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    work = WorkTables(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = work.put(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
