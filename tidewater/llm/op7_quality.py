"""Quality classifier: regularised quadratic discriminant over transformed document statistics.

Every whole text becomes a short vector of statistics, transformed (logs and logits) towards normal shape. Per class
Spark sums counts, vectors and outer products over the labelled training rows; from these few numbers the driver
forms each class's mean and its covariance, shrunk towards the pooled covariance and a scaled identity, and factors it
once (Cholesky). A document's score is the logistic of the difference of the classes' log densities, from
Mahalanobis distances by those cached factors, plus the log prior ratio.

The fit reads every labelled row whose crc32(doc_id as text) mod 5 is not 0; labels, lang, source and doc_id are never
inputs of a score.

Defined cases: a null or empty text has the statistics of zero words and gets a score from the same model. Without
training rows of both classes every score is 0.5. Several labels of one document all count. A document without an id
is scored, and counts as not held out. Extra columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StructField, StructType

from tidewater.llm.common import WorkTables, own_columns, table

THRESHOLD, SHRINK, RIDGE, FOLDS = 0.3, 0.3, 0.05, 5
STATISTICS = ("chars", "words", "word_length", "upper", "digit", "symbol", "mark", "space", "distinct", "top", "repeat", "bare", "line_words", "line_repeat", "short", "capital")

#: Byte classes: upper, lower, digit, sentence marks, white space, other ASCII; bytes over 0x7F count as letters.
_UPPER, _DIGIT, _MARK, _SPACE, _SYMBOL = (np.array([c in s for c in range(256)]) for s in (
    set(range(65, 91)), set(range(48, 58)), set(b".,;:?'\"-()"), set(b" \t\n\x0b\x0c\r"), {c for c in range(33, 127) if not chr(c).isalnum()} - set(b".,;:?'\"-()"),
))


def _logit(part: float, whole: float) -> float:
    """Log odds of a share, pulled in by half a count on either side."""
    return float(np.log((part + 0.5) / (whole - part + 0.5)))


def statistics(text: bytes | None) -> list[float]:
    text = text or b""
    seen = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    upper, digit, mark, space, symbol = (int(seen[c].sum()) for c in (_UPPER, _DIGIT, _MARK, _SPACE, _SYMBOL))
    n, words, lines = len(text), text.split(), [x for x in text.split(b"\n") if x.strip()]
    ink, total = n - space, len(words)
    counts = Counter(words)
    pairs = len(set(zip(words, words[1:], strict=False)))
    capital = sum(1 for w in words if 65 <= w[0] <= 90)
    bare = sum(1 for w in words if not w[0] & 0x80 and not (65 <= w[0] <= 90 or 97 <= w[0] <= 122))
    return [
        np.log1p(n), np.log1p(total), np.log((ink + 1) / (total + 1)), _logit(upper, ink), _logit(digit, ink), _logit(symbol, ink), _logit(mark, ink), _logit(space, n),
        np.log((len(counts) + 1) / (total + 1) ** 0.8), _logit(max(counts.values(), default=0), total), _logit(total - 1 - pairs if total > 1 else 0, max(total - 1, 0)), _logit(bare, total),
        np.log((total + 1) / (len(lines) + 1)), _logit(len(lines) - len(set(lines)), len(lines)), _logit(sum(len(w) <= 3 for w in words), total), _logit(capital, total),
    ]


def _described(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        made = [statistics(t) for t in batch.column(1).cast(pa.binary()).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(made, pa.list_(pa.float64()))], ["doc_id", "x"])


def describe(docs: DataFrame) -> DataFrame:
    """(doc_id, x): the statistics of every whole text."""
    return own_columns(docs, "doc_id", "text").mapInArrow(_described, "doc_id long, x array<double>")


def held_out(doc_id: Column, folds: int = FOLDS) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == 0, F.lit(False))


@dataclass(frozen=True)
class Discriminant:
    """Means, Cholesky factors and log weights of both classes; ``None`` in place of one that can't be fitted."""

    means: np.ndarray  # (2, d)
    factors: np.ndarray  # (2, d, d), lower triangles
    weights: np.ndarray  # (2,): log prior minus log determinant of the factor

    def scores(self, x: np.ndarray) -> np.ndarray:
        logs = [w - 0.5 * (np.linalg.solve(f, (x - m).T) ** 2).sum(axis=0) for m, f, w in zip(self.means, self.factors, self.weights, strict=True)]
        return 1 / (1 + np.exp(-np.clip(logs[1] - logs[0], -700, 700)))


def fit(described: DataFrame, labels: DataFrame, shrink: float = SHRINK, ridge: float = RIDGE, folds: int = FOLDS) -> Discriminant | None:
    """Fits on the labelled rows outside the held-out fold. Only each class's sums reach the driver (two rows)."""
    marks = own_columns(labels, "doc_id", "quality").filter(F.col("quality").isin(0, 1) & ~held_out(F.col("doc_id"), folds))
    rows = described.join(marks, "doc_id")
    d = len(STATISTICS)
    x = [F.col("x")[i] for i in range(d)]
    cells = [(i, j) for i in range(d) for j in range(i + 1)]
    sums = rows.groupBy("quality").agg(F.count(F.lit(1)).alias("n"), F.array(*[F.sum(c) for c in x]).alias("sum"), F.array(*[F.sum(x[i] * x[j]) for i, j in cells]).alias("products"))
    found = {r["quality"]: r for r in sums.collect()}
    if set(found) != {0, 1}:
        return None
    n = np.array([found[k]["n"] for k in (0, 1)], float)
    means = np.array([found[k]["sum"] for k in (0, 1)]) / n[:, None]
    covariances = np.zeros((2, d, d))
    for k in (0, 1):
        for (i, j), total in zip(cells, found[k]["products"], strict=True):
            covariances[k, i, j] = covariances[k, j, i] = total / n[k] - means[k, i] * means[k, j]
    pooled = np.tensordot(n / n.sum(), covariances, 1)
    scale = np.diag(np.diag(pooled) + 1e-6)
    factors = np.linalg.cholesky((1 - shrink) * covariances + shrink * pooled + ridge * scale)
    return Discriminant(means, factors, np.log(n / n.sum()) - np.log(np.diagonal(factors, axis1=1, axis2=2)).sum(axis=1))


def score(described: DataFrame, model: Discriminant | None) -> DataFrame:
    """(doc_id, score) of every described row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
            scores = model.scores(x) if model and batch.num_rows else np.full(batch.num_rows, 0.5)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64())], ["doc_id", "score"])

    return described.mapInArrow(run, "doc_id long, score double")


def classify(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, held_out, score, predicted) of each document row."""
    described = WorkTables(docs.sparkSession).put(describe(docs), "statistics")
    scored = score(described, fit(described, labels))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs``, with all their columns, whose text scores at least ``threshold``."""
    row = docs.select(F.col("doc_id"), F.col("text"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    shape = StructType([*row.select("doc_id", "row").schema, StructField("x", ArrayType(DoubleType()))])

    def described(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [statistics(t) for t in batch.column(1).cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(made, pa.list_(pa.float64()))], ["doc_id", "row", "x"])

    rows = WorkTables(docs.sparkSession).put(row.mapInArrow(described, shape), "statistics")
    model = fit(rows.select("doc_id", "x"), labels)

    @F.pandas_udf("double")
    def judge(x: pd.Series) -> pd.Series:
        return pd.Series(model.scores(np.stack(x.to_numpy())) if model and len(x) else np.full(len(x), 0.5))

    return rows.filter(judge("x") >= threshold).select("row.*")


def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
