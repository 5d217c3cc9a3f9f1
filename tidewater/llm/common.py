"""Helpers shared by the operators: table access, shared work tables, text and hash columns."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def work_folder(spark: SparkSession) -> str:
    """A new folder name below the shared folder that the cluster names in spark.checkpoint.dir.

    Only a local session may go without that setting (as in tests); it then gets a temporary folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="tidewater-llm-")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/tidewater-llm/{uuid.uuid4().hex}"


class WorkTables:
    """Tables written to the shared folder and read again: they cut lineage and survive lost executors.

    With ``clean`` the shuffle files of a table's job go as soon as the table is written, not when the driver collects
    its garbage: the table takes their place.
    """

    def __init__(self, spark: SparkSession, clean: bool = False):
        self.spark, self.folder, self.count, self.clean = spark, work_folder(spark), 0, clean

    def put(self, df: DataFrame, name: str = "t", **options: str) -> DataFrame:
        self.count += 1
        path = f"{self.folder}/{self.count:03d}-{name}"
        with self._cleaning():
            df.write.options(**options).parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._work_path = path  # noqa: SLF001
        return out

    @contextmanager
    def _cleaning(self) -> Iterator[None]:
        before = self.spark.conf.get(CLEANUP, None)
        if self.clean:
            self.spark.conf.set(CLEANUP, "true")
        try:
            yield
        finally:
            if self.clean:
                self.spark.conf.unset(CLEANUP) if before is None else self.spark.conf.set(CLEANUP, before)

    def drop(self, df: DataFrame) -> None:
        """Deletes a work table that no later step reads."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(df._work_path)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def lower_ascii(text: Column) -> Column:
    """A-Z to a-z; every other character stays."""
    return F.translate(text, UPPER, LOWER)


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def own_columns(df: DataFrame, *names: str) -> DataFrame:
    """The named columns only, so that no extra column of the input can clash with the operator's own."""
    return df.select(*[F.col(f"`{n}`") for n in names])
