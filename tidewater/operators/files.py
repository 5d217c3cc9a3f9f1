"""Folders of the target and of work files, through Hadoop's file system interface (any store that Spark reads)."""

from __future__ import annotations

from pyspark.sql import SparkSession


def fs_path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = fs_path(spark, path)
    return fs.exists(p)


def remove_path(spark: SparkSession, path: str) -> None:
    fs, p = fs_path(spark, path)
    if fs.exists(p):
        fs.delete(p, True)


def make_folder(spark: SparkSession, path: str) -> None:
    fs, p = fs_path(spark, path)
    fs.mkdirs(p)


def child_names(spark: SparkSession, path: str) -> list[str]:
    fs, p = fs_path(spark, path)
    if not fs.exists(p):
        return []
    return [status.getPath().getName() for status in fs.listStatus(p)]


def folder_bytes(spark: SparkSession, path: str) -> int:
    fs, p = fs_path(spark, path)
    return fs.getContentSummary(p).getLength() if fs.exists(p) else 0


def publish(spark: SparkSession, written: str, final: str) -> None:
    """Move a finished folder to its final name by one rename; the final name must be free."""
    fs, source = fs_path(spark, written)
    _, target = fs_path(spark, final)
    if fs.exists(target):
        raise FileExistsError(f"{final} exists; is another writer at work on this target?")
    if not fs.rename(source, target):
        raise OSError(f"could not rename {written} to {final}")
