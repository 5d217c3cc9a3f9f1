"""Session settings and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings every job relies on: AQE re-plans joins and shuffles at run time,
# splits skewed partitions and coalesces small ones; rebalance before writes
# splits hot buckets.
JOB_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def build_session(master: str = "local[*]", shuffle_partitions: int = 8, app: str = "tidewater", **extra) -> SparkSession:
    """A session for tests and local runs (clusters bring their own)."""
    builder = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in {**JOB_CONF, **extra}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def apply_job_conf(spark: SparkSession) -> None:
    for key, value in JOB_CONF.items():
        spark.conf.set(key, value)


@contextmanager
def conf_held(spark: SparkSession, conf: dict[str, str]) -> Iterator[None]:
    """The session with these settings, its own ones put back at the end."""
    before = {key: spark.conf.get(key, None) for key in conf}
    try:
        for key, value in conf.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def shuffles_dropped(spark: SparkSession):
    """Shuffle files go when the query that wrote them ends (from Spark 4.1 on).

    Otherwise they stay until the driver happens to collect its garbage, so a
    job of several large writes has those of all of them on disk at once.
    """
    return conf_held(spark, {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"})


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this setting names shared storage and is always read from
    the session. Only when it is unset (local runs, tests) a folder is made
    for a local session; elsewhere a machine-local folder would lose rows,
    so that is an error.
    """
    conf = spark.sparkContext.getConf()
    path = spark.conf.get("spark.checkpoint.dir", None) or conf.get("spark.checkpoint.dir", None)
    if not path:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        path = tempfile.mkdtemp(prefix="tidewater-ckpt-")
        spark.conf.set("spark.checkpoint.dir", path)
    return path.rstrip("/")


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A new, unique path under the shared checkpoint folder."""
    return "/".join([checkpoint_dir(spark), *parts, uuid.uuid4().hex])
