"""How the feeds of the given tables are dealt over tasks."""

import glob

import duckdb
import pytest
from pyspark.sql import functions as F

from tidewater.plans import feeds


@pytest.mark.parametrize("feed", ["change_feed", "lookup_feed", "deep_feed"])
def test_a_table_of_one_row_group_is_dealt_over_the_tasks(spark, tmp_dir, feed):
    """The file has more splits than the session cores, but all rows are in one of them."""
    con = duckdb.connect()
    con.execute(f"""COPY (SELECT e AS event_id, TIMESTAMP '2024-01-02' + INTERVAL 1 SECOND * e AS ts, e % 100 AS user_id, 'view' AS event_type,
                    random() AS value, '{{"k":1}}' AS props FROM range(4000) t(e)) TO '{tmp_dir}/events.parquet'""")
    con.execute(f"COPY (SELECT p AS page_id, 'http://h/' || p AS url FROM range(50) t(p)) TO '{tmp_dir}/pages.parquet'")
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        for key in before:
            spark.conf.set(key, "4000")
        assert feeds.table(spark, tmp_dir, "events").rdd.getNumPartitions() > 4
        rows = getattr(feeds, feed)(spark, tmp_dir).groupBy(F.spark_partition_id().alias("task")).count().collect()
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    assert sum(r["count"] for r in rows) == 4000 and max(r["count"] for r in rows) < 2000


def test_pieces_follow_the_bytes_of_the_table(spark, tmp_dir):
    cores = spark.sparkContext.defaultParallelism
    for name, size in (("small", 10), ("large", 9 * cores * feeds.PIECE_BYTES)):
        with open(f"{tmp_dir}/{name}.parquet", "wb") as f:
            f.truncate(size)
    assert [feeds.pieces(spark, tmp_dir, name) for name in ("small", "large")] == [cores, 9 * cores]


def test_page_files_are_written_by_several_tasks(spark, tmp_dir):
    duckdb.connect().execute(f"COPY (SELECT p AS page_id FROM range(1600) t(p)) TO '{tmp_dir}/pages.parquet'")
    feeds.write_page_files(spark, tmp_dir, f"{tmp_dir}/files", 0)
    files = glob.glob(f"{tmp_dir}/files/file=*/part-*")
    assert len(files) == 40 and len({f.split("part-")[1][:5] for f in files}) > 1
    assert spark.read.text(f"{tmp_dir}/files").count() == 800
