"""Write PLANS.md: the physical plans of the main flows, as Spark formats them.

Usage: python tools/show_plans.py [sf_dir]
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from tidewater.config import TargetConfig  # noqa: E402
from tidewater.functions.keys import merge_key  # noqa: E402
from tidewater.operators import upsert as U  # noqa: E402
from tidewater.operators.enrich import enrich  # noqa: E402
from tidewater.operators.latest import latest_per_key  # noqa: E402
from tidewater.operators.normalize import normalize_changes, normalize_export  # noqa: E402
from tidewater.plans import feeds  # noqa: E402
from tidewater.plans.batch import apply_change_batch  # noqa: E402
from tidewater.session import build_session, scratch_path  # noqa: E402

KEEP = ("Scan", "Exchange", "WindowGroupLimit", "Window", "Join", "Filter", "Union", "ArrowEvalPython",
        "BatchEvalPython", "HashAggregate", "SortAggregate", "ObjectHashAggregate", "BroadcastExchange",
        "PartitionFilters", "PushedFilters", "ReadSchema", "AdaptiveSparkPlan", "WriteFiles")


def _scan(line: str) -> str:
    """A FileScan line cut down to what shows pushdown and pruning."""
    head = line[: line.index("FileScan") + len("FileScan parquet")]
    parts = [m.group(0) for m in re.finditer(r"(PartitionFilters|PushedFilters|ReadSchema): (\[[^\]]*\]|struct<[^>]*>)", line)]
    return head + " " + ", ".join(parts)


def outline(df) -> str:
    plan = df._jdf.queryExecution().executedPlan().toString()
    lines = [ln.rstrip() for ln in plan.split("\n") if any(k in ln for k in KEEP)]
    lines = [_scan(ln) if "FileScan" in ln else ln for ln in lines]
    return "\n".join(ln if len(ln) < 240 else ln[:237] + "..." for ln in lines)


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session("local[8]", 8)
    sections = []
    feed = feeds.change_feed(spark, sf_dir).select("value")
    sections.append(("Stream batch: decode + latest per key (partial limit before the shuffle, no Python)",
                     latest_per_key(normalize_changes(feed))))
    target = TargetConfig(path=scratch_path(spark, "plans", "target"), buckets=16)
    apply_change_batch(spark, feeds.change_batches(spark, sf_dir)[0], target, batch_id=0)
    staged = latest_per_key(normalize_changes(feeds.change_batches(spark, sf_dir)[1]))
    staged = staged.withColumn(U.MK, merge_key()).withColumn(U.BUCKET, U.bucket_of(F.col(U.MK), 16))
    staging = scratch_path(spark, "plans", "staging")
    U._write_buckets(staged, staging)
    staged = spark.read.parquet(staging)
    old = U.read_target(spark, target).filter(F.col(U.BUCKET).isin([1, 2, 3])).withColumn(U.MK, merge_key())
    sections.append(("Upsert merge: touched buckets only (PartitionFilters), anti join on (bucket, key)",
                     U._merge_rows(old, staged, order_guard=False)))
    sections.append(("Upsert merge with the order guard",
                     U._merge_rows(old, staged, order_guard=True)))
    lines = feeds.export_lines(spark, sf_dir)
    sections.append(("Bulk load rows: text in, one projection, no shuffle",
                     normalize_export(lines, feeds.EXPORT_KEYS, "orders", "run")))
    sections.append(("Lookup left join (AQE chooses broadcast or shuffle by measured size)",
                     enrich(latest_per_key(normalize_changes(feeds.lookup_feed(spark, sf_dir))),
                            feeds.page_lookup(spark, sf_dir))))
    sections.append(("Reading the target: bucket pruning and column pruning",
                     U.read_target(spark, target).filter(F.col("bucket") == 3).select("keys", "new_image")))
    out = ["# PLANS", "", f"Physical plans (outline) at `{sf_dir}`, written by `tools/show_plans.py`.", ""]
    for title, df in sections:
        out += [f"## {title}", "", "```", outline(df), "```", ""]
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md"), "w") as f:
        f.write("\n".join(out))
    spark.stop()


if __name__ == "__main__":
    main()
