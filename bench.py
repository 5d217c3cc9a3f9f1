"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints one JSON line. Each query is timed end to end (planning, the jobs it
runs, and a full evaluation of its result through the ``noop`` sink), RUNS
times; ``queries`` has the medians and ``first_run`` the first times, which
still compile code.
"""

from __future__ import annotations

import json
import os
import sys
import time
from statistics import median

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tidewater.operators.latest import latest_per_key  # noqa: E402
from tidewater.operators.normalize import normalize_changes  # noqa: E402
from tidewater.plans import catalog, feeds  # noqa: E402
from tidewater.session import build_session  # noqa: E402

RUNS = 3

HEADLINE = {
    "latest_per_key": catalog.latest_per_key_query,
    "upsert_batches": catalog.upsert_batches,
    "bulk_load": catalog.bulk_load,
    "lookup_left_join": catalog.lookup_left_join,
    "decode_images": catalog.decode_images,
    "stream_replay": catalog.stream_replay,
}


def timed(spark, fn, sf_dir):
    t = time.time()
    fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return round(time.time() - t, 3)


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = build_session(f"local[{cpus}]", cpus, app="tidewater-bench")
    # Warm-up, not timed: a long-running job plans and runs on a warm JVM.
    warm = feeds.change_feed(spark, sf_dir).select("value").limit(200)
    latest_per_key(normalize_changes(warm)).write.format("noop").mode("overwrite").save()
    runs = {name: [timed(spark, fn, sf_dir) for _ in range(RUNS)] for name, fn in HEADLINE.items()}
    times = {name: round(median(own), 3) for name, own in runs.items()}
    sf = sf_dir.rsplit("sf", 1)[-1]
    print(
        json.dumps(
            {
                "metric": "total_headline_sec",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "first_run": {name: own[0] for name, own in runs.items()},
                "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
                "cpus": cpus,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
