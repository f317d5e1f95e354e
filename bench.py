"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

The snapshot panel is derived from ``lineitem`` once and written as parquet
(day folders, rows sorted by stock and time) below the session's checkpoint
folder -- the way a stored snapshot table is read in production. That step
(``materialize_panel``) counts in the total. Every query then runs to a
``noop`` sink over the whole stored panel. ``snapshots_per_s`` is the online
feature stream's throughput.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = ["index_wap", "features_v1", "features_v2", "features_nb", "book_rolling", "rolling_diff",
            "book_returns", "row_moments", "triplet_imbalance", "stock_unit_stats", "tail_per_stock",
            "zero_sum", "cv_cpcv", "cv_group_kfold", "stream_tail", "index_weights"]


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    from auctide.plans import queries as Q
    from auctide.session import build_session, drop_at_exit, scratch_path
    from auctide.sources.snapshots import SNAPSHOT_SCHEMA, snapshots, write_snapshots
    from auctide.streaming import online

    spark = build_session(f"local[{cpus}]", shuffle_partitions=max(cpus, 8))
    times: dict[str, float] = {}

    path = scratch_path(spark, "bench-panel")
    t = time.perf_counter()
    write_snapshots(snapshots(spark, sf), path)
    times["materialize_panel"] = round(time.perf_counter() - t, 3)
    drop_at_exit(spark, path)
    panel = spark.read.schema(SNAPSHOT_SCHEMA).parquet(path).select(*SNAPSHOT_SCHEMA.names)
    inputs = Q.Inputs(sf, panel)

    runs: list = []
    run_stream = online.run_stream

    def watched(*a, **k):
        out = run_stream(*a, **k)
        runs.extend(out[1])
        return out

    online.run_stream = watched
    names = [n for n in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if n]
    for n in names:
        t = time.perf_counter()
        Q.QUERIES[n](spark, inputs).write.format("noop").mode("overwrite").save()
        times[n] = round(time.perf_counter() - t, 3)
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": os.path.basename(sf).replace("sf", ""), "cpus": cpus,
                      "snapshots_per_s": round(online.throughput(runs), 1)}))


if __name__ == "__main__":
    main()
