"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each query is built (including its small driver-side reads) and executed in
full through the ``noop`` sink; the time is the best of ``$BENCH_REPEAT`` runs
(default 2: the first run also warms the JVM and the Python workers).
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from prefdata.catalog import QUERIES  # noqa: E402
from prefdata.session import local_session  # noqa: E402

HEADLINE = [
    "split_exact", "first_n", "pairs_capped", "pairs_orders", "pairs_large_question", "pairs_with_text",
    "split_pairs", "vocab", "encode", "pack_blocks", "batches", "reward_batches", "reward_log",
    "html_to_markdown", "markdown_native", "shard_rows", "stream_rewards",
]


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeat = int(os.environ.get("BENCH_REPEAT", "2"))
    names = sys.argv[1:] or HEADLINE
    spark = local_session(cores=cpus, shuffle_partitions=int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", "16")),
                          app="prefdata-bench")
    times: dict[str, float] = {}
    for name in names:
        best = None
        for _ in range(repeat):
            t0 = time.perf_counter()
            QUERIES[name](spark, sf).write.format("noop").mode("overwrite").save()
            dt = time.perf_counter() - t0
            best = dt if best is None else min(best, dt)
        times[name] = round(best, 3)
        print(f"{name}: {best:.2f}s", file=sys.stderr)
    sf_val = sf.rstrip("/").rsplit("sf", 1)[-1]
    print(json.dumps({"metric": "sum_of_query_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": float(sf_val) if sf_val.replace(".", "").isdigit() else sf,
                      "cpus": int(cpus)}))
    spark.stop()


if __name__ == "__main__":
    main()
