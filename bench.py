"""Bench: run the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS] and
print one JSON line.  Each query runs to completion into Spark's ``noop`` sink
(the whole plan executes, nothing is collected to the driver).  Each query is
timed $BENCH_RUNS times (default 3) and the median is reported."""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from keytally.plans import catalog, streams  # noqa: E402
from keytally.session import build_session  # noqa: E402

HEADLINE = list(catalog.BATCH_QUERIES)
STREAMS = list(streams.STREAM_QUERIES)


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=cpus, app_name="keytally-bench")
    # warm-up: every query once on the smallest tables (JIT, code generation,
    # were also taken after a warm-up.
    warm = "/root/testdata/sf0.001"
    if os.path.isdir(warm) and os.environ.get("BENCH_WARMUP", "1") == "1":
        for name in HEADLINE:
            run(catalog.BATCH_QUERIES[name](spark, warm))
        for name in STREAMS:
            run(streams.STREAM_QUERIES[name](spark, warm))

    runs = max(1, int(os.environ.get("BENCH_RUNS", "3")))

    def timed(build) -> float:
        samples = []
        for _ in range(runs):
            t0 = time.perf_counter()
            run(build())  # the plan is built inside the timing (streams run here)
            samples.append(time.perf_counter() - t0)
        return round(statistics.median(samples), 3)

    times: dict[str, float] = {}
    for name in HEADLINE:
        times[name] = timed(lambda: catalog.BATCH_QUERIES[name](spark, sf_dir))
    for name in STREAMS:
        times[name] = timed(lambda: streams.STREAM_QUERIES[name](spark, sf_dir))
    spark.stop()
    sf = os.path.basename(sf_dir).replace("sf", "")
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": sf, "cpus": cpus, "runs": runs, "stat": "median",
                      "warmup": os.environ.get("BENCH_WARMUP", "1") == "1"}))


if __name__ == "__main__":
    main()
