"""Benchmark: the nine jobs (JOB_A..JOB_I) and the end-to-end pipeline.

Runs on ``local[$BENCH_CPUS]`` over ``$BENCH_SF_DIR`` (default sf0.1) and prints
one JSON line. Each query is executed in full with the ``noop`` sink (the whole
plan runs, nothing is collected to the driver); the best of ``$BENCH_REPEATS``
runs is reported per query after one warm-up pass.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from roomrate.plans.pipeline import Models, price_all  # noqa: E402
from roomrate.plans.extracts import AS_OF, CRAWL_AS_OF  # noqa: E402
from roomrate.registry import queries  # noqa: E402
from roomrate.session import local_session  # noqa: E402
from roomrate.sources.ensemble import CRAWL_MODEL, OWN_MODEL, ROOM_MODEL, demo_model  # noqa: E402
from roomrate.sources.tables import RentalTables  # noqa: E402

HEADLINE = ("job_a", "job_b", "job_c", "job_d", "job_e", "job_f", "job_g", "job_h", "job_i")


def _run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeats = int(os.environ.get("BENCH_REPEATS", "2"))
    spark = local_session(cores=cpus, shuffle_partitions=int(cpus) * 2 if cpus.isdigit() else 16, app="roomrate-bench")
    qs = queries()
    _run(qs["job_a"](spark, sf_dir))  # warm-up: JIT, parquet footers, python workers

    times = {}
    for name in HEADLINE:
        best = float("inf")
        for _ in range(repeats):
            t0 = time.perf_counter()
            _run(qs[name](spark, sf_dir))
            best = min(best, time.perf_counter() - t0)
        times[name] = round(best, 3)

    out_root = tempfile.mkdtemp(prefix="roomrate-bench-out-")
    t0 = time.perf_counter()
    models = Models(demo_model(OWN_MODEL), demo_model(CRAWL_MODEL), demo_model(ROOM_MODEL))
    price_all(RentalTables.from_driver(spark, sf_dir), models, out_root, AS_OF, CRAWL_AS_OF)
    times["pipeline_csv"] = round(time.perf_counter() - t0, 3)

    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(
        json.dumps(
            {
                "metric": "jobs_total_time",
                "value": round(sum(times[q] for q in HEADLINE), 3),
                "unit": "sec",
                "queries": times,
                "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
                "cpus": cpus,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
