"""Benchmark: run every registered query at $BENCH_SF_DIR and print one JSON line.

Each query is executed in full with the ``noop`` sink (every row computed,
nothing collected to the driver).  Every query is run $BENCH_REPEAT times
(default 3): ``queries`` holds the best run per query (warm JVM and code
generation), ``cold_total_sec`` the sum of the first runs.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

The derived ERP tables are also written once as Parquet in the production
layout (``write_catalog``: season and creation-year partitions, buckets by
batch), and the four reports are timed again on that catalog (``staged``);
staging time is reported separately, BENCH_STAGE=0 leaves this out.  The
staging folder is taken from ``spark.checkpoint.dir`` when the session has one;
only a local master gets a fresh scratch folder instead.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from binyard.plans import checks  # noqa: E402
from binyard.session import build_session  # noqa: E402

REPORTS = ("batch_packout", "defect_share", "pack_units", "bin_intake")


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeat = max(1, int(os.environ.get("BENCH_REPEAT", "3")))
    only = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n]
    spark = build_session(f"local[{cpus}]", app="binyard-bench", shuffle_partitions=cpus * 2,
                          extra={"spark.driver.memory": os.environ.get("BENCH_MEM", "16g")})
    names = only or list(checks.CHECKS)

    # Warm-up: JVM, Parquet footers, codegen caches.
    checks.run(spark, sf_dir, "scan_prune").write.format("noop").mode("overwrite").save()

    runs, errors = {name: [] for name in names}, {}
    for _ in range(repeat):
        for name in names:
            if name in errors:
                continue
            t0 = time.perf_counter()
            try:
                checks.run(spark, sf_dir, name).write.format("noop").mode("overwrite").save()
            except Exception as exc:  # keep timing the others; report the failure
                errors[name] = f"{type(exc).__name__}: {str(exc)[:200]}"
                print(f"bench: {name} failed: {errors[name]}", file=sys.stderr)
                continue
            runs[name].append(time.perf_counter() - t0)
    timings = {name: round(min(r), 3) for name, r in runs.items() if r}
    cold = round(sum(r[0] for r in runs.values() if r), 3)

    # Jobs and stages per report (status tracker; the web UI stays off).
    sc, shape = spark.sparkContext, {}
    for name in [n for n in REPORTS if n in timings]:
        group = f"shape-{name}"
        sc.setJobGroup(group, group)
        checks.run(spark, sf_dir, name).write.format("noop").mode("overwrite").save()
        tracker = sc.statusTracker()
        jobs = [tracker.getJobInfo(j) for j in tracker.getJobIdsForGroup(group)]
        shape[name] = {"jobs": len(jobs), "stages": sum(len(j.stageIds) for j in jobs if j)}
    sc.setJobGroup("bench", "bench")

    staged = None
    if os.environ.get("BENCH_STAGE", "1") == "1":
        from binyard.sources.sinks import write_catalog
        from binyard.sources.testdata import TestdataCatalog
        base = spark.conf.get("spark.checkpoint.dir", None)
        if not base and not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        base = base or tempfile.mkdtemp(prefix="binyard-")
        root = f"{base.rstrip('/')}/erp-{os.getpid()}-{int(time.time())}"
        t0 = time.perf_counter()
        pq = write_catalog(TestdataCatalog.shared(spark, sf_dir), root, buckets=cpus * 2)
        staged = {"stage_sec": round(time.perf_counter() - t0, 3)}
        for name in REPORTS:
            best = None
            for _ in range(repeat):
                t0 = time.perf_counter()
                checks.run_on(pq, name).write.format("noop").mode("overwrite").save()
                dt = time.perf_counter() - t0
                best = dt if best is None else min(best, dt)
            staged[name] = round(best, 3)
    spark.stop()

    sf = os.path.basename(sf_dir).removeprefix("sf")
    print(json.dumps({
        "metric": "total_query_sec",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "reports_sec": round(sum(v for k, v in timings.items() if k in REPORTS), 3),
        "cold_total_sec": cold,
        "report_shape": shape,
        **({"staged": staged} if staged else {}),
        **({"errors": errors} if errors else {}),
        "repeat": repeat,
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
        "cpus": cpus,
    }))


if __name__ == "__main__":
    main()
