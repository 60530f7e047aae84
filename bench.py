"""Benchmark: headline queries on $BENCH_SF_DIR (default /root/testdata/sf0.1) on local[$BENCH_CPUS].

The driver's tables are single files of one row group, which Spark cannot split, so they are copied
once, before anything is timed, to as many files as there are CPUs ($BENCH_WIDEN=0 reads them as
they are). Each query is executed in full into Spark's ``noop`` sink (every row computed, nothing collected),
once to warm up and then timed as the best of $BENCH_REPEAT (default 3) runs. Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "daily_summary", "daily_summary_hot_station", "quality_report", "daily_observations", "latest_by_station", "hottest_10",
    "history_upsert", "cleanse_accept", "payload_decode", "station_name_lookup", "stream_landed_rows",
    "stored_daily_summary",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]

    from stationlake import get_session
    from stationlake.plans.queries import queries

    spark = get_session(f"local[{cpus}]", shuffle_partitions=int(cpus) * 2,
                        extra={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g")})
    source_dir = sf_dir
    if os.environ.get("BENCH_WIDEN", "1") != "0":
        from stationlake.session import shared_dir

        sf_dir = f"{shared_dir(spark, 'bench')}/{os.path.basename(sf_dir.rstrip('/'))}"
        for table in ("events", "supplier", "nation"):
            spark.read.parquet(f"{source_dir}/{table}.parquet").repartition(int(cpus)).write.parquet(f"{sf_dir}/{table}.parquet")
    qs = queries()
    names = only or HEADLINE
    spark.range(1000).selectExpr("sum(id)").collect()  # start executors and codegen caches

    times: dict[str, float | None] = {}
    errors: dict[str, str] = {}
    for name in names:
        best = None
        try:
            for i in range(repeat + 1):
                t0 = time.perf_counter()
                qs[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
                dt_ = time.perf_counter() - t0
                if i > 0 or repeat == 0:
                    best = dt_ if best is None else min(best, dt_)
            times[name] = round(best, 3)
        except Exception as e:  # keep measuring the rest; report the failure in the JSON line
            times[name] = None
            errors[name] = f"{type(e).__name__}: {str(e)[:200]}"
    from stationlake.sources.fixtures import raw_observations

    raw_rows = raw_observations(spark, sf_dir).count()
    sf = os.path.basename(source_dir.rstrip("/")).replace("sf", "")
    out = {"metric": "headline_total_sec", "value": round(sum(v for v in times.values() if v), 3), "unit": "sec",
           "queries": times, "sf": float(sf) if sf.replace(".", "").isdigit() else sf, "cpus": int(cpus),
           "raw_rows": raw_rows, "files_per_table": int(cpus) if sf_dir != source_dir else 1}
    # Throughput of the two paths the reference runs continuously / nightly, in observations per second.
    for q, key in (("stream_landed_rows", "landing_rows_per_sec"), ("stored_daily_summary", "daily_job_rows_per_sec")):
        if times.get(q):
            out[key] = round(raw_rows / times[q])
    if errors:
        out["errors"] = errors
    print(json.dumps(out))


if __name__ == "__main__":
    main()
