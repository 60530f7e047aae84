"""Skew diagnostic: a third of all observations on one station, per-task shuffle reads.

Derives a skewed copy of the observations from the driver's events table (station 0 receives
every station id divisible by 3), runs the curated summary, and reads the per-task shuffle
metrics from Spark's event log (written to a fresh scratch folder). For contrast it also runs a
top-1 window keyed by the station alone, the layout that would put the hot station in one task.

A second run puts a third of all rows into one (station, hour) group, copies of one reading.

Usage: python tools/skew_check.py [sf_dir]
"""

from __future__ import annotations

import glob
import json
import os
import statistics
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def stage_reads(log_dir: str) -> dict[str, dict[int, list[int]]]:
    """Shuffle records read per task, by job group and stage, from the (rolling) event log."""
    group_of_stage: dict[int, str] = {}
    reads: dict[int, list[int]] = {}
    for path in sorted(glob.glob(f"{log_dir}/**/*", recursive=True)):
        if os.path.isdir(path):
            continue
        with open(path) as f:
            for line in f:
                ev = json.loads(line)
                if ev.get("Event") == "SparkListenerJobStart":
                    group = (ev.get("Properties") or {}).get("spark.jobGroup.id")
                    for sid in ev.get("Stage IDs", []):
                        group_of_stage[sid] = group
                elif ev.get("Event") == "SparkListenerTaskEnd":
                    m = (ev.get("Task Metrics") or {}).get("Shuffle Read Metrics") or {}
                    if m.get("Total Records Read", 0):
                        reads.setdefault(ev["Stage ID"], []).append(m["Total Records Read"])
    out: dict[str, dict[int, list[int]]] = {}
    for sid, r in reads.items():
        out.setdefault(group_of_stage.get(sid) or "?", {})[sid] = r
    return out


def main(argv):
    from pyspark.sql import Window
    from pyspark.sql import functions as F

    from stationlake import get_session
    from stationlake.operators import curate, summarize
    from stationlake.sources.fixtures import raw_observations

    sf_dir = argv[0] if argv else "/root/testdata/sf0.1"
    log_dir = tempfile.mkdtemp(prefix="stationlake-eventlog-")
    spark = get_session("local[8]", 32, extra={
        "spark.eventLog.enabled": "true", "spark.eventLog.dir": log_dir, "spark.eventLog.compress": "false",
        "spark.sql.adaptive.coalescePartitions.enabled": "false"})  # keep the 32 reducers visible
    raw = raw_observations(spark, sf_dir)
    hot = raw.withColumn("station_id", F.when(F.col("station_id") % 3 == 0, F.lit(0)).otherwise(F.col("station_id")))
    share = hot.where("station_id = 0").count() / hot.count()

    def run(label, df):
        spark.sparkContext.setJobGroup(label, label)
        df.write.format("noop").mode("overwrite").save()

    run("summary (window on station+hour, partial top-1)", summarize.daily_summary(curate.daily_observations(hot)))
    # a third of all rows as copies inside ONE (station, hour) group
    one = F.col("station_id") % 3 == 0
    copies = raw.withColumn("station_id", F.when(one, F.lit(0)).otherwise(F.col("station_id"))).withColumn(
        "timestamp", F.when(one, F.lit("2024-01-15 10:30:00").cast("timestamp_ntz")).otherwise(F.col("timestamp")))
    run("one station-hour holding a third of the rows", curate.daily_observations(copies))
    w = Window.partitionBy("station_id").orderBy(*curate.latest_order())
    run("contrast: window keyed by station only", hot.withColumn("rn", F.row_number().over(w)).where("rn > 0"))
    spark.stop()  # flushes the event log
    print(f"hot station share of rows: {share:.1%}")
    for label, stages in stage_reads(log_dir).items():
        for sid, reads in sorted(stages.items()):
            print(f"{label}: stage {sid}: tasks={len(reads)} records max={max(reads)} "
                  f"median={statistics.median(reads):.0f} max/total={max(reads) / sum(reads):.1%}")


if __name__ == "__main__":
    main(sys.argv[1:])
