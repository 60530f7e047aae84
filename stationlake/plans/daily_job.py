"""The daily job (C14): curate a date range of the raw table, then summarise, report and update
the station history. Every output replaces the days of the range as one version of its table, so reruns
are idempotent and a killed run leaves each table as it was or as it is to be.

Lineage is cut once: the curated rows are written to ``daily_observations`` and the three consumers
read those date folders back instead of recomputing the hourly pick.
"""

from __future__ import annotations

import datetime as dt
import logging
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from stationlake.functions import ntz_literal
from stationlake.operators import history as hist
from stationlake.operators import partials
from stationlake.operators.curate import daily_observations
from stationlake.operators.partials import daily_partials
from stationlake.operators.summarize import daily_summary, quality_report
from stationlake.sources.tables import RAW_TABLE_SCHEMA, path_exists, read_days, read_raw, read_table, replace_days

HISTORY_MODES = ("upsert", "union_distinct")
log = logging.getLogger(__name__)


@dataclass(frozen=True)
class Layout:
    """Table folders under one root (a path every executor can reach)."""

    root: str

    def path(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"

    @property
    def raw(self) -> str:
        return self.path("raw_observations")

    @property
    def quarantine(self) -> str:
        return self.path("quarantine")

    @property
    def daily(self) -> str:
        return self.path("daily_observations")

    @property
    def summary(self) -> str:
        return self.path("daily_summary")

    @property
    def report(self) -> str:
        return self.path("quality_report")

    @property
    def partials(self) -> str:
        return self.path("daily_partials")

    @property
    def history(self) -> str:
        return self.path("station_history")


def run_days(spark: SparkSession, layout: Layout, start=None, end=None, run_ts: dt.datetime | None = None,
             history_mode: str = "upsert", stations=None, exact_distinct: bool = False,
             step: Callable[[str], None] = lambda at: None) -> dict[str, object]:
    """Process [start, end] (one day when ``end`` is None, every stored day when ``start`` is None).

    Returns the processed dates, the audit time used and the rows written per table (observed
    during the writes, no extra jobs). ``step`` is called between the steps of every table's change.
    """
    if history_mode not in HISTORY_MODES:
        raise ValueError(f"history_mode must be one of {HISTORY_MODES}")
    run_ts = run_ts or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    if start is None:
        raw = read_raw(spark, layout.raw)
        # at most one row per stored day
        days = sorted(r[0] for r in raw.where("observation_date IS NOT NULL").select("observation_date").distinct().collect())
    else:
        s = dt.date.fromisoformat(str(start))
        e = dt.date.fromisoformat(str(end if end is not None else start))
        days = [s + dt.timedelta(days=i) for i in range((e - s).days + 1)]
        raw = read_days(spark, layout.raw, days, RAW_TABLE_SCHEMA)
    curated = daily_observations(raw, start, end, run_ts=run_ts, exact_distinct=exact_distinct)
    curated = curated.withColumn("observation_date", F.to_date("timestamp"))

    seen = {name: Observation(f"{name}_rows") for name in ("daily", "summary", "report", "partials", "history")}
    # An observation only reports when its write ran over rows; empty outputs count as 0.
    wrote = dict.fromkeys(seen, False)

    def counted(df: DataFrame, name: str) -> DataFrame:
        return df.observe(seen[name], F.count(F.lit(1)).alias("n"))

    def written(df: DataFrame, name: str, path: str, date_col: str, sort_cols: list[str] | None = None) -> None:
        present = replace_days(counted(df, name), path, date_col, days, sort_cols, lambda at: step(f"{name} {at}"))
        wrote[name] = bool(present)

    written(curated, "daily", layout.daily, "observation_date", ["station_id", "timestamp"])
    daily = read_days(spark, layout.daily, days, curated.schema)

    def write_summary():
        summary = daily_summary(daily).withColumn("processing_time", ntz_literal(run_ts))
        written(summary, "summary", layout.summary, "observation_date", ["station_id"])

    def write_report():
        report = quality_report(daily).withColumn("generated_at", ntz_literal(run_ts))
        written(report, "report", layout.report, "report_date")

    def write_partials():
        written(daily_partials(daily), "partials", layout.partials, "observation_date", ["station_id"])

    def write_history():
        new = hist.history_rows(daily)
        if stations is not None:
            new = new.where(F.col("station_id").isin(list(stations)))
        # the old version's folders, which stay while the new version is written beside them
        existing = read_days(spark, layout.history, days, HISTORY_TABLE_SCHEMA)
        merged = (hist.upsert_history(existing, new) if history_mode == "upsert"
                  else hist.union_distinct_history(existing, new))
        written(merged, "history", layout.history, "observation_date", ["station_id", "timestamp"])

    # The four outputs read only the daily observations (and history its own partitions), so they run
    # as concurrent Spark jobs.
    with ThreadPoolExecutor(max_workers=4) as pool:
        for f in [pool.submit(w) for w in (write_summary, write_report, write_partials, write_history)]:
            f.result()
    rows = {name: (obs.get.get("n", 0) if wrote[name] else 0) for name, obs in seen.items()}
    log.info("processed %d day(s) at %s: %s", len(days), run_ts, rows)
    return {"days": days, "run_ts": run_ts, "rows": rows}


def run_day(spark: SparkSession, layout: Layout, day, run_ts: dt.datetime | None = None, **kw) -> dict[str, object]:
    """The reference's nightly job for one date."""
    return run_days(spark, layout, day, day, run_ts=run_ts, **kw)


def _history_schema():
    from pyspark.sql import types as T

    from stationlake.schemas import HISTORY_COLUMNS, MEASURES
    fields = []
    for c in HISTORY_COLUMNS:
        if c == "station_id":
            fields.append(T.StructField(c, T.LongType()))
        elif c in ("timestamp", "processing_time"):
            fields.append(T.StructField(c, T.TimestampNTZType()))
        elif c in MEASURES or c == "data_completeness_score":
            fields.append(T.StructField(c, T.DoubleType()))
    fields.append(T.StructField("observation_date", T.DateType()))
    return T.StructType(fields)


HISTORY_TABLE_SCHEMA = _history_schema()


def trend_kpis(spark: SparkSession, layout: Layout, as_of: dt.datetime, days: int = 30) -> DataFrame:
    """Per station, the KPIs of the ``days`` up to ``as_of``: whole days from their stored partials, the days that the
    period cuts from their own observations."""
    since = as_of - dt.timedelta(days=days)
    first = since.date() if since.time() == dt.time() else since.date() + dt.timedelta(days=1)
    whole = [first + dt.timedelta(days=i) for i in range((as_of.date() - first).days)]
    cut = sorted({since.date(), as_of.date()} - set(whole))
    stored = read_days(spark, layout.partials, whole, None)
    edge = read_days(spark, layout.daily, cut, None)
    edge = edge.where((F.col("timestamp") >= ntz_literal(since)) & (F.col("timestamp") <= ntz_literal(as_of)))
    return partials.trend_kpis(stored.unionByName(daily_partials(edge).select(*stored.columns)))


def register_views(spark: SparkSession, layout: Layout) -> list[str]:
    """Expose the stored tables to ``spark.sql`` under their usual names.

    One partitioned table replaces each family of per-day (or per-station) tables, so a query on
    "the summary of day D" becomes ``... FROM daily_summary WHERE observation_date = DATE 'D'``,
    which prunes to that day's folder. Tables not written yet are skipped.
    """
    names = []
    tables = {
        "raw_observations": (layout.raw, RAW_TABLE_SCHEMA), "daily_observations": (layout.daily, None),
        "daily_summary": (layout.summary, None), "quality_report": (layout.report, None),
        "daily_partials": (layout.partials, None), "station_history": (layout.history, HISTORY_TABLE_SCHEMA), "quarantine": (layout.quarantine, None),
    }
    for name, (path, schema) in tables.items():
        if path_exists(spark, path):
            read_table(spark, path, schema).createOrReplaceTempView(name)
            names.append(name)
    return names


def main(argv: list[str] | None = None) -> None:
    """``python -m stationlake.plans.daily_job --root PATH --date YYYY-MM-DD`` (what a scheduler runs)."""
    import argparse

    from stationlake.session import get_session

    ap = argparse.ArgumentParser(description="Curate, summarise, report and update history for a date range.")
    ap.add_argument("--root", required=True, help="table root every executor can reach")
    ap.add_argument("--date", help="one date (the nightly run); default: yesterday (UTC)")
    ap.add_argument("--start", help="first date of a range (with --end)")
    ap.add_argument("--end", help="last date of a range")
    ap.add_argument("--run-ts", help="audit time (ISO); default now")
    ap.add_argument("--history-mode", choices=HISTORY_MODES, default="upsert")
    ap.add_argument("--stations", help="comma-separated station ids kept in the history")
    ap.add_argument("--compact-days-ago", type=int, default=None,
                    help="also fold the raw table's landed batches of the day N days ago (N >= 2)")
    a = ap.parse_args(argv)
    start = a.start or a.date or (dt.datetime.now(dt.timezone.utc).date() - dt.timedelta(days=1)).isoformat()
    end = a.end or start
    run_ts = dt.datetime.fromisoformat(a.run_ts) if a.run_ts else None
    stations = [int(x) for x in a.stations.split(",")] if a.stations else None
    spark = get_session()
    done = run_days(spark, Layout(a.root), start, end, run_ts=run_ts, history_mode=a.history_mode, stations=stations)
    print(f"processed {len(done['days'])} day(s) at {done['run_ts']}: rows written {done['rows']}")
    if a.compact_days_ago is not None:
        from stationlake.sources.tables import compact_days

        layout = Layout(a.root)
        day = dt.datetime.now(dt.timezone.utc).date() - dt.timedelta(days=a.compact_days_ago)
        print("compacted", compact_days(spark, layout.raw, [day]))


if __name__ == "__main__":
    main()
