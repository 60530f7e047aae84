"""Registered queries that run the daily job end to end on stored tables and read them back."""

from __future__ import annotations

import contextlib
import datetime as dt

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stationlake.operators import partials, views
from stationlake.plans.daily_job import HISTORY_TABLE_SCHEMA, Layout, run_days, trend_kpis
from stationlake.schemas import DAILY_COLUMNS, RAW_COLUMNS
from stationlake.session import shared_dir
from stationlake.sources.fixtures import LATE_KEY, observations_from_events, raw_observations, read_source
from stationlake.sources.tables import RAW_TABLE_SCHEMA, append_batch, compact_days, read_day, read_raw, read_table

FIRST_RUN = dt.datetime(2024, 1, 31, 1, 0)
RERUN = dt.datetime(2024, 2, 1, 1, 0)
RERUN_FROM, RERUN_TO = "2024-01-16", "2024-01-30"


class Interrupted(RuntimeError):
    """Stands for a killed run."""


def interrupted(run, stop: str | None) -> None:
    """Call ``run(step)``, ending it after the step ``stop``."""
    def step(at: str) -> None:
        if at == stop:
            raise Interrupted(at)

    with contextlib.suppress(Interrupted):
        run(step)


def _loaded(spark: SparkSession, sf_dir: str, name: str) -> Layout:
    layout = Layout(shared_dir(spark, name))
    append_batch(raw_observations(spark, sf_dir), layout.raw, 0)
    return layout


def q_stored_daily_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    layout = _loaded(spark, sf_dir, "stored-summary")
    run_days(spark, layout, run_ts=FIRST_RUN)
    return read_table(spark, layout.summary).drop("processing_time")


def q_stored_quality_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    layout = _loaded(spark, sf_dir, "stored-report")
    run_days(spark, layout, run_ts=FIRST_RUN)
    return read_table(spark, layout.report).drop("generated_at")


def _rerun_history(spark: SparkSession, sf_dir: str, mode: str) -> DataFrame:
    layout = _loaded(spark, sf_dir, f"stored-history-{mode}")
    run_days(spark, layout, run_ts=FIRST_RUN, history_mode=mode)
    run_days(spark, layout, RERUN_FROM, RERUN_TO, run_ts=RERUN, history_mode=mode)
    return read_table(spark, layout.history, HISTORY_TABLE_SCHEMA)


def q_stored_history_upsert_rerun(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rerun_history(spark, sf_dir, "upsert")


def q_stored_history_union_rerun(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rerun_history(spark, sf_dir, "union_distinct")


def q_stored_history_late_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that land after a first run change their hours' winners; a rerun of half the month replaces
    those hours' history rows."""
    layout = Layout(shared_dir(spark, "stored-history-late"))
    rows = observations_from_events(read_source(spark, sf_dir, "events"), keep_key=True)
    late = F.col("k") == LATE_KEY
    append_batch(rows.where(~late).drop("k"), layout.raw, 0)
    run_days(spark, layout, run_ts=FIRST_RUN)
    append_batch(rows.where(late).drop("k"), layout.raw, 1)
    run_days(spark, layout, RERUN_FROM, RERUN_TO, run_ts=RERUN)
    return read_table(spark, layout.history, HISTORY_TABLE_SCHEMA)


def q_stored_compacted_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A raw table landed in three batches by two sources, every day compacted: stopped after each step in turn,
    run to its end, and run once more."""
    layout = Layout(shared_dir(spark, "stored-compacted"))
    rows = raw_observations(spark, sf_dir)
    part = F.pmod(F.xxhash64("station_id", "timestamp", "ingestion_time"), F.lit(3))
    for n, (source, batch) in enumerate([("a", 0), ("a", 1), ("b", 0)]):
        append_batch(rows.where(part == n), layout.raw, batch, source_id=source)
    days = [r[0] for r in read_raw(spark, layout.raw).select("observation_date").distinct().collect()]
    for stop in ("marked", "written", "committed", None, None):
        interrupted(lambda step: compact_days(spark, layout.raw, days, today=dt.date(2024, 3, 1), step=step), stop)
    return read_raw(spark, layout.raw).select(*RAW_COLUMNS)


def q_stored_interrupted_backfill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily observations and history after a rerun of half the month that was stopped between writing and
    committing the history, read as they stand, and again after the rerun that ends it."""
    layout = _loaded(spark, sf_dir, "stored-interrupted")
    run_days(spark, layout, run_ts=FIRST_RUN)
    out = None
    for stop in ("history written", None):
        interrupted(lambda step: run_days(spark, layout, RERUN_FROM, RERUN_TO, run_ts=RERUN, step=step), stop)
        for name, path in (("daily_observations", layout.daily), ("station_history", layout.history)):
            rows = read_table(spark, path).groupBy("observation_date").agg(
                F.count("*").alias("n"), F.count_distinct("station_id").alias("stations"), F.max("processing_time").alias("processing_time"))
            rows = rows.select(F.lit(stop or "end").alias("stopped"), F.lit(name).alias("what"), "*")
            # the folders that a version no longer needs go with later versions, so the counts are kept
            rows = spark.createDataFrame(rows.collect(), rows.schema)  # one row per day
            out = rows if out is None else out.union(rows)
    return out


def q_stored_read_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One day of the stored daily observations."""
    layout = _loaded(spark, sf_dir, "stored-day")
    run_days(spark, layout, run_ts=FIRST_RUN)
    return read_day(spark, layout.daily, "2024-01-15").select(*DAILY_COLUMNS)


def q_stored_empty_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nightly job over a day with rows, and over one without (P17): rows written, and rows that each table then has
    of the day."""
    layout = _loaded(spark, sf_dir, "stored-empty")
    out = None
    for day in ("2024-01-15", "2024-03-01"):
        done = run_days(spark, layout, day, day, run_ts=FIRST_RUN)
        for name, path, column in (("daily", layout.daily, "observation_date"), ("summary", layout.summary, "observation_date"),
                                   ("report", layout.report, "report_date"), ("history", layout.history, "observation_date")):
            there = read_day(spark, path, day, date_col=column).agg(F.count("*").alias("stored"))
            one = there.select(F.lit(day).cast("date").alias("observation_date"), F.lit(name).alias("what"),
                               F.lit(done["rows"][name]).cast("long").alias("written"), "stored")
            out = one if out is None else out.union(one)
    return out


def q_stored_missing_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table not created yet, and a day not stored, have no rows."""
    layout = Layout(shared_dir(spark, "stored-missing"))
    one = lambda name, df: df.agg(F.count("*").alias("n")).select(F.lit(name).alias("what"), "n")
    out = one("no table", read_raw(spark, layout.raw))
    append_batch(raw_observations(spark, sf_dir), layout.raw, 0)
    return out.union(one("no day", read_day(spark, layout.raw, "2030-01-01", RAW_TABLE_SCHEMA))).union(
        one("table", read_raw(spark, layout.raw)))


def q_stored_station_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """History kept for some stations (P12), read for one of them."""
    layout = _loaded(spark, sf_dir, "stored-station")
    run_days(spark, layout, run_ts=FIRST_RUN, stations=[3, 5])
    return views.station_trend(read_table(spark, layout.history, HISTORY_TABLE_SCHEMA), "2024-01-31 00:00:00", 30, station_ids=[5])


def q_stored_trend_from_partials(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trend KPIs of 14 days that begin and end at noon, from stored partials and two cut days."""
    layout = _loaded(spark, sf_dir, "stored-trend")
    run_days(spark, layout, run_ts=FIRST_RUN)
    return trend_kpis(spark, layout, dt.datetime(2024, 1, 25, 12), 14)


def q_stored_statistics_from_partials(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Means, spread and correlation of the whole month per station, from stored partials alone."""
    layout = _loaded(spark, sf_dir, "stored-statistics")
    run_days(spark, layout, run_ts=FIRST_RUN)
    return partials.station_statistics(read_table(spark, layout.partials))


def q_stored_temperature_trend_from_partials(spark: SparkSession, sf_dir: str) -> DataFrame:
    layout = _loaded(spark, sf_dir, "stored-temperature")
    run_days(spark, layout, run_ts=FIRST_RUN)
    return partials.temperature_trend(read_table(spark, layout.partials))


def q_stored_order_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the ordered outputs that stand before their predecessor within a file or partition."""
    layout = _loaded(spark, sf_dir, "stored-order")
    run_days(spark, layout, run_ts=FIRST_RUN)

    def inversions(name: str, df: DataFrame, part, key) -> DataFrame:
        placed = df.select(part.alias("part"), F.monotonically_increasing_id().alias("at"), key.alias("key"))
        before = F.lag("key").over(Window.partitionBy("part").orderBy("at"))
        return placed.withColumn("bad", before > F.col("key")).agg(
            F.count("*").alias("n"), F.count(F.when(F.col("bad"), 1)).alias("inversions")).select(F.lit(name).alias("what"), "n", "inversions")

    stored = F.struct("station_id", "timestamp")
    latest = views.latest_table(views.latest_by_station(read_raw(spark, layout.raw)))
    newest_first = F.struct((-F.unix_micros(F.col("timestamp").cast("timestamp"))).alias("t"), "station_id")
    return (inversions("daily_observations", read_table(spark, layout.daily), F.input_file_name(), stored)
            .union(inversions("station_history", read_table(spark, layout.history, HISTORY_TABLE_SCHEMA), F.input_file_name(), stored))
            .union(inversions("latest_table", latest, F.spark_partition_id().cast("string"), newest_first)))


STORED_QUERIES = {
    "stored_history_late_row": q_stored_history_late_row,
    "stored_compacted_rows": q_stored_compacted_rows,
    "stored_interrupted_backfill": q_stored_interrupted_backfill,
    "stored_read_day": q_stored_read_day,
    "stored_missing_counts": q_stored_missing_counts,
    "stored_empty_day": q_stored_empty_day,
    "stored_station_history": q_stored_station_history,
    "stored_order_checks": q_stored_order_checks,
    "stored_trend_from_partials": q_stored_trend_from_partials,
    "stored_statistics_from_partials": q_stored_statistics_from_partials,
    "stored_temperature_trend_from_partials": q_stored_temperature_trend_from_partials,
    "stored_daily_summary": q_stored_daily_summary,
    "stored_quality_report": q_stored_quality_report,
    "stored_history_upsert_rerun": q_stored_history_upsert_rerun,
    "stored_history_union_rerun": q_stored_history_union_rerun,
}
