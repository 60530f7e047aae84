import datetime as dt

from stationlake.plans.daily_job import HISTORY_TABLE_SCHEMA, Layout, run_day, run_days
from stationlake.sources.fixtures import raw_observations
from stationlake.sources.tables import append_batch, read_table

from tests.conftest import SF_SMALL


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def _snapshot(spark, lay):
    return {name: _rows(read_table(spark, p)) for name, p in
            [("daily", lay.daily), ("summary", lay.summary), ("report", lay.report), ("partials", lay.partials), ("history", lay.history)]}


def test_rerun_is_idempotent_and_empty_day_clears(spark, workdir):
    lay = Layout(workdir)
    append_batch(raw_observations(spark, SF_SMALL), lay.raw, 0)
    ts = dt.datetime(2024, 2, 1, 1)
    done = run_days(spark, lay, "2024-01-01", "2024-01-30", run_ts=ts)
    once = _snapshot(spark, lay)
    assert done["rows"] == {k: len(v) for k, v in once.items()}
    run_day(spark, lay, "2024-01-10", run_ts=ts)
    assert _snapshot(spark, lay) == once
    # a day with no raw rows leaves empty partitions, and replaces anything that was there
    run_day(spark, lay, "2024-03-01", run_ts=ts)
    assert read_table(spark, lay.daily).where("observation_date = '2024-03-01'").count() == 0
    assert read_table(spark, lay.daily).count() == len(once["daily"])


def test_upsert_history_keeps_latest_run(spark, workdir):
    lay = Layout(workdir)
    append_batch(raw_observations(spark, SF_SMALL), lay.raw, 0)
    run_days(spark, lay, run_ts=dt.datetime(2024, 2, 1, 1))
    n = read_table(spark, lay.history, HISTORY_TABLE_SCHEMA).count()
    run_day(spark, lay, "2024-01-05", run_ts=dt.datetime(2024, 2, 3, 1))
    h = read_table(spark, lay.history, HISTORY_TABLE_SCHEMA)
    assert h.count() == n
    assert h.where("observation_date = '2024-01-05'").select("processing_time").distinct().count() == 1
    assert h.where("observation_date = '2024-01-05' and processing_time = '2024-02-03 01:00:00'").count() > 0


def test_station_subset_and_missing_tables(spark, workdir):
    from stationlake.operators import views
    from stationlake.sources.tables import RAW_TABLE_SCHEMA, read_day, read_raw

    lay = Layout(workdir)
    assert read_raw(spark, lay.raw).count() == 0                      # table not created yet: empty
    assert read_day(spark, lay.raw, "2024-01-15", RAW_TABLE_SCHEMA).count() == 0
    append_batch(raw_observations(spark, SF_SMALL), lay.raw, 0)
    run_days(spark, lay, run_ts=dt.datetime(2024, 2, 1, 1), stations=[3, 5])
    h = read_table(spark, lay.history, HISTORY_TABLE_SCHEMA)
    assert {r[0] for r in h.select("station_id").distinct().collect()} == {3, 5}
    trend = views.station_trend(h, "2024-01-31 00:00:00", days=7, station_ids=[5])
    rows = trend.collect()
    assert rows and {r["station_id"] for r in rows} == {5}
    assert min(r["timestamp"] for r in rows) >= dt.datetime(2024, 1, 24)
    assert [r["timestamp"] for r in rows] == sorted(r["timestamp"] for r in rows)


def test_sql_over_registered_views(spark, workdir):
    from stationlake.plans.daily_job import register_views

    lay = Layout(workdir)
    append_batch(raw_observations(spark, SF_SMALL), lay.raw, 0)
    run_days(spark, lay, run_ts=dt.datetime(2024, 2, 1, 1))
    names = register_views(spark, lay)
    assert {"raw_observations", "daily_observations", "daily_summary", "quality_report", "station_history"} <= set(names)
    # the dashboard's "latest observation per station for a day", as SQL
    latest = spark.sql("""
        SELECT * EXCEPT (rn) FROM (
          SELECT station_id, location, temperature, timestamp,
                 ROW_NUMBER() OVER (PARTITION BY station_id ORDER BY timestamp DESC, ingestion_time DESC) AS rn
          FROM raw_observations WHERE observation_date = DATE '2024-01-15') WHERE rn = 1""")
    assert latest.count() == spark.sql(
        "SELECT COUNT(DISTINCT station_id) FROM raw_observations WHERE observation_date = DATE '2024-01-15'").first()[0]
    day = spark.sql("SELECT * FROM daily_summary WHERE observation_date = DATE '2024-01-15' ORDER BY station_id")
    report = spark.sql("SELECT overall_quality_rating FROM quality_report WHERE report_date = DATE '2024-01-15'")
    assert day.count() > 0 and report.count() == 1
