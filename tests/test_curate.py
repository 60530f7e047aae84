import datetime as dt

from pyspark.sql import functions as F

from stationlake.operators import curate, summarize
from stationlake.schemas import RAW_COLUMNS, RAW_SCHEMA
from stationlake.sources.fixtures import raw_observations

from tests.conftest import SF_SMALL


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def _raw(spark, rows):
    full = []
    for r in rows:
        d = dict.fromkeys(RAW_COLUMNS)
        d.update(r)
        full.append(tuple(d[c] for c in RAW_COLUMNS))
    return spark.createDataFrame(full, RAW_SCHEMA)


def test_hourly_pick_at_most_one_per_station_hour(spark):
    daily = curate.daily_observations(raw_observations(spark, SF_SMALL))
    per = daily.groupBy("station_id", F.date_trunc("hour", "timestamp")).count()
    assert per.where("count > 1").count() == 0


def test_dropping_distinct_gives_the_same_table(spark):
    raw = raw_observations(spark, SF_SMALL)
    assert _rows(curate.daily_observations(raw)) == _rows(curate.daily_observations(raw, exact_distinct=True))


def test_result_independent_of_order_and_partitions(spark):
    raw = raw_observations(spark, SF_SMALL)
    a = _rows(summarize.daily_summary(curate.daily_observations(raw)))
    b = _rows(summarize.daily_summary(curate.daily_observations(raw.repartition(13).orderBy(F.rand(7)))))
    assert a == b


def test_latest_ties_broken_by_ingestion_time(spark):
    t = dt.datetime(2024, 1, 1, 10, 30)
    raw = _raw(spark, [
        dict(timestamp=t, station_id=1, temperature=1.0, ingestion_time=t + dt.timedelta(minutes=1)),
        dict(timestamp=t, station_id=1, temperature=2.0, ingestion_time=t + dt.timedelta(minutes=11)),
        dict(timestamp=t - dt.timedelta(minutes=20), station_id=1, temperature=3.0, ingestion_time=t),
        dict(timestamp=t + dt.timedelta(hours=1), station_id=1, temperature=4.0, ingestion_time=t),
    ])
    got = curate.daily_observations(raw).orderBy("timestamp").select("temperature").collect()
    assert [r[0] for r in got] == [2.0, 4.0]


def test_flag_counts_add_up(spark):
    daily = curate.daily_observations(raw_observations(spark, SF_SMALL))
    total = daily.count()
    for m in ("temperature", "humidity", "wind_speed", "pressure"):
        counts = {r[0]: r[1] for r in daily.groupBy(f"{m}_quality").count().collect()}
        assert sum(counts.values()) == total
        assert set(counts) <= {"VALID", "OUTLIER", "MISSING"}


def test_one_row_stddev_is_null_and_empty_day(spark):
    t = dt.datetime(2024, 1, 1, 10, 0)
    raw = _raw(spark, [dict(timestamp=t, station_id=5, temperature=1.0, humidity=50.0, ingestion_time=t)])
    s = summarize.daily_summary(curate.daily_observations(raw)).first()
    assert s["stddev_temperature"] is None and s["total_observations"] == 1 and s["avg_completeness_score"] == 0.5
    empty = curate.daily_observations(raw, start="2024-01-02")
    assert empty.count() == 0 and summarize.quality_report(empty).count() == 0


def test_report_rating_uses_rounded_score(spark):
    daily = curate.daily_observations(raw_observations(spark, SF_SMALL))
    for r in summarize.quality_report(daily).collect():
        s = r["avg_completeness_score"]
        want = "EXCELLENT" if s >= 0.9 else "GOOD" if s >= 0.7 else "FAIR" if s >= 0.5 else "POOR"
        assert r["overall_quality_rating"] == want


def test_day_filter_and_audit_time_ignore_session_zone(spark):
    raw = raw_observations(spark, SF_SMALL)
    want = _rows(curate.daily_observations(raw, start="2024-01-15", run_ts="2024-01-16 01:00:00"))
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
        got = _rows(curate.daily_observations(raw, start="2024-01-15", run_ts=dt.datetime(2024, 1, 16, 1)))
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert got == want and len(got) > 0


def test_cycle_calendar_is_dealt_out(spark):
    """A bad ingestion time far off gives every cycle between once, and no task more than a few blocks."""
    import datetime as dt

    from stationlake.operators import lookup

    ends = spark.createDataFrame([(dt.datetime(1970, 1, 1), dt.datetime(2024, 1, 1, 3, 20))], "a timestamp_ntz, b timestamp_ntz")
    cycles = lookup.cycle_calendar(ends, 10)
    n = int((dt.datetime(2024, 1, 1, 3, 20) - dt.datetime(1970, 1, 1)).total_seconds() // 600) + 1
    got = cycles.selectExpr("count(*) AS n", "count(DISTINCT cycle_start) AS d", "min(cycle_start) AS a", "max(cycle_start) AS b").first()
    assert (got.n, got.d, got.a, got.b) == (n, n, dt.datetime(1970, 1, 1), dt.datetime(2024, 1, 1, 3, 20))
    from pyspark.sql import functions as F

    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        parts = [r["count"] for r in cycles.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(parts) == 8 and max(parts) < n / 4
    cat = spark.createDataFrame([(1, "a"), (2, "b")], "station_id long, station_name string")
    obs = spark.createDataFrame([(1, dt.datetime(1970, 1, 1)), (1, dt.datetime(2024, 1, 1, 0, 1)), (2, dt.datetime(2024, 1, 1, 0, 25))],
                                "station_id long, ingestion_time timestamp_ntz")
    out = lookup.poll_cycle_outcomes(cat, obs, 10, start="2024-01-01 00:00:00")
    assert sorted((r.cycle_start.minute, r.polled, r.succeeded, r.failed) for r in out.collect()) == [(0, 2, 1, 1), (10, 2, 0, 2), (20, 2, 1, 1)]
