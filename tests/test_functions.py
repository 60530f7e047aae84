import math

from pyspark.sql import functions as F

from stationlake.functions import (
    completeness_score, num_or_null, parse_timestamp, quality_flag, rating, rating_mark, round_stable, to_id,
)


def _one(spark, expr, value, ddl):
    return spark.createDataFrame([(value,)], f"x {ddl}").select(expr(F.col("x")).alias("y")).first()["y"]


def test_quality_flag_boundaries(spark):
    cases = [(-50.0, "VALID"), (50.0, "VALID"), (-50.01, "OUTLIER"), (50.01, "OUTLIER"), (None, "MISSING"),
             (float("inf"), "OUTLIER"), (float("-inf"), "OUTLIER")]
    for v, want in cases:
        assert _one(spark, lambda c: quality_flag(c, -50.0, 50.0), v, "double") == want, v
    for lo, hi, inside, outside in [(0.0, 100.0, 100.0, 100.5), (0.0, 50.0, 0.0, -0.1), (900.0, 1100.0, 900.0, 1100.1)]:
        assert _one(spark, lambda c: quality_flag(c, lo, hi), inside, "double") == "VALID"
        assert _one(spark, lambda c: quality_flag(c, lo, hi), outside, "double") == "OUTLIER"


def test_completeness_score(spark):
    df = spark.createDataFrame(
        [(1.0, 1.0, 1.0, 1.0), (None, 1.0, 1.0, 1.0), (None, None, 1.0, None), (None, None, None, None)],
        "temperature double, humidity double, wind_speed double, pressure double")
    got = [r[0] for r in df.select(completeness_score()).collect()]
    assert got == [1.0, 0.75, 0.25, 0.0]


def test_rating_edges(spark):
    cases = [(0.9, "EXCELLENT"), (0.899, "GOOD"), (0.7, "GOOD"), (0.5, "FAIR"), (0.499, "POOR"), (None, "POOR")]
    for v, want in cases:
        assert _one(spark, rating, v, "double") == want, v
    # the report compares the score rounded to 3 decimals: 0.8995 rounds up to 0.9
    assert _one(spark, lambda c: rating(round_stable(c, 3)), 0.8995, "double") == "EXCELLENT"


def test_rating_mark_default(spark):
    assert _one(spark, rating_mark, "GOOD", "string") == "🟡"
    assert _one(spark, rating_mark, "UNKNOWN", "string") == "⚪"
    assert _one(spark, rating_mark, None, "string") == "⚪"


def test_round_stable_half_away_from_zero(spark):
    assert _one(spark, lambda c: round_stable(c, 2), 2.675, "double") == 2.68
    assert _one(spark, lambda c: round_stable(c, 2), -2.675, "double") == -2.68
    assert _one(spark, lambda c: round_stable(c, 3), 0.0005, "double") == 0.001
    assert _one(spark, lambda c: round_stable(c, 2), float("inf"), "double") == float("inf")
    assert _one(spark, lambda c: round_stable(c, 2), None, "double") is None


def test_num_or_null(spark):
    cases = [("1.5", 1.5), (" 2 ", 2.0), ("NaN", None), ("abc", None), ("", None), (None, None), ("1e3", 1000.0)]
    for v, want in cases:
        assert _one(spark, num_or_null, v, "string") == want, v
    assert math.isinf(_one(spark, num_or_null, "inf", "string"))


def test_to_id(spark):
    cases = [("204518", 204518), (" 7 ", 7), ("204518.0", 204518), ("1.5", None), ("abc", None), ("", None),
             (None, None)]
    for v, want in cases:
        assert _one(spark, to_id, v, "string") == want, v


def test_parse_timestamp_both_forms(spark):
    import datetime as dt
    assert _one(spark, parse_timestamp, "2026-01-01T10:04:11.123456", "string") == dt.datetime(2026, 1, 1, 10, 4, 11, 123456)
    assert _one(spark, parse_timestamp, "2026-01-01T10:04:11", "string") == dt.datetime(2026, 1, 1, 10, 4, 11)
    assert _one(spark, parse_timestamp, "\t2026-01-01 10:04:11\n", "string") == dt.datetime(2026, 1, 1, 10, 4, 11)
    assert _one(spark, parse_timestamp, "not-a-time", "string") is None
    # explicit zones name an instant: stored as UTC wall time, whatever the session zone
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        for tz in ("UTC", "America/Los_Angeles"):
            spark.conf.set("spark.sql.session.timeZone", tz)
            assert _one(spark, parse_timestamp, "2026-01-01T10:00:00+02:00", "string") == dt.datetime(2026, 1, 1, 8, 0)
            assert _one(spark, parse_timestamp, "2026-01-01T10:00:00.5Z", "string") == dt.datetime(2026, 1, 1, 10, 0, 0, 500000)
            assert _one(spark, parse_timestamp, "2026-01-01 23:30:00-0100", "string") == dt.datetime(2026, 1, 2, 0, 30)
            assert _one(spark, parse_timestamp, "2026-01-01", "string") == dt.datetime(2026, 1, 1)
            assert _one(spark, parse_timestamp, "2026-01-01T10:00:00", "string") == dt.datetime(2026, 1, 1, 10, 0)
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_source_times_are_utc_wall_time_whatever_the_type(spark):
    import datetime as dt

    from stationlake.functions import utc_wall_time

    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Asia/Kolkata")
        ltz = spark.sql("select timestamp'2024-01-15 10:00:00+00:00' as ts")           # an instant
        ntz = spark.sql("select timestamp_ntz'2024-01-15 10:00:00' as ts")             # a wall time
        for df in (ltz, ntz):
            assert df.select(utc_wall_time(df, "ts").alias("t")).first()["t"] == dt.datetime(2024, 1, 15, 10, 0)
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
