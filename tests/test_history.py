from pyspark.sql import functions as F

from stationlake.operators import curate, history as hist
from stationlake.sources.fixtures import raw_observations

from tests.conftest import SF_SMALL


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def _daily(spark):
    return curate.daily_observations(raw_observations(spark, SF_SMALL))


def test_union_distinct_duplicates_reruns_upsert_does_not(spark):
    daily = _daily(spark)
    first = hist.history_rows(daily, F.lit("2024-02-01 01:00:00"))
    again = hist.history_rows(daily, F.lit("2024-02-02 01:00:00"))
    n = daily.count()
    u = hist.union_distinct_history(first, again)
    assert u.count() == 2 * n                           # the reference's behaviour on reruns
    assert hist.union_distinct_history(first, first).count() == n
    up = hist.upsert_history(first, again)
    assert up.count() == n
    assert up.select("processing_time").distinct().count() == 1
    assert _rows(hist.upsert_history(up, again)) == _rows(up)   # idempotent


def test_merge_equals_upsert_over_everything(spark):
    daily = _daily(spark)
    old = hist.history_rows(daily, F.lit("2024-02-01 01:00:00"))
    new = hist.history_rows(daily.where("timestamp >= '2024-01-20'"), F.lit("2024-02-05 01:00:00"))
    assert _rows(hist.merge_history(old, new, "2024-01-20", "2024-02-28")) == _rows(hist.upsert_history(old, new))


def test_upsert_is_keyed_by_the_hour(spark):
    daily = _daily(spark)
    old = hist.history_rows(daily, F.lit("2024-02-01 01:00:00"))
    # the rerun has another observation standing for each hour
    moved = old.withColumn("timestamp", F.expr("date_trunc('hour', timestamp) + interval 59 minutes").cast("timestamp_ntz"))
    new = moved.withColumn("processing_time", F.lit("2024-02-02 01:00:00").cast("timestamp_ntz"))
    assert _rows(hist.upsert_history(old, new)) == _rows(new)
