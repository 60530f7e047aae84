"""Mergeable partials against the observations themselves."""

import datetime as dt
import random

from pyspark.sql import functions as F

from stationlake.operators import partials as P
from stationlake.plans.daily_job import Layout, run_days, trend_kpis
from stationlake.sources.fixtures import raw_observations
from stationlake.sources.tables import append_batch

from tests.conftest import SF_SMALL


def observations(spark):
    rng = random.Random(9)
    rows = []
    for i in range(900):
        v = lambda base: None if rng.random() < 0.2 else base + rng.gauss(0, 1e-3)  # noqa: E731  large mean, small spread
        rows.append((i % 7, "L", dt.datetime(2024, 1, 1 + i % 11, i % 24), v(1e6), v(-3e5), v(2.0), v(1000.0), 0.5))
    rows += [(50, "one", dt.datetime(2024, 1, 1), 4.0, None, None, None, 1.0), (51, None, dt.datetime(2024, 1, 1), None, None, None, None, 0.0)]
    return spark.createDataFrame(rows, "station_id long, location string, timestamp timestamp_ntz, temperature double, humidity double, "
                                       "wind_speed double, pressure double, data_completeness_score double")


def test_merged_moments_equal_those_of_all_rows(spark):
    obs = observations(spark)
    got = {r.station_id: r for r in P.merged(P.merged(P.daily_partials(obs), P.KEY), ["station_id"]).select(
        "station_id", "n", P.mean("temperature").alias("mean"), P.stddev("temperature").alias("sd"), P.correlation().alias("corr"), "pairs").collect()}
    want = obs.groupBy("station_id").agg(F.count("*").alias("n"), F.avg("temperature").alias("mean"), F.stddev_samp("temperature").alias("sd"),
                                         F.corr("temperature", "humidity").alias("corr"), F.count(F.col("temperature") + F.col("humidity")).alias("pairs"))
    for r in want.collect():
        g = got[r.station_id]
        assert (g.n, g.pairs) == (r.n, r.pairs)
        if r.pairs > 1:
            assert abs(g["mean"] - r["mean"]) < 1e-8 and abs(g.sd - r.sd) < 1e-4 * r.sd and abs(g["corr"] - r["corr"]) < 1e-3
    assert got[50].sd is None and got[50]["mean"] == 4.0 and got[51]["mean"] is None and got[51]["corr"] is None


def test_a_trend_reads_partials_and_its_cut_days_only(spark, workdir):
    lay = Layout(workdir)
    append_batch(raw_observations(spark, SF_SMALL), lay.raw, 0)
    run_days(spark, lay, run_ts=dt.datetime(2024, 2, 1))
    out = trend_kpis(spark, lay, dt.datetime(2024, 1, 25, 12), 14)
    files = out.inputFiles()
    assert {f.split("daily_observations/")[1][:27] for f in files if "daily_observations" in f} == {
        "observation_date=2024-01-11", "observation_date=2024-01-25"}
    assert len({f.split("observation_date=")[1][:10] for f in files if "daily_partials" in f}) == 13
    midnight = trend_kpis(spark, lay, dt.datetime(2024, 1, 25), 7)  # whole days, and the first instant of the last
    assert {f.split("daily_observations/")[1][:27] for f in midnight.inputFiles() if "daily_observations" in f} <= {"observation_date=2024-01-25"}
