"""Mergeable daily partials (A9, A18–A23): per station and day the counts, sums, extremes and second moments that any
longer period is put together from.

A range of days reads one small row per station and day in place of all its observations. Second
moments are kept about the day's own mean and merged about the mean of the period, so large values of small
spread keep their digits; the temperature–humidity pairs carry their co-moment the same way.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stationlake.functions import round_stable
from stationlake.operators.reports import with_date

MEASURED = ["temperature", "humidity", "wind_speed", "pressure", "data_completeness_score"]
KEY = ["station_id", "location", "observation_date"]
_PAIR = ("temperature", "humidity")


def daily_partials(obs: DataFrame) -> DataFrame:
    """One row per station, location and day of ``obs`` (daily observations or history rows)."""
    obs = with_date(obs)
    both = F.col(_PAIR[0]).isNotNull() & F.col(_PAIR[1]).isNotNull()
    x, y = (F.when(both, F.col(c)) for c in _PAIR)
    out = [F.count("*").alias("n")]
    for m in MEASURED:
        c = F.col(m)
        out += [F.count(c).alias(f"{m}_n"), F.sum(c).alias(f"{m}_sum"), (F.var_pop(c) * F.count(c)).alias(f"{m}_m2"),
                F.min(c).alias(f"{m}_min"), F.max(c).alias(f"{m}_max")]
    n = F.count(x)
    out += [n.alias("pairs"), F.sum(x).alias("pair_x_sum"), F.sum(y).alias("pair_y_sum"), (F.var_pop(x) * n).alias("pair_x_m2"),
            (F.var_pop(y) * n).alias("pair_y_m2"), (F.covar_pop(x, y) * n).alias("pair_co")]
    return obs.groupBy(*KEY).agg(*out)


def merged(partials: DataFrame, by: list[str]) -> DataFrame:
    """Partials of the coarser key ``by``, as if computed from the observations themselves.

    A moment is the sum of the days' own and of what their means lie apart, taken about the mean of the whole
    key: a window gives that mean to every row of the key, in the partitioning that the sum needs anyway.
    """
    sums = {"pairs": ["pair_x_sum", "pair_y_sum"], **{f"{m}_n": [f"{m}_sum"] for m in MEASURED}}
    whole = Window.partitionBy(*by)
    off = {c: (F.try_divide(F.col(c), F.col(n)) - F.try_divide(F.sum(c).over(whole), F.sum(n).over(whole))).alias(f"{c}_off")
           for n, cs in sums.items() for c in cs}
    rows = partials.select("*", *off.values())
    moment = lambda own, n, a, b: (F.sum(own) + F.sum(F.coalesce(F.col(n) * F.col(f"{a}_off") * F.col(f"{b}_off"), F.lit(0.0)))).alias(own)
    out = [F.sum("n").alias("n")]
    for m in MEASURED:
        out += [F.sum(f"{m}_n").alias(f"{m}_n"), F.sum(f"{m}_sum").alias(f"{m}_sum"), moment(f"{m}_m2", f"{m}_n", f"{m}_sum", f"{m}_sum"),
                F.min(f"{m}_min").alias(f"{m}_min"), F.max(f"{m}_max").alias(f"{m}_max")]
    out += [F.sum("pairs").alias("pairs"), F.sum("pair_x_sum").alias("pair_x_sum"), F.sum("pair_y_sum").alias("pair_y_sum"),
            moment("pair_x_m2", "pairs", "pair_x_sum", "pair_x_sum"), moment("pair_y_m2", "pairs", "pair_y_sum", "pair_y_sum"),
            moment("pair_co", "pairs", "pair_x_sum", "pair_y_sum")]
    return rows.groupBy(*by).agg(*out)


def mean(m: str) -> Column:
    return F.try_divide(F.col(f"{m}_sum"), F.col(f"{m}_n"))


def stddev(m: str) -> Column:
    """Sample standard deviation, null for fewer than two values."""
    return F.when(F.col(f"{m}_n") > 1, F.sqrt(F.greatest(F.col(f"{m}_m2"), F.lit(0.0)) / (F.col(f"{m}_n") - 1)))


def correlation() -> Column:
    """Pearson correlation of the pairs, null for fewer than two or without spread."""
    return F.when(F.col("pairs") > 1, F.try_divide(F.col("pair_co"), F.sqrt(F.col("pair_x_m2") * F.col("pair_y_m2"))))


def trend_kpis(partials: DataFrame) -> DataFrame:
    """Per station: mean/min/max temperature, mean humidity, data points (A18) of the given days."""
    m = merged(partials, ["station_id"])
    return m.select("station_id", round_stable(mean("temperature"), 2).alias("avg_temperature"),
                    round_stable("temperature_min", 2).alias("min_temperature"), round_stable("temperature_max", 2).alias("max_temperature"),
                    round_stable(mean("humidity"), 2).alias("avg_humidity"), F.col("n").alias("data_points"))


def station_statistics(partials: DataFrame) -> DataFrame:
    """Per station: spread and relation of temperature and humidity, mean wind and completeness."""
    m = merged(partials, ["station_id"])
    return m.select("station_id", F.col("n").alias("observations"), round_stable(mean("temperature"), 2).alias("avg_temperature"),
                    round_stable(stddev("temperature"), 4).alias("stddev_temperature"), round_stable(mean("wind_speed"), 2).alias("avg_wind_speed"),
                    round_stable(mean("data_completeness_score"), 4).alias("avg_completeness_score"), "pairs",
                    round_stable(correlation(), 4).alias("temp_humidity_corr"))


def temperature_trend(partials: DataFrame) -> DataFrame:
    """Mean temperature and stations per day."""
    m = merged(partials, ["observation_date"]).select("observation_date", round_stable(mean("temperature"), 2).alias("avg_temperature"))
    return m.join(partials.groupBy("observation_date").agg(F.count_distinct("station_id").alias("stations")), "observation_date")
