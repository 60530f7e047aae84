"""Per-station-day statistics and the per-day quality report."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationlake.functions import rating, round_stable
from stationlake.schemas import OUTLIER, QUALITY_MEASURES, VALID

SUMMARY_KEYS = ["station_id", "location", "latitude", "longitude", "observation_date"]


def _count_if(cond) -> F.Column:
    return F.count(F.when(cond, F.lit(1)))


def daily_summary(daily: DataFrame) -> DataFrame:
    """Statistics per station-day; groups also on location and coordinates, as the reference does.

    One hash aggregation with map-side partial aggregates, so a hot station costs one partial row
    per map task, not a hot reducer.
    """
    t, h, w, p = (F.col(c) for c in ("temperature", "humidity", "wind_speed", "pressure"))
    return (
        daily.withColumn("observation_date", F.to_date("timestamp"))
        .groupBy(*SUMMARY_KEYS)
        .agg(
            F.count(t).alias("temperature_count"),
            round_stable(F.avg(t), 2).alias("avg_temperature"),
            round_stable(F.min(t), 2).alias("min_temperature"),
            round_stable(F.max(t), 2).alias("max_temperature"),
            round_stable(F.stddev_samp(t), 2).alias("stddev_temperature"),
            F.count(h).alias("humidity_count"),
            round_stable(F.avg(h), 2).alias("avg_humidity"),
            round_stable(F.min(h), 2).alias("min_humidity"),
            round_stable(F.max(h), 2).alias("max_humidity"),
            F.count(w).alias("wind_count"),
            round_stable(F.avg(w), 2).alias("avg_wind_speed"),
            round_stable(F.max(w), 2).alias("max_wind_speed"),
            round_stable(F.avg(p), 2).alias("avg_pressure"),
            round_stable(F.min(p), 2).alias("min_pressure"),
            round_stable(F.max(p), 2).alias("max_pressure"),
            round_stable(F.sum(F.coalesce(F.col("precipitation"), F.lit(0.0))), 2).alias("total_precipitation"),
            F.count(F.lit(1)).alias("total_observations"),
            round_stable(F.avg("data_completeness_score"), 3).alias("avg_completeness_score"),
            _count_if(F.col("temperature_quality") == OUTLIER).alias("temperature_outliers"),
            _count_if(F.col("humidity_quality") == OUTLIER).alias("humidity_outliers"),
        )
    )


def quality_report(daily: DataFrame) -> DataFrame:
    """One row per day: stations, observations, missing/outlier counts, valid %, score and rating.

    The station count is exact: a two-level aggregate, (day, station) and then day, both partial.
    """
    n = F.count(F.lit(1))
    aggs = [
        F.count_distinct("station_id").alias("active_stations"),
        n.alias("total_observations"),
        *[_count_if(F.col(m).isNull()).alias(f"missing_{m}") for m in QUALITY_MEASURES],
        *[_count_if(F.col(f"{m}_quality") == OUTLIER).alias(f"outlier_{m}") for m in QUALITY_MEASURES],
        *[round_stable(_count_if(F.col(f"{m}_quality") == VALID) * F.lit(100.0) / n, 2).alias(f"{m}_valid_pct")
          for m in QUALITY_MEASURES],
        round_stable(F.avg("data_completeness_score"), 3).alias("avg_completeness_score"),
    ]
    return (
        daily.groupBy(F.to_date("timestamp").alias("report_date"))
        .agg(*aggs)
        .withColumn("overall_quality_rating", rating("avg_completeness_score"))
    )


def station_day_rating(summary: DataFrame) -> DataFrame:
    """The report's rating rule applied per station-day."""
    return summary.select(*SUMMARY_KEYS, "avg_completeness_score",
                          rating("avg_completeness_score").alias("quality_rating"))
