"""Datasets of the documented BI report pages (C13): overview and station analysis."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationlake.functions import round_stable


def with_date(df: DataFrame) -> DataFrame:
    return df if "observation_date" in df.columns else df.withColumn("observation_date", F.to_date("timestamp"))


def date_between(df: DataFrame, start, end) -> DataFrame:
    """Two-sided date-range filter of the report."""
    return with_date(df).where(F.col("observation_date").between(F.lit(start).cast("date"), F.lit(end).cast("date")))


def station_daily_range(daily: DataFrame) -> DataFrame:
    """Daily min/avg/max temperature series per station."""
    return with_date(daily).groupBy("station_id", "observation_date").agg(
        round_stable(F.min("temperature"), 2).alias("min_temperature"),
        round_stable(F.avg("temperature"), 2).alias("avg_temperature"),
        round_stable(F.max("temperature"), 2).alias("max_temperature"),
    )


def temp_humidity_corr(daily: DataFrame) -> DataFrame:
    """Temperature–humidity relation per station: pair count and Pearson correlation."""
    both = F.col("temperature").isNotNull() & F.col("humidity").isNotNull()
    return daily.groupBy("station_id").agg(
        F.count(F.when(both, F.lit(1))).alias("pairs"),
        round_stable(F.corr("temperature", "humidity"), 4).alias("temp_humidity_corr"),
    )


def temp_humidity_pairs(daily: DataFrame) -> DataFrame:
    """The points of the temperature–humidity scatter: observations that have both."""
    return daily.where(F.col("temperature").isNotNull() & F.col("humidity").isNotNull()).select(
        "station_id", "timestamp", "temperature", "humidity")


def station_comparison(daily: DataFrame) -> DataFrame:
    """Per-station averages for the comparison bars."""
    return daily.groupBy("station_id", "location").agg(
        round_stable(F.avg("temperature"), 2).alias("avg_temperature"),
        round_stable(F.avg("humidity"), 2).alias("avg_humidity"),
        round_stable(F.avg("wind_speed"), 2).alias("avg_wind_speed"),
    )


def temperature_trend(daily: DataFrame) -> DataFrame:
    """Mean temperature per day over all stations."""
    return with_date(daily).groupBy("observation_date").agg(
        round_stable(F.avg("temperature"), 2).alias("avg_temperature"),
        F.count_distinct("station_id").alias("stations"),
    )


def wind_trend(daily: DataFrame) -> DataFrame:
    """Mean and highest wind speed per day over all stations."""
    return with_date(daily).groupBy("observation_date").agg(
        round_stable(F.avg("wind_speed"), 2).alias("avg_wind_speed"),
        round_stable(F.max("wind_speed"), 2).alias("max_wind_speed"),
        F.count("wind_speed").alias("observations"),
    )


def station_completeness(daily: DataFrame) -> DataFrame:
    """Observation count and mean completeness per station."""
    return daily.groupBy("station_id").agg(
        F.count(F.lit(1)).alias("observations"),
        round_stable(F.avg("data_completeness_score"), 4).alias("avg_completeness_score"),
    )


def geo_distribution(daily: DataFrame) -> DataFrame:
    """One point per station position with its averages, for the map page."""
    return daily.groupBy("station_id", "location", "latitude", "longitude").agg(
        round_stable(F.avg("temperature"), 2).alias("avg_temperature"),
        round_stable(F.avg("wind_speed"), 2).alias("avg_wind_speed"),
        F.count(F.lit(1)).alias("observations"),
    )
