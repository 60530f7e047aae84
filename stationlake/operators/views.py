"""Datasets behind the overview, daily-statistics, trend and quality views.

Every view is computed for all dates at once (grouped by date) instead of one selected day, so
one job serves every date a user may pick; a single day is a partition-pruned filter on top.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stationlake.functions import ntz_literal, rating_mark, round_stable
from stationlake.operators.curate import latest_order
from stationlake.schemas import PARAMETER_LABELS, UNIT_PERCENT, UNIT_TEMPERATURE, UNIT_WIND

LATEST_COLUMNS = ["station_id", "location", "latitude", "longitude", "temperature", "humidity",
                  "wind_speed", "pressure", "timestamp"]


def latest_by_station(raw: DataFrame) -> DataFrame:
    """Newest observation per station and day (W2), with the day as ``observation_date``.

    ``row_number() = 1`` is planned with a partial WindowGroupLimit, so each map task forwards
    one row per station-day and a hot station is reduced before the shuffle.
    """
    day = F.to_date("timestamp")
    w = Window.partitionBy(F.col("station_id"), day).orderBy(*latest_order())
    return (raw.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1)
            .select(*LATEST_COLUMNS, day.alias("observation_date")))


def latest_table(latest: DataFrame) -> DataFrame:
    """The overview's table: newest observations first, station id breaking ties."""
    return (latest.select("observation_date", "station_id", "location", "temperature", "humidity", "wind_speed",
                          "pressure", "timestamp")
            .orderBy(F.col("timestamp").desc(), F.col("station_id")))


def date_suffix(d) -> Column:
    """``YYYYMMDD`` text of a date, the reference's per-day table suffix."""
    return F.date_format(F.col(d) if isinstance(d, str) else d, "yyyyMMdd")


def _fixed(x: Column, digits: int, unit: str = "") -> Column:
    # Round first (stable, half away from zero) so the text shows exactly the rounded value.
    return F.format_string(f"%.{digits}f{unit.replace('%', '%%')}", round_stable(x, digits))


def overview_display(latest: DataFrame) -> DataFrame:
    """KPI card texts of the overview page: 1 decimal with units.

    Aggregated from the latest rows and rounded once, so the text shows the mean itself to one
    decimal (formatting the 2-decimal KPI columns would round twice).
    """
    kpis = latest.groupBy("observation_date").agg(
        F.count(F.lit(1)).alias("active_stations"), F.avg("temperature").alias("t"),
        F.avg("humidity").alias("h"), F.max("wind_speed").alias("w"))
    return kpis.select(
        "observation_date", date_suffix("observation_date").alias("date_suffix"),
        F.col("active_stations").cast("string").alias("active_stations_text"),
        _fixed(F.col("t"), 1, UNIT_TEMPERATURE).alias("avg_temperature_text"),
        _fixed(F.col("h"), 1, UNIT_PERCENT).alias("avg_humidity_text"),
        _fixed(F.col("w"), 1, UNIT_WIND).alias("max_wind_speed_text"))


def daily_display(kpis: DataFrame) -> DataFrame:
    """KPI card texts of the daily-statistics page: thousands separator, percent."""
    return kpis.select(
        "observation_date", date_suffix("observation_date").alias("date_suffix"),
        F.col("stations_reporting").cast("string").alias("stations_reporting_text"),
        F.format_number(F.col("total_observations"), 0).alias("total_observations_text"),
        _fixed(F.col("avg_data_quality") * 100, 2, UNIT_PERCENT).alias("avg_data_quality_text"))


def overview_kpis(latest: DataFrame) -> DataFrame:
    """Per day: stations with data, mean temperature, mean humidity, max wind (nulls skipped)."""
    return latest.groupBy("observation_date").agg(
        F.count(F.lit(1)).alias("active_stations"),
        round_stable(F.avg("temperature"), 2).alias("avg_temperature"),
        round_stable(F.avg("humidity"), 2).alias("avg_humidity"),
        round_stable(F.max("wind_speed"), 2).alias("max_wind_speed"),
    )


def map_points(latest: DataFrame) -> DataFrame:
    """Latest rows plus marker size: missing wind → 0, then at least 1."""
    display = F.coalesce(F.col("wind_speed"), F.lit(0.0))
    return latest.select(
        "observation_date", "station_id", "location", "latitude", "longitude", "temperature", "humidity",
        "wind_speed", "pressure", display.alias("wind_speed_display"),
        F.greatest(display, F.lit(1.0)).alias("marker_size"))


def top_n_per_day(summary: DataFrame, value: str, n: int = 10, largest: bool = True) -> DataFrame:
    """The ``n`` highest (or lowest) stations of each day by ``value``.

    Nulls rank last, ties go to the lower station id (the view's input order). The per-day limit
    is planned as a partial top-n before the shuffle, so each task ships at most ``n`` rows a day.
    """
    order = F.col(value).desc_nulls_last() if largest else F.col(value).asc_nulls_last()
    w = Window.partitionBy("observation_date").orderBy(order, "station_id", "location", "latitude", "longitude")
    return (summary.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)
            .select("observation_date", "rank", "station_id", "location", value))


def daily_kpis(summary: DataFrame) -> DataFrame:
    """Per day: stations reporting, total observations, mean completeness."""
    return summary.groupBy("observation_date").agg(
        F.count(F.lit(1)).alias("stations_reporting"),
        F.sum("total_observations").alias("total_observations"),
        round_stable(F.avg("avg_completeness_score"), 4).alias("avg_data_quality"),
    )


def station_trend(history: DataFrame, as_of, days: int = 30, station_ids=None, sort: bool = True) -> DataFrame:
    """History rows of the ``days`` days up to ``as_of`` (P13, O3), optionally for some stations."""
    if isinstance(as_of, str):
        as_of = dt.datetime.fromisoformat(as_of)
    since = as_of - dt.timedelta(days=days)
    out = history.where((F.col("timestamp") >= ntz_literal(since)) & (F.col("timestamp") <= ntz_literal(as_of)))
    if "observation_date" in history.columns:  # lets the reader skip whole date folders
        out = out.where(F.col("observation_date").between(F.lit(since.date()), F.lit(as_of.date())))
    if station_ids is not None:
        out = out.where(F.col("station_id").isin(list(station_ids)))
    out = out.select("station_id", "timestamp", "temperature", "humidity", "wind_speed", "pressure",
                     "data_completeness_score")
    return out.orderBy("station_id", "timestamp") if sort else out


def trend_kpis(trend: DataFrame) -> DataFrame:
    """Per station: mean/min/max temperature, mean humidity, data points."""
    return trend.groupBy("station_id").agg(
        round_stable(F.avg("temperature"), 2).alias("avg_temperature"),
        round_stable(F.min("temperature"), 2).alias("min_temperature"),
        round_stable(F.max("temperature"), 2).alias("max_temperature"),
        round_stable(F.avg("humidity"), 2).alias("avg_humidity"),
        F.count(F.lit(1)).alias("data_points"),
    )


def trend_display(trend: DataFrame) -> DataFrame:
    """KPI card texts of the trend page per station: mean and range to 1 decimal, thousands separator."""
    kpis = trend.groupBy("station_id").agg(
        F.avg("temperature").alias("t"), F.min("temperature").alias("lo"), F.max("temperature").alias("hi"),
        F.avg("humidity").alias("h"), F.count(F.lit(1)).alias("n"))
    return kpis.select(
        "station_id", _fixed(F.col("t"), 1, UNIT_TEMPERATURE).alias("avg_temperature_text"),
        F.concat(_fixed(F.col("lo"), 1, UNIT_TEMPERATURE), F.lit(" to "), _fixed(F.col("hi"), 1, UNIT_TEMPERATURE))
        .alias("temperature_range_text"),
        _fixed(F.col("h"), 1, UNIT_PERCENT).alias("avg_humidity_text"), F.format_number("n", 0).alias("data_points_text"))


def quality_display(report: DataFrame) -> DataFrame:
    """Texts of the quality page per day: the rating with its mark, counts, valid shares to 1 decimal."""
    return report.select(
        "report_date",
        F.concat_ws(" ", rating_mark("overall_quality_rating"), F.col("overall_quality_rating")).alias("rating_text"),
        F.col("active_stations").cast("string").alias("active_stations_text"),
        F.format_number("total_observations", 0).alias("total_observations_text"),
        *[_fixed(F.col(f"{m}_valid_pct"), 1, UNIT_PERCENT).alias(f"{m}_valid_text") for m in PARAMETER_LABELS])


def trend_series_long(trend: DataFrame) -> DataFrame:
    """Temperature and humidity as one long series per station."""
    return trend.unpivot(["station_id", "timestamp"], ["temperature", "humidity"], "series", "value")


def _report_long(report: DataFrame, prefix: str, value_name: str) -> DataFrame:
    cols: list[Column] = [F.col(f"{prefix}_{m}").alias(label) for m, label in PARAMETER_LABELS.items()]
    return report.select("report_date", *cols).unpivot(
        ["report_date"], list(PARAMETER_LABELS.values()), "parameter", value_name)


def missing_long(report: DataFrame) -> DataFrame:
    """Missing counts, one row per day and parameter."""
    return _report_long(report, "missing", "missing_count")


def outlier_long(report: DataFrame) -> DataFrame:
    """Outlier counts, one row per day and parameter (R2)."""
    return _report_long(report, "outlier", "outlier_count")


def rating_view(report: DataFrame) -> DataFrame:
    """The quality page's header row per day: rating, its mark and the headline metrics."""
    return report.select(
        "report_date", "overall_quality_rating", rating_mark("overall_quality_rating").alias("rating_mark"),
        "active_stations", "total_observations", "temperature_valid_pct", "humidity_valid_pct",
        "wind_speed_valid_pct", "pressure_valid_pct")
