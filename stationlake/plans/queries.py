"""The registered queries: each takes (spark, sf_dir) and returns a DataFrame over whole tables.

Inputs are derived in Spark from the driver's tables (``sources/fixtures``); dates and times
below are the parameters of the feature being shown (a report day, a lookback, a backfill), not
filters to make checks cheap: every query still reads all rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stationlake.functions import completeness_score, quality_columns
from stationlake.operators import curate, lookup, reports, summarize, views
from stationlake.operators import history as hist
from stationlake.operators.cleanse import cleanse, reject_counts
from stationlake.plans.stored import STORED_QUERIES
from stationlake.plans.streams import STREAM_QUERIES
from stationlake.schemas import DAILY_COLUMNS, RAW_COLUMNS
from stationlake.session import shared_dir
from stationlake.sources import catalog as cat
from stationlake.sources.fixtures import (
    messages_from_events, payloads_from_events, raw_observations, read_source,
)
from stationlake.sources.messages import decode_messages, encode_messages
from stationlake.sources.payload import decode_payloads, payload_rejects
from stationlake.sources.tables import stage

Query = Callable[[SparkSession, str], DataFrame]
REPORT_DAY = "2024-01-15"


def _daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curate.daily_observations(raw_observations(spark, sf_dir))


def q_observations_distinct(spark, sf_dir):
    return curate.observations_distinct(raw_observations(spark, sf_dir))


def q_latest_per_station_hour(spark, sf_dir):
    return curate.hourly_latest(raw_observations(spark, sf_dir)).select(*RAW_COLUMNS)


def q_quality_flags(spark, sf_dir):
    raw = raw_observations(spark, sf_dir)
    return raw.select("station_id", "timestamp", "ingestion_time",
                      *[e.alias(n) for n, e in quality_columns().items()],
                      completeness_score().alias("data_completeness_score"))


def q_daily_observations(spark, sf_dir):
    return _daily(spark, sf_dir).select(*DAILY_COLUMNS)


def q_daily_observations_day(spark, sf_dir):
    return curate.daily_observations(raw_observations(spark, sf_dir), start=REPORT_DAY).select(*DAILY_COLUMNS)


def q_daily_observations_exact(spark, sf_dir):
    """C5 with the reference's DISTINCT step replayed literally (same table as the default path)."""
    return curate.daily_observations(raw_observations(spark, sf_dir), exact_distinct=True).select(*DAILY_COLUMNS)


def q_daily_summary(spark, sf_dir):
    return summarize.daily_summary(_daily(spark, sf_dir))


def q_daily_summary_hot_station(spark, sf_dir):
    """The summary when one station sends a third of all observations (every id divisible by 3 is
    sent as station 0): the skew case the hourly pick and the aggregates must absorb."""
    raw = raw_observations(spark, sf_dir)
    hot = raw.withColumn("station_id", F.when(F.col("station_id") % 3 == 0, F.lit(0).cast("bigint"))
                         .otherwise(F.col("station_id")))
    return summarize.daily_summary(curate.daily_observations(hot))


def q_quality_report(spark, sf_dir):
    return summarize.quality_report(_daily(spark, sf_dir))


def q_quality_rating_by_station_day(spark, sf_dir):
    return summarize.station_day_rating(summarize.daily_summary(_daily(spark, sf_dir)))


# ---- views, history, reports, lookups -------------------------------------------------------

TREND_AS_OF = "2024-01-25 12:00:00"
TREND_DAYS = 14
BACKFILL_FROM, BACKFILL_TO = "2024-01-16", "2024-01-30"
BACKFILL_RUN = "2024-02-01 01:00:00"
REPORT_FROM, REPORT_TO = "2024-01-05", "2024-01-25"


def _summary(spark, sf_dir):
    return summarize.daily_summary(_daily(spark, sf_dir))


def _report(spark, sf_dir):
    return summarize.quality_report(_daily(spark, sf_dir))


def _nightly_history(daily: DataFrame) -> DataFrame:
    """History as nightly runs leave it: each day processed at 01:00 the next day."""
    nightly = F.timestamp_add("HOUR", F.lit(25), F.to_date("timestamp").cast("timestamp_ntz"))
    return hist.history_rows(daily, nightly)


def _backfill(daily: DataFrame) -> DataFrame:
    """A rerun of the second half of the month at one later processing time."""
    return hist.history_rows(reports.date_between(daily, BACKFILL_FROM, BACKFILL_TO).drop("observation_date"),
                             F.lit(BACKFILL_RUN).cast("timestamp_ntz"))


def _lookup_catalog(spark, sf_dir):
    return cat.lookup_catalog(cat.catalog_from_tables(read_source(spark, sf_dir, "supplier"),
                                                      read_source(spark, sf_dir, "nation")))


def q_latest_by_station(spark, sf_dir):
    return views.latest_by_station(raw_observations(spark, sf_dir))


def q_latest_table(spark, sf_dir):
    return views.latest_table(views.latest_by_station(raw_observations(spark, sf_dir)))


def q_overview_display(spark, sf_dir):
    return views.overview_display(views.latest_by_station(raw_observations(spark, sf_dir)))


def q_daily_display(spark, sf_dir):
    return views.daily_display(views.daily_kpis(_summary(spark, sf_dir)))


def q_overview_kpis(spark, sf_dir):
    return views.overview_kpis(views.latest_by_station(raw_observations(spark, sf_dir)))


def q_map_points(spark, sf_dir):
    return views.map_points(views.latest_by_station(raw_observations(spark, sf_dir)))


def q_hottest_10(spark, sf_dir):
    return views.top_n_per_day(_summary(spark, sf_dir), "max_temperature", 10, largest=True)


def q_coldest_10(spark, sf_dir):
    return views.top_n_per_day(_summary(spark, sf_dir), "min_temperature", 10, largest=False)


def q_daily_kpis(spark, sf_dir):
    return views.daily_kpis(_summary(spark, sf_dir))


def _trend(spark, sf_dir, sort=True):
    return views.station_trend(_nightly_history(_daily(spark, sf_dir)), TREND_AS_OF, TREND_DAYS, sort=sort)


def q_station_trend(spark, sf_dir):
    return _trend(spark, sf_dir)


def q_trend_kpis(spark, sf_dir):
    return views.trend_kpis(_trend(spark, sf_dir, sort=False))


def q_trend_series_long(spark, sf_dir):
    return views.trend_series_long(_trend(spark, sf_dir, sort=False))


def q_trend_display(spark, sf_dir):
    return views.trend_display(_trend(spark, sf_dir, sort=False))


def q_quality_display(spark, sf_dir):
    return views.quality_display(_report(spark, sf_dir))


def q_missing_long(spark, sf_dir):
    return views.missing_long(_report(spark, sf_dir))


def q_outlier_long(spark, sf_dir):
    return views.outlier_long(_report(spark, sf_dir))


def q_rating_view(spark, sf_dir):
    return views.rating_view(_report(spark, sf_dir))


def _daily_staged(spark, sf_dir):
    """The curated table written once to the shared folder; the history inputs both read it."""
    return stage(_daily(spark, sf_dir), f"{shared_dir(spark, 'daily')}/daily")


def q_history_union_distinct(spark, sf_dir):
    daily = _daily_staged(spark, sf_dir)
    return hist.union_distinct_history(_nightly_history(daily), _backfill(daily))


def q_history_upsert(spark, sf_dir):
    daily = _daily_staged(spark, sf_dir)
    return hist.merge_history(_nightly_history(daily), _backfill(daily), BACKFILL_FROM, BACKFILL_TO)


def q_station_daily_range(spark, sf_dir):
    return reports.station_daily_range(reports.date_between(_daily(spark, sf_dir), REPORT_FROM, REPORT_TO))


def q_temp_humidity_corr(spark, sf_dir):
    return reports.temp_humidity_corr(_daily(spark, sf_dir))


def q_temp_humidity_pairs(spark, sf_dir):
    return reports.temp_humidity_pairs(_daily(spark, sf_dir))


def q_wind_trend(spark, sf_dir):
    return reports.wind_trend(_daily(spark, sf_dir))


def q_station_comparison(spark, sf_dir):
    return reports.station_comparison(_daily(spark, sf_dir))


def q_temperature_trend(spark, sf_dir):
    return reports.temperature_trend(_daily(spark, sf_dir))


def q_station_completeness(spark, sf_dir):
    return reports.station_completeness(_daily(spark, sf_dir))


def q_geo_distribution(spark, sf_dir):
    return reports.geo_distribution(_daily(spark, sf_dir))


def q_station_name_lookup(spark, sf_dir):
    raw = raw_observations(spark, sf_dir)
    return lookup.enrich_station(raw, _lookup_catalog(spark, sf_dir)).select(
        "station_id", "timestamp", "ingestion_time", "location")


def q_catalog_csv_lookup(spark, sf_dir):
    """The catalogue round-tripped through its published CSV layout, then the producer's rules:
    active stations only, first row per id."""
    path = f"{shared_dir(spark, 'catalog')}/stations_csv"
    cat.write_station_catalog(cat.catalog_from_tables(read_source(spark, sf_dir, "supplier"),
                                                      read_source(spark, sf_dir, "nation")), path)
    return cat.lookup_catalog(cat.read_station_catalog(spark, path)).select("station_id", "station_name")


def q_silent_stations(spark, sf_dir):
    return lookup.silent_stations(_lookup_catalog(spark, sf_dir), raw_observations(spark, sf_dir))


def q_poll_outcome_counts(spark, sf_dir):
    return lookup.poll_outcome_counts(_lookup_catalog(spark, sf_dir), raw_observations(spark, sf_dir))


def q_poll_cycle_outcomes(spark, sf_dir):
    return lookup.poll_cycle_outcomes(_lookup_catalog(spark, sf_dir), raw_observations(spark, sf_dir))


# ---- messages, cleansing, payloads ----------------------------------------------------------
def _cleansed(spark, sf_dir):
    return cleanse(decode_messages(messages_from_events(read_source(spark, sf_dir, "events"))))


def q_cleanse_accept(spark, sf_dir):
    return _cleansed(spark, sf_dir)[0].select(*RAW_COLUMNS)


def q_cleanse_reject_counts(spark, sf_dir):
    return reject_counts(_cleansed(spark, sf_dir)[1])


def q_json_roundtrip(spark, sf_dir):
    accepted, _ = cleanse(decode_messages(encode_messages(raw_observations(spark, sf_dir))))
    return accepted.select(*RAW_COLUMNS)


def _payloads(spark, sf_dir):
    return payloads_from_events(read_source(spark, sf_dir, "events"))


def q_payload_decode(spark, sf_dir):
    return decode_payloads(_payloads(spark, sf_dir))


def q_payload_latest(spark, sf_dir):
    return decode_payloads(_payloads(spark, sf_dir), latest_only=True)


def q_producer_records(spark, sf_dir):
    """The producer's record per poll: newest payload line, named from the active catalogue."""
    latest = decode_payloads(_payloads(spark, sf_dir), latest_only=True)
    return lookup.enrich_station(latest, _lookup_catalog(spark, sf_dir))


def q_payload_reject_counts(spark, sf_dir):
    return (payload_rejects(_payloads(spark, sf_dir)).groupBy("reject_reason")
            .agg(F.count(F.lit(1)).alias("rejected")))


def queries() -> dict[str, Query]:
    return {
        "observations_distinct": q_observations_distinct,
        "latest_per_station_hour": q_latest_per_station_hour,
        "quality_flags": q_quality_flags,
        "daily_observations": q_daily_observations,
        "daily_observations_day": q_daily_observations_day,
        "daily_observations_exact": q_daily_observations_exact,
        "daily_summary": q_daily_summary,
        "daily_summary_hot_station": q_daily_summary_hot_station,
        "quality_report": q_quality_report,
        "quality_rating_by_station_day": q_quality_rating_by_station_day,

        "latest_by_station": q_latest_by_station,
        "overview_kpis": q_overview_kpis,
        "latest_table": q_latest_table,
        "overview_display": q_overview_display,
        "daily_display": q_daily_display,
        "map_points": q_map_points,
        "hottest_10": q_hottest_10,
        "coldest_10": q_coldest_10,
        "daily_kpis": q_daily_kpis,
        "station_trend_14d": q_station_trend,
        "trend_kpis": q_trend_kpis,
        "trend_series_long": q_trend_series_long,
        "trend_display": q_trend_display,
        "quality_display": q_quality_display,
        "missing_long": q_missing_long,
        "outlier_long": q_outlier_long,
        "rating_view": q_rating_view,
        "history_union_distinct": q_history_union_distinct,
        "history_upsert": q_history_upsert,
        "station_daily_range": q_station_daily_range,
        "temp_humidity_corr": q_temp_humidity_corr,
        "temp_humidity_pairs": q_temp_humidity_pairs,
        "wind_trend": q_wind_trend,
        "station_comparison": q_station_comparison,
        "temperature_trend": q_temperature_trend,
        "station_completeness": q_station_completeness,
        "geo_distribution": q_geo_distribution,
        "station_name_lookup": q_station_name_lookup,
        "silent_stations": q_silent_stations,
        "catalog_csv_lookup": q_catalog_csv_lookup,
        "poll_outcome_counts": q_poll_outcome_counts,
        "poll_cycle_outcomes": q_poll_cycle_outcomes,
        "cleanse_accept": q_cleanse_accept,
        "cleanse_reject_counts": q_cleanse_reject_counts,
        "json_roundtrip": q_json_roundtrip,
        "payload_decode": q_payload_decode,
        "payload_latest": q_payload_latest,
        "payload_reject_counts": q_payload_reject_counts,
        "producer_records": q_producer_records,
        **STREAM_QUERIES,
        **STORED_QUERIES,
    }
