"""Catalogue joins: station-name enrichment and poll coverage.

No broadcast hint is forced: a real catalogue is small, but one derived from data is not bounded,
so the choice is left to the size check Spark already makes (autoBroadcastJoinThreshold on the
estimate, then AQE on the measured shuffle size) with sort-merge as the way beyond it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationlake.functions import ntz_literal
from stationlake.schemas import POLL_INTERVAL_MINUTES, RAW_COLUMNS


def enrich_station(obs: DataFrame, catalog: DataFrame) -> DataFrame:
    """Set ``location`` from the catalogue; ids not in the active catalogue get null."""
    names = catalog.select("station_id", F.col("station_name").alias("location"))
    return obs.drop("location").join(names, "station_id", "left")


def silent_stations(catalog: DataFrame, obs: DataFrame) -> DataFrame:
    """Active catalogue stations that delivered no observation at all (J2, left anti).

    The observations are first reduced to their distinct station ids (a partial aggregate, so a
    station with a third of all rows collapses map-side); the join then pairs two station lists.
    """
    delivered = obs.select("station_id").distinct()
    return catalog.join(delivered, "station_id", "left_anti").select("station_id", "station_name")


def poll_outcome_counts(catalog: DataFrame, obs: DataFrame) -> DataFrame:
    """Per day: active stations polled, stations that delivered, stations that did not.

    The number of polled stations is one scalar subquery, not a join, so nothing is paired. Days
    are those from the first to the last observation, whether or not anything came.
    """
    days = obs.agg(F.to_date(F.min("timestamp")).alias("a"), F.to_date(F.max("timestamp")).alias("b")).where("a IS NOT NULL")
    calendar = days.select(F.explode(F.sequence("a", "b")).alias("observation_date"))
    return _outcomes(catalog, obs.select(F.to_date("timestamp").alias("observation_date"), "station_id"), calendar,
                     "observation_date")


CYCLES_PER_BLOCK = 4096


def cycle_calendar(ends: DataFrame, minutes: int) -> DataFrame:
    """Every cycle start from ``a`` to ``b`` of the one row of ``ends``, made where it is used.

    Only the starts of blocks of cycles come from one row; they are dealt out, and each task counts through
    its blocks. A bad ingestion time that lies centuries off so adds blocks to every task, not an array of
    millions to one.
    """
    block = f"make_interval(0, 0, 0, 0, 0, {minutes * CYCLES_PER_BLOCK}, 0)"
    blocks = ends.select("b", F.explode(F.expr(f"sequence(a, b, {block})")).alias("from"))
    upto = F.expr(f"least(b, `from` + make_interval(0, 0, 0, 0, 0, {minutes * (CYCLES_PER_BLOCK - 1)}, 0))")
    return (blocks.select("from", upto.alias("to")).repartition("from")
            .select(F.explode(F.expr(f"sequence(`from`, `to`, make_interval(0, 0, 0, 0, 0, {minutes}, 0))")).alias("cycle_start")))


def poll_cycle_outcomes(catalog: DataFrame, obs: DataFrame, minutes: int = POLL_INTERVAL_MINUTES, start=None, end=None) -> DataFrame:
    """The same per poll cycle of ``minutes``, by ingestion time, cycles in which nothing came included.

    ``start`` and ``end`` bound the cycles to the feed's own period; without them the first and the last
    ingestion time do.
    """
    at = F.window("ingestion_time", f"{minutes} minutes")["start"].cast("timestamp_ntz")
    seen = obs.select(at.alias("cycle_start"), "station_id")
    for bound, keep in ((start, F.col("cycle_start") >= F.lit(start).cast("timestamp_ntz")), (end, F.col("cycle_start") <= F.lit(end).cast("timestamp_ntz"))):
        seen = seen if bound is None else seen.where(keep)
    ends = seen.agg(F.min("cycle_start").alias("a"), F.max("cycle_start").alias("b")).where("a IS NOT NULL")
    return _outcomes(catalog, seen, cycle_calendar(ends, minutes), "cycle_start")


def _outcomes(catalog: DataFrame, seen: DataFrame, calendar: DataFrame, period: str) -> DataFrame:
    polled = catalog.select(F.count(F.lit(1))).scalar()
    delivered = (seen.distinct().join(catalog.select("station_id"), "station_id", "left_semi")
                 .groupBy(period).agg(F.count(F.lit(1)).alias("succeeded")))
    counted = calendar.join(delivered, period, "left").select(
        period, polled.alias("polled"), F.coalesce("succeeded", F.lit(0)).alias("succeeded"))
    return counted.withColumn("failed", F.col("polled") - F.col("succeeded"))


def producer_records(decoded: DataFrame, catalog: DataFrame, ingestion_time) -> DataFrame:
    """The producer's 14-field records: decoded payload rows, named from the catalogue, stamped with the
    ``ingestion_time`` (a column, or one time for the whole poll)."""
    at = ingestion_time if isinstance(ingestion_time, F.Column) else ntz_literal(ingestion_time)
    return enrich_station(decoded.withColumn("ingestion_time", at), catalog).select(*RAW_COLUMNS)
