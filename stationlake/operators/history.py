"""Long-term station history (C8): literal union-distinct and keyed upsert."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stationlake.functions import ntz_literal
from stationlake.schemas import HISTORY_COLUMNS, MEASURES



def history_rows(daily: DataFrame, processing_time=None) -> DataFrame:
    """Project daily observations to history rows; ``processing_time`` may be a literal or column."""
    if processing_time is not None:
        pt = processing_time if isinstance(processing_time, F.Column) else ntz_literal(processing_time)
        daily = daily.withColumn("processing_time", pt.cast("timestamp_ntz"))
    return daily.select(*HISTORY_COLUMNS, F.to_date("timestamp").alias("observation_date"))


def union_distinct_history(existing: DataFrame, new: DataFrame) -> DataFrame:
    """``existing UNION DISTINCT new`` (U1). Rerunning a day with a new processing time appends a
    second copy of its rows, exactly as the reference does."""
    cols = [*HISTORY_COLUMNS, "observation_date"]
    return existing.select(*cols).unionByName(new.select(*cols)).distinct()


def upsert_history(existing: DataFrame, new: DataFrame) -> DataFrame:
    """Keyed upsert (U2): one row per (station, clock hour), as in the daily observations; the newest
    processing time wins, then the newest observation.

    Keyed by the hour and not the timestamp: a late row can change which observation stands for
    its hour, and a rerun must then replace the old one. Only dates present in ``new`` can change,
    so pass ``existing`` restricted to those dates (``merge_history`` does; the daily job filters the
    partition column), and history size stops mattering.
    """
    cols = [*HISTORY_COLUMNS, "observation_date"]
    both = existing.select(*cols).unionByName(new.select(*cols))
    order = [F.col("processing_time").desc_nulls_last(), F.col("timestamp").desc_nulls_last(),
             *[F.col(c).desc_nulls_last() for c in [*MEASURES, "data_completeness_score"]]]
    w = Window.partitionBy("station_id", F.date_trunc("hour", "timestamp")).orderBy(*order)
    return both.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")


def merge_history(existing: DataFrame, new: DataFrame, start, end) -> DataFrame:
    """The whole history after a keyed upsert of ``new``, whose dates are ``start`` to ``end``.

    The range is a constant predicate on the partition date: dates outside it pass through as they
    are, those inside go through the upsert window, and neither side reads the other's folders.
    """
    cols = [*HISTORY_COLUMNS, "observation_date"]
    inside = F.col("observation_date").between(F.lit(str(start)).cast("date"), F.lit(str(end)).cast("date"))
    untouched = existing.where(~F.coalesce(inside, F.lit(False))).select(*cols)
    return untouched.unionByName(upsert_history(existing.where(inside), new.where(inside)).select(*cols))
