"""Station catalogue: CSV reader, active-station rule, de-duplication."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stationlake.functions import to_id
from stationlake.schemas import ACTIVE_FINISH_YEAR, CATALOG_CSV_SCHEMA

CATALOG_COLUMNS = ["station_id", "station_name", "lat", "lon", "start", "finish", "catalog_order"]


def read_station_catalog(spark: SparkSession, path: str, encoding: str = "UTF-8") -> DataFrame:
    """Read the published ``Name,FMISID,lat,lon,start,finish`` CSV with an explicit schema.

    ``catalog_order`` orders rows as they appear in the file(s), taken right at the scan, so
    "first row wins" lookups stay reproducible when an id appears twice.
    """
    df = spark.read.csv(path, header=True, schema=CATALOG_CSV_SCHEMA, encoding=encoding, mode="PERMISSIVE")
    # File order: by file name, then by position in the file (one split per catalogue-sized file,
    # where the generated id grows with the row position).
    order = F.struct(F.input_file_name().alias("file"), F.monotonically_increasing_id().alias("row"))
    return df.select(
        to_id("FMISID").alias("station_id"), F.col("Name").alias("station_name"), "lat", "lon", "start",
        F.col("finish"), order.alias("catalog_order"))


def catalog_from_tables(supplier: DataFrame, nation: DataFrame) -> DataFrame:
    """A catalogue made from the driver tables: station ``2 * s_suppkey`` per supplier, plus station
    ``2 * n_nationkey`` per nation, listed after the suppliers, so low ids appear twice and the first
    active row must win. Odd observation ids have no catalogue row; high even ids have no data.
    ``finish`` cycles over empty, 2019, 2020 and an unparsable value."""
    nk = F.col("s_nationkey")
    finish = (F.when(nk % 5 == 1, F.lit("2019")).when(nk % 5 == 2, F.lit("2020"))
              .when(nk % 5 == 3, F.lit("x")).otherwise(F.lit(None).cast("string")))
    sup = supplier.select(
        (F.col("s_suppkey") * 2).cast("bigint").alias("station_id"), F.col("s_name").alias("station_name"),
        (F.lit(60.0) + F.col("s_nationkey")).alias("lat"), (F.lit(20.0) + F.col("s_nationkey") % 11).alias("lon"),
        F.lit(1990).alias("start"), finish.alias("finish"), F.col("s_suppkey").cast("bigint").alias("catalog_order"))
    nat = nation.select(
        (F.col("n_nationkey") * 2).cast("bigint").alias("station_id"), F.col("n_name").alias("station_name"),
        F.lit(65.0).alias("lat"), F.lit(25.0).alias("lon"), F.lit(2000).alias("start"),
        F.lit(None).cast("string").alias("finish"),
        (F.lit(1_000_000_000_000) + F.col("n_nationkey")).cast("bigint").alias("catalog_order"))
    return sup.unionByName(nat)


def active_stations(catalog: DataFrame) -> DataFrame:
    """``finish`` empty, or numeric and >= 2020 (P5)."""
    fin = F.trim(F.col("finish"))
    return catalog.where(fin.isNull() | (fin == "") | (fin.try_cast("double") >= F.lit(float(ACTIVE_FINISH_YEAR))))


def dedupe_catalog(catalog: DataFrame) -> DataFrame:
    """One row per station id: the first in catalogue order."""
    w = Window.partitionBy("station_id").orderBy("catalog_order")
    return catalog.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")


def lookup_catalog(catalog: DataFrame) -> DataFrame:
    """The catalogue as the producer uses it: active rows, one per id."""
    return dedupe_catalog(active_stations(catalog))


def write_station_catalog(catalog: DataFrame, path: str) -> None:
    """Write a catalogue as the published CSV layout, rows in ``catalog_order`` across range-ordered
    files, as many as the session's shuffles have partitions (fewer where those are small)."""
    out = catalog.repartitionByRange("catalog_order").sortWithinPartitions("catalog_order")
    out.select(F.col("station_name").alias("Name"), F.col("station_id").cast("string").alias("FMISID"),
               "lat", "lon", "start", "finish").write.mode("overwrite").csv(path, header=True, encoding="UTF-8")
