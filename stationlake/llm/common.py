"""Shared helpers of the training-data operators: table access and staging in the shared folder."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stationlake.session import shared_dir

#: ids of rows without one sort after every real id (documented null rule of the operators)
NO_ID = (1 << 63) - 1


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables, whole."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the cluster's shared folder and read it back.

    Cuts the lineage: a lost executor recomputes nothing before this point, and several readers of
    the result scan the files instead of repeating the work.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark, name)}/data"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def staged_by(df: DataFrame, name: str, key: str, count: int) -> DataFrame:
    """``staged`` in a file for each of ``count`` hash partitions of ``key``, by which ``df`` must be dealt out already:
    what groups by ``key`` (and other columns) or joins by it moves no row again.

    Spark keeps the layout of files in the catalog alone: the table has a name there until its plan is resolved.
    """
    spark = df.sparkSession
    table_name = f"stationlake_{uuid.uuid4().hex}"
    (df.write.format("parquet").option("path", f"{shared_dir(spark, name)}/data")
     .bucketBy(count, key).saveAsTable(table_name))
    try:
        return spark.table(table_name)
    finally:
        spark.sql(f"DROP TABLE {table_name}")  # the files stay, as they lie outside the warehouse


_kept: dict = {}


def worker_state(key, make: Callable[[], object]):
    """What a Python worker keeps from task to task (a vocabulary, a cache), for one operator at a time:
    workers are reused by every stage of an application, and must not add up what each left."""
    if key not in _kept:
        _kept.clear()
        give_back()
        _kept[key] = make()
    return _kept[key]


def give_back() -> None:
    """Return freed memory to the system, where the C library offers it."""
    gc.collect()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def doc_key() -> F.Column:
    """``doc_id`` as a long; rows without an id share the largest one."""
    return F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID))
