"""Publishing without duplicates (S4, T3): an outbox on the sending side, a ledger on the landing side.

A batch of messages is numbered and written to the outbox before anything is sent, then sent from there, then
marked as sent. A run that was killed in between sends the same messages under the same ids again, as
does a retried task of a sink without transactions. Every message carries its id, ``<producer>/<batch>/<hash
of the message>-<copy>``; the landing job leaves out ids that its ledger holds. The ledger is kept by
producer and batch, so a micro-batch reads the ids of the producer batches that it holds messages of,
and no others, and a replayed micro-batch replaces its own part of it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stationlake.sources import versions
from stationlake.sources.messages import write_messages
from stationlake.sources.tables import path_exists

NUMBERED_SCHEMA = "key string, value string, message_id string"
LEDGER_SCHEMA = T.StructType([T.StructField("message_id", T.StringType()), T.StructField("producer", T.StringType()),
                              T.StructField("producer_batch", T.LongType()), T.StructField("source_id", T.StringType()),
                              T.StructField("batch_id", T.LongType())])


def number_messages(msgs: DataFrame, producer: str, batch: int) -> DataFrame:
    """``msgs`` (key, value) plus ``message_id``. Equal messages are counted, so which copy is which does not matter
    and the ids are the same whatever order the rows come in."""
    if "/" in producer:
        raise ValueError("a producer's name has no slash")
    text = [F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value")]
    counted = msgs.select(*text).groupBy("key", "value").agg(F.count("*").alias("n"))
    digest = F.concat(F.hex(F.xxhash64(F.lit(0), "key", "value")), F.hex(F.xxhash64(F.lit(1), "key", "value")))
    return (counted.select("key", "value", F.explode(F.sequence(F.lit(1).cast("long"), "n")).alias("copy"))
            .select("key", "value", F.concat(F.lit(f"{producer}/{batch}/"), F.lower(digest), F.lit("-"), F.col("copy")).alias("message_id")))


def publish(msgs: DataFrame, fmt: str, target: str, outbox: str, producer: str, batch: int, topic: str | None = None,
            step: Callable[[str], None] = lambda at: None, files: int | None = None) -> bool:
    """Send one batch through the outbox (to at most ``files`` files); False if it was sent before. ``step`` is called
    between the steps."""
    spark = msgs.sparkSession
    folder = f"{outbox.rstrip('/')}/producer={producer}/batch={batch}"
    if path_exists(spark, f"{folder}/sent"):
        return False
    if not path_exists(spark, f"{folder}/messages/_SUCCESS"):
        number_messages(msgs, producer, batch).write.mode("overwrite").parquet(f"{folder}/messages")
    step("staged")
    write_messages(spark.read.schema(NUMBERED_SCHEMA).parquet(f"{folder}/messages"), fmt, target, topic, files)
    step("sent")
    versions.file_system(spark, folder).create(spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/sent"), True).close()
    step("marked")
    return True


def _parts() -> list[F.Column]:
    return [F.split_part("message_id", F.lit("/"), F.lit(1)).alias("producer"),
            F.split_part("message_id", F.lit("/"), F.lit(2)).try_cast("long").alias("producer_batch")]


def unseen(batch: DataFrame, ledger: str, source_id: str, batch_id: int) -> DataFrame:
    """The messages of a micro-batch that no other micro-batch landed, each once. Messages without an id all stay."""
    spark = batch.sparkSession
    named = batch.where("message_id IS NOT NULL").dropDuplicates(["message_id"])
    parts = named.select(*_parts()).distinct().collect()  # the producer batches in one micro-batch
    folders = [f"{ledger.rstrip('/')}/producer={r.producer}/producer_batch={r.producer_batch}" for r in parts]
    there = [f for f in folders if path_exists(spark, f)]
    if there:
        own = (F.col("source_id") == source_id) & (F.col("batch_id") == batch_id)
        landed = spark.read.schema(LEDGER_SCHEMA).option("basePath", ledger).parquet(*there).where(~own).select("message_id")
        named = named.join(landed, "message_id", "left_anti")
    return named.select(*batch.columns).unionByName(batch.where("message_id IS NULL"))


def record(batch: DataFrame, ledger: str, source_id: str, batch_id: int) -> None:
    """Enter a micro-batch's ids into the ledger, replacing what an earlier try of it entered."""
    ids = batch.where("message_id IS NOT NULL").select("message_id", *_parts(), F.lit(source_id).alias("source_id"),
                                                       F.lit(batch_id).cast("long").alias("batch_id"))
    parts = ["producer", "producer_batch", "source_id", "batch_id"]
    (ids.hint("rebalance", *parts).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*parts).parquet(ledger))
