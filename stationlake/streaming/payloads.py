"""The producer as a stream (C1, J1, S2–S4): payload documents in, observation rows, landed records or keyed
messages out.

Decoding keeps no state, so the batch functions of ``sources.payload`` serve the stream unchanged. Names
come from a stream-static join: the catalogue is a table that each micro-batch reads anew, small
enough or not to be broadcast as Spark measures it. Rejected payloads are not lost on the way; the
landing job writes them to a quarantine beside the rows, under the same source and batch.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from stationlake.operators.lookup import producer_records
from stationlake.sources.messages import encode_messages
from stationlake.sources.payload import decode_payloads, decoded_and_rejected
from stationlake.sources.tables import append_batch
from stationlake.streaming.landing import _query_id, _trigger

PAYLOAD_SCHEMA = "station_id string, xml string"
REJECT_SCHEMA = T.StructType([
    T.StructField("station", T.StringType()), T.StructField("xml", T.StringType()), T.StructField("reject_reason", T.StringType()),
    T.StructField("source_id", T.StringType()), T.StructField("batch_id", T.LongType())])


def payload_stream(spark: SparkSession, path: str, fmt: str = "json", max_per_trigger: int | None = None) -> DataFrame:
    """A stream of payloads (station_id, xml) from files of a folder, ``max_per_trigger`` files a micro-batch."""
    reader = spark.readStream.format(fmt).schema(PAYLOAD_SCHEMA)
    if max_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_per_trigger))
    return reader.load(path)


def record_stream(payloads: DataFrame, catalog: DataFrame, ingestion_time=None, latest_only: bool = True) -> DataFrame:
    """Named records of a payload stream. ``ingestion_time`` defaults to the time of the micro-batch."""
    at = F.current_timestamp().cast("timestamp_ntz") if ingestion_time is None else ingestion_time
    return producer_records(decode_payloads(payloads, latest_only=latest_only), catalog, at)


def message_stream(payloads: DataFrame, catalog: DataFrame, ingestion_time=None, latest_only: bool = True) -> DataFrame:
    """The keyed messages of a payload stream, for any streaming sink."""
    return encode_messages(record_stream(payloads, catalog, ingestion_time, latest_only))


def land_payload_batch(batch: DataFrame, batch_id: int, catalog: DataFrame, raw_path: str, rejects_path: str,
                       ingestion_time=None, latest_only: bool = True, source_id: str = "payloads") -> None:
    """Decode one micro-batch once; its records go to the raw table, its rejects to the quarantine."""
    at = F.current_timestamp().cast("timestamp_ntz") if ingestion_time is None else ingestion_time
    lines = decoded_and_rejected(batch, latest_only=latest_only).persist()
    try:
        rows = producer_records(lines.where("reject_reason IS NULL").drop("reject_reason", "xml", "station"), catalog, at)
        bad = lines.where("reject_reason IS NOT NULL").select("station", "xml", "reject_reason")
        with ThreadPoolExecutor(max_workers=2) as pool:  # both read the persisted lines
            for job in [pool.submit(append_batch, rows, raw_path, batch_id, "timestamp", source_id),
                        pool.submit(append_batch, bad, rejects_path, batch_id, None, source_id)]:
                job.result()
    finally:
        lines.unpersist()


def land_payloads(payloads: DataFrame, catalog: DataFrame, raw_path: str, rejects_path: str, checkpoint: str,
                  ingestion_time=None, latest_only: bool = True, trigger: str | None = "availableNow") -> StreamingQuery:
    """Poll → raw table without a message queue between: each micro-batch replaces its own partitions, so a
    replay lands every record once."""
    writer = payloads.writeStream.option("checkpointLocation", checkpoint).foreachBatch(
        lambda df, n: land_payload_batch(df, n, catalog, raw_path, rejects_path, ingestion_time, latest_only, _query_id(df)))
    return _trigger(writer, trigger).start()
