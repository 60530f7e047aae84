"""Registered streaming queries: each runs a stream to completion (``availableNow``, several batches)
over message files derived from the driver tables, in a fresh folder under the shared checkpoint
root, and returns a batch read of what the stream wrote."""

from __future__ import annotations

import contextlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stationlake.operators.cleanse import reject_counts
from stationlake.operators.curate import hourly_latest
from stationlake.operators.lookup import producer_records
from stationlake.schemas import DAILY_COLUMNS, RAW_COLUMNS
from stationlake.session import shared_dir
from stationlake.sources import catalog as cat
from stationlake.sources import fields, outbox
from stationlake.sources.fixtures import FEED_FILES, messages_from_events, payloads_from_events, read_source
from stationlake.sources.messages import encode_messages, value_stream, write_messages
from stationlake.sources.payload import decode_payloads
from stationlake.sources.tables import QUARANTINE_SCHEMA, read_raw, read_table, stage
from stationlake.streaming import landing, monitor
from stationlake.streaming import payloads as payload_streams

FILES_PER_TRIGGER = 2  # several micro-batches whatever the number of files
POLL_TIME = "2024-02-01 00:00:00"


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events, dealt evenly over the tasks: each becomes messages or a document of many times its size, so the
    splits of the small event files would be a few long tasks."""
    return read_source(spark, sf_dir, "events").repartition(int(spark.conf.get("spark.sql.shuffle.partitions")))


def _message_files(spark: SparkSession, sf_dir: str, root: str) -> str:
    path = f"{root}/messages"
    # A live feed comes in the order of arrival: each file holds one stretch of it.
    messages_from_events(_events(spark, sf_dir), arrival_ordered=True).select("value").write.text(path)
    return path


def _await(query) -> None:
    query.awaitTermination()
    if query.exception():
        raise RuntimeError(str(query.exception()))


def _land(spark: SparkSession, sf_dir: str) -> str:
    root = shared_dir(spark, "landing")
    src = _message_files(spark, sf_dir, root)
    _await(landing.land_stream(value_stream(spark, "text", src, max_per_trigger=FILES_PER_TRIGGER),
                               f"{root}/raw", f"{root}/quarantine", f"{root}/_checkpoint"))
    return root


def q_stream_landed_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_raw(spark, f"{_land(spark, sf_dir)}/raw").select(*RAW_COLUMNS)


def q_stream_extra_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unknown message fields, kept in the raw table."""
    raw = read_raw(spark, f"{_land(spark, sf_dir)}/raw").where("extra_fields IS NOT NULL")
    return raw.select("station_id", "timestamp", "ingestion_time", F.explode("extra_fields").alias("field", "text"))


def q_stream_typed_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The unknown field as a number column beside the known ones, null in the rows without it."""
    raw = f"{_land(spark, sf_dir)}/raw"
    fields.promote_fields(spark, raw)
    return fields.read_typed(spark, raw).select("station_id", "timestamp", "ingestion_time", "extra_field")


def q_stream_failed_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landing whose second batch fails after writing its rows and whose third fails before: what the listener saw,
    and the rows that are there."""
    root = shared_dir(spark, "failing")
    src = _message_files(spark, sf_dir, root)
    seen = monitor.RunLog()
    write = monitor.failing_once(lambda df, n: landing.land_batch(df, n, f"{root}/raw", f"{root}/quarantine", source_id="feed"), [1])
    write = monitor.failing_once(write, [2], after=False)

    def start():
        stream = value_stream(spark, "text", src, max_per_trigger=FILES_PER_TRIGGER)
        return stream.writeStream.option("checkpointLocation", f"{root}/_checkpoint").trigger(availableNow=True).foreachBatch(write).start()

    spark.streams.addListener(seen)
    try:
        failures = monitor.supervise(start, attempts=5, wait_seconds=0, run_log=seen)
    finally:
        spark.streams.removeListener(seen)
    seen.flush(spark, f"{root}/log")
    events = spark.read.schema(monitor.LOG_SCHEMA).parquet(f"{root}/log")
    count = lambda what, n: spark.range(1).select(F.lit(what).alias("what"), F.lit(n).cast("long").alias("n"))
    done = events.where("event = 'progress' AND input_rows > 0")
    out = count("failures", failures)
    out = out.union(events.where("error IS NOT NULL").agg(F.lit("ended with an error"), F.count("*")))
    out = out.union(events.where("event = 'started'").agg(F.lit("runs"), F.count("*")))
    out = out.union(done.agg(F.lit("batches committed more than once"), F.count("*") - F.count_distinct("batch_id")))
    out = out.union(done.agg(F.lit("input rows of the batches"), F.sum("input_rows")))
    return out.union(read_raw(spark, f"{root}/raw").agg(F.lit("rows landed"), F.count("*")))


def q_stream_quarantine_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reject_counts(read_table(spark, f"{_land(spark, sf_dir)}/quarantine", QUARANTINE_SCHEMA))


def q_stream_two_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two queries with checkpoints of their own land the two halves of the feed in one raw table."""
    root = shared_dir(spark, "two-sources")
    msgs = messages_from_events(_events(spark, sf_dir)).select("value", F.pmod(F.xxhash64("value"), F.lit(2)).alias("half"))
    # made once for both, in a fixed number of files: more events are longer files, not more micro-batches
    msgs.repartition(FEED_FILES).write.partitionBy("half").text(f"{root}/messages")
    for n in (0, 1):
        _await(landing.land_stream(value_stream(spark, "text", f"{root}/messages/half={n}", max_per_trigger=FILES_PER_TRIGGER),
                                   f"{root}/raw", f"{root}/quarantine", f"{root}/_checkpoint{n}"))
    return read_raw(spark, f"{root}/raw").select(*RAW_COLUMNS)


def _messages_of_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = cat.lookup_catalog(cat.catalog_from_tables(read_source(spark, sf_dir, "supplier"), read_source(spark, sf_dir, "nation")))
    latest = decode_payloads(payloads_from_events(_events(spark, sf_dir)), latest_only=True)
    return encode_messages(producer_records(latest, names, POLL_TIME))


def q_producer_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The producer's keyed messages: the key and what its value says."""
    return _message_fields(_messages_of_payloads(spark, sf_dir))


def _message_fields(msgs: DataFrame) -> DataFrame:
    field = lambda f: F.get_json_object("value", f"$.{f}")
    return msgs.select("key", field("fmisid").alias("fmisid"), field("timestamp").alias("timestamp_text"),
                       field("ingestion_time").alias("ingestion_text"), field("location").alias("location"))


def q_payload_landed_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payloads → records → keyed messages → stream → raw table."""
    root = shared_dir(spark, "payload-landing")
    write_messages(_messages_of_payloads(spark, sf_dir).repartition(FEED_FILES), "json", f"{root}/messages")
    _await(landing.land_stream(value_stream(spark, "json", f"{root}/messages", max_per_trigger=FILES_PER_TRIGGER),
                               f"{root}/raw", f"{root}/quarantine", f"{root}/_checkpoint"))
    return read_raw(spark, f"{root}/raw").select(*RAW_COLUMNS)


def q_publish_landed_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages in two batches published through the outbox, each sent, stopped before it was marked, and sent again;
    landed with a ledger over several micro-batches: every message once."""
    root = shared_dir(spark, "publish")
    msgs = stage(_messages_of_payloads(spark, sf_dir), f"{root}/polled")  # decoded once for both batches

    def stop(at: str) -> None:
        if at == "sent":
            raise InterruptedError(at)

    for n in (0, 1):
        half = msgs.where(F.pmod(F.xxhash64("value"), F.lit(2)) == n)
        for step in (stop, lambda at: None, stop):  # killed, run again, and once more when all is done
            with contextlib.suppress(InterruptedError):
                outbox.publish(half, "json", f"{root}/messages", f"{root}/outbox", "poller", n, step=step, files=FEED_FILES)
    stream = value_stream(spark, "json", f"{root}/messages", max_per_trigger=FILES_PER_TRIGGER, message_ids=True)
    _await(landing.land_stream(stream, f"{root}/raw", f"{root}/quarantine", f"{root}/_checkpoint", ledger=f"{root}/ledger"))
    return read_raw(spark, f"{root}/raw").select(*RAW_COLUMNS)


def _payload_files(spark: SparkSession, sf_dir: str, root: str) -> str:
    payloads_from_events(_events(spark, sf_dir)).repartition(3 * FILES_PER_TRIGGER).write.json(f"{root}/payloads")
    return f"{root}/payloads"


def _landed_payloads(spark: SparkSession, sf_dir: str, name: str, latest_only: bool) -> str:
    root = shared_dir(spark, name)
    stream = payload_streams.payload_stream(spark, _payload_files(spark, sf_dir, root), max_per_trigger=FILES_PER_TRIGGER)
    names = cat.lookup_catalog(cat.catalog_from_tables(read_source(spark, sf_dir, "supplier"), read_source(spark, sf_dir, "nation")))
    _await(payload_streams.land_payloads(stream, names, f"{root}/raw", f"{root}/rejects", f"{root}/_checkpoint", POLL_TIME, latest_only))
    return root


def q_stream_payload_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payload files → decoded rows as a stream, over several triggers."""
    root = shared_dir(spark, "payload-rows")
    stream = payload_streams.payload_stream(spark, _payload_files(spark, sf_dir, root), max_per_trigger=FILES_PER_TRIGGER)
    rows = decode_payloads(stream)
    _await(landing.run_to_table(rows, f"{root}/out", f"{root}/_checkpoint"))
    return spark.read.schema(rows.schema).parquet(f"{root}/out")


def q_stream_payload_landed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payload files → named records in the raw table, the catalogue joined to the stream."""
    return read_raw(spark, f"{_landed_payloads(spark, sf_dir, 'payload-landed', True)}/raw").select(*RAW_COLUMNS)


def q_stream_payload_reject_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The payloads and lines that the stream quarantined."""
    root = _landed_payloads(spark, sf_dir, "payload-rejects", False)
    return read_table(spark, f"{root}/rejects", payload_streams.REJECT_SCHEMA).groupBy("reject_reason").agg(F.count("*").alias("rejected"))


def q_stream_payload_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payload files → keyed messages as a stream, written by the file sink."""
    root = shared_dir(spark, "payload-messages")
    stream = payload_streams.payload_stream(spark, _payload_files(spark, sf_dir, root), max_per_trigger=FILES_PER_TRIGGER)
    names = cat.lookup_catalog(cat.catalog_from_tables(read_source(spark, sf_dir, "supplier"), read_source(spark, sf_dir, "nation")))
    msgs = payload_streams.message_stream(stream, names, POLL_TIME)
    _await(landing.run_to_table(msgs, f"{root}/out", f"{root}/_checkpoint"))
    return _message_fields(spark.read.schema(msgs.schema).parquet(f"{root}/out"))


def _winners(spark: SparkSession, sf_dir: str, name: str, rule) -> str:
    root = shared_dir(spark, name)
    src = _message_files(spark, sf_dir, root)
    stream = landing.cleansed_stream(value_stream(spark, "text", src, max_per_trigger=FILES_PER_TRIGGER))
    # a fan-in of two: a few batches already fill several levels
    _await(landing.keep_winners(stream, rule, f"{root}/out", f"{root}/_checkpoint", fan_in=2))
    return f"{root}/out"


def q_stream_hourly_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return landing.read_winners(spark, _winners(spark, sf_dir, "hourly", hourly_latest), hourly_latest)


def q_stream_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rule = landing.first_deliveries
    return landing.read_winners(spark, _winners(spark, sf_dir, "dedup", rule), rule)


def q_stream_curated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return landing.curated_observations(spark, _winners(spark, sf_dir, "curated", hourly_latest)).select(*DAILY_COLUMNS)


def q_stream_curated_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One day of the stream's curated rows: only that day's merged folders are read."""
    return landing.curated_observations(spark, _winners(spark, sf_dir, "curated-day", hourly_latest), "2024-01-15").select(*DAILY_COLUMNS)


def q_stream_quality_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = shared_dir(spark, "flags")
    src = _message_files(spark, sf_dir, root)
    stream = landing.flagged_stream(landing.cleansed_stream(
        value_stream(spark, "text", src, max_per_trigger=FILES_PER_TRIGGER)))
    _await(landing.run_to_table(stream, f"{root}/out", f"{root}/_checkpoint"))
    return spark.read.schema(stream.schema).parquet(f"{root}/out").select(
        "station_id", "timestamp", "ingestion_time", "temperature_quality", "humidity_quality",
        "wind_speed_quality", "pressure_quality", "data_completeness_score")


STREAM_QUERIES = {
    "stream_landed_rows": q_stream_landed_rows,
    "stream_extra_fields": q_stream_extra_fields,
    "stream_typed_fields": q_stream_typed_fields,
    "stream_failed_batches": q_stream_failed_batches,
    "stream_quarantine_counts": q_stream_quarantine_counts,
    "stream_two_sources": q_stream_two_sources,
    "stream_hourly_latest": q_stream_hourly_latest,
    "stream_dedup": q_stream_dedup,
    "stream_quality_flags": q_stream_quality_flags,
    "stream_curated": q_stream_curated,
    "stream_curated_day": q_stream_curated_day,
    "producer_messages": q_producer_messages,
    "payload_landed_rows": q_payload_landed_rows,
    "publish_landed_once": q_publish_landed_once,
    "stream_payload_rows": q_stream_payload_rows,
    "stream_payload_landed": q_stream_payload_landed,
    "stream_payload_reject_counts": q_stream_payload_reject_counts,
    "stream_payload_messages": q_stream_payload_messages,
}
