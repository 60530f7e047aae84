"""Stream landing.

``land_stream`` is the consumer: a micro-batch per trigger (``maxOffsetsPerTrigger`` /
``maxFilesPerTrigger`` bound its size), each batch parsed once, appended to the raw table and its
rejects to the quarantine, both keyed by the query's id and the batch id so a replay is idempotent.
Progress lives in the checkpoint, so a restarted query resumes where the last committed batch
ended (at-least-once delivery, exactly-once tables).

De-duplication and the hourly pick keep *winners*: each batch is reduced to its own winners before
it is appended, a day's batches are merged by levels as they come, and readers reduce the stored winners
once more, of the days they ask for. So a row that comes hours late
still changes its closed hour, the newest hours are there after every batch, and no state grows with
the stream; a watermark would drop the one and hold back the other.
"""

from __future__ import annotations

import logging
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from stationlake.operators.cleanse import check_messages, cleanse, split_checked
from stationlake.operators.curate import flag_quality, hourly_latest
from stationlake.schemas import RAW_COLUMNS
from stationlake.sources.messages import decode_messages
from stationlake.sources.outbox import record, unseen
from stationlake.sources.tables import DEFAULT_SOURCE, FAN_IN, RAW_TABLE_SCHEMA, append_batch, merge_levels, read_days, read_table
from stationlake.sources.versions import ConcurrentCommit

log = logging.getLogger(__name__)


def _trigger(writer, trigger: str | None):
    if trigger in (None, "availableNow"):
        return writer.trigger(availableNow=True)
    if trigger == "once":
        return writer.trigger(once=True)
    return writer.trigger(processingTime=trigger)


def _query_id(batch: DataFrame) -> str:
    """The id of the streaming query that runs this batch: kept in its checkpoint, so the same after a
    restart and another for another checkpoint."""
    return batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId") or DEFAULT_SOURCE


def land_batch(batch: DataFrame, batch_id: int, raw_path: str, quarantine_path: str,
               keep_extra: bool = True, source_id: str = DEFAULT_SOURCE, ledger: str | None = None) -> dict[str, int]:
    """Decode and cleanse one micro-batch; write accepted rows and rejects for this source and batch id.
    With a ``ledger`` (``outbox``) messages whose id another micro-batch landed are left out.

    Returns (and logs) the accepted and rejected counts, observed while the two writes run (P9)
    rather than by extra counting jobs.
    """
    known = ledger is not None and "message_id" in batch.columns
    fresh = unseen(batch, ledger, source_id, batch_id).persist() if known else batch
    checked = check_messages(decode_messages(fresh), keep_extra).persist()
    try:
        if checked.isEmpty():  # nothing arrived (reads from the cache being built)
            return {"batch_id": batch_id, "accepted": 0, "rejected": 0}
        accepted, rejected = split_checked(checked, keep_extra)
        seen_ok, seen_bad = Observation(f"accepted_{batch_id}"), Observation(f"rejected_{batch_id}")
        # Both writes read the persisted batch, so they run as two concurrent jobs.
        with ThreadPoolExecutor(max_workers=2) as pool:
            jobs = [pool.submit(append_batch, accepted.observe(seen_ok, F.count(F.lit(1)).alias("n")), raw_path,
                                batch_id, "timestamp", source_id),
                    pool.submit(append_batch, rejected.observe(seen_bad, F.count(F.lit(1)).alias("n")),
                                quarantine_path, batch_id, None, source_id)]
            for j in jobs:
                j.result()
        if known:  # after the rows: a try that dies before this is replayed, and its rows replaced
            record(fresh, ledger, source_id, batch_id)
        counts = {"batch_id": batch_id, "accepted": seen_ok.get["n"], "rejected": seen_bad.get["n"]}
        if counts["rejected"]:
            log.warning("batch %s: %s of %s messages quarantined", batch_id, counts["rejected"],
                        counts["accepted"] + counts["rejected"])
        return counts
    finally:
        checked.unpersist()
        if known:
            fresh.unpersist()


def land_stream(messages: DataFrame, raw_path: str, quarantine_path: str, checkpoint: str,
                trigger: str | None = "availableNow", name: str | None = None,
                keep_extra: bool = True, ledger: str | None = None) -> StreamingQuery:
    """Start the landing query over a (``key``, ``value``) stream, with a ``ledger`` of message ids if they carry any."""
    writer = (messages.writeStream.option("checkpointLocation", checkpoint)
              .foreachBatch(lambda df, bid: land_batch(df, bid, raw_path, quarantine_path, keep_extra, _query_id(df), ledger)))
    if name:
        writer = writer.queryName(name)
    return _trigger(writer, trigger).start()


def cleansed_stream(messages: DataFrame) -> DataFrame:
    """Stateless decode + cleanse on a message stream (accepted rows only)."""
    accepted, _ = cleanse(decode_messages(messages))
    return accepted


def first_deliveries(obs: DataFrame) -> DataFrame:
    """One row per observation (station, event time): re-polled and re-delivered copies collapse to the
    earliest-ingested copy (T5). The order covers every column, so equal winners are identical rows."""
    order = ["ingestion_time", *[c for c in RAW_COLUMNS if c not in ("ingestion_time", "station_id", "timestamp")]]
    w = Window.partitionBy("station_id", "timestamp").orderBy(*order)
    return obs.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def keep_winners(obs: DataFrame, rule: Callable[[DataFrame], DataFrame], path: str, checkpoint: str,
                 trigger: str | None = "availableNow", fan_in: int = FAN_IN) -> StreamingQuery:
    """Append each micro-batch's winners under ``rule`` (``first_deliveries`` for T5, ``hourly_latest`` for
    T7) to the table at ``path``, keyed by query and batch id, and merge the days it touched by levels.

    A day so keeps fewer than ``fan_in`` folders a level however many batches it has. Merging is upkeep: if
    another query commits a version first, it is left to the next batch.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        source = _query_id(batch)
        seen = Observation(f"days_{batch_id}")
        winners = rule(batch.select(*RAW_COLUMNS))
        # one value per day in the batch
        days = F.collect_set(F.date_format("timestamp", "yyyy-MM-dd")).alias("days")
        append_batch(winners.observe(seen, days, F.count(F.lit(1)).alias("n")), path, batch_id, "timestamp", source)
        touched = [d for d in (seen.get.get("days") or []) if d]
        try:
            merge_levels(batch.sparkSession, path, sorted(touched), rule, source, fan_in)
        except ConcurrentCommit as e:
            log.warning("batch %s: %s; merging later", batch_id, e)

    writer = obs.writeStream.option("checkpointLocation", checkpoint).foreachBatch(write)
    return _trigger(writer, trigger).start()


def read_winners(spark: SparkSession, path: str, rule: Callable[[DataFrame], DataFrame], days: list | None = None) -> DataFrame:
    """The winners over all batches, or over those of some ``days``: the winners among the stored winners. A rule's
    groups lie within a day, so each day stands by itself and only its folders are listed."""
    stored = read_table(spark, path, RAW_TABLE_SCHEMA) if days is None else read_days(spark, path, days, RAW_TABLE_SCHEMA)
    return rule(stored.select(*RAW_COLUMNS))


def curated_observations(spark: SparkSession, path: str, day=None) -> DataFrame:
    """The daily observations (of one ``day``) of a stream kept under ``hourly_latest`` (C5 = T7 + T8): flagged and scored."""
    winners = read_winners(spark, path, hourly_latest, None if day is None else [day])
    return flag_quality(winners).withColumn("observation_date", F.to_date("timestamp"))


def flagged_stream(obs: DataFrame) -> DataFrame:
    """Quality flags and completeness applied on the stream (T8), stateless."""
    return flag_quality(obs)


def run_to_table(stream: DataFrame, path: str, checkpoint: str, output_mode: str = "append",
                 trigger: str | None = "availableNow", partition_by: list[str] | None = None) -> StreamingQuery:
    """Run a streaming DataFrame into a parquet table (file sink: exactly-once via its log)."""
    writer = (stream.writeStream.format("parquet").option("path", path)
              .option("checkpointLocation", checkpoint).outputMode(output_mode))
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    return _trigger(writer, trigger).start()


def main(argv: list[str] | None = None) -> None:
    """``python -m stationlake.streaming.landing --root PATH --kafka HOST:PORT --topic T`` (or
    ``--files DIR``): run the consumer until stopped (or once over what is there, ``--drain``)."""
    import argparse

    from stationlake.plans.daily_job import Layout
    from stationlake.session import get_session
    from stationlake.sources.messages import value_stream

    ap = argparse.ArgumentParser(description="Land a message stream into the raw table and quarantine.")
    ap.add_argument("--root", required=True)
    src = ap.add_mutually_exclusive_group(required=True)
    src.add_argument("--kafka", help="bootstrap servers")
    src.add_argument("--files", help="folder of newline-delimited JSON messages")
    src.add_argument("--keyed-files", help="folder of keyed messages as write_messages leaves them")
    ap.add_argument("--topic", default="observations")
    ap.add_argument("--max-per-trigger", type=int, default=None)
    ap.add_argument("--trigger", default="1 minute", help="processing-time interval")
    ap.add_argument("--drain", action="store_true", help="process what is available, then stop")
    ap.add_argument("--drop-extra", action="store_true", help="leave out unknown message fields (kept in extra_fields)")
    ap.add_argument("--message-ids", action="store_true", help="land each message id once (messages published through an outbox)")
    a = ap.parse_args(argv)
    spark = get_session()
    lay = Layout(a.root)
    stream = (value_stream(spark, "kafka", a.kafka, topic=a.topic, max_per_trigger=a.max_per_trigger, message_ids=a.message_ids) if a.kafka
              else value_stream(spark, "text" if a.files else "json", a.files or a.keyed_files,
                                max_per_trigger=a.max_per_trigger, message_ids=a.message_ids and not a.files))
    q = land_stream(stream, lay.raw, lay.quarantine, lay.path("_checkpoints/landing"),
                    trigger="availableNow" if a.drain else a.trigger, name="landing", keep_extra=not a.drop_extra,
                    ledger=lay.path("_ledger") if a.message_ids else None)
    q.awaitTermination()


if __name__ == "__main__":
    main()
