"""Keyed JSON messages: encode observations (S4), decode message values (S5, F26, F27), and
open a message stream from Kafka or from files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stationlake.functions import strip_ws
from stationlake.schemas import MEASURES, MESSAGE_STRING_SCHEMA

ISO_MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def iso(ts) -> F.Column:
    """TIMESTAMP_NTZ → ISO-8601 text with microseconds (zone-free)."""
    return F.date_format(ts, ISO_MICROS)


def message_struct(timestamp_text: F.Column | None = None) -> list:
    """Fields of one message, with the reference's wire names and types."""
    ts = iso(F.col("timestamp")) if timestamp_text is None else timestamp_text
    return [
        F.col("station_id").alias("fmisid"), "latitude", "longitude", ts.alias("timestamp"),
        *MEASURES, iso(F.col("ingestion_time")).alias("ingestion_time"), "location",
    ]


def encode_messages(obs: DataFrame) -> DataFrame:
    """``key`` = station id as text, ``value`` = JSON of the record (nulls written as null)."""
    return obs.select(
        F.col("station_id").cast("string").alias("key"),
        F.to_json(F.struct(*message_struct()), {"ignoreNullFields": "false"}).alias("value"))


def decode_messages(msgs: DataFrame, value: str = "value", key: str | None = "key") -> DataFrame:
    """Parse message values with an all-text schema (a typed schema would void a whole record
    for one field of an unexpected JSON type); what is not exactly one JSON object lands in
    ``_corrupt_record``.

    The parser stops after a first value and ignores what follows, so the text is wrapped, as the
    member of an object and as the element of an array: what is no single object spoils either.
    Binary key/value columns (Kafka) are decoded as UTF-8 first; a null key stays null.
    """
    cols = [F.col(value).cast("string").alias("value")]
    if key and key in msgs.columns:
        cols.insert(0, F.col(key).cast("string").alias("key"))
    else:
        cols.insert(0, F.lit(None).cast("string").alias("key"))
    wrapped = F.concat(F.lit('{"m":'), F.col("value"), F.lit(',"end":"1"}'))
    parsed = F.from_json(wrapped, T.StructType([T.StructField("m", MESSAGE_STRING_SCHEMA), T.StructField("end", T.StringType())]))
    elements = F.from_json(F.concat(F.lit("["), F.col("value"), F.lit("]")), "array<struct<fmisid:string>>")
    one_object = (F.col("p.end").isNotNull() & F.col("p.m").isNotNull() & (F.size(elements) == 1)
                  & strip_ws("value").startswith("{"))
    return (msgs.select(*cols).select("key", "value", parsed.alias("p"))
            .select("key", "value", "p.m.*", F.when(~F.coalesce(one_object, F.lit(False)), F.coalesce("value", F.lit("")))
                    .alias("_corrupt_record")))


def write_messages(msgs: DataFrame, fmt: str, target: str, topic: str | None = None, files: int | None = None) -> None:
    """Publish keyed messages (S4): ``fmt="kafka"`` to ``topic`` at the servers ``target``, ``fmt="json"`` as
    files of ``{"key": …, "value": …}`` lines in the folder ``target``, at most ``files`` of them: a stream that takes
    some files a trigger then needs no more micro-batches for more messages.

    Spark retries a failed task, so a message may be sent twice; a ``message_id`` column (``outbox``) goes with
    each message, as a header or a field, for the landing job to leave the second one out.
    """
    out = msgs.select(F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value"),
                      *[c for c in ("message_id",) if c in msgs.columns])
    if fmt == "kafka":
        if "message_id" in out.columns:
            header = F.struct(F.lit("message_id").alias("key"), F.col("message_id").cast("binary").alias("value"))
            out = out.select("key", "value", F.array(header).alias("headers"))
        out.write.format("kafka").option("kafka.bootstrap.servers", target).option("topic", topic).save()
    elif fmt == "json":
        (out.coalesce(files) if files else out).write.mode("append").json(target)
    else:
        raise ValueError(f"unknown message sink {fmt!r}")


def value_stream(spark: SparkSession, fmt: str, path_or_servers: str, topic: str | None = None,
                 max_per_trigger: int | None = None, starting: str = "earliest",
                 fail_on_data_loss: bool = True, message_ids: bool = False) -> DataFrame:
    """A streaming DataFrame with ``key`` and ``value`` columns.

    ``fmt="kafka"`` subscribes to ``topic`` from ``starting`` offsets, ``max_per_trigger`` capping
    records per micro-batch (the reference's batch of 100). Offsets that vanished before they
    were read (retention) stop the query unless ``fail_on_data_loss=False``: results stay whole
    or fail loudly. ``fmt="text"`` reads one message per line from files in a folder and ``fmt="json"``
    the keyed lines of ``write_messages``; ``max_per_trigger`` then caps files per micro-batch. With ``message_ids``
    messages from Kafka and keyed lines have a ``message_id`` too, null where they were sent without one.
    """
    reader = spark.readStream.format(fmt)
    if fmt == "kafka":
        reader = reader.option("kafka.bootstrap.servers", path_or_servers).option("subscribe", topic)
        reader = reader.option("startingOffsets", starting).option("failOnDataLoss", str(fail_on_data_loss).lower())
        if max_per_trigger:
            reader = reader.option("maxOffsetsPerTrigger", str(max_per_trigger))
        text = [F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value")]
        if message_ids:
            reader = reader.option("includeHeaders", "true")
            sent = F.get(F.filter("headers", lambda h: h["key"] == "message_id"), F.lit(0))["value"].cast("string")
            text.append(sent.alias("message_id"))
        return reader.load().select(*text)
    if max_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_per_trigger))
    if fmt == "json":
        return reader.schema("key string, value string" + ", message_id string" * message_ids).load(path_or_servers)
    return reader.load(path_or_servers).select(F.lit(None).cast("string").alias("key"), F.col("value"))
