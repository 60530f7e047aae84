"""Observation fixtures derived in Spark from the driver's ``events`` table.

The mapping follows FIXTURES.md §3: each event becomes one station observation with rule-made
nulls and outliers, and some events are re-polled (same observation, later ingestion time) or
delivered twice. Re-polls are produced by exploding a per-row array of ingestion delays, so the
events table is scanned once (a UNION ALL of three filtered copies would scan it three times).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stationlake.functions import utc_wall_time
from stationlake.schemas import MEASURES, PAYLOAD_POSITIONS, RAW_COLUMNS


def read_source(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver's source tables (``<sf_dir>/<name>.parquet``)."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def event_key() -> F.Column:
    """The integer ``k`` carried in ``events.props``."""
    return F.get_json_object("props", "$.k").try_cast("int")


def observation_base(events: DataFrame) -> DataFrame:
    """One observation per event (before re-polls), keeping ``k`` for the derived fixtures."""
    k = F.col("k")
    value = F.col("value")
    et = F.col("event_type")
    null = F.lit(None).cast("double")
    return events.select(
        F.col("user_id").alias("station_id"), utc_wall_time(events, "ts").alias("timestamp"), event_key().alias("k"),
        "event_type", "value",
    ).select(
        "station_id", "timestamp", "k",
        F.concat(F.lit("Station "), F.col("station_id").cast("string")).alias("location"),
        (F.lit(60.0) + F.col("station_id") % 10).alias("latitude"),
        (F.lit(20.0) + F.col("station_id") % 11).alias("longitude"),
        F.when(k % 10 == 0, null).when(k == 51, F.lit(-60.0)).otherwise(value / 4 - 30).alias("temperature"),
        F.when(k % 7 == 0, null).otherwise(k * F.lit(1.1) - 3).alias("humidity"),
        F.when(et == "signup", null).when(k == 33, F.lit(-1.0)).otherwise(value / 6).alias("wind_speed"),
        (k * F.lit(3.6)).alias("wind_direction"),
        F.when(et == "error", null).otherwise(F.lit(880.0) + k * F.lit(2.4)).alias("pressure"),
        F.when(et == "view", value / 100).alias("precipitation"),
        (k % 9).cast("double").alias("cloud_cover"),
        (F.lit(500.0) * k).alias("visibility"),
    )


def observations_from_events(events: DataFrame, keep_key: bool = False) -> DataFrame:
    """Raw observations (the 14 raw columns) with re-polls and duplicate deliveries."""
    k = F.col("k")
    none = F.array().cast("array<int>")
    delays = F.concat(
        F.array(F.lit(1)),
        F.when(k % 5 == 0, F.array(F.lit(11))).otherwise(none),
        F.when(k % 13 == 0, F.array(F.lit(1))).otherwise(none),
    )
    base = observation_base(events)
    out = base.select("*", F.explode(delays).alias("_delay_min")).withColumn(
        "ingestion_time", F.timestamp_add("MINUTE", F.col("_delay_min"), F.col("timestamp")))
    cols = [*RAW_COLUMNS, "k"] if keep_key else RAW_COLUMNS
    return out.select(*cols)


def raw_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return observations_from_events(read_source(spark, sf_dir, "events"))


# ---- derived message and payload fixtures ---------------------------------------------------
# Defects are assigned by the event key k (0..99), one kind per value of k:
#   k=7 null timestamp, k=17 blank timestamp, k=27 unparsable timestamp, k=37 non-numeric id,
#   k=47 no ingestion time, k=57 truncated JSON, k=61 text after the object, k=62 two objects,
#   k=63 id one above the largest, k=64 blank ingestion time                 -> rejected
#   k=67 non-numeric temperature (-> null), k=77 timestamp without fraction,
#   k=87 unknown extra field, k=97 id sent as text                           -> kept
# In an arrival-ordered feed, k=71 comes LATE_HOURS after its time.
# Payloads: k=3 no values element, k=4 truncated XML, k=11 a value line too few (rejected);
#   k=9 blank second value line, k=12 last epoch no timestamp (that line rejected); k=8 value lines of
#   5 tokens, k=13 commented-out positions, k=14 other prefixes, k=15 character references,
#   k=16 a second prefix of the namespace, k=18 a default namespace beside the prefix, k=19 the prefix bound
#   to another namespace in an element before (read).
LATE_KEY, LATE_HOURS = 71, 5
FEED_FILES = 8


def messages_from_events(events: DataFrame, arrival_ordered: bool = False) -> DataFrame:
    """Keyed JSON messages for every raw observation (re-polls included), with the defects above.

    ``arrival_ordered`` range-partitions the messages by arrival first, so files written from them
    are in the order of a live feed (each file covers one stretch of time).
    """
    from stationlake.sources.messages import iso, message_struct

    obs = observations_from_events(events, keep_key=True)
    k = F.col("k")
    if arrival_ordered:
        arrival = F.timestamp_add("HOUR", F.when(k == LATE_KEY, LATE_HOURS).otherwise(0), F.col("timestamp"))
        obs = obs.repartitionByRange(FEED_FILES, arrival, "station_id")  # a fixed number, or small feeds become one file
    ts_text = (F.when(k == 7, F.lit(None).cast("string")).when(k == 17, F.lit("  "))
               .when(k == 27, F.lit("not-a-time"))
               .when(k == 77, F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss"))
               .otherwise(iso(F.col("timestamp"))))
    fields = message_struct(ts_text)
    v = F.col("v_json")
    v = (F.when(k == 37, F.regexp_replace(v, r'"fmisid":-?[0-9]+', '"fmisid":"abc"'))
         .when(k == 97, F.regexp_replace(v, r'"fmisid":(-?[0-9]+)', '"fmisid":"$1"'))
         .when(k == 67, F.regexp_replace(v, r'"temperature":[^,]*', '"temperature":"warm"'))
         .when(k == 63, F.regexp_replace(v, r'"fmisid":-?[0-9]+', '"fmisid":9223372036854775808'))
         .when(k == 64, F.regexp_replace(v, r'"ingestion_time":"[^"]*"', '"ingestion_time":"  "'))
         .when(k == 61, F.concat(v, F.lit(" xx"))).when(k == 62, F.concat(v, v))
         .when(k == 47, F.regexp_replace(v, r',"ingestion_time":"[^"]*"', ""))
         .when(k == 57, F.expr("substring(v_json, 1, length(v_json) - 7)"))
         .when(k == 87, F.concat(F.expr("substring(v_json, 1, length(v_json) - 1)"), F.lit(',"extra_field":1}')))
         .otherwise(v))
    return (obs.withColumn("v_json", F.to_json(F.struct(*fields), {"ignoreNullFields": "false"}))
            .select(F.col("station_id").cast("string").alias("key"), v.alias("value")))


_VALUES = r"(<gml:doubleOrNilReasonTupleList>\n)([^\n]*)\n([^\n]*)\n([^\n]*)(\n</gml:doubleOrNilReasonTupleList>)"


def payloads_from_events(events: DataFrame) -> DataFrame:
    """One payload per event: the observation and the two 10-minute polls before it (the overlap
    of the reference's 2-hour lookback), with the payload defects above."""
    from stationlake.sources.payload import encode_payload, epoch_seconds, value_tokens

    b = observation_base(events)
    k = F.col("k")
    e = epoch_seconds(F.col("timestamp"))
    toks = value_tokens([F.col(m) for m in MEASURES])
    toks = toks[:5] + [F.when(k == 8, F.lit(None).cast("string")).otherwise(t) for t in toks[5:]]
    lines = [(F.col("latitude"), F.col("longitude"), e - back, toks) for back in (1200, 600, 0)]
    doc = F.col("xml_doc")
    doc = (F.when(k == 3, F.regexp_replace(doc, r"<gml:doubleOrNilReasonTupleList>[\s\S]*</gml:doubleOrNilReasonTupleList>", ""))
           .when(k == 4, F.expr("substring(xml_doc, 1, length(xml_doc) - 40)"))
           .when(k == 9, F.regexp_replace(doc, _VALUES, "$1$2\n\n$4$5"))
           .when(k == 11, F.regexp_replace(doc, _VALUES, "$1$3\n$4$5"))
           # (the pattern has one group, so "$1" ends at the 1)
           .when(k == 12, F.regexp_replace(doc, r"(<gmlcov:positions>\n[^\n]*\n[^\n]*\n\S+ \S+ )\S+", "$199999999999999999"))
           .when(k == 13, F.replace(doc, F.lit("<gmlcov:positions>"), F.lit("<!-- <gmlcov:positions>1 2 3</gmlcov:positions> --><gmlcov:positions>")))
           .when(k == 14, F.replace(F.replace(F.replace(F.replace(doc, F.lit("gmlcov:"), F.lit("cov:")), F.lit("xmlns:gmlcov="), F.lit("xmlns:cov=")),
                                              F.lit("gml:"), F.lit("g:")), F.lit("xmlns:gml="), F.lit("xmlns:g=")))
           .when(k == 16, F.replace(F.replace(doc, F.lit("gmlcov:positions"), F.lit("two:positions")), F.lit(" xmlns:gml="),
                                    F.lit(f' xmlns:two="{PAYLOAD_POSITIONS[0]}" xmlns:gml=')))
           .when(k == 18, F.replace(F.replace(doc, F.lit("<gmlcov:positions>"), F.lit(f'<positions xmlns="{PAYLOAD_POSITIONS[0]}">')),
                                    F.lit("</gmlcov:positions>"), F.lit("</positions>")))
           .when(k == 19, F.replace(doc, F.lit("<gmlcov:positions>"), F.lit(
               '<gmlcov:positions xmlns:gmlcov="http://other.example/ns">1 2 3</gmlcov:positions><gmlcov:positions>')))
           .when(k == 15, F.regexp_replace(doc, r"(<gmlcov:positions>\n\S+) ", "$1&#32;"))
           .otherwise(doc))
    return (b.withColumn("xml_doc", encode_payload(lines))
            .select(F.col("station_id").cast("string").alias("station_id"), doc.alias("xml")))
