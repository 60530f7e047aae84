"""Cleansing of decoded messages into raw observations, with a quarantine for the rest.

The checks run in the reference's order; the first failing one names the reject reason:

* ``malformed_json``        value is not a JSON object (or is null)
* ``missing_required``      timestamp or station id is null/absent
* ``blank_timestamp``       timestamp is blank
* ``blank_ingestion_time``  ingestion time is blank
* ``bad_timestamp``         timestamp does not parse
* ``bad_ingestion_time``    ingestion time is absent or does not parse
* ``bad_station_id``        station id is not an integer

A bad measure never rejects a row: it becomes null, as does the NaN token.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationlake.functions import num_or_null, parse_timestamp, strip_ws, to_id
from stationlake.schemas import MESSAGE_FIELDS, NUMERIC_FIELDS, RAW_COLUMNS

REJECT_REASONS = ["malformed_json", "missing_required", "blank_timestamp", "blank_ingestion_time",
                  "bad_timestamp", "bad_ingestion_time", "bad_station_id"]
QUARANTINE_COLUMNS = ["key", "value", "reject_reason"]


def _checked(decoded: DataFrame) -> DataFrame:
    ts_text, id_text, ing_text = F.col("timestamp"), F.col("fmisid"), F.col("ingestion_time")
    ts, ing, sid = parse_timestamp(ts_text), parse_timestamp(ing_text), to_id(id_text)
    reason = (
        F.when(F.col("value").isNull() | F.col("_corrupt_record").isNotNull(), F.lit("malformed_json"))
        .when(ts_text.isNull() | id_text.isNull(), F.lit("missing_required"))
        .when(strip_ws(ts_text) == "", F.lit("blank_timestamp"))
        .when(strip_ws(ing_text) == "", F.lit("blank_ingestion_time"))
        .when(ts.isNull(), F.lit("bad_timestamp"))
        .when(ing.isNull(), F.lit("bad_ingestion_time"))
        .when(sid.isNull(), F.lit("bad_station_id"))
    )
    typed = {c: num_or_null(c).alias(c) for c in NUMERIC_FIELDS}
    return decoded.select(
        "key", "value", reason.alias("reject_reason"),
        ts.alias("timestamp"), sid.alias("station_id"), F.col("location").cast("string").alias("location"),
        *typed.values(), ing.alias("ingestion_time"))


def extra_fields(value: str = "value") -> F.Column:
    """Fields of a message value outside the known set, as a text map (nested values as JSON).

    The reference lets a load add new columns to the raw table; here unknown fields land in one
    map column (null if there are none), so the table schema stays fixed while nothing sent is lost.
    """
    known = F.array(*[F.lit(f) for f in MESSAGE_FIELDS])
    allf = F.from_json(F.col(value), "map<string,string>", {"mode": "PERMISSIVE"})
    extra = F.map_filter(allf, lambda k, v: ~F.array_contains(known, k))
    return F.when(F.size(extra) > 0, extra)


def extra_values(value: str = "value") -> F.Column:
    """The same fields with their values as the message typed them, as VARIANT (``sources.fields`` makes columns of them)."""
    known = F.array(*[F.lit(f) for f in MESSAGE_FIELDS])
    return F.map_filter(F.from_json(F.col(value), "map<string,variant>"), lambda k, v: ~F.array_contains(known, k))


def cleanse(decoded: DataFrame, keep_extra: bool = True) -> tuple[DataFrame, DataFrame]:
    """(accepted raw observations, quarantined messages with ``reject_reason``).

    Both come from one projection that decodes each message once; persist ``check_messages`` (as the
    landing job does per micro-batch) when both are written, so every message is parsed once.
    Unknown fields are kept in ``extra_fields`` unless ``keep_extra`` is off.
    """
    return split_checked(check_messages(decoded, keep_extra), keep_extra)


def check_messages(decoded: DataFrame, keep_extra: bool = True) -> DataFrame:
    """Typed columns and ``reject_reason`` of every decoded message."""
    checked = _checked(decoded)
    if not keep_extra:
        return checked
    # parsed again only where there are such fields
    checked = checked.withColumn("extra_fields", extra_fields())
    return checked.withColumn("extra_values", F.when(F.col("extra_fields").isNotNull(), extra_values()))


def split_checked(checked: DataFrame, keep_extra: bool = True) -> tuple[DataFrame, DataFrame]:
    cols = [*RAW_COLUMNS, "extra_fields", "extra_values"] if keep_extra else RAW_COLUMNS
    return _keep(checked, cols, accepted=True), _keep(checked, QUARANTINE_COLUMNS, accepted=False)


def _keep(checked: DataFrame, cols: list[str], accepted: bool) -> DataFrame:
    """Rows of one outcome, as a zero-or-one-row ``inline`` (a flatMap) rather than a filter.

    A filter on ``reject_reason`` would be pushed below the projection that computes it, copying
    the JSON decode and every parse into the predicate (and, for a derived input, whatever built
    the message text). A generator is not crossed by predicate pushdown, so each message is
    parsed exactly once.
    """
    bad = F.col("reject_reason").isNotNull()
    row = F.array(F.struct(*[F.col(c) for c in cols]))
    return checked.select(F.inline(F.when(~bad if accepted else bad, row)))


def reject_counts(rejected: DataFrame) -> DataFrame:
    """Rejected-message count per reason."""
    return rejected.groupBy("reject_reason").agg(F.count(F.lit(1)).alias("rejected"))
