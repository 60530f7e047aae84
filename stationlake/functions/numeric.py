"""Lenient parsing and engine-stable rounding."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


# Characters removed by ``strip_ws`` (Python's str.strip() set for ASCII text).
WHITESPACE = " \t\n\r\x0b\x0c"


def strip_ws(x) -> Column:
    """Remove leading/trailing whitespace of every kind (one-argument ``trim`` removes spaces only)."""
    return F.trim(_c(x).cast("string"), F.lit(WHITESPACE))


def round_stable(x, digits: int) -> Column:
    """Round half away from zero on the decimal value, then back to double.

    Rounding a double directly rounds its binary value in some engines and its decimal text in
    others; going through DECIMAL(38,10) first gives one answer everywhere. A value that does not
    fit (1e28 and more, infinities) has no fraction to round, so it is returned as it is.
    """
    x = _c(x)
    as_dec = x.try_cast("decimal(38,10)")
    return F.when(as_dec.isNull(), x).otherwise(F.round(as_dec, digits).cast("double"))


def num_or_null(x) -> Column:
    """Text or number → double; unparsable text and the NaN token become null (inf is kept)."""
    d = strip_ws(x).try_cast("double")
    return F.when(F.isnan(d), F.lit(None).cast("double")).otherwise(d)


def to_id(x) -> Column:
    """Station id → bigint: integer text, or a number with no fraction ("100971.0"); blank,
    fractional, non-numeric or too large ids become null (they are quarantined by the caller).

    Exact: the text goes through DECIMAL(38,18), which holds every bigint and its fraction."""
    number = strip_ws(x).try_cast("decimal(38,18)")
    return F.when(number == F.floor(number), F.floor(number)).try_cast("bigint")


def ntz_literal(value) -> Column:
    """A TIMESTAMP_NTZ literal from a datetime, date or ISO text, independent of every time zone.

    ``F.lit(datetime)`` makes a zone-aware literal from the Python process's local zone, which a
    later cast to TIMESTAMP_NTZ then reads in the session zone; going through text avoids both.
    """
    if isinstance(value, dt.datetime):
        text = value.replace(tzinfo=None).isoformat(sep=" ")
    elif isinstance(value, dt.date):
        text = value.isoformat() + " 00:00:00"
    else:
        text = str(value)
    return F.lit(text).cast("timestamp_ntz")


def utc_wall_time(df, name: str) -> Column:
    """Column ``name`` of ``df`` as TIMESTAMP_NTZ holding UTC wall time.

    TIMESTAMP_NTZ passes through. A zone-aware TIMESTAMP (an instant; e.g. parquet read with
    NTZ inference turned off) is converted through epoch microseconds, so the result never
    depends on the session time zone.
    """
    from pyspark.sql import types as T

    if isinstance(df.schema[name].dataType, T.TimestampType):
        return F.timestamp_add("MICROSECOND", F.unix_micros(F.col(name)), ntz_literal("1970-01-01 00:00:00"))
    return F.col(name)


# A zone designator after a time of day: Z, +hh, +hhmm or +hh:mm.
_ZONED = r"(?i)[T ]\d{1,2}:\d{2}(:\d{2}(\.\d*)?)?\s*(Z|[+-]\d{2}(:?\d{2})?)$"


def parse_timestamp(x) -> Column:
    """ISO-8601 text (with or without fraction, ``T`` or space) → TIMESTAMP_NTZ in UTC wall time;
    bad text → null.

    Naive text is taken as UTC wall time as written. Text with an explicit zone (``Z``, ``+02:00``)
    names an instant, which is converted to UTC through epoch microseconds, so neither the
    offset nor the session zone leaks into the stored value.
    """
    text = strip_ws(x)
    # "+0200" → "+02:00", the offset form the cast accepts
    instant = F.regexp_replace(text, r"([+-]\d{2})(\d{2})$", "$1:$2").try_cast("timestamp")
    utc_wall = F.timestamp_add("MICROSECOND", F.unix_micros(instant), ntz_literal("1970-01-01 00:00:00"))
    return F.when(text.rlike(_ZONED), utc_wall).otherwise(text.try_cast("timestamp_ntz"))
