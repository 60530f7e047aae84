"""Column lists, struct types and the fixed rule tables of the observation model."""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------------------------
# Fixed values that must equal the reference's for right results.
#
# Measures of an observation, in payload value-line order (also the table column names).
MEASURES = [
    "temperature", "humidity", "wind_speed", "wind_direction",
    "pressure", "precipitation", "cloud_cover", "visibility",
]
# Field names of a message value on the wire; ``fmisid`` is the station id.
MESSAGE_FIELDS = [
    "fmisid", "latitude", "longitude", "timestamp",
    "temperature", "humidity", "wind_speed", "wind_direction",
    "pressure", "precipitation", "cloud_cover", "visibility",
    "ingestion_time", "location",
]
# Header of the station catalogue CSV.
CATALOG_CSV_COLUMNS = ["Name", "FMISID", "lat", "lon", "start", "finish"]
# Quality rules, per measure: (measure, lowest valid value, highest valid value).
#   temperature -50 .. 50, humidity 0 .. 100, wind_speed 0 .. 50, pressure 900 .. 1100
QUALITY_RULES = [
    ("temperature", -50.0, 50.0),
    ("humidity", 0.0, 100.0),
    ("wind_speed", 0.0, 50.0),
    ("pressure", 900.0, 1100.0),
]
# Quality labels.
MISSING, OUTLIER, VALID = "MISSING", "OUTLIER", "VALID"
# Rating thresholds on the completeness score rounded to 3 decimals, highest first; below all is POOR.
RATING_LEVELS = [(0.9, "EXCELLENT"), (0.7, "GOOD"), (0.5, "FAIR")]
RATING_FLOOR = "POOR"
# Display marks of the ratings, and the mark for anything else.
RATING_MARKS = {"EXCELLENT": "🟢", "GOOD": "🟡", "FAIR": "🟠", "POOR": "🔴"}
RATING_MARK_DEFAULT = "⚪"
# Parameter labels of the long-form missing/outlier views.
PARAMETER_LABELS = {"temperature": "Temperature", "humidity": "Humidity",
                    "wind_speed": "Wind Speed", "pressure": "Pressure"}
# Hours that a poll looks back: an observation can be delivered again for so long.
POLL_LOOKBACK_HOURS = 2
# Minutes between two polls of all stations.
POLL_INTERVAL_MINUTES = 10
# Units of the display texts.
UNIT_TEMPERATURE, UNIT_PERCENT, UNIT_WIND = "°C", "%", " m/s"
# Catalogue rule: a station is active when `finish` is empty or a year >= 2020.
ACTIVE_FINISH_YEAR = 2020
# Payload elements (namespace, name): positions (lat lon epoch per line) and values (8 measures per line).
PAYLOAD_POSITIONS = ("http://www.opengis.net/gmlcov/1.0", "positions")
PAYLOAD_VALUES = ("http://www.opengis.net/gml/3.2", "doubleOrNilReasonTupleList")
# Token the payload uses for a missing value.
PAYLOAD_NAN_TOKEN = "NaN"
# ---------------------------------------------------------------------------------------------

# Columns of the landed raw table (the reference's 14 columns; the id is called station_id here).
RAW_COLUMNS = ["timestamp", "station_id", "location", "latitude", "longitude", *MEASURES, "ingestion_time"]

RAW_SCHEMA = T.StructType(
    [
        T.StructField("timestamp", T.TimestampNTZType(), False),
        T.StructField("station_id", T.LongType(), False),
        T.StructField("location", T.StringType(), True),
        T.StructField("latitude", T.DoubleType(), True),
        T.StructField("longitude", T.DoubleType(), True),
        *[T.StructField(m, T.DoubleType(), True) for m in MEASURES],
        T.StructField("ingestion_time", T.TimestampNTZType(), False),
    ]
)

# Numeric fields cast leniently at cleansing (everything numeric except the id).
NUMERIC_FIELDS = ["latitude", "longitude", *MEASURES]

# Message value as it travels: every field is text so one malformed field cannot void the record.
MESSAGE_STRING_SCHEMA = T.StructType([T.StructField(f, T.StringType(), True) for f in MESSAGE_FIELDS])


QUALITY_MEASURES = [m for m, _, _ in QUALITY_RULES]
QUALITY_COLUMNS = [f"{m}_quality" for m in QUALITY_MEASURES]

DAILY_COLUMNS = [*RAW_COLUMNS, *QUALITY_COLUMNS, "data_completeness_score"]

# Columns of the long-term station history (the reference's 11, plus the id and partition date).
HISTORY_COLUMNS = [
    "station_id", "timestamp", "temperature", "humidity", "wind_speed", "wind_direction", "pressure",
    "precipitation", "cloud_cover", "visibility", "data_completeness_score", "processing_time",
]

# Station catalogue CSV as published (ids read as text and cast leniently).
CATALOG_CSV_SCHEMA = T.StructType(
    [T.StructField(name, typ, True) for name, typ in zip(
        CATALOG_CSV_COLUMNS,
        [T.StringType(), T.StringType(), T.DoubleType(), T.DoubleType(), T.IntegerType(), T.StringType()])]
)
