"""Column expressions used across the library (all built-in Spark functions, no UDFs)."""

from stationlake.functions.numeric import ntz_literal, num_or_null, parse_timestamp, round_stable, strip_ws, to_id, utc_wall_time
from stationlake.functions.quality import (
    completeness_score,
    quality_columns,
    quality_flag,
    rating,
    rating_mark,
)

__all__ = [
    "ntz_literal", "num_or_null", "parse_timestamp", "round_stable", "strip_ws", "to_id", "utc_wall_time",
    "completeness_score", "quality_columns", "quality_flag", "rating", "rating_mark",
]
