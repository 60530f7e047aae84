"""Quality flags, completeness score and rating."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from stationlake.schemas import (
    MISSING, OUTLIER, QUALITY_RULES, RATING_FLOOR, RATING_LEVELS, RATING_MARK_DEFAULT,
    RATING_MARKS, VALID,
)


def quality_flag(x, lo: float, hi: float) -> Column:
    """null → MISSING, outside [lo, hi] → OUTLIER, else VALID."""
    x = F.col(x) if isinstance(x, str) else x
    return (F.when(x.isNull(), F.lit(MISSING))
            .when((x < F.lit(lo)) | (x > F.lit(hi)), F.lit(OUTLIER))
            .otherwise(F.lit(VALID)))


def quality_columns() -> dict[str, Column]:
    """``{<measure>_quality: flag}`` for every rule in the threshold table."""
    return {f"{m}_quality": quality_flag(m, lo, hi) for m, lo, hi in QUALITY_RULES}


def completeness_score() -> Column:
    """Share of the four checked measures that are present: 0, .25, .5, .75 or 1 (double)."""
    present = [F.col(m).isNotNull().cast("int") for m, _, _ in QUALITY_RULES]
    total = present[0]
    for p in present[1:]:
        total = total + p
    return total / F.lit(float(len(present)))


def rating(score) -> Column:
    """Rating of a completeness score already rounded to 3 decimals."""
    score = F.col(score) if isinstance(score, str) else score
    expr = None
    for threshold, label in RATING_LEVELS:
        cond = score >= F.lit(threshold)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.otherwise(F.lit(RATING_FLOOR))


def rating_mark(r) -> Column:
    """Display mark of a rating, default mark when unknown or null."""
    r = F.col(r) if isinstance(r, str) else r
    expr = None
    for label, mark in RATING_MARKS.items():
        cond = r == F.lit(label)
        expr = F.when(cond, F.lit(mark)) if expr is None else expr.when(cond, F.lit(mark))
    return expr.otherwise(F.lit(RATING_MARK_DEFAULT))
