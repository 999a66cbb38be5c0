"""Rounding and shares."""

from pyspark.sql import Column
from pyspark.sql import functions as F

LABEL_COLUMN = "sentiment_label"


def half_up(value: Column, places: int = 2) -> Column:
    """Half-up rounding. A sum of doubles depends on partition order in its last bits, so
    the value is first rounded to ten places and the published one stays the same."""
    return F.round(F.round(value, 10), places)


def share(part: Column, whole: Column, places: int | None = 2) -> Column:
    """``part`` of ``whole`` in percent, null when the whole is 0."""
    percent = F.try_divide(part * F.lit(100.0), whole)
    return percent if places is None else half_up(percent, places)


def rows() -> Column:
    return F.count(F.lit(1))


def count_label(label: str, column: str = LABEL_COLUMN) -> Column:
    return F.count_if(F.col(column) == label)


def label_share(label: str, column: str = LABEL_COLUMN, places: int | None = 2) -> Column:
    return share(count_label(label, column), F.count(F.lit(1)), places)
