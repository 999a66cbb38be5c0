"""Safe casts: a bad value becomes null or a default, never an error."""

from pyspark.sql import Column
from pyspark.sql import functions as F

_TIME = "[ HH:mm[:ss[.SSSSSS]]]['T'HH:mm[:ss[.SSSSSS]]]"
DATE_FORMATS = ("yyyy-MM-dd" + _TIME, "dd/MM/yyyy" + _TIME, "yyyy/MM/dd" + _TIME)
PUBLISH_DATE = "2024-01-01"


def nan_to_null(value: Column) -> Column:
    return F.when(~F.isnan(value), value)


def to_number(value: Column, default: float | None = None) -> Column:
    number = nan_to_null(value.try_cast("double"))
    return number if default is None else F.coalesce(number, F.lit(float(default)))


def to_whole(value: Column) -> Column:
    """A whole number, cutting the fraction; text such as ``4.7`` counts as a number."""
    return to_number(value).try_cast("int")


def to_date(value: Column, formats=DATE_FORMATS, default: str | None = None) -> Column:
    """First format that the whole text follows. A time of day may stand after the date; anything else gives null."""
    text = F.trim(value.cast("string"))
    day = F.coalesce(*[F.try_to_timestamp(text, F.lit(f)).cast("date") for f in formats])
    return day if default is None else F.coalesce(day, F.to_date(F.lit(default)))


def first_date(*values: Column) -> Column:
    """First of several columns that holds a date."""
    return F.coalesce(*[to_date(v) for v in values])


def rating_from_label(label: Column) -> Column:
    """First number in a label such as ``4.5 stars``; 0 when there is none."""
    return F.coalesce(F.regexp_extract(label, r"([0-9]+(\.[0-9]+)?)", 1).try_cast("double"), F.lit(0.0))
