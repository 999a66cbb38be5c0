"""Dashboard filters as one declared specification."""

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DEFAULT_MONTHS = 6


@dataclass(frozen=True)
class Filters:
    """Nothing set means no restriction, except for the period: the last six months by default."""

    start: str | None = None
    end: str | None = None
    months: int | None = DEFAULT_MONTHS
    banks: list[str] = field(default_factory=list)
    sentiments: list[str] = field(default_factory=list)
    city: str | None = None
    min_rating: float | None = None
    topics: list[str] = field(default_factory=list)
    excluded_topics: list[str] = field(default_factory=list)


def apply_filters(main: DataFrame, chosen: Filters, as_of: str) -> DataFrame:
    """Rows that pass. ``as_of`` is the day the default period ends on; all tests are plain
    comparisons with literals, so they reach the scan."""
    end = F.to_date(F.lit(chosen.end or as_of))
    tests = [F.col("review_date") <= end]
    if chosen.start:
        tests.append(F.col("review_date") >= F.to_date(F.lit(chosen.start)))
    elif chosen.months is not None:
        tests.append(F.col("review_date") >= F.add_months(end, -chosen.months))
    if chosen.banks:
        tests.append(F.col("bank_name").isin(chosen.banks))
    if chosen.sentiments:
        tests.append(F.col("sentiment_label").isin(chosen.sentiments))
    if chosen.city:
        tests.append(F.col("city") == chosen.city)
    if chosen.min_rating is not None:
        tests.append(F.col("star_rating") >= chosen.min_rating)
    if chosen.topics:
        tests.append(F.col("topic_name").isin(chosen.topics))
    if chosen.excluded_topics:
        tests.append(F.col("topic_name").isNull() | ~F.col("topic_name").isin(chosen.excluded_topics))
    out = main
    for test in tests:
        out = out.filter(test)
    return out
