"""Sentiment labels and display buckets."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from opinara import fixed_values as fixed
from opinara.functions.casting import nan_to_null


def rating_label(rating: Column) -> Column:
    """Label that a star rating stands for; 0 and null mean no rating."""
    rating = nan_to_null(rating.cast("double"))
    return (
        F.when(rating.isNull() | (rating == 0), "unknown")
        .when(rating >= 4, "positive")
        .when(rating <= 2, "negative")
        .otherwise("neutral")
    )


def score_label(
    score: Column, positive: float = fixed.LABEL_THRESHOLD, negative: float = -fixed.LABEL_THRESHOLD
) -> Column:
    return F.when(score >= positive, "positive").when(score <= negative, "negative").otherwise("neutral")


def ensemble_score(polarity: Column, valence: Column, lexicon: Column) -> Column:
    return (
        F.lit(fixed.WEIGHT_POLARITY) * polarity
        + F.lit(fixed.WEIGHT_VALENCE) * valence
        + F.lit(fixed.WEIGHT_LEXICON) * lexicon
    )


def ensemble_label(score: Column, rating: Column, threshold: float = fixed.ENSEMBLE_THRESHOLD) -> Column:
    """Label of the score, unless a rating says the opposite: then the rating wins."""
    by_score, by_rating = score_label(score, threshold, -threshold), rating_label(rating)
    opposite = ((by_score == "positive") & (by_rating == "negative")) | (
        (by_score == "negative") & (by_rating == "positive")
    )
    return F.when(opposite, by_rating).otherwise(by_score)


def confidence(score: Column) -> Column:
    return F.least(F.abs(score) * 2, F.lit(1.0))


def rating_bucket(rating: Column, unrated: str = fixed.RATING_UNRATED) -> Column:
    five, four, three, low = fixed.RATING_NAMES
    return (
        F.when(rating == 5, five)
        .when(rating == 4, four)
        .when(rating == 3, three)
        .when(rating.isin(1, 2), low)
        .otherwise(unrated)
    )


def rating_bucket_short(rating: Column) -> Column:
    five, four, three, other = fixed.RATING_SHORT_NAMES
    return F.when(rating == 5, five).when(rating == 4, four).when(rating == 3, three).otherwise(other)


def sentiment_bucket(label: Column, any_case: bool = False) -> Column:
    label = F.lower(label) if any_case else label
    out = F
    for name, shown in fixed.SENTIMENT_NAMES.items():
        out = out.when(label == name, shown)
    return out.otherwise(fixed.SENTIMENT_OTHER)


def sentiment_bucket_short(label: Column) -> Column:
    out = F
    for name, shown in fixed.SENTIMENT_SHORT_NAMES.items():
        out = out.when(F.lower(label) == name, shown)
    return out.otherwise(fixed.SENTIMENT_SHORT_OTHER)


def quality_level(score: Column) -> Column:
    score = nan_to_null(score)
    high, medium, low, lowest = fixed.QUALITY_NAMES
    return F.when(score >= 0.8, high).when(score >= 0.6, medium).when(score >= 0.4, low).otherwise(lowest)


def length_bucket(words: Column) -> Column:
    words = nan_to_null(words.cast("double"))
    longest, long, medium, short = fixed.LENGTH_NAMES
    return F.when(words > 50, longest).when(words >= 20, long).when(words >= 10, medium).otherwise(short)


def quality_score(text: Column, rating: Column) -> Column:
    """0.5, plus 0.3 for a text over ten characters, plus 0.2 for a rating above 0."""
    has_text = F.coalesce(F.length(text) > 10, F.lit(False))
    has_rating = F.coalesce(nan_to_null(rating.cast("double")) > 0, F.lit(False))
    return F.lit(0.5) + F.when(has_text, 0.3).otherwise(0.0) + F.when(has_rating, 0.2).otherwise(0.0)


def month_key(year: Column, month: Column) -> Column:
    return F.format_string("%04d-%02d", year, month)
