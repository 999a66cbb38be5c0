"""Declared schemas. Nothing is inferred from data."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType, BooleanType, DataType, DateType, DecimalType, DoubleType, IntegerType, LongType, StringType,
    StructField, StructType, TimestampType,
)

from opinara.functions.casting import nan_to_null, to_date, to_number

S, D, I, L, B = StringType(), DoubleType(), IntegerType(), LongType(), BooleanType()


def _schema(*fields: tuple[str, DataType]) -> StructType:
    return StructType([StructField(name, kind) for name, kind in fields])


REVIEWS_RAW = _schema(
    ("bank_name", S), ("branch_name", S), ("branch_location", S), ("review_text", S), ("rating", D), ("review_date", S)
)
REVIEWS_CLEANED = StructType(
    REVIEWS_RAW.fields
    + _schema(
        ("cleaned_text", S), ("processed_text", S), ("tokens", ArrayType(S)), ("word_count", I), ("char_count", I),
        ("original_length", I), ("cleaned_length", I), ("sentence_count", I), ("has_exclamation", B),
        ("has_question", B), ("has_caps", B), ("textblob_polarity", D),
    ).fields
)
REVIEWS_SENTIMENT = StructType(
    REVIEWS_CLEANED.fields
    + _schema(
        ("textblob_subjectivity", D), ("vader_compound", D), ("vader_positive", D), ("vader_neutral", D),
        ("vader_negative", D), ("custom_sentiment_score", D), ("positive_words_count", I),
        ("negative_words_count", I), ("sentiment_label", S), ("ensemble_score", D), ("sentiment_confidence", D),
        ("rating_sentiment", S),
    ).fields
)
REVIEWS_TOPICS = StructType(
    REVIEWS_SENTIMENT.fields + _schema(("topic_id", I), ("topic_probability", D), ("topic_label", S)).fields
)

DIM_BANK = _schema(("bank_id", L), ("bank_name", S))
DIM_BRANCH = _schema(("branch_id", L), ("branch_name", S), ("branch_location", S), ("city", S), ("region", S))
DIM_DATE = _schema(
    ("date_id", L), ("full_date", DateType()), ("year", I), ("quarter", I), ("month", I), ("month_name", S),
    ("day", I), ("day_of_week", I), ("day_name", S), ("week_of_year", I), ("is_weekend", B),
)
DIM_SENTIMENT = _schema(
    ("sentiment_id", L), ("sentiment_label", S), ("sentiment_description", S), ("sentiment_score_min", D),
    ("sentiment_score_max", D),
)
DIM_TOPIC = _schema(
    ("topic_id", L), ("topic_name", S), ("topic_description", S), ("topic_keywords", ArrayType(S)),
    ("created_at", TimestampType()),
)
DIM_REVIEWER = _schema(
    ("reviewer_id", L), ("reviewer_name", S), ("reviewer_hash", S), ("review_count", I),
    ("first_review_date", DateType()), ("last_review_date", DateType()), ("avg_rating", DecimalType(3, 2)),
    ("created_at", TimestampType()), ("updated_at", TimestampType()),
)
FACT_NARROW = _schema(
    ("review_id", L), ("bank_id", L), ("branch_id", L), ("date_id", L), ("sentiment_id", L), ("review_text", S),
    ("rating", D), ("word_count", I), ("char_count", I), ("has_exclamation", B), ("has_question", B), ("has_caps", B),
)
FACT_ADDED = _schema(
    ("topic_id", L), ("star_rating", I), ("review_text_cleaned", S), ("review_date", DateType()),
    ("textblob_polarity", D), ("textblob_subjectivity", D), ("vader_compound", D), ("vader_positive", D),
    ("vader_neutral", D), ("vader_negative", D), ("custom_sentiment_score", D), ("ensemble_score", D),
    ("sentiment_confidence", D), ("word_count", I), ("char_count", I), ("sentence_count", I),
    ("positive_words_count", I), ("negative_words_count", I), ("topic_probability", D), ("has_exclamation", B),
    ("has_question", B), ("has_caps", B), ("original_length", I), ("cleaned_length", I),
    ("scraped_at", TimestampType()), ("data_quality_score", D),
)
FACT_DEFAULTS = {"has_exclamation": False, "has_question": False, "has_caps": False}
EXPECTED_TABLES = [
    "fact_reviews", "dim_bank", "dim_branch", "dim_date", "dim_sentiment", "dim_topic", "dim_reviewer"
]
EXPECTED_FACT_COLUMNS = [
    "review_id", "bank_id", "branch_id", "date_id", "sentiment_id", "topic_id", "star_rating", "ensemble_score"
]


def typed(value: Column, kind: DataType) -> Column:
    """Value of text in a declared type; null when it does not fit."""
    if isinstance(kind, ArrayType):
        return F.filter(F.split(value, " "), lambda t: t != "")
    if isinstance(kind, DateType):
        return to_date(value)
    if isinstance(kind, IntegerType | LongType):
        return to_number(value).try_cast(kind)
    out = value.try_cast(kind)
    return nan_to_null(out) if isinstance(kind, DoubleType) else out


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """Columns of a text table in declared types and order; a missing column is all null."""
    return df.select(
        *[
            (typed(F.col(f.name), f.dataType) if f.name in df.columns else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in schema
        ]
    )


def add_missing(df: DataFrame, schema: StructType, defaults: dict | None = None) -> DataFrame:
    """The table with every declared column it lacks, null or the given default."""
    defaults = defaults or {}
    added = {f.name: F.lit(defaults.get(f.name)).cast(f.dataType) for f in schema if f.name not in df.columns}
    return df.withColumns(added) if added else df
