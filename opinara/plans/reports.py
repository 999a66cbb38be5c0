"""Reporting datasets over the star schema or over a flat review table.

Groups may be of any size: every measure here is partially aggregated in the map tasks.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DecimalType, DoubleType, FloatType

from opinara import fixed_values as fixed
from opinara.functions import labels
from opinara.functions.casting import PUBLISH_DATE, to_date, to_number
from opinara.functions.numbers import count_label, half_up, label_share, rows, share
from opinara.functions.text import word_count
from opinara.operators.gather import grouped_text, term_counts
from opinara.operators.lineage import cut_lineage
from opinara.operators.lookup import lookup, which_are_small
from opinara.operators.places import add_places, ordered_text

Star = dict[str, DataFrame]

FACT_MEASURES = [
    "star_rating", "ensemble_score", "sentiment_confidence", "topic_probability", "word_count", "char_count",
    "positive_words_count", "negative_words_count", "has_exclamation", "has_question", "has_caps",
    "data_quality_score", "review_text", "textblob_polarity", "vader_compound", "custom_sentiment_score",
]
DIMENSION_COLUMNS = {
    "dim_bank": ("bank_id", ["bank_name"]),
    "dim_branch": ("branch_id", ["branch_name", "city", "region"]),
    "dim_date": ("date_id", ["full_date", "year", "month", "month_name", "quarter", "day_name", "is_weekend"]),
    "dim_sentiment": ("sentiment_id", ["sentiment_label"]),
    "dim_topic": ("topic_id", ["topic_name"]),
}


def join_dimensions(star: Star, tables=tuple(DIMENSION_COLUMNS)) -> DataFrame:
    """The fact with the columns of some dimensions; a row without a member keeps nulls."""
    out = star["fact_reviews"]
    small = which_are_small({t: star[t].select(DIMENSION_COLUMNS[t][0], *DIMENSION_COLUMNS[t][1]) for t in tables})
    for table in tables:
        key, columns = DIMENSION_COLUMNS[table]
        out = lookup(out, star[table].select(key, *columns), {key: key}, ["review_id"], small=small[table])
    return out


# ---------------------------------------------------------------- main datasets


def main_dataset(star: Star, newest_first: bool = False) -> DataFrame:
    """One row per rated review with all five dimensions and display buckets. The order is for
    display only; a range sort of the whole fact is left out unless asked for."""
    rated = star | {"fact_reviews": star["fact_reviews"].filter("star_rating is not null")}
    flat = join_dimensions(rated).withColumnRenamed("full_date", "review_date")
    out = flat.select(
        "review_id", "bank_name", "branch_name", "city", "region", "review_date", "year", "month", "month_name",
        "quarter", "day_name", "is_weekend", "star_rating", "sentiment_label", "ensemble_score",
        "sentiment_confidence", "topic_name", "topic_probability", "word_count", "char_count",
        "positive_words_count", "negative_words_count", "has_exclamation", "has_question", "has_caps",
        "data_quality_score", "review_text", "textblob_polarity", "vader_compound", "custom_sentiment_score",
    )
    return out.orderBy(F.col("review_date").desc_nulls_last(), "review_id") if newest_first else out


def with_buckets(main: DataFrame) -> DataFrame:
    return main.withColumns(
        {
            "rating_category": labels.rating_bucket(F.col("star_rating")),
            "sentiment_emoji": labels.sentiment_bucket(F.col("sentiment_label")),
            "quality_level": labels.quality_level(F.col("data_quality_score")),
            "text_length_category": labels.length_bucket(F.col("word_count")),
        }
    )


def _with_two_buckets(flat: DataFrame) -> DataFrame:
    return flat.withColumns(
        {
            "rating_category": labels.rating_bucket(F.col("star_rating")),
            "sentiment_emoji": labels.sentiment_bucket(F.col("sentiment_label")),
        }
    )


def main_dataset_with_text(star: Star) -> DataFrame:
    """Reviews with a text and four dimensions."""
    texts = star | {"fact_reviews": star["fact_reviews"].filter("review_text is not null")}
    flat = join_dimensions(texts, ("dim_bank", "dim_sentiment", "dim_topic", "dim_date"))
    columns = [c for c in FACT_MEASURES if c in flat.columns]
    return _with_two_buckets(
        flat.select("review_id", "bank_name", "sentiment_label", "topic_name", F.col("full_date").alias("review_date"),
                    "year", "month", "month_name", "quarter", *columns)
    )


def main_dataset_simple(star: Star) -> DataFrame:
    """Rated reviews with bank and sentiment only."""
    rated = star | {"fact_reviews": star["fact_reviews"].filter("star_rating is not null")}
    flat = join_dimensions(rated, ("dim_bank", "dim_sentiment"))
    measures = [c for c in FACT_MEASURES if c != "topic_probability"]
    return _with_two_buckets(flat.select("review_id", *measures, "topic_probability", "bank_name", "sentiment_label"))


RENAMES = {"rating": "star_rating", "ensemble_score": "sentiment_score", "topic_label": "topic_name",
           "topic_probability": "topic_confidence"}
FLAT_DEFAULTS = {
    "bank_name": "Banque Inconnue", "star_rating": 3, "sentiment_label": "neutral", "sentiment_score": 0.0,
    "topic_name": "autres", "review_text": "Pas de texte",
}
FLAT_COLUMNS = [
    "bank_name", "branch_name", "star_rating", "rating_category", "sentiment_label", "sentiment_emoji",
    "sentiment_score", "topic_name", "review_text", "word_count", "char_count", "review_date", "year", "month",
    "month_name", "quarter",
]


def fill_or_add(df: DataFrame, defaults: dict) -> DataFrame:
    """Each column with its default where it is null, or added when it is missing."""
    values = {
        name: F.coalesce(F.col(name).cast("string"), F.lit(str(value))) if name in df.columns and isinstance(value, str)
        else F.coalesce(to_number(F.col(name)), F.lit(float(value))) if name in df.columns
        else F.lit(value)
        for name, value in defaults.items()
    }
    return df.withColumns(values)


def keep_columns(df: DataFrame, wanted: list[str]) -> DataFrame:
    return df.select([c for c in wanted if c in df.columns])


def flat_dataset(reviews: DataFrame) -> DataFrame:
    """Publishing table straight from scored reviews, without a warehouse: renamed columns, defaults,
    buckets, text counts where missing, and date parts with English month names."""
    named = reviews.withColumnsRenamed({old: new for old, new in RENAMES.items() if old in reviews.columns})
    out = fill_or_add(named, FLAT_DEFAULTS)
    added = {
        "rating_category": labels.rating_bucket(F.col("star_rating"), fixed.RATING_UNEVALUATED),
        "sentiment_emoji": labels.sentiment_bucket(F.col("sentiment_label"), any_case=True),
    }
    if "word_count" not in out.columns:
        added["word_count"] = word_count(F.col("review_text"))
    if "char_count" not in out.columns:
        added["char_count"] = F.length("review_text")
    given = F.col("review_date") if "review_date" in out.columns else F.lit(None).cast("string")
    out = out.withColumns(added).withColumn("review_date", to_date(given, default=PUBLISH_DATE))
    day = F.col("review_date")
    parts = {"year": F.year(day), "month": F.month(day), "month_name": F.date_format(day, "MMMM"), "quarter": F.quarter(day)}
    return keep_columns(out.withColumns(parts), FLAT_COLUMNS)


SIMPLE_DEFAULTS = {"Banque": "Banque Inconnue", "Agence": "Agence Inconnue", "Sentiment": "neutral", "Sujet": "autres"}
SIMPLE_DATE, SIMPLE_YEAR, SIMPLE_MONTH = "2024-06-01", 2024, 6
SIMPLE_CHARS, SIMPLE_WORDS = 100, 20


def simple_dataset(reviews: DataFrame) -> DataFrame:
    """Small dataset with French column names. A missing column falls back as in the published one."""

    def first(*names: str, default):
        return next((F.col(n) for n in names if n in reviews.columns), F.lit(default))

    has_text = "review_text" in reviews.columns
    out = reviews.select(
        first("bank_name", default="Inconnue").alias("Banque"),
        first("branch_name", default="Inconnue").alias("Agence"),
        to_number(first("rating", "star_rating", default=3).cast("string"), 3).alias("Note"),
        first("sentiment_label", default="neutral").alias("Sentiment"),
        to_number(first("ensemble_score", default=0).cast("string"), 0).alias("Score_Sentiment"),
        first("topic_label", "topic_name", default="autres").alias("Sujet"),
        (F.length("review_text") if has_text else F.lit(SIMPLE_CHARS)).alias("Longueur_Avis"),
        (word_count(F.col("review_text")) if has_text else F.lit(SIMPLE_WORDS)).alias("Nb_Mots"),
        F.lit(SIMPLE_DATE).alias("Date"),
        F.lit(SIMPLE_YEAR).alias("Annee"),
        F.lit(SIMPLE_MONTH).alias("Mois"),
    )
    out = out.fillna(SIMPLE_DEFAULTS).fillna({"Longueur_Avis": 0})
    return out.withColumns(
        {
            "Categorie_Note": labels.rating_bucket_short(F.col("Note")),
            "Sentiment_Emoji": labels.sentiment_bucket_short(F.col("Sentiment")),
        }
    )


def simple_bank_summary(simple: DataFrame) -> DataFrame:
    return simple.groupBy("Banque").agg(
        F.count("Note").alias("Total_Avis"),
        half_up(F.avg("Note")).alias("Note_Moyenne"),
        half_up(F.avg("Score_Sentiment")).alias("Sentiment_Moyen"),
    )


# ---------------------------------------------------------------- grouped reports


def _averages(**columns: str) -> list:
    return [F.avg(c).alias(name) for name, c in columns.items()]


REPORT_KEYS = {
    "bank_summary": ["bank_id", "bank_name"],
    "temporal_trends": ["year", "month", "month_name", "quarter"],
    "topic_analysis": ["topic_id", "topic_name"],
    "branch_performance": ["bank_id", "bank_name", "branch_id", "branch_name", "city", "region"],
    "bank_topic_matrix": ["bank_id", "bank_name", "topic_id", "topic_name"],
}
REPORT_TABLES = {
    "bank_summary": ("dim_bank", "dim_sentiment", "dim_date"),
    "temporal_trends": ("dim_date", "dim_sentiment"),
    "topic_analysis": ("dim_topic", "dim_sentiment"),
    "branch_performance": ("dim_bank", "dim_branch", "dim_sentiment"),
    "bank_topic_matrix": ("dim_bank", "dim_topic"),
}


def _measures() -> dict[str, Column]:
    """Every measure of the grouped reports."""
    return {
        "n": rows(),
        "rating": F.avg("star_rating"),
        "score": F.avg("ensemble_score"),
        "n_positive": count_label("positive"),
        "n_negative": count_label("negative"),
        "n_neutral": count_label("neutral"),
        "positive": label_share("positive"),
        "negative": label_share("negative"),
        "words": F.avg("word_count"),
        "quality": F.avg("data_quality_score"),
        "probability": F.avg("topic_probability"),
        "first": F.min("full_date"),
        "last": F.max("full_date"),
    }


_SHOWN = {
    "bank_summary": {
        "n": "total_reviews", "rating": "avg_rating", "score": "avg_sentiment_score", "n_positive": "positive_reviews",
        "n_negative": "negative_reviews", "n_neutral": "neutral_reviews", "positive": "positive_percentage",
        "negative": "negative_percentage", "words": "avg_word_count", "quality": "avg_data_quality",
        "first": "first_review_date", "last": "last_review_date",
    },
    "temporal_trends": {
        "n": "review_count", "rating": "avg_rating", "score": "avg_sentiment", "n_positive": "positive_count",
        "n_negative": "negative_count", "n_neutral": "neutral_count", "positive": "positive_percentage",
    },
    "topic_analysis": {
        "n": "review_count", "rating": "avg_rating", "score": "avg_sentiment", "probability": "avg_topic_probability",
        "n_positive": "positive_reviews", "n_negative": "negative_reviews", "positive": "positive_percentage",
        "words": "avg_word_count",
    },
    "branch_performance": {
        "n": "total_reviews", "rating": "avg_rating", "score": "avg_sentiment_score", "n_positive": "positive_reviews",
        "n_negative": "negative_reviews", "positive": "positive_percentage", "quality": "avg_data_quality",
    },
    "bank_topic_matrix": {"n": "review_count", "score": "avg_sentiment"},
}


def _shown(name: str, grouped: DataFrame, min_reviews: int = 3) -> DataFrame:
    """A report from its groups: the groups it keeps, and its columns."""
    if name == "topic_analysis":
        grouped = grouped.filter("topic_name is not null")
    if name == "branch_performance":
        grouped = grouped.filter(F.col("branch_name").isNotNull() & (F.col("n") >= min_reviews))
    extra = []
    if name == "bank_topic_matrix":
        # The total of a bank is summed over its topic counts, those without a topic included
        grouped = grouped.filter("bank_name is not null")
        grouped = grouped.withColumn("_share", share(F.col("n"), F.sum("n").over(Window.partitionBy("bank_id"))))
        grouped, extra = grouped.filter("topic_name is not null"), [F.col("_share").alias("topic_percentage_in_bank")]
    hidden = ["bank_id", "topic_id", "branch_id"] if name != "bank_summary" else []
    keys = [c for c in REPORT_KEYS[name] if c not in hidden]
    return grouped.select(*keys, *(F.col(c).alias(shown) for c, shown in _SHOWN[name].items()), *extra)


def _report(name: str, star: Star, **options) -> DataFrame:
    fact, wanted = join_dimensions(star, REPORT_TABLES[name]), _SHOWN[name]
    grouped = fact.groupBy(*REPORT_KEYS[name]).agg(*(m.alias(c) for c, m in _measures().items() if c in wanted))
    return _shown(name, grouped, **options)


def bank_summary(star: Star) -> DataFrame:
    """Reviews without a bank stay as one group."""
    return _report("bank_summary", star)


def temporal_trends(star: Star) -> DataFrame:
    """Per month; reviews without a date are one group."""
    return _report("temporal_trends", star)


def topic_analysis(star: Star) -> DataFrame:
    return _report("topic_analysis", star)


def branch_performance(star: Star, min_reviews: int = 3) -> DataFrame:
    return _report("branch_performance", star, min_reviews=min_reviews)


def bank_topic_matrix(star: Star) -> DataFrame:
    """Counts per bank and topic, with the share of all reviews of the bank, those without a topic included."""
    return _report("bank_topic_matrix", star)


def all_reports(star: Star) -> dict[str, DataFrame]:
    """The five grouped reports from one pass: the fact is read and joined to its dimensions once, and one aggregate over grouping
    sets, with map-side totals, makes the groups of all of them. Those are written and split by their grouping set."""
    fact = join_dimensions(star)
    columns = list(dict.fromkeys(c for keys in REPORT_KEYS.values() for c in keys))
    # a row per review and set with the columns of the set alone; the set is a key of its own, as a null may be a group
    sets = [
        F.struct(F.lit(name).alias("_set"), *(F.col(c) if c in keys else F.lit(None).cast(fact.schema[c].dataType).alias(c) for c in columns))
        for name, keys in REPORT_KEYS.items()
    ]
    measured = ["star_rating", "ensemble_score", "sentiment_label", "word_count", "data_quality_score", "topic_probability", "full_date"]
    listed = fact.select(*measured, F.inline(F.array(*sets)))
    grouped = cut_lineage(listed.groupBy("_set", *columns).agg(*(m.alias(c) for c, m in _measures().items())))
    return {name: _shown(name, grouped.filter(F.col("_set") == name)) for name in REPORT_KEYS}


REPORT_ORDERS = {
    "main_dataset": ["-review_date", "review_id"],
    "bank_summary": ["-total_reviews", "bank_name"],
    "temporal_trends": ["year", "month"],
    "topic_analysis": ["-review_count", "topic_name"],
    "branch_performance": ["-positive_percentage", "-avg_rating", "bank_name", "branch_name", "city", "region"],
    "bank_topic_matrix": ["bank_name", "-review_count", "topic_name"],
}


def in_order(report: DataFrame, name: str) -> DataFrame:
    """A report with the ``place`` of each row in its order of display, from 1. A column with a minus falls, missing values last;
    others rise, missing values first. Means count to six places, so that equal ones tie however they were summed up."""
    kinds = {f.name: f.dataType for f in report.schema}
    keys = []
    for part in REPORT_ORDERS[name]:
        column = part.lstrip("-")
        value = F.round(column, 6) if isinstance(kinds[column], DoubleType) else F.col(column)
        keys.append(value.desc_nulls_last() if part[0] == "-" else value.asc_nulls_first())
    return add_places(report, keys)


def bank_summary_known(star: Star) -> DataFrame:
    """The same without unknown banks, date span and negative share."""
    fact = join_dimensions(star, ("dim_bank", "dim_sentiment")).filter("bank_name is not null")
    return fact.groupBy("bank_id", "bank_name").agg(
        rows().alias("total_reviews"),
        *_averages(avg_rating="star_rating", avg_sentiment_score="ensemble_score"),
        count_label("positive").alias("positive_reviews"),
        count_label("negative").alias("negative_reviews"),
        count_label("neutral").alias("neutral_reviews"),
        label_share("positive").alias("positive_percentage"),
        *_averages(avg_word_count="word_count", avg_data_quality="data_quality_score"),
    )


def flat_bank_summary(flat: DataFrame) -> DataFrame:
    """Rounded summary of the flat dataset; both shares are always there."""
    return flat.groupBy("bank_name").agg(
        F.count("star_rating").alias("total_reviews"),
        half_up(F.coalesce(F.avg("star_rating"), F.lit(0.0))).alias("avg_rating"),
        half_up(F.coalesce(F.avg("sentiment_score"), F.lit(0.0))).alias("avg_sentiment"),
        half_up(F.coalesce(F.avg("word_count"), F.lit(0.0))).alias("avg_word_count"),
        F.coalesce(label_share("positive"), F.lit(0.0)).alias("positive_percentage"),
        F.coalesce(label_share("negative"), F.lit(0.0)).alias("negative_percentage"),
    )


def flat_temporal_trends(flat: DataFrame) -> DataFrame:
    return flat.groupBy("year", "month", "month_name").agg(
        F.count("star_rating").alias("review_count"),
        half_up(F.avg("star_rating")).alias("avg_rating"),
        half_up(F.avg("sentiment_score")).alias("avg_sentiment"),
    )


def flat_topic_analysis(flat: DataFrame) -> DataFrame:
    return flat.groupBy("topic_name").agg(
        F.count("star_rating").alias("review_count"),
        half_up(F.coalesce(F.avg("star_rating"), F.lit(0.0))).alias("avg_rating"),
        half_up(F.coalesce(F.avg("sentiment_score"), F.lit(0.0))).alias("avg_sentiment"),
        F.coalesce(label_share("positive"), F.lit(0.0)).alias("positive_percentage"),
    )


def wordcloud_texts(star: Star, order: str, rows_per_piece: int = 1000) -> DataFrame:
    fact = join_dimensions(star, ("dim_sentiment", "dim_topic")).filter(F.length("review_text") > 10)
    return grouped_text(fact, ["sentiment_label", "topic_name"], "review_text", order, rows_per_piece)


def wordcloud_pieces(star: Star, order=("review_id",), **limits) -> DataFrame:
    """The texts of each sentiment and topic in any order, in pieces of bounded rows and bytes."""
    fact = join_dimensions(star, ("dim_sentiment", "dim_topic")).filter(F.length("review_text") > 10)
    return ordered_text(fact, ["sentiment_label", "topic_name"], "review_text", list(order), **limits)


def wordcloud_terms(star: Star) -> DataFrame:
    fact = join_dimensions(star, ("dim_sentiment", "dim_topic")).filter(F.length("review_text") > 10)
    return term_counts(fact, ["sentiment_label", "topic_name"], "review_text")


def sentiment_counts(df: DataFrame, group: str) -> DataFrame:
    """One column of counts per known label, 0 where a label does not occur."""
    return df.groupBy(group).pivot("sentiment_label", fixed.LABELS).count().fillna(0, fixed.LABELS)


# ---------------------------------------------------------------- polish


def publish(df: DataFrame) -> DataFrame:
    """Types by column name: percentages, scores and ratings to two places, whole counts as BIGINT,
    dates as dates, and a name for a missing bank or sentiment. A mean that has ``count`` in its
    name keeps its fraction and is rounded to two places."""
    columns = []
    for field in df.schema:
        name, value = field.name, F.col(field.name)
        fractional = isinstance(field.dataType, DoubleType | FloatType | DecimalType)
        if name in ("review_date", "first_review_date", "last_review_date") and not isinstance(field.dataType, DateType):
            value = to_date(value)
        elif fractional and any(part in name for part in ("percentage", "score", "rating", "count")):
            value = half_up(value)
        elif "count" in name and field.dataType.typeName() in ("integer", "short", "byte"):
            value = value.cast("long")
        elif name == "bank_name":
            value = F.coalesce(value, F.lit("Inconnu"))
        elif name == "sentiment_label":
            value = F.coalesce(value, F.lit("unknown"))
        columns.append(value.alias(name))
    return df.select(*columns)


# ---------------------------------------------------------------- custom queries


def last_day(df: DataFrame, as_of: str | Column | None = None) -> Column:
    """The day a period ends on: the given one, or the last review date of the table."""
    if isinstance(as_of, Column):
        return as_of
    return F.to_date(F.lit(as_of)) if as_of is not None else df.agg(F.max("review_date")).scalar()


def last_rated_day(star: Star) -> Column:
    """The last date of the rated reviews, from the date keys of the fact alone: no other dimension is joined for it."""
    rated = star["fact_reviews"].filter("star_rating is not null").select("date_id").distinct()
    return rated.join(star["dim_date"], "date_id").agg(F.max("full_date")).scalar()


def kpi_overview(main: DataFrame, as_of: str | Column | None = None, days: int = 30) -> DataFrame:
    recent = main.filter(F.col("review_date") >= F.date_sub(last_day(main, as_of), days))
    return recent.agg(
        rows().alias("total_reviews"),
        *_averages(avg_rating="star_rating", avg_sentiment="ensemble_score"),
        label_share("positive", places=None).alias("positive_percentage"),
    )


def monthly_trend(main: DataFrame) -> DataFrame:
    return main.groupBy(F.trunc("review_date", "MM").alias("month")).agg(
        rows().alias("review_count"), *_averages(avg_sentiment="ensemble_score", avg_rating="star_rating")
    )


def bank_comparison(main: DataFrame, min_reviews: int = 10) -> DataFrame:
    grouped = main.groupBy("bank_name").agg(
        rows().alias("total_reviews"),
        *_averages(avg_rating="star_rating"),
        label_share("positive", places=None).alias("positive_percentage"),
        *_averages(avg_review_length="word_count"),
    )
    return grouped.filter(F.col("total_reviews") >= min_reviews)


def topic_sentiment(main: DataFrame) -> DataFrame:
    known = main.filter("topic_name is not null")
    return known.groupBy("topic_name", "sentiment_label").agg(
        rows().alias("review_count"), *_averages(avg_confidence="topic_probability")
    )


def regional_performance(main: DataFrame, min_reviews: int = 5) -> DataFrame:
    known = main.filter("region is not null and city is not null")
    grouped = known.groupBy("region", "city").agg(
        rows().alias("total_reviews"),
        *_averages(avg_rating="star_rating"),
        label_share("positive", places=None).alias("positive_percentage"),
    )
    return grouped.filter(F.col("total_reviews") >= min_reviews)
