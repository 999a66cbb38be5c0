"""KPIs and dashboard calculations over the main dataset and its reports."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from opinara.functions.labels import month_key, rating_bucket
from opinara.functions.numbers import half_up, label_share, rows
from opinara.operators.lineage import cut_lineage
from opinara.operators.lookup import lookup
from opinara.operators.statistics import correlation_matrix, exact_percentiles
from opinara.plans.reports import last_day

METRIC_COLUMNS = [
    "star_rating", "ensemble_score", "sentiment_confidence", "topic_probability", "word_count", "data_quality_score"
]


def summary_metrics(main: DataFrame) -> DataFrame:
    """One row of headline figures with the span of dates."""
    row = main.agg(
        rows().alias("total_reviews"),
        F.countDistinct("bank_name").alias("total_banks"),
        F.countDistinct("branch_name").alias("total_branches"),
        F.countDistinct("city").alias("total_cities"),
        half_up(F.avg("star_rating")).alias("avg_rating"),
        half_up(F.avg("ensemble_score")).alias("avg_sentiment_score"),
        half_up(F.avg("data_quality_score")).alias("avg_data_quality"),
        label_share("positive").alias("positive_percentage"),
        label_share("negative").alias("negative_percentage"),
        label_share("neutral").alias("neutral_percentage"),
        F.coalesce(F.date_diff(F.max("review_date"), F.min("review_date")), F.lit(0)).alias("date_range_days"),
    )
    per_month = F.try_divide(F.col("total_reviews").cast("double"), F.col("date_range_days") / F.lit(30.0))
    return row.withColumn("reviews_per_month", half_up(F.coalesce(per_month, F.lit(0.0))))


def top_banks(bank_summary: DataFrame) -> DataFrame:
    """Bank with the best positive share and bank with most reviews; ties go to the larger bank, then by name."""
    named = bank_summary.filter("bank_name is not null")
    best = F.min_by("bank_name", F.struct(-F.col("positive_percentage"), -F.col("total_reviews"), "bank_name"))
    most = F.min_by("bank_name", F.struct(-F.col("total_reviews"), "bank_name"))
    return named.agg(best.alias("best_bank"), most.alias("most_reviewed_bank"))


def full_metrics(main: DataFrame, bank_summary: DataFrame) -> DataFrame:
    """Headline figures and top banks as one row."""
    top = top_banks(bank_summary).select(F.struct("*")).scalar()
    return summary_metrics(main).withColumn("_top", top).select("*", "_top.*").drop("_top")


def small_metrics(main: DataFrame, score: str = "ensemble_score") -> DataFrame:
    return main.agg(
        rows().alias("total_reviews"),
        F.countDistinct("bank_name").alias("total_banks"),
        half_up(F.avg("star_rating")).alias("avg_rating"),
        half_up(F.avg(score), 3).alias("avg_sentiment"),
        label_share("positive").alias("positive_percentage"),
    )


def quick_kpis(main: DataFrame) -> DataFrame:
    return main.agg(
        F.count("bank_name").alias("total_reviews"),
        F.avg("star_rating").alias("avg_rating"),
        F.avg("ensemble_score").alias("avg_sentiment"),
    )


def rating_by_bank(main: DataFrame) -> DataFrame:
    return main.groupBy("bank_name").agg(F.avg("star_rating").alias("avg_rating"))


def count_by_sentiment(main: DataFrame, column: str = "sentiment_label") -> DataFrame:
    return main.groupBy(column).agg(rows().alias("review_count"))


def bank_indices(bank_summary: DataFrame) -> DataFrame:
    """Satisfaction score, positive conversion rate and quality index of each bank."""
    positive, neutral, negative = (F.col(f"{label}_reviews") for label in ("positive", "neutral", "negative"))
    return bank_summary.select(
        "bank_name",
        F.try_divide((positive * 2 + neutral).cast("double"), F.col("total_reviews")).alias("satisfaction_score"),
        F.try_divide(positive.cast("double"), positive + negative).alias("conversion_rate"),
        ((F.col("avg_rating") * 20 + F.col("positive_percentage")) / 2).alias("quality_index"),
    )


def monthly_scores(main: DataFrame) -> DataFrame:
    """Mean score and count per month. Everything below works on these few rows. The mean is cut to
    ten places, so that one that should be 0 is 0 when it divides another."""
    day = F.col("review_date")
    grouped = main.filter("review_date is not null").groupBy(F.year(day).alias("year"), F.month(day).alias("month"))
    out = grouped.agg(rows().alias("review_count"), half_up(F.avg("ensemble_score"), 10).alias("avg_sentiment"))
    return out.withColumn("period", month_key(F.col("year"), F.col("month")))


def sentiment_trend(months: DataFrame) -> DataFrame:
    """Change of the mean score against the month before, in percent."""
    before = F.lag("avg_sentiment").over(Window.orderBy("year", "month"))  # one row per month
    listed = months.withColumn("previous_sentiment", before)
    change = F.try_divide((F.col("avg_sentiment") - F.col("previous_sentiment")) * 100, F.col("previous_sentiment"))
    return listed.withColumn("sentiment_trend", change)


def sentiment_alerts(months: DataFrame, drop: float) -> DataFrame:
    """Months whose mean score fell by more than ``drop``."""
    change = F.col("avg_sentiment") - F.lag("avg_sentiment").over(Window.orderBy("year", "month"))
    return months.withColumn("sentiment_change", change).filter(F.col("sentiment_change") < -drop)


def year_over_year(months: DataFrame) -> DataFrame:
    """Each month with the same month a year earlier."""
    earlier = months.select(
        (F.col("year") + 1).alias("year"),
        "month",
        F.col("review_count").alias("previous_count"),
        F.col("avg_sentiment").alias("previous_sentiment"),
    )
    return months.select("year", "month", "review_count", "avg_sentiment").join(earlier, ["year", "month"], "left")


def by_quarter(main: DataFrame) -> DataFrame:
    return main.groupBy(F.quarter("review_date").alias("quarter")).agg(
        rows().alias("review_count"), F.avg("ensemble_score").alias("avg_sentiment")
    )


def by_weekday(main: DataFrame) -> DataFrame:
    return main.groupBy((F.weekday("review_date") + 1).alias("day_of_week")).agg(
        rows().alias("review_count"), F.avg("ensemble_score").alias("avg_sentiment")
    )


def recent_activity(main: DataFrame, as_of: str | Column | None = None, days: int = 7) -> DataFrame:
    """Reviews per day over the last days."""
    recent = main.filter(F.col("review_date") > F.date_sub(last_day(main, as_of), days))
    return recent.groupBy("review_date").agg(
        rows().alias("review_count"), F.avg("ensemble_score").alias("avg_sentiment"), label_share("positive").alias("positive_percentage")
    )


def rating_histogram(main: DataFrame) -> DataFrame:
    return main.groupBy("star_rating").agg(rows().alias("review_count")).withColumn("rating_category", rating_bucket(F.col("star_rating")))


def score_quartiles(main: DataFrame) -> DataFrame:
    """Box-plot figures of the score per bank."""
    return exact_percentiles(main, "bank_name", "ensemble_score")


def score_by_length(main: DataFrame, width: int = 10) -> DataFrame:
    """Mean score per span of ``width`` words."""
    return main.groupBy(F.expr(f"word_count div {width} * {width}").alias("words_from")).agg(
        rows().alias("review_count"), F.avg("ensemble_score").alias("avg_sentiment")
    )


def extreme_topics(main: DataFrame, n: int = 3) -> DataFrame:
    """The topics with the highest and with the lowest positive share."""
    topics = main.filter("topic_name is not null").groupBy("topic_name").agg(
        rows().alias("review_count"), label_share("positive").alias("positive_percentage")
    )
    high = topics.orderBy(F.desc("positive_percentage"), "topic_name").limit(n).withColumn("side", F.lit("positive"))
    low = topics.orderBy("positive_percentage", "topic_name").limit(n).withColumn("side", F.lit("negative"))
    return high.unionByName(low)


def branch_ranking(branches: DataFrame) -> DataFrame:
    """Rank of each branch inside its bank by positive share, then by rating.

    Equal (share, rating) pairs are counted first. Shares have two decimals, so a bank has at most
    10,001 of them to add up in order; ratings are only ordered inside one share. So no task sorts
    all branches of a bank. The branches are written once: they are read for the counts, the sizes of tables and the result.
    """
    branches = cut_lineage(branches)
    share, rating = "positive_percentage", "avg_rating"
    pairs = branches.groupBy("bank_name", share, rating).agg(rows().alias("_n"))
    per_share = pairs.groupBy("bank_name", share).agg(F.sum("_n").alias("_n"))
    preceding = (Window.unboundedPreceding, -1)
    better = Window.partitionBy("bank_name").orderBy(F.desc(share)).rowsBetween(*preceding)
    above = per_share.select("bank_name", share, F.coalesce(F.sum("_n").over(better), F.lit(0)).alias("_above"))
    higher = Window.partitionBy("bank_name", share).orderBy(F.desc(rating)).rowsBetween(*preceding)
    inside = pairs.withColumn("_inside", F.coalesce(F.sum("_n").over(higher), F.lit(0)))
    keys = {c: c for c in ("bank_name", share)}
    placed = lookup(inside, above, keys, [rating])
    ranks = placed.select("bank_name", share, rating, (F.col("_above") + F.col("_inside") + 1).alias("branch_rank"))
    return lookup(branches, ranks, keys | {rating: rating}, ["branch_name", "city"])


def top_rows(report: DataFrame, count: str, name: str, n: int = 8) -> DataFrame:
    """The ``n`` largest rows of a report."""
    return report.orderBy(F.desc(count), F.asc_nulls_first(name)).limit(n)


def metric_correlations(main: DataFrame) -> DataFrame:
    return correlation_matrix(main, METRIC_COLUMNS)


def distinct_counts(main: DataFrame) -> DataFrame:
    return main.agg(
        F.countDistinct("bank_name").alias("banks"),
        F.countDistinct("branch_name").alias("branches"),
        F.countDistinct("city").alias("cities"),
    )
