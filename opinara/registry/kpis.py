"""Queries of the KPIs and dashboard calculations."""

from itertools import combinations

from pyspark.sql import functions as F

from opinara.plans import kpis, reports
from opinara.registry.core import query, rounded, sql_label_share, with_ctes
from opinara.registry.reports import (
    _BRANCHES, _NEGATIVE, _POSITIVE, MAIN, RATING_SQL, STAR, _avg, _label_counts, bank_summary as _bank_summary, main,
)
from opinara.sources.tables import review_star

_SUMMARY = f"""count(*) AS total_reviews, count(DISTINCT bank_name) AS total_banks,
  count(DISTINCT branch_name) AS total_branches, count(DISTINCT city) AS total_cities,
  {rounded('avg(star_rating)', 2)} AS avg_rating, {rounded('avg(ensemble_score)', 2)} AS avg_sentiment_score,
  {rounded('avg(data_quality_score)', 2)} AS avg_data_quality, {_POSITIVE}, {_NEGATIVE},
  {sql_label_share('neutral')} AS neutral_percentage, max(review_date) - min(review_date) AS date_range_days,
  {rounded('count(*) / ((max(review_date) - min(review_date)) / CAST(30 AS DOUBLE))', 2)} AS reviews_per_month"""
_BANKS = f"""
banks AS (SELECT bank_name, count(*) AS total_reviews, {_POSITIVE} FROM fact WHERE bank_name IS NOT NULL GROUP BY bank_name)"""
_TOP = """(SELECT bank_name FROM banks ORDER BY positive_percentage DESC, total_reviews DESC, bank_name LIMIT 1) AS best_bank,
  (SELECT bank_name FROM banks ORDER BY total_reviews DESC, bank_name LIMIT 1) AS most_reviewed_bank"""


@query("summary_metrics", with_ctes(MAIN, _BANKS, select=f"SELECT {_SUMMARY}, {_TOP} FROM main"))
def summary_metrics(spark, folder):
    star = review_star(spark, folder)
    return kpis.full_metrics(reports.main_dataset(star), reports.bank_summary(star))


@query("top_banks", with_ctes(MAIN, _BANKS, select=f"SELECT {_TOP}"))
def top_banks(spark, folder):
    return kpis.top_banks(_bank_summary(spark, folder))


@query(
    "small_metrics",
    with_ctes(
        MAIN,
        select=f"""SELECT count(*) AS total_reviews, count(DISTINCT bank_name) AS total_banks,
          {rounded('avg(star_rating)', 2)} AS avg_rating, {rounded('avg(ensemble_score)', 3)} AS avg_sentiment, {_POSITIVE}
          FROM main""",
    ),
)
def small_metrics(spark, folder):
    return kpis.small_metrics(main(spark, folder))


@query(
    "quick_kpis",
    with_ctes(
        MAIN,
        select=f"""SELECT count(bank_name) AS total_reviews, {_avg(avg_rating='star_rating', avg_sentiment='ensemble_score')}
          FROM main""",
    ),
)
def quick_kpis(spark, folder):
    return kpis.quick_kpis(main(spark, folder))


@query(
    "rating_by_bank",
    with_ctes(MAIN, select=f"SELECT bank_name, {_avg(avg_rating='star_rating')} FROM main GROUP BY bank_name"),
)
def rating_by_bank(spark, folder):
    return kpis.rating_by_bank(main(spark, folder))


@query(
    "count_by_sentiment",
    with_ctes(MAIN, select="SELECT sentiment_label, count(*) AS review_count FROM main GROUP BY sentiment_label"),
)
def count_by_sentiment(spark, folder):
    return kpis.count_by_sentiment(main(spark, folder))


_INDEX_BASE = f"""
b AS (SELECT bank_name, count(*) AS n, {_label_counts('{}')}, avg(star_rating) AS r, {_POSITIVE} FROM fact GROUP BY bank_name)"""


@query(
    "bank_indices",
    with_ctes(
        STAR, _INDEX_BASE,
        select=f"""SELECT bank_name, {rounded('(positive * 2 + neutral) / n')} AS satisfaction_score,
          {rounded('positive / nullif(positive + negative, 0)')} AS conversion_rate,
          {rounded('(r * 20 + positive_percentage) / 2')} AS quality_index FROM b""",
    ),
)
def bank_indices(spark, folder):
    return kpis.bank_indices(_bank_summary(spark, folder))


_MONTHLY = """
months AS (SELECT year, month, count(*) AS review_count,
  CAST(CAST(avg(ensemble_score) AS DECIMAL(38,10)) AS DOUBLE) AS avg_sentiment,
  printf('%04d-%02d', year, month) AS period FROM main WHERE review_date IS NOT NULL GROUP BY year, month),
trend AS (SELECT *, lag(avg_sentiment) OVER (ORDER BY year, month) AS previous FROM months)"""


@query(
    "sentiment_trend",
    with_ctes(
        MAIN, _MONTHLY,
        select=f"""SELECT year, month, review_count, {rounded('avg_sentiment')} AS avg_sentiment, period,
          {rounded('previous')} AS previous_sentiment,
          {rounded('(avg_sentiment - previous) * 100 / nullif(previous, 0)')} AS sentiment_trend FROM trend"""
        .replace(rounded("previous"), f"CASE WHEN previous IS NOT NULL THEN {rounded('previous')} END")
        .replace(
            rounded("(avg_sentiment - previous) * 100 / nullif(previous, 0)"),
            f"CASE WHEN previous IS NOT NULL THEN {rounded('(avg_sentiment - previous) * 100 / nullif(previous, 0)')} END",
        ),
    ),
)
def sentiment_trend(spark, folder):
    return kpis.sentiment_trend(kpis.monthly_scores(main(spark, folder)))


@query(
    "sentiment_alerts",
    with_ctes(
        MAIN, _MONTHLY,
        select=f"""SELECT year, month, review_count, {rounded('avg_sentiment')} AS avg_sentiment, period,
          {rounded('avg_sentiment - previous')} AS sentiment_change FROM trend
          WHERE avg_sentiment - previous < CAST(-0.02 AS DOUBLE)""",
    ),
)
def sentiment_alerts(spark, folder):
    return kpis.sentiment_alerts(kpis.monthly_scores(main(spark, folder)), drop=0.02)


@query(
    "year_over_year",
    with_ctes(
        MAIN, _MONTHLY,
        select=f"""SELECT m.year, m.month, m.review_count, {rounded('m.avg_sentiment')} AS avg_sentiment,
          p.review_count AS previous_count, CASE WHEN p.year IS NOT NULL THEN {rounded('p.avg_sentiment')} END AS previous_sentiment
          FROM months m LEFT JOIN months p ON p.year = m.year - 1 AND p.month = m.month""",
    ),
)
def year_over_year(spark, folder):
    return kpis.year_over_year(kpis.monthly_scores(main(spark, folder)))


_SCORE = f"count(*) AS review_count, {_avg(avg_sentiment='ensemble_score')}"


@query("by_quarter", with_ctes(MAIN, select=f"SELECT quarter, {_SCORE} FROM main GROUP BY quarter"))
def by_quarter(spark, folder):
    return kpis.by_quarter(main(spark, folder))


@query(
    "by_weekday",
    with_ctes(MAIN, select=f"SELECT isodow(review_date) AS day_of_week, {_SCORE} FROM main GROUP BY 1"),
)
def by_weekday(spark, folder):
    return kpis.by_weekday(main(spark, folder))


@query(
    "recent_activity",
    with_ctes(
        MAIN,
        select=f"""SELECT CAST(review_date AS VARCHAR) AS review_date, {_SCORE}, {_POSITIVE} FROM main
          WHERE review_date > (SELECT max(review_date) FROM main) - 7 GROUP BY main.review_date""",
    ),
)
def recent_activity(spark, folder):
    star = review_star(spark, folder)
    return kpis.recent_activity(reports.main_dataset(star), reports.last_rated_day(star))


@query(
    "rating_histogram",
    with_ctes(
        MAIN,
        select=f"""SELECT star_rating, count(*) AS review_count, {RATING_SQL.format('Non noté')} AS rating_category
          FROM main GROUP BY star_rating""",
    ),
)
def rating_histogram(spark, folder):
    return kpis.rating_histogram(main(spark, folder))


_QUARTILES = " UNION ALL ".join(
    f"SELECT bank_name, CAST({p} AS DOUBLE) AS point, {rounded(f'quantile_cont(ensemble_score, {p})')} AS value "
    "FROM main GROUP BY bank_name"
    for p in (0, 0.25, 0.5, 0.75, 1)
)


@query("score_quartiles", with_ctes(MAIN, select=_QUARTILES))
def score_quartiles(spark, folder):
    return kpis.score_quartiles(main(spark, folder))


@query(
    "price_percentiles",
    " UNION ALL ".join(
        f"SELECT l_returnflag, CAST({p} AS DOUBLE) AS point, {rounded(f'quantile_cont(l_extendedprice, {p})')} AS value "
        "FROM lineitem GROUP BY l_returnflag"
        for p in (0, 0.1, 0.5, 0.99, 1)
    ),
)
def price_percentiles(spark, folder):
    """Percentiles of a column with many different values."""
    from opinara.operators.statistics import exact_percentiles
    from opinara.sources.tables import load

    lines = load(spark, folder, "lineitem")
    return exact_percentiles(lines, "l_returnflag", "l_extendedprice", (0.0, 0.1, 0.5, 0.99, 1.0))


@query(
    "heavy_tailed_percentiles",
    " UNION ALL ".join(
        f"SELECT g, CAST({p} AS DOUBLE) AS point, {rounded(f'quantile_cont(v, {p})')} AS value FROM (SELECT CASE WHEN l_orderkey % 3 > 0 "
        "THEN 'most' WHEN l_orderkey % 7 > 0 THEN 'some' END AS g, CAST(1000000 AS DOUBLE) / (1 + l_partkey) AS v FROM lineitem) GROUP BY g"
        for p in (0, 0.25, 0.5, 0.9, 1)
    ),
)
def heavy_tailed_percentiles(spark, folder):
    """Most values are small and a few are large; one group has two thirds of the rows, one has no name."""
    from opinara.operators.statistics import exact_percentiles
    from opinara.sources.tables import load

    order = F.col("l_orderkey")
    name = F.when(order % 3 > 0, "most").when(order % 7 > 0, "some").alias("g")
    values = load(spark, folder, "lineitem").select(name, (F.lit(1e6) / (1 + F.col("l_partkey"))).alias("v"))
    return exact_percentiles(values, "g", "v", (0.0, 0.25, 0.5, 0.9, 1.0))


@query("score_by_length", with_ctes(MAIN, select=f"SELECT word_count // 10 * 10 AS words_from, {_SCORE} FROM main GROUP BY 1"))
def score_by_length(spark, folder):
    return kpis.score_by_length(main(spark, folder))


_TOPICS = f"""
topics AS (SELECT topic_name, count(*) AS review_count, {_POSITIVE} FROM main WHERE topic_name IS NOT NULL GROUP BY topic_name)"""


@query(
    "extreme_topics",
    with_ctes(
        MAIN, _TOPICS,
        select="""(SELECT *, 'positive' AS side FROM topics ORDER BY positive_percentage DESC, topic_name LIMIT 2) UNION ALL
          (SELECT *, 'negative' AS side FROM topics ORDER BY positive_percentage, topic_name LIMIT 2)""",
    ),
)
def extreme_topics(spark, folder):
    return kpis.extreme_topics(main(spark, folder), 2)


@query(
    "branch_ranking",
    with_ctes(
        STAR, f"\nbranches AS ({_BRANCHES})",
        select="""SELECT *, rank() OVER (PARTITION BY bank_name ORDER BY positive_percentage DESC, avg_rating DESC NULLS LAST)
          AS branch_rank FROM branches""",
    ),
)
def branch_ranking(spark, folder):
    branches = reports.branch_performance(review_star(spark, folder))
    return kpis.branch_ranking(branches.withColumn("avg_rating", F.round(F.round("avg_rating", 10), 6)))


@query(
    "top_eight_branches",
    with_ctes(
        STAR, f"\nbranches AS ({_BRANCHES})",
        select="""SELECT branch_name, CAST(sum(branches.total_reviews) AS BIGINT) AS total_reviews FROM branches
          GROUP BY branch_name ORDER BY 2 DESC, branch_name LIMIT 8""",
    ),
)
def top_eight_branches(spark, folder):
    branches = reports.branch_performance(review_star(spark, folder))
    report = branches.groupBy("branch_name").agg(F.sum("total_reviews").alias("total_reviews"))
    return kpis.top_rows(report, "total_reviews", "branch_name", 8)


_CORRELATIONS = " UNION ALL ".join(
    f"SELECT '{a}' AS metric_a, '{b}' AS metric_b, "
    + rounded(f"covar_pop({a}, {b}) / nullif(stddev_pop({a}) * stddev_pop({b}), 0)")
    + " AS correlation FROM main"
    for a, b in combinations(kpis.METRIC_COLUMNS, 2)
)


@query("metric_correlations", with_ctes(MAIN, select=_CORRELATIONS))
def metric_correlations(spark, folder):
    return kpis.metric_correlations(main(spark, folder))


@query(
    "distinct_counts",
    with_ctes(
        MAIN,
        select="""SELECT count(DISTINCT bank_name) AS banks, count(DISTINCT branch_name) AS branches,
          count(DISTINCT city) AS cities FROM main""",
    ),
)
def distinct_counts(spark, folder):
    return kpis.distinct_counts(main(spark, folder))
