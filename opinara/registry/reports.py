"""Queries of the reporting datasets, over the star schema of the sales tables or over flat reviews."""

import uuid

from pyspark.sql import functions as F

from opinara import fixed_values as fixed
from opinara.operators.lineage import checkpoint_folder
from opinara.plans import reports
from opinara.plans.filters import Filters, apply_filters
from opinara.plans.publishing import publish_reports
from opinara.registry.core import (
    ORACLES, REVIEWS_RAW, query, rounded, sql_label_share, sql_share, sql_words, with_ctes,
)
from opinara.sources.tables import load, review_star, reviews_raw

_MONTHS = " ".join(f"WHEN {n} THEN '{m}'" for n, m in enumerate(fixed.MONTH_NAMES, 1))
_DAYS = " ".join(f"WHEN {n} THEN '{d}'" for n, d in enumerate(fixed.DAY_NAMES, 1))

STAR = f"""
lines AS (SELECT *, CAST(l_quantity AS INT) AS q, {rounded('l_discount * 20 - 1')} AS score,
  CASE WHEN l_orderkey % 29 <> 0 THEN CAST(o_orderdate AS DATE) END AS d
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
  JOIN part ON l_partkey = p_partkey LEFT JOIN supplier ON l_suppkey = s_suppkey
  LEFT JOIN nation ON s_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey),
fact AS (SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey, q) AS review_id,
  CASE WHEN c_custkey % 23 <> 0 THEN c_mktsegment END AS bank_name,
  CASE WHEN l_suppkey % 31 <> 0 THEN s_name END AS branch_name, n_name AS city, r_name AS region,
  d AS review_date, year(d) AS year, month(d) AS month, CASE month(d) {_MONTHS} END AS month_name,
  quarter(d) AS quarter, CASE isodow(d) {_DAYS} END AS day_name, CAST(isodow(d) >= 6 AS INT) AS is_weekend,
  CASE WHEN l_partkey % 19 <> 0 THEN q % 6 END AS star_rating,
  CASE WHEN l_partkey % 13 <> 0 THEN CASE WHEN score >= CAST(0.15 AS DOUBLE) THEN 'positive'
    WHEN score <= CAST(-0.15 AS DOUBLE) THEN 'negative' ELSE 'neutral' END END AS sentiment_label,
  score AS ensemble_score, {rounded('least(abs(score) * 2, 1)')} AS sentiment_confidence,
  CASE WHEN l_partkey % 11 <> 0 THEN p_type END AS topic_name, {rounded('l_tax * 10')} AS topic_probability,
  p_size AS word_count, length(p_name) AS char_count, q % 4 AS positive_words_count, q % 3 AS negative_words_count,
  CAST(l_returnflag = 'R' AS INT) AS has_exclamation, CAST(l_returnflag = 'A' AS INT) AS has_question,
  CAST(l_linestatus = 'O' AS INT) AS has_caps,
  CAST(0.5 AS DOUBLE) + CASE WHEN l_partkey % 7 <> 0 AND length(p_name) > 10 THEN CAST(0.3 AS DOUBLE) ELSE 0 END
    + CASE WHEN l_partkey % 19 <> 0 AND q % 6 > 0 THEN CAST(0.2 AS DOUBLE) ELSE 0 END AS data_quality_score,
  CASE WHEN l_partkey % 7 <> 0 THEN p_name END AS review_text,
  {rounded('l_discount * 10 - CAST(0.5 AS DOUBLE)')} AS textblob_polarity,
  {rounded('l_tax * 20 - CAST(0.8 AS DOUBLE)')} AS vader_compound,
  {rounded('l_discount - l_tax')} AS custom_sentiment_score, l_orderkey FROM lines)"""
MAIN = STAR + ",\nmain AS (SELECT * EXCLUDE (l_orderkey) FROM fact WHERE star_rating IS NOT NULL)"

RATING_SQL = """CASE star_rating WHEN 5 THEN 'Excellent (5★)' WHEN 4 THEN 'Bon (4★)' WHEN 3 THEN 'Moyen (3★)'
  WHEN 2 THEN 'Mauvais (1-2★)' WHEN 1 THEN 'Mauvais (1-2★)' ELSE '{}' END"""
EMOJI_SQL = """CASE {} WHEN 'positive' THEN '😊 Positif' WHEN 'negative' THEN '😞 Négatif'
  WHEN 'neutral' THEN '😐 Neutre' ELSE '❓ Inconnu' END"""
_BUCKETS = f"{RATING_SQL.format('Non noté')} AS rating_category, {EMOJI_SQL.format('sentiment_label')} AS sentiment_emoji"
_LEVELS = """CASE WHEN data_quality_score >= CAST(0.8 AS DOUBLE) THEN 'Haute' WHEN data_quality_score >= CAST(0.6 AS DOUBLE)
  THEN 'Moyenne' WHEN data_quality_score >= CAST(0.4 AS DOUBLE) THEN 'Basse' ELSE 'Très basse' END AS quality_level,
  CASE WHEN word_count > 50 THEN 'Très détaillé (>50 mots)' WHEN word_count >= 20 THEN 'Détaillé (20-50 mots)'
  WHEN word_count >= 10 THEN 'Moyen (10-19 mots)' ELSE 'Court (<10 mots)' END AS text_length_category"""
_DATE = "CAST(review_date AS VARCHAR) AS review_date"


def _avg(**columns: str) -> str:
    return ", ".join(f"{rounded(f'avg({c})')} AS {name}" for name, c in columns.items())


def _label_counts(form: str, *labels: str) -> str:
    return ", ".join(
        f"count(CASE WHEN sentiment_label = '{n}' THEN 1 END) AS {form.format(n)}" for n in labels or fixed.LABELS
    )


_POSITIVE = sql_label_share("positive") + " AS positive_percentage"
_NEGATIVE = sql_label_share("negative") + " AS negative_percentage"
_POSITIVE_RAW = sql_label_share("positive", 6) + " AS positive_percentage"


def main(spark, folder):
    return reports.main_dataset(review_star(spark, folder))


@query(
    "main_dataset",
    with_ctes(MAIN, select=f"SELECT * REPLACE ({_DATE}), {_BUCKETS}, {_LEVELS} FROM main"),
)
def main_dataset(spark, folder):
    return reports.with_buckets(main(spark, folder))


_SIMPLE = """review_id, star_rating, ensemble_score, sentiment_confidence, topic_probability, word_count, char_count,
  positive_words_count, negative_words_count, has_exclamation, has_question, has_caps, data_quality_score, review_text,
  textblob_polarity, vader_compound, custom_sentiment_score, bank_name, sentiment_label"""


@query(
    "main_dataset_with_text",
    with_ctes(
        STAR,
        select=f"""SELECT {_SIMPLE}, topic_name, {_DATE}, year, month, month_name, quarter, {_BUCKETS} FROM fact
          WHERE review_text IS NOT NULL""",
    ),
)
def main_dataset_with_text(spark, folder):
    return reports.main_dataset_with_text(review_star(spark, folder))


@query("main_dataset_simple", with_ctes(MAIN, select=f"SELECT {_SIMPLE}, {_BUCKETS} FROM main"))
def main_dataset_simple(spark, folder):
    return reports.main_dataset_simple(review_star(spark, folder))


@query(
    "newest_reviews",
    with_ctes(
        MAIN,
        select=f"SELECT review_id, {_DATE} FROM main",
    ),
)
def newest_reviews(spark, folder):
    """All reviews in their order of display, which a comparison of rows can't see; a test looks at it."""
    return reports.main_dataset(review_star(spark, folder), newest_first=True).select("review_id", "review_date")


# ---------------------------------------------------------------- flat reviews

# Raw reviews with scores that come from text columns, some of them bad, as a flat input.
FLAT_INPUT = with_ctes(
    REVIEWS_RAW,
    select="""SELECT * EXCLUDE (rating), CASE WHEN review_seq % 13 = 0 THEN 'n/a' ELSE CAST(rating AS VARCHAR) END AS rating,
  CASE review_seq % 5 WHEN 0 THEN 'positive' WHEN 1 THEN 'Negative' WHEN 2 THEN 'neutral' WHEN 3 THEN 'positive' END
    AS sentiment_label,
  CASE WHEN review_seq % 11 = 0 THEN 'bad' ELSE CAST((review_seq % 200 - 100) / CAST(100 AS DOUBLE) AS VARCHAR) END
    AS ensemble_score,
  CASE WHEN review_seq % 6 <> 0 THEN concat('topic_', CAST(review_seq % 6 AS VARCHAR)) END AS topic_label FROM reviews_raw""",
)


def flat_input(spark, folder):
    seq = F.col("review_seq")
    labels = F.array(*[F.lit(v) for v in ("positive", "Negative", "neutral", "positive", None)])
    return reviews_raw(spark, folder).withColumns(
        {
            "rating": F.when(seq % 13 == 0, "n/a").otherwise(F.col("rating").cast("string")),
            "sentiment_label": F.get(labels, (seq % 5).cast("int")),
            "ensemble_score": F.when(seq % 11 == 0, "bad").otherwise(((seq % 200 - 100) / 100.0).cast("string")),
            "topic_label": F.when(seq % 6 != 0, F.concat(F.lit("topic_"), (seq % 6).cast("string"))),
        }
    )


_FLAT_DAY = "coalesce(TRY_CAST(review_date AS DATE), DATE '2024-01-01')"
FLAT = f"""
flat_input AS ({FLAT_INPUT}),
flat AS (SELECT bank_name, branch_name, coalesce(TRY_CAST(rating AS DOUBLE), 3) AS star_rating,
  coalesce(sentiment_label, 'neutral') AS sentiment_label, coalesce(TRY_CAST(ensemble_score AS DOUBLE), 0) AS sentiment_score,
  coalesce(topic_label, 'autres') AS topic_name, coalesce(review_text, 'Pas de texte') AS review_text,
  len({sql_words("coalesce(review_text, 'Pas de texte')")}) AS word_count,
  length(coalesce(review_text, 'Pas de texte')) AS char_count, {_FLAT_DAY} AS review_date, year({_FLAT_DAY}) AS year,
  month({_FLAT_DAY}) AS month, monthname({_FLAT_DAY}) AS month_name, quarter({_FLAT_DAY}) AS quarter FROM flat_input)"""


@query(
    "flat_dataset",
    with_ctes(
        FLAT,
        select=f"""SELECT * REPLACE ({_DATE}, {rounded('sentiment_score')} AS sentiment_score),
          {RATING_SQL.format('Non évalué')} AS rating_category, {EMOJI_SQL.format('lower(sentiment_label)')} AS sentiment_emoji
          FROM flat""",
    ),
)
def flat_dataset(spark, folder):
    return reports.flat_dataset(flat_input(spark, folder))


@query(
    "flat_bank_summary",
    with_ctes(
        FLAT,
        select=f"""SELECT bank_name, count(star_rating) AS total_reviews, {rounded('avg(star_rating)', 2)} AS avg_rating,
          {rounded('avg(sentiment_score)', 2)} AS avg_sentiment, {rounded('avg(word_count)', 2)} AS avg_word_count,
          {_POSITIVE}, {_NEGATIVE} FROM flat GROUP BY bank_name""",
    ),
)
def flat_bank_summary(spark, folder):
    return reports.flat_bank_summary(reports.flat_dataset(flat_input(spark, folder)))


@query(
    "flat_temporal_trends",
    with_ctes(
        FLAT,
        select=f"""SELECT year, month, month_name, count(star_rating) AS review_count, {rounded('avg(star_rating)', 2)}
          AS avg_rating, {rounded('avg(sentiment_score)', 2)} AS avg_sentiment FROM flat GROUP BY year, month, month_name""",
    ),
)
def flat_temporal_trends(spark, folder):
    return reports.flat_temporal_trends(reports.flat_dataset(flat_input(spark, folder)))


@query(
    "flat_topic_analysis",
    with_ctes(
        FLAT,
        select=f"""SELECT topic_name, count(star_rating) AS review_count, {rounded('avg(star_rating)', 2)} AS avg_rating,
          {rounded('avg(sentiment_score)', 2)} AS avg_sentiment, {_POSITIVE} FROM flat GROUP BY topic_name""",
    ),
)
def flat_topic_analysis(spark, folder):
    return reports.flat_topic_analysis(reports.flat_dataset(flat_input(spark, folder)))


@query(
    "flat_sentiment_counts",
    with_ctes(FLAT, select=f"SELECT bank_name, {_label_counts('{}')} FROM flat GROUP BY bank_name"),
)
def flat_sentiment_counts(spark, folder):
    return reports.sentiment_counts(reports.flat_dataset(flat_input(spark, folder)), "bank_name")


_SIMPLE_FLAT = f"""
flat_input AS ({FLAT_INPUT}),
simple AS (SELECT coalesce(bank_name, 'Banque Inconnue') AS "Banque", coalesce(branch_name, 'Agence Inconnue') AS "Agence",
  coalesce(TRY_CAST(rating AS DOUBLE), 3) AS "Note", coalesce(sentiment_label, 'neutral') AS "Sentiment",
  coalesce(TRY_CAST(ensemble_score AS DOUBLE), 0) AS "Score_Sentiment", coalesce(topic_label, 'autres') AS "Sujet",
  coalesce(length(review_text), 0) AS "Longueur_Avis", coalesce(len({sql_words('review_text')}), 0) AS "Nb_Mots",
  '2024-06-01' AS "Date", 2024 AS "Annee", 6 AS "Mois" FROM flat_input)"""


@query(
    "simple_dataset",
    with_ctes(
        _SIMPLE_FLAT,
        select=f"""SELECT * REPLACE ({rounded('"Score_Sentiment"')} AS "Score_Sentiment"),
          CASE "Note" WHEN 5 THEN 'Excellent' WHEN 4 THEN 'Bon' WHEN 3 THEN 'Moyen' ELSE 'Faible' END AS "Categorie_Note",
          CASE lower("Sentiment") WHEN 'positive' THEN 'Positif 😊' WHEN 'negative' THEN 'Negatif 😞' ELSE 'Neutre 😐' END
          AS "Sentiment_Emoji" FROM simple""",
    ),
)
def simple_dataset(spark, folder):
    return reports.simple_dataset(flat_input(spark, folder))


@query(
    "simple_bank_summary",
    with_ctes(
        _SIMPLE_FLAT,
        select=f"""SELECT "Banque", count("Note") AS "Total_Avis", {rounded('avg("Note")', 2)} AS "Note_Moyenne",
          {rounded('avg("Score_Sentiment")', 2)} AS "Sentiment_Moyen" FROM simple GROUP BY "Banque" """,
    ),
)
def simple_bank_summary(spark, folder):
    return reports.simple_bank_summary(reports.simple_dataset(flat_input(spark, folder)))


@query(
    "fill_defaults",
    """SELECT event_id, coalesce(TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE), 0) AS sentiment_score,
      coalesce(CASE WHEN event_id % 3 <> 0 THEN event_type END, 'Banque Inconnue') AS bank_name, 3 AS star_rating FROM events""",
)
def fill_defaults(spark, folder):
    events = load(spark, folder, "events").select(
        "event_id",
        F.get_json_object("props", "$.k").alias("sentiment_score"),
        F.when(F.col("event_id") % 3 != 0, F.col("event_type")).alias("bank_name"),
    )
    wanted = {"sentiment_score": 0.0, "bank_name": "Banque Inconnue", "star_rating": 3}
    return reports.fill_or_add(events, wanted)


# ---------------------------------------------------------------- grouped reports

_BANK = f"""bank_name, count(*) AS total_reviews, {_avg(avg_rating='star_rating', avg_sentiment_score='ensemble_score')},
  {_label_counts('{}_reviews')}, {_POSITIVE}, {_avg(avg_word_count='word_count', avg_data_quality='data_quality_score')}"""


@query(
    "bank_summary",
    with_ctes(
        STAR,
        select=f"""SELECT {_BANK}, {_NEGATIVE}, CAST(min(review_date) AS VARCHAR) AS first_review_date,
          CAST(max(review_date) AS VARCHAR) AS last_review_date FROM fact GROUP BY bank_name""",
    ),
)
def bank_summary(spark, folder):
    return reports.bank_summary(review_star(spark, folder)).drop("bank_id")


@query("bank_summary_known", with_ctes(STAR, select=f"SELECT {_BANK} FROM fact WHERE bank_name IS NOT NULL GROUP BY bank_name"))
def bank_summary_known(spark, folder):
    return reports.bank_summary_known(review_star(spark, folder)).drop("bank_id")


@query(
    "temporal_trends",
    with_ctes(
        STAR,
        select=f"""SELECT year, month, month_name, quarter, count(*) AS review_count,
          {_avg(avg_rating='star_rating', avg_sentiment='ensemble_score')}, {_label_counts('{}_count')}, {_POSITIVE}
          FROM fact GROUP BY year, month, month_name, quarter""",
    ),
)
def temporal_trends(spark, folder):
    return reports.temporal_trends(review_star(spark, folder))


@query(
    "topic_analysis",
    with_ctes(
        STAR,
        select=f"""SELECT topic_name, count(*) AS review_count, {_avg(avg_rating='star_rating', avg_sentiment='ensemble_score',
          avg_topic_probability='topic_probability')}, {_label_counts('{}_reviews', 'positive', 'negative')}, {_POSITIVE},
          {_avg(avg_word_count='word_count')} FROM fact WHERE topic_name IS NOT NULL GROUP BY topic_name""",
    ),
)
def topic_analysis(spark, folder):
    return reports.topic_analysis(review_star(spark, folder))


_BRANCHES = f"""SELECT bank_name, branch_name, city, region, count(*) AS total_reviews,
  {_avg(avg_rating='star_rating', avg_sentiment_score='ensemble_score')}, {_label_counts('{}_reviews', 'positive', 'negative')},
  {_POSITIVE}, {_avg(avg_data_quality='data_quality_score')} FROM fact WHERE branch_name IS NOT NULL
  GROUP BY bank_name, branch_name, city, region HAVING count(*) >= 3"""


@query("branch_performance", with_ctes(STAR, select=_BRANCHES))
def branch_performance(spark, folder):
    return reports.branch_performance(review_star(spark, folder))


@query(
    "bank_topic_matrix",
    with_ctes(
        STAR,
        "\ntotals AS (SELECT bank_name, count(*) AS whole FROM fact GROUP BY bank_name)",
        select=f"""SELECT bank_name, topic_name, count(*) AS review_count, {_avg(avg_sentiment='ensemble_score')},
          {sql_share('count(*)', 'any_value(whole)')} AS topic_percentage_in_bank FROM fact JOIN totals USING (bank_name)
          WHERE topic_name IS NOT NULL GROUP BY bank_name, topic_name""",
    ),
)
def bank_topic_matrix(spark, folder):
    return reports.bank_topic_matrix(review_star(spark, folder))


def _sql_in_order(name: str) -> str:
    keys = [f"{c[1:]} DESC NULLS LAST" if c[0] == "-" else f"{c} NULLS FIRST" for c in reports.REPORT_ORDERS[name]]
    return f"SELECT *, row_number() OVER (ORDER BY {', '.join(keys)}) AS place FROM ({ORACLES[name]}) AS report"


def _register_in_order(name: str) -> None:
    @query(f"{name}_in_order", _sql_in_order(name))
    def in_order(spark, folder):
        """One of the reports of a single pass, with the place of each row."""
        report = reports.all_reports(review_star(spark, folder))[name]
        return reports.in_order(report.drop("bank_id"), name)


for _name in reports.REPORT_KEYS:
    _register_in_order(_name)


@query("main_dataset_in_order", _sql_in_order("main_dataset"))
def main_dataset_in_order(spark, folder):
    return reports.in_order(main_dataset(spark, folder), "main_dataset")


def _ordered_star(spark, folder):
    star = review_star(spark, folder)
    order = F.split("review_id", "-")[0].cast("long")
    return star | {"fact_reviews": star["fact_reviews"].withColumn("line_order", order)}


@query(
    "wordcloud_texts",
    with_ctes(
        STAR,
        select="""SELECT sentiment_label, topic_name, l_orderkey // 1000 AS piece,
          string_agg(review_text, ' ' ORDER BY l_orderkey, review_text) AS combined_text FROM fact
          WHERE length(review_text) > 10 GROUP BY ALL""",
    ),
)
def wordcloud_texts(spark, folder):
    return reports.wordcloud_texts(_ordered_star(spark, folder), "line_order")


@query(
    "wordcloud_texts_of_reviews",
    with_ctes(
        REVIEWS_RAW,
        select="""SELECT bank_name, review_seq // 50 AS piece, string_agg(review_text, ' ' ORDER BY review_seq) AS combined_text
          FROM reviews_raw GROUP BY ALL""",
    ),
)
def wordcloud_texts_of_reviews(spark, folder):
    from opinara.operators.gather import grouped_text

    return grouped_text(reviews_raw(spark, folder), ["bank_name"], "review_text", "review_seq", 50)


# Text in the order of review_id, which is text: every 200 places a block, cut at 3,000 bytes.
_PIECES = """
placed AS (SELECT sentiment_label, topic_name, review_text,
  row_number() OVER (ORDER BY sentiment_label NULLS FIRST, topic_name NULLS FIRST, review_id) AS p FROM fact WHERE length(review_text) > 10),
cuts AS (SELECT *, (p - 1) // {rows} AS block, coalesce(sum(strlen(review_text) + 1) OVER (PARTITION BY (p - 1) // {rows}, sentiment_label,
  topic_name ORDER BY p ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) // {bytes} AS cut FROM placed),
pieces AS (SELECT sentiment_label, topic_name, min(p) AS piece, count(*) AS n_texts,
  string_agg(review_text, ' ' ORDER BY p) AS combined_text FROM cuts GROUP BY sentiment_label, topic_name, block, cut)"""


@query("wordcloud_pieces", with_ctes(STAR, _PIECES.format(rows=200, bytes=3000), select="SELECT * FROM pieces"))
def wordcloud_pieces(spark, folder):
    return reports.wordcloud_pieces(review_star(spark, folder), rows_per_piece=200, bytes_per_piece=3000)


@query(
    "wordcloud_terms",
    with_ctes(
        STAR,
        select=f"""SELECT sentiment_label, topic_name, term, count(*) AS term_count FROM (SELECT sentiment_label, topic_name,
          unnest({sql_words('lower(review_text)')}) AS term FROM fact WHERE length(review_text) > 10) GROUP BY ALL""",
    ),
)
def wordcloud_terms(spark, folder):
    return reports.wordcloud_terms(review_star(spark, folder))


@query(
    "sentiment_counts_by_topic",
    with_ctes(STAR, select=f"SELECT topic_name, {_label_counts('{}')} FROM fact GROUP BY topic_name"),
)
def sentiment_counts_by_topic(spark, folder):
    star = review_star(spark, folder)
    return reports.sentiment_counts(reports.join_dimensions(star, ("dim_topic", "dim_sentiment")), "topic_name")


@query(
    "published_bank_summary",
    with_ctes(
        STAR,
        select=f"""SELECT coalesce(bank_name, 'Inconnu') AS bank_name, count(*) AS total_reviews,
          {rounded('avg(star_rating)', 2)} AS avg_rating, {rounded('avg(ensemble_score)', 2)} AS avg_sentiment_score,
          {_label_counts('{}_reviews')}, {_POSITIVE}, {_NEGATIVE}, {rounded('avg(word_count)', 2)} AS avg_word_count,
          {_avg(avg_data_quality='data_quality_score')}, CAST(min(review_date) AS VARCHAR) AS first_review_date,
          CAST(max(review_date) AS VARCHAR) AS last_review_date FROM fact GROUP BY bank_name""",
    ),
)
def published_bank_summary(spark, folder):
    return reports.publish(reports.bank_summary(review_star(spark, folder)).drop("bank_id"))


@query(
    "published_main_dataset",
    with_ctes(
        MAIN,
        select=f"""SELECT * REPLACE (coalesce(bank_name, 'Inconnu') AS bank_name, {_DATE}, coalesce(sentiment_label, 'unknown')
          AS sentiment_label, {rounded('ensemble_score', 2)} AS ensemble_score, {rounded('data_quality_score', 2)} AS data_quality_score,
          {rounded('custom_sentiment_score', 2)} AS custom_sentiment_score) FROM main""",
    ),
)
def published_main_dataset(spark, folder):
    return reports.publish(main(spark, folder))


_PUBLISHED = {
    "main_dataset": "fact WHERE star_rating IS NOT NULL", "bank_summary": "(SELECT DISTINCT bank_name FROM fact)",
    "temporal_trends": "(SELECT DISTINCT year, month FROM fact)",
    "topic_analysis": "(SELECT DISTINCT topic_name FROM fact WHERE topic_name IS NOT NULL)",
    "branch_performance": f"({_BRANCHES})",
    "bank_topic_matrix": "(SELECT DISTINCT bank_name, topic_name FROM fact WHERE bank_name IS NOT NULL AND topic_name IS NOT NULL)",
    "wordcloud_data": "pieces",
    "wordcloud_terms": f"""(SELECT DISTINCT sentiment_label, topic_name, unnest({sql_words('lower(review_text)')}) FROM fact
      WHERE length(review_text) > 10)""",
    "summary_metrics": "(SELECT 1)",
}


@query(
    "published_run",
    with_ctes(
        STAR,
        _PIECES.format(rows=1000, bytes=1 << 20),
        select=" UNION ALL ".join(
            f"SELECT '{name}' AS dataset, count(*) AS n_rows, 1 AS written FROM {source}" for name, source in _PUBLISHED.items()
        ),
    ),
)
def published_run(spark, folder):
    """All datasets written, and the list of them."""
    path = f"{checkpoint_folder(spark)}/opinara/reports-{uuid.uuid4().hex}"
    return publish_reports(review_star(spark, folder), path).select("dataset", "n_rows", "written")


# ---------------------------------------------------------------- custom queries


@query(
    "kpi_overview",
    with_ctes(
        MAIN,
        select=f"""SELECT count(*) AS total_reviews, {_avg(avg_rating='star_rating', avg_sentiment='ensemble_score')},
          {_POSITIVE_RAW} FROM main WHERE review_date >= (SELECT max(review_date) FROM main) - 30""",
    ),
)
def kpi_overview(spark, folder):
    star = review_star(spark, folder)
    return reports.kpi_overview(reports.main_dataset(star), reports.last_rated_day(star))


@query(
    "monthly_trend",
    with_ctes(
        MAIN,
        select=f"""SELECT CAST(CAST(date_trunc('month', review_date) AS DATE) AS VARCHAR) AS month, count(*) AS review_count,
          {_avg(avg_sentiment='ensemble_score', avg_rating='star_rating')} FROM main GROUP BY 1""",
    ),
)
def monthly_trend(spark, folder):
    return reports.monthly_trend(main(spark, folder))


@query(
    "bank_comparison",
    with_ctes(
        MAIN,
        select=f"""SELECT bank_name, count(*) AS total_reviews, {_avg(avg_rating='star_rating')}, {_POSITIVE_RAW},
          {_avg(avg_review_length='word_count')} FROM main GROUP BY bank_name HAVING count(*) >= 10""",
    ),
)
def bank_comparison(spark, folder):
    return reports.bank_comparison(main(spark, folder))


@query(
    "topic_sentiment",
    with_ctes(
        MAIN,
        select=f"""SELECT topic_name, sentiment_label, count(*) AS review_count, {_avg(avg_confidence='topic_probability')}
          FROM main WHERE topic_name IS NOT NULL GROUP BY topic_name, sentiment_label""",
    ),
)
def topic_sentiment(spark, folder):
    return reports.topic_sentiment(main(spark, folder))


@query(
    "regional_performance",
    with_ctes(
        MAIN,
        select=f"""SELECT region, city, count(*) AS total_reviews, {_avg(avg_rating='star_rating')}, {_POSITIVE_RAW}
          FROM main WHERE region IS NOT NULL AND city IS NOT NULL GROUP BY region, city HAVING count(*) >= 5""",
    ),
)
def regional_performance(spark, folder):
    return reports.regional_performance(main(spark, folder))


# ---------------------------------------------------------------- filters

_CHOSEN = Filters(banks=["AUTOMOBILE", "MACHINERY"], sentiments=["positive", "neutral"], min_rating=2,
                  excluded_topics=["PROMO"])


@query(
    "filtered_reviews",
    with_ctes(
        MAIN,
        select=f"""SELECT review_id, {_DATE} FROM main WHERE main.review_date <= DATE '2000-03-31'
          AND main.review_date >= DATE '1999-09-30' AND bank_name IN ('AUTOMOBILE', 'MACHINERY')
          AND sentiment_label IN ('positive', 'neutral') AND star_rating >= 2
          AND (topic_name IS NULL OR topic_name <> 'PROMO')""",
    ),
)
def filtered_reviews(spark, folder):
    return apply_filters(main(spark, folder), _CHOSEN, as_of="2000-03-31").select("review_id", "review_date")


@query(
    "filtered_city",
    with_ctes(
        MAIN,
        select="""SELECT city, topic_name, count(*) AS review_count FROM main WHERE review_date BETWEEN DATE '1996-01-01'
          AND DATE '1998-12-31' AND city = (SELECT min(n_name) FROM nation) AND topic_name IN ('LARGE', 'SMALL')
          GROUP BY city, topic_name""",
    ),
)
def filtered_city(spark, folder):
    city = load(spark, folder, "nation").agg(F.min("n_name")).head()[0]
    chosen = Filters(start="1996-01-01", end="1998-12-31", city=city, topics=["LARGE", "SMALL"])
    kept = apply_filters(main(spark, folder), chosen, as_of="1998-12-31")
    return kept.groupBy("city", "topic_name").agg(F.count(F.lit(1)).alias("review_count"))
