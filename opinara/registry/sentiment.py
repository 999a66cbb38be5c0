"""Queries of the sentiment stage. They use the fixture lexicon; texts are scored after cleaning."""

from pyspark.sql import functions as F

from opinara import fixed_values as fixed
from opinara.plans import cleaning, sentiment
from opinara.registry.core import (
    KEPT, PROCESSED, REVIEWS_RAW, TEST_LEXICON, TEST_NEGATORS, lexicon_values, query, rounded, sql_label_share, sql_share,
    sql_words, text_list, with_ctes,
)
from opinara.sources.seeds import lexicon
from opinara.sources.tables import load, reviews_raw

BOOSTERS, DAMPENERS = ["en", "it"], ["to", "re"]
VALENCE = {term: 4 * w for term, w in TEST_LEXICON.items()}
SUBJECTIVITY = {term: abs(w) for term, w in TEST_LEXICON.items()}


def plain(spark, folder):
    return cleaning.plain_tokens(cleaning.remove_duplicates(reviews_raw(spark, folder)))


def scored(spark, folder):
    """All sentiment columns with the fixture lexicons."""
    return sentiment.score_reviews(
        plain(spark, folder), TEST_LEXICON, TEST_LEXICON, SUBJECTIVITY, VALENCE, TEST_NEGATORS, score_on="cleaned_text"
    )


_BARE = r"""regexp_replace(regexp_replace(w, '^[.,!?;:''"-]+', ''), '[.,!?;:''"-]+$', '')"""
_STEPS = ""
for _n, _damp in enumerate(fixed.VALENCE_DAMPING, 1):
    _last, _from = f"v{_n - 1}", "weighted" if _n == 1 else f"step{_n - 1}"
    _STEPS += f"""
step{_n} AS (SELECT *, CASE WHEN b{_n} IS NULL OR b{_n} IN (SELECT term FROM lexicon) THEN {_last}
    ELSE ({_last} + CASE WHEN b{_n} IN ({text_list(BOOSTERS)}) THEN CAST(0.293 AS DOUBLE)
      WHEN b{_n} IN ({text_list(DAMPENERS)}) THEN CAST(-0.293 AS DOUBLE) ELSE 0 END * CAST({_damp} AS DOUBLE)
      * CASE WHEN {_last} < 0 THEN -1 ELSE 1 END)
      * CASE WHEN b{_n} IN ({text_list(TEST_NEGATORS)}) THEN CAST(-0.74 AS DOUBLE) ELSE 1 END END AS v{_n}
  FROM {_from}),"""


def sql_word_rows(name: str, words: str, source: str) -> str:
    """Word, its place, and the three words before it."""
    before = ", ".join(f"lag(w, {n}) OVER (PARTITION BY review_seq ORDER BY i) AS b{n}" for n in (1, 2, 3))
    return f"""
{name} AS (SELECT review_seq, w, i, {before} FROM (
  SELECT review_seq, unnest(ws) AS w, generate_subscripts(ws, 1) AS i FROM (
    SELECT review_seq, {words} AS ws FROM {source})))"""


_BARE_WORDS = f"""list_transform(list_filter(string_split(lower(cleaned_text), ' '), lambda w: length(w) > 1),
  lambda w: CASE WHEN length({_BARE}) > 2 THEN {_BARE} ELSE w END)"""


def sql_lexicon_score(name: str, rows: str, negators: list[str]) -> str:
    return f"""
{name}_signed AS (SELECT review_seq, CASE WHEN b1 IN ({text_list(negators)}) THEN -weight ELSE weight END AS s
  FROM {rows} JOIN lexicon ON w = term),
{name} AS (SELECT review_seq, coalesce(sum(s) / nullif(count(CASE WHEN s <> 0 THEN 1 END), 0), 0) AS custom_sentiment_score,
  count(CASE WHEN s > 0 THEN 1 END) AS positive_words_count, count(CASE WHEN s < 0 THEN 1 END) AS negative_words_count
  FROM {name}_signed GROUP BY review_seq)"""


SCORES = f"""{sql_word_rows('wordrows', sql_words('lower(cleaned_text)'), 'processed')},
{sql_lexicon_score('lexscore', 'wordrows', TEST_NEGATORS)},
{sql_word_rows('barerows', _BARE_WORDS, 'processed')},
polarity AS (SELECT review_seq, avg(weight) AS textblob_polarity, avg(abs(weight)) AS textblob_subjectivity
  FROM barerows JOIN lexicon ON w = term GROUP BY review_seq),
weighted AS (SELECT b.*, l.weight * 4 AS v0, min(CASE WHEN w = 'but' THEN i END) OVER (PARTITION BY review_seq) AS turn_at
  FROM barerows b LEFT JOIN lexicon l ON w = term AND w NOT IN ({text_list(BOOSTERS + DAMPENERS)})),{_STEPS}
valued AS (SELECT review_seq, coalesce(v3, 0) * CASE WHEN turn_at IS NULL OR i = turn_at THEN 1
  WHEN i < turn_at THEN CAST(0.5 AS DOUBLE) ELSE CAST(1.5 AS DOUBLE) END AS v FROM step3),
sums AS (SELECT review_seq, sum(v) AS plain, sum(CASE WHEN v > 0 THEN v + 1 ELSE 0 END) AS up,
  sum(CASE WHEN v < 0 THEN 1 - v ELSE 0 END) AS down, CAST(count(CASE WHEN v = 0 THEN 1 END) AS DOUBLE) AS neutral
  FROM valued GROUP BY review_seq),
marks AS (SELECT review_seq, least(len(regexp_extract_all(cleaned_text, '!')), 4) * CAST(0.292 AS DOUBLE) +
  CASE WHEN len(regexp_extract_all(cleaned_text, '\\?')) > 3 THEN CAST(0.96 AS DOUBLE)
  WHEN len(regexp_extract_all(cleaned_text, '\\?')) > 1 THEN len(regexp_extract_all(cleaned_text, '\\?')) * CAST(0.18 AS DOUBLE)
  ELSE 0 END AS m FROM processed),
moved AS (SELECT s.review_seq, plain + sign(plain) * m AS x, up + CASE WHEN up > down THEN m ELSE 0 END AS p,
  down + CASE WHEN down > up THEN m ELSE 0 END AS n, neutral AS z FROM sums s JOIN marks USING (review_seq)),
valence AS (SELECT review_seq, {rounded('x / sqrt(x * x + 15)', 4)} AS vader_compound,
  {rounded('coalesce(p / nullif(p + n + z, 0), 0)', 3)} AS vader_positive,
  {rounded('coalesce(z / nullif(p + n + z, 0), 0)', 3)} AS vader_neutral,
  {rounded('coalesce(n / nullif(p + n + z, 0), 0)', 3)} AS vader_negative FROM moved),
scores AS (SELECT p.review_seq, p.bank_name, p.branch_name, p.branch_location, p.review_text, p.review_date, p.rating,
  coalesce(textblob_polarity, 0) AS textblob_polarity, coalesce(textblob_subjectivity, 0) AS textblob_subjectivity,
  coalesce(vader_compound, 0) AS vader_compound, coalesce(vader_positive, 0) AS vader_positive,
  coalesce(vader_neutral, 0) AS vader_neutral, coalesce(vader_negative, 0) AS vader_negative,
  coalesce(custom_sentiment_score, 0) AS custom_sentiment_score, coalesce(positive_words_count, 0) AS positive_words_count,
  coalesce(negative_words_count, 0) AS negative_words_count
  FROM processed p LEFT JOIN polarity USING (review_seq) LEFT JOIN valence USING (review_seq)
  LEFT JOIN lexscore USING (review_seq)),
summed AS (SELECT *, CAST(0.25 AS DOUBLE) * textblob_polarity + CAST(0.35 AS DOUBLE) * vader_compound
  + CAST(0.40 AS DOUBLE) * custom_sentiment_score AS ensemble_score FROM scores),
byrating AS (SELECT *, CASE WHEN rating IS NULL OR rating = 0 THEN 'unknown' WHEN rating >= 4 THEN 'positive'
  WHEN rating <= 2 THEN 'negative' ELSE 'neutral' END AS rating_sentiment,
  CASE WHEN ensemble_score >= CAST(0.15 AS DOUBLE) THEN 'positive' WHEN ensemble_score <= CAST(-0.15 AS DOUBLE) THEN 'negative'
  ELSE 'neutral' END AS by_score FROM summed),
scored AS (SELECT *, CASE WHEN (by_score = 'positive' AND rating_sentiment = 'negative')
  OR (by_score = 'negative' AND rating_sentiment = 'positive') THEN rating_sentiment ELSE by_score END AS sentiment_label,
  least(abs(ensemble_score) * 2, 1) AS sentiment_confidence FROM byrating)"""
CTES = (REVIEWS_RAW, KEPT, PROCESSED, lexicon_values(TEST_LEXICON), SCORES)
_MEASURES = [
    "textblob_polarity", "textblob_subjectivity", "vader_compound", "vader_positive", "vader_neutral", "vader_negative",
    "custom_sentiment_score", "ensemble_score", "sentiment_confidence",
]
_ALL = ["review_seq", "positive_words_count", "negative_words_count", "sentiment_label", "rating_sentiment"]


def _select(names: list[str]) -> str:
    return ", ".join(f"{rounded(n)} AS {n}" if n in _MEASURES else n for n in names)


_LEX = ["review_seq", "custom_sentiment_score", "positive_words_count", "negative_words_count"]
_LEX_SQL = with_ctes(*CTES, select=f"SELECT {_select(_LEX)} FROM scores")


@query("lexicon_score", _LEX_SQL)
def lexicon_score(spark, folder):
    out = sentiment.add_lexicon_score(plain(spark, folder), TEST_LEXICON, TEST_NEGATORS, "cleaned_text")
    return out.select(*_LEX)


@query("lexicon_score_by_join", _LEX_SQL)
def lexicon_score_by_join(spark, folder):
    """The same by a join with the lexicon table, as used for long lexicons."""
    table = lexicon(spark, TEST_LEXICON)
    out = sentiment.add_lexicon_score(plain(spark, folder), table, TEST_NEGATORS, "cleaned_text", inline_terms=0)
    return out.select(*_LEX)


_TOKEN_ROWS = sql_word_rows(
    "tokenrows", f"CASE WHEN len(tokens) > 0 THEN tokens ELSE {sql_words('cleaned_text')} END", "processed"
)


@query(
    "lexicon_score_on_tokens",
    with_ctes(
        REVIEWS_RAW, KEPT, PROCESSED, lexicon_values(fixed.LEXICON), _TOKEN_ROWS,
        sql_lexicon_score("tokenscore", "tokenrows", fixed.NEGATORS),
        select=f"""SELECT review_seq, {rounded("coalesce(custom_sentiment_score, 0)")} AS custom_sentiment_score,
          coalesce(positive_words_count, 0) AS positive_words_count,
          coalesce(negative_words_count, 0) AS negative_words_count FROM processed LEFT JOIN tokenscore USING (review_seq)""",
    ),
)
def lexicon_score_on_tokens(spark, folder):
    """Built-in lexicon on the tokens."""
    return sentiment.add_lexicon_score(plain(spark, folder)).select(*_LEX)


_POL = ["review_seq", "textblob_polarity", "textblob_subjectivity"]


@query("polarity_subjectivity", with_ctes(*CTES, select=f"SELECT {_select(_POL)} FROM scores"))
def polarity_subjectivity(spark, folder):
    return sentiment.add_polarity(plain(spark, folder), TEST_LEXICON, SUBJECTIVITY).select(*_POL)


_VAL = ["review_seq", "vader_compound", "vader_positive", "vader_neutral", "vader_negative"]


@query("valence", with_ctes(*CTES, select=f"SELECT {_select(_VAL)} FROM scores"))
def valence(spark, folder):
    rules = {"boosters": BOOSTERS, "dampeners": DAMPENERS}
    return sentiment.add_valence(plain(spark, folder), VALENCE, TEST_NEGATORS, rules=rules).select(*_VAL)


_PLAIN_RULES = SCORES.replace(text_list(BOOSTERS), text_list(fixed.BOOSTERS)).replace(
    text_list(DAMPENERS), text_list(fixed.DAMPENERS)
).replace(text_list(BOOSTERS + DAMPENERS), text_list(fixed.BOOSTERS + fixed.DAMPENERS))
DEFAULT_CTES = (REVIEWS_RAW, KEPT, PROCESSED, lexicon_values(TEST_LEXICON), _PLAIN_RULES)


@query("sentiment_scores", with_ctes(*DEFAULT_CTES, select=f"SELECT {_select(_ALL + _MEASURES)} FROM scored"))
def sentiment_scores(spark, folder):
    return scored(spark, folder).select(*_ALL, *_MEASURES)


@query(
    "rating_labels",
    with_ctes(*DEFAULT_CTES, select="SELECT rating_sentiment, count(*) AS n FROM scored GROUP BY rating_sentiment"),
)
def rating_labels(spark, folder):
    from opinara.functions.labels import rating_label

    kept = cleaning.remove_duplicates(reviews_raw(spark, folder))
    return kept.groupBy(rating_label(F.col("rating")).alias("rating_sentiment")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "score_labels",
    """SELECT event_id, CASE WHEN x >= CAST(0.1 AS DOUBLE) THEN 'positive' WHEN x <= CAST(-0.1 AS DOUBLE) THEN 'negative'
      ELSE 'neutral' END AS label FROM (SELECT event_id, value / 50 - CAST(0.5 AS DOUBLE) AS x FROM events)""",
)
def score_labels(spark, folder):
    from opinara.functions.labels import score_label

    return load(spark, folder, "events").select("event_id", score_label(F.col("value") / 50 - 0.5).alias("label"))


@query(
    "label_distribution",
    with_ctes(
        *DEFAULT_CTES,
        select=f"""SELECT sentiment_label, count(*) AS n, {sql_share('count(*)', '(SELECT count(*) FROM scored)')}
          AS percentage FROM scored GROUP BY sentiment_label""",
    ),
)
def label_distribution(spark, folder):
    return sentiment.label_distribution(scored(spark, folder))


@query(
    "mean_scores",
    with_ctes(
        *DEFAULT_CTES,
        select=f"""SELECT sentiment_label, {rounded('avg(ensemble_score)')} AS ensemble_score,
          {rounded('avg(sentiment_confidence)')} AS confidence, {rounded('avg(textblob_polarity)')} AS textblob,
          {rounded('avg(vader_compound)')} AS vader, {rounded('avg(custom_sentiment_score)')} AS custom
          FROM scored WHERE sentiment_label IN ('positive', 'negative', 'neutral') GROUP BY sentiment_label""",
    ),
)
def mean_scores(spark, folder):
    return sentiment.mean_scores(scored(spark, folder))


_CORR = " UNION ALL ".join(
    f"SELECT '{c}' AS metric_a, 'rating' AS metric_b, "
    + rounded(f"covar_pop({c}, rating) / nullif(stddev_pop({c}) * stddev_pop(rating), 0)")
    + " AS correlation FROM scored"
    for c in sentiment.SCORE_COLUMNS
)


@query("rating_correlations", with_ctes(*DEFAULT_CTES, select=_CORR))
def rating_correlations(spark, folder):
    return sentiment.rating_correlations(scored(spark, folder))


@query(
    "sentiment_by_bank",
    with_ctes(
        *DEFAULT_CTES,
        select=f"""SELECT bank_name, count(*) AS total_reviews, {rounded('avg(ensemble_score)')} AS avg_sentiment_score,
          {rounded('avg(rating)')} AS avg_rating, count(CASE WHEN sentiment_label = 'positive' THEN 1 END) AS positive,
          count(CASE WHEN sentiment_label = 'negative' THEN 1 END) AS negative,
          count(CASE WHEN sentiment_label = 'neutral' THEN 1 END) AS neutral FROM scored GROUP BY bank_name""",
    ),
)
def sentiment_by_bank(spark, folder):
    out = sentiment.summary_by(scored(spark, folder), "bank_name")
    found = [
        F.coalesce(F.try_element_at("sentiment_distribution", F.lit(n)), F.lit(0)).alias(n) for n in fixed.LABELS
    ]
    return out.select("bank_name", "total_reviews", "avg_sentiment_score", "avg_rating", *found)


@query(
    "positive_share_by_bank",
    with_ctes(
        *DEFAULT_CTES,
        select=f"""SELECT bank_name, count(*) AS total_reviews, {rounded('avg(ensemble_score)', 3)} AS avg_sentiment_score,
          {sql_label_share('positive', 1)} AS positive_percentage FROM scored GROUP BY bank_name""",
    ),
)
def positive_share_by_bank(spark, folder):
    return sentiment.positive_share_by_bank(scored(spark, folder))
