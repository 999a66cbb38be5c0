"""Queries of the warehouse stage."""

from pyspark.sql import functions as F

from opinara import fixed_values as fixed
from opinara.operators.keys import insert_or_ignore
from opinara.operators.lineage import cut_lineage
from opinara.operators.lookup import lookup
from opinara.operators.small import small_table
from opinara.plans import reports, warehouse
from opinara.registry.collection import run_folder
from opinara.registry.core import REVIEWS_RAW, query, rounded, with_ctes
from opinara.registry.reports import _DAYS, _MONTHS, STAR
from opinara.sources import schemas
from opinara.sources.tables import load, review_star, reviews_raw
from opinara.sources.versions import current_table

# Reviews with scores and some null parts, for the narrow load.
_INPUT = f"""{REVIEWS_RAW},
loaded AS (SELECT review_seq, CASE WHEN review_seq % 37 <> 0 THEN bank_name END AS bank_name, branch_name,
  CASE WHEN review_seq % 10 <> 0 THEN branch_location END AS branch_location, review_text, rating, review_date,
  CASE WHEN review_seq % 9 <> 0 THEN (review_seq % 41 - 20) / CAST(20 AS DOUBLE) END AS textblob_polarity,
  CAST(review_seq % 60 AS INT) AS word_count, length(review_text) AS char_count,
  CAST(contains(review_text, '!') AS INT) AS has_exclamation, CAST(contains(review_text, '?') AS INT) AS has_question,
  CAST(review_seq % 3 = 0 AS INT) AS has_caps FROM reviews_raw)"""


def loaded(spark, folder):
    seq = F.col("review_seq")
    return reviews_raw(spark, folder).withColumns(
        {
            "bank_name": F.when(seq % 37 != 0, F.col("bank_name")),
            "branch_location": F.when(seq % 10 != 0, F.col("branch_location")),
            "textblob_polarity": F.when(seq % 9 != 0, (seq % 41 - 20) / 20.0),
            "word_count": (seq % 60).cast("int"),
            "char_count": F.length("review_text"),
            "has_exclamation": F.contains("review_text", F.lit("!")),
            "has_question": F.contains("review_text", F.lit("?")),
            "has_caps": seq % 3 == 0,
        }
    )


def _key(*natural: str) -> str:
    parts = ", ".join(f"coalesce({c}, '\\N')" for c in natural)
    order = ", ".join(f"{c} NULLS FIRST" for c in natural)
    return f"row_number() OVER (ORDER BY substr(md5(concat_ws(chr(31), {parts})), 1, 4), {order})"


_CITY = "CASE " + " ".join(f"WHEN contains(branch_location, '{c}') THEN '{c}'" for c in fixed.CITIES) + " END"
_REGIONS = {"Casablanca": "Casablanca-Settat", "Rabat": "Rabat-Salé-Kénitra", "Fès": "Fès-Meknès", "Meknès": "Fès-Meknès",
            "Marrakech": "Marrakech-Safi", "Tanger": "Tanger-Tétouan-Al Hoceïma", "Agadir": "Souss-Massa"}
_REGION = "CASE city " + " ".join(f"WHEN '{c}' THEN '{r}'" for c, r in _REGIONS.items()) + " END"
_DAY = "TRY_CAST(review_date AS DATE)"
_BANK = f"dim_bank AS (SELECT {_key('bank_name')} AS bank_id, bank_name FROM (SELECT DISTINCT bank_name FROM loaded WHERE bank_name IS NOT NULL))"
_BRANCH = f"""dim_branch AS (SELECT {_key('branch_name', 'branch_location')} AS branch_id, branch_name, branch_location,
  {_CITY} AS city FROM (SELECT DISTINCT branch_name, branch_location FROM loaded))"""
_DATE = f"""dim_date AS (SELECT {_key('review_date')} AS date_id, review_date, year({_DAY}) AS year, month({_DAY}) AS month,
  day({_DAY}) AS day FROM (SELECT DISTINCT review_date FROM loaded WHERE {_DAY} IS NOT NULL))"""


@query("bank_dimension", with_ctes(_INPUT, _BANK, select="SELECT * FROM dim_bank"))
def bank_dimension(spark, folder):
    return warehouse.bank_dimension(loaded(spark, folder))


@query("branch_dimension", with_ctes(_INPUT, _BRANCH, select=f"SELECT *, {_REGION} AS region FROM dim_branch"))
def branch_dimension(spark, folder):
    regions = small_table(spark, list(_REGIONS.items()), "city string, region string")
    return warehouse.branch_dimension(loaded(spark, folder), regions=regions)


@query("date_dimension", with_ctes(_INPUT, _DATE, select="SELECT * FROM dim_date"))
def date_dimension(spark, folder):
    return warehouse.date_dimension(loaded(spark, folder))


@query(
    "polarity_dimension",
    with_ctes(
        _INPUT,
        select=f"""SELECT DISTINCT {rounded('textblob_polarity')} AS textblob_polarity FROM loaded
          WHERE textblob_polarity IS NOT NULL""",
    ),
)
def polarity_dimension(spark, folder):
    return warehouse.polarity_dimension(loaded(spark, folder)).select("textblob_polarity")


def _dimensions(reviews):
    return {name: cut_lineage(table) for name, table in warehouse.star_dimensions(reviews).items()}


@query(
    "narrow_fact",
    with_ctes(
        _INPUT, _BANK, _BRANCH, _DATE,
        select=f"""SELECT review_seq AS review_id, bank_id, branch_id, date_id, CASE WHEN textblob_polarity IS NOT NULL THEN
          {rounded('textblob_polarity')} END AS polarity, review_text, rating, word_count, char_count, has_exclamation,
          has_question, has_caps FROM loaded l LEFT JOIN dim_bank USING (bank_name)
          LEFT JOIN dim_branch b ON b.branch_name IS NOT DISTINCT FROM l.branch_name
            AND b.branch_location IS NOT DISTINCT FROM l.branch_location
          LEFT JOIN dim_date USING (review_date)""",
    ),
)
def narrow_fact(spark, folder):
    reviews = loaded(spark, folder)
    dims = _dimensions(reviews)
    fact = warehouse.load_fact(reviews, dims)
    polarity = dims["dim_sentiment"].withColumnRenamed("textblob_polarity", "polarity")
    return lookup(fact, polarity, {"sentiment_id": "sentiment_id"}, ["review_id"]).drop("sentiment_id")


@query(
    "narrow_fact_by_shuffle",
    with_ctes(
        _INPUT, _BRANCH,
        select="""SELECT review_seq AS review_id, branch_id FROM loaded l LEFT JOIN dim_branch b
          ON b.branch_name IS NOT DISTINCT FROM l.branch_name AND b.branch_location IS NOT DISTINCT FROM l.branch_location""",
    ),
)
def narrow_fact_by_shuffle(spark, folder):
    """The lookup of a dimension that is too large to broadcast."""
    reviews = loaded(spark, folder)
    branches = warehouse.branch_dimension(reviews).select("branch_id", "branch_name", "branch_location")
    on = {"branch_name": "branch_name", "branch_location": "branch_location"}
    found = lookup(reviews, branches, on, spread_by=["review_seq"], small=False)
    return found.select(F.col("review_seq").alias("review_id"), "branch_id")


@query(
    "calendar",
    f"""SELECT CAST(strftime(d, '%Y%m%d') AS BIGINT) AS date_id, CAST(d AS VARCHAR) AS full_date, year(d) AS year,
      quarter(d) AS quarter, month(d) AS month, CASE month(d) {_MONTHS} END AS month_name, day(d) AS day,
      isodow(d) AS day_of_week, CASE isodow(d) {_DAYS} END AS day_name, weekofyear(d) AS week_of_year,
      CAST(isodow(d) >= 6 AS INT) AS is_weekend FROM (SELECT CAST(unnest(generate_series(CAST(min(o_orderdate) AS DATE),
      CAST(max(o_orderdate) AS DATE), INTERVAL 1 DAY)) AS DATE) AS d FROM orders)""",
)
def calendar(spark, folder):
    days = load(spark, folder, "orders").agg(F.min("o_orderdate").cast("date"), F.max("o_orderdate").cast("date")).head()
    return warehouse.calendar(spark, str(days[0]), str(days[1]))


# Two batches: every third review comes later. A member of the first batch keeps its key, a new one gets the next.
_BATCHES = f"""early AS (SELECT * FROM loaded WHERE review_seq % 3 <> 0 AND review_seq % 41 < 30),
bank_1 AS (SELECT {_key('bank_name')} AS bank_id, bank_name FROM (SELECT DISTINCT bank_name FROM early WHERE bank_name IS NOT NULL)),
branch_1 AS (SELECT {_key('branch_name', 'branch_location')} AS branch_id, branch_name, branch_location
  FROM (SELECT DISTINCT branch_name, branch_location FROM early)),
date_1 AS (SELECT {_key('review_date')} AS date_id, review_date FROM (SELECT DISTINCT review_date FROM early WHERE {_DAY} IS NOT NULL)),
bank_2 AS (SELECT * FROM bank_1 UNION ALL SELECT coalesce((SELECT max(bank_id) FROM bank_1), 0) + {_key('bank_name')}, bank_name
  FROM (SELECT DISTINCT bank_name FROM loaded WHERE bank_name IS NOT NULL) l WHERE bank_name NOT IN (SELECT bank_name FROM bank_1)),
branch_2 AS (SELECT * FROM branch_1 UNION ALL SELECT coalesce((SELECT max(branch_id) FROM branch_1), 0)
  + {_key('branch_name', 'branch_location')}, branch_name, branch_location FROM (SELECT DISTINCT branch_name, branch_location FROM loaded) l
  WHERE NOT EXISTS (SELECT 1 FROM branch_1 b WHERE b.branch_name IS NOT DISTINCT FROM l.branch_name
    AND b.branch_location IS NOT DISTINCT FROM l.branch_location)),
date_2 AS (SELECT * FROM date_1 UNION ALL SELECT coalesce((SELECT max(date_id) FROM date_1), 0) + {_key('review_date')}, review_date
  FROM (SELECT DISTINCT review_date FROM loaded WHERE {_DAY} IS NOT NULL) l WHERE review_date NOT IN (SELECT review_date FROM date_1))"""


def early(spark, folder):
    """The first batch; some members are in later reviews only."""
    return loaded(spark, folder).filter("review_seq % 3 <> 0 AND review_seq % 41 < 30")


def _two_batches(spark, folder):
    """The dimensions after the first batch and after the second."""
    first = _dimensions(early(spark, folder))
    highest = warehouse.star_highest(first)
    second = warehouse.extend_star(first, loaded(spark, folder), highest)
    return first, {name: cut_lineage(table) for name, table in second.items()}


@query("branch_keys_continue", with_ctes(_INPUT, _BATCHES, select=f"SELECT *, {_CITY} AS city FROM branch_2"))
def branch_keys_continue(spark, folder):
    return _two_batches(spark, folder)[1]["dim_branch"].drop("region")


@query(
    "fact_in_batches",
    with_ctes(
        _INPUT, _BATCHES,
        select="""SELECT review_seq AS review_id, bank_id, branch_id, date_id, review_text, rating, word_count, char_count,
          has_exclamation, has_question, has_caps FROM loaded l LEFT JOIN bank_2 USING (bank_name)
          LEFT JOIN branch_2 b ON b.branch_name IS NOT DISTINCT FROM l.branch_name
            AND b.branch_location IS NOT DISTINCT FROM l.branch_location
          LEFT JOIN date_2 USING (review_date)""",
    ),
)
def fact_in_batches(spark, folder):
    """The facts of the first batch, loaded with its dimensions, and those of the rest, loaded with the extended ones."""
    first, second = _two_batches(spark, folder)
    rows = loaded(spark, folder)
    is_early = F.expr("review_seq % 3 <> 0 AND review_seq % 41 < 30")
    facts = warehouse.load_fact(rows.filter(is_early), first).unionByName(warehouse.load_fact(rows.filter(~is_early), second))
    return facts.drop("sentiment_id")


@query(
    "highest_keys",
    with_ctes(
        _INPUT, _BATCHES,
        select="""SELECT 'dim_bank' AS table_name, max(bank_id) AS highest FROM bank_2 UNION ALL
          SELECT 'dim_branch', max(branch_id) FROM branch_2 UNION ALL SELECT 'dim_date', max(date_id) FROM date_2 UNION ALL
          SELECT 'dim_sentiment', count(DISTINCT textblob_polarity) FROM loaded""",
    ),
)
def highest_keys(spark, folder):
    first, second = _two_batches(spark, folder)
    return warehouse.star_highest(second, warehouse.star_highest(first))


_TOPIC_SEED = ", ".join(f"({n}, '{name}')" for n, (name, _) in enumerate(fixed.TOPIC_ROWS, 1))


@query(
    "topics_inserted_once",
    f"""SELECT topic_name, topic_id FROM (VALUES {_TOPIC_SEED}) AS t(topic_id, topic_name) UNION ALL
      SELECT topic_name, {len(fixed.TOPIC_ROWS)} + {_key('topic_name')} FROM (SELECT DISTINCT lower(p_type) AS topic_name FROM part)""",
)
def topics_inserted_once(spark, folder):
    """Part types as new topics, inserted twice; the first time they get the next keys."""
    new = load(spark, folder, "part").select(F.lower("p_type").alias("topic_name"))
    once = insert_or_ignore(warehouse.topic_dimension(spark), new, ["topic_name"], key="topic_id")
    return insert_or_ignore(once, new, ["topic_name"], key="topic_id").select("topic_name", "topic_id")


@query(
    "seeded_sentiments",
    f"""SELECT sentiment_label, {rounded('sentiment_score_min')} AS sentiment_score_min, n FROM (VALUES ('positive', 0.1),
      ('negative', -1.0), ('neutral', -0.1)) AS s(sentiment_label, sentiment_score_min) JOIN (SELECT CASE WHEN value > 60 THEN
      'positive' WHEN value < 20 THEN 'negative' ELSE 'neutral' END AS sentiment_label, count(*) AS n FROM events GROUP BY 1)
      USING (sentiment_label)""",
)
def seeded_sentiments(spark, folder):
    """An empty sentiment dimension is filled once, and events are counted by its members."""
    empty = spark.createDataFrame([], schemas.DIM_SENTIMENT)
    seed = warehouse.sentiment_dimension(spark)
    table = warehouse.seed_if_empty(warehouse.seed_if_empty(empty, seed, ["sentiment_label"]), seed, ["sentiment_label"])
    label = F.when(F.col("value") > 60, "positive").when(F.col("value") < 20, "negative").otherwise("neutral")
    counts = load(spark, folder, "events").groupBy(label.alias("sentiment_label")).agg(F.count(F.lit(1)).alias("n"))
    return counts.join(F.broadcast(table), "sentiment_label").select("sentiment_label", "sentiment_score_min", "n")


# Text values as a CSV would hold them, some of them bad, for the enriched load.
_RATING = """CASE WHEN review_seq % 13 = 0 THEN 'n/a' WHEN review_seq % 6 = 0 THEN NULL WHEN review_seq % 5 = 0 THEN '4.7'
  ELSE CAST(rating AS VARCHAR) END"""
_THEME = f"""CASE review_seq % 10 {' '.join(f"WHEN {n} THEN '{t}'" for n, (t, _) in enumerate(fixed.TOPIC_ROWS))}
  ELSE 'theme_a b' END"""
_ENRICHED = f"""{REVIEWS_RAW},
given AS (SELECT review_seq, bank_name, review_text, {_RATING} AS rating, CASE review_seq % 5 WHEN 0 THEN 'positive'
  WHEN 1 THEN 'mixed' WHEN 2 THEN 'neutral' WHEN 3 THEN 'negative' END AS sentiment_label, {_THEME} AS topic_label, review_date,
  CASE WHEN review_seq % 4 = 0 THEN '2024-02-29' END AS scraped_at,
  CASE WHEN review_seq % 11 = 0 THEN 'bad' ELSE CAST((review_seq % 200 - 100) / CAST(100 AS DOUBLE) AS VARCHAR) END AS ensemble_score,
  CAST(review_seq % 60 AS VARCHAR) AS word_count, CASE WHEN review_seq % 2 = 0 THEN 'true' END AS has_caps,
  concat('cleaned ', CAST(review_seq AS VARCHAR)) AS cleaned_text, concat(CAST(review_seq % 900 AS VARCHAR), '.0') AS char_count,
  CASE WHEN review_seq % 8 <> 0 THEN CAST(review_seq % 5 AS VARCHAR) END AS positive_words_count,
  CASE WHEN review_seq % 7 = 0 THEN 'NaN' ELSE CAST(review_seq % 4 AS VARCHAR) END AS negative_words_count,
  CAST(review_seq % 10 / CAST(10 AS DOUBLE) AS VARCHAR) AS sentiment_confidence,
  CASE WHEN review_seq % 3 > 0 THEN CAST(review_seq % 8 / CAST(8 AS DOUBLE) AS VARCHAR) END AS topic_probability,
  CAST((review_seq % 41 - 20) / CAST(20 AS DOUBLE) AS VARCHAR) AS textblob_polarity,
  CASE WHEN review_seq % 9 = 0 THEN 'nan' ELSE CAST((review_seq % 33 - 16) / CAST(16 AS DOUBLE) AS VARCHAR) END AS vader_compound,
  CAST(review_seq % 3 - 1 AS VARCHAR) AS custom_sentiment_score,
  CASE review_seq % 3 WHEN 0 THEN 'true' WHEN 1 THEN 'false' END AS has_exclamation,
  CASE WHEN review_seq % 19 = 0 THEN 'perhaps' ELSE 'false' END AS has_question FROM reviews_raw),
typed AS (SELECT *, CAST(trunc(TRY_CAST(rating AS DOUBLE)) AS INT) AS star_rating, TRY_CAST(ensemble_score AS DOUBLE) AS score,
  coalesce(TRY_CAST(review_date AS DATE), TRY_CAST(scraped_at AS DATE)) AS day,
  array_to_string(list_filter([CASE WHEN rating IS NOT NULL AND TRY_CAST(rating AS DOUBLE) IS NULL THEN 'rating' END,
    CASE WHEN TRY_CAST(ensemble_score AS DOUBLE) IS NULL THEN 'ensemble_score' END,
    CASE WHEN has_question = 'perhaps' THEN 'has_question' END], lambda x: x IS NOT NULL), ',')
    AS bad_columns FROM given)"""
_WHOLE = "CAST(TRY_CAST(nullif(lower({0}), 'nan') AS DOUBLE) AS INT) AS {0}"
_NUMBER = "CASE WHEN lower({0}) <> 'nan' THEN {1} END AS {0}"
_FLAG = "CAST(coalesce({0} = 'true', false) AS INT) AS {0}"
# The values of the enriched fact, all of them
_VALUES = f"""review_seq AS review_id, review_text, cleaned_text AS review_text_cleaned, CAST(day AS VARCHAR) AS review_date, star_rating,
  {', '.join(_WHOLE.format(c) for c in ('word_count', 'char_count', 'positive_words_count', 'negative_words_count'))},
  {rounded('score')} AS ensemble_score,
  {', '.join(_NUMBER.format(c, rounded(f'TRY_CAST({c} AS DOUBLE)')) for c in warehouse.NUMBER_COLUMNS if c != 'ensemble_score')},
  {', '.join(_FLAG.format(c) for c in warehouse.FLAG_COLUMNS)},
  {rounded('''CAST(0.5 AS DOUBLE) + CASE WHEN length(review_text) > 10 THEN CAST(0.3 AS DOUBLE) ELSE 0 END
    + CASE WHEN TRY_CAST(rating AS DOUBLE) > 0 THEN CAST(0.2 AS DOUBLE) ELSE 0 END''')} AS data_quality_score"""


def _typed(spark, folder):
    seq = F.col("review_seq")
    labels = F.array(*[F.lit(v) for v in ("positive", "mixed", "neutral", "negative", None)])
    themes = F.array(*[F.lit(name) for name, _ in fixed.TOPIC_ROWS], F.lit("theme_a b"))
    rows = reviews_raw(spark, folder).select(
        "review_seq",
        "bank_name",
        "review_text",
        F.when(seq % 13 == 0, "n/a").when(seq % 6 == 0, None).when(seq % 5 == 0, "4.7")
        .otherwise(F.col("rating").cast("string")).alias("rating"),
        F.get(labels, (seq % 5).cast("int")).alias("sentiment_label"),
        F.get(themes, (seq % 10).cast("int")).alias("topic_label"),
        "review_date",
        F.when(seq % 4 == 0, "2024-02-29").alias("scraped_at"),
        F.when(seq % 11 == 0, "bad").otherwise(((seq % 200 - 100) / 100.0).cast("string")).alias("ensemble_score"),
        (seq % 60).cast("string").alias("word_count"),
        F.when(seq % 2 == 0, "true").alias("has_caps"),
        F.concat(F.lit("cleaned "), seq.cast("string")).alias("cleaned_text"),
        F.concat((seq % 900).cast("string"), F.lit(".0")).alias("char_count"),
        F.when(seq % 8 != 0, (seq % 5).cast("string")).alias("positive_words_count"),
        F.when(seq % 7 == 0, "NaN").otherwise((seq % 4).cast("string")).alias("negative_words_count"),
        (seq % 10 / 10.0).cast("string").alias("sentiment_confidence"),
        F.when(seq % 3 > 0, (seq % 8 / 8.0).cast("string")).alias("topic_probability"),
        ((seq % 41 - 20) / 20.0).cast("string").alias("textblob_polarity"),
        F.when(seq % 9 == 0, "nan").otherwise(((seq % 33 - 16) / 16.0).cast("string")).alias("vader_compound"),
        (seq % 3 - 1).cast("string").alias("custom_sentiment_score"),
        F.when(seq % 3 == 0, "true").when(seq % 3 == 1, "false").alias("has_exclamation"),
        F.when(seq % 19 == 0, "perhaps").otherwise("false").alias("has_question"),
    )
    return warehouse.typed_fact(rows)


@query("rejected_rows", with_ctes(_ENRICHED, select="SELECT review_seq AS review_id, bad_columns FROM typed WHERE bad_columns <> ''"))
def rejected_rows(spark, folder):
    rejected = warehouse.rejected_rows(_typed(spark, folder))
    return rejected.select("review_id", F.array_join("bad_columns", ",").alias("bad_columns"))


_SENTIMENT_ID = "CASE sentiment_label WHEN 'positive' THEN 1 WHEN 'negative' THEN 2 WHEN 'neutral' THEN 3 ELSE 4 END"
_TOPIC_ID = "CASE topic_label " + " ".join(f"WHEN '{t}' THEN {n}" for n, (t, _) in enumerate(fixed.TOPIC_ROWS, 1)) + " ELSE 9 END"


@query(
    "enriched_fact",
    with_ctes(
        _ENRICHED,
        f"\nbanks AS (SELECT {_key('bank_name')} AS bank_id, bank_name FROM (SELECT DISTINCT bank_name FROM reviews_raw WHERE bank_name IS NOT NULL))",
        select=f"""SELECT {_VALUES}, bank_id, {_SENTIMENT_ID} AS sentiment_id, {_TOPIC_ID} AS topic_id,
          CASE WHEN day BETWEEN DATE '2023-01-01' AND DATE '2024-12-31' THEN CAST(strftime(day, '%Y%m%d') AS BIGINT) END AS date_id
          FROM typed LEFT JOIN banks USING (bank_name) WHERE bad_columns = ''""",
    ),
)
def enriched_fact(spark, folder):
    typed = _typed(spark, folder)
    dims = {
        "dim_bank": cut_lineage(warehouse.bank_dimension(reviews_raw(spark, folder))),
        "dim_sentiment": warehouse.sentiment_dimension(spark),
        "dim_topic": warehouse.topic_dimension(spark),
        "dim_date": warehouse.calendar(spark),
    }
    return warehouse.load_enriched_fact(typed, dims)


@query(
    "evolved_fact",
    with_ctes(
        _INPUT,
        select=f"""SELECT review_seq AS review_id, rating, CAST(NULL AS INT) AS star_rating, CAST(NULL AS DOUBLE) AS ensemble_score,
          word_count, has_caps, {len({f.name for f in schemas.FACT_NARROW} | {f.name for f in schemas.FACT_ADDED})} AS n_columns FROM loaded""",
    ),
)
def evolved_fact(spark, folder):
    reviews = loaded(spark, folder)
    fact = warehouse.evolve_fact(warehouse.load_fact(reviews, warehouse.star_dimensions(reviews)))
    return fact.select(
        "review_id", "rating", "star_rating", "ensemble_score", "word_count", "has_caps", F.lit(len(fact.columns)).alias("n_columns")
    )


@query(
    "replaced_fact",
    with_ctes(
        _ENRICHED,
        select=f"""SELECT {_VALUES}, bank_name, sentiment_label, topic_label, year(day) AS year, month(day) AS month
          FROM typed WHERE bad_columns = ''""",
    ),
)
def replaced_fact(spark, folder):
    """Every second row published first, then all of them in place of those, and what a reader sees then."""
    path = run_folder(spark, "fact")
    good = _typed(spark, folder).filter(F.size("bad_columns") == 0).drop("bad_columns")
    warehouse.replace_fact(good.filter("review_id % 2 = 0"), path)
    written = warehouse.replace_fact(good, path, replace=True)
    return current_table(spark, path, written.schema)


@query(
    "reviewer_dimension",
    f"""SELECT sha256(concat('user ', user_id)) AS reviewer_hash, concat('user ', user_id) AS reviewer_name,
      CAST(count(*) AS INT) AS review_count, CAST(CAST(min(ts) AS DATE) AS VARCHAR) AS first_review_date,
      CAST(CAST(max(ts) AS DATE) AS VARCHAR) AS last_review_date,
      {rounded('avg(CASE WHEN event_id % 6 > 0 THEN event_id % 6 END)', 2)} AS avg_rating FROM events GROUP BY user_id""",
)
def reviewer_dimension(spark, folder):
    reviews = load(spark, folder, "events").select(
        F.concat(F.lit("user "), F.col("user_id").cast("string")).alias("reviewer_name"),
        (F.col("event_id") % 6).cast("double").alias("rating"),
        F.col("ts").cast("date").cast("string").alias("review_date"),
    )
    return warehouse.reviewer_dimension(reviews).select(
        "reviewer_hash", "reviewer_name", "review_count", "first_review_date", "last_review_date", "avg_rating"
    )


@query(
    "audit_tables",
    f"""SELECT table_name, CAST(present AS INT) AS present, n_rows FROM (VALUES {', '.join(
        f"('{t}', {'false' if t == 'dim_reviewer' else 'true'})" for t in schemas.EXPECTED_TABLES)}) AS e(table_name, present)
      LEFT JOIN (SELECT 'fact_reviews' AS table_name, (SELECT count(*) FROM lineitem) AS n_rows UNION ALL
      SELECT 'dim_bank', 5 UNION ALL SELECT 'dim_branch', (SELECT count(*) FROM supplier) UNION ALL SELECT 'dim_date', 2557
      UNION ALL SELECT 'dim_sentiment', 4 UNION ALL SELECT 'dim_topic', 6) USING (table_name)""",
)
def audit_tables(spark, folder):
    return warehouse.audit_tables(spark, review_star(spark, folder))



@query(
    "audit_keys",
    with_ctes(
        STAR,
        select=" UNION ALL ".join(
            f"SELECT '{key}' AS key_column, count({column}) AS n_rows, {missing} AS n_unresolved FROM fact"
            for key, column, missing in [
                ("bank_id", "bank_name", "0"), ("branch_id", "l_orderkey", "0"),
                ("date_id", "review_date", "count(CASE WHEN review_date > DATE '1999-12-31' THEN 1 END)"),
            ]
        ),
    ),
)
def audit_keys(spark, folder):
    star = review_star(spark, folder)
    dims = {
        "bank_id": (star["dim_bank"], "bank_id"),
        "branch_id": (star["dim_branch"], "branch_id"),
        "date_id": (warehouse.calendar(spark, "1995-01-01", "1999-12-31"), "date_id"),
    }
    return warehouse.audit_keys(star["fact_reviews"], dims)


@query(
    "star_join",
    with_ctes(
        STAR, select="SELECT review_id, bank_name, branch_name, city, region, sentiment_label, topic_name, day_name FROM fact"
    ),
)
def star_join(spark, folder):
    """All facts with the names of their five dimensions."""
    flat = reports.join_dimensions(review_star(spark, folder))
    return flat.select("review_id", "bank_name", "branch_name", "city", "region", "sentiment_label", "topic_name", "day_name")


_STORED = {
    "dim_bank": [("bank_id", "bigint"), ("bank_name", "string")],
    "fact_reviews": [(f.name, f.dataType.simpleString()) for f in schemas.FACT_NARROW],
}
_STORED_ROWS = ", ".join(f"('{t}', '{c}', '{k}')" for t, columns in _STORED.items() for c, k in columns)


@query(
    "audit_stored",
    with_ctes(
        _INPUT,
        f"""
declared AS (SELECT * FROM (VALUES {_STORED_ROWS}) AS v(table_name, column_name, declared_type)),
added AS (SELECT *, column_name = 'word_count' AND table_name = 'fact_reviews' AS is_text,
  column_name = 'has_caps' AND table_name = 'fact_reviews' AS is_left_out FROM declared)""",
        select="""SELECT table_name, column_name, declared_type, 1 AS some_right, CAST(is_text AS INT) AS some_other,
          CAST(is_left_out AS INT) AS some_missing FROM added WHERE (SELECT count(*) FROM loaded) > 0
          UNION ALL SELECT 'fact_reviews', 'note', NULL, 0, 1, 0 FROM (SELECT count(*) AS n FROM loaded) WHERE n > 0""",
    ),
)
def audit_stored(spark, folder):
    """Dimension and fact as written, the fact with later files of another shape: a count as text, a flag left out, a new column."""
    reviews = loaded(spark, folder)
    dims = _dimensions(reviews)
    paths = {name: run_folder(spark, name) for name in _STORED}
    dims["dim_bank"].write.parquet(paths["dim_bank"])
    fact = warehouse.load_fact(reviews, dims).select(*(F.col(f.name).cast(f.dataType) for f in schemas.FACT_NARROW))
    fact.filter("review_id % 2 = 0").write.parquet(paths["fact_reviews"])
    later = fact.filter("review_id % 2 = 1").withColumns({"word_count": F.col("word_count").cast("string"), "note": F.lit("later")})
    later.drop("has_caps").write.mode("append").parquet(paths["fact_reviews"])
    declared = {"dim_bank": schemas.DIM_BANK, "fact_reviews": schemas.FACT_NARROW}
    found = warehouse.audit_stored(spark, paths, declared)
    return found.select("table_name", "column_name", "declared_type", *(
        (F.col(f"n_{c}") > 0).alias(f"some_{c}") for c in ("right", "other", "missing")
    ))


@query(
    "audit_columns",
    with_ctes(
        _INPUT,
        f"""
wanted AS (SELECT unnest({list(schemas.EXPECTED_FACT_COLUMNS)}) AS column_name)""",
        select="""SELECT column_name, CAST(column_name NOT IN ('topic_id', 'star_rating', 'ensemble_score') AS INT) AS before,
          1 AS after FROM wanted WHERE (SELECT count(*) FROM loaded) > 0""",
    ),
)
def audit_columns(spark, folder):
    """The expected columns in the narrow fact, and in the fact that was evolved from it."""
    reviews = loaded(spark, folder)
    fact = warehouse.load_fact(reviews, _dimensions(reviews))
    before, after = (warehouse.audit_columns(f).withColumnRenamed("present", n) for f, n in ((fact, "before"), (warehouse.evolve_fact(fact), "after")))
    return before.join(after, "column_name")
