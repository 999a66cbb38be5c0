"""Queries of the collection stage, and of files in and out."""

import uuid

from pyspark.sql import functions as F

from opinara import fixed_values as fixed
from opinara.functions.casting import rating_from_label
from opinara.operators.lineage import checkpoint_folder
from opinara.registry.core import REVIEWS_RAW, query, rounded, text_list, text_literal, with_ctes
from opinara.registry.reports import MAIN, main
from opinara.plans import kpis
from opinara.sources import files, pages, schemas, seeds
from opinara.sources.tables import load, load_texts, reviews_raw


def run_folder(spark, name: str) -> str:
    """A new folder next to the checkpoints, which every executor can reach."""
    return f"{checkpoint_folder(spark)}/opinara/{name}-{uuid.uuid4().hex}"


@query(
    "crawl_queries",
    f"""SELECT s_name AS bank_name, city, replace(concat(s_name, ' ', city), ' ', '+') AS query
      FROM supplier, (SELECT unnest([{text_list(fixed.CITIES)}]) AS city)""",
)
def crawl_queries(spark, folder):
    return seeds.crawl_queries(load(spark, folder, "supplier").select(F.col("s_name").alias("bank_name")))


LINK = r'<a href="([^"]*)"'
_LINKS = f"""
found AS (SELECT p.page_id % 7 AS search, (p.page_id, generate_subscripts(l, 1) - 1) AS position, unnest(l) AS url
  FROM (SELECT page_id, regexp_extract_all(html, {text_literal(LINK)}, 1) AS l FROM pages) p),
firsts AS (SELECT search, url, min(position) AS position FROM found WHERE url <> '' GROUP BY search, url)"""


@query(
    "distinct_links",
    with_ctes(
        _LINKS,
        select="SELECT search, url, position[1] AS page_id, CAST(position[2] AS INT) AS nth FROM firsts",
    ),
)
def distinct_links(spark, folder):
    stored = load_texts(spark, folder, "pages", "page_id").withColumn("search", F.col("page_id") % 7)
    return pages.distinct_links(pages.links(stored, "search", LINK), "search").select("search", "url", "position.*")


# Selectors for the given pages, in order of preference (fixed values).
PAGE_BRANCH = [r'<h1 class="name">([^<]*)', r"<h1[^>]*>([^<]*)", r"<title>([^<]*)"]
PAGE_LOCATION = [r'<address>([^<]*)', r'<div class="ad">([^<]*)']
PAGE_OPENINGS = [r'<div class="review">', r"<p>"]
PAGE_TEXT = [r"^<b>([^<]*)", r"^([^<]*)"]
PAGE_RATING = [r"([0-9]+(?:\.[0-9]+)? stars)", r"([0-9]+)"]
PAGE_DATE = [r"<time>([^<]*)"]


def _first(value: str, selectors: list[str], default: str) -> str:
    cases = " ".join(
        f"WHEN regexp_matches({value}, {text_literal(p)}) THEN trim(regexp_extract({value}, {text_literal(p)}, 1), ' ')"
        for p in selectors
    )
    return f"CASE {cases} ELSE {text_literal(default)} END"


def _elements(openings: list[str]) -> str:
    cases = " ".join(
        f"WHEN len(string_split_regex(html, {text_literal(p)})) > 1 THEN string_split_regex(html, {text_literal(p)})[2:]"
        for p in openings
    )
    return f"CASE {cases} ELSE [] END"


_FIRST_NUMBER = "coalesce(TRY_CAST(regexp_extract({}, '([0-9]+(\\.[0-9]+)?)', 1) AS DOUBLE), 0)"


@query(
    "extract_reviews",
    with_ctes(
        f"""
raw_elements AS (SELECT page_id, {_first('html', PAGE_BRANCH, fixed.UNKNOWN_BRANCH)} AS branch_name,
  {_first('html', PAGE_LOCATION, fixed.UNKNOWN_LOCATION)} AS branch_location, {_elements(PAGE_OPENINGS)} AS els FROM pages),
elements AS (SELECT page_id, branch_name, branch_location, generate_subscripts(els, 1) - 1 AS position, unnest(els) AS element
  FROM raw_elements),
found AS (SELECT page_id, position, branch_name, branch_location, {_first('element', PAGE_TEXT, '')} AS t,
  {_FIRST_NUMBER.format(_first('element', PAGE_RATING, ''))} AS rating,
  {_first('element', PAGE_DATE, fixed.UNKNOWN_DATE)} AS review_date FROM elements)""",
        select="""SELECT page_id, position, 'bank' AS bank_name, branch_name, branch_location,
  CASE WHEN t = '' THEN 'No text' ELSE t END AS review_text, rating, review_date FROM found WHERE rating <> 0 OR t <> ''""",
    ),
)
def extract_reviews(spark, folder):
    stored = load_texts(spark, folder, "pages", "page_id").withColumn("bank_name", F.lit("bank"))
    return pages.extract_reviews(
        stored, branch=PAGE_BRANCH, location=PAGE_LOCATION, openings=PAGE_OPENINGS, rating=PAGE_RATING, text=PAGE_TEXT,
        date=PAGE_DATE,
    )


@query(
    "rating_from_label",
    f"""SELECT o_orderpriority, {_FIRST_NUMBER.format('o_orderpriority')} AS rating, count(*) AS n FROM orders
      GROUP BY ALL""",
)
def rating_of_priorities(spark, folder):
    orders = load(spark, folder, "orders")
    return orders.groupBy("o_orderpriority", rating_from_label(F.col("o_orderpriority")).alias("rating")).agg(
        F.count(F.lit(1)).alias("n")
    )


_EVENT_REVIEWS = """
e AS (SELECT event_id, event_type, user_id, CASE WHEN event_id % 4 = 0 THEN 0 ELSE event_id % 6 END AS rating,
  CASE WHEN event_id % 3 = 0 THEN NULL WHEN event_id % 3 = 1 THEN '' ELSE event_type END AS review_text FROM events)"""


def _event_reviews(spark, folder):
    event = F.col("event_id")
    return load(spark, folder, "events").select(
        "event_id",
        "event_type",
        "user_id",
        F.when(event % 4 == 0, 0).otherwise(event % 6).cast("double").alias("rating"),
        F.when(event % 3 == 1, "").when(event % 3 == 2, F.col("event_type")).alias("review_text"),
    )


_KEPT = """SELECT event_id, event_type, user_id, CAST(rating AS DOUBLE) AS rating,
  CASE WHEN coalesce(review_text, '') = '' THEN 'No text' ELSE review_text END AS review_text FROM {}
  WHERE rating <> 0 OR coalesce(review_text, '') <> ''"""


@query("keep_reviews", with_ctes(_EVENT_REVIEWS, select=_KEPT.format("e")))
def keep_reviews(spark, folder):
    return pages.keep_reviews(_event_reviews(spark, folder))


@query(
    "cap_reviews",
    with_ctes(
        _EVENT_REVIEWS,
        "\nfirsts AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY event_id) AS rn FROM e) "
        "WHERE rn <= 100)",
        select=_KEPT.format("firsts"),
    ),
)
def cap_reviews(spark, folder):
    return pages.cap_reviews(_event_reviews(spark, folder), ["event_type"], ["event_id"], fixed.MAX_REVIEWS_PER_BRANCH)


# ---------------------------------------------------------------- files

_RAW = "bank_name, branch_name, branch_location, review_text, rating, review_date"


@query("csv_round_trip", with_ctes(REVIEWS_RAW, select=f"SELECT {_RAW} FROM reviews_raw"))
def csv_round_trip(spark, folder):
    path = files.run_path(run_folder(spark, "csv"), "20250612_001641")
    files.write_csv(reviews_raw(spark, folder).drop("review_seq"), path)
    return files.read_csv(spark, path, schemas.REVIEWS_RAW)


@query(
    "csv_with_tokens",
    """SELECT array_to_string(list_filter(string_split(lower(p_name), ' '), lambda w: w <> ''), ' ') AS tokens,
      p_size AS word_count, CAST(NULL AS DOUBLE) AS rating, p_name AS review_text FROM part""",
)
def csv_with_tokens(spark, folder):
    """A list column through CSV, and a column that the file does not have."""
    path = run_folder(spark, "tokens")
    parts = load(spark, folder, "part").select(
        F.split(F.lower("p_name"), " ").alias("tokens"),
        F.col("p_size").alias("word_count"),
        F.col("p_name").alias("review_text"),
    )
    files.write_csv(parts, path)
    back = files.read_csv(spark, path, schemas.REVIEWS_CLEANED)
    return back.select(F.array_join("tokens", " ").alias("tokens"), "word_count", "rating", "review_text")


@query(
    "json_kpis",
    with_ctes(
        MAIN,
        select=f"""SELECT count(*) AS total_reviews, count(DISTINCT bank_name) AS total_banks,
          {rounded('avg(star_rating)', 2)} AS avg_rating, {rounded('avg(ensemble_score)', 3)} AS avg_sentiment,
          {rounded("count(CASE WHEN sentiment_label = 'positive' THEN 1 END) * CAST(100 AS DOUBLE) / count(*)", 2)}
          AS positive_percentage FROM main""",
    ),
)
def json_kpis(spark, folder):
    path = run_folder(spark, "kpis")
    row = kpis.small_metrics(main(spark, folder))
    files.write_kpis(row, path)
    return spark.read.schema(row.schema).json(path)


@query("table_round_trip", "SELECT event_id, event_type, value, props FROM events")
def table_round_trip(spark, folder):
    events = load(spark, folder, "events").select("event_id", "event_type", "value", "props")
    back = files.write_table(events, run_folder(spark, "events"), partition_by=["event_type"])
    return back.select("event_id", "event_type", "value", "props")


@query(
    "newest_input",
    """SELECT path FROM (SELECT concat('/data/', CASE doc_id % 3 WHEN 0 THEN 'bank_reviews_topics_' WHEN 1 THEN
      'bank_reviews_sentiment_' ELSE 'other_' END, CAST(doc_id AS VARCHAR), '.csv') AS path, n_chars AS modified, doc_id FROM documents)
      WHERE path LIKE '/data/bank_reviews_topics_%' ORDER BY modified DESC, path DESC LIMIT 1""",
)
def newest_input(spark, folder):
    kind = F.element_at(
        F.array(F.lit("bank_reviews_topics_"), F.lit("bank_reviews_sentiment_"), F.lit("other_")),
        (F.col("doc_id") % 3 + 1).cast("int"),
    )
    path = F.concat(F.lit("/data/"), kind, F.col("doc_id").cast("string"), F.lit(".csv"))
    listing = load(spark, folder, "documents").select(path.alias("path"), F.col("n_chars").alias("modified"))
    return files.newest(listing)


@query(
    "output_manifest",
    """SELECT 'events' AS dataset, count(*) AS n_rows, 'out/events' AS path FROM events UNION ALL
      SELECT 'nation', count(*), 'out/nation' FROM nation UNION ALL SELECT 'part', count(*), 'out/part' FROM part""",
)
def output_manifest(spark, folder):
    return files.manifest({t: load(spark, folder, t) for t in ("events", "nation", "part")}, "out")
