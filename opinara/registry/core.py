"""The registry, and SQL text shared by the queries."""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DateType, DecimalType, DoubleType, FloatType

from opinara import fixed_values as fixed
from opinara.functions import text as tx

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
PLAIN: dict[str, Query] = {}
ORACLES: dict[str, str] = {}
PLACES = 6


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query; ``sql`` gives the same rows in DuckDB."""

    def register(function: Query) -> Query:
        PLAIN[name] = function
        QUERIES[name] = lambda spark, folder: comparable(function(spark, folder))
        if sql is not None:
            ORACLES[name] = sql
        return function

    return register


def six_places(value: Column) -> Column:
    """Half-up rounding to six places by way of ten, in whole numbers where they are large enough."""
    size = F.abs(value)
    ten = (size * 1e10 + 0.5).cast("long")
    quick = F.call_function("div", ten + 5000, F.lit(10_000)) / 1e6
    slow = F.round(F.round(size, 10), PLACES)
    rounded = F.when(size < 1e8, quick).otherwise(slow)
    return F.when(rounded == 0, F.lit(0.0)).when(value < 0, -rounded).otherwise(rounded)


def comparable(df: DataFrame) -> DataFrame:
    """Doubles to six places and dates as text, so that two engines show the same values."""
    columns = []
    for field in df.schema:
        value = F.col(field.name)
        if isinstance(field.dataType, DoubleType | FloatType | DecimalType):
            value = six_places(value.cast("double"))
        elif isinstance(field.dataType, DateType):
            value = value.cast("string")
        elif isinstance(field.dataType, BooleanType):
            value = value.cast("int")
        columns.append(value.alias(field.name))
    return df.select(*columns)


def text_literal(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def text_list(values) -> str:
    return ", ".join(text_literal(v) for v in values)


def rounded(value: str, places: int = PLACES) -> str:
    """SQL for half-up rounding by way of ten places, without a negative zero."""
    cast = f"CAST(round(CAST(CAST({value} AS DOUBLE) AS DECIMAL(38,10)), {places}) AS DOUBLE)"
    return f"(CASE WHEN {cast} = 0 THEN CAST(0 AS DOUBLE) ELSE {cast} END)"


def sql_share(part: str, whole: str) -> str:
    return rounded(f"({part}) * CAST(100 AS DOUBLE) / nullif({whole}, 0)", 2)


def sql_label_share(label: str, places: int = 2) -> str:
    part = f"count(CASE WHEN sentiment_label = '{label}' THEN 1 END)"
    return rounded(f"{part} * CAST(100 AS DOUBLE) / nullif(count(*), 0)", places)


def sql_replace(value: str, pattern: str, new: str) -> str:
    return f"regexp_replace({value}, {text_literal(pattern)}, {text_literal(new)}, 'g')"


# White space spelled out, and the cleaning steps one by one, in plain patterns.
SPACES = r"\t\n\x0B\f\r\x1C-\x1F \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
SENTENCE_END = rf"[.!?]+([{SPACES}]+|$)"
ODD_SPACE = r"[\x0B\x1C-\x1F\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}]"
EMAIL = r"[^\s\x{3000}]+@[^\s\x{3000}]+"
UNWANTED = rf"""[^{tx.WORD}\s.,!?;:'"-]"""


def sql_clean(value: str) -> str:
    out = sql_replace(f"lower({value})", ODD_SPACE, " ")
    for pattern in (tx.URL, EMAIL, tx.PHONE, tx.TAG, tx.EMOJI):
        out = sql_replace(out, pattern, "")
    out = sql_replace(sql_replace(out, UNWANTED, " "), r"\s+", " ")
    return f"coalesce(trim({out}, ' '), '')"


def sql_tokens(cleaned: str, stop_words=fixed.STOP_WORDS) -> str:
    found = f"regexp_extract_all(lower({cleaned}), {text_literal(tx.TOKEN)}, 0)"
    return (
        f"list_filter({found}, lambda t: regexp_matches(t, {text_literal(tx.KEPT_TOKEN)}) "
        f"AND NOT list_contains([{text_list(stop_words)}], t))"
    )


def sql_words(value: str) -> str:
    return f"list_filter(string_split_regex({value}, {text_literal(f'[{SPACES}]+')}), lambda w: w <> '')"


_CITY = " ".join(f"WHEN {n} THEN {text_literal(city)}" for n, city in enumerate(fixed.CITIES[:-1]))
REVIEWS_RAW = f"""
reviews_raw AS (
  SELECT d.doc_id AS review_seq,
    concat('bank_', CAST(CAST(substr(d.source, 4) AS INT) % 6 AS VARCHAR)) AS bank_name,
    concat(d.source, '_', d.lang) AS branch_name,
    concat('Avenue ', CAST(d.doc_id % 90 AS VARCHAR), ', ',
      CASE d.doc_id % 8 {_CITY} ELSE {text_literal(fixed.CITIES[-1])} END) AS branch_location,
    d.text AS review_text,
    CAST(CASE WHEN l.quality = 1 THEN 4 + d.doc_id % 2 WHEN l.quality = 0 THEN 1 + d.doc_id % 2
      WHEN d.doc_id % 5 = 0 THEN 0 ELSE 3 END AS DOUBLE) AS rating,
    CASE WHEN d.doc_id % 17 = 0 THEN 'il y a 2 mois'
      ELSE CAST(DATE '2023-01-01' + CAST((d.doc_id * 7) % 731 AS INT) AS VARCHAR) END AS review_date
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)"""

KEPT = """
kept AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY bank_name, review_text ORDER BY review_seq) AS rn FROM reviews_raw)
  WHERE rn = 1 AND review_text IS NOT NULL AND length(review_text) >= 10)"""

PROCESSED = f"""
cleaned AS (SELECT *, {sql_clean('review_text')} AS cleaned_text FROM kept),
processed AS (SELECT *, {sql_tokens('cleaned_text')} AS tokens FROM cleaned)"""

# Fixture lexicon for the given texts, which hold few words of the built-in one (fixed values).
TEST_LEXICON = {
    "the": 0.2, "and": 0.3, "is": 0.5, "que": -0.6, "was": -0.4, "with": 0.6, "of": -0.1, "der": 0.4, "die": -0.5,
    "les": 0.3, "el": 0.2, "und": -0.2, "cher": -0.4, "queue": -0.4,
}
TEST_NEGATORS = ["to", "pas", "la", "den"]


def with_ctes(*ctes: str, select: str) -> str:
    return "WITH " + ",".join(ctes) + "\n" + select


def lexicon_values(lexicon: dict[str, float], name: str = "lexicon") -> str:
    rows = ", ".join(f"({text_literal(t)}, CAST({w} AS DOUBLE))" for t, w in lexicon.items())
    return f"\n{name}(term, weight) AS (VALUES {rows})"
