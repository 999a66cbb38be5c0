"""Reviews out of stored HTML pages.

A selector is a pattern with one group. Where several are given, the first one with any hit on
the page wins. An element runs from its opening tag to the next opening tag of the same kind.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opinara import fixed_values as fixed
from opinara.functions.casting import rating_from_label
from opinara.operators.dedupe import distinct_first, first_n

# Selectors of the review site (fixed values).
BRANCH_SELECTORS = [
    r'<h1[^>]*class="[^"]*DUwDvf[^"]*"[^>]*>([^<]*)',
    r'<h1[^>]*class="[^"]*fontHeadlineLarge[^"]*"[^>]*>([^<]*)',
    r"<h1[^>]*>([^<]*)",
]
LOCATION_SELECTORS = [
    r"""<button[^>]*data-item-id=["']address["'][^>]*>([^<]*)""",
    r"""<div[^>]*aria-label="[^"]*address[^"]*"[^>]*>([^<]*)""",
]
REVIEW_OPENINGS = [r'<div[^>]*class="[^"]*jftiEf[^"]*"[^>]*>', r'<div[^>]*class="[^"]*review[^"]*"[^>]*>']
RATING_SELECTORS = [r'<span[^>]*aria-label="([^"]*star[^"]*)"']
TEXT_SELECTORS = [
    r'<span[^>]*class="[^"]*wiI7pd[^"]*"[^>]*>([^<]*)',
    r'<span[^>]*class="[^"]*review-full-text[^"]*"[^>]*>([^<]*)',
]
DATE_SELECTORS = [
    r'<span[^>]*class="[^"]*rsqaWe[^"]*"[^>]*>([^<]*)',
    r'<span[^>]*class="[^"]*date[^"]*"[^>]*>([^<]*)',
]
PLACE_LINK = r'<a[^>]*href="(https://www\.google\.com/maps/place[^"]*)"'


def select_first(html: Column, selectors: list[str], default: str) -> Column:
    out = F
    for pattern in selectors:
        out = out.when(html.rlike(pattern), F.trim(F.regexp_extract(html, pattern, 1)))
    return out.otherwise(default)


def select_elements(html: Column, openings: list[str]) -> Column:
    """The elements of the first opening tag found, in page order."""
    out = F
    for pattern in openings:
        parts = F.split(html, pattern)
        out = out.when(F.size(parts) > 1, F.slice(parts, 2, 2_000_000_000))
    return out.otherwise(F.array().cast("array<string>"))


def extract_reviews(
    pages: DataFrame,
    max_reviews: int | None = None,
    branch=BRANCH_SELECTORS,
    location=LOCATION_SELECTORS,
    openings=REVIEW_OPENINGS,
    rating=RATING_SELECTORS,
    text=TEXT_SELECTORS,
    date=DATE_SELECTORS,
) -> DataFrame:
    """Reviews of pages (page_id, bank_name, html): all of them, or the first ``max_reviews`` elements of each page, counted
    before empty ones go."""
    html = F.col("html")
    found = select_elements(html, openings)
    elements = pages.select(
        "page_id",
        "bank_name",
        select_first(html, branch, fixed.UNKNOWN_BRANCH).alias("branch_name"),
        select_first(html, location, fixed.UNKNOWN_LOCATION).alias("branch_location"),
        F.posexplode(found if max_reviews is None else F.slice(found, 1, max_reviews)).alias("position", "element"),
    )
    element = F.col("element")
    reviews = elements.select(
        "page_id",
        "position",
        "bank_name",
        "branch_name",
        "branch_location",
        select_first(element, text, "").alias("review_text"),
        rating_from_label(select_first(element, rating, "")).alias("rating"),
        select_first(element, date, fixed.UNKNOWN_DATE).alias("review_date"),
    )
    return keep_reviews(reviews)


def keep_reviews(reviews: DataFrame) -> DataFrame:
    """Reviews with a rating or a text; an empty text becomes the default one."""
    text = F.coalesce(F.col("review_text"), F.lit(""))
    kept = reviews.filter((F.coalesce(F.col("rating"), F.lit(0.0)) != 0) | (text != ""))
    return kept.withColumn("review_text", F.when(text == "", fixed.NO_TEXT).otherwise(text))


def cap_reviews(reviews: DataFrame, branch: list[str], order: list[str], n: int):
    """First ``n`` elements of each branch, then only those with a rating or a text."""
    return keep_reviews(first_n(reviews, branch, order, n))


def links(pages: DataFrame, search: str, pattern: str = PLACE_LINK) -> DataFrame:
    """Link targets with their place in the crawl order: search, position (page_id and place on the page, from 0), url."""
    found = F.posexplode(F.regexp_extract_all("html", F.lit(pattern), F.lit(1))).alias("_nth", "url")
    exploded = pages.select(search, "page_id", found)
    return exploded.select(search, F.struct("page_id", F.col("_nth").alias("nth")).alias("position"), "url")


def distinct_links(found: DataFrame, search: str, n: int | None = None) -> DataFrame:
    """The different links of each search with the place where they were found first; ``n``: the first so many of a search."""
    firsts = distinct_first(found.filter("url <> ''"), [search, "url"], "position")
    return firsts if n is None else first_n(firsts, [search], ["position"], n)
