"""Warehouse stage: dimensions, calendar, fact loads, schema evolution and audits."""

from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from opinara import fixed_values as fixed
from opinara.functions.casting import first_date, nan_to_null, to_date, to_number, to_whole
from opinara.functions.labels import quality_score
from opinara.operators.keys import add_dense_key, highest_keys, insert_or_ignore
from opinara.operators.lookup import lookup, which_are_small
from opinara.operators.small import small_table
from opinara.sources import schemas
from opinara.sources.files import list_files
from opinara.sources.versions import publish_version


def bank_dimension(reviews: DataFrame) -> DataFrame:
    banks = reviews.select("bank_name").filter("bank_name is not null").distinct()
    return add_dense_key(banks, ["bank_name"], "bank_id")


def branch_dimension(reviews: DataFrame, cities=fixed.CITIES, regions: DataFrame | None = None) -> DataFrame:
    """Distinct (name, location), with the known city named in the location and its region."""
    natural = ["branch_name", "branch_location"]
    city = F.coalesce(*[F.when(F.contains("branch_location", F.lit(c)), c) for c in cities])
    keyed = add_dense_key(reviews.select(*natural).distinct(), natural, "branch_id").withColumn("city", city)
    if regions is None:
        return keyed.withColumn("region", F.lit(None).cast("string"))
    return lookup(keyed, regions.select("city", "region"), {"city": "city"}, spread_by=["branch_id"])


def date_dimension(reviews: DataFrame) -> DataFrame:
    """Distinct date texts that hold a date."""
    parsed = reviews.select("review_date").distinct().withColumn("_day", to_date(F.col("review_date")))
    parts = parsed.filter(F.col("_day").isNotNull()).select(
        "review_date",
        F.year("_day").alias("year"),
        F.month("_day").alias("month"),
        F.dayofmonth("_day").alias("day"),
    )
    return add_dense_key(parts, ["review_date"], "date_id")


def polarity_dimension(reviews: DataFrame) -> DataFrame:
    """Distinct polarity values."""
    value = nan_to_null(F.col("textblob_polarity")).alias("textblob_polarity")
    return add_dense_key(
        reviews.select(value).filter("textblob_polarity is not null").distinct(), ["textblob_polarity"], "sentiment_id"
    )


def calendar(spark: SparkSession, start: str = fixed.CALENDAR_START, end: str = fixed.CALENDAR_END) -> DataFrame:
    """One row per day with French names, Monday as day 1 and the ISO week. ``date_id`` is yyyymmdd."""
    span = F.sequence(F.to_date(F.lit(start)), F.to_date(F.lit(end)))
    days = spark.range(1).select(F.explode(span).alias("full_date"))
    day = F.col("full_date")
    number = F.weekday(day) + 1

    def name(values: list[str], at: Column) -> Column:
        return F.element_at(F.array(*[F.lit(v) for v in values]), at)

    return days.select(
        F.date_format(day, "yyyyMMdd").cast("long").alias("date_id"),
        "full_date",
        F.year(day).alias("year"),
        F.quarter(day).alias("quarter"),
        F.month(day).alias("month"),
        name(fixed.MONTH_NAMES, F.month(day)).alias("month_name"),
        F.dayofmonth(day).alias("day"),
        number.alias("day_of_week"),
        name(fixed.DAY_NAMES, number).alias("day_name"),
        F.weekofyear(day).alias("week_of_year"),
        (number >= 6).alias("is_weekend"),
    )


def sentiment_dimension(spark: SparkSession) -> DataFrame:
    rows = [(n, *row) for n, row in enumerate(fixed.SENTIMENT_ROWS, 1)]
    return small_table(spark, rows, schemas.DIM_SENTIMENT)


def topic_dimension(spark: SparkSession, created_at: str | None = None) -> DataFrame:
    """The default topics with the keywords of their theme; the time of creation is given."""
    rows = [(n, name, text, fixed.THEMES.get(name)) for n, (name, text) in enumerate(fixed.TOPIC_ROWS, 1)]
    columns = "topic_id long, topic_name string, topic_description string, topic_keywords array<string>"
    topics = small_table(spark, rows, columns)
    return topics.withColumn("created_at", F.lit(created_at).cast("timestamp"))


def seed_if_empty(table: DataFrame, seed: DataFrame, natural: list[str]) -> DataFrame:
    """The table, or the seed rows when it has none."""
    return table if table.limit(1).count() else insert_or_ignore(table, seed, natural)


def reviewer_dimension(reviews: DataFrame, as_of: str | None = None) -> DataFrame:
    """Reviews, first and last date and mean rating per reviewer, keyed by the hash of the name."""
    day, stars = to_date(F.col("review_date")), nan_to_null(F.col("rating"))
    moment = F.lit(as_of).cast("timestamp")
    grouped = reviews.groupBy(F.sha2("reviewer_name", 256).alias("reviewer_hash")).agg(
        F.min("reviewer_name").alias("reviewer_name"),
        F.count(F.lit(1)).cast("int").alias("review_count"),
        F.min(day).alias("first_review_date"),
        F.max(day).alias("last_review_date"),
        F.avg(F.when(stars > 0, stars)).cast("decimal(3,2)").alias("avg_rating"),
    )
    keyed = add_dense_key(grouped.filter("reviewer_hash is not null"), ["reviewer_hash"], "reviewer_id")
    names = [f.name for f in schemas.DIM_REVIEWER]
    return keyed.withColumns({"created_at": moment, "updated_at": moment}).select(*names)


def star_dimensions(reviews: DataFrame) -> dict[str, DataFrame]:
    """The four dimensions that come out of scored reviews. Write them before loading facts:
    the load checks their sizes and reads them again."""
    return {
        "dim_bank": bank_dimension(reviews),
        "dim_branch": branch_dimension(reviews),
        "dim_date": date_dimension(reviews),
        "dim_sentiment": polarity_dimension(reviews),
    }


STAR_KEYS = {
    "dim_bank": ("bank_id", ["bank_name"]),
    "dim_branch": ("branch_id", ["branch_name", "branch_location"]),
    "dim_date": ("date_id", ["review_date"]),
    "dim_sentiment": ("sentiment_id", ["textblob_polarity"]),
}


def extend_star(stored: dict[str, DataFrame], reviews: DataFrame, highest: DataFrame | None = None) -> dict[str, DataFrame]:
    """The stored dimensions with the members that later reviews bring. Known members keep their keys and columns; new ones get
    the next keys. ``highest`` are the stored largest keys (``star_highest``). Write the results before the next step."""
    known = {r.table_name: r.highest for r in highest.collect()} if highest is not None else {}  # one row per table
    fresh = star_dimensions(reviews)
    return {
        table: insert_or_ignore(stored[table], fresh[table].drop(key), natural, key=key, highest=known.get(table))
        for table, (key, natural) in STAR_KEYS.items()
    }


def star_highest(dims: dict[str, DataFrame], before: DataFrame | None = None) -> DataFrame:
    """Per dimension the largest key that was ever given."""
    return highest_keys({table: (dims[table], key) for table, (key, _) in STAR_KEYS.items()}, before)


def load_fact(reviews: DataFrame, dims: dict[str, DataFrame], key: str = "review_seq") -> DataFrame:
    """Fact rows with the four dimension keys; a missing member leaves its key null."""
    out, small = reviews, which_are_small({table: dims[table] for table in STAR_KEYS})
    for table, (surrogate, natural) in STAR_KEYS.items():
        members = dims[table].select(surrogate, *natural)
        out = lookup(out, members, {c: c for c in natural}, [key], small=small[table])
    names = [f.name for f in schemas.FACT_NARROW if f.name != "review_id"]
    return out.select(F.col(key).alias("review_id"), *names)


WHOLE_COLUMNS = {
    "star_rating": "rating", "word_count": "word_count", "char_count": "char_count",
    "positive_words_count": "positive_words_count", "negative_words_count": "negative_words_count",
}
NUMBER_COLUMNS = [
    "ensemble_score", "sentiment_confidence", "topic_probability", "textblob_polarity", "vader_compound",
    "custom_sentiment_score",
]
FLAG_COLUMNS = ["has_exclamation", "has_question", "has_caps"]


def _column(df: DataFrame, name: str) -> Column:
    return F.col(name) if name in df.columns else F.lit(None).cast("string")


def typed_fact(rows: DataFrame, key: str = "review_seq") -> DataFrame:
    """Fact values in their types, plus ``bad_columns``: values that are there but do not fit."""
    values, bad = {}, []

    def put(name: str, source: str, value: Column) -> None:
        values[name] = value
        given = _column(rows, source)
        bad.append(F.when(given.isNotNull() & (F.lower(given.cast("string")) != "nan") & value.isNull(), F.lit(source)))

    for name, source in WHOLE_COLUMNS.items():
        put(name, source, to_whole(_column(rows, source)))
    for name in NUMBER_COLUMNS:
        put(name, name, to_number(_column(rows, name)))
    for name in FLAG_COLUMNS:
        put(name, name, _column(rows, name).try_cast("boolean"))
        values[name] = F.coalesce(values[name], F.lit(False))
    rating = to_number(_column(rows, "rating"))
    return rows.select(
        F.col(key).alias("review_id"),
        _column(rows, "bank_name").alias("bank_name"),
        _column(rows, "sentiment_label").alias("sentiment_label"),
        _column(rows, "topic_label").alias("topic_label"),
        _column(rows, "review_text").alias("review_text"),
        _column(rows, "cleaned_text").alias("review_text_cleaned"),
        first_date(_column(rows, "review_date"), _column(rows, "scraped_at")).alias("review_date"),
        quality_score(_column(rows, "review_text"), rating).alias("data_quality_score"),
        *[value.alias(name) for name, value in values.items()],
        F.array_compact(F.array(*bad)).alias("bad_columns"),
    )


def rejected_rows(typed: DataFrame) -> DataFrame:
    return typed.filter(F.size("bad_columns") > 0).select("review_id", "bad_columns")


def load_enriched_fact(typed: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    """Fact rows of the good rows. An unknown sentiment or topic gets the default member."""
    out = typed.filter(F.size("bad_columns") == 0).drop("bad_columns")
    out = out.withColumns({"_label": F.coalesce("sentiment_label", F.lit(fixed.DEFAULT_SENTIMENT))})
    steps = [
        ("dim_bank", "bank_id", "bank_name", "bank_name"),
        ("dim_sentiment", "sentiment_id", "_label", "sentiment_label"),
        ("dim_topic", "topic_id", "topic_label", "topic_name"),
        ("dim_date", "date_id", "review_date", "full_date"),
    ]
    small = which_are_small({table: dims[table] for table, *_ in steps})
    for table, surrogate, left, right in steps:
        out = lookup(out, dims[table].select(surrogate, right), {left: right}, ["review_id"], small=small[table])
    defaults = {
        "sentiment_id": default_key(dims["dim_sentiment"], "sentiment_label", fixed.DEFAULT_SENTIMENT, "sentiment_id"),
        "topic_id": default_key(dims["dim_topic"], "topic_name", fixed.DEFAULT_TOPIC, "topic_id"),
    }
    filled = out.withColumns({name: F.coalesce(name, value) for name, value in defaults.items()})
    return filled.drop("_label", "bank_name", "sentiment_label", "topic_label")


def default_key(table: DataFrame, natural: str, value: str, key: str) -> Column:
    """Key of the default member, null when there is none."""
    return table.filter(F.col(natural) == value).agg(F.min(key)).scalar()


def replace_fact(fact: DataFrame, path: str, replace: bool = False) -> DataFrame:
    """Publish the fact table, partitioned by month, as a version (``sources/versions.py``): readers see the old rows until all new
    ones are written. Rows that are there are only replaced on request."""
    parted = fact.withColumns({"year": F.year("review_date"), "month": F.month("review_date")})
    return publish_version(parted, path, replace, ["year", "month"])


def evolve_fact(fact: DataFrame) -> DataFrame:
    """The fact table with every column of the rich schema; new flags are false."""
    return schemas.add_missing(fact, schemas.FACT_ADDED, schemas.FACT_DEFAULTS)


def create_missing(spark: SparkSession, tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The tables, with empty topic and reviewer dimensions where they are missing."""
    wanted = {"dim_topic": schemas.DIM_TOPIC, "dim_reviewer": schemas.DIM_REVIEWER}
    return tables | {n: spark.createDataFrame([], s) for n, s in wanted.items() if n not in tables}


def empty_star(spark: SparkSession) -> dict[str, DataFrame]:
    """The star schema without rows."""
    rich = schemas.add_missing(spark.createDataFrame([], schemas.FACT_NARROW), schemas.FACT_ADDED)
    dims = {"dim_bank": schemas.DIM_BANK, "dim_branch": schemas.DIM_BRANCH, "dim_date": schemas.DIM_DATE,
            "dim_sentiment": schemas.DIM_SENTIMENT}
    return create_missing(spark, {"fact_reviews": rich} | {n: spark.createDataFrame([], s) for n, s in dims.items()})


def audit_tables(spark: SparkSession, tables: dict[str, DataFrame], expected=schemas.EXPECTED_TABLES) -> DataFrame:
    """Expected tables: whether each is there and its row count."""
    listed = small_table(spark, [(t, t in tables) for t in expected], "table_name string, present boolean")
    present = [t for t in expected if t in tables]
    if not present:
        return listed.withColumn("n_rows", F.lit(None).cast("long"))
    counts = None
    for name in present:
        one = tables[name].agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows")
        counts = one if counts is None else counts.unionByName(one)
    return listed.join(counts, "table_name", "left")


def audit_columns(fact: DataFrame, expected=schemas.EXPECTED_FACT_COLUMNS) -> DataFrame:
    rows = [(c, c in fact.columns) for c in expected]
    return small_table(fact.sparkSession, rows, "column_name string, present boolean")


def stored_columns(spark: SparkSession, path: str, at_once: int = 8) -> DataFrame:
    """file, column_name and stored_type of every data file of a Parquet table, from the footers alone. A footer of each file is
    read, ``at_once`` at a time; what comes to the driver is a row per file and column."""
    names = [r.path for r in list_files(spark, path, "*.parquet", nested=True).select("path").collect()]
    with ThreadPoolExecutor(at_once) as pool:
        schemas_of = pool.map(inheritable_thread_target(spark)(lambda name: spark.read.parquet(name).schema), names)
        rows = [(name, f.name, f.dataType.simpleString()) for name, schema in zip(names, schemas_of, strict=True) for f in schema]
    return small_table(spark, rows, "file string, column_name string, stored_type string")


def audit_stored(spark: SparkSession, paths: dict[str, str], declared: dict) -> DataFrame:
    """What is stored against what is declared: table_name, column_name, declared_type, and in how many of the table's files the
    column has that type (n_right), has another (n_other) or is missing (n_missing). A column that files have and no schema
    declares has a null declared_type and counts as another. Columns that the folders of a table are named after are not in files."""
    out = None
    for name, path in paths.items():
        stored = stored_columns(spark, path)
        n_files = stored.select("file").distinct().count()
        wanted = small_table(spark, [(f.name, f.dataType.simpleString()) for f in declared[name]], "column_name string, declared_type string")
        right = F.coalesce(F.col("stored_type") == F.col("declared_type"), F.lit(False))
        counts = stored.join(wanted, "column_name", "full").groupBy("column_name", "declared_type").agg(
            F.count_if(F.col("file").isNotNull() & right).alias("n_right"), F.count_if(F.col("file").isNotNull() & ~right).alias("n_other")
        )
        missing = F.when(F.col("declared_type").isNotNull(), F.lit(n_files) - F.col("n_right") - F.col("n_other")).otherwise(0)
        one = counts.select(F.lit(name).alias("table_name"), "column_name", "declared_type", "n_right", "n_other", missing.cast("long").alias("n_missing"))
        out = one if out is None else out.unionByName(one)
    return out


def audit_keys(fact: DataFrame, dims: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """Per dimension key of the fact: rows with the key and rows whose key is in no dimension row."""
    out = None
    for key, (table, natural) in dims.items():
        known = table.select(natural).distinct().withColumn("_known", F.lit(True))
        used = fact.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n"))
        joined = used.join(known, used[key] == known[natural], "left")
        one = joined.agg(
            F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"),
            F.coalesce(F.sum(F.when(F.col("_known").isNull(), F.col("n"))), F.lit(0)).alias("n_unresolved"),
        ).select(F.lit(key).alias("key_column"), "n_rows", "n_unresolved")
        out = one if out is None else out.unionByName(one)
    return out
