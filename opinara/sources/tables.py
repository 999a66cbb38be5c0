"""Views over the given tables that stand for the review inputs."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opinara import fixed_values as fixed
from opinara.operators.small import small_table
from opinara.plans.warehouse import calendar, sentiment_dimension
from opinara.sources.files import spread


SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double,"
    " o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double,"
    " l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string,"
    " l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
    "pages": "page_id bigint, url string, html string",
    "labels": "doc_id bigint, quality int, toxic int",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
}


def load(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{folder}/{name}.parquet")


def load_texts(spark: SparkSession, folder: str, name: str, key: str) -> DataFrame:
    return spread(load(spark, folder, name), key)


def reviews_raw(spark: SparkSession, folder: str) -> DataFrame:
    """Raw reviews from documents and labels, with a unique ``review_seq``."""
    docs, labels = load_texts(spark, folder, "documents", "doc_id"), load(spark, folder, "labels")
    doc = F.col("doc_id")
    rating = (
        F.when(F.col("quality") == 1, 4 + doc % 2)
        .when(F.col("quality") == 0, 1 + doc % 2)
        .when(doc % 5 == 0, 0)
        .otherwise(3)
    )
    day = F.date_add(F.lit("2023-01-01").cast("date"), ((doc * 7) % 731).cast("int"))
    city = F.element_at(F.array(*[F.lit(c) for c in fixed.CITIES]), (doc % 8 + 1).cast("int"))
    return docs.join(labels.select("doc_id", "quality"), "doc_id", "left").select(
        doc.alias("review_seq"),
        F.concat(F.lit("bank_"), (F.substring("source", 4, 20).cast("int") % 6).cast("string")).alias("bank_name"),
        F.concat_ws("_", "source", "lang").alias("branch_name"),
        F.concat(F.lit("Avenue "), (doc % 90).cast("string"), F.lit(", "), city).alias("branch_location"),
        F.col("text").alias("review_text"),
        rating.cast("double").alias("rating"),
        F.when(doc % 17 == 0, "il y a 2 mois").otherwise(day.cast("string")).alias("review_date"),
    )


def review_star(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """A star schema of reviews from the sales tables, with some null keys and ratings.

    Each line is a review: the market segment is the bank, the supplier the branch, the part
    type the topic, and the discount the score.
    """
    line, orders = spread(load(spark, folder, "lineitem"), "l_orderkey"), load(spark, folder, "orders")
    customer, part = load(spark, folder, "customer"), load(spark, folder, "part")
    supplier, nation, region = (load(spark, folder, t) for t in ("supplier", "nation", "region"))
    segments = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
    types = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]

    discount, tax = ((F.col(c) * 100 + 0.5).cast("int") for c in ("l_discount", "l_tax"))  # whole percent
    score = (discount * 20 - 100) / 100.0
    quantity = F.col("l_quantity").cast("int")
    text = F.when(F.col("l_partkey") % 7 != 0, F.col("p_name"))
    rating = F.when(F.col("l_partkey") % 19 != 0, quantity % 6)
    label = F.when(score >= 0.15, 1).when(score <= -0.15, 2).otherwise(3)
    bought = orders.join(customer, F.col("o_custkey") == F.col("c_custkey"))  # before the lines, of which there are more
    fact = (
        line.join(bought, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(part, F.col("l_partkey") == F.col("p_partkey"))
        .select(
            F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", quantity).alias("review_id"),
            F.when(F.col("c_custkey") % 23 != 0, F.array_position(F.array(*map(F.lit, segments)), F.col("c_mktsegment")))
            .cast("long")
            .alias("bank_id"),
            F.col("l_suppkey").alias("branch_id"),
            F.when(F.col("l_orderkey") % 29 != 0, F.date_format("o_orderdate", "yyyyMMdd").cast("long")).alias("date_id"),
            F.when(F.col("l_partkey") % 13 != 0, label).cast("long").alias("sentiment_id"),
            F.when(F.col("l_partkey") % 11 != 0, F.array_position(F.array(*map(F.lit, types)), F.col("p_type")))
            .cast("long")
            .alias("topic_id"),
            rating.alias("star_rating"),
            text.alias("review_text"),
            score.alias("ensemble_score"),
            F.least(F.abs(score) * 2, F.lit(1.0)).alias("sentiment_confidence"),
            (tax / 10.0).alias("topic_probability"),
            F.col("p_size").alias("word_count"),
            F.length("p_name").alias("char_count"),
            (quantity % 4).alias("positive_words_count"),
            (quantity % 3).alias("negative_words_count"),
            (F.col("l_returnflag") == "R").alias("has_exclamation"),
            (F.col("l_returnflag") == "A").alias("has_question"),
            (F.col("l_linestatus") == "O").alias("has_caps"),
            (
                0.5
                + F.when(F.coalesce(F.length(text) > 10, F.lit(False)), 0.3).otherwise(0.0)
                + F.when(F.coalesce(rating > 0, F.lit(False)), 0.2).otherwise(0.0)
            ).alias("data_quality_score"),
            ((discount * 10 - 50) / 100.0).alias("textblob_polarity"),
            ((tax * 20 - 80) / 100.0).alias("vader_compound"),
            ((discount - tax) / 100.0).alias("custom_sentiment_score"),
        )
    )
    branches = (
        supplier.join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            F.col("s_suppkey").alias("branch_id"),
            F.when(F.col("s_suppkey") % 31 != 0, F.col("s_name")).alias("branch_name"),
            F.col("n_name").alias("city"),
            F.col("r_name").alias("region"),
        )
    )
    return {
        "fact_reviews": fact,
        "dim_bank": small_table(spark, list(enumerate(segments, 1)), "bank_id long, bank_name string"),
        "dim_branch": branches,
        "dim_date": calendar(spark, "1995-01-01", "2001-12-31"),
        "dim_sentiment": sentiment_dimension(spark),
        "dim_topic": small_table(spark, list(enumerate(types, 1)), "topic_id long, topic_name string"),
    }
