"""Normalising words by a stored table: each distinct word is worked out once, when it first comes up.

The table has two columns, word and normal. A run takes the distinct words of its reviews, adds those that the stored table lacks,
stores the table again, and puts the normal forms in the place of the words.
"""

from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

from opinara.functions.stemming import map_lists, stem_words
from opinara.operators.keys import is_unique
from opinara.operators.lookup import is_small, lookup

WORDS_AT_ONCE = 1_000_000  # of the reviews that are looked up together in the words they have
MOST_SHARED = 200_000  # words of a table that every executor holds; a larger one is joined by shuffle


def distinct_words(df: DataFrame, column: str = "tokens") -> DataFrame:
    """The distinct words of a list column. They are folded in the map tasks, so a word in every review is no hot key."""
    return df.select(F.explode(column).alias("word")).filter("word is not null").distinct()


def extend_word_table(stored: DataFrame | None, words: DataFrame, normalise: Callable[[Column], Column] = stem_words) -> DataFrame:
    """The stored table with the words it lacks, and only those go through ``normalise`` (by default the stem). A word without a
    normal form stands for itself. Write the result before it is used or extended again."""
    missing = words if stored is None else words.join(stored, "word", "left_anti")
    fresh = missing.select("word", F.coalesce(normalise(F.col("word")), F.col("word")).alias("normal"))
    return fresh if stored is None else stored.select("word", "normal").unionByName(fresh)


def _looked_up(lists: pa.Array, known: pa.Array, normal: pa.Array) -> pa.Array:
    return map_lists(lists, lambda words: pc.coalesce(normal.take(pc.index_in(words, value_set=known)), words))


def _by_share(df: DataFrame, table: DataFrame, column: str) -> DataFrame:
    """Every executor holds the table; the words of a batch are looked up at once."""
    rows = table.select("word", "normal").toArrow()
    shared = df.sparkSession.sparkContext.broadcast((rows["word"].combine_chunks(), rows["normal"].combine_chunks()))

    @F.arrow_udf(ArrayType(StringType()))
    def look_up(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        known, normal = shared.value

        for lists in parts:
            yield _looked_up(lists, known, normal)

    return df.withColumn(column, look_up(column))


def _by_block(df: DataFrame, table: DataFrame, column: str, key: str, words_at_once: int = WORDS_AT_ONCE) -> DataFrame:
    """Reviews are dealt into blocks, and a block meets only the words that it has, each once: far fewer than its tokens."""
    whole = df.agg(F.sum(F.size(column))).head()[0] or 0
    rows = df.withColumn("_block", F.pmod(F.xxhash64(key), F.lit(whole // words_at_once + 1)))
    wanted = rows.select("_block", F.explode(column).alias("word")).filter("word is not null").distinct()
    found = wanted.join(table.select("word", "normal"), "word").select(F.col("_block").alias("_met_in"), "word", "normal")

    def look_up(reviews: pa.Table, words: pa.Table) -> pa.Table:
        known, normal = (pa.array(words[c].to_pylist(), pa.string()) for c in ("word", "normal"))
        at = reviews.column_names.index(column)
        reviews = reviews.combine_chunks()
        changed = pa.chunked_array([_looked_up(lists, known, normal) for lists in reviews[column].chunks], pa.list_(pa.string()))
        return reviews.set_column(at, column, changed).drop_columns(["_block"])

    return rows.groupBy("_block").cogroup(found.groupBy("_met_in")).applyInArrow(look_up, df.schema)


def _by_shuffle(df: DataFrame, table: DataFrame, column: str, key: str) -> DataFrame:
    """Words are joined to the table by shuffle, frequent ones spread, and put back by their place."""
    words = df.select(key, F.posexplode(column).alias("_at", "_word"))
    found = lookup(words, table.select("word", "normal"), {"_word": "word"}, spread_by=[key, "_at"], small=False)
    place = F.struct("_at", F.coalesce("normal", "_word").alias("_word"))
    changed = found.groupBy(key).agg(F.sort_array(F.collect_list(place)).alias("_changed"))  # the words of one review
    joined = df.join(changed, key, "left")
    empty = F.when(F.col(column).isNotNull(), F.array().cast("array<string>"))
    return joined.withColumn(column, F.coalesce(F.col("_changed._word"), empty)).drop("_changed")


def normalise_words(
    df: DataFrame, table: DataFrame, column: str = "tokens", key: str = "review_seq", most_shared: int = MOST_SHARED
) -> DataFrame:
    """The rows with the normal form of each word of a list column; a word that isn't in the table stays. ``table`` is unique on
    word; ``key`` on the rows. With a table that executors can't hold, write the rows first: they are read several times."""
    if is_small(table, most_shared):
        return _by_share(df, table, column)
    if is_unique(df, key):
        return _by_block(df, table, column, key)
    return _by_shuffle(df, table, column, key)
