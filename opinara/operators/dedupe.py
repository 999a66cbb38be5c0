"""Keep-first de-duplication and first-n per group."""

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def keep_first(df: DataFrame, text: str, keys: list[str], order: str) -> DataFrame:
    """First row in ``order`` for each (keys, text). Nulls count as equal; ``order`` is unique.

    Texts are hashed before any shuffle, and partial aggregation folds a group of copies of any size inside each map task.
    Only the rows that go are looked up, among the hashes that occur twice, and taken out by an anti join on the unique
    ``order``. There are few of them as a rule, so Spark broadcasts them and no text is shuffled.
    """
    named = {c: f"_key_{c}" for c in keys}
    hashed = df.select(order, *keys, F.sha2(F.col(text), 256).alias("_text_hash"))
    groups = hashed.groupBy(*keys, "_text_hash").agg(F.min(order).alias("_first"), F.count(F.lit(1)).alias("_rows"))
    repeated = groups.filter("_rows > 1").withColumnsRenamed(named | {"_text_hash": "_repeated_hash"})
    same = [hashed[c].eqNullSafe(repeated[name]) for c, name in named.items()]
    same.append(hashed["_text_hash"].eqNullSafe(repeated["_repeated_hash"]))
    later = hashed.join(repeated, reduce(lambda a, b: a & b, same)).filter(F.col(order) > F.col("_first"))
    return df.join(later.select(order), order, "left_anti")


def first_n(df: DataFrame, group: list[str], order: list, n: int) -> DataFrame:
    """First ``n`` rows of each group. Spark trims every group to ``n`` before the shuffle
    (WindowGroupLimit), so a hot group costs no more than ``n`` rows per map task."""
    rank = F.row_number().over(Window.partitionBy(*group).orderBy(*order))
    return df.withColumn("_rank", rank).filter(F.col("_rank") <= n).drop("_rank")


def distinct_first(df: DataFrame, group: list[str], position: str) -> DataFrame:
    """Distinct groups with their first position; partial aggregation folds hot groups."""
    return df.groupBy(*group).agg(F.min(position).alias(position))
