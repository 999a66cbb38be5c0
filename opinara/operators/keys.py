"""Surrogate keys and insert-or-ignore."""

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

MISSING_PART = "\\N"


def is_unique(df: DataFrame, key: str) -> bool:
    """Whether no value of ``key`` repeats or is null."""
    counted = df.groupBy(key).agg(F.count(F.lit(1)).alias("_rows"))
    return counted.filter((F.col("_rows") > 1) | F.col(key).isNull()).isEmpty()


def add_dense_key(table: DataFrame, natural: list[str], key: str, hex_digits: int = 4, above: Column | int = 0) -> DataFrame:
    """Number the rows of a distinct table ``above`` + 1, + 2, + 3, … without sorting it in one task.

    Rows are grouped by the first digits of the MD5 of the natural key (65,536 groups by default,
    even in size because keys are distinct), numbered inside each group, and shifted by the sizes
    of the groups before. Only the group sizes, at most ``16 ** hex_digits`` rows, meet in one
    task and are broadcast. The numbers depend on nothing but the natural keys and ``above``.
    """
    parts = [F.coalesce(F.col(c).cast("string"), F.lit(MISSING_PART)) for c in natural]
    marked = table.withColumn("_group", F.substring(F.md5(F.concat_ws("\x1f", *parts)), 1, hex_digits))
    sizes = marked.groupBy("_group").agg(F.count(F.lit(1)).alias("_size"))
    before = Window.orderBy("_group").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_group", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset"))
    inside = F.row_number().over(Window.partitionBy("_group").orderBy(*[F.col(c).asc_nulls_first() for c in natural]))
    numbered = marked.withColumn("_number", inside).join(F.broadcast(offsets), "_group")
    start = above if isinstance(above, Column) else F.lit(above)
    return numbered.select((start + F.col("_offset") + F.col("_number")).cast("long").alias(key), *table.columns)


def new_members(old: DataFrame, new: DataFrame, natural: list[str], order: list[str] | None = None) -> DataFrame:
    """The new rows whose natural key is not among the old ones, one of each key: the first in ``order`` (by default: in all
    columns). Null keys count as equal."""
    first = F.min_by(F.struct(*new.columns), F.struct(*(order or new.columns)))
    once = new.groupBy(*[F.col(c).alias(f"_{c}") for c in natural]).agg(first.alias("_row")).select("_row.*")
    match = [once[c].eqNullSafe(old[c]) for c in natural]
    return once.join(old, match, "left_anti")


def insert_or_ignore(
    old: DataFrame,
    new: DataFrame,
    natural: list[str],
    order: list[str] | None = None,
    key: str | None = None,
    highest: int | None = None,
) -> DataFrame:
    """Old rows plus the ``new_members``. With ``key``, old rows keep their key and new ones get the next.

    Keys go on from the largest of the table, or from ``highest`` if that is larger: the largest key that was ever given, stored
    by ``highest_keys``, so that the key of a member that was taken out is not given again. Which member gets which of the next
    keys depends on nothing but its natural key. Write the result before it is extended again.
    """
    fresh = new_members(old, new, natural, order)
    if key is not None:
        largest = F.coalesce(old.agg(F.max(key)).scalar(), F.lit(0))
        above = F.greatest(largest, F.lit(highest)) if highest is not None else largest
        fresh = add_dense_key(fresh.drop(key), natural, key, above=above)
    return old.unionByName(fresh, allowMissingColumns=True)


def highest_keys(tables: dict[str, tuple[DataFrame, str]], before: DataFrame | None = None) -> DataFrame:
    """table_name and highest, the largest key that each table (a frame and its key column) has, or had in the rows of
    ``before``. Write it beside the tables and pass it on at the next load."""
    rows = [
        table.agg(F.coalesce(F.max(key), F.lit(0)).cast("long").alias("highest")).select(F.lit(name).alias("table_name"), "highest")
        for name, (table, key) in tables.items()
    ]
    listed = reduce(DataFrame.unionByName, rows if before is None else [*rows, before.select("table_name", "highest")])
    return listed.groupBy("table_name").agg(F.max("highest").alias("highest"))
