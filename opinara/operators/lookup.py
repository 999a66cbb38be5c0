"""Joins to lookup tables whose size is checked before a broadcast."""

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 64 * 1024 * 1024
SALTS = 32
HOT_ROWS = 1_000_000  # a key with so many rows is spread
MOST_HOT = 10_000  # keys that are spread, the largest first; adaptive skew joins see to the rest


def _row_bytes(table: DataFrame) -> Column:
    """Bytes of a row: text and binary by length, arrays, maps and structs by their length as JSON, others eight."""

    def size(field) -> Column:
        kind = field.dataType.typeName()
        if kind in ("string", "binary"):
            return F.coalesce(F.octet_length(field.name), F.lit(0))
        if kind in ("array", "map", "struct"):
            return F.coalesce(F.length(F.to_json(F.struct(field.name))), F.lit(0))
        return F.lit(8)

    return reduce(lambda a, b: a + b, map(size, table.schema), F.lit(0))


def which_are_small(tables: dict[str, DataFrame], max_rows: int = BROADCAST_ROWS) -> dict[str, bool]:
    """Which tables have at most ``max_rows`` rows and ``BROADCAST_BYTES`` bytes, found in one job that
    reads no more than one row past the limit of each."""
    listed = [
        df.limit(max_rows + 1).select(F.lit(name).alias("name"), _row_bytes(df).alias("bytes")) for name, df in tables.items()
    ]
    sizes = reduce(DataFrame.union, listed).groupBy("name").agg(F.count(F.lit(1)).alias("n"), F.sum("bytes").alias("bytes"))
    found = {r["name"]: r["n"] <= max_rows and r["bytes"] <= BROADCAST_BYTES for r in sizes.collect()}
    return {name: found.get(name, True) for name in tables}


def is_small(table: DataFrame, max_rows: int = BROADCAST_ROWS) -> bool:
    return which_are_small({"table": table}, max_rows)["table"]


def lookup(
    rows: DataFrame,
    table: DataFrame,
    on: dict[str, str],
    spread_by: list[str],
    how: str = "left",
    max_rows: int = BROADCAST_ROWS,
    salts: int = SALTS,
    small: bool | None = None,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Join ``rows`` to a table that is unique on its key; ``on`` maps row columns to table columns.

    Keys match null-safe. A small table is broadcast; ``small`` says so when it was checked before. A larger one is joined by
    shuffle. Keys with ``hot_rows`` rows or more, counted with map-side totals, are spread over ``salts`` partitions by a hash
    of ``spread_by``, and only their table rows are repeated once per salt.
    """
    table = table.withColumnsRenamed({right: f"_key_{right}" for right in on.values()})

    def matches(extra: list[Column]) -> Column:
        pairs = [rows[left].eqNullSafe(table[f"_key_{right}"]) for left, right in on.items()]
        return reduce(lambda a, b: a & b, pairs + extra)

    keys = [f"_key_{right}" for right in on.values()]
    if is_small(table, max_rows) if small is None else small:
        return rows.join(F.broadcast(table), matches([]), how).drop(*keys)
    hot = hot_keys(rows, list(on), hot_rows).withColumn("_hot", F.lit(True))
    named = {left: f"_hot_{left}" for left in on}
    of_rows = reduce(lambda a, b: a & b, [rows[left].eqNullSafe(F.col(name)) for left, name in named.items()])
    of_table = reduce(lambda a, b: a & b, [table[f"_key_{on[left]}"].eqNullSafe(F.col(name)) for left, name in named.items()])
    hot = F.broadcast(hot.withColumnsRenamed(named))
    spread = F.when(F.col("_hot"), F.pmod(F.xxhash64(*spread_by), F.lit(salts))).otherwise(0).cast("int")
    rows = rows.join(hot, of_rows, "left").withColumn("_salt", spread).drop("_hot", *named.values())
    places = F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    table = table.join(hot, of_table, "left").withColumn("_salt_of_key", F.explode(places)).drop("_hot", *named.values())
    salted = rows.join(table, matches([rows["_salt"] == table["_salt_of_key"]]), how)
    return salted.drop(*keys, "_salt", "_salt_of_key")


def hot_keys(rows: DataFrame, keys: list[str], hot_rows: int) -> DataFrame:
    """The keys that hold ``hot_rows`` rows or more, at most ``MOST_HOT`` of them."""
    counted = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
    return counted.filter(F.col("_rows") >= hot_rows).orderBy(F.desc("_rows")).limit(MOST_HOT).drop("_rows")
