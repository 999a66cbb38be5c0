"""Correlations and exact percentiles."""

from itertools import combinations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from opinara.functions.casting import nan_to_null
from opinara.functions.numbers import half_up
from opinara.operators.lineage import cut_lineage
from opinara.operators.lookup import lookup
from opinara.operators.small import small_table

QUARTILES = (0.0, 0.25, 0.5, 0.75, 1.0)
_STEP = 16  # a group has the square of it in bins, found in two steps


def correlations(df: DataFrame, pairs: list[tuple[str, str]], places: int = 6) -> DataFrame:
    """Pearson correlation of each pair, long form, from one aggregation over the table.

    A pair uses the rows where both values are there; a constant column gives null. Each row is
    listed once per pair and folded in the map tasks, which is quicker than one aggregate with
    three measures for every pair.
    """
    value = {c: nan_to_null(F.col(c).cast("double")) for pair in pairs for c in pair}
    listed = F.array(
        *[F.struct(F.lit(n).alias("pair"), value[a].alias("x"), value[b].alias("y")) for n, (a, b) in enumerate(pairs)]
    )
    both = df.select(F.inline(listed)).filter(F.col("x").isNotNull() & F.col("y").isNotNull())
    spread = F.stddev_pop("x") * F.stddev_pop("y")
    found = both.groupBy("pair").agg(F.try_divide(F.covar_pop("x", "y"), spread).alias("r"))
    rows = [(n, a, b) for n, (a, b) in enumerate(pairs)]
    names = small_table(df.sparkSession, rows, "pair int, metric_a string, metric_b string")
    joined = names.join(found, "pair", "left")
    return joined.select("metric_a", "metric_b", half_up(F.col("r"), places).alias("correlation"))


def correlation_matrix(df: DataFrame, columns: list[str], places: int = 6) -> DataFrame:
    return correlations(df, list(combinations(columns, 2)), places)


def exact_percentiles(df: DataFrame, group: str, value: str, points=QUARTILES) -> DataFrame:
    """Exact, interpolated percentiles of a value per group: group, point, value.

    The built-in exact percentile holds all values of a group in one buffer. Here equal values are counted first. A mergeable sketch
    of the distinct values, bounded in memory, gives each group edges with about as many values between them, whatever their range
    and shape. The counts are added up per bin, and only the bins that hold a wanted rank are looked into. An edge of the sketch
    that is off makes a bin larger or smaller and changes no result.
    """
    filled = df.select(F.col(group), nan_to_null(F.col(value).cast("double")).alias("_value"))
    counted = filled.filter(F.col("_value").isNotNull()).groupBy(group, "_value").agg(F.count(F.lit(1)).alias("_n"))
    counted = cut_lineage(counted)
    bins = _STEP * _STEP
    shares = [n / bins for n in range(1, bins)]
    edges = counted.groupBy(group).agg(F.percentile_approx("_value", shares, 10 * bins).alias("_edges"))
    coarse = F.transform(F.sequence(F.lit(_STEP), F.lit(bins - _STEP), F.lit(_STEP)), lambda n: F.element_at("_edges", n))
    edges = cut_lineage(edges.withColumn("_coarse", coarse))
    placed = lookup(counted, edges, {group: group}, spread_by=["_value"])
    placed = placed.withColumn("_part", F.size(F.filter("_coarse", lambda e: e <= F.col("_value"))))
    fine = F.slice("_edges", F.col("_part") * _STEP + 1, F.lit(_STEP - 1))
    inside = F.size(F.filter(fine, lambda e: e <= F.col("_value")))
    counted = placed.select(group, "_value", "_n", (F.col("_part") * _STEP + inside).alias("_bin"))

    by_group = Window.partitionBy(group)
    before = by_group.orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)
    bin_sizes = counted.groupBy(group, "_bin").agg(F.sum("_n").alias("_bin_n"))
    bin_sizes = bin_sizes.select(
        group,
        "_bin",
        "_bin_n",
        F.coalesce(F.sum("_bin_n").over(before), F.lit(0)).alias("_bin_start"),
        F.sum("_bin_n").over(by_group).alias("_total"),
    )
    wanted = F.explode(F.array(*[F.lit(float(p)) for p in points])).alias("point")
    rank = F.col("point") * (F.col("_total") - 1)
    ranks = bin_sizes.select("*", wanted).select(
        "*", F.explode(F.array_distinct(F.array(F.floor(rank), F.ceil(rank)))).alias("_rank"), rank.alias("_exact")
    )
    ranks = ranks.filter((F.col("_rank") >= F.col("_bin_start")) & (F.col("_rank") < F.col("_bin_start") + F.col("_bin_n")))
    bins_hit = ranks.select(F.col(group).alias("_g"), F.col("_bin").alias("_b"), "_bin_start").distinct()

    inside = Window.partitionBy("_g", "_b").orderBy("_value").rowsBetween(Window.unboundedPreceding, -1)
    in_bin = F.col(group).eqNullSafe(F.col("_g")) & (F.col("_bin") == F.col("_b"))
    spans = counted.join(bins_hit, in_bin).select("_g", "_b", "_value", "_n", "_bin_start")
    start = F.col("_bin_start") + F.coalesce(F.sum("_n").over(inside), F.lit(0))
    spans = spans.select("_g", "_b", "_value", "_n", start.alias("_start"))
    in_span = (F.col("_rank") >= F.col("_start")) & (F.col("_rank") < F.col("_start") + F.col("_n"))
    hits = ranks.select(group, "_bin", "point", "_rank", "_exact").join(spans, in_bin & in_span)
    # One or two ranks per point: weigh the lower and the upper value.
    weight = F.lit(1.0) - F.abs(F.col("_exact") - F.col("_rank"))
    return hits.groupBy(group, "point").agg(F.sum(F.col("_value") * weight).alias("value"))
