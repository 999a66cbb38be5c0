"""Mixing sources to target weights by entropy balancing.

Each document gets a rate, how many copies of it the mix takes, between 0 and 3. Among all rates that meet the token target of
every source, those with the largest entropy relative to one copy each are exponentially tilted by the tokens of the document:
with ``t = lambda * size / scale`` of its source, ``3 e^t / (2 + e^t)``. The multipliers solve a convex dual, one equation per
source, by Newton steps; each is an aggregation over (source, size) cells, in which all documents have the same rate. Rates are
then rounded into whole copies along the sizes of a source, and the error of a source is filled up with its smaller documents.

Only DataFrame functions are used. Nothing is collected but one number per Newton step.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from opinara.llm.common import scratch_table

MOST_COPIES = 3
BUCKETS = 64  # a (source, size) cell is dealt over so many groups, as one size may hold a third of all rows
_MOST_STEPS = 80
_PASSES = 5


def n_words(text: str) -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def target_sizes(sizes: DataFrame, weights: tuple[int, ...] = (1, 2, 3), most: int = MOST_COPIES) -> DataFrame:
    """source_rank, source, source_size and target, from a table of source and source_size with a row per source.

    Sources by code point, null last, weigh ``weights`` in turn and share the sum of all sizes. A target stops at ``most``
    times its source, and the excess is shared again by weight until none is above: all targets stand at one level per weight,
    or at their own limit. Sources are ranked by limit per weight, and the level is that of the first that it doesn't reach.
    """
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())).cast("long")
    weight = F.element_at(F.array(*map(F.lit, weights)), ((F.col("source_rank") - 1) % len(weights) + 1).cast("int"))
    ranked = sizes.select(rank.alias("source_rank"), "source", "source_size").withColumn("weight", weight.cast("double"))
    ranked = ranked.withColumn("limit", (F.col("source_size") * most).cast("double"))
    order = Window.orderBy(F.col("limit") / F.col("weight"), "source_rank")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    after = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    rest = F.sum("source_size").over(Window.partitionBy()) - F.coalesce(F.sum("limit").over(before), F.lit(0.0))
    levels = ranked.withColumn("level", rest / F.sum("weight").over(after)).withColumn("place", F.row_number().over(order))
    reached = F.when(F.col("level") * F.col("weight") <= F.col("limit"), F.struct("place", "level"))
    level = F.min(reached).over(Window.partitionBy())["level"]
    target = F.least(F.col("limit"), level * F.col("weight"))
    return levels.select("source_rank", "source", "source_size", target.alias("target"))


def _rate(multiplier: Column, size: Column, scale: Column, full: Column, most: int) -> Column:
    tilted = most / (1 + (most - 1) * F.exp(-multiplier * size / scale))
    return F.when(full, F.lit(float(most))).otherwise(tilted)


def solve(cells: DataFrame, sources: DataFrame, most: int = MOST_COPIES) -> DataFrame:
    """The multiplier of each source. ``cells``: source_rank, size, n; ``sources``: source_rank, source_size, target.

    A Newton step that would leave the interval known to hold the solution is replaced by its middle. The steps end when every
    source is within half a word, or a millionth of a millionth, of its target. Returns source_rank, multiplier, scale, full.
    """
    size = F.col("size").cast("double")
    scales = cells.groupBy("source_rank").agg((F.sum(F.col("n") * size * size) / F.greatest(F.sum(F.col("n") * size), F.lit(1.0))).alias("scale"))
    state = sources.join(scales, "source_rank").select(
        "source_rank",
        "target",
        F.greatest("scale", F.lit(1.0)).alias("scale"),
        (F.col("target") >= F.col("source_size") * most).alias("full"),
        F.lit(0.0).alias("multiplier"),
        F.lit(float("-inf")).alias("low"),
        F.lit(float("inf")).alias("high"),
        F.lit(float("inf")).alias("miss"),
    )
    state = scratch_table(state, "multipliers")
    tolerance = F.greatest(F.lit(0.5), F.col("target") * 1e-12)
    for _ in range(_MOST_STEPS):
        rate = _rate(F.col("multiplier"), size, F.col("scale"), F.col("full"), most)
        words = F.col("n") * size
        sums = (
            cells.join(state.filter(~F.col("full")).select("source_rank", "multiplier", "scale", "full"), "source_rank")
            .groupBy("source_rank")
            .agg(
                F.sum(words * rate).alias("taken"),
                F.sum(words * size / F.col("scale") * rate * (1 - rate / most)).alias("slope"),
            )
        )
        miss = F.col("taken") - F.col("target")
        low = F.when(miss < 0, F.col("multiplier")).otherwise(F.col("low"))
        high = F.when(miss > 0, F.col("multiplier")).otherwise(F.col("high"))
        stepped = state.join(sums, "source_rank", "left").select(
            "source_rank", "target", "scale", "full", "multiplier",
            F.coalesce(low, "low").alias("low"),
            F.coalesce(high, "high").alias("high"),
            F.coalesce(miss, F.lit(0.0)).alias("miss"),
            (F.col("multiplier") - F.greatest(F.lit(-8.0), F.least(F.lit(8.0), F.try_divide(miss, F.col("slope"))))).alias("newton"),
        )
        outside = F.col("newton").isNull() | F.isnan("newton") | (F.col("newton") <= F.col("low")) | (F.col("newton") >= F.col("high"))
        open_low, open_high = F.col("low") == float("-inf"), F.col("high") == float("inf")
        middle = (
            F.when(open_high, F.greatest(F.col("multiplier") * 2, F.col("multiplier") + 8))
            .when(open_low, F.least(F.col("multiplier") * 2, F.col("multiplier") - 8))
            .otherwise((F.col("low") + F.col("high")) / 2)
        )
        moved = F.when(F.abs("miss") <= tolerance, F.col("multiplier")).when(outside, middle).otherwise(F.col("newton"))
        state = scratch_table(stepped.withColumn("multiplier", moved).drop("newton"), "multipliers")
        if not state.filter(F.abs("miss") > tolerance).limit(1).count():
            break
    return state.select("source_rank", "multiplier", "scale", "full")


def _running(cells: DataFrame, value: str, largest_first: bool = False) -> DataFrame:
    """The cells with ``before``: the sum of ``value`` over the sizes of the source that come earlier. It is summed over blocks
    of sizes first and then inside each block, so no task needs all cells of a source."""
    blocks = cells.groupBy("source_rank", "block").agg(F.sum(value).alias("of_block"))
    turn = (lambda c: F.col(c).desc()) if largest_first else F.col
    earlier = Window.partitionBy("source_rank").orderBy(turn("block")).rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select("source_rank", "block", F.coalesce(F.sum("of_block").over(earlier), F.lit(0.0)).alias("blocks_before"))
    inside = Window.partitionBy("source_rank", "block").orderBy(turn("size"), "bucket").rowsBetween(Window.unboundedPreceding, -1)
    before = F.col("blocks_before") + F.coalesce(F.sum(value).over(inside), F.lit(0.0))
    return cells.join(scratch_table(blocks, "blocks"), ["source_rank", "block"]).withColumn("before", before).drop("blocks_before")


def _round(cells: DataFrame, sources: DataFrame, most: int) -> DataFrame:
    """``total``: how many copies the mix takes of the documents of each cell.

    The parts of copies are rounded as they add up along the sizes, which leaves about one large document of error per source.
    A few passes then add or take back copies of ever smaller documents, largest first, until the next one would miss by more.
    Documents of up to one and a half times what is missing are moved, so a pass halves it at least while there are any.
    """
    parts = _running(cells.withColumn("part", F.col("n") * (F.col("rate") - F.floor("rate"))), "part")
    extra = F.floor(F.col("before") + F.col("part") + 0.5) - F.floor(F.col("before") + 0.5)
    total = F.col("n") * F.floor("rate") + F.greatest(F.lit(0), F.least(extra, "n"))
    kept = ["source_rank", "size", "bucket", "block", "n", "rate"]
    cells = scratch_table(parts.select(*kept, total.cast("long").alias("total")), "copies")
    for _ in range(_PASSES):
        taken = cells.groupBy("source_rank").agg(F.sum(F.col("size") * F.col("total")).alias("taken"))
        missing = sources.join(taken, "source_rank").select("source_rank", (F.col("target") - F.col("taken")).alias("missing"))
        cells = cells.join(missing, "source_rank")
        room = F.when(F.col("missing") > 0, F.col("n") * most - F.col("total")).otherwise(F.col("total"))
        fits = (F.col("size") > 0) & (F.col("size") <= 1.5 * F.abs("missing"))
        cells = cells.withColumn("room", F.when(fits, room).otherwise(0))
        cells = cells.withColumn("words", (F.col("room") * F.col("size")).cast("double"))
        cells = _running(scratch_table(cells, "room"), "words", largest_first=True)
        left = F.abs("missing") - F.col("before")
        moved = F.greatest(F.lit(0), F.least(F.col("room"), F.floor(F.try_divide(left, F.col("size")) + 0.5)))
        total = F.col("total") + F.when(F.col("room") > 0, F.signum("missing") * moved).otherwise(0)
        cells = scratch_table(cells.select(*kept, total.cast("long").alias("total")), "copies")
    return cells.select("source_rank", "size", "bucket", "n", "rate", "total")


def _place() -> Column:
    return F.xxhash64(F.col("doc_id").cast("long"), F.col("text").cast("string"))


def mix(docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), most: int = MOST_COPIES) -> DataFrame:
    """doc_id, source, place (a hash of doc_id and text), size, source_size, target, rate, copies and taken (copies times size) of
    every row.

    Takes a table with doc_id, text and source. Size is the number of words; a null or empty text has none and takes no words.
    A null source is one of its own. Which documents of one size get the extra copy is settled by a hash of doc_id and text, so
    reruns agree; rows that are equal throughout may stand for each other. Other columns are ignored; an empty table stays so.
    """
    text = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), F.col("text").cast("string").alias("text"))
    sized = scratch_table(text.select("doc_id", "source", n_words("text").alias("size"), _place().alias("place")), "sizes")
    sizes = scratch_table(sized.groupBy("source", "size").agg(F.count(F.lit(1)).alias("n")), "source-sizes")
    sources = scratch_table(target_sizes(sizes.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size")), weights, most), "targets")
    same = sources["source"].eqNullSafe(sizes["source"])
    by_size = scratch_table(sizes.join(sources, same).select("source_rank", "size", "n"), "ranked-sizes")
    state = scratch_table(solve(by_size, sources, most), "solved")

    ranked = sized.join(sources, sized["source"].eqNullSafe(sources["source"])).select(
        "doc_id", sized["source"], "source_rank", "source_size", "target", "size", "place", F.pmod("place", F.lit(BUCKETS)).cast("int").alias("bucket")
    )
    ranked = scratch_table(ranked, "ranked")
    rate = _rate(F.col("multiplier"), F.col("size").cast("double"), F.col("scale"), F.col("full"), most)
    cells = ranked.groupBy("source_rank", "size", "bucket").agg(F.count(F.lit(1)).alias("n"))
    cells = cells.join(state, "source_rank").select("source_rank", "size", "bucket", "n", rate.alias("rate"))
    cells = cells.withColumn("block", F.floor(F.log2(F.col("size") + 1.0) * 8))
    cells = scratch_table(cells, "cells")
    copies = scratch_table(_round(cells, sources, most), "copies")

    nth = F.row_number().over(Window.partitionBy("source_rank", "size", "bucket").orderBy("place", "doc_id"))
    dealt = ranked.withColumn("nth", nth).join(copies, ["source_rank", "size", "bucket"])
    more = F.when(F.col("nth") <= F.col("total") % F.col("n"), 1).otherwise(0)
    n_copies = (F.floor(F.col("total") / F.col("n")) + more).cast("long")
    return dealt.select("doc_id", "source", "place", "size", "source_size", "target", "rate", n_copies.alias("copies")).withColumn("taken", F.col("copies") * F.col("size"))


def copies(docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), most: int = MOST_COPIES) -> DataFrame:
    """The rows of a table, with all its columns, each as often as the mix takes it; see ``mix``.

    Of rows that repeat doc_id, text and source one stands for all, as often as the mix takes them together. Columns may have any
    names. Texts are shuffled once, to meet how often they are taken; repeats are told from the written table of the mix, and only
    they are folded, in the map tasks first.
    """
    mixed = scratch_table(mix(docs, weights, most), "mixed")
    source = F.when(F.col("source").isNotNull(), F.concat(F.lit("="), F.col("source").cast("string"))).otherwise("").alias("origin")
    wanted = mixed.groupBy("place", source).agg(F.sum("copies").alias("copies"), F.count(F.lit(1)).alias("n"))
    wanted = scratch_table(wanted.filter("copies > 0"), "wanted")
    rows = docs.select(F.struct("*").alias("row"), _place().alias("place"), source)
    single = rows.join(wanted.filter("n = 1"), ["place", "origin"])
    repeated = rows.join(wanted.filter("n > 1"), ["place", "origin"]).dropDuplicates(["place", "origin"])
    taken = single.unionByName(repeated).select("row", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    return taken.select("row.*")
