"""Places of rows in an order, and text in that order, without sorting anything in one task."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from opinara.operators.lineage import stored

ROWS_PER_PIECE = 1000
BYTES_PER_PIECE = 1 << 20
_INSIDE = 33  # bits of a row number that count inside its partition


def add_places(df: DataFrame, order: list[Column], place: str = "place") -> DataFrame:
    """The rows with their place in ``order``, from 1.

    Rows are dealt by range, sorted inside their partition and written once. A place is that inside the partition plus the rows of
    the partitions before; only those sizes, one row per partition, meet in one task. Let the order end in a unique column: rows that
    are equal in it share a partition, and which of them comes first is open.
    """
    ordered = df.repartitionByRange(*order).sortWithinPartitions(*order)
    ordered = stored(ordered.withColumn("_at", F.monotonically_increasing_id()))
    part = F.shiftright("_at", _INSIDE)
    sizes = ordered.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_size"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_before"))
    joined = ordered.join(F.broadcast(offsets), part == F.col("_part"))
    inside = F.col("_at").bitwiseAND(F.lit((1 << _INSIDE) - 1))
    return joined.select(*df.columns, (F.col("_before") + inside + 1).cast("long").alias(place))


def ordered_text(
    df: DataFrame,
    group: list[str],
    text: str,
    order: list[str],
    rows_per_piece: int = ROWS_PER_PIECE,
    bytes_per_piece: int = BYTES_PER_PIECE,
) -> DataFrame:
    """All texts of a group joined by a space, ordered by columns of any type, in pieces: group, piece, n_texts, combined_text.

    Rows are placed by group and order, and every ``rows_per_piece`` places are a block. A block is cut where a group ends and
    where the texts before, with a space each, fill another ``bytes_per_piece``. So a piece holds no more texts than a block and no
    more bytes than that and one text, however large the group; a text is never cut. ``piece`` is the place of its first text: the
    pieces of a group in that order, joined by a space, are the whole text of the group. Missing texts are left out.
    """
    keys = [F.col(c).asc_nulls_first() for c in (*group, *order)]
    given = df.select(*dict.fromkeys([*group, *order, text])).filter(F.col(text).isNotNull())
    placed = add_places(given, keys, "_place").withColumn("_block", F.expr(f"(_place - 1) div {rows_per_piece}"))
    inside = Window.partitionBy("_block", *group).orderBy("_place").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum(F.octet_length(text) + 1).over(inside), F.lit(0))
    cut = placed.repartition("_block").withColumn("_cut", F.call_function("div", before, F.lit(bytes_per_piece)))
    entries = F.sort_array(F.collect_list(F.struct("_place", F.col(text).alias("_text"))))
    pieces = cut.groupBy("_block", *group, "_cut").agg(F.min("_place").alias("piece"), F.count(F.lit(1)).alias("n_texts"), entries.alias("_entries"))
    return pieces.select(*group, "piece", "n_texts", F.array_join("_entries._text", " ").alias("combined_text"))
