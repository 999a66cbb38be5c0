"""N-gram Jaccard join: a size-aware heavy-light join over sets of word shingles.

Two sets with a Jaccard similarity of p per cent share ``ceil(p * n / 100)`` elements of either, so of the first
``n - ceil(p * n / 100) + c`` elements in one common order they share ``c`` at least. Elements are ordered from rare to common
(by a counting sketch of all documents; any common order is right, a good one is fast).

* Small sets enumerate all subsets of size ``c = 2`` of those elements; two small sets that link share a subset.
* Large sets scan the inverted lists of their elements with ``c = 1``. Small sets that a large one can link with are listed too.

The boundary between small and large is where the cost, subsets against list entries with their scans, is least over the sizes
of the corpus. Sets under six elements link with equal sets only.

Lists are never turned into all of their pairs. Equal sets are one node. Each node of a list is first verified against one
node of the list, and links unite to components. What is left are pairs of a list in different components: all of them are
verified, and once none is left, every link is either found or inside a component. Verification intersects whole sets. Shingles
and sets are named by 64-bit hashes.
"""

import hashlib
import math
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from opinara.llm.common import batches, doc_id, gram_hashes, keyed_texts, mixed, row_key, scratch_table, word_hashes
from opinara.llm.components import components

SHINGLE = 4
PERCENT = 85
SKETCH_BITS = 20  # the sketch has so many bits of counters, whatever the corpus
_BLOCK = 1 << 12
_SCAN = 4  # what scanning a list costs, in subsets
_LARGEST_SMALL = 256
_SALTS = 32
_OUTSIDE = 4096  # outside nodes of a list that meet in one block

_SIZED = pa.schema(
    [("id", pa.int64()), ("fp", pa.int64()), ("n", pa.int32()), ("node", pa.int64()), ("block", pa.int32()), ("counts", pa.binary())]
)
_LISTED = pa.schema([("key", pa.int64()), ("node", pa.int64()), ("n", pa.int32()), ("place", pa.int32())])
_LINKS = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def shingles(text: str | None, length: int = SHINGLE) -> np.ndarray:
    """Hashes of the distinct shingles, ascending. With fewer words, the whole sequence is one."""
    words = text.encode("utf-8", "surrogatepass").lower().split() if text else []  # bytes.lower() changes A-Z only
    if not words:
        return np.zeros(0, np.uint64)
    hashes = word_hashes(words)
    if len(words) < length:
        return gram_hashes(hashes, len(words)) ^ np.uint64(len(words))
    return np.unique(gram_hashes(hashes, length))


def node_of(grams: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(grams.tobytes(), digest_size=8).digest(), "little", signed=True)


def needed(n: int, percent: int) -> int:
    """How many elements a set of ``n`` shares with any set it links with, at least."""
    return -(-percent * n // 100)


def prefix(n: int, percent: int, shared: int) -> int:
    return min(n, n - needed(n, percent) + shared)


def links_with_others(n: int, percent: int) -> bool:
    """Whether a set of ``n`` can link with a set that isn't equal."""
    return 100 * n >= percent * (n + 1) or needed(n, percent) < n


def _size_documents(length: int):
    """A row for each document, and the sketch of the task's documents in blocks."""

    def rows(parts):
        counters = np.zeros(1 << SKETCH_BITS, np.uint32)
        none = {"block": [None], "counts": [None]}
        for part in parts:
            for key, fp, text in zip(*(part.column(c).to_pylist() for c in ("id", "fp", "text")), strict=True):
                grams = shingles(text, length)
                np.add.at(counters, (grams >> np.uint64(64 - SKETCH_BITS)).astype(np.int64), np.uint32(1))
                yield {"id": [key], "fp": [fp], "n": [len(grams)], "node": [node_of(grams)]} | none
        for block in range(len(counters) // _BLOCK):
            counts = counters[block * _BLOCK : (block + 1) * _BLOCK]
            if counts.any():
                yield {"id": [0], "fp": [0], "n": [0], "node": [0], "block": [block], "counts": [counts.tobytes()]}

    def run(parts):
        yield from batches(rows(parts), _SIZED, 4_000)

    return run


def _add_up(group: pd.DataFrame) -> pd.DataFrame:
    total = np.zeros(_BLOCK, np.uint64)
    for counts in group["counts"]:
        total += np.frombuffer(counts, np.uint32 if len(counts) == 4 * _BLOCK else np.uint64)
    return pd.DataFrame({"block": [group["block"].iloc[0]], "counts": [total.tobytes()]})


def rarity_levels(sized: DataFrame) -> np.ndarray:
    """For each counter of the sketch the logarithm of its count, in eighths of an octave; 2**SKETCH_BITS bytes."""
    blocks = sized.filter("block is not null").select("block", "counts", F.pmod(F.xxhash64("counts"), F.lit(_SALTS)).alias("salt"))
    some = blocks.groupBy("block", "salt").applyInPandas(_add_up, "block int, counts binary")
    whole = some.groupBy("block").applyInPandas(_add_up, "block int, counts binary")
    levels = np.zeros(1 << SKETCH_BITS, np.uint8)
    for row in whole.collect():
        counts = np.frombuffer(row["counts"], np.uint64).astype(np.float64)
        levels[row.block * _BLOCK : (row.block + 1) * _BLOCK] = np.minimum(8 * np.log2(counts + 1), 255).astype(np.uint8)
    return levels


def boundary(sizes: dict[int, int], percent: int) -> int:
    """The largest size that counts as small: the one with the least cost. ``sizes``: how many sets have each small size."""

    def cost(most: int) -> int:
        total = 0
        for n, sets in sizes.items():
            if n <= most:
                total += sets * math.comb(prefix(n, percent, 2), 2)
            if listed(n, most, percent):
                total += sets * prefix(n, percent, 1) * (1 + _SCAN)
        return total

    return min(range(0, _LARGEST_SMALL + 1), key=lambda most: (cost(most), most))


def listed(n: int, most: int, percent: int) -> bool:
    """Whether a set of ``n`` is in inverted lists: a large set, or a small one that can link with a large one."""
    return n > most or 100 * n >= percent * (most + 1)


def _list_sets(length: int, percent: int, most: int, levels):
    def rows(batch):
        for text in batch.column("text").to_pylist():
            grams = shingles(text, length)
            n = len(grams)
            if n == 0 or not links_with_others(n, percent):
                continue
            level = levels.value[(grams >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)]
            ordered = grams[np.lexsort((grams, level))]
            keys, places = [], []
            if listed(n, most, percent):
                keys.append(ordered[: prefix(n, percent, 1)])
                places.append(np.arange(len(keys[-1])))
            if n <= most:
                pairs = np.array(list(combinations(range(prefix(n, percent, 2)), 2)), np.int64).reshape(-1, 2)
                keys.append(mixed(ordered[pairs[:, 0]] * np.uint64(0x9E3779B97F4A7C15) + ordered[pairs[:, 1]]))
                places.append(pairs[:, 0])
            keys, size = np.concatenate(keys), sum(map(len, keys))
            yield {
                "key": keys,
                "node": np.full(size, node_of(grams), np.int64),
                "n": np.full(size, n, np.int32),
                "place": np.concatenate(places).astype(np.int32),
            }

    def run(parts):
        for part in parts:
            yield from batches(rows(part), _LISTED)

    return run


def _confirm(length: int, percent: int):
    """The pairs (a, b) of texts whose whole sets link. A text that comes several times in a row is taken apart once."""

    def rows(batch):
        known: dict[int, np.ndarray] = {}
        for a, b, *texts in zip(*(batch.column(c).to_pylist() for c in ("a", "b", "text_a", "text_b")), strict=True):
            for node, text in zip((a, b), texts, strict=True):
                if node not in known:
                    known[node] = shingles(text, length)
            one, other = known[a], known[b]
            common = len(np.intersect1d(one, other, assume_unique=True))
            if 100 * common >= percent * (len(one) + len(other) - common):
                yield {"a": [a], "b": [b]}

    def run(parts):
        for part in parts:
            for at in range(0, part.num_rows, 500):
                yield from batches(rows(part.slice(at, 500)), _LINKS)

    return run


def _lists(entries: DataFrame) -> DataFrame:
    """The entries whose key has several nodes, once each. They are dealt by key once, for the test and for the list."""
    by_key = Window.partitionBy("key")
    ends = entries.withColumns({"first": F.min("node").over(by_key), "last": F.max("node").over(by_key)})
    return ends.filter("first <> last").drop("first", "last").distinct()


def _linked(texts: DataFrame, nodes: DataFrame, pairs: DataFrame, length: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets link. The texts of their nodes, and of no others, are fetched once."""
    ends = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct()
    wanted = nodes.join(ends, "node").select("id", "fp", "node")
    found = texts.join(wanted, ["id", "fp"]).dropDuplicates(["id", "fp", "node"])
    table = scratch_table(found.select("node", "text"), "texts")
    ones = pairs.join(table.select(F.col("node").alias("b"), F.col("text").alias("text_b")), "b")
    both = ones.join(table.select(F.col("node").alias("a"), F.col("text").alias("text_a")), "a")
    return scratch_table(both.mapInArrow(_confirm(length, percent), "a long, b long"), "links")


def join_documents(docs: DataFrame, percent: int = PERCENT, length: int = SHINGLE) -> DataFrame:
    """id, fp (``common.keyed_texts``), n_shingles, node (of its set), component (one node of it) and component_id of every row.

    Documents link when ``100 * intersection >= percent * union`` of their sets of distinct shingles; A-Z count as a-z. A null or
    empty text has no shingles and links with nothing. component_id is the smallest doc_id that links reach; null where no row of
    the component has one. Rows with one doc_id and different texts are documents of their own. Other columns are ignored.
    """
    spark, texts = docs.sparkSession, keyed_texts(docs)
    sized = scratch_table(texts.mapInArrow(_size_documents(length), "id long, fp long, n int, node long, block int, counts binary"), "sized")
    rows = sized.filter("block is null").select("id", "fp", "n", "node")
    levels = spark.sparkContext.broadcast(rarity_levels(sized))
    small = rows.filter((F.col("n") > 0) & (F.col("n") <= 2 * _LARGEST_SMALL)).groupBy("n").count().collect()
    sizes = {r["n"]: r["count"] for r in small if links_with_others(r["n"], percent)}
    most = boundary(sizes, percent)
    entries = texts.mapInArrow(_list_sets(length, percent, most, levels), "key long, node long, n int, place int")
    nodes = rows.filter("n > 0").groupBy("node").agg(F.min(F.struct("id", "fp")).alias("row"))
    nodes = scratch_table(nodes.select("node", "row.id", "row.fp"), "nodes")

    lists = scratch_table(_lists(entries), "lists")
    pairs = scratch_table(_pairs_with_centres(lists, percent), "pairs")
    links = _linked(texts, nodes, pairs, length, percent)
    found = components(links)

    apart = scratch_table(_pairs_apart(lists, found, percent).join(pairs, ["a", "b"], "left_anti"), "pairs-apart")
    if apart.limit(1).count():
        found = components(links.unionByName(_linked(texts, nodes, apart, length, percent)))

    named = nodes.join(found, "node", "left").select("node", "id", F.coalesce("component", "node").alias("component"))
    least = scratch_table(named.groupBy("component").agg(F.min("id").alias("component_id")), "names")
    named = scratch_table(named.join(least, "component").select("node", "component", "component_id"), "named")
    out = rows.filter("n > 0").join(named, "node").select("id", "fp", "n", "node", "component", "component_id")
    alone = rows.filter("n = 0").select("id", "fp", "n", F.lit(None).cast("long").alias("node"), F.lit(None).cast("long").alias("component"), F.col("id").alias("component_id"))
    return out.unionByName(alone).withColumnRenamed("n", "n_shingles")


def _may_link(n: str, place: str, m: str, other: str, percent: int) -> Column:
    """Whether two sets of a list may link if its element is the first that they have in common.

    What they have in common then is this element and at most the rest of either behind it. The first common element of two sets
    that link is in both of their prefixes, so some list lets them through.
    """
    n, m, place, other = map(F.col, (n, m, place, other))
    overlap = F.ceil((n + m) * percent / (100 + percent) - 1e-9)
    similar = 100 * F.least(n, m) >= percent * F.greatest(n, m)
    return similar & (F.least(n - place, m - other) >= overlap)


def _pairs_with_centres(lists: DataFrame, percent: int) -> DataFrame:
    """Each node of a list with one node of it: the one that is in most lists, so has fewest elements of its own. Where copies
    were made of one text, that is the text itself or close to it, and links with most of them."""
    ranked = lists.join(lists.groupBy("node").agg(F.count(F.lit(1)).alias("lists")), "node")
    centres = ranked.groupBy("key").agg(F.max(F.struct("lists", "node", "n", "place")).alias("c"))
    centres = centres.select("key", F.col("c.node").alias("centre"), F.col("c.n").alias("n_centre"), F.col("c.place").alias("place_centre"))
    pairs = lists.join(centres, "key").filter((F.col("node") != F.col("centre")) & _may_link("n", "place", "n_centre", "place_centre", percent))
    return pairs.select(F.greatest("node", "centre").alias("a"), F.least("node", "centre").alias("b")).distinct()


def _pairs_apart(lists: DataFrame, found: DataFrame, percent: int) -> DataFrame:
    """Pairs of a list that are in different components and may link. The nodes outside a list's main component meet all others, in
    blocks of bounded size; those inside don't meet each other. As rare elements come first, the places of a common one tell how
    many elements of its own a set has, and hold back nearly all copies that differ too much inside the join."""
    placed = lists.join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
    sizes = placed.groupBy("key", "component").agg(F.count(F.lit(1)).alias("size"))
    keys = sizes.groupBy("key").agg(F.max(F.struct("size", "component")).alias("m"), F.sum("size").alias("all"), F.count(F.lit(1)).alias("several"))
    keys = keys.filter("several > 1").select("key", F.col("m.component").alias("main"), (F.col("all") - F.col("m.size")).alias("outside"))
    placed = scratch_table(placed.join(keys, "key"), "open")
    columns, blocks = ["node", "n", "component", "place"], F.ceil(F.col("outside") / _OUTSIDE).cast("long")
    outside = placed.filter("component <> main").select("key", F.pmod(F.xxhash64("node"), blocks).alias("block"), *(F.col(c).alias(f"{c}_x") for c in columns))
    inside = placed.select("key", F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)).alias("block"), *columns)
    meet = outside.join(inside, ["key", "block"])
    meet = meet.filter((F.col("component_x") != F.col("component")) & _may_link("n_x", "place_x", "n", "place", percent))
    return meet.select(F.greatest("node_x", "node").alias("a"), F.least("node_x", "node").alias("b")).distinct()


def document_components(docs: DataFrame, percent: int = PERCENT, length: int = SHINGLE) -> DataFrame:
    """doc_id, n_shingles and component_id of every row; see ``join_documents``."""
    joined = join_documents(docs, percent, length)
    return joined.select(doc_id(), F.col("n_shingles").cast("long").alias("n_shingles"), doc_id("component_id").alias("component_id"))


def one_of_each(docs: DataFrame, percent: int = PERCENT, length: int = SHINGLE) -> DataFrame:
    """The rows of a table, with all its columns, but of each component the one with the smallest doc_id (then hash of the text).

    Rows that repeat doc_id and text count as one; rows without a word stay as they are. Columns may have any names.
    """
    joined = scratch_table(join_documents(docs, percent, length), "joined")
    first = joined.filter("n_shingles > 0").groupBy("component").agg(F.min(F.struct("id", "fp")).alias("row"))
    keep = scratch_table(first.select("row.id", "row.fp"), "kept")
    id_, fp, text = row_key()
    wordless = ~F.coalesce(text, F.lit("")).rlike(r"[^\x20\x09-\x0D]")
    keyed = docs.select(F.struct("*").alias("row"), id_.alias("id"), fp.alias("fp"), wordless.alias("wordless"))
    kept = keyed.filter("not wordless").join(keep, ["id", "fp"], "left_semi").dropDuplicates(["id", "fp"])
    return kept.select("row.*").unionByName(keyed.filter("wordless").select("row.*"))
