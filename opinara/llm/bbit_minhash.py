"""MinHash near-duplicates with b-bit signatures.

A set of word shingles has the minima of 160 hash functions. Whole minima, five at a time, make the keys of 32 bands; two sets that
link share a key of a band but for one chance in 10^8. Of each minimum two bits of its scramble are retained and packed into five
numbers. Two signatures differ in as many places as the bit count of their exclusive or says; minima that differ agree in two bits
by chance one time in four, and with that collision corrected the count estimates the similarity. Only candidates whose estimate is
within five standard deviations of a link are fetched and confirmed on full sets.

The sets of a band's key are never turned into all of their pairs. Equal sets are one node. Nodes first meet one node of each key:
the most central one, then a few drawn ones where several components are left; links unite to components. Then pairs of different
components under one key whose estimates are high enough meet, so that every link is found or lies inside a component. A set that
has shingles of its own, in no other candidate, can't share those: that bound, counted once, is exact, and keeps copies of one text
that differ too much from meeting one another.
"""

import hashlib
import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opinara.llm.common import doc_id, gram_hashes, keyed_texts, mixed, scratch_table
from opinara.llm.components import components
from opinara.llm.jaccard_join import links_with_others
from opinara.llm.unit_store import pieces, sums

SHINGLE = 3
PERCENT = 85
BANDS, ROWS = 32, 5
FUNCTIONS = BANDS * ROWS
BITS = 2
WORDS = FUNCTIONS * BITS // 64
MARGIN = 5  # standard deviations
_DRAWS = 3  # drawn centres of a key; what they leave open is settled pair by pair
_CHUNK = 1 << 16
_RARE = 16  # nodes of open lists that have a rare shingle, at most
_MAPS = 8  # numbers of 64 bits that a bitmap of frequent shingles has
_BLOCK = 4096  # outside nodes under one key that meet in one block

_SEEDS = mixed(np.arange(1, 2 * FUNCTIONS + BANDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_FACTORS = (_SEEDS[:FUNCTIONS] >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
_MASKS = (_SEEDS[FUNCTIONS : 2 * FUNCTIONS] >> np.uint64(32)).astype(np.uint32)
_BAND_SEEDS = _SEEDS[2 * FUNCTIONS :]
_PACKED = [f"g{n}" for n in range(WORDS)]
_MAPPED = [f"m{n}" for n in range(_MAPS)]
_SHOWN = ["n", "common", *_PACKED]  # what a list tells of a node
SIGNED = "id long, fp long, n int, s1 long, s2 long, " + ", ".join(f"{g} long" for g in _PACKED) + ", bands array<long>"
_SIGNED = pa.schema(
    [("id", pa.int64()), ("fp", pa.int64()), ("n", pa.int32()), ("s1", pa.int64()), ("s2", pa.int64())]
    + [(g, pa.int64()) for g in _PACKED]
    + [("bands", pa.list_(pa.int64()))]
)
_LINKS = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def shingle_sets(texts: pa.Array, length: int = SHINGLE) -> list[np.ndarray]:
    """Hashes of the distinct shingles of each text, ascending. With fewer words, the whole sequence is one."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    words = lists.flatten()
    there = pc.greater(pc.binary_length(words), 0).to_numpy(zero_copy_only=False)
    counts = sums(there.astype(np.int64), np.diff(lists.offsets.to_numpy()))
    encoded = words.filter(pa.array(there)).dictionary_encode()
    hashed = np.array([xxhash.xxh3_64_intdigest(w) for w in encoded.dictionary.cast(pa.binary()).to_pylist()], np.uint64)
    hashes = hashed[encoded.indices.to_numpy()] if len(hashed) else hashed
    grams = gram_hashes(hashes, length)
    out = []
    for end, n in zip(np.cumsum(counts).tolist(), counts.tolist(), strict=True):
        if n >= length:
            out.append(np.unique(grams[end - n : end - length + 1]))
        else:
            out.append(gram_hashes(hashes[end - n : end], n) ^ np.uint64(n) if n else hashes[:0])
    return out


def minima(sets: list[np.ndarray]) -> np.ndarray:
    """The minima of all hash functions of non-empty sets, a row each."""
    out = np.empty((FUNCTIONS, len(sets)), np.uint32)
    sizes = np.fromiter(map(len, sets), np.int64, len(sets))
    number = (np.cumsum(sizes) - sizes) // _CHUNK
    cuts = [*np.flatnonzero(np.r_[True, np.diff(number) > 0]).tolist(), len(sets)] if len(sets) else []
    for first, last in zip(cuts, cuts[1:], strict=False):
        values = (np.concatenate(sets[first:last]) >> np.uint64(32)).astype(np.uint32)
        starts = np.cumsum(sizes[first:last]) - sizes[first:last]
        for n in range(FUNCTIONS):
            out[n, first:last] = np.minimum.reduceat((values ^ _MASKS[n]) * _FACTORS[n], starts)
    return np.ascontiguousarray(out.T)


def packed(found: np.ndarray) -> np.ndarray:
    """Two bits of each minimum, 32 minima to a number."""
    bits = ((found * np.uint32(0x9E3779B1)) >> np.uint32(32 - BITS)).astype(np.uint64).reshape(len(found), WORDS, 64 // BITS)
    return np.bitwise_or.reduce(bits << np.arange(0, 64, BITS, dtype=np.uint64), axis=2)


def band_keys(found: np.ndarray) -> np.ndarray:
    keys = np.broadcast_to(_BAND_SEEDS, (len(found), BANDS)).copy()
    for row in range(ROWS):
        keys = mixed(keys * np.uint64(0x9E3779B97F4A7C15) + found[:, row::ROWS].astype(np.uint64))
    return keys


def _sign(length: int):
    def run(parts):
        for part in parts:
            for few in pieces(part):
                sets = shingle_sets(few.column("text"), length)
                names = np.array([np.frombuffer(hashlib.blake2b(s.tobytes(), digest_size=16).digest(), np.int64) for s in sets]).reshape(-1, 2)
                some = [n for n, s in enumerate(sets) if len(s)]
                found = minima([sets[n] for n in some])
                bits, keys = np.zeros((len(sets), WORDS), np.int64), np.zeros((len(sets), BANDS), np.int64)
                bits[some], keys[some] = packed(found).view(np.int64), band_keys(found).view(np.int64)
                lists = pa.ListArray.from_arrays(np.arange(len(sets) + 1, dtype=np.int32) * BANDS, pa.array(keys.ravel()))
                columns = [few.column("id"), few.column("fp"), pa.array([len(s) for s in sets], pa.int32()), *map(pa.array, names.T.copy())]
                yield pa.RecordBatch.from_arrays([*columns, *map(pa.array, bits.T.copy()), lists], schema=_SIGNED)

    return run


def most_differences(percent: int) -> int:
    """How many of the packed places two sets that link differ in at most, but for ``MARGIN`` standard deviations."""
    similarity, by_chance = percent / 100, 0.5**BITS
    equal = similarity + (1 - similarity) * by_chance
    return FUNCTIONS - math.floor(FUNCTIONS * equal - MARGIN * math.sqrt(FUNCTIONS * equal * (1 - equal)))


def differences(one: str, other: str) -> Column:
    """In how many places two packed signatures (columns ``g0`` and on, with a suffix each) differ."""
    low, total = F.lit(0x5555555555555555), None
    for g in _PACKED:
        both = F.col(f"{g}{one}").bitwiseXOR(F.col(f"{g}{other}"))
        count = F.bit_count(both.bitwiseOR(F.shiftrightunsigned(both, 1)).bitwiseAND(low))
        total = count if total is None else total + count
    return total


def estimate(one: str, other: str) -> Column:
    """The similarity that two signatures tell, corrected for minima that agree by chance."""
    by_chance = 0.5**BITS
    return (1 - differences(one, other) / FUNCTIONS - by_chance) / (1 - by_chance)


def _may_link(one: str, other: str, percent: int) -> Column:
    """By sizes, by what two sets have in common at most (``common``: shingles that other candidates have too), by estimate."""
    n, m = F.col(f"n{one}"), F.col(f"n{other}")
    at_most = F.least(f"common{one}", f"common{other}")
    possible = (100 * F.least(n, m) >= percent * F.greatest(n, m)) & ((100 + percent) * at_most >= percent * (n + m))
    return possible & (differences(one, other) <= most_differences(percent))


def _lacking(one: str, other: str) -> Column:
    """How many shingles of a set the other lacks, at least: a bit that only its own bitmap has stands for one or more of them."""
    counts = [F.bit_count(F.col(f"{m}{one}").bitwiseAND(F.bitwise_not(F.col(f"{m}{other}")))) for m in _MAPPED]
    return sum(counts[1:], counts[0])


def _bitmaps() -> list[Column]:
    """The bitmap of the shingles of a group: each sets the bit that its hash names."""
    place = F.expr(f"pmod(shiftrightunsigned(gram, 6), {_MAPS})")
    bit = F.expr("shiftleft(1L, cast(gram & 63 as int))")
    return [F.bit_or(F.when(place == n, bit).otherwise(F.lit(0).cast("long"))).alias(m) for n, m in enumerate(_MAPPED)]


class _Texts:
    """The texts of the nodes that share a key with another."""

    def __init__(self, texts: DataFrame, nodes: DataFrame, lists: DataFrame, length: int, percent: int):
        wanted = nodes.join(lists.select("node").distinct(), "node").select("id", "fp", "node")
        found = texts.join(wanted, ["id", "fp"]).select("node", "text").dropDuplicates(["node"])
        self.table, self.length, self.percent = scratch_table(found, "texts"), length, percent

    def grams(self, nodes: DataFrame | None = None) -> DataFrame:
        """node and gram: the shingles of these nodes, or of some of them."""
        table = self.table if nodes is None else self.table.join(nodes.select("node"), "node", "left_semi")
        return table.mapInArrow(_grams(self.length), "node long, gram long")

    def own(self) -> DataFrame:
        """node and own: how many shingles of a node no other of these nodes has. Counted in the map tasks first."""
        alone = self.grams().groupBy("gram").agg(F.count(F.lit(1)).alias("uses"), F.min("node").alias("node")).filter("uses = 1")
        return alone.groupBy("node").agg(F.count(F.lit(1)).cast("int").alias("own"))

    def linked(self, pairs: DataFrame) -> DataFrame:
        """The pairs (a, b) whose full sets link."""
        ones = pairs.join(self.table.select(F.col("node").alias("a"), F.col("text").alias("text_a")), "a")
        both = ones.join(self.table.select(F.col("node").alias("b"), F.col("text").alias("text_b")), "b")
        return scratch_table(both.mapInArrow(_confirm(self.length, self.percent), "a long, b long"), "links")


def _grams(length: int):
    def run(parts):
        for part in parts:
            for few in pieces(part):
                sets = shingle_sets(few.column("text"), length)
                nodes = np.repeat(few.column("node").to_numpy(), [len(s) for s in sets])
                yield pa.RecordBatch.from_arrays([pa.array(nodes), pa.array(np.concatenate(sets).view(np.int64))], names=["node", "gram"])

    return run


def _confirm(length: int, percent: int):
    def run(parts):
        for part in parts:
            for few in pieces(part, "text_a", 1_000_000):
                sides = []
                for text in ("text_a", "text_b"):
                    encoded = few.column(text).dictionary_encode()
                    sets = shingle_sets(encoded.dictionary, length)
                    sides.append([sets[n] for n in encoded.indices.to_pylist()])
                link = []
                for one, other in zip(*sides, strict=True):
                    common = len(np.intersect1d(one, other, assume_unique=True))
                    link.append(100 * common >= percent * (len(one) + len(other) - common))
                yield pa.RecordBatch.from_arrays([few.column(c).filter(pa.array(link, pa.bool_())) for c in ("a", "b")], schema=_LINKS)

    return run


def _with_centres(lists: DataFrame, ranks: list[Column], percent: int) -> DataFrame:
    """Pairs of each node under a key with the node there of the highest rank, for each of the ranks, if they may link and aren't in
    one component already."""
    shown = ["node", *(["component"] if "component" in lists.columns else []), *_SHOWN]
    tops = [F.max(F.struct(rank.alias("rank"), *shown)) for rank in ranks]
    centres = lists.groupBy("key").agg(F.array_distinct(F.array(*[t.dropFields("rank") for t in tops])).alias("c"))
    centres = centres.select("key", F.explode("c").alias("c")).select("key", *(F.col(f"c.{c}").alias(f"{c}_c") for c in shown))
    name = shown[1] if "component" in shown else "node"
    pairs = lists.join(centres, "key").filter((F.col(name) != F.col(f"{name}_c")) & _may_link("", "_c", percent))
    return pairs.select(F.greatest("node", "node_c").alias("a"), F.least("node", "node_c").alias("b")).distinct()


def _united(found: DataFrame, links: DataFrame) -> DataFrame:
    """The components after more links, which join components to larger ones: each counts once between two of them."""
    of = {side: found.select(F.col("node").alias(side), F.col("component").alias(f"c{side}")) for side in "ab"}
    ends = links.join(of["a"], "a", "left").join(of["b"], "b", "left")
    ends = ends.select(F.coalesce("ca", "a").alias("a"), F.coalesce("cb", "b").alias("b")).filter("a <> b").distinct()
    whole = components(ends).withColumnRenamed("component", "whole")
    known = found.join(whole.withColumnRenamed("node", "component"), "component", "left").select("node", F.coalesce("whole", "component").alias("component"))
    fresh = whole.join(found, "node", "left_anti").select("node", F.col("whole").alias("component"))
    return scratch_table(known.unionByName(fresh), "components")


def _open_lists(lists: DataFrame, found: DataFrame) -> DataFrame:
    """The lists with nodes of several components, with component, main (a component of the key) and outside (nodes of others)."""
    placed = lists.join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
    sizes = placed.groupBy("key", "component").agg(F.count(F.lit(1)).alias("size"))
    keys = sizes.groupBy("key").agg(F.max(F.struct("size", "component")).alias("m"), F.sum("size").alias("all"), F.count(F.lit(1)).alias("several"))
    keys = keys.filter("several > 1").select("key", F.col("m.component").alias("main"), (F.col("all") - F.col("m.size")).alias("outside"))
    return scratch_table(placed.join(keys, "key"), "open")


def _pairs_apart(open_: DataFrame, fetched: _Texts, percent: int) -> DataFrame:
    """Pairs of nodes of open lists in different components that may link.

    A shingle that at most ``_RARE`` of these nodes have is rare. Two sets either have a rare shingle in common, and such pairs are
    listed by shingle, a bounded number for each; or they have no more in common than either has shingles that aren't rare, less
    those that the other lacks by its bitmap. Among copies of one text those that aren't rare are the text's own, and each copy lacks
    others of them, so that copies that differ too much don't meet, however many there are.
    """
    nodes = scratch_table(open_.select("node", "component", *_SHOWN).distinct(), "open-nodes")
    grams = scratch_table(fetched.grams(nodes), "grams")
    uses = grams.groupBy("gram").agg(F.count(F.lit(1)).alias("uses")).filter("uses > 1")
    shared = scratch_table(grams.join(uses, "gram"), "shared-grams")
    rare = shared.filter(F.col("uses") <= _RARE).groupBy("gram").agg(F.collect_list("node").alias("nodes"))  # few, by the filter
    rare = rare.select("nodes", F.explode("nodes").alias("a")).select("a", F.explode("nodes").alias("b")).filter("a > b").distinct()
    for name, side in (("a", "_x"), ("b", "")):
        rare = rare.join(nodes.select(F.col("node").alias(name), *(F.col(c).alias(f"{c}{side}") for c in ("component", *_SHOWN))), name)
    apart = (F.col("component_x") != F.col("component")) & _may_link("_x", "", percent)
    listed = rare.filter(apart).select("a", "b")

    frequent = shared.filter(F.col("uses") > _RARE).groupBy("node").agg(F.count(F.lit(1)).cast("int").alias("frequent"), *_bitmaps())
    left = open_.drop("common").join(frequent.withColumnRenamed("frequent", "common"), "node").filter(100 * F.col("common") >= percent * F.col("n"))
    # Nodes outside the key's main component meet all others, in blocks of bounded size
    columns = ["node", "component", *_SHOWN, *_MAPPED]
    blocks = F.ceil(F.col("outside") / _BLOCK).cast("long")
    outside = left.filter("component <> main").select("key", F.pmod(F.xxhash64("node"), blocks).alias("block"), *(F.col(c).alias(f"{c}_x") for c in columns))
    inside = left.select("key", F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)).alias("block"), *columns)
    at_most = F.least(F.col("common_x") - _lacking("_x", ""), F.col("common") - _lacking("", "_x"))
    enough = (100 + percent) * at_most >= percent * (F.col("n_x") + F.col("n"))
    meet = outside.join(inside, ["key", "block"]).filter(apart & enough)
    met = meet.select(F.greatest("node_x", "node").alias("a"), F.least("node_x", "node").alias("b"))
    return listed.unionByName(met).distinct()


def near_duplicates(docs: DataFrame, percent: int = PERCENT, length: int = SHINGLE) -> DataFrame:
    """doc_id, n_shingles (size of its set), component_id and kept of every row of a table with doc_id and text.

    Documents link when ``100 * intersection >= percent * union`` of their sets of distinct shingles of ``length`` words; A-Z count as
    a-z. component_id is the smallest doc_id that links reach; null where no row of the component has one. kept says that a row has
    that doc_id. A null, empty or blank text has no shingles, links with nothing and is kept. Rows that repeat a doc_id are judged by
    their text, alike if it is the same; a row without a doc_id comes after all others. Other columns are ignored.
    """
    texts = keyed_texts(docs)
    signed = scratch_table(texts.mapInArrow(_sign(length), SIGNED), "signed")
    first = F.min(F.struct("id", "fp", "n", *_PACKED, "bands")).alias("row")
    nodes = signed.filter("n > 0").groupBy("s1", "s2").agg(first).select(F.monotonically_increasing_id().alias("node"), "s1", "s2", "row.*")
    nodes = scratch_table(nodes, "nodes")

    least = next(n for n in range(1, 10_000) if links_with_others(n, percent))
    entries = nodes.filter(F.col("n") >= least).select("node", "n", *_PACKED, F.explode("bands").alias("key"))
    shared = entries.groupBy("key").agg(F.count(F.lit(1)).alias("size")).filter("size > 1").select("key")
    lists = scratch_table(entries.join(shared, "key"), "lists")
    fetched = _Texts(texts, nodes, lists, length, percent)
    common = F.col("n") - F.coalesce("own", F.lit(0))
    lists = lists.join(scratch_table(fetched.own(), "own"), "node", "left").withColumn("common", common).drop("own")
    lists = scratch_table(lists.filter(100 * F.col("common") >= percent * F.col("n")), "lists")  # others link with no set

    lists_of = lists.groupBy("node").agg(F.count(F.lit(1)).alias("lists"))
    judged = scratch_table(_with_centres(lists.join(lists_of, "node"), [F.col("lists")], percent), "pairs")
    found = components(fetched.linked(judged))
    open_ = _open_lists(lists, found)
    drawn = _with_centres(open_, [F.xxhash64(F.lit(n), "key", "node") for n in range(_DRAWS)], percent) if _DRAWS else judged.limit(0)
    for step, wanted in enumerate((lambda: drawn, lambda: _pairs_apart(open_, fetched, percent))):
        pairs = scratch_table(wanted().join(judged, ["a", "b"], "left_anti"), "pairs")
        if not pairs.limit(1).count():
            continue
        judged, found = judged.unionByName(pairs), _united(found, fetched.linked(pairs))
        open_ = _open_lists(lists, found) if step == 0 else open_

    named = nodes.join(found, "node", "left").select("s1", "s2", "id", F.coalesce("component", "node").alias("component"))
    names = scratch_table(named.groupBy("component").agg(F.min("id").alias("component_id")), "names")
    named = scratch_table(named.join(names, "component").select("s1", "s2", "component_id"), "named")
    rows = signed.select("id", "n", "s1", "s2")
    out = rows.filter("n > 0").join(named, ["s1", "s2"]).select("id", "n", "component_id")
    out = out.unionByName(rows.filter("n = 0").select("id", "n", F.col("id").alias("component_id")))
    kept = (F.col("id") == F.col("component_id")).alias("kept")
    return out.select(doc_id(), F.col("n").cast("long").alias("n_shingles"), doc_id("component_id").alias("component_id"), kept)
