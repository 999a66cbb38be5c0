"""The prefix trie of conversations, in double arrays.

A conversation is rebuilt from the first turns that it shares with the head of its group, and its own turns after those. Every
prefix has a 128-bit key, an exclusive or of hashes of (place, turn), so it comes from a running window and no conversation is
gathered into a row.

A prefix with more turns below it than a shard takes is an upper node. Below the upper nodes the prefixes are dealt into shards of
bounded size: each numbers its turns densely, packs the trie into the arrays BASE and CHECK (the child of node s by turn t is at
``BASE[s] + t`` if ``CHECK`` there is s), walks them for the node of each turn, and adds up the subtrees. Upper nodes are shared by
shards: counts of their members are summed over all conversations, what shards found below them is summed by parent, and passed up
by pointer doubling.
"""

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from opinara.llm.common import batches, scratch_table

SHARD_ROWS = 20_000  # turns below the prefixes of a shard; more make a prefix an upper node, which changes no result
PIECE = 10_000  # members in a piece of an upper node's ends
GROUP = 20
SHARED = 4  # a conversation shares 0 to 3 turns

NODES = "conv_id long, depth long, q1 long, q2 long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends array<long>"
_NODES = pa.schema([(c.split()[0], pa.list_(pa.int64()) if c.endswith("array<long>") else pa.int64()) for c in NODES.split(", ")])
_PIECES = pa.schema([("conv_id", pa.int64()), ("depth", pa.int64()), ("first", pa.int64()), ("members", pa.list_(pa.int64()))])
_DIGESTS = pa.schema([("conv_id", pa.int64()), ("depth", pa.int64()), ("digest", pa.string())])


# ---- rebuilt conversations ----


def _place_hash(salt: int) -> Column:
    return F.xxhash64(F.lit(salt), "pos", "x1", "x2")


def paths(conversations: DataFrame) -> DataFrame:
    """conv, pos (0: the root), x1 and x2 (hashes of the turn), words, length (turns of the rebuilt conversation), p1 and p2 (key of
    the prefix) for every turn of every rebuilt conversation. All steps work on one shuffle, by group."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    conv = F.col("conv_id").cast("long")
    rows = conversations.filter(conv.isNotNull()).select(
        (conv - conv % GROUP).alias("group"),
        conv.alias("conv"),
        F.col("turn"),
        F.xxhash64(F.lit(1), role, text).alias("x1"),
        F.xxhash64(F.lit(2), role, text).alias("x2"),
        F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("words"),
    )
    of_conv = Window.partitionBy("group", "conv")
    own = rows.withColumn("own", F.row_number().over(of_conv.orderBy(F.col("turn").asc_nulls_first(), "x1", "x2")).cast("long"))
    own = own.withColumn("n_own", F.count(F.lit(1)).over(of_conv))
    turn = F.struct("own", "x1", "x2", "words")
    is_head = (F.col("conv") == F.col("group")) & (F.col("own") < SHARED)
    own = own.withColumn("head", F.array_sort(F.collect_list(F.when(is_head, turn)).over(Window.partitionBy("group"))))
    shared = F.crc32(F.col("conv").cast("string").cast("binary")) % SHARED
    own = own.withColumn("shared", shared).withColumn("head", F.slice("head", F.lit(1), F.col("shared").cast("int")))
    n_head = F.size("head").cast("long")

    def placed(pos, x1, x2, words):
        return F.struct(pos.cast("long").alias("pos"), x1.alias("x1"), x2.alias("x2"), words.alias("words"))

    none, zero = F.lit(None).cast("long"), F.lit(0).cast("long")
    begin = F.concat(F.array(placed(zero, none, none, zero)), F.transform("head", lambda t: placed(t["own"], t["x1"], t["x2"], t["words"])))
    rest = F.array(placed(F.col("own") - F.col("shared") + n_head, F.col("x1"), F.col("x2"), F.col("words")))
    nothing = F.slice(rest, 1, 0)
    turns = F.concat(F.when(F.col("own") == 1, begin).otherwise(nothing), F.when(F.col("own") > F.col("shared"), rest).otherwise(nothing))
    length = n_head + F.greatest(F.col("n_own") - F.col("shared"), zero)
    rebuilt = own.select("group", "conv", length.alias("length"), F.inline(turns))
    so_far = of_conv.orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    keys = [F.bit_xor(F.when(F.col("pos") == 0, zero).otherwise(_place_hash(salt))).over(so_far) for salt in (3, 4)]
    return rebuilt.select("conv", "pos", "x1", "x2", "words", "length", keys[0].alias("p1"), keys[1].alias("p2"))


# ---- double arrays ----


class DoubleArray:
    """A trie over dense turn ids. Node 0 is the root; ``check`` is -1 where no node is."""

    _TRIES = 256

    def __init__(self, n_ids: int):
        self.n_ids = n_ids
        self.base, self.check = np.zeros(1024, np.int64), np.full(1024, -1, np.int64)
        self.check[0] = 0
        self.low, self.top = 1, 1  # no free slot below low, no node from top on

    def _reach(self, end: int) -> None:
        if end > len(self.check):
            more = max(end, 2 * len(self.check)) - len(self.check)
            self.base, self.check = np.r_[self.base, np.zeros(more, np.int64)], np.r_[self.check, np.full(more, -1, np.int64)]

    def _free(self, most: int) -> np.ndarray:
        """The next free slots."""
        self._reach(self.top + most)
        holes = self.low + np.flatnonzero(self.check[self.low : self.top] < 0)[:most]
        return np.r_[holes, np.arange(self.top, self.top + most - len(holes))]

    def _taken(self, last: int) -> None:
        self.top = max(self.top, last + 1)
        while self.low < self.top and self.check[self.low] >= 0:
            some = self.check[self.low : self.low + 4096]
            open_ = np.flatnonzero(some < 0)
            self.low += int(open_[0]) if len(open_) else len(some)

    def add(self, parents: np.ndarray, ids: np.ndarray) -> None:
        """Children of nodes that have none yet, sorted by parent and id, without repeats."""
        first = np.flatnonzero(np.r_[True, parents[1:] != parents[:-1]])
        sizes = np.diff(np.r_[first, len(parents)])
        for at, size in zip(first[sizes > 1].tolist(), sizes[sizes > 1].tolist(), strict=True):
            self._add_many(int(parents[at]), ids[at : at + size])
        single = first[sizes == 1]
        if len(single):
            slots = self._free(len(single))
            self.base[parents[single]] = slots - ids[single]
            self.check[slots] = parents[single]
            self._taken(int(slots.max()))

    def _add_many(self, parent: int, ids: np.ndarray) -> None:
        """First fit among the next free slots, or behind the last node."""
        offsets = ids - ids[0]
        self._reach(self.top + self._TRIES + int(offsets[-1]) + 1)
        starts = self._free(self._TRIES)
        self._reach(int(starts[-1]) + int(offsets[-1]) + 1)
        fits = np.ones(len(starts), bool)
        for offset in offsets[1:].tolist():
            fits &= self.check[starts + offset] < 0
        start = int(starts[fits.argmax()]) if fits.any() else self.top
        self.base[parent] = start - ids[0]
        self.check[start + offsets] = parent
        self._taken(start + int(offsets[-1]))

    def step(self, nodes: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """The children of nodes by turn ids; -1 where there is none."""
        found = self.base[nodes] + ids
        inside = (found >= 0) & (found < len(self.check))
        return np.where(inside & (self.check[np.where(inside, found, 0)] == nodes), found, -1)


def pack(ids: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> DoubleArray:
    """The trie of sequences of ids, level by level. Sequences are sorted by falling length."""
    trie = DoubleArray(int(ids.max()) + 1 if len(ids) else 0)
    nodes = np.zeros(len(starts), np.int64)
    for depth in range(int(lengths[0]) if len(lengths) else 0):
        alive = np.searchsorted(-lengths, -depth)
        level = ids[starts[:alive] + depth]
        children = np.unique(nodes[:alive] * trie.n_ids + level)
        trie.add(children // trie.n_ids, children % trie.n_ids)
        nodes = trie.step(nodes[:alive], level)
    return trie


def walk(trie: DoubleArray, ids: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The node of each place of each sequence."""
    out, nodes = np.zeros(len(ids), np.int64), np.zeros(len(starts), np.int64)
    for depth in range(int(lengths[0]) if len(lengths) else 0):
        alive = np.searchsorted(-lengths, -depth)
        nodes = trie.step(nodes[:alive], ids[starts[:alive] + depth])
        out[starts[:alive] + depth] = nodes
    return out


def shard_nodes(rows: dict[str, np.ndarray]) -> dict[str, list]:
    """The nodes of one shard, from its rows in the order of root, conv and pos."""
    conv, pos, root1, root2 = (rows[c] for c in ("conv", "pos", "root1", "root2"))
    begins = np.r_[True, (conv[1:] != conv[:-1]) | (root1[1:] != root1[:-1]) | (root2[1:] != root2[:-1])]
    # The first turn below an upper node is named by the key of its whole prefix
    k1, k2 = np.where(begins, root1, rows["x1"]), np.where(begins, root2, rows["x2"])
    order = np.lexsort((k2, k1))
    new = np.r_[True, (np.diff(k1[order]) != 0) | (np.diff(k2[order]) != 0)]
    ids = np.empty(len(conv), np.int64)
    ids[order] = np.cumsum(new) - 1
    starts = np.flatnonzero(begins)
    lengths = np.diff(np.r_[starts, len(conv)])
    longest = np.argsort(-lengths, kind="stable")
    starts, lengths = starts[longest], lengths[longest]
    trie = pack(ids, starts, lengths)
    node = walk(trie, ids, starts, lengths)

    size = trie.top
    parent = trie.check[:size]
    first = np.full(size, np.iinfo(np.int64).max)
    np.minimum.at(first, node, conv)
    members = np.bincount(node, minlength=size)
    depth, words = np.zeros(size, np.int64), np.zeros(size, np.int64)
    depth[node], words[node] = pos, rows["words"]
    q1, q2 = np.zeros(size, np.int64), np.zeros(size, np.int64)
    q1[node[begins]], q2[node[begins]] = rows["q1"][begins], rows["q2"][begins]
    used = np.flatnonzero(parent >= 0)
    used = used[used > 0]
    children = np.bincount(parent[used], minlength=size)
    leaves, saved = (children == 0).astype(np.int64), (members - 1) * words
    level = np.zeros(size, np.int64)
    level[node] = np.arange(len(conv)) - np.repeat(np.flatnonzero(begins), np.diff(np.r_[np.flatnonzero(begins), len(conv)]))
    deepest = used[np.argsort(-level[used], kind="stable")]
    for some in np.split(deepest, np.flatnonzero(np.diff(level[deepest])) + 1):
        if len(some) and level[some[0]] > 0:
            np.add.at(leaves, parent[some], leaves[some])
            np.add.at(saved, parent[some], saved[some])

    last = starts + lengths - 1
    by_node = np.lexsort((conv[last], node[last]))
    end_nodes, end_convs = node[last][by_node], conv[last][by_node]
    cuts = np.searchsorted(end_nodes, used), np.searchsorted(end_nodes, used, "right")
    listed = end_convs.tolist()
    at_top = parent[used] == 0
    return {
        "conv_id": first[used].tolist(),
        "depth": depth[used].tolist(),
        "q1": [q if top else None for q, top in zip(q1[used].tolist(), at_top.tolist(), strict=True)],
        "q2": [q if top else None for q, top in zip(q2[used].tolist(), at_top.tolist(), strict=True)],
        "parent_conv_id": [None if top else p for p, top in zip(first[parent[used]].tolist(), at_top.tolist(), strict=True)],
        "n_convs": members[used].tolist(),
        "n_children": children[used].tolist(),
        "n_leaves": leaves[used].tolist(),
        "saved_tokens": saved[used].tolist(),
        "ends": [listed[a:b] for a, b in zip(*(c.tolist() for c in cuts), strict=True)],
    }


def _shards(shard_rows: int):
    """Whole roots are taken together until a shard is full."""
    names = ["root1", "root2", "q1", "q2", "conv", "pos", "x1", "x2", "words"]

    def rows(parts):
        held: list[dict[str, np.ndarray]] = []
        n = 0
        for part in parts:
            if not part.num_rows:
                continue
            some = {c: part.column(c).to_numpy() for c in names}
            root1, root2 = some["root1"], some["root2"]
            new = np.ones(part.num_rows, bool)
            new[1:] = (root1[1:] != root1[:-1]) | (root2[1:] != root2[:-1])
            new[0] = not held or (held[-1]["root1"][-1], held[-1]["root2"][-1]) != (root1[0], root2[0])
            at = 0
            for cut in np.flatnonzero(new).tolist():
                if n + cut - at >= shard_rows:
                    held.append({c: v[at:cut] for c, v in some.items()})
                    yield shard_nodes({c: np.concatenate([h[c] for h in held]) for c in names})
                    held, n, at = [], 0, cut
            held.append({c: v[at:] for c, v in some.items()})
            n += part.num_rows - at
        if held:
            yield shard_nodes({c: np.concatenate([h[c] for h in held]) for c in names})

    def run(parts):
        yield from batches(rows(parts), _NODES, 50_000)

    return run


# ---- the whole trie ----


def _upper_sums(upper: DataFrame) -> DataFrame:
    """p1, p2 and the sums of leaves and saved over each node's subtree. After k rounds a node has the sums of what is less than
    2 ** k below it, and knows the node that far above it."""
    sums = scratch_table(upper.select("p1", "p2", "leaves", "saved", F.col("q1").alias("a1"), F.col("q2").alias("a2")), "upper-sums")
    while sums.filter("a1 is not null").limit(1).count():
        moving = sums.filter("a1 is not null")
        passed = moving.groupBy("a1", "a2").agg(F.sum("leaves").alias("more_leaves"), F.sum("saved").alias("more_saved"))
        passed = passed.withColumnsRenamed({"a1": "p1", "a2": "p2"})
        above = sums.select(F.col("p1").alias("a1"), F.col("p2").alias("a2"), F.col("a1").alias("b1"), F.col("a2").alias("b2"))
        joined = sums.join(passed, ["p1", "p2"], "left").join(above, ["a1", "a2"], "left")
        sums = joined.select(
            "p1",
            "p2",
            (F.col("leaves") + F.coalesce("more_leaves", F.lit(0))).alias("leaves"),
            (F.col("saved") + F.coalesce("more_saved", F.lit(0))).alias("saved"),
            F.col("b1").alias("a1"),
            F.col("b2").alias("a2"),
        )
        sums = scratch_table(sums, "upper-sums")
    return sums.select("p1", "p2", "leaves", "saved")


def build(conversations: DataFrame, shard_rows: int = SHARD_ROWS) -> tuple[DataFrame, DataFrame]:
    """The nodes of the trie of a table with conv_id, turn, role and text, and the members that end at upper nodes.

    Nodes have conv_id (smallest member; with depth it names the node), depth, parent_conv_id (null at the root), n_convs (members),
    n_children, n_leaves (childless nodes in the subtree), saved_tokens (over the subtree, n_convs - 1 times the words of the last
    turn) and ends: the members that end there, ascending; null for upper nodes, whose ends are in the second table in pieces
    (conv_id, depth, first, members).

    Turns are ordered by turn, null first; turns with one number by a hash of role and text, so that reruns agree, and rows that are
    equal are turns of their own. A null role or text is empty. Rows without a conv_id are left out; an empty table has no nodes.
    Remainders of negative conv_ids are as in SQL. Other columns are ignored.
    """
    turns = scratch_table(paths(conversations), "paths")
    below = turns.groupBy("p1", "p2").agg(F.sum(F.col("length") - F.col("pos") + 1).alias("below"), F.min("pos").alias("pos"))
    heavy = scratch_table(below.filter((F.col("below") > shard_rows) | (F.col("pos") == 0)).select("p1", "p2", F.lit(True).alias("upper")), "heavy")
    flagged = turns.join(heavy, ["p1", "p2"], "left")
    parents = [F.when(F.col("pos") > 0, F.col(p).bitwiseXOR(_place_hash(salt))) for p, salt in (("p1", 3), ("p2", 4))]
    flagged = flagged.withColumns({"q1": parents[0], "q2": parents[1]})

    light = flagged.filter("upper is null")
    so_far = Window.partitionBy("conv").orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    dealt = light.select(
        "conv", "pos", "x1", "x2", "words", *(F.first(c).over(so_far).alias(name) for c, name in (("p1", "root1"), ("p2", "root2"), ("q1", "q1"), ("q2", "q2")))
    )
    partitions = int(conversations.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = dealt.repartition(partitions, "root1", "root2").sortWithinPartitions("root1", "root2", "conv", "pos")
    shards = scratch_table(dealt.mapInArrow(_shards(shard_rows), NODES), "shards")

    shared = flagged.filter("upper").groupBy("p1", "p2").agg(
        F.count(F.lit(1)).alias("n_convs"), *(F.min(c).alias(c) for c in ("conv", "pos", "words", "q1", "q2"))
    )
    shared = scratch_table(shared, "shared")
    tops = shards.filter("q1 is not null")
    under = tops.groupBy("q1", "q2").agg(F.count(F.lit(1)).alias("n_tops"), F.sum("n_leaves").alias("leaves"), F.sum("saved_tokens").alias("saved"))
    inner = shared.filter("q1 is not null").groupBy("q1", "q2").agg(F.count(F.lit(1)).alias("n_inner"))
    upper = shared
    for sums in (under, inner):
        upper = upper.join(sums.withColumnsRenamed({"q1": "p1", "q2": "p2"}), ["p1", "p2"], "left")
    upper = upper.fillna(0, ["n_tops", "n_inner", "leaves", "saved"]).withColumn("n_children", F.col("n_tops") + F.col("n_inner"))
    leaf = F.when(F.col("n_children") == 0, 1).otherwise(0)
    upper = upper.withColumns({"leaves": F.col("leaves") + leaf, "saved": F.col("saved") + (F.col("n_convs") - 1) * F.col("words")})
    upper = scratch_table(upper, "upper")

    named = shared.select(F.col("p1").alias("q1"), F.col("p2").alias("q2"), F.col("conv").alias("parent_conv_id"))
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends"]
    uppers = upper.drop("leaves", "saved").join(_upper_sums(upper), ["p1", "p2"]).join(named, ["q1", "q2"], "left")
    uppers = uppers.select(
        F.col("conv").alias("conv_id"), F.col("pos").alias("depth"), "parent_conv_id", "n_convs", "n_children",
        F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"), F.lit(None).cast("array<long>").alias("ends"),
    )
    tops = tops.drop("parent_conv_id").join(named, ["q1", "q2"])
    nodes = shards.filter("q1 is null").select(*columns).unionByName(tops.select(*columns)).unionByName(uppers.select(*columns))

    ended = flagged.filter("upper and pos = length").select("p1", "p2", F.col("conv").alias("member"))
    ended = ended.join(shared.select("p1", "p2", F.col("conv").alias("conv_id"), F.col("pos").alias("depth")), ["p1", "p2"])
    ended = ended.select("conv_id", "depth", "member").repartitionByRange(partitions, "conv_id", "depth", "member")
    pieces = ended.sortWithinPartitions("conv_id", "depth", "member").mapInArrow(_pieces, "conv_id long, depth long, first long, members array<long>")
    return nodes, pieces


def _pieces(parts):
    def rows():
        for part in parts:
            if not part.num_rows:
                continue
            conv, depth, member = (part.column(c).to_numpy() for c in ("conv_id", "depth", "member"))
            cuts = np.flatnonzero((conv[1:] != conv[:-1]) | (depth[1:] != depth[:-1])) + 1
            cuts = np.union1d(cuts, np.arange(0, len(conv), PIECE))
            for a, b in zip(cuts.tolist(), [*cuts[1:].tolist(), len(conv)], strict=True):
                yield {"conv_id": [conv[a]], "depth": [depth[a]], "first": [member[a]], "members": [member[a:b].tolist()]}

    yield from batches(rows(), _PIECES, 100)


def digests(pieces: DataFrame) -> DataFrame:
    """conv_id, depth and the SHA-256 (lowercase hex) of the decimal members of all pieces of a node, joined by commas. Pieces are
    read one after another, so memory is bounded however many members end at a node."""

    def rows(parts):
        key, digest = None, None
        for part in parts:
            for conv, depth, members in zip(*(part.column(c).to_pylist() for c in ("conv_id", "depth", "members")), strict=True):
                if key != (conv, depth):
                    if key is not None:
                        yield {"conv_id": [key[0]], "depth": [key[1]], "digest": [digest.hexdigest()]}
                    key, digest = (conv, depth), hashlib.sha256()
                else:
                    digest.update(b",")
                digest.update(",".join(map(str, members)).encode())
        if key is not None:
            yield {"conv_id": [key[0]], "depth": [key[1]], "digest": [digest.hexdigest()]}

    def run(parts):
        yield from batches(rows(parts), _DIGESTS, 1_000)

    dealt = pieces.repartition("conv_id", "depth").sortWithinPartitions("conv_id", "depth", "first")
    return dealt.mapInArrow(run, "conv_id long, depth long, digest string")


def with_end_digests(nodes: DataFrame, pieces: DataFrame) -> DataFrame:
    """Nodes with ends_sha256 in place of ends: the SHA-256 of the members that end there (of nothing, if none does)."""
    listed = nodes.filter("ends is not null").withColumn("ends_sha256", F.sha2(F.array_join(F.col("ends").cast("array<string>"), ",").cast("binary"), 256))
    upper = nodes.filter("ends is null").join(digests(pieces), ["conv_id", "depth"], "left")
    upper = upper.withColumn("ends_sha256", F.coalesce("digest", F.sha2(F.lit("").cast("binary"), 256))).drop("digest")
    return listed.drop("ends").unionByName(upper.drop("ends"))
