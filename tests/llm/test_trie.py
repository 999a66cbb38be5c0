"""The prefix trie against a trie of dicts."""

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

from opinara.llm import prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string, p1 string, parent int, depth string, own int"


def remainder(c, n):
    return c % n if c >= 0 else -(-c % n)


def by_dicts(rows):
    """Every node as a tuple, from (conv_id, turn, role, text)."""
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append(((turn is not None, turn or 0), role or "", text or ""))
    own = {c: [t[1:] for t in sorted(turns, key=lambda t: t[0])] for c, turns in own.items()}
    whole = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        whole[c] = (own.get(c - remainder(c, 20), [])[:h]) + turns[h:]
    members = defaultdict(list)
    for c, turns in whole.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        leaves[node] = sum(leaves[n] for n in children[node]) or 1
        words = len(node[-1][1].encode().split()) if node else 0
        saved[node] = (len(members[node]) - 1) * words + sum(saved[n] for n in children[node])
    out = []
    for node, convs in members.items():
        ends = sorted(c for c in convs if len(whole[c]) == len(node))
        parent = min(members[node[:-1]]) if node else None
        digest = hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()
        out.append((min(convs), len(node), parent, len(convs), len(children[node]), leaves[node], saved[node], digest))
    return sorted(out, key=str)


def by_spark(table, shard_rows):
    nodes = prefix_trie.with_end_digests(*prefix_trie.build(table, shard_rows))
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return sorted((tuple(r) for r in nodes.select(*columns).collect()), key=str)


@pytest.fixture(scope="module")
def odd_turns():
    """Nulls, empty texts, repeated rows, one long conversation, copies of one conversation, groups without a head."""
    rng = random.Random(3)
    rows = []
    for c in [*range(45), 1000, 1019, -6, -25, -40, 2**62]:
        if c == 20:
            continue
        for turn in range(rng.randint(1, 6)):
            rows.append((c, turn, rng.choice(["user", "assistant", None]), rng.choice(["yes", "no  way", "", None, "tell me\tmore"])))
    rows += [(c, t, "user", f"copy of turn {t}") for c in range(100, 140) for t in range(4)]
    rows += [(200, t, "user", f"turn {t}") for t in range(150)] + [(201, t, "user", f"turn {t}") for t in range(149)]
    rows += [(7, None, "system", "first of all"), (8, 0, "user", "said twice"), (9, 50, "a", "x"), (9, 50, "a", "x")]
    rows += [(None, 0, "user", "nobody's"), (None, None, None, None)]
    rows = [r for r in rows if (r[0], r[1]) != (8, 0)] + [(8, 0, "user", "said twice")] * 2
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("shard_rows", [0, 3, 60, 20_000])
def test_odd_turns(spark, odd_turns, shard_rows):
    table = spark.createDataFrame([(*r, "clash", 1, "clash", 2) for r in odd_turns], SCHEMA).repartition(5)
    assert by_spark(table, shard_rows) == by_dicts(odd_turns)


def test_small_table(spark, folder):
    table = spark.read.parquet(f"{folder}/conversations.parquet")
    rows = [tuple(r) for r in table.select("conv_id", "turn", "role", "text").collect()]
    assert by_spark(table, prefix_trie.SHARD_ROWS) == by_dicts(rows)


def test_empty_and_turnless(spark):
    assert by_spark(spark.createDataFrame([], SCHEMA), 5) == []
    # a conversation that shares more turns than it and its missing head have is the root only
    lone = next(c for c in range(1, 20) if zlib.crc32(str(c).encode()) % 4 == 3)
    rows = [(lone, 0, "user", "gone")]
    table = spark.createDataFrame([(*r, "clash", 1, "clash", 2) for r in rows], SCHEMA)
    assert by_spark(table, 5) == by_dicts(rows) == [(lone, 0, None, 1, 0, 1, 0, hashlib.sha256(str(lone).encode()).hexdigest())]


def test_ties_have_one_order(spark):
    rows = [(0, 1, "user", t) for t in "abcdef"]
    tables = [spark.createDataFrame([(*r, "clash", 1, "clash", 2) for r in some], SCHEMA) for some in (rows, rows[::-1])]
    first, second = ([(r.depth, r.conv_id, r.saved_tokens) for r in prefix_trie.build(t)[0].orderBy("depth").collect()] for t in tables)
    assert first == second and len(first) == 7


def test_double_array_finds_what_was_packed_and_nothing_else():
    rng = np.random.default_rng(5)
    sequences = [tuple(rng.integers(0, 30, rng.integers(1, 9))) for _ in range(400)]
    sequences.sort(key=len, reverse=True)
    ids = np.array([i for s in sequences for i in s])
    lengths = np.array([len(s) for s in sequences])
    starts = np.cumsum(lengths) - lengths
    trie = prefix_trie.pack(ids, starts, lengths)
    nodes = prefix_trie.walk(trie, ids, starts, lengths)
    prefixes = {s[:d] for s in sequences for d in range(1, len(s) + 1)}
    found = {s[: d + 1]: nodes[at + d] for s, at in zip(sequences, starts, strict=True) for d in range(len(s))}
    assert len(set(found.values())) == len(prefixes) == int((trie.check[: trie.top] >= 0).sum()) - 1
    for prefix, node in found.items():
        missing = [i for i in range(30) if (*prefix, i) not in prefixes]
        assert (trie.step(np.full(len(missing), node), np.array(missing, np.int64)) < 0).all()


def test_digests_of_pieces_are_those_of_the_whole(spark, monkeypatch):
    rows = [(c, 0, "user", "same") for c in range(0, 20_000, 20)]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    assert by_spark(table, 10) == by_dicts(rows)
