"""b-bit MinHash against brute force over all pairs."""

import random
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest

from opinara.llm import bbit_minhash as bbit

LAST = 2**63 - 1


def word_sets(text, length):
    words = text.encode().lower().split() if text else []
    if not words:
        return frozenset()
    return frozenset([tuple(words)] if len(words) < length else [tuple(words[i : i + length]) for i in range(len(words) - length + 1)])


def by_pairs(rows, percent, length):
    """(doc_id, n_shingles, component_id, kept) of (doc_id, text)."""
    sets = [word_sets(t, length) for _, t in rows]
    root = list(range(len(rows)))

    def find(n):
        while root[n] != n:
            root[n] = root[root[n]]
            n = root[n]
        return n

    places = {}
    for n, s in enumerate(sets):
        for e in s:
            places.setdefault(e, []).append(n)
    pairs = {p for found in places.values() if len(found) < 200 for p in combinations(found, 2)} if len(rows) > 500 else combinations(range(len(rows)), 2)
    for a, b in pairs:
        common = len(sets[a] & sets[b])
        if sets[a] and sets[b] and 100 * common >= percent * (len(sets[a]) + len(sets[b]) - common):
            root[find(a)] = find(b)
    least = {}
    for n, (i, _) in enumerate(rows):
        least[find(n)] = min(least.get(find(n), LAST), LAST if i is None else i)
    out = []
    for n, (i, _) in enumerate(rows):
        c = least[find(n)] if sets[n] else LAST if i is None else i
        out.append((i, len(sets[n]), None if c == LAST else c, (LAST if i is None else i) == c))
    return sorted(out, key=str)


def by_spark(docs, *args):
    return sorted((tuple(r) for r in bbit.near_duplicates(docs, *args).collect()), key=str)


def test_odd_rows(odd_docs, odd_rows):
    assert by_spark(odd_docs) == by_pairs([r[:2] for r in odd_rows], 85, 3)


def test_clashing_columns(spark, odd_rows):
    rows = [(*r[:2], 1, 2, "x", 3, "y", 4) for r in odd_rows]
    docs = spark.createDataFrame(rows, "doc_id long, text string, id int, fp int, node string, key int, component string, n int")
    assert by_spark(docs) == by_pairs([r[:2] for r in odd_rows], 85, 3)


def test_small_table(spark, folder, small_docs):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    assert by_spark(docs) == by_pairs([r[:2] for r in small_docs], 85, 3)


def test_empty_table(no_docs):
    assert by_spark(no_docs) == []


@pytest.fixture(scope="module")
def families():
    """Near copies at all distances around the threshold, chains of them, copies of copies, and supersets."""
    rng = random.Random(4)
    rows, i = [], 0
    for length in [6, 8, 9, 15, 40, 200, 700] * 3:
        base = [f"w{rng.randint(0, 5000)}" for _ in range(length)]
        copy = list(base)
        for _ in range(12):
            rows.append((i, " ".join(copy)))
            i += 1
            source = base if rng.random() < 0.5 else copy
            copy = list(source)
            for _ in range(rng.randint(0, max(1, length // 15))):
                copy[rng.randrange(len(copy))] = f"w{rng.randint(0, 5000)}"
            if rng.random() < 0.3:
                copy.append(f"w{rng.randint(0, 5000)}")
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("draws, block, rare", [(bbit._DRAWS, 4096, 16), (0, 2, 1), (0, 2, 4)])
def test_families(spark, families, monkeypatch, draws, block, rare):
    monkeypatch.setattr(bbit, "_RARE", rare)
    monkeypatch.setattr(bbit, "_DRAWS", draws)
    monkeypatch.setattr(bbit, "_BLOCK", block)
    docs = spark.createDataFrame(families, "doc_id long, text string").repartition(6)
    got = by_spark(docs)
    assert got == by_pairs(families, 85, 3)
    assert len({r[2] for r in got}) < len(families)


def test_copies_without_their_text(spark, monkeypatch):
    """Copies of a text that isn't there, each with two other words: few of them link, and the others don't meet in all pairs."""
    rng = random.Random(9)
    base = [f"w{n}" for n in range(80)]
    rows = []
    for i in range(120):
        copy = list(base)
        for place in rng.sample(range(5, 75), 2):
            copy[place] = f"x{i}y{place}"
        rows.append((i, " ".join(copy)))
    met, pairs_apart = [], bbit._pairs_apart
    monkeypatch.setattr(bbit, "_pairs_apart", lambda *given: met.append(pairs_apart(*given)) or met[-1])
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert by_spark(docs) == by_pairs(rows, 85, 3)
    assert met[0].count() < 120 * 119 / 2 / 10


def test_other_thresholds(spark, families):
    docs = spark.createDataFrame(families, "doc_id long, text string")
    assert by_spark(docs, 80, 5) == by_pairs(families, 80, 5)


def test_estimate_is_close_to_the_similarity(spark):
    rng = np.random.default_rng(8)
    rows = []
    for n, shared in enumerate([0, 200, 500, 800, 900, 1000]):
        common = rng.integers(0, 2**63, 1000).astype(np.uint64)
        one, other = common, np.r_[common[:shared], rng.integers(0, 2**63, 1000 - shared).astype(np.uint64)]
        bits = bbit.packed(bbit.minima([one, other])).view(np.int64)
        rows.append((n, shared / (2000 - shared), *bits[0].tolist(), *bits[1].tolist()))
    names = [f"g{n}{side}" for side in "xy" for n in range(bbit.WORDS)]
    table = spark.createDataFrame(rows, ["n", "similarity", *names])
    for r in table.select("similarity", bbit.estimate("x", "y").alias("e"), bbit.differences("x", "y").alias("d")).collect():
        assert abs(r.e - r.similarity) < 0.17
        assert (r.d <= bbit.most_differences(85)) == (r.similarity > 0.8)


def test_minima_and_bits_by_loops():
    rng = np.random.default_rng(1)
    sets = [rng.integers(0, 2**63, n).astype(np.uint64) for n in (1, 5, 70_000, 3)]
    found = bbit.minima(sets)
    bits = bbit.packed(found)
    for s, row, words in zip(sets, found, bits, strict=True):
        for k in (0, 7, 159):
            low = [((int(v) >> 32) ^ int(bbit._MASKS[k])) * int(bbit._FACTORS[k]) % 2**32 for v in s]
            assert row[k] == min(low)
            assert (int(words[k // 32]) >> (2 * (k % 32))) & 3 == (min(low) * 0x9E3779B1 % 2**32) >> 30
    assert [len(s) for s in bbit.shingle_sets(pa.array(["a b c d", None, "", " \n", "a b", "A B c\tb"]))] == [2, 0, 0, 0, 1, 2]
