"""Substring, line and set de-duplication against brute force."""

import hashlib
import random
from collections import Counter

import pytest

from opinara.llm import jaccard_join, line_dedup, substring_dedup

LAST = 2**63 - 1


def words(text):
    return (text or "").encode().split()


def repeats(rows, window):
    first = {}
    for i, t in rows:
        w = words(t)
        for k in range(len(w) - window + 1):
            key = tuple(w[k : k + window])
            first[key] = min(first.get(key, LAST), LAST if i is None else i)
    out = []
    for i, t in rows:
        w, gone = words(t), set()
        for k in range(len(w) - window + 1):
            if first[tuple(w[k : k + window])] < (LAST if i is None else i):
                gone.update(range(k, k + window))
        kept = b" ".join(x for k, x in enumerate(w) if k not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(kept).hexdigest()))
    return Counter(out)


@pytest.mark.parametrize(("window", "anchor"), [(50, 10), (12, 4), (5, 5)])
def test_substrings_of_odd_rows(odd_docs, odd_rows, window, anchor):
    got = substring_dedup.remove_repeats(odd_docs, window, anchor).select("doc_id", "n_words", "n_removed", "kept_sha256")
    assert Counter(map(tuple, got.collect())) == repeats([r[:2] for r in odd_rows], window)


def test_substrings_of_few_words(spark):
    """Overlapping repeats of a small vocabulary, where anchors tie and stretches differ."""
    rng = random.Random(3)
    rows = [(rng.randint(0, 30), " ".join(rng.choices("ab", weights=[3, 1], k=rng.randint(0, 60)))) for _ in range(60)]
    got = substring_dedup.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), 8, 3)
    assert Counter((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in got.collect()) == repeats(rows, 8)
    for r in got.collect():
        assert sum(x.stop - x.start for x in r.removed) == r.n_removed


def test_no_rows(no_docs):
    assert substring_dedup.remove_repeats(no_docs).collect() == []
    assert line_dedup.line_report(no_docs).collect() == []
    assert jaccard_join.document_components(no_docs).collect() == []
    assert jaccard_join.one_of_each(no_docs).collect() == []


def close(a, b):
    if a == b:
        return True
    if abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def line_verdicts(rows, least):
    places = []
    for i, t in set(rows):
        for no, line in enumerate((t or "").split("\n"), 1):
            if line.strip(" \t\n\x0b\x0c\r"):
                places.append((LAST if i is None else i, t, no, line.strip(" \t\n\x0b\x0c\r")))
    gone = Counter()
    for i, t, no, line in places:
        earlier = [p for p in places if (p[0], p[2]) < (i, no) or (p[0] < i)]
        near = any(p[3] == line or (len(line) >= least and len(p[3]) >= least and close(line, p[3])) for p in earlier if p[0] < i or (p[1] == t and p[2] < no))
        gone[(i, t)] += near
    return {(None if i == LAST else i, t): n for (i, t), n in gone.items()}


@pytest.mark.parametrize("least", [20, 1])
def test_lines_of_odd_rows(odd_docs, odd_rows, least):
    rows = [r[:2] for r in odd_rows if r[0] is not None and r[0] != 16]  # one text per doc_id: the order is known
    expected = line_verdicts(rows, least)
    docs = odd_docs.filter("doc_id is not null and doc_id <> 16")
    got = line_dedup.line_report(docs, least)
    by_id = {}
    for r in got.collect():
        by_id.setdefault(r.doc_id, []).append((r.n_removed, len(r.removed)))
    for i, t in rows:
        assert set(by_id[i]) == {(expected.get((i, t), 0),) * 2}
    assert sum(map(len, by_id.values())) == len(rows)


def test_lines_within_one_edit(spark):
    rng = random.Random(9)
    base = ["".join(rng.choices("abé ", k=rng.randint(1, 24))) + "x" for _ in range(40)]
    rows = []
    for i in range(60):
        line = rng.choice(base)
        for _ in range(rng.randint(0, 2)):
            k = rng.randint(0, len(line))
            line = line[:k] + rng.choice(["", "a", "é"]) + line[k + rng.randint(0, 1) :]
        rows.append((i, "\n".join([line, rng.choice(base)])))
    got = line_dedup.line_report(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), least=3)
    expected = line_verdicts(rows, 3)
    assert {r.doc_id: r.n_removed for r in got.collect()} == {i: expected.get((i, t), 0) for i, t in rows}


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


@pytest.mark.parametrize("edits", [2, 3])
def test_lines_within_more_edits(spark, edits):
    rng = random.Random(edits)
    base = ["".join(rng.choices("abé ", k=rng.randint(1, 20))) + "x" for _ in range(25)]
    rows = []
    for i in range(60):
        line = rng.choice(base)
        for _ in range(rng.randint(0, 4)):
            k = rng.randint(0, len(line))
            line = line[:k] + rng.choice(["", "a", "é"]) + line[k + rng.randint(0, 1) :]
        rows.append((i, line.strip()))
    rows += [(60, "a line of des ouiere that is long"), (61, "a line of des oui-ere, that is long")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = {r.doc_id: r.n_removed for r in line_dedup.line_report(docs, least=3, edits=edits).collect()}
    alike = lambda a, b: a == b or (min(len(a), len(b)) >= 3 and distance(a, b) <= edits)
    assert got == {i: int(bool(t) and any(alike(t, u) for _, u in rows[:i])) for i, t in rows}
    assert got[61] == 1


def test_remove_lines(spark):
    docs = spark.createDataFrame([(1, "keep this line as it is\n\nand this"), (2, "keep this line as it is!\n\nand that"), (3, None)], "doc_id long, text string")
    got = {r.doc_id: (r.text, r.n_removed) for r in line_dedup.remove_lines(docs).collect()}
    assert got == {1: ("keep this line as it is\n\nand this", 0), 2: ("\nand that", 1), 3: (None, 0)}


def shingle_set(text, length):
    w = (text or "").encode().lower().split()
    return {tuple(w[k : k + length]) for k in range(max(1, len(w) - length + 1))} if w else set()


def linked_components(rows, percent, length):
    sets = [shingle_set(t, length) for _, t in rows]
    parent = list(range(len(rows)))

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for a in range(len(rows)):
        for b in range(a):
            common = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * common >= percent * len(sets[a] | sets[b]):
                parent[root(a)] = root(b)
    least = {}
    for k, (i, _) in enumerate(rows):
        least[root(k)] = min(least.get(root(k), LAST), LAST if i is None else i)
    names = [least[root(k)] for k in range(len(rows))]
    return Counter((i, len(s), None if c == LAST else c) for (i, _), s, c in zip(rows, sets, names, strict=True)), root


@pytest.mark.parametrize(("percent", "length"), [(85, 4), (80, 5)])
def test_components_of_odd_rows(odd_docs, odd_rows, percent, length):
    got = jaccard_join.document_components(odd_docs, percent, length)
    expected, _ = linked_components([r[:2] for r in odd_rows], percent, length)
    assert Counter(map(tuple, got.collect())) == expected


@pytest.mark.parametrize("most", [0, 20, 256])
def test_components_of_small_and_large_sets(spark, monkeypatch, most):
    """Chains of near copies on both sides of the boundary, wherever it is."""
    monkeypatch.setattr(jaccard_join, "boundary", lambda sizes, percent: most)
    rng = random.Random(most)
    rows = []
    for _ in range(14):
        text = [str(rng.randint(0, 25)) for _ in range(rng.choice([6, 9, 12, 20, 40, 70]))]
        for _ in range(rng.randint(1, 6)):
            rows.append((len(rows) * 7 % 101, " ".join(text)))
            k = rng.choice([0, len(text) - 1, rng.randrange(len(text))])
            text = [*text[:k], str(rng.randint(0, 25)), *text[k + rng.randint(0, 1) :]]
    got = jaccard_join.document_components(spark.createDataFrame(rows, "doc_id long, text string").repartition(4))
    expected, _ = linked_components(rows, 85, 4)
    assert Counter(map(tuple, got.collect())) == expected


def test_one_of_each(odd_docs, odd_rows):
    kept = jaccard_join.one_of_each(odd_docs)
    assert kept.columns == odd_docs.columns
    rows = [r[:2] for r in odd_rows]
    _, root = linked_components(rows, 85, 4)
    groups = {}
    for k, (i, t) in enumerate(rows):
        if words(t):
            groups.setdefault(root(k), []).append(LAST if i is None else i)
    expected = Counter(min(g) for g in groups.values())
    got = Counter(LAST if r.doc_id is None else r.doc_id for r in kept.collect() if words(r.text))
    assert got == expected
    assert sum(not words(r.text) for r in kept.collect()) == sum(not words(t) for _, t in rows)


def test_only_texts_of_pairs_are_fetched(spark, monkeypatch):
    """Entries are dealt once and not written before, and texts that only meet others that they can't link with stay where they are."""
    rng, written, write = random.Random(6), {}, jaccard_join.scratch_table

    def keep(df, label):
        written[label] = write(df, label)
        return written[label]

    monkeypatch.setattr(jaccard_join, "scratch_table", keep)
    monkeypatch.setattr(jaccard_join, "boundary", lambda sizes, percent: 0)
    prose = lambda n: [f"w{rng.randint(0, 10**9)}" for _ in range(n)]
    rows = []
    for i in range(0, 30, 3):  # passages in two texts each, so that they lead the order, and sizes that differ too much
        one, two, three = prose(100), prose(200), prose(400)
        rows += [(i, " ".join(one + two)), (i + 1, " ".join(two + three)), (i + 2, " ".join(three + one))]
    near = prose(100)
    rows += [(100, " ".join(near)), (101, " ".join([*near, "more"]))]
    got = jaccard_join.document_components(spark.createDataFrame(rows, "doc_id long, text string").repartition(4))
    assert {r.doc_id: r.component_id for r in got.collect()} == {i: i for i, _ in rows} | {101: 100}
    ends = {n for p in written["pairs"].collect() for n in p}
    assert {r.node for r in written["texts"].collect()} == ends and "entries" not in written
    assert len(ends) < len({r.node for r in written["lists"].collect()})
    plan = jaccard_join._lists(spark.createDataFrame([(1, 2, 3, 4)], "key long, node long, n int, place int"))
    assert str(plan._jdf.queryExecution().executedPlan()).count("Exchange") == 1


def test_boundary_follows_cost():
    assert jaccard_join.boundary({}, 85) == 0
    assert 6 <= jaccard_join.boundary({n: 10 for n in range(6, 400)}, 85) < 256
