"""Language, toxicity, quality, mixing and decontamination against brute force and held-out rows."""

import itertools
import math
import random
from collections import Counter

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from opinara.llm import decontaminate, language_id, mixing, quality_rules, registry, toxicity

LAST = 2**63 - 1


# language identification


def counts_of(texts):
    uses = Counter()
    for lang, text in texts:
        data = b"\n\n\n" + text.encode().lower()
        for k in range(3, len(data)):
            uses[lang, int.from_bytes(data[k - 3 : k + 1], "big")] += 1
    return pd.DataFrame([(lang, gram, n) for (lang, gram), n in uses.items()], columns=["lang", "gram", "uses"])


def plain_bits(model, training, text):
    """Code length by the recursive definition."""
    symbols = lambda s: [int(model.symbol[b]) for b in b"\n\n\n" + s.encode().lower()]
    seen = Counter()
    for t in training:
        s = symbols(t)
        for k in range(3, len(s)):
            for depth in range(4):
                seen[tuple(s[k - depth : k]), s[k]] += 1

    def chances(context):
        below = dict.fromkeys(range(128), 1 / 128) if not context else chances(context[1:])
        here = {sym: seen[context, sym] for sym in range(128) if seen[context, sym]}
        base = {sym: 1 / 128 for sym in range(128)} if not context else below
        if not here:
            return base
        rest = sum(p for sym, p in base.items() if sym not in here)
        total = sum(here.values())
        if rest <= 0:
            return {sym: n / total for sym, n in here.items()}
        return {sym: here[sym] / (total + len(here)) if sym in here else len(here) / (total + len(here)) * p / rest for sym, p in base.items()}

    s, bits = symbols(text), 0.0
    for k in range(3, len(s)):
        bits -= math.log2(chances(tuple(s[k - 3 : k]))[s[k]])
        bits += math.log2(model.others) if s[k] == 127 else 0
    return bits


def test_code_lengths():
    training = [("a", "the cat sat on the mat. THE END"), ("a", "the hat"), ("b", "der hut ist größer. das ende"), ("b", "")]
    model = language_id.Model(counts_of(training))
    texts = ["the cat", "größer als", "\x00\x01 ~", "", "ähnlich the mat"]
    got = model.bits([t.encode() for t in texts])
    for n, lang in enumerate(model.langs):
        mine = [t for x, t in training if x == lang]
        assert got[:, n] == pytest.approx([plain_bits(model, mine, t) for t in texts], rel=1e-5)


def test_chances_add_up_to_one():
    model = language_id.Model(counts_of([("a", "abracadabra"), ("a", "".join(map(chr, range(32, 127))) * 3)]))
    bits = model.costs[0].reshape(-1, 128).astype(np.float64)
    bits[:, -1] -= math.log2(model.others)
    assert np.exp2(-bits).sum(1) == pytest.approx(1, abs=1e-4)


def test_language_of_odd_rows(spark, odd_docs, odd_rows, no_docs):
    model = language_id.Model(counts_of([("de", "der die das und größe"), ("en", "the and of words alpha beta gamma")]))
    got = language_id.identify(odd_docs, model).select("doc_id", "text", "language.*").collect()
    assert len(got) == len(odd_rows)
    for r in got:
        if not r.text or not any(c.isalpha() for c in r.text):
            assert (r.lang_pred, r.score) == ("und", 0.0)
        else:
            assert r.lang_pred in ("de", "en") and 0.5 <= r.score <= 1
    nothing = language_id.train(no_docs)
    assert {tuple(r) for r in language_id.identify(odd_docs, nothing).select("language.*").collect()} == {("und", 0.0)}
    assert language_id.identify(no_docs, model).collect() == []


def test_language_of_held_out_rows(spark, folder):
    found = registry.QUERIES["op3_language_id"](spark, folder)
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "lang")
    rows = found.join(docs, "doc_id").filter("held_out").collect()
    assert len(rows) > 20
    assert sum(r.lang == r.lang_pred for r in rows) >= 0.95 * len(rows)


def test_all_labelled_texts_are_learned(spark):
    """Statistics and limits come from every labelled text, however many there are."""
    rng = random.Random(5)
    texts = [("ab"[k % 2], " ".join("".join(rng.choices("aeinrst" if k % 2 else "bdglomu", k=5)) for _ in range(20)) + f" {k}") for k in range(1500)]
    docs = spark.createDataFrame([(k, *t) for k, t in enumerate(texts)] + [(-1, None, "zzz"), (-2, "a", None)], "doc_id long, lang string, text string")
    counts = language_id.gram_counts(docs.repartition(5))
    assert {(r.lang, r.gram): r.uses for r in counts.itertuples()} == {(r.lang, r.gram): r.uses for r in counts_of(texts).itertuples()}
    assert (counts["half_0"] + counts["half_1"] == counts["uses"]).all() and 0.4 < counts["half_0"].sum() / counts["uses"].sum() < 0.6
    some = [t.encode() for _, t in texts[:20]]
    assert language_id.train(docs).bits(some) == pytest.approx(language_id.Model(counts_of(texts)).bits(some), abs=1e-6)
    halves = [[(r.lang, r.text) for r in language_id.labelled(docs).filter(f"half = {n}").collect()] for n in (0, 1)]
    models = [language_id.Model(counts_of(h)) for h in halves]
    pieces = {"a": [], "b": []}
    for n in (0, 1):
        for lang, text in halves[n]:
            bits = models[1 - n].byte_bits(text.encode(), lang)
            pieces[lang] += [int(bits[k : k + 8].mean(dtype=float) * 64) for k in range(0, len(bits) - 7, 8)]
    for lang, held in language_id.limits(docs).items():
        middle, high = (sorted(pieces[lang])[math.ceil(share * len(pieces[lang])) - 1] + 1 for share in (0.5, 0.95))
        assert held[0] == pytest.approx((middle + 5 * (high - middle)) / 64, abs=0.1)


# toxicity


def abuse(rng, bad):
    words = ["".join(rng.choices(["ta", "ri", "no", "el", "os", "un"], k=rng.randint(1, 4))) for _ in range(rng.randint(20, 200))]
    for _ in range(rng.randint(2, 5) if bad else 0):
        words[rng.randrange(len(words))] = rng.choice(["gruffling", "snarkwit", "blatherskite"])
    return " ".join(words)


def test_misspellings_share_parts(spark):
    rng = random.Random(2)
    rows = [(i, abuse(rng, i % 3 == 0)) for i in range(240)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(200)], "doc_id long, toxic int")
    model = toxicity.train(docs, labels)
    assert model.scores([t for i, t in rows[200:] if i % 3 == 0]) == pytest.approx([1] * 13, abs=0.3)
    assert max(model.scores([t for i, t in rows[200:] if i % 3])) < 0.7
    clean = abuse(random.Random(8), False)
    assert min(model.scores([clean + " Snarkwits,", "blatherskyte " + clean, "(gruffling!) " + clean])) >= 0.7
    again = toxicity.train(docs.repartition(2), labels)
    assert np.array_equal(np.nan_to_num(again.weights), np.nan_to_num(model.weights)) and again.bias == model.bias


def test_rare_words_and_few_labels_count(spark):
    """Words that only a few toxic texts hold, and a sample too small for any part to be a sure sign."""
    rng = random.Random(5)
    rows = [(i, abuse(rng, i % 3 == 0)) for i in range(300)]
    rows += [(i, abuse(rng, False) + " quibblemonger") for i in range(300, 305)]
    rare = toxicity.train(
        spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame([(i, int(i % 3 == 0 or i >= 300)) for i in range(305)], "doc_id long, toxic int")
    )
    clean = [abuse(rng, False) for _ in range(20)]
    assert min(rare.scores([f"{t} {w}" for t in clean for w in ("quibblemonger", "quibblemongers")])) >= 0.7 > max(rare.scores(clean))
    parts, _ = toxicity.parts_of(sorted({w for _, t in rows for w in toxicity.words_of(t)}))
    assert not np.isnan(rare.weights[parts]).any() and (rare.shares[parts] > 0).all()

    rows = [(i, f"{abuse(rng, False)} {rng.choice(['gruffling', 'snarkwit', 'blatherskite']) if i % 9 == 0 else ''}") for i in range(52)]
    few = toxicity.train(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame([(i, int(i % 9 == 0)) for i in range(52)], "doc_id long, toxic int"))
    scores = few.scores([t + " snarkwit gruffling" for t in clean])
    assert sum(s >= 0.7 for s in scores) >= 18 and sum(s >= 0.7 for s in few.scores(clean)) <= 4


def test_gradient_by_loops():
    """Mean of vectors, softmax of two labels, log loss and its slopes, one number at a time."""
    rng = np.random.default_rng(4)
    n_parts, dim, labels, balance, decay = 5, 3, np.array([1, 0, 1]), np.array([0.7, 1.4, 0.7]), 0.01
    bags = [{0: 0.5, 2: 0.5}, {1: 1.0}, {0: 0.2, 3: 0.3, 4: 0.5}]  # part: share of the mean
    vectors, softmax, bias = rng.normal(size=(n_parts, dim)).astype(np.float32), rng.normal(size=(dim, 2)), rng.normal(size=2)
    rows = np.array([r for r, bag in enumerate(bags) for _ in bag])
    column, mean = (np.array([v for bag in bags for v in pair(bag)]) for pair in (dict.keys, dict.values))

    def loss(vectors, softmax, bias):
        total = 0.0
        for bag, label, weight in zip(bags, labels, balance, strict=True):
            text = [sum(share * vectors[p][d] for p, share in bag.items()) for d in range(dim)]
            scores = [sum(text[d] * softmax[d][c] for d in range(dim)) + bias[c] for c in range(2)]
            total -= weight * (scores[label] - math.log(sum(math.exp(s) for s in scores))) / len(bags)
        return total + decay / 2 * (sum(v * v for row in vectors for v in row) + sum(v * v for row in softmax for v in row))

    logits, slopes = toxicity.gradient([vectors, softmax, bias], rows, column, mean, labels, balance, decay)
    for r, bag in enumerate(bags):
        text = sum(share * vectors[p].astype(float) for p, share in bag.items())
        assert logits[r] == pytest.approx((text @ softmax)[1] - (text @ softmax)[0] + bias[1] - bias[0], abs=1e-5)
    given = [vectors.astype(float), softmax, bias]
    for which, slope in enumerate(slopes):
        for at in np.ndindex(slope.shape):
            moved = []
            for step in (1e-5, -1e-5):
                values = [v.copy() for v in given]
                values[which][at] += step
                moved.append(loss(*values))
            assert slope[at] == pytest.approx((moved[0] - moved[1]) / 2e-5, abs=1e-5)


def test_trained_model_is_the_mean_and_softmax_of_its_parts(spark):
    """Scores by plain loops over the parts of each distinct word."""
    rng = random.Random(3)
    rows = [(i, abuse(rng, i % 3 == 0)) for i in range(60)]
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(60)], "doc_id long, toxic int")
    model = toxicity.train(spark.createDataFrame(rows, "doc_id long, text string"), labels)
    for _, text in rows[:10]:
        over, under = 0.0, 0.0
        for word in sorted(set(text.lower().split())):
            for part in toxicity.parts_of([word])[0].tolist():
                if not math.isnan(model.weights[part]):
                    over += model.weights[part] * model.shares[part]
                    under += model.shares[part]
        assert model.scores([text])[0] == pytest.approx(1 / (1 + math.exp(-(model.bias + over / under))), rel=1e-9)
    bag = (np.array([3, 70, 1 << 19]), np.array([1, 90_000, 2]))
    assert all(np.array_equal(x, y) for x, y in zip(toxicity.unpack_bag(toxicity.pack_bag(*bag)), bag, strict=True))


def test_toxicity_of_odd_rows(spark, odd_docs, odd_rows, no_docs):
    labels = spark.createDataFrame([(10, 0), (16, 1), (None, 1), (14, None), (3, 0), (3, 0)], "doc_id long, toxic int")
    got = toxicity.score_texts(odd_docs, toxicity.train(odd_docs, labels)).collect()
    assert len(got) == len(odd_rows) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in got)
    none = toxicity.train(no_docs, labels)
    assert toxicity.score_texts(no_docs, none).collect() == []
    assert none.scores([None, "", "x"]) == [none.scores([""])[0]] * 3


# quality rules


def plain_measures(text):
    text = text or ""
    w = text.encode().split()
    grams = Counter(tuple(w[k : k + 3]) for k in range(len(w) - 2))
    under = {k + j for k in range(len(w) - 2) if grams[tuple(w[k : k + 3])] > 1 for j in range(3)}
    lines = [x for x in text.split("\n") if x.encode().split()]
    return [len(w), sum(len(x.decode()) for x in w), sum(c in "#*$%&|<>" for c in text), sum(x in lines[:k] for k, x in enumerate(lines)), len(under)]


def test_measures(odd_rows):
    texts = [r[1] for r in odd_rows] + ["a # b\r\na # b\n\n \n", "é|漢< > x y x y x y"]
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    for text in texts:
        got = quality_rules.measures(text)
        assert [got[n] for n in names] == plain_measures(text)


@pytest.mark.parametrize(("bad", "n", "level"), [(0, 10, 0.05), (3, 40, 0.01), (0, 5000, 0.001), (120, 5000, 0.0005), (7, 7, 0.05)])
def test_binomial_bound(bad, n, level):
    bound = quality_rules.upper_bound(bad, n, level)
    if bad == n:
        assert bound == 1
    else:
        tail = math.fsum(math.exp(math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1) + k * math.log(bound) + (n - k) * math.log1p(-bound)) for k in range(bad + 1))
        assert tail == pytest.approx(level, rel=1e-6)


def test_cutoffs_hold_their_risk():
    """Over many draws of labels the true share above the chosen cutoff is past the risk in few of them."""
    rng, grid, wrong = np.random.default_rng(4), quality_rules.GRID, 0
    for _ in range(300):
        values = rng.exponential(0.05, 400)
        cut = quality_rules.cutoff([int((values > c).sum()) for c in grid], 400, 0.05, 0.05, grid)
        wrong += cut is not None and math.exp(-cut / 0.05) > 0.05
    assert wrong <= 300 * 0.05 + 3 * math.sqrt(300 * 0.05 * 0.95)
    assert quality_rules.cutoff([0] * len(grid), 0, 0.05, 0.05) is None


def test_quality_of_odd_rows(spark, odd_docs, odd_rows, no_docs):
    labels = spark.createDataFrame([(i, 1) for i in range(30)] + [(None, 1), (3, 0)], "doc_id long, quality int")
    got = quality_rules.judge(odd_docs, labels).collect()
    expected = Counter((r[0], *plain_measures(r[1])) for r in odd_rows)
    assert Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in got) == expected
    for r in got:
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert r.kept == (not r.base_failed and not r.broken)
    assert quality_rules.judge(no_docs, labels).collect() == []


def test_rules_reject_what_stands_out(spark):
    rng = random.Random(1)
    prose = lambda: " ".join("".join(rng.choices("abcdefgh", k=5)) for _ in range(80))
    rows = [(i, prose(), "x" if i % 2 else None) for i in range(1200)]
    rows += [(2000 + i, prose().replace("a", "#"), None) for i in range(20)] + [(3000 + i, prose().upper(), "x") for i in range(20)]
    rows += [(4000, prose().upper(), "too few labels")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, 1) for i in range(1000)], "doc_id long, quality int")
    got = {r.doc_id: r.kept for r in quality_rules.judge(docs, labels).collect()}
    assert sum(got[i] for i in range(1200)) >= 0.95 * 1200
    assert not any(got[i] for i in got if 2000 <= i < 4000)
    assert got[4000]


# mixing


def plain_targets(sizes):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: k % 3 + 1 for k, s in enumerate(names)}
    total, capped = sum(sizes.values()), set()
    while True:
        rest = total - sum(3 * sizes[s] for s in capped)
        free = sum(weight[s] for s in names if s not in capped)
        target = {s: 3.0 * sizes[s] if s in capped else rest * weight[s] / free for s in names}
        over = {s for s in names if s not in capped and target[s] > 3 * sizes[s]}
        if not over:
            return target
        capped |= over


@pytest.mark.parametrize("seed", [0, 5])
def test_mix(spark, seed):
    rng = random.Random(seed)
    rows = []
    for source in ["b", "a", "é", None, "B", "tiny", "none", "𝒳"]:
        for _ in range({"tiny": 2, "none": 2}.get(source, 60)):
            n = 0 if source == "none" else rng.choice([1, 3, 10, 10, 40, 200]) * (1 if source == "tiny" else rng.randint(1, 9))
            rows.append((len(rows), " ".join(["w"] * n), source))
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)
    got = mixing.mix(docs).collect()
    sizes = Counter({s: 0 for _, _, s in rows})
    for _, t, s in rows:
        sizes[s] += len(t.split())
    targets, taken = plain_targets(sizes), Counter()
    assert len(got) == len(rows)
    for r in got:
        assert r.size == len(rows[r.doc_id][1].split()) and r.source == rows[r.doc_id][2]
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(targets[r.source])
        assert r.taken == r.copies * r.size and 0 <= r.copies <= 3
        taken[r.source] += r.taken
    for source, target in targets.items():
        assert taken[source] == pytest.approx(target, abs=max(5, 0.02 * target))
        rates = [(r.size, r.rate) for r in got if r.source == source]
        assert math.fsum(n * x for n, x in rates) == pytest.approx(target, abs=1)
        # exponentially tilted: the log odds of the rate are a multiple of the size
        tilt = [math.log(2 * x / (3 - x)) / n for n, x in rates if n and 1e-6 < x < 3 - 1e-6]
        assert not tilt or max(tilt) - min(tilt) < 1e-6 * max(1, max(map(abs, tilt)) * 1000)
    assert sorted(map(tuple, mixing.mix(docs.repartition(5)).collect())) == sorted(map(tuple, got)) or any(r.source is None for r in got)


def test_mix_of_odd_rows(spark, odd_docs, odd_rows, no_docs):
    got = mixing.mix(odd_docs).collect()
    sizes = Counter()
    for r in odd_rows:
        sizes[r[3]] += len((r[1] or "").encode().split())
    targets = plain_targets(sizes)
    assert Counter((r.doc_id, r.source, r.size) for r in got) == Counter((r[0], r[3], len((r[1] or "").encode().split())) for r in odd_rows)
    assert all(r.target == pytest.approx(targets[r.source]) and r.taken <= 3 * r.size for r in got)
    assert mixing.mix(no_docs).collect() == []
    repeated = mixing.copies(odd_docs)
    assert repeated.columns == odd_docs.columns
    assert repeated.count() == sum(r.copies for r in got)
    assert mixing.copies(no_docs).collect() == []


def test_mix_of_nothing_but_empty_texts(spark):
    docs = spark.createDataFrame([(1, "", "a"), (2, None, "b")], "doc_id long, text string, source string")
    assert sorted((r.doc_id, r.size, r.target, r.taken) for r in mixing.mix(docs).collect()) == [(1, 0, 0.0, 0), (2, 0, 0.0, 0)]


# decontamination


def grams(text, length):
    w = (text or "").encode().lower().split()
    return {tuple(w[k : k + length]) for k in range(len(w) - length + 1)}


def contained(rows, items, percent, length):
    out = set()
    for (i, t), (j, u) in itertools.product(rows, items):
        need, have = grams(u, length), grams(t, length)
        if need and 100 * len(need & have) >= percent * len(need):
            out.add((i, j, len(need), len(need & have)))
    return out


@pytest.mark.parametrize("most", [8 << 20, -1])
def test_contained_items(spark, monkeypatch, most):
    monkeypatch.setattr(decontaminate, "BROADCAST_BYTES", most)
    rng = random.Random(6)
    vocabulary = [f"w{k}" for k in range(60)] + ["É", "X"]
    items = [(k, " ".join(rng.choices(vocabulary, k=rng.randint(1, 40)))) for k in range(40)]
    items += [(None, items[7][1]), (3, items[3][1]), (99, None), (98, "")]
    rows = []
    for i in range(60):
        words = rng.choice(items[:40])[1].split()
        for _ in range(rng.randint(0, 3)):
            words[rng.randrange(len(words))] = "other"
        rows.append((i if i % 9 else None, " ".join(rng.choices(vocabulary, k=rng.randint(0, 300)) + [x.upper() for x in words] + ["end"])))
    rows += [(5, rows[5][1]), (70, None), (71, "")]
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, item_id string, n_found int").repartition(4)
    table = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.contaminated(docs, table)
    assert {(r.doc_id, r.item_id, r.n_shingles, r.n_found) for r in got.collect()} == contained(rows, items, 80, 5)
    clean = decontaminate.clean_rows(docs, table)
    assert clean.columns == docs.columns
    expected = [r for r in rows if not contained([r], items, 80, 5)]
    assert Counter((r.doc_id, r.text) for r in clean.collect()) == Counter(expected)


def test_contained_items_of_odd_rows(spark, odd_docs, odd_rows, no_docs):
    items = spark.createDataFrame([(k, r[1]) for k, r in enumerate(odd_rows)], "item_id long, text string")
    got = decontaminate.contaminated(odd_docs, items).collect()
    rows = [r[:2] for r in odd_rows]
    expected = contained(rows, [(k, t) for k, (_, t) in enumerate(rows)], 80, 5)
    assert {(r.doc_id, r.item_id, r.n_shingles, r.n_found) for r in got} == expected
    assert decontaminate.contaminated(no_docs, items).collect() == []
    nothing = items.filter(F.lit(False))
    assert decontaminate.contaminated(odd_docs, nothing).collect() == []
    assert decontaminate.clean_rows(odd_docs, nothing).count() == len(rows)
