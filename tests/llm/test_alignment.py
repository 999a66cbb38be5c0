"""Alignment of two tokenizers against the libraries and plain loops."""

import hashlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from opinara.llm import alignment, token_counts

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def libraries():
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=B)
    letters = token_counts.byte_letters()
    names = {n: e for e, n in a.get_vocab().items()}

    def tokens(text):
        if not text:
            return [], []
        ids_a, ids_b = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
        of_a = [bytes(letters[c] for c in names[n]) for n in ids_a]
        of_b = [bytes([int(b.id_to_piece(n)[3:5], 16)]) if b.is_byte(n) else b.id_to_piece(n).replace("▁", " ").encode() for n in ids_b]
        if b"".join(of_a) != (" " + text).encode() or b"".join(of_b) != (" " + text).encode():
            return [], []
        return list(zip(ids_a, of_a, strict=True)), list(zip(ids_b, of_b, strict=True))

    return tokens


def spans(tokens):
    at, out = 0, []
    for number, data in tokens:
        out.append((number, at, at + len(data)))
        at += len(data)
    return out


def groups_and_links(texts, tokens):
    found = []
    for text in texts:
        a, b = (spans(t) for t in tokens(text))
        links, j = [], 0
        for number, start, end in a:
            while j and b[j][1] > start:
                j -= 1
            while j < len(b) and b[j][2] <= start:
                j += 1
            k = j
            while k < len(b) and b[k][1] < end:
                links.append((number, b[k][0]))
                k += 1
        ends = sorted({e for _, _, e in a} & {e for _, _, e in b})
        groups = []
        for s, e in zip([0, *ends], ends, strict=False):
            groups.append(tuple([n for n, x, y in t if x >= s and y <= e] for t in (a, b)))
        found.append((len(a), len(b), groups, links))
    return found


def by_loops(texts, tokens):
    found = groups_and_links(texts, tokens)
    counts = Counter(p for *_, links in found for p in links)
    most = Counter()
    for (_, n), uses in counts.items():
        most[n] = max(most[n], uses)
    out = []
    for n_a, n_b, groups, links in found:
        written = ";".join("|".join(",".join(map(str, ids)) for ids in g) for g in groups)
        digest = hashlib.sha256(written.encode()).hexdigest() if written else ""
        best = sum(counts[p] == most[p[1]] for p in links)
        out.append((n_a, n_b, len(groups), len(links), best, sum(counts[p] for p in links), digest))
    return out


ODD = [
    None,
    "",
    " ",
    "plain words on one line",
    "two\nlines of it",
    "a<|endoftext|>b and <s> or </s> <unk> <0x41>",
    "tabs\tand\r\nreturns",
    "  doubled  spaces  ",
    "\nline first",
    "line last\n",
    "mixed été 漢字 😀 ﬁ ½",
    "a▁b has the mark",
    "▁",
    "nul\x00inside",
    "\x00first of a word \x00again",
    "no\xa0break and ideographic　space",
    "don't we'll it's",
    "x" * 3000,
    "word " * 400 + "end",
    "plain words on one line",
    "é combining",
]


@pytest.mark.parametrize("most_broadcast", [0, alignment.MOST_BROADCAST])
def test_odd_texts(spark, libraries, most_broadcast):
    rows = [(n, t, "clash", n, 1, 2) for n, t in enumerate(ODD)] + [(3, ODD[3], "clash", 1, 1, 2), (None, "no id here", None, None, 1, 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, codes string, pair long, links int, n_a int").repartition(4)
    got = alignment.align(docs, A, B, most_broadcast).collect()
    wanted = by_loops([r[1] for r in rows], libraries)
    assert sorted((tuple(r) for r in got), key=str) == sorted(((r[0], *w) for r, w in zip(rows, wanted, strict=True)), key=str)


def test_small_table(spark, folder, libraries):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    rows = docs.select("doc_id", "text").collect()
    wanted = by_loops([r.text for r in rows], libraries)
    got = {r[0]: tuple(r)[1:] for r in alignment.align(docs, A, B).collect()}
    assert got == {r.doc_id: w for r, w in zip(rows, wanted, strict=True)}


def test_groups_tile_the_text(spark, libraries):
    docs = spark.createDataFrame([(n, t) for n, t in enumerate(ODD)], "doc_id long, text string")
    rows = alignment.groups(docs, A, B).orderBy("doc_id", "start").collect()
    for n, text in enumerate(ODD):
        _, _, groups, _ = groups_and_links([text], libraries)[0]
        mine = [r for r in rows if r.doc_id == n]
        assert [(r.a, r.b) for r in mine] == [(a, b) for a, b in groups]
        if mine:
            assert mine[0].start == 0 and mine[-1].end == len((" " + text).encode())
            assert all(x.end == y.start for x, y in zip(mine, mine[1:], strict=False))


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert alignment.align(docs, A, B).collect() == [] and alignment.groups(docs, A, B).collect() == []


def test_coalescing_of_random_tilings():
    rng = np.random.default_rng(2)
    for _ in range(50):
        cuts = [np.unique(np.r_[rng.choice(60, rng.integers(1, 30)), 60]) for _ in "ab"]
        cuts = [c[c > 0] for c in cuts]
        links = alignment.coalesce(*(np.diff(c, prepend=0) for c in cuts))
        a, b = (list(zip([0, *c[:-1]], c, strict=True)) for c in cuts)
        wanted = [(i, j) for i, x in enumerate(a) for j, y in enumerate(b) if x[0] < y[1] and y[0] < x[1]]
        assert sorted(zip(links.a.tolist(), links.b.tolist(), strict=True)) == wanted
        both = np.intersect1d(*cuts)
        assert links.group_a.tolist() == [int(np.searchsorted(both, x[1])) for x in a]
        assert links.group_b.tolist() == [int(np.searchsorted(both, y[1])) for y in b]
