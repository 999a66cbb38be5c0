"""Token counts and the token file against the library itself."""

import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from opinara.llm import token_counts, token_file

PATH = public_tokenizers.path("byte_bpe_50k.json")
PLAIN = Tokenizer.from_file(PATH)
ODD = [
    "",
    " ",
    "  a  b",
    "a\n b\n\n  c \n",
    "tabs\t\tand\x0b\x0cmore \x1c\x1d\x85\xa0 x",
    "it's they'RE we'll 'sa 's's",
    "x <|endoftext|> y  <|endoftext|>\n\nz<|endoftext|>",
    "Größe ñandú ç' 12³ ½ 漢字 😀😀 ᠎a ٣٤",
    "a" * 5000,
    "!!!! $$$ ### word.\nNext",
]


def plain(text):
    return PLAIN.encode(text, add_special_tokens=False).ids


@pytest.fixture(scope="module")
def counter():
    return token_counts.Counter(PATH, token_counts.proven_strings(PATH))


@pytest.fixture(scope="module")
def encoder():
    return token_file.Encoder(PATH)


def check(counter, encoder, texts):
    given = pa.array(texts, pa.string())
    assert counter.counts(given).tolist() == [len(plain(t)) for t in texts]
    ids, lengths = encoder.ids(given)
    assert [p.tolist() for p in np.split(ids, np.cumsum(lengths))[:-1]] == [plain(t) for t in texts]


def test_odd_texts(counter, encoder):
    check(counter, encoder, ODD)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet=st.one_of(st.sampled_from(" \n\t\r's.,aB1é \xa0\x1f"), st.characters(exclude_categories=["Cs"])), max_size=40), max_size=4))
def test_random_texts(counter, encoder, texts):
    check(counter, encoder, texts)


def test_random_pieces(counter, encoder):
    rng = random.Random(5)
    pieces = [" ", "  ", "\n", "\t", "'s", "word", "Word", "ing", "123", ".", "***", "é", "<|endoftext|>", " ", "'", "x"]
    check(counter, encoder, ["".join(rng.choices(pieces, k=rng.randint(0, 30))) for _ in range(2000)])


def test_a_vocabulary_string_may_not_encode_alone():
    proven = token_counts.proven_strings(PATH)
    assert "<|endoftext|>" not in proven or plain("<|endoftext|>") == [50256]
    assert all(len(plain(s)) == 1 for s in random.Random(1).sample(sorted(proven), 500))


def test_sentencepiece_counts():
    import sentencepiece

    path = public_tokenizers.path("piece_bpe_32k.model")
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    assert token_counts.Counter(path, frozenset()).counts(pa.array(["Hello world", ""])).tolist() == [len(model.encode("Hello world")), 0]


@pytest.mark.parametrize("most", [1, 255, 256, 65536, 2**32 - 1])
@pytest.mark.parametrize("n", [0, 1, 63, 64, 511, 512, 513, 5000])
def test_codes(n, most):
    ids = np.random.default_rng(n).integers(0, most, n, dtype=np.uint32, endpoint=True)
    codes = token_file.Codes(token_file.encode(ids))
    assert len(codes) == n
    assert codes.all().tolist() == ids.tolist()
    places = np.random.default_rng(1).permutation(n)
    assert codes.at(places).tolist() == ids[places].tolist()


ROWS = [(7, "the end"), (2, None), (None, "no id"), (2, "again\nand again"), (5, ""), (1, "long " * 20000), (7, "the end"), (3, ODD[6])]


def test_token_file(spark, tmp_path):
    docs = spark.createDataFrame([(i, t, 0, "x") for i, t in ROWS], "doc_id long, text string, start int, n_tokens string")
    path = str(tmp_path / "ids")
    token_file.write_tokens(docs, path, PATH, shards=3, block_ids=50)
    got = [tuple(r) for r in token_file.read_documents(spark, path).collect()]
    got.sort(key=lambda r: r[1])
    ids = [i for i, _ in sorted(ROWS, key=lambda r: (r[0] is None, r[0] or 0))]
    assert [r[0] for r in got] == ids
    texts, start, flat = {}, 0, []
    for i, t in ROWS:
        texts.setdefault(i, []).append([*plain(t or ""), 0])
    for i, at, n, crc in got:
        mine = next(x for x in texts[i] if len(x) == n and zlib.crc32(np.array(x, "<u4").tobytes()) == crc)
        texts[i].remove(mine)
        assert at == start
        start, flat = start + n, flat + mine
    asked = spark.createDataFrame([(p,) for p in (0, 17, len(flat) - 1, len(flat), -3, None)], "place long")
    found = {r.place: r.id for r in token_file.tokens_at(asked, path, bin_ids=64).collect()}
    assert found == {p: flat[p] for p in (0, 17, len(flat) - 1)}


def test_empty_table(spark, tmp_path):
    docs = spark.createDataFrame([], "doc_id long, text string")
    path = str(tmp_path / "none")
    token_file.write_tokens(docs, path, PATH)
    assert token_file.read_documents(spark, path).collect() == []
    assert token_counts.count_tokens(docs, PATH).collect() == []


def test_count_tokens(spark):
    docs = spark.createDataFrame([(i, t, 1, True) for i, t in ROWS], "doc_id long, text string, n_tokens int, over_limit boolean")
    got = sorted(map(str, map(tuple, token_counts.count_tokens(docs, PATH).collect())))
    assert got == sorted(
        str((i, len((t or "").encode()), len(plain(t or "")), len(plain(t or "")) > 1024)) for i, t in ROWS
    )
