"""The registered queries and the stages of the pipeline."""

import zlib
from collections import Counter

import duckdb
import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from opinara.llm import decontaminate, jaccard_join, language_id, mixing, registry
from tests.llm.test_dedup import linked_components
from tests.llm.test_rows import contained, plain_targets

CONTRACTS = {
    "op1_substring_dedup": ["doc_id:bigint", "n_words:bigint", "n_removed:bigint", "kept_sha256:string"],
    "op3_language_id": ["doc_id:bigint", "held_out:boolean", "lang_pred:string", "score:double"],
    "op4_toxicity": ["doc_id:bigint", "held_out:boolean", "score:double", "predicted:int"],
    "op5_mixing": ["doc_id:bigint", "size:bigint", "source_size:bigint", "target:double", "taken:bigint"],
    "op11_token_alignment": [
        "doc_id:bigint", "n_a:bigint", "n_b:bigint", "n_groups:bigint", "n_links:bigint", "n_best:bigint", "count_sum:bigint",
        "groups_sha256:string",
    ],
    "op12_bbit_minhash": ["doc_id:bigint", "n_shingles:bigint", "component_id:bigint", "kept:boolean"],
    "op13_prefix_trie": [
        "conv_id:bigint", "depth:bigint", "parent_conv_id:bigint", "n_convs:bigint", "n_children:bigint", "n_leaves:bigint",
        "saved_tokens:bigint", "ends_sha256:string",
    ],
    "op6_jaccard_join": ["doc_id:bigint", "n_shingles:bigint", "component_id:bigint"],
    "op7_token_file": ["doc_id:bigint", "start:bigint", "n_tokens:bigint", "ids_crc32:bigint"],
    "op8_quality_rules": ["doc_id:bigint", "n_words:bigint", "word_chars:bigint", "n_symbols:bigint", "n_dup_lines:bigint",
                          "n_repeat_words:bigint", "base_failed:boolean", "kept:boolean"],
    "op9_token_counts": ["doc_id:bigint", "n_bytes:bigint", "n_tokens:bigint", "over_limit:boolean"],
}


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_query_matches_sql(spark, folder, name):
    duck = duckdb.connect()
    for table in ("documents", "benchmark", "labels", "conversations"):
        duck.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    expected = duck.execute(registry.ORACLES[name]).fetchdf()
    df = registry.QUERIES[name](spark, folder)
    names = sorted(df.columns)
    assert sorted(expected.columns) == names
    assert Counter(map(tuple, df.select(*names).collect())) == Counter(expected[names].itertuples(index=False, name=None))


@pytest.mark.parametrize("name", sorted(set(CONTRACTS) - set(registry.ORACLES)))
def test_query_returns_every_document(spark, folder, small_docs, name):
    df = registry.QUERIES[name](spark, folder)
    assert [f"{c}:{kind}" for c, kind in df.dtypes[: len(CONTRACTS[name])]] == CONTRACTS[name]
    rows = df.collect()
    if "doc_id" not in df.columns:
        return  # nodes of conversations; test_trie.py holds them against brute force
    assert Counter(r.doc_id for r in rows) == Counter(d[0] for d in small_docs)
    if name.startswith(("op3", "op4")):
        divisor, remainder = (4, 2) if name.startswith("op3") else (3, 1)
        assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % divisor == remainder) for r in rows)


def check_stages(spark, docs, folder, items):
    """Each stage against brute force on what the one before has kept."""
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        columns = docs.columns
        before = [(r.doc_id, r.text, r.source) for r in docs.collect()]
        out = stage(spark, docs, folder).cache()
        rows = out.collect()
        kept[name] = rows
        if name == corpus_pipeline.STAGES[-1][0]:
            return before, rows
        assert out.columns == columns
        after = Counter((r.doc_id, r.text, r.source) for r in rows)
        if name == "language ID":
            lettered = Counter(b for b in before if any(c.isalpha() for c in b[1] or ""))
            assert not after - lettered and after.total() >= 0.95 * lettered.total()
        elif name == "n-gram Jaccard join":
            _, root = linked_components([b[:2] for b in before], 85, 4)
            groups = {}
            for k, (i, _, _) in enumerate(before):
                groups.setdefault(root(k), []).append(2**63 if i is None else i)
            assert Counter(2**63 if i is None else i for i, _, _ in after.elements()) == Counter(min(g) for g in groups.values())
        elif name == "benchmark decontamination":
            dirty = {i for i, *_ in contained([b[:2] for b in before], items, 80, 5)}
            assert after == Counter(b for b in before if b[0] not in dirty)
        else:
            sizes, taken = Counter(), Counter()
            for _, t, s in before:
                sizes[s] += len((t or "").encode().split())
            for (_, t, s), n in after.items():
                taken[s] += n * len((t or "").encode().split())
            most = Counter(before)
            assert all(after[b] <= 3 * most[b] for b in after)
            for s, target in plain_targets(sizes).items():
                assert taken[s] == pytest.approx(target, abs=max(20, 0.1 * target))
        docs = out
    raise AssertionError("no last stage")


FOREIGN = [
    "Tämä on suomenkielinen lause, jota mikään opituista kielistä ei pysty kuvaamaan, ja siksi se pitää hylätä kokonaan ensimmäisessä vaiheessa.",
    "Wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw, są obdarzeni rozumem i sumieniem.",
    "Все люди рождаются свободными и равными в своем достоинстве и правах, они наделены разумом и совестью.",
]


def test_foreign_documents_go(spark):
    folder = "/root/testdata/sf0.01"  # the smallest table with enough labelled texts to know their spread
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    rng = np.random.default_rng(3)
    texts = FOREIGN + ["".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz "), 300)) for _ in range(3)]
    odd = spark.createDataFrame([(10**9 + k, t) for k, t in enumerate(texts)], "doc_id long, text string")
    kept = corpus_pipeline.identify_languages(spark, docs.unionByName(odd, allowMissingColumns=True), folder)
    assert [r.text for r in kept.filter("doc_id >= 1000000000").collect()] == []
    assert kept.count() >= 0.95 * docs.filter(r"text rlike '\\p{L}'").count()


def check_tokens(before, rows):
    plain = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    ids = [np.array([*plain.encode(t or "", add_special_tokens=False).ids, 0], "<u4") for _, t, _ in before]
    expected = Counter((b[0], len(x), zlib.crc32(x.tobytes())) for b, x in zip(before, ids, strict=True))
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in rows) == expected
    rows = sorted(rows, key=lambda r: r.start)
    assert [r.start for r in rows] == [0, *np.cumsum([r.n_tokens for r in rows])[:-1]] if rows else True
    assert [r.doc_id for r in rows] == sorted((r.doc_id for r in rows), key=lambda i: (i is None, i or 0))


def test_stages_of_the_small_table(spark, folder):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{folder}/benchmark.parquet").select("item_id", "text").collect()]
    check_tokens(*check_stages(spark, spark.read.parquet(f"{folder}/documents.parquet"), folder, items))


def test_no_documents(spark, folder, no_docs):
    docs = no_docs.select("doc_id", "text", "lang", "source", "n_chars")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, folder)
        assert docs.collect() == []


def test_odd_documents_pass_every_stage(spark, folder, odd_docs):
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, odd_docs, folder).count() >= 0


def test_columns_of_any_name(spark, odd_rows):
    """Stages that keep all columns keep those whose names they use themselves, with their values."""
    names = ["_id", "_fp", "_place", "_copies", "_nth", "rate", "place", "row", "id", "fp", "origin", "copies", "n", "language", "wordless"]
    kinds = "doc_id long, text string, lang string, source string, " + ", ".join(f"{n} string" for n in names)
    rows = [(*r[:4], *(f"{n} {k}" for n in names)) for k, r in enumerate(odd_rows)]
    docs = spark.createDataFrame(rows, kinds).repartition(3)
    given = set(rows)
    items = spark.createDataFrame([(1, odd_rows[14][1])], "item_id long, text string")
    stages = {
        "one of each": lambda: jaccard_join.one_of_each(docs),
        "clean rows": lambda: decontaminate.clean_rows(docs, items),
        "copies": lambda: mixing.copies(docs),
        "fitting": lambda: language_id.fitting(docs, language_id.train(docs), language_id.limits(docs)),
    }
    for name, stage in stages.items():
        out = stage()
        assert out.columns == docs.columns, name
        found = [tuple(r) for r in out.collect()]
        assert found and set(found) <= given, name
