import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, n_words string, size int, score string, language int"


@pytest.fixture(scope="session")
def odd_rows():
    """Rows with nulls in any column, empty, blank and long texts, ties, repeated rows and near copies."""
    rng = random.Random(11)
    words = ["alpha", "Beta", "gamma,", "delta", "été", "12", "zeta.", "eta", "theta", "iota", "漢字", "x"]

    def prose(n):
        return " ".join(rng.choice(words) + str(rng.randint(0, 40)) for _ in range(n))

    base, other, passage, long_ = prose(120), prose(90), prose(60), prose(3000)
    near = base.split(" ")
    near[60] = "changed"
    rows = [
        (10, base),
        (3, base),
        (3, base),
        (25, " ".join(near)),
        (4, base.upper()),
        (None, base),
        (None, None),
        (7, None),
        (8, ""),
        (9, " \n\t "),
        (11, "one two three"),
        (12, "One  two\tthree"),
        (13, "one two three four"),
        (14, prose(30) + "\n" + passage + "\n" + prose(20)),
        (15, passage + " " + prose(45)),
        (16, other),
        (16, other + " and more"),
        (17, long_),
        (18, long_ + "\nthe end of it"),
        (19, "1234 5678 ... !!"),
        (20, "line that is said often enough\nline that is said often enough\nlime that is said often enough\nshort\nshirt"),
        (5, "line that is said often  enough\nline that is said often enough.\n\n  line that is said often enough  "),
        (21, "a b a b a b a b a b a b"),
        (2**62, "far away"),
        (-6, passage),
    ]
    langs, sources = ["en", "de", None], ["b", "a", None, "c", "é"]
    return [
        (i, t, langs[k % 3], sources[k % 5], None if k % 4 else k, "clash", k, None, k) for k, (i, t) in enumerate(rows)
    ]


@pytest.fixture(scope="session")
def odd_docs(spark, odd_rows):
    return spark.createDataFrame(odd_rows, SCHEMA).repartition(5).cache()


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def small_docs(spark, folder):
    """Rows of the small table as (doc_id, text, lang, source)."""
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    return [tuple(r) for r in docs.select("doc_id", "text", "lang", "source").collect()]
