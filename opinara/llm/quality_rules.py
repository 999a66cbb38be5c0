"""Quality rules with cutoffs that hold back a stated share of good texts at most.

Each rule is a share of a text, such as symbols per letter, and rejects texts above a cutoff. Cutoffs are chosen per stratum
(language) on labelled texts: along a grid from the loosest to the strictest, each step is a test that the rule rejects more
than its share of good texts, and the walk stops at the first test that is not turned down by the exact binomial upper bound.
Such a sequence needs no correction along the grid; the level is divided by the number of rules times strata (Bonferroni), and
the risk of a stratum by the number of its rules. So, with probability 1 - ``error``, no stratum loses more than ``risk`` of
its good texts to the rules. A stratum with too few labels to prove anything gets no cutoffs.
"""

import math
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opinara.llm.common import SPACES, batches, gram_hashes, scratch_table, word_hashes, words_of

RISK, ERROR = 0.05, 0.05
MIN_WORDS = 50
MOST_REPEATED = 50  # per cent of the words
SYMBOLS = "#*$%&|<>"
GRID = (0.5, 0.4, 0.3, 0.25, 0.2, 0.15, 0.12, 0.1, 0.08, 0.06, 0.05, 0.04, 0.03, 0.02, 0.01)  # loosest first
_BASE = ["word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
_SCHEMA = "doc_id long, lang string, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_lines long, n_capitals long"
_ARROW = pa.schema([("doc_id", pa.int64()), ("lang", pa.string()), *((c.split()[0], pa.int64()) for c in _SCHEMA.split(", ")[2:])])
_SPACE = re.compile(f"[{SPACES}]")

#: Rule: numerator and denominator.
RULES = {
    "symbols": ("n_symbols", "word_chars"),
    "capitals": ("n_capitals", "word_chars"),
    "repeated lines": ("n_dup_lines", "n_lines"),
    "repeated words": ("n_repeat_words", "n_words"),
}


def measures(text: str | None) -> dict[str, int]:
    """Counts of one text. A null text has no words, lines or characters."""
    text = text or ""
    words = words_of(text)
    lines = [line for line in text.split("\n") if line.strip(SPACES)]
    plain = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    repeated = 0
    if len(words) > 3:
        _, where, uses = np.unique(gram_hashes(word_hashes(words), 3), return_inverse=True, return_counts=True)
        again = np.flatnonzero(uses[where] > 1)
        under = np.zeros(len(words), bool)
        for j in range(3):
            under[again + j] = True
        repeated = int(under.sum())
    return {
        "n_words": len(words),
        "word_chars": len(text) - sum(text.count(c) for c in SPACES),
        "n_symbols": sum(text.count(c) for c in SYMBOLS),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": repeated,
        "n_lines": len(lines),
        "n_capitals": int(np.count_nonzero((plain >= 65) & (plain <= 90))),
    }


def measure(docs: DataFrame) -> DataFrame:
    """doc_id, lang and the counts of every row."""

    def rows(part):
        for key, lang, text in zip(*(part.column(c).to_pylist() for c in ("doc_id", "lang", "text")), strict=True):
            yield {"doc_id": [key], "lang": [lang]} | {k: [v] for k, v in measures(text).items()}

    def run(parts):
        for part in parts:
            yield from batches(rows(part), _ARROW, 2_000)

    casts = [F.col(c).cast(t).alias(c) for c, t in (("doc_id", "long"), ("lang", "string"), ("text", "string"))]
    return docs.select(*casts).mapInArrow(run, _SCHEMA)


def upper_bound(bad: int, n: int, level: float) -> float:
    """The exact binomial (Clopper-Pearson) upper bound: the chance under which ``bad`` or fewer of ``n`` have probability
    ``level``."""
    if bad >= n:
        return 1.0
    low, high = bad / n, 1.0
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (middle, high) if _at_most(bad, n, middle) > level else (low, middle)
    return high


def _at_most(bad: int, n: int, p: float) -> float:
    if p <= 0:
        return 1.0
    if p >= 1:
        return 0.0
    k = np.arange(bad + 1)
    steps = np.log((n - k[1:] + 1) / k[1:]) if bad else np.zeros(0)
    logs = np.r_[0.0, np.cumsum(steps)] + k * math.log(p) + (n - k) * math.log1p(-p)
    top = logs.max()
    return float(np.exp(logs - top).sum() * math.exp(top)) if top > -700 else 0.0


def cutoff(above: list[int], n: int, risk: float, level: float, grid=GRID) -> float | None:
    """The strictest cutoff that fixed-sequence testing reaches. ``above``: good texts above each value of the grid."""
    found = None
    for value, bad in zip(grid, above, strict=True):
        if n == 0 or upper_bound(bad, n, level) > risk:
            break
        found = value
    return found


def share(rule: str) -> Column:
    over, under = RULES[rule]
    return F.when(F.col(under) > 0, F.col(over) / F.col(under)).otherwise(0.0)


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))


def choose_cutoffs(measured: DataFrame, labels: DataFrame, risk: float = RISK, error: float = ERROR) -> list[tuple]:
    """(lang, one cutoff or None per rule) for each stratum with labels. Only counts per stratum come to the driver, and only
    of strata with enough good texts to prove anything at all, so they are bounded by the labels."""
    good = labels.filter("quality = 1 and doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id")).distinct()
    passing = measured.filter(~base_failed())
    counts = [F.count_if(share(r) > c).alias(f"{n}_{k}") for n, r in enumerate(RULES) for k, c in enumerate(GRID)]
    fewest = math.ceil(math.log(error / len(RULES)) / math.log1p(-risk / len(RULES)))
    found = passing.join(good, "doc_id", "left_semi").groupBy("lang").agg(F.count(F.lit(1)).alias("n"), *counts)
    strata = sorted(found.filter(F.col("n") >= fewest).collect(), key=lambda r: (r.lang is not None, r.lang))
    level = error / max(1, len(RULES) * len(strata))
    return [
        (s.lang, *(cutoff([s[f"{n}_{k}"] for k in range(len(GRID))], s.n, risk / len(RULES), level) for n in range(len(RULES))))
        for s in strata
    ]


def judge(docs: DataFrame, labels: DataFrame, risk: float = RISK, error: float = ERROR) -> DataFrame:
    """Every row's doc_id, lang, counts, ``base_failed``, ``broken`` (names of the rules that reject it) and ``kept``.

    Takes a table with doc_id, text and lang, and labels with doc_id and quality (1 good). A null or empty text fails the base
    rules. Rows may repeat and lang may be null, which is a stratum of its own; other columns are ignored.
    """
    measured = scratch_table(measure(docs), "measures")
    cutoffs = choose_cutoffs(measured, labels, risk, error)
    names = [f"_cutoff_{n}" for n in range(len(RULES))]
    schema = "_lang string, " + ", ".join(f"{n} double" for n in names)
    table = docs.sparkSession.createDataFrame(cutoffs, schema)
    joined = measured.join(F.broadcast(table), F.col("lang").eqNullSafe(F.col("_lang")), "left")
    broken = F.array_compact(F.array(*(F.when(share(r) > F.col(n), F.lit(r)) for n, r in zip(names, RULES, strict=True))))
    judged = joined.withColumn("base_failed", base_failed()).withColumn("broken", broken).drop("_lang", *names)
    return judged.withColumn("kept", ~F.col("base_failed") & (F.size("broken") == 0))
