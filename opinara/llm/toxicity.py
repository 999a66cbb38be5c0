"""Toxicity by subword bags.

A word's parts are the whole word and its character runs of three to five, word ends included, each hashed to a bucket with a
vector. A text is the mean vector of the parts of its distinct words, and a linear softmax over that mean gives the label.
Vectors and softmax are trained together with numpy on a bounded sample of labelled texts. A misspelling shares most of its
character runs with the word it stands for, and so its vectors. Every bucket of the sample has a vector. In the mean it counts by
the chance that it tells the labels apart, given the sample: that grows smoothly with the likelihood ratio and is never zero, so
one bad word isn't thinned out by a long text and a rare one still counts. As all of it is linear, a trained model is two numbers
per bucket.
"""

import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opinara.llm.common import batches, mixed, scratch_table

SAMPLE = 2_000  # labelled texts per label that the model is trained on, about
CUTOFF = 0.7
BUCKETS = 1 << 20
PRIOR_ODDS = 1000.0  # against a bucket telling the labels apart, before the sample is seen
_LENGTHS = (3, 4, 5)
_MOST_REMEMBERED = 300_000  # words in memory per task; past that the memory starts anew, which changes no result
_SLICE = 1 << 20  # entries that are worked on at once where the driver goes through all of them
_BAGS = pa.schema([("toxic", pa.int32()), ("key", pa.int64()), ("n", pa.int32()), ("bag", pa.binary())])


def words_of(text: str | None) -> list[str]:
    return text.lower().split() if text else []


def parts_of(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Bucket and place of the word of every part of the words."""
    if not words:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    signs = np.frombuffer(("\n" + "\n".join(words) + "\n").encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    ends = signs == 10
    word = np.cumsum(ends) - 1
    whole = np.fromiter((xxhash.xxh3_64_intdigest(w.encode("utf-8", "surrogatepass")) for w in words), np.uint64, len(words))
    buckets, owners = [whole], [np.arange(len(words))]
    for length in _LENGTHS:
        n = len(signs) - length + 1
        if n <= 0:
            continue
        hashes = np.full(n, length, np.uint64)
        inside = np.ones(n, bool)
        for j in range(length):
            hashes = mixed(hashes * np.uint64(31) + signs[j : n + j])
            if 0 < j < length - 1:
                inside &= ~ends[j : n + j]
        places = np.flatnonzero(inside)
        buckets.append(hashes[places])
        owners.append(word[places + 1])
    return (np.concatenate(buckets) & np.uint64(BUCKETS - 1)).astype(np.int64), np.concatenate(owners)


def pack_bag(parts: np.ndarray, uses: np.ndarray) -> bytes:
    """Ascending parts as steps, and their uses, compressed."""
    return zlib.compress(np.concatenate([np.diff(parts, prepend=0), uses]).astype("<i4").tobytes(), 1)


def unpack_bag(bag: bytes) -> tuple[np.ndarray, np.ndarray]:
    steps, uses = np.frombuffer(zlib.decompress(bag), "<i4").reshape(2, -1)
    return np.cumsum(steps, dtype=np.int32), uses


def _bags(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows(part):
        for toxic, key, text in zip(*(part.column(c).to_pylist() for c in ("toxic", "key", "text")), strict=True):
            buckets, _ = parts_of(sorted(set(words_of(text))))
            distinct, uses = np.unique(buckets, return_counts=True)
            yield {"toxic": [toxic], "key": [key], "n": [len(distinct)], "bag": [pack_bag(distinct, uses)]}

    for part in parts:
        yield from batches(rows(part), _BAGS, 200)


class Model:
    """``weights`` of the buckets that have a vector (others are NaN), ``shares`` by which they count in the mean, and ``bias``,
    the difference of the softmax scores."""

    def __init__(self, weights: np.ndarray, shares: np.ndarray, bias: float):
        self.weights, self.shares, self.bias = weights, shares, bias
        self.known: dict[str, tuple[float, float] | None] = {}

    def __getstate__(self):
        return {"weights": self.weights, "shares": self.shares, "bias": self.bias, "known": {}}

    def scores(self, texts: list[str | None]) -> list[float]:
        out, held, size = [], [], 0
        for n, text in enumerate(texts):
            held.append(set(words_of(text)))
            size += len(held[-1])
            if size >= 100_000 or n == len(texts) - 1:
                out += self._some(held)
                held, size = [], 0
        return (1 / (1 + np.exp(-np.clip(out, -500, 500)))).tolist()

    def _some(self, held: list[set[str]]) -> list[float]:
        if len(self.known) > _MOST_REMEMBERED:
            self.known = {}
        new = list(set().union(*held) - self.known.keys())
        for n in range(0, len(new), 50_000):
            words = new[n : n + 50_000]
            buckets, owners = parts_of(words)
            weights, shares = self.weights[buckets], self.shares[buckets]
            marked = ~np.isnan(weights)
            sums = np.bincount(owners[marked], weights[marked] * shares[marked], minlength=len(words))
            counts = np.bincount(owners[marked], shares[marked], minlength=len(words))
            self.known.update((w, (s, c) if c else None) for w, s, c in zip(words, sums.tolist(), counts.tolist(), strict=True))
        out = []
        for words in held:
            found = sorted(filter(None, map(self.known.__getitem__, words)))  # in order: sums of doubles are repeatable
            out.append(self.bias + (sum(s for s, _ in found) / sum(c for _, c in found) if found else 0.0))
        return out


def shares_of(n_0: np.ndarray, n_1: np.ndarray, texts: tuple[int, int]) -> np.ndarray:
    """The chance that a bucket with the text counts ``n_0`` and ``n_1`` tells the labels apart: the prior odds times the
    likelihood ratio of one share of texts under both labels and of two shares."""

    def log_likelihood(some, of):
        rest = of - some
        return some * np.log(np.maximum(some, 1) / max(of, 1)) + rest * np.log(np.maximum(rest, 1) / max(of, 1))

    ratio = log_likelihood(n_0, texts[0]) + log_likelihood(n_1, texts[1]) - log_likelihood(n_0 + n_1, sum(texts))
    return 1 / (1 + PRIOR_ODDS * np.exp(-np.maximum(ratio, 0)))


def text_counts(labels: np.ndarray, starts: np.ndarray, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """In how many texts of either label each bucket is. Slice by slice, as the entries are many."""
    counts = np.zeros((2, BUCKETS), np.int64)
    owners = np.repeat(labels.astype(bool), np.diff(starts))
    for at in range(0, len(parts), _SLICE):
        some, toxic = parts[at : at + _SLICE], owners[at : at + _SLICE]
        counts[1] += np.bincount(some[toxic], minlength=BUCKETS)
        counts[0] += np.bincount(some[~toxic], minlength=BUCKETS)
    return counts[0], counts[1]


def gradient(values, rows: np.ndarray, column: np.ndarray, mean: np.ndarray, labels: np.ndarray, balance: np.ndarray, decay: float):
    """Scores (label 1 over label 0) of the texts of a step, and the slopes of the log loss by vectors, softmax and bias.

    Entry n says that text ``rows[n]`` has the part ``column[n]`` with the share ``mean[n]`` of its mean.
    """
    vectors, softmax, bias = values
    # the softmax of two labels depends on the difference of their scores only, so one number per part is summed
    apart = softmax[:, 1] - softmax[:, 0]
    logits = np.bincount(rows, mean * (vectors @ apart.astype(np.float32))[column], minlength=len(labels)) + bias[1] - bias[0]
    error = (1 / (1 + np.exp(-np.clip(logits, -500, 500))) - labels) * balance / len(labels)
    pull = np.bincount(column, mean * error[rows], minlength=len(vectors)).astype(np.float32)
    inner = pull @ vectors
    by_vector = np.multiply.outer(pull, apart.astype(np.float32))
    by_vector += np.float32(decay) * vectors
    return logits, [by_vector, np.stack([-inner, inner], 1) + decay * softmax, np.array([-error.sum(), error.sum()])]


def fit(
    labels: np.ndarray, starts: np.ndarray, parts: np.ndarray, uses: np.ndarray,
    dim: int = 8, steps: int = 400, rate: float = 0.05, decay: float = 1e-6, seed: int = 7,
) -> Model:
    """Vectors and softmax together, by stochastic gradient steps with moments (Adam) on the log loss. Text n has the label
    ``labels[n]`` and, from ``starts[n]`` to ``starts[n + 1]``, distinct ``parts`` and how often they occur. ``parts`` are renumbered
    in place."""
    rng = np.random.default_rng(seed)
    weights, all_shares = np.full(BUCKETS, np.nan), np.zeros(BUCKETS)
    toxic = int(labels.sum())
    if not 0 < toxic < len(labels) or not len(parts):  # nothing to tell apart: the share of the label
        share = (toxic + 0.5) / (len(labels) + 1)
        return Model(weights, all_shares, float(np.log(share / (1 - share))))
    sizes = np.diff(starts)
    n_0, n_1 = text_counts(labels, starts, parts)
    used = np.flatnonzero(n_0 + n_1)
    local = np.zeros(BUCKETS, np.int32)
    local[used] = np.arange(len(used))
    shares = shares_of(n_0[used], n_1[used], (len(labels) - toxic, toxic))
    for at in range(0, len(parts), _SLICE):
        parts[at : at + _SLICE] = local[parts[at : at + _SLICE]]
    balance = np.where(labels == 1, 0.5 / (labels == 1).mean(), 0.5 / (labels == 0).mean())  # both labels weigh the same
    values = [rng.normal(0, 0.1, (len(used), dim)).astype(np.float32), rng.normal(0, 0.5, (dim, 2)), np.zeros(2)]
    moments = [(np.zeros_like(v), np.zeros_like(v)) for v in values]
    step, size, order = 0, 128, np.zeros(0, np.int64)
    while step < steps:
        if not len(order):
            order = rng.permutation(len(labels))
        some, order = order[:size], order[size:]
        at = np.concatenate([np.arange(starts[n], starts[n + 1]) for n in some])
        rows, column = np.repeat(np.arange(len(some)), sizes[some]), parts[at]
        mean = uses[at] * shares[column]
        mean /= np.bincount(rows, mean, minlength=len(some))[rows]
        _, slopes = gradient(values, rows, column, mean, labels[some], balance[some], decay)
        step += 1
        scale = rate * np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
        for value, (first, second), slope in zip(values, moments, slopes, strict=True):
            # first += 0.1 * (slope - first), second += 0.001 * (slope ** 2 - second), in place
            first *= 0.9
            first += 0.1 * slope
            second *= 0.999
            np.square(slope, out=slope)
            slope *= 0.001
            second += slope
            np.sqrt(second, out=slope)
            slope += 1e-8
            np.divide(first, slope, out=slope)
            slope *= scale
            value -= slope
    vectors, softmax, bias = values
    weights[used], all_shares[used] = vectors @ (softmax[:, 1] - softmax[:, 0]), shares
    return Model(weights, all_shares, float(bias[1] - bias[0]))


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """A model from text and labels.toxic, on about ``sample`` texts of each label, chosen by hash. What comes to the driver is
    bounded by the distinct parts of those texts."""
    known = labels.filter("toxic in (0, 1) and doc_id is not null").groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    rates = known.groupBy("toxic").agg((F.lit(sample) / F.count(F.lit(1))).alias("rate"))  # two rows
    place = F.pmod(F.xxhash64(F.lit("sample"), "doc_id"), F.lit(1_000_003)) / 1_000_003
    chosen = known.join(F.broadcast(rates), "toxic").filter(place < F.col("rate")).select("doc_id", "toxic")
    texts = docs.filter("text is not null").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    chosen = scratch_table(chosen, "chosen")  # as a table its size is known, and a short one is broadcast
    chosen = texts.join(chosen, "doc_id").select("toxic", F.xxhash64("doc_id", "text").alias("key"), "text")
    bags = scratch_table(chosen.mapInArrow(_bags, "toxic int, key long, n int, bag binary"), "bags")
    table = bags.orderBy("key", "toxic").toArrow()  # compressed: some ten kilobytes for each text of the sample
    sizes = table["n"].to_numpy().astype(np.int64)
    starts = np.concatenate([[0], np.cumsum(sizes)])
    labels = table["toxic"].to_numpy()
    parts, uses, at = np.empty(starts[-1], np.int32), np.empty(starts[-1], np.int32), 0
    for bag in chain.from_iterable(chunk.to_pylist() for chunk in table["bag"].chunks):
        some = unpack_bag(bag)
        parts[at : at + len(some[0])], uses[at : at + len(some[0])] = some
        at += len(some[0])
    del table
    return fit(labels, starts, parts, uses)


def toxicity(spark, model: Model, text: str = "text") -> Column:
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in parts:
            yield pd.Series(shared.value.scores(part.tolist()), dtype="float64")

    return score(F.col(text).cast("string"))


def score_texts(docs: DataFrame, model: Model, cutoff: float = CUTOFF) -> DataFrame:
    """doc_id, score and predicted of every row of a table with doc_id and text.

    A null or empty text has no words and gets the score of the bias alone. Rows may repeat; other columns are ignored.
    """
    scored = docs.select(F.col("doc_id").cast("long").alias("doc_id"), toxicity(docs.sparkSession, model).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= cutoff).cast("int"))
