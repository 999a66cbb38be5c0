"""Substring de-duplication by seed and extend.

Seeds are winnowed anchors: of the ``window - anchor + 1`` runs of ``anchor`` words inside a window of ``window`` words, the
one with the smallest hash. Equal windows choose the same anchor at the same place, so a repeat of ``window`` words or more
always meets in a join on anchors. Each occurrence of an anchor carries the longest stretch, to both sides, of windows that
chose it. Occurrences are joined to the earliest document of their anchor and stretch, never to each other:

1. a stretch that an earlier document has as a whole is a repeat as it stands;
2. where an anchor occurs in stretches that differ, the first document of each stretch is extended window by window, and
   each window is compared with the earliest document that has it.

A word goes if a window over it starts in a document with a smaller doc_id. Neighbouring windows unite to maximal repeats.
Work and rows grow with the number of anchors, also for a passage that a third of all documents share.
"""

import hashlib
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opinara.llm.common import batches, doc_id, gram_hashes, keyed_texts, scratch_table, word_hashes, words_of

WINDOW = 50
ANCHOR = 10
_CHUNK = 1 << 16

_SEEDS = pa.schema(
    [("anchor", pa.int64()), ("span", pa.int64()), ("id", pa.int64()), ("fp", pa.int64()), ("lo", pa.int32()), ("hi", pa.int32())]
)
_WINDOWS = pa.schema([("w1", pa.int64()), ("w2", pa.int64()), ("id", pa.int64()), ("fp", pa.int64()), ("pos", pa.int32())])
_KEPT = "id long, n_words long, n_removed long, kept_text string, kept_sha256 string, removed array<struct<start:int,stop:int>>"


def chosen_anchors(hashes: np.ndarray, reach: int) -> np.ndarray:
    """For each run of ``reach`` neighbouring hashes, the place of its (leftmost) smallest one."""
    n = len(hashes) - reach + 1
    out = np.empty(max(n, 0), np.int64)
    for start in range(0, n, _CHUNK):
        stop = min(n, start + _CHUNK)
        view = np.lib.stride_tricks.sliding_window_view(hashes[start : stop + reach - 1], reach)
        out[start:stop] = view.argmin(axis=1) + np.arange(start, stop)
    return out


def stretches(words: list[bytes], window: int, anchor: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Anchor hash, first and last window of each stretch of windows that chose the same anchor."""
    grams = gram_hashes(word_hashes(words), anchor)
    owner = chosen_anchors(grams, window - anchor + 1)
    first = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
    last = np.r_[first[1:], len(owner)] - 1
    return grams[owner[first]], first, last


def _offsets(words: list[bytes]) -> np.ndarray:
    """Where each word starts in the words joined by one space, and one past the end."""
    sizes = np.fromiter(map(len, words), np.int64, len(words)) + 1
    return np.r_[0, np.cumsum(sizes)]


def _seed_rows(window: int, anchor: int):
    def rows(batch):
        for key, fp, text in zip(*(batch.column(c).to_pylist() for c in ("id", "fp", "text")), strict=True):
            words = words_of(text)
            if len(words) < window:
                continue
            anchors, first, last = stretches(words, window, anchor)
            joined, at = b" ".join(words), _offsets(words)
            spans = [
                hashlib.blake2b(joined[a:b], digest_size=8).digest()
                for a, b in zip(at[first].tolist(), (at[last + window] - 1).tolist(), strict=True)
            ]
            yield {
                "anchor": anchors,
                "span": np.frombuffer(b"".join(spans), np.int64),
                "id": np.full(len(first), key, np.int64),
                "fp": np.full(len(first), fp, np.int64),
                "lo": first.astype(np.int32),
                "hi": last.astype(np.int32),
            }

    def run(parts):
        for part in parts:
            yield from batches(rows(part), _SEEDS)

    return run


def _window_rows(window: int):
    def rows(batch):
        for key, fp, text, stretch in zip(*(batch.column(c).to_pylist() for c in ("id", "fp", "text", "open")), strict=True):
            words = words_of(text)
            joined, at = b" ".join(words), _offsets(words)
            pos = np.unique(np.concatenate([np.arange(s["lo"], s["hi"] + 1) for s in stretch]))
            digests = b"".join(
                hashlib.blake2b(joined[a:b], digest_size=16).digest()
                for a, b in zip(at[pos].tolist(), (at[pos + window] - 1).tolist(), strict=True)
            )
            halves = np.frombuffer(digests, np.int64).reshape(-1, 2)
            yield {
                "w1": halves[:, 0].copy(),
                "w2": halves[:, 1].copy(),
                "id": np.full(len(pos), key, np.int64),
                "fp": np.full(len(pos), fp, np.int64),
                "pos": pos.astype(np.int32),
            }

    def run(parts):
        for part in parts:
            yield from batches(rows(part), _WINDOWS)

    return run


def _cut(window: int):
    schema = pa.schema(
        [
            ("id", pa.int64()),
            ("n_words", pa.int64()),
            ("n_removed", pa.int64()),
            ("kept_text", pa.string()),
            ("kept_sha256", pa.string()),
            ("removed", pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))),
        ]
    )

    def rows(batch):
        for key, text, repeats in zip(*(batch.column(c).to_pylist() for c in ("id", "text", "repeats")), strict=True):
            words = words_of(text)
            steps = np.zeros(len(words) + 1, np.int64)
            for r in repeats or ():
                steps[r["lo"]] += 1
                steps[r["hi"] + window] -= 1
            gone = np.cumsum(steps[:-1]) > 0
            edges = np.flatnonzero(np.diff(np.r_[False, gone, False].astype(np.int8)))
            kept = b" ".join(compress(words, ~gone))
            yield {
                "id": [key],
                "n_words": [len(words)],
                "n_removed": [int(gone.sum())],
                "kept_text": [kept.decode("utf-8", "surrogatepass")],
                "kept_sha256": [hashlib.sha256(kept).hexdigest()],
                "removed": [[{"start": a, "stop": b} for a, b in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True)]],
            }

    def run(parts):
        for part in parts:
            yield from batches(rows(part), schema, 1_000)

    return run


def remove_repeats(docs: DataFrame, window: int = WINDOW, anchor: int = ANCHOR) -> DataFrame:
    """Remove every word under a window of ``window`` words that also starts in a document with a smaller doc_id.

    Takes any table with doc_id and text. Returns one row per input row: doc_id, n_words, n_removed, kept_text (kept words
    joined by one space), kept_sha256 and removed (maximal repeats as half-open word ranges, in order). Windows are judged on
    the input. A null or empty text has no words. A row without a doc_id counts as later than all others; equal doc_ids never
    remove each other's words. Other columns are ignored.
    """
    texts = keyed_texts(docs)
    seeds = scratch_table(texts.mapInArrow(_seed_rows(window, anchor), "anchor long, span long, id long, fp long, lo int, hi int"), "seeds")
    repeated = (
        seeds.groupBy("anchor")
        .agg(F.min("id").alias("a"), F.max("id").alias("z"), F.min("span").alias("s"), F.max("span").alias("t"))
        .filter("a < z")
        .select("anchor", (F.col("s") != F.col("t")).alias("differ"))
    )
    repeated = scratch_table(repeated, "repeated")  # as tables, sums leave the joins free to split a hot key
    hits = scratch_table(seeds.join(repeated, "anchor"), "hits")
    firsts = scratch_table(hits.groupBy("anchor", "span").agg(F.min("id").alias("first")), "firsts")
    compared = hits.join(firsts, ["anchor", "span"])
    whole = compared.filter("id > first").select("id", "fp", "lo", "hi")
    open_ = (
        compared.filter("id = first and differ").groupBy("id", "fp").agg(F.collect_set(F.struct("lo", "hi")).alias("open"))
    )
    spread = texts.repartition(_partitions(docs), "id", "fp")
    windows = spread.join(open_, ["id", "fp"]).mapInArrow(_window_rows(window), "w1 long, w2 long, id long, fp long, pos int")
    windows = scratch_table(windows, "windows")
    earliest = windows.groupBy("w1", "w2").agg(F.min("id").alias("first"), F.max("id").alias("last")).filter("first < last")
    earliest = scratch_table(earliest, "earliest")
    single = windows.join(earliest, ["w1", "w2"]).filter("id > first").select("id", "fp", F.col("pos").alias("lo"), F.col("pos").alias("hi"))
    repeats = whole.unionByName(single).groupBy("id", "fp").agg(F.collect_set(F.struct("lo", "hi")).alias("repeats"))
    cut = spread.join(repeats, ["id", "fp"], "left").mapInArrow(_cut(window), _KEPT)
    return cut.select(doc_id(), *cut.columns[1:])


def _partitions(docs: DataFrame) -> int:
    return int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
