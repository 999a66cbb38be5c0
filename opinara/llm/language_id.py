"""Language identification by prediction by partial matching.

For each language a tree of byte contexts up to three bytes deep is counted on all labelled texts and then frozen. A
byte is coded in the longest context the tree has; a byte that never followed it costs an escape (method C: as likely as the
number of different bytes seen there) and is coded in the next shorter context, without the bytes already ruled out, down to
the uniform code. The code length of a text is the sum over all of its bytes, and the language with the shortest code wins.

The frozen tree is flattened, which changes no code length: a row of 128 costs for each context of the tree, and for each of
the 128^3 triples of symbols the rows of its longest context, in one table for all languages. So a model has no more than 128^3
contexts a language, however long the texts. Symbols are the 127 commonest bytes of the texts; other bytes share the last symbol
and cost a uniform choice more. Letters A-Z are lower-cased and a text is taken to follow a line end.
"""

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opinara.llm.common import batches

UNKNOWN = "und"
_DEPTH = 3
_SYMBOLS = 128
_PAD = b"\n" * _DEPTH
_PIECE = 1 << 21  # bytes of texts whose grams are counted at once
_BLOCK = 512  # contexts whose chances are worked out at once
_LETTER = regex.compile(r"\p{L}")
_LEVELS = range(3, 12)  # pieces of 8 to 2,048 bytes tell how far the code lengths of a language spread
_BINS = 64  # of a bit per byte
_LEAST_PIECES = 20
_MARGIN = 5.0  # distances from the median to the 95th percentile
_SPREAD = pa.schema([("lang", pa.string()), ("level", pa.int32()), ("bin", pa.int32()), ("uses", pa.int64())])
_COUNTS = pa.schema([("lang", pa.string()), ("half", pa.int32()), ("gram", pa.int64()), ("uses", pa.int64())])


def _grams(texts: list[bytes]) -> np.ndarray:
    """Each byte of the texts with the three before it, as one number."""
    data = np.frombuffer(b"".join(_PAD + t for t in texts), np.uint8)
    coded = np.ones(len(data), bool)
    before = np.cumsum([0, *(len(t) + _DEPTH for t in texts[:-1])])
    coded[(before[:, None] + np.arange(_DEPTH)).ravel()] = False
    wide = data.astype(np.uint32)
    return (wide[:-3] << 24 | wide[1:-2] << 16 | wide[2:-1] << 8 | wide[3:])[coded[3:]]


def _merged(values: list[np.ndarray], uses: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The distinct values of some lists, and the sums of their uses."""
    found, at = np.unique(np.concatenate(values), return_inverse=True)
    return found, np.bincount(at, np.concatenate(uses), len(found)).astype(np.int64)


def _count_grams(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The grams of a task's texts by language and half, each once."""
    counts: dict[tuple, tuple[np.ndarray, np.ndarray]] = {}
    held: dict[tuple, list[bytes]] = {}
    size = 0

    def count():
        for key, texts in held.items():
            grams, uses = np.unique(_grams(texts), return_counts=True)
            before = counts.get(key)
            counts[key] = _merged([before[0], grams], [before[1], uses]) if before else (grams, uses)
        held.clear()

    for part in parts:
        texts = part.column("text").cast(pa.binary())
        for lang, half, text in zip(part.column("lang").to_pylist(), part.column("half").to_pylist(), texts, strict=True):
            text = text.as_py().lower()
            held.setdefault((lang, half), []).append(text)
            size += len(text)
            if size >= _PIECE:
                count()
                size = 0
    count()
    rows = ({"lang": [k[0]] * len(g), "half": [k[1]] * len(g), "gram": g.astype(np.int64), "uses": n} for k, (g, n) in counts.items() if len(g))
    yield from batches(rows, _COUNTS)


def labelled(docs: DataFrame) -> DataFrame:
    """lang and text of all labelled texts, and the half that each is in, by its hash."""
    half = F.pmod(F.xxhash64(F.lit("half"), "text"), F.lit(2)).cast("int")
    return docs.filter("lang is not null and text is not null").select("lang", "text", half.alias("half"))


def gram_counts(docs: DataFrame) -> pd.DataFrame:
    """How often each gram is in the labelled texts of a language (``uses``), and in those of either half (``half_0``, ``half_1``).
    Every text is counted, in its task first. What comes to the driver are the distinct grams."""
    found = labelled(docs).mapInArrow(_count_grams, "lang string, half int, gram long, uses long").groupBy("lang", "gram")
    in_half = [F.sum(F.when(F.col("half") == n, F.col("uses")).otherwise(0)).alias(f"half_{n}") for n in (0, 1)]
    table = found.agg(F.sum("uses").alias("uses"), *in_half).toArrow()
    return table.set_column(0, "lang", table["lang"].dictionary_encode()).to_pandas()


class Model:
    """Frozen code lengths in bits: ``costs[l][rows[l][place[context]] * 128 + symbol]``."""

    def __init__(self, counts: pd.DataFrame):
        self.langs = sorted(counts["lang"].unique())
        by_byte = np.zeros(256)
        np.add.at(by_byte, counts["gram"].to_numpy(np.int64) & 255, counts["uses"].to_numpy(np.float64))
        common = np.argsort(-by_byte, kind="stable")[: _SYMBOLS - 1]
        self.symbol = np.full(256, _SYMBOLS - 1, np.uint32)
        self.symbol[common] = np.arange(_SYMBOLS - 1, dtype=np.uint32)
        self.others = 256 - (_SYMBOLS - 1)
        self.place, self.rows, self.costs = np.zeros(_SYMBOLS**_DEPTH, np.int32), [], []
        for lang in self.langs:
            mine = (counts["lang"] == lang).to_numpy()
            rows, costs = self._tree(counts["gram"].to_numpy(np.int64)[mine], counts["uses"].to_numpy(np.float64)[mine])
            self._add_rows(rows, len(costs) // _SYMBOLS)
            self.costs.append(costs)

    def _add_rows(self, rows: np.ndarray, size: int) -> None:
        """Contexts with the same rows in all languages so far and in one more have one place; worked out in blocks."""
        blocks = [slice(n, n + _SYMBOLS**2) for n in range(0, len(rows), _SYMBOLS**2)]
        pair = lambda block: self.place[block].astype(np.int64) * size + rows[block]
        pairs = np.unique(np.concatenate([np.unique(pair(block)) for block in blocks]))
        for block in blocks:
            self.place[block] = np.searchsorted(pairs, pair(block))
        self.rows = [r[pairs // size] for r in self.rows] + [(pairs % size).astype(np.int32)]

    def _tree(self, grams: np.ndarray, uses: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        s = [self.symbol[grams >> shift & 255].astype(np.int64) for shift in (24, 16, 8, 0)]
        shorter = np.full((1, _SYMBOLS), 1 / _SYMBOLS)  # the uniform code
        longest = np.zeros(_SYMBOLS**_DEPTH, np.int32)
        cube = longest.reshape((_SYMBOLS,) * _DEPTH)
        costs, total = [], 0
        parent_of = np.zeros(1, np.int64)
        for depth in range(_DEPTH + 1):
            context = np.zeros(len(grams), np.int64)
            for k in range(_DEPTH - depth, _DEPTH):
                context = context * _SYMBOLS + s[k]
            seen, where = np.unique(context, return_inverse=True)
            order = np.argsort(where, kind="stable")
            parents = parent_of[seen % _SYMBOLS ** max(depth - 1, 0)] if depth else np.zeros(len(seen), np.int64)
            longer = []
            for first in range(0, len(seen), _BLOCK):
                size = min(_BLOCK, len(seen) - first)
                mine = order[np.searchsorted(where, first, sorter=order) : np.searchsorted(where, first + size, sorter=order)]
                table = np.zeros((size, _SYMBOLS))
                np.add.at(table, (where[mine] - first, s[_DEPTH][mine]), uses[mine])
                chances = self._with_escape(table, shorter[parents[first : first + size]])
                bits = -np.log2(chances)
                bits[:, -1] += math.log2(self.others)
                costs.append(bits.astype(np.float32).ravel())
                if depth < _DEPTH:
                    longer.append(chances)
            shorter = np.concatenate(longer) if longer else shorter
            if depth < _DEPTH:
                parent_of = np.zeros(_SYMBOLS**depth, np.int64)
                parent_of[seen] = np.arange(len(seen))
            place = np.unravel_index(seen, (_SYMBOLS,) * depth) if depth else ()
            cube[(..., *place)] = total + np.arange(len(seen))
            total += len(seen)
        return longest, np.concatenate(costs)

    @staticmethod
    def _with_escape(counts: np.ndarray, below: np.ndarray) -> np.ndarray:
        """Chances of the next symbol, given counts in a context and the chances in the next shorter one."""
        seen = counts > 0
        kinds, total = seen.sum(1, keepdims=True), counts.sum(1, keepdims=True)
        rest = np.where(seen, 0, below).sum(1, keepdims=True)
        closed = rest <= 0  # every symbol was seen: no escape is needed
        escape = np.where(closed, 0, kinds / (total + kinds))
        kept = np.where(closed, counts / total, counts / (total + kinds))
        return np.where(seen, kept, escape * below / np.where(closed, 1, rest))

    def bits(self, texts: list[bytes]) -> np.ndarray:
        """Code length of each text in each language."""
        sizes = np.array([len(t) for t in texts])
        symbols = self.symbol[np.frombuffer(b"".join(_PAD + t.lower() for t in texts), np.uint8)]
        place = self.place[symbols[:-3] << np.uint32(14) | symbols[1:-2] << np.uint32(7) | symbols[2:-1]]
        ends = np.cumsum(sizes + _DEPTH) - _DEPTH
        out = np.zeros((len(texts), len(self.langs)))
        for n, (rows, costs) in enumerate(zip(self.rows, self.costs, strict=True)):
            bits = costs[rows[place].astype(np.int64) * _SYMBOLS + symbols[3:]]
            sums = np.concatenate([[0.0], np.cumsum(bits, dtype=np.float64)])
            out[:, n] = sums[ends] - sums[ends - sizes]
        return out

    def byte_bits(self, text: bytes, lang: str) -> np.ndarray:
        """Code length of each byte in one language."""
        n = self.langs.index(lang)
        symbols = self.symbol[np.frombuffer(_PAD + text.lower(), np.uint8)]
        place = self.place[symbols[:-3] << np.uint32(14) | symbols[1:-2] << np.uint32(7) | symbols[2:-1]]
        return self.costs[n][self.rows[n][place].astype(np.int64) * _SYMBOLS + symbols[3:]]

    def fits(self, texts: list[str | None], limits: dict[str, list[float]]) -> list[bool]:
        """Whether the shortest code has no more bits per byte than the ``limits`` of its language allow at that length."""
        out = [False] * len(texts)
        for n, text in enumerate(texts):
            if text and self.langs and _LETTER.search(text):
                data = text.encode("utf-8", "surrogatepass")
                bits = self.bits([data])[0]
                level = min(len(data).bit_length() - 1, _LEVELS[-1]) - _LEVELS[0]
                out[n] = level < 0 or bool(bits.min() / len(data) <= limits.get(self.langs[bits.argmin()], [math.inf] * len(_LEVELS))[level])
        return out

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        langs, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
        some = [n for n, t in enumerate(texts) if t and self.langs and _LETTER.search(t)]
        held, size = [], 0
        for n in some:
            held.append(n)
            size += len(texts[n])
            if size >= 1_000_000 or n == some[-1]:
                bits = self.bits([texts[m].encode("utf-8", "surrogatepass") for m in held])
                best = bits.argmin(1)
                shares = 1 / np.exp2(np.maximum(bits.min(1, keepdims=True) - bits, -1000)).sum(1)
                for m, b, share in zip(held, best.tolist(), shares.tolist(), strict=True):
                    langs[m], scores[m] = self.langs[b], share
                held, size = [], 0
        return langs, scores


def train(docs: DataFrame, counts: pd.DataFrame | None = None) -> Model:
    """Statistics of text by non-null lang, from all of them; ``counts`` are the ``gram_counts`` if they are known. What comes to the
    driver is bounded by the possible grams and grows with the different ones, not with the texts."""
    return Model(gram_counts(docs) if counts is None else counts)


def limits(docs: DataFrame, counts: pd.DataFrame | None = None) -> dict[str, list[float]]:
    """The most bits per byte that a text of a language has, by language and length from 2 ** 3 to 2 ** 11 bytes.

    Either half of the labelled texts is coded by the statistics of the other half, piece by piece. A limit lies five times as far
    above the median of the pieces of a length as their 95th percentile does. A length with few pieces has the limit of a shorter one.
    """
    counts = gram_counts(docs) if counts is None else counts
    both = []
    for n in (0, 1):  # one after the other: a worker holds one model at a time
        others = counts[["lang", "gram"]].assign(uses=counts[f"half_{1 - n}"])
        both.append(_spread(labelled(docs).filter(F.col("half") == n), Model(others[others["uses"] > 0])))
    found = pd.concat(both).groupby(["lang", "level", "bin"], as_index=False)["uses"].sum()
    out = {}
    for (lang, level), group in found.sort_values(["lang", "level", "bin"]).groupby(["lang", "level"]):
        held = out.setdefault(lang, [math.inf] * len(_LEVELS))
        sums = group["uses"].cumsum().to_numpy()
        if sums[-1] >= _LEAST_PIECES:
            middle, high = ((group["bin"].to_numpy()[np.searchsorted(sums, share * sums[-1])] + 1) / _BINS for share in (0.5, 0.95))
            held[level - _LEVELS[0] :] = [float(middle + _MARGIN * (high - middle))] * (len(_LEVELS) + _LEVELS[0] - level)
    return out


def _spread(texts: DataFrame, model: Model) -> pd.DataFrame:
    """How many pieces of each length have how many bits per byte in their own language: lang, level, bin, uses."""
    shared = texts.sparkSession.sparkContext.broadcast(model)

    def rows(held):
        for lang, codes in held.items():
            found, uses = np.unique(np.concatenate(codes), return_counts=True)
            yield {"lang": [lang] * len(found), "level": found >> 32, "bin": found & 0xFFFFFFFF, "uses": uses}

    def spread(parts):
        model, held, size = shared.value, {}, 0
        for part in parts:
            for lang, text in zip(part.column("lang").to_pylist(), part.column("text").cast(pa.binary()), strict=True):
                if lang not in model.langs:
                    continue
                sums = np.concatenate([[0.0], np.cumsum(model.byte_bits(text.as_py(), lang), dtype=np.float64)])
                for level in _LEVELS:
                    per_byte = np.diff(sums[:: 1 << level]) / (1 << level)
                    held.setdefault(lang, []).append((per_byte * _BINS).astype(np.int64) | level << 32)
                size += len(sums)
                if size >= _PIECE:
                    yield from batches(rows(held), _SPREAD)
                    held, size = {}, 0
        yield from batches(rows(held), _SPREAD)

    found = texts.mapInArrow(spread, "lang string, level int, bin int, uses long").groupBy("lang", "level", "bin").agg(F.sum("uses").alias("uses"))
    out = found.toPandas()
    shared.destroy()
    return out


def fitting(docs: DataFrame, model: Model, allowed: dict[str, list[float]]) -> DataFrame:
    """The rows of a table with text that are in a learned language by the ``limits``. Null texts and those without a letter
    go; texts under eight bytes with a letter stay, as they are too short to tell."""
    shared = docs.sparkSession.sparkContext.broadcast((model, allowed))

    @F.pandas_udf("boolean")
    def fits(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model, allowed = shared.value
        for part in parts:
            yield pd.Series(model.fits(part.tolist(), allowed), dtype="bool")

    return docs.filter(fits(F.col("text").cast("string")))


def language(spark, model: Model, text: str = "text") -> Column:
    """Struct of lang_pred and score for a text column."""
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, score double")
    def predict(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for part in parts:
            langs, scores = shared.value.predict(part.tolist())
            yield pd.DataFrame({"lang_pred": langs, "score": scores})

    return predict(F.col(text).cast("string"))


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """All columns of a table with text, and ``language``, a struct of lang_pred and score.

    lang_pred is the learned language with the shortest code, the first by name in a tie; ``und`` with score 0 for a null text,
    a text without a letter, or when nothing was learned. score is the share of that language when all are equally likely
    before. Whole texts count, however long. A column of the name ``language`` is replaced.
    """
    return docs.withColumn("language", language(docs.sparkSession, model))
