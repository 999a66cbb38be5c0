"""Alignment of the tokens of two tokenizers over one text, by interval coalescing.

Both tokenizers tile the bytes of a space and the text. All tokens of a batch are sorted by where they start; a running maximum of
their ends shows where a start reaches all ends so far, which is where both tokenizers end a token: there a group breaks. Inside a
group, at every distinct start, the latest token of either tokenizer overlap, and no other tokens do.

Tokenizer A is a byte-level BPE of the tokenizers library, B a sentencepiece model. Words are encoded once per batch by either
(``unit_store``) where that is proven to be exact, and whole texts by the library elsewhere.
"""

import functools
import hashlib
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from opinara.llm import pretokens
from opinara.llm.common import batches, doc_id, keyed_texts, scratch_table
from opinara.llm.token_counts import byte_letters
from opinara.llm.unit_store import WHOLE, Store, Units, gather, pieces, sums, text_of

MOST_BROADCAST = 2_000_000  # pairs of ids; 26 bytes each go to every executor, more pairs are joined by shuffle
SPACE = "▁"
_PAIRS = pa.schema([("pair", pa.int64()), ("links", pa.int64())])
_OF_DOCUMENTS = pa.schema([("id", pa.int64()), ("fp", pa.int64()), ("pair", pa.int64()), ("links", pa.int64())])
_GROUPS = pa.schema(
    [("id", pa.int64()), ("start", pa.int64()), ("end", pa.int64()), ("a", pa.list_(pa.int32())), ("b", pa.list_(pa.int32()))]
)


# ---- the two tokenizers ----


def spaced(unit: str) -> str:
    """What a unit stands for, with a space before a whole text."""
    return " " + unit[1:] if unit[0] == WHOLE else text_of(unit)


class ByteTokens:
    """Ids of a space and a text. Special strings inside texts are plain text."""

    def __init__(self, path: str):
        self.library = pretokens.Library(path)
        self.library.tokenizer.encode_special_tokens = True
        self.cuts = pretokens.cuts_like_byte_bpe(path)
        letters = byte_letters()
        entries = self.library.tokenizer.get_vocab(with_added_tokens=True)
        self.bytes = [b""] * (max(entries.values()) + 1)
        for entry, number in entries.items():
            self.bytes[number] = bytes(letters[c] for c in entry) if all(c in letters for c in entry) else entry.encode()

    def of_units(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Lengths of the units' runs of ids, and the runs."""
        found = self.library.ids_of_units([spaced(u) for u in units])
        return np.fromiter(map(len, found), np.int64, len(found)) // 4, np.frombuffer(b"".join(found), "<u4")


class PieceTokens:
    """Ids of a text by a model that puts a space before it."""

    def __init__(self, path: str):
        self.model = model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        entries = [model.id_to_piece(n) for n in range(size)]
        self.bytes = [bytes([int(p[3:5], 16)]) if model.is_byte(n) else p.replace(SPACE, " ").encode() for n, p in enumerate(entries)]
        plain = [p for n, p in enumerate(entries) if not (model.is_byte(n) or model.is_control(n) or model.is_unknown(n))]
        # Proof that words can be encoded one by one: no piece holds a line end, or a space after another character, and
        # normalization changes neither
        self.space = model.piece_to_id(SPACE)
        self.cuts = (
            not any("\n" in p or SPACE in p.lstrip(SPACE) for p in plain)
            and model.normalize("x  y\n zﬁ") == f"{SPACE}x{SPACE}{SPACE}y\n{SPACE}zﬁ"
            and [self.space, *model.encode("\n")[1:]] == model.encode("\n")
        )

    def of_units(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """A unit that starts with a line end has no space before it, so the one the model adds goes."""
        found = self.model.encode([u[1:] if u[0] == WHOLE else u for u in units], num_threads=1)
        for n, unit in enumerate(units):
            if unit[0] == "\n":
                del found[n][0]
        lengths = np.fromiter(map(len, found), np.int64, len(found))
        return lengths, np.fromiter(chain.from_iterable(found), np.uint32, int(lengths.sum()))


@dataclass
class Tokens:
    """Ids of units by both tokenizers, one unit after another, and how many each unit has."""

    a: np.ndarray
    b: np.ndarray
    n_a: np.ndarray
    n_b: np.ndarray


class Pair:
    """Both tokenizers, and what units come to: links, groups and their text. All ends of units are ends of tokens of both."""

    def __init__(self, a: str, b: str):
        self.a, self.b = ByteTokens(a), PieceTokens(b)
        self.units = Units([SPACE], spaced=True, cut=self.a.cuts and self.b.cuts)
        self.size_b, self.most = len(self.b.bytes), max(len(self.a.bytes), len(self.b.bytes))
        self.lengths_a, self.lengths_b = (np.array(list(map(len, t.bytes)), np.int64) for t in (self.a, self.b))
        self.kind = "<u4" if len(self.a.bytes) * self.size_b < 1 << 32 else "<u8"
        self.decimals = [f"{n}{mark}".encode() for mark in ",|;" for n in range(self.most)]
        self.store = Store(self._of_units, self.kind, (np.int64, np.int64, np.int64, object))

    def tokens(self, units: list[str]) -> Tokens:
        """A unit whose bytes aren't given back by both has no tokens."""
        (n_a, a), (n_b, b) = (self._given_back(units, tokens) for tokens in (self.a, self.b))
        both = (n_a > 0) & (n_b > 0)
        return Tokens(a[np.repeat(both, n_a)], b[np.repeat(both, n_b)], np.where(both, n_a, 0), np.where(both, n_b, 0))

    def _of_units(self, units: list[str]) -> tuple:
        tokens = self.tokens(units)
        links = coalesce(self.lengths_a[tokens.a], self.lengths_b[tokens.b])
        n_groups = sums(np.diff(links.group_a, prepend=-1), tokens.n_a)
        codes = tokens.a[links.a].astype(self.kind) * np.array(self.size_b, self.kind) + tokens.b[links.b].astype(self.kind)
        texts = np.empty(len(units), object)
        texts[:] = group_texts(self, tokens, links)
        return tokens.n_a + tokens.n_b - n_groups, codes, tokens.n_a, tokens.n_b, n_groups, texts

    @staticmethod
    def _given_back(units: list[str], tokens) -> tuple[np.ndarray, np.ndarray]:
        """The run of each unit; of length zero where the tokens don't give back its bytes."""
        lengths, flat = tokens.of_units(units)
        wanted = [spaced(u).encode("utf-8", "surrogatepass") for u in units]
        sizes = np.fromiter(map(len, wanted), np.int64, len(wanted))
        text = np.frombuffer(b"".join(wanted), np.uint8)
        token_sizes = np.fromiter(map(len, tokens.bytes), np.int64, len(tokens.bytes))
        token_starts, table = np.cumsum(token_sizes) - token_sizes, np.frombuffer(b"".join(tokens.bytes), np.uint8)
        of_unit = sums(token_sizes[flat], lengths)
        if not np.array_equal(of_unit, sizes):  # compare units of the right size only
            right = of_unit == sizes
            kept = np.repeat(right, lengths)
            bytes_kept = np.repeat(right, sizes)
        else:
            right, kept, bytes_kept = np.ones(len(units), bool), slice(None), slice(None)
        same = gather(table, token_starts[flat[kept]], token_sizes[flat[kept]]) == text[bytes_kept]
        right[right] = sums(same.astype(np.int64), sizes[right]) == sizes[right]
        return np.where(right, lengths, 0), flat[np.repeat(right, lengths)]

    def of_texts(self, texts: pa.Array) -> tuple[list[bytes], np.ndarray, np.ndarray, np.ndarray, list[bytes]]:
        """Per text: the pair of ids of each link, as one number each; n_a, n_b and n_groups; and the text of its groups."""
        numbers, units, counts = self.units.cut(pc.fill_null(texts, ""))
        places = self.store.places(units)
        lost = sums((self.store.lengths.held[places] == 0)[numbers].astype(np.int64), counts) > 0
        numbers, counts = numbers[~np.repeat(lost, counts)], np.where(lost, 0, counts)
        n_a, n_b, n_groups = (sums(c.held[places][numbers], counts) for c in self.store.columns[:3])
        data = self.store.gathered(places[numbers]).tobytes()
        ends = (np.cumsum(n_a + n_b - n_groups) * np.dtype(self.kind).itemsize).tolist()
        codes = [data[s:e] for s, e in zip([0, *ends[:-1]], ends, strict=True)]
        of_units = self.store.columns[3].held[places].tolist()
        parts = list(map(of_units.__getitem__, numbers.tolist()))
        ends = np.cumsum(counts).tolist()
        return codes, n_a, n_b, n_groups, [b"".join(parts[s:e])[:-1] for s, e in zip([0, *ends[:-1]], ends, strict=True)]

    def codes(self, stored: pa.Array) -> np.ndarray:
        return np.frombuffer(b"".join(stored.to_pylist()), self.kind)


@functools.cache
def pair_of(a: str, b: str) -> Pair:
    """One per Python worker, so that tasks share what it remembers."""
    return Pair(a, b)


# ---- coalescing ----


@dataclass
class Links:
    """Of tiles A and B (numbered from 0): which overlap, and the group of each tile."""

    a: np.ndarray
    b: np.ndarray
    group_a: np.ndarray
    group_b: np.ndarray


def coalesce(length_a: np.ndarray, length_b: np.ndarray) -> Links:
    """Groups and overlaps of two tilings, given by the lengths (one or more) of their tiles, that cover the same range."""
    end_a, end_b = np.cumsum(length_a), np.cumsum(length_b)
    starts, ends = np.concatenate([end_a - length_a, end_b - length_b]), np.concatenate([end_a, end_b])
    is_b = np.arange(len(starts)) >= len(end_a)
    order = np.lexsort((is_b, starts))
    starts, is_b = starts[order], is_b[order]
    reach = np.maximum.accumulate(ends[order])
    breaks = np.ones(len(starts), bool)
    breaks[1:] = starts[1:] >= reach[:-1]
    group = np.empty(len(starts), np.int64)
    group[order] = np.cumsum(breaks) - 1
    latest_a = np.maximum.accumulate(np.where(is_b, 0, order)) if len(order) else order
    latest_b = np.maximum.accumulate(np.where(is_b, order - len(end_a), 0)) if len(order) else order
    last = np.ones(len(starts), bool)  # of the one or two tiles with one start
    last[:-1] = starts[1:] != starts[:-1]
    return Links(latest_a[last], latest_b[last], group[: len(end_a)], group[len(end_a) :])


def group_texts(pair: Pair, tokens: Tokens, links: Links) -> list[bytes]:
    """``a1,a2|b1;a3|b2,b3;`` per unit: the ids of each group."""
    ids = np.concatenate([tokens.a, tokens.b]).astype(np.int64)
    of_b = np.arange(len(ids)) >= len(tokens.a)
    place = np.concatenate([links.group_a, links.group_b]) * 2 + of_b
    order = np.argsort(place, kind="stable")
    place = place[order]
    mark = np.full(len(ids), 2)
    mark[:-1] = np.where(place[1:] == place[:-1], 0, np.where(place[1:] // 2 == place[:-1] // 2, 1, 2))
    parts = list(map(pair.decimals.__getitem__, (mark * pair.most + ids[order]).tolist()))
    ends = np.cumsum(tokens.n_a + tokens.n_b).tolist()
    return [b"".join(parts[s:e]) for s, e in zip([0, *ends[:-1]], ends, strict=True)]


# ---- jobs ----

ENCODED = "id long, fp long, codes binary, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string"
_KINDS = {"long": pa.int64(), "binary": pa.binary(), "string": pa.string()}
_ENCODED = pa.schema([(name, _KINDS[kind]) for name, kind in (c.split() for c in ENCODED.split(", "))])


def _encode(a: str, b: str):
    def run(parts):
        pair = pair_of(a, b)
        for part in parts:
            for few in pieces(part):
                codes, n_a, n_b, n_groups, texts = pair.of_texts(few.column("text"))
                digests = [hashlib.sha256(t).hexdigest() if t else "" for t in texts]
                columns = [codes, n_a, n_b, n_groups, n_a + n_b - n_groups, digests]
                arrays = [few.column("id"), few.column("fp"), *(pa.array(c, f.type) for c, f in zip(columns, list(_ENCODED)[2:], strict=True))]
                yield pa.RecordBatch.from_arrays(arrays, schema=_ENCODED)

    return run


def _count_pairs(a: str, b: str):
    def rows(parts):
        pair = pair_of(a, b)
        for part in parts:
            for few in pieces(part, "codes"):
                codes, links = np.unique(pair.codes(few.column("codes")), return_counts=True)
                yield {"pair": codes.astype(np.int64), "links": links.astype(np.int64)}

    def run(parts):
        yield from batches(rows(parts), _PAIRS)

    return run


def _count_of_documents(a: str, b: str):
    def rows(parts):
        pair = pair_of(a, b)
        for part in parts:
            for few in pieces(part, "codes"):
                codes = pair.codes(few.column("codes")).astype(np.int64)
                places = np.repeat(np.arange(few.num_rows), few.column("n_links").to_numpy())
                order = np.lexsort((codes, places))
                codes, places = codes[order], places[order]
                first = np.flatnonzero(np.r_[True, (codes[1:] != codes[:-1]) | (places[1:] != places[:-1])][: len(codes)])
                id_, fp = (few.column(c).to_numpy()[places[first]] for c in ("id", "fp"))
                yield {"id": id_, "fp": fp, "pair": codes[first], "links": np.diff(np.r_[first, len(codes)])}

    def run(parts):
        yield from batches(rows(parts), _OF_DOCUMENTS)

    return run


def encode(docs: DataFrame, a: str, b: str) -> DataFrame:
    """A table of every row: id, fp (``common.keyed_texts``), the pairs of ids of its links as little-endian numbers, and the
    counts and digest of its groups."""
    return scratch_table(keyed_texts(docs).mapInArrow(_encode(a, b), ENCODED), "aligned")


def pair_counts(encoded: DataFrame, a: str, b: str) -> DataFrame:
    """pair (a's id times the size of b's vocabulary, plus b's id), links (how many link the two) and best (whether that is the
    most for the id of b), from a table of ``encode``."""
    size_b = sentencepiece.SentencePieceProcessor(model_file=b).get_piece_size()
    counted = encoded.mapInArrow(_count_pairs(a, b), "pair long, links long").groupBy("pair").agg(F.sum("links").alias("links"))
    counted = scratch_table(counted, "pairs")
    most = counted.groupBy((F.col("pair") % size_b).alias("b")).agg(F.max("links").alias("most"))  # a row per id at most
    joined = counted.join(F.broadcast(most), F.col("pair") % size_b == F.col("b"))
    return scratch_table(joined.select("pair", "links", (F.col("links") == F.col("most")).alias("best")), "pair-counts")


def align(docs: DataFrame, a: str, b: str, most_broadcast: int = MOST_BROADCAST) -> DataFrame:
    """doc_id, n_a and n_b (tokens), n_groups (ranges between offsets where both end a token), n_links (pairs of tokens whose bytes
    overlap), n_best (links of ids whose links in all documents are the most for that id of b), count_sum (over the links: how many
    there are of their pair of ids in all documents) and groups_sha256 of every row of a table with doc_id and text.

    ``a`` is a .json file of a byte-level BPE, ``b`` a .model file of sentencepiece that puts a space before a text, both on every
    executor. Null and empty texts, and texts that b doesn't give back, have no tokens: zeros and ''. Repeated rows count as often
    as they are there. Whole texts count, however long. Other columns are ignored.
    """
    spark, encoded = docs.sparkSession, encode(docs, a, b)
    counts = pair_counts(encoded, a, b)
    summed = _summed_by_broadcast if counts.count() <= most_broadcast else _summed_by_shuffle
    out = summed(spark, encoded, counts, a, b)
    return out.select(doc_id(), "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def _summed_by_broadcast(spark: SparkSession, encoded: DataFrame, counts: DataFrame, a: str, b: str) -> DataFrame:
    table = counts.toArrow().sort_by("pair")
    arrays = spark.sparkContext.broadcast(tuple(table.column(c).to_numpy() for c in ("pair", "links", "best")))
    names = [f.name for f in _ENCODED if f.name != "codes"]
    schema = pa.schema([_ENCODED.field(n) for n in names] + [("n_best", pa.int64()), ("count_sum", pa.int64())])

    def run(parts):
        pair, (known, links, best) = pair_of(a, b), arrays.value
        for part in parts:
            for few in pieces(part, "codes"):
                n, at = few.column("n_links").to_numpy(), np.searchsorted(known, pair.codes(few.column("codes")).astype(np.int64))
                more = [sums(best[at].astype(np.int64), n), sums(links[at], n)]
                yield pa.RecordBatch.from_arrays([*(few.column(c) for c in names), *map(pa.array, more)], schema=schema)

    kinds = dict(c.split() for c in ENCODED.split(", "))
    return encoded.mapInArrow(run, ", ".join([f"{n} {kinds[n]}" for n in names] + ["n_best long", "count_sum long"]))


def _summed_by_shuffle(spark: SparkSession, encoded: DataFrame, counts: DataFrame, a: str, b: str) -> DataFrame:
    """The same by a join on the pair. Rows that repeat id and text are alike, so their sums are divided by how many there are."""
    of_docs = encoded.mapInArrow(_count_of_documents(a, b), "id long, fp long, pair long, links long")
    of_docs = of_docs.join(counts.withColumnRenamed("links", "uses"), "pair")
    of_docs = of_docs.groupBy("id", "fp").agg(
        F.sum("links").alias("all"), F.sum(F.when(F.col("best"), F.col("links")).otherwise(0)).alias("n_best"), F.sum(F.col("links") * F.col("uses")).alias("count_sum")
    )
    rows = encoded.drop("codes").join(of_docs, ["id", "fp"], "left")
    return rows.withColumns({c: F.coalesce(F.expr(f"{c} div (all div n_links)"), F.lit(0)) for c in ("n_best", "count_sum")})


def groups(docs: DataFrame, a: str, b: str) -> DataFrame:
    """doc_id, start, end (bytes of a space and the text), a and b (ids) of every group of every row; see ``align``."""

    def rows(few, pair):
        numbers, units, counts = pair.units.cut(pc.fill_null(few.column("text"), ""))
        tokens = pair.tokens(units)
        lost = sums((tokens.n_a == 0)[numbers].astype(np.int64), counts) > 0
        numbers, counts = numbers[~np.repeat(lost, counts)], np.where(lost, 0, counts)
        ids_a, ids_b = (gather(flat, (np.cumsum(n) - n)[numbers], n[numbers]) for flat, n in ((tokens.a, tokens.n_a), (tokens.b, tokens.n_b)))
        if not len(ids_a):
            return
        lengths = pair.lengths_a[ids_a]
        links = coalesce(lengths, pair.lengths_b[ids_b])
        first_a, first_b = (np.searchsorted(g, np.arange(links.group_a[-1] + 1)) for g in (links.group_a, links.group_b))
        n_a = sums(tokens.n_a[numbers], counts)
        document, of_document = np.repeat(np.arange(few.num_rows), n_a), sums(lengths, n_a)
        start = (np.cumsum(lengths) - lengths)[first_a]
        before = (np.cumsum(of_document) - of_document)[document[first_a]]
        yield {
            "id": few.column("id").to_numpy()[document[first_a]],
            "start": start - before,
            "end": np.r_[start[1:], lengths.sum()] - before,
            "a": [p.tolist() for p in np.split(ids_a, first_a[1:])],
            "b": [p.tolist() for p in np.split(ids_b, first_b[1:])],
        }

    def run(parts):
        pair = pair_of(a, b)
        for part in parts:
            for few in pieces(part):
                yield from batches(rows(few, pair), _GROUPS)

    found = keyed_texts(docs).mapInArrow(run, "id long, start long, end long, a array<int>, b array<int>")
    return found.select(doc_id(), "start", "end", "a", "b")
