"""Line de-duplication by a join on deletion neighbourhoods.

A line goes if an earlier line, in order of doc_id and place, is the same or within one edit (a character replaced, put in or
left out). Two lines are that close exactly if they are equal after leaving out the character at one place of both, or if one is
the other without one character. So all variants of a line with one character left out are emitted as hashed keys, equal variants
are joined, each line meets the earliest line of its variants only, and the edit distance of the two is verified.

Long lines have many variants, and few lines have a partner at all. So a coarser neighbourhood comes first, in which a whole part
of the line is left out: lines within one edit are equal outside the part that holds the edit. Halves thin out all lines, parts of
a sixteenth those that are left, and the variants of the rest are emitted in full. Neither step drops a pair within the bound.

A line is what stands between line ends, without white space around it; lines without a word are never removed. Lines under
``least`` characters are compared whole only, as one edit makes another word of them. Lines are named by 128-bit hashes.
"""

from collections.abc import Iterator
from itertools import batched, combinations, pairwise, product

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opinara.llm.common import SPACES, batches, doc_id, keyed_texts, scratch_table, signed

LEAST = 20
EDITS = 1
_HALVES, _PARTS = 2, 16
_LINE = "l1 long, l2 long"

_LINES = pa.schema(
    [(c, pa.int64()) for c in ("l1", "l2", "id", "fp")] + [("no", pa.int32()), ("keys", pa.list_(pa.int64()))]
)
_TEXTS = pa.schema([("l1", pa.int64()), ("l2", pa.int64()), ("line", pa.string()), ("keys", pa.list_(pa.int64()))])
_MARKED = pa.schema([(c, pa.int64()) for c in ("l1", "l2", "variant")] + [("marks", pa.int32()), ("left_out", pa.int32())])
_VARIANTS = pa.schema([("l1", pa.int64()), ("l2", pa.int64()), ("variant", pa.int64()), ("place", pa.int32()), ("shorter", pa.bool_())])


def lines_of(text: str | None) -> list[tuple[int, str]]:
    """Number and text of the lines with a word; numbers count all lines from 1."""
    found = ((n, line.strip(SPACES)) for n, line in enumerate((text or "").split("\n"), 1))
    return [(n, line) for n, line in found if line]


def name_of(line: str) -> tuple[int, int]:
    value = xxhash.xxh3_128_intdigest(line.encode("utf-8", "surrogatepass"))
    return signed(value >> 64), signed(value & (1 << 64) - 1)


def _key(text: str, *more: int) -> int:
    return signed(xxhash.xxh3_64_intdigest(text.encode("utf-8", "surrogatepass") + repr(more).encode()))


def coarse_keys(line: str, parts: int) -> list[int]:
    """A key per part left out, with parts as the line cuts them, and as a line one shorter would."""
    size, keys = len(line), []
    for of in (size, size - 1):
        edges = [j * of // parts for j in range(parts + 1)]
        for j in range(parts):
            keys.append(_key(line[: edges[j]] + "\n" + line[size - (of - edges[j + 1]) :], parts, of, j))
    return keys


def shifted_keys(line: str, edits: int) -> list[int]:
    """Keys of which two lines within ``edits`` share one: the parts of the longer line, and what a shorter one has near there."""
    size, found, parts = len(line), {}, edits + 1
    for of in range(size, size + parts):
        edges = [j * of // parts for j in range(parts + 1)]
        for j in range(parts):
            for start in range(max(0, edges[j] - edits), edges[j] + parts):
                stop = start + edges[j + 1] - edges[j]
                if stop <= size:
                    found[_key(line[start:stop], parts, of, j)] = None
    return list(found)


def marked_variants(line: str, edits: int) -> Iterator[tuple[int, int, int]]:
    """(key, characters marked, characters left out) of the line with up to ``edits`` of its characters marked or left out."""
    for n in range(edits + 1):
        for places in combinations(range(len(line)), n):
            edges = (-1, *places, len(line))
            pieces = [line[a + 1 : b] for a, b in pairwise(edges)]
            for marked in product((False, True), repeat=n):
                text = pieces[0] + "".join("\n" * m + piece for m, piece in zip(marked, pieces[1:], strict=True))
                marks = sum(marked)
                yield _key(text, marks), marks, n - marks


def variants(line: str) -> list[tuple[int, int, bool]]:
    """(key, place left out, or -1; whether the line is the variant). A place is part of the key where lines of one size meet."""
    whole = [_key(line[:i] + line[i + 1 :]) for i in range(len(line))]
    return [(_key(line), -1, True)] + [(k, -1, False) for k in dict.fromkeys(whole)] + [(k, i, False) for i, k in enumerate(whole)]


def _line_rows(least: int, edits: int):
    def keys_of(line):
        if len(line) < least:
            return []
        return coarse_keys(line, _HALVES) if edits == 1 else shifted_keys(line, edits)

    def rows(batch):
        for key, fp, text in zip(*(batch.column(c).to_pylist() for c in ("id", "fp", "text")), strict=True):
            lines = lines_of(text)
            if lines:
                names = [name_of(line) for _, line in lines]
                yield {
                    "l1": [a for a, _ in names],
                    "l2": [b for _, b in names],
                    "id": [key] * len(lines),
                    "fp": [fp] * len(lines),
                    "no": [n for n, _ in lines],
                    "keys": [keys_of(line) for _, line in lines],
                }

    return rows


def _text_rows(batch):
    for text, wanted in zip(batch.column("text").to_pylist(), batch.column("wanted").to_pylist(), strict=True):
        lines = dict(lines_of(text))
        some = [lines[w["no"]] for w in wanted]
        yield {"l1": [w["l1"] for w in wanted], "l2": [w["l2"] for w in wanted], "line": some, "keys": [coarse_keys(s, _PARTS) for s in some]}


def _variant_rows(batch):
    for a, b, line in zip(*(batch.column(c).to_pylist() for c in ("l1", "l2", "line")), strict=True):
        keys, places, shorter = zip(*variants(line), strict=True)
        n = len(keys)
        yield {"l1": np.full(n, a), "l2": np.full(n, b), "variant": np.array(keys, np.int64), "place": np.array(places, np.int32), "shorter": list(shorter)}


def _marked_rows(edits: int):
    def rows(batch):
        for a, b, line in zip(*(batch.column(c).to_pylist() for c in ("l1", "l2", "line")), strict=True):
            for some in batched(marked_variants(line, edits), 50_000):
                keys, marks, left_out = zip(*set(some), strict=True)
                n = len(keys)
                yield {
                    "l1": np.full(n, a),
                    "l2": np.full(n, b),
                    "variant": np.array(keys, np.int64),
                    "marks": np.array(marks, np.int32),
                    "left_out": np.array(left_out, np.int32),
                }

    return rows


def _over(rows, schema, most):
    def run(parts):
        for part in parts:
            yield from batches(rows(part), schema, most)

    return run


def _with_partner(lines: DataFrame) -> DataFrame:
    """The lines (l1, l2) that share one of their ``keys`` with another line."""
    keys = lines.select("l1", "l2", F.explode("keys").alias("key"))
    shared = keys.groupBy("key").agg(F.min("l1").alias("a"), F.max("l1").alias("z")).filter("a <> z").select("key")
    return keys.join(scratch_table(shared, "shared-keys"), "key").select("l1", "l2").distinct()


def _met_by_variant(some: DataFrame) -> DataFrame:
    """l1, l2 and ``partner`` (first, l1, l2), the earliest line within one edit, of the lines that have an earlier one."""
    emitted = some.select("l1", "l2", "line").mapInArrow(_over(_variant_rows, _VARIANTS, 100_000), f"{_LINE}, variant long, place int, shorter boolean")
    # the order of a line and its name, for the earliest of a variant
    emitted = scratch_table(emitted.join(some.select("l1", "l2", "first"), ["l1", "l2"]), "variants")
    turn = F.struct("first", "l1", "l2")
    earliest = emitted.groupBy("variant", "place").agg(
        F.min(F.when(F.col("shorter"), turn)).alias("of_shorter"),
        F.min(F.when(~F.col("shorter"), turn)).alias("of_longer"),
        F.min("first").alias("least"),
        F.max("first").alias("most"),
    )
    earliest = scratch_table(earliest.filter("least <> most").drop("least", "most"), "earliest")
    same_place = F.col("place") >= 0
    partner = F.when(same_place | F.col("shorter"), F.col("of_longer")).otherwise(F.col("of_shorter"))
    met = emitted.join(earliest, ["variant", "place"]).withColumn("partner", partner).filter(F.col("partner.first") < F.col("first"))
    return met.groupBy("l1", "l2").agg(F.min("partner").alias("partner"))


def _met_by_marked_variant(some: DataFrame, edits: int) -> DataFrame:
    """l1, l2 and ``partner`` (first, l1, l2), the earliest line within ``edits``, of the lines that have an earlier one."""
    emitted = some.select("l1", "l2", "line").mapInArrow(_over(_marked_rows(edits), _MARKED, 100_000), f"{_LINE}, variant long, marks int, left_out int")
    emitted = scratch_table(emitted.join(some.select("l1", "l2", "first"), ["l1", "l2"]), "variants")
    earliest = emitted.groupBy("variant", "marks", F.col("left_out").alias("others")).agg(F.min(F.struct("first", "l1", "l2")).alias("partner"))
    met = emitted.join(earliest, ["variant", "marks"])
    met = met.filter((F.col("marks") + F.col("left_out") + F.col("others") <= edits) & (F.col("partner.first") < F.col("first")))
    return met.groupBy("l1", "l2").agg(F.min("partner").alias("partner"))


def near_lines(texts: DataFrame, lines: DataFrame, firsts: DataFrame, edits: int = EDITS) -> DataFrame:
    """The lines (l1, l2) that an earlier line is within ``edits`` of."""
    candidates = scratch_table(_with_partner(lines).join(firsts, ["l1", "l2"]), "candidates")
    wanted = candidates.groupBy("first.id", "first.fp").agg(F.collect_list(F.struct("l1", "l2", "first.no")).alias("wanted"))
    found = texts.dropDuplicates(["id", "fp"]).join(wanted, ["id", "fp"]).select("text", "wanted")
    found = scratch_table(found.mapInArrow(_over(_text_rows, _TEXTS, 5_000), f"{_LINE}, line string, keys array<long>"), "candidate-lines")
    some = found.select("l1", "l2", "line")
    if edits == 1:
        some = some.join(scratch_table(_with_partner(found), "close"), ["l1", "l2"])
    some = scratch_table(some.join(firsts, ["l1", "l2"]), "close-lines")
    met = _met_by_variant(some) if edits == 1 else _met_by_marked_variant(some, edits)
    text = some.select("l1", "l2", "line")
    both = met.join(text, ["l1", "l2"]).join(
        text.select(F.col("l1").alias("p1"), F.col("l2").alias("p2"), F.col("line").alias("earlier")),
        (F.col("partner.l1") == F.col("p1")) & (F.col("partner.l2") == F.col("p2")),
    )
    return both.filter(F.levenshtein("line", "earlier", edits) >= 0).select("l1", "l2")


def repeated_lines(docs: DataFrame, least: int = LEAST, edits: int = EDITS) -> DataFrame:
    """id, fp (``common.keyed_texts``), n_lines (lines with a word), n_removed and removed (numbers of the lines that go, ascending).

    ``edits`` (at least one) is the bound within which lines count as the same.
    Takes any table with doc_id and text; a row per distinct row that has a line with a word. Rows without a doc_id come last in
    the order; rows that repeat doc_id and text count once. Other columns are ignored.
    """
    texts = keyed_texts(docs)
    lines = texts.mapInArrow(_over(_line_rows(least, edits), _LINES, 50_000), f"{_LINE}, id long, fp long, no int, keys array<long>")
    lines = scratch_table(lines, "lines")
    firsts = lines.groupBy("l1", "l2").agg(F.min(F.struct("id", "fp", "no")).alias("first"))
    firsts = scratch_table(firsts, "firsts")
    near = scratch_table(near_lines(texts, lines, firsts, edits).withColumn("near", F.lit(True)), "near")
    judged = scratch_table(firsts.join(near, ["l1", "l2"], "left"), "judged")
    placed = lines.select("l1", "l2", "id", "fp", "no").join(judged, ["l1", "l2"])
    gone = (F.col("first") < F.struct("id", "fp", "no")) | F.coalesce("near", F.lit(False))
    per_text = placed.groupBy("id", "fp").agg(
        F.countDistinct("no").alias("n_lines"), F.array_sort(F.collect_set(F.when(gone, F.col("no")))).alias("removed")
    )
    return per_text.select("id", "fp", "n_lines", F.size("removed").cast("long").alias("n_removed"), "removed")


def line_report(docs: DataFrame, least: int = LEAST, edits: int = EDITS) -> DataFrame:
    """doc_id, n_lines, n_removed and removed of every row; a row without a line with a word has none."""
    keys = keyed_texts(docs).select("id", "fp")
    found = scratch_table(repeated_lines(docs, least, edits), "repeated-lines")
    none = F.array().cast("array<int>")
    joined = keys.join(found, ["id", "fp"], "left")
    return joined.select(doc_id(), *(F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("n_lines", "n_removed")), F.coalesce("removed", none).alias("removed"))


def remove_lines(docs: DataFrame, least: int = LEAST, edits: int = EDITS) -> DataFrame:
    """doc_id, text without the lines that go, n_lines and n_removed of every row. A null text stays null."""
    found = scratch_table(repeated_lines(docs, least, edits), "repeated-lines")
    rows = keyed_texts(docs).join(found, ["id", "fp"], "left")
    numbered = F.transform(F.split("text", "\n"), lambda line, n: F.when(~F.coalesce(F.array_contains("removed", n + 1), F.lit(False)), line))
    kept = F.array_join(F.array_compact(numbered), "\n")
    text = F.when(F.coalesce("n_removed", F.lit(0)) > 0, kept).otherwise(F.col("text"))
    counts = (F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("n_lines", "n_removed"))
    return rows.select(doc_id(), text.alias("text"), *counts)
