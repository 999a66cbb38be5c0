"""Benchmark decontamination: a size-partitioned MinHash containment search, verified exactly.

A test item of n shingles is contained in a document if at least ``ceil(threshold * n)`` of them occur there. Items fall into
partitions by size, and the partition sets how long the MinHash signature of an item is: its ``n - ceil(threshold * n) + 1``
smallest hashes, so a document that misses all of them misses too many shingles. Unlike with signatures of a fixed length, the
size of the document plays no part, and no item is missed however long the document is. Documents look up the hashes of all
their shingles; each hit is a candidate, and a candidate is verified by the share of the item's shingles, as text, that the
document holds.

Only DataFrame functions are used. The items are broadcast where a count of their bytes shows that they are small; past that
their signatures and texts are joined by shuffle, with the same rows.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opinara.llm.common import doc_id, keyed_texts, row_key, scratch_table
from opinara.operators.binding import bind

SHINGLE = 5
PERCENT = 80
BROADCAST_BYTES = 8 << 20  # of all item texts
_PARTITION = 8  # shingle counts of a partition lie within one factor of 2 ** (1 / 8)


def words(text: str) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+``, A-Z lower-cased."""
    lower = F.translate(F.col(text), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.coalesce(F.regexp_extract_all(lower, F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0)), F.array().cast("array<string>"))


def _hashed(df: DataFrame, length: int) -> DataFrame:
    """``words`` to ``grams``: a hash per run of ``length`` words."""
    df = bind(df.withColumn("hashes", F.transform("words", lambda w: F.xxhash64(w))), "hashes")
    starts = F.when(F.size("hashes") >= length, F.slice("hashes", 1, F.greatest(F.size("hashes") - length + 1, F.lit(0))))
    grams = F.transform(starts, lambda h, i: F.xxhash64(h, *(F.get("hashes", i + k) for k in range(1, length))))
    return df.withColumn("grams", F.coalesce(grams, F.array().cast("array<bigint>")))


def _texts_of_grams(length: int) -> Column:
    """The runs of ``length`` words as text, joined by one space, each once."""
    starts = F.when(F.size("words") >= length, F.slice("words", 1, F.greatest(F.size("words") - length + 1, F.lit(0))))
    grams = F.transform(starts, lambda w, i: F.concat_ws(" ", w, *(F.get("words", i + k) for k in range(1, length))))
    return F.array_distinct(F.coalesce(grams, F.array().cast("array<string>")))


def _needed(n: Column, percent: int) -> Column:
    return F.floor((n * percent + 99) / 100).cast("int")


def contained_items(docs: DataFrame, items: DataFrame, percent: int = PERCENT, length: int = SHINGLE) -> DataFrame:
    """id, fp (``common.keyed_texts``), item_id, n_shingles, n_found and containment for each item that a document contains.

    ``docs`` has doc_id and text, ``items`` item_id and text. An item is contained if at least ``percent`` per cent of its distinct
    shingles of ``length`` words occur in the document. Null and empty texts, and those with fewer words, have no shingles: such
    items are never found and such documents contain none. Repeated items are searched once per item_id and text, repeated rows
    of documents once; rows without an item_id keep a null there. Other columns are ignored.
    """
    items = items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).distinct()
    items = bind(items.withColumn("words", words("text")), "words").withColumn("shingles", _texts_of_grams(length))
    items = _hashed(bind(items, "shingles"), length).withColumn("grams", F.array_sort(F.array_distinct("grams")))
    items = items.filter(F.size("grams") > 0).withColumn("item", F.xxhash64("item_id", "text"))
    size = F.size("grams")
    # one signature length for all sizes of a partition: that of its largest size
    largest = F.floor(F.pow(2.0, (F.floor(F.log2(size) * _PARTITION) + 1) / _PARTITION)).cast("int")
    allowed = F.greatest(largest, size) - _needed(F.greatest(largest, size), percent)
    items = items.withColumn("signature", F.slice("grams", 1, F.greatest(allowed, size - _needed(size, percent)) + 1))
    items = scratch_table(items.select("item", "item_id", "shingles", "signature"), "items")
    bytes_ = items.agg(F.sum(F.length(F.to_json(F.struct("shingles", "signature"))))).head()[0] or 0
    small = bytes_ <= BROADCAST_BYTES

    keys = items.select("item", F.explode("signature").alias("gram")).distinct()
    texts = keyed_texts(docs)
    looked = bind(texts.withColumn("words", words("text")), "words").select("id", "fp", "words")
    looked = _hashed(looked, length).select("id", "fp", F.explode("grams").alias("gram"))
    hits = looked.join(F.broadcast(keys) if small else keys, "gram").select("id", "fp", "item").distinct()
    hits = scratch_table(hits, "candidates")

    found = texts.join(hits, ["id", "fp"]).join(F.broadcast(items) if small else items, "item")
    found = found.dropDuplicates(["id", "fp", "item"]).select("id", "fp", "text", "item_id", "shingles")
    found = bind(found.withColumn("words", words("text")), "words")
    count = F.size(F.array_intersect("shingles", _texts_of_grams(length)))
    found = bind(found.withColumn("n_found", count), "n_found").withColumn("n_shingles", F.size("shingles"))
    found = found.filter(F.col("n_found") >= _needed(F.col("n_shingles"), percent))
    return found.select("id", "fp", "item_id", "n_shingles", "n_found", (F.col("n_found") / F.col("n_shingles")).alias("containment"))


def contaminated(docs: DataFrame, items: DataFrame, percent: int = PERCENT, length: int = SHINGLE) -> DataFrame:
    """doc_id, item_id, n_shingles, n_found and containment, a row per document and item that it contains."""
    found = contained_items(docs, items, percent, length)
    return found.select(doc_id(), "item_id", *(F.col(c).cast("long") for c in ("n_shingles", "n_found")), "containment").distinct()


def clean_rows(docs: DataFrame, items: DataFrame, percent: int = PERCENT, length: int = SHINGLE) -> DataFrame:
    """The rows of a table, with all its columns, whatever their names, whose text contains no item."""
    found = scratch_table(contained_items(docs, items, percent, length).select("id", "fp").distinct(), "contaminated")
    id_, fp, _ = row_key()
    keyed = docs.select(F.struct("*").alias("row"), id_.alias("id"), fp.alias("fp"))
    return keyed.join(found, ["id", "fp"], "left_anti").select("row.*")
