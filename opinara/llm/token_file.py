"""Token ids on file as directly addressable codes.

An id is split into chunks of eight bits. The lowest chunks of all ids form level 0, the next chunks of those ids that have
more form level 1, and so on. A bitmap per level says which ids go on, and a rank directory with the number of set bits before
every 512 turns a place on one level into the place on the next, so any id is read without decoding its neighbours.

A table of such blocks is Parquet: one row per block with whole documents in ascending doc_id order, the ids as one binary
value, and the doc_ids and lengths beside it. Documents are dealt by range, so each shard encodes and writes its own.
"""

import functools
import struct
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from opinara.llm import pretokens
from opinara.llm.common import batches, doc_id, keyed_texts
from opinara.llm.unit_store import Store, Units, pieces, pre_token_units, sums, text_of

BLOCK_IDS = 1 << 18  # a block is closed when it holds so many ids; a document is never split
MOST_UNITS = 1_000_000  # units that a task remembers
MAGIC = b"DAC1"
_STEP = 512

TABLE = (
    "shard int, block int, start long, n_ids long, ids array<long>, lengths array<long>, codes binary"  # ids: of documents
)
_TABLE = pa.schema(
    [
        ("shard", pa.int32()),
        ("block", pa.int32()),
        ("start", pa.int64()),
        ("n_ids", pa.int64()),
        ("ids", pa.list_(pa.int64())),
        ("lengths", pa.list_(pa.int64())),
        ("codes", pa.binary()),
    ]
)


def encode(ids: np.ndarray) -> bytes:
    """The codes of unsigned 32-bit ids: a header, then per level its size, chunks, bitmap words and directory."""
    values, levels = np.asarray(ids, np.uint32), []
    while len(values) or not levels:
        more = values > 255
        bits = np.packbits(more, bitorder="little")
        bits = np.r_[bits, np.zeros(-len(bits) % 8, np.uint8)].view("<u8")
        counts = np.bitwise_count(bits).astype(np.int64)
        heads = np.add.reduceat(counts, np.arange(0, len(counts), _STEP // 64)) if len(counts) else counts
        directory = np.r_[0, np.cumsum(heads)[:-1]].astype("<u4") if len(heads) else np.zeros(0, "<u4")
        chunks = (values & np.uint32(255)).astype(np.uint8)
        levels.append((chunks, bits, directory))
        values = values[more] >> np.uint32(8)
        if not len(values):
            break
    parts = [MAGIC, struct.pack("<I", len(levels))]
    for chunks, bits, directory in levels:
        parts += [struct.pack("<QQQ", len(chunks), len(bits), len(directory)), chunks.tobytes(), bits.tobytes(), directory.tobytes()]
    return b"".join(parts)


class Codes:
    """A view of encoded ids. Indexing reads single places; nothing is decoded ahead."""

    def __init__(self, data: bytes):
        if data[:4] != MAGIC:
            raise ValueError("not a block of directly addressable codes")
        (n,), at = struct.unpack_from("<I", data, 4), 8
        self.levels = []
        for _ in range(n):
            chunks, bits, heads = struct.unpack_from("<QQQ", data, at)
            at += 24
            level = []
            for kind, count, width in ((np.uint8, chunks, 1), ("<u8", bits, 8), ("<u4", heads, 4)):
                level.append(np.frombuffer(data, kind, count, at))
                at += count * width
            self.levels.append(level)

    def __len__(self) -> int:
        return len(self.levels[0][0])

    def at(self, places: np.ndarray) -> np.ndarray:
        """The ids at the given places, in any order."""
        places = np.asarray(places, np.int64)
        out, where = np.zeros(len(places), np.uint32), np.arange(len(places))
        for depth, (chunks, bits, directory) in enumerate(self.levels):
            out[where] |= chunks[places].astype(np.uint32) << np.uint32(8 * depth)
            word, bit = places >> 6, (places & 63).astype(np.uint64)
            more = (bits[word] >> bit) & np.uint64(1) == 1
            places, word, bit, where = places[more], word[more], bit[more], where[more]
            if not len(where):
                break
            rank = directory[places // _STEP].astype(np.int64)
            first = places // _STEP * (_STEP // 64)
            for step in range(_STEP // 64 - 1):
                inside = first + step < word
                rank[inside] += np.bitwise_count(bits[first[inside] + step])
            rank += np.bitwise_count(bits[word] & ((np.uint64(1) << bit) - np.uint64(1)))
            places = rank
        return out

    def all(self) -> np.ndarray:
        """Every id, level by level."""
        out = np.zeros(len(self), np.uint32)
        where = np.arange(len(self))
        for depth, (chunks, bits, _) in enumerate(self.levels):
            out[where] |= chunks.astype(np.uint32) << np.uint32(8 * depth)
            where = where[np.unpackbits(bits.view(np.uint8), count=len(chunks), bitorder="little").astype(bool)]
        return out


class Encoder:
    """Ids of texts as the tokenizers library gives them."""

    def __init__(self, path: str):
        self.library = pretokens.Library(path)
        kept = [*pretokens.added_strings(path), pretokens.UNSETTLED]
        self.units = Units(kept, spaced=False, cut=pretokens.cuts_like_byte_bpe(path), uneven=pre_token_units)
        self.store = Store(self._of_units, most=MOST_UNITS)

    def _of_units(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found = self.library.ids_of_units([text_of(u) for u in units])
        return np.fromiter(map(len, found), np.int64, len(found)) // 4, np.frombuffer(b"".join(found), "<u4")

    def ids(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, one text after another, and how many each has. Null is an empty text."""
        numbers, units, counts = self.units.cut(pc.fill_null(texts, ""))
        places = self.store.places(units)[numbers]
        return self.store.gathered(places), sums(self.store.lengths.held[places], counts)


@functools.cache
def encoder(path: str) -> Encoder:
    """One per Python worker, so that tasks share what it remembers."""
    return Encoder(path)


def _blocks(path: str, end_id: int, block_ids: int):
    def rows(parts):
        codes, shard = encoder(path), TaskContext.get().partitionId()
        start, block, held, keys, lengths = 0, 0, [], [], []

        def full():
            nonlocal start, block, held, keys, lengths
            size = sum(lengths)
            row = {
                "shard": [shard],
                "block": [block],
                "start": [start],
                "n_ids": [size],
                "ids": [keys],
                "lengths": [lengths],
                "codes": [encode(np.concatenate(held))],
            }
            start, block, held, keys, lengths = start + size, block + 1, [], [], []
            return row

        size = 0
        for part in parts:
            for few in pieces(part):
                ids, counts = codes.ids(few.column("text"))
                # the end id goes behind the ids of each text
                ends = np.cumsum(counts + 1)
                whole = np.full(int(ends[-1]), end_id, np.uint32)
                whole[np.delete(np.arange(len(whole)), ends - 1)] = ids
                names, at = few.column("id").to_pylist(), 0
                while at < len(names):
                    begin = int(ends[at - 1]) if at else 0
                    last = int(np.searchsorted(ends, begin + block_ids - size))  # the document that fills the block
                    some = slice(at, min(last, len(names) - 1) + 1)
                    at = some.stop
                    held.append(whole[begin : int(ends[at - 1])])
                    keys += names[some]
                    lengths += (counts[some] + 1).tolist()
                    size += len(held[-1])
                    if size >= block_ids:
                        yield full()
                        size = 0
        if held:
            yield full()

    def run(parts):
        yield from batches(rows(parts), _TABLE, 1)

    return run


def write_tokens(docs: DataFrame, path: str, tokenizer: str, end_id: int = 0, shards: int | None = None, block_ids: int = BLOCK_IDS) -> None:
    """Encode every text of a table with doc_id and text, append ``end_id`` to each, and write the blocks to ``path``.

    Order is ascending doc_id, then the text's hash; rows without a doc_id come last. A null text is an empty one. Rows may
    repeat; an empty table gives a table without blocks. Other columns are ignored.
    """
    shards = shards or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = keyed_texts(docs).repartitionByRange(shards, "id", "fp").sortWithinPartitions("id", "fp")
    ordered.mapInArrow(_blocks(tokenizer, end_id, block_ids), TABLE).write.parquet(path)


def read_blocks(spark: SparkSession, path: str) -> DataFrame:
    """The blocks, with ``first``: how many ids all blocks before hold. There are no more shards than there were tasks."""
    blocks = spark.read.schema(TABLE).parquet(path)
    sizes = blocks.groupBy("shard").agg(F.sum("n_ids").alias("ids_of_shard"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("shard", F.coalesce(F.sum("ids_of_shard").over(before), F.lit(0)).alias("before"))
    return blocks.join(F.broadcast(sizes), "shard").withColumn("first", F.col("before") + F.col("start")).drop("before")


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens (with the end id) and ids_crc32, from the blocks alone."""
    schema = pa.schema([("id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])

    def rows(batch):
        for first, keys, lengths, codes in zip(*(batch.column(c).to_pylist() for c in ("first", "ids", "lengths", "codes")), strict=True):
            ids = Codes(codes).all().astype("<u4")
            ends = np.cumsum(lengths)
            yield {
                "id": np.array(keys, np.int64),
                "start": first + ends - lengths,
                "n_tokens": np.array(lengths, np.int64),
                "ids_crc32": np.array([zlib.crc32(ids[e - n : e].tobytes()) for e, n in zip(ends, lengths, strict=True)], np.int64),
            }

    def run(parts):
        for part in parts:
            yield from batches(rows(part), schema)

    read = read_blocks(spark, path).select("first", "ids", "lengths", "codes")
    read = read.mapInArrow(run, "id long, start long, n_tokens long, ids_crc32 long")
    return read.select(doc_id(), "start", "n_tokens", "ids_crc32")


def tokens_at(places: DataFrame, path: str, bin_ids: int = BLOCK_IDS) -> DataFrame:
    """place and id for a table of places (a column ``place``: 0 is the first id of all), by random access.

    Places past the end, or null, have no row. Places meet blocks by an equi-join on bins of ``bin_ids`` ids; the distinct
    places of one bin are bounded by its size.
    """
    spark = places.sparkSession
    last = F.col("first") + F.col("n_ids") - 1
    blocks = read_blocks(spark, path).select("first", "n_ids", "codes")
    blocks = blocks.withColumn("bin", F.explode(F.sequence(F.floor(F.col("first") / bin_ids), F.floor(last / bin_ids))))
    asked = places.select(F.col("place").cast("long").alias("place")).filter("place >= 0")
    asked = asked.groupBy(F.floor(F.col("place") / bin_ids).alias("bin")).agg(F.collect_set("place").alias("places"))
    schema = pa.schema([("place", pa.int64()), ("id", pa.int64())])

    def rows(batch):
        for first, n, codes, wanted in zip(*(batch.column(c).to_pylist() for c in ("first", "n_ids", "codes", "places")), strict=True):
            inside = np.array(sorted(p for p in wanted if first <= p < first + n), np.int64)
            if len(inside):
                yield {"place": inside, "id": Codes(codes).at(inside - first).astype(np.int64)}

    def run(parts):
        for part in parts:
            yield from batches(rows(part), schema)

    found = blocks.join(asked, "bin").select("first", "n_ids", "codes", "places").mapInArrow(run, "place long, id long")
    return places.join(found, "place")
