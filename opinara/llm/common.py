"""What the text operators share: words, row keys, hashes and scratch tables."""

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from opinara.operators.lineage import checkpoint_folder

LAST_ID = 2**63 - 1  # stands for a missing doc_id in orders: such rows come after all others
SPACES = " \t\n\x0b\x0c\r"
WORD_BREAKS = "[ \t\n\x0b\x0c\r]+"


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path in the shared folder that ``spark.checkpoint.dir`` names; the caller's to empty once results are written."""
    return f"{checkpoint_folder(spark).rstrip('/')}/opinara-{uuid.uuid4().hex}/{label}"


def scratch_table(df: DataFrame, label: str) -> DataFrame:
    """Write a step to the shared folder and go on from there."""
    spark, path = df.sparkSession, scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet")


def row_key() -> tuple[Column, Column, Column]:
    """``id`` (doc_id; a missing one sorts last), ``fp`` (hash of the text) and the text itself."""
    text = F.col("text").cast("string")
    return F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST_ID)), F.xxhash64(F.col("doc_id").isNull(), text), text


def keyed_texts(docs: DataFrame) -> DataFrame:
    """Columns ``id``, ``fp`` and ``text`` (``row_key``). ``id`` and ``fp`` together name a row; rows that repeat both are equal
    and get equal results."""
    return docs.select(*(column.alias(name) for column, name in zip(row_key(), ("id", "fp", "text"), strict=True)))


def doc_id(name: str = "id") -> Column:
    """The doc_id that ``keyed_texts`` made an ``id`` of."""
    return F.when(F.col(name) != LAST_ID, F.col(name)).alias("doc_id")


def words_of(text: str | None) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` as UTF-8; bytes.split() breaks at just these six characters."""
    return text.encode("utf-8", "surrogatepass").split() if text else []


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def mixed(values: np.ndarray) -> np.ndarray:
    """A one-to-one scramble of 64-bit numbers (the finalizer of the splitmix generator)."""
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def gram_hashes(hashes: np.ndarray, length: int) -> np.ndarray:
    """A 64-bit hash of each run of ``length`` words."""
    n = len(hashes) - length + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for j in range(length):
        out = mixed(out * np.uint64(0x9E3779B97F4A7C15) + hashes[j : n + j])
    return out


def batches(rows: Iterator[dict], schema: pa.Schema, most: int = 200_000) -> Iterator[pa.RecordBatch]:
    """Record batches of about ``most`` rows from dicts of equally long columns."""
    held: list[dict] = []
    n = 0
    for row in rows:
        held.append(row)
        n += len(next(iter(row.values())))
        if n >= most:
            yield _batch(held, schema)
            held, n = [], 0
    if held:
        yield _batch(held, schema)


def _batch(held: list[dict], schema: pa.Schema) -> pa.RecordBatch:
    columns = []
    for field in schema:
        parts = [h[field.name] for h in held]
        if isinstance(parts[0], np.ndarray):
            whole = np.concatenate(parts)
            if field.type == pa.int64() and whole.dtype == np.uint64:
                whole = whole.view(np.int64)
            columns.append(pa.array(whole, field.type))
        else:
            columns.append(pa.array([v for p in parts for v in p], field.type))
    return pa.RecordBatch.from_arrays(columns, schema=schema)


def signed(value: int) -> int:
    """An unsigned 64-bit number as the signed long with the same bits."""
    return value - (1 << 64) if value >= 1 << 63 else value
