"""Token counts with a whole-token shortcut.

Which strings of the vocabulary come out as one token when they stand alone is proved once, by encoding each of them: that it
is in the vocabulary isn't enough, as the merges may lead elsewhere. A pre-token among the proven strings counts one; only the
rest goes through the merges of the library. Counts are remembered per unit (``unit_store``), in bounded memory.
"""

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opinara.llm import pretokens
from opinara.llm.unit_store import WHOLE, Store, Units, pieces, pre_token_units, sums, text_of

LIMIT = 1024
MOST_UNITS = 1_000_000  # units that a task remembers


def byte_letters() -> dict[str, int]:
    """The letter that byte-level vocabularies write for each byte: printable bytes as they are, others from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + n): b for n, b in enumerate(hidden)}


def proven_strings(path: str) -> frozenset[str]:
    """The strings of the vocabulary that encode alone as one token. Bounded by the vocabulary."""
    tokenizer, letters = pretokens.load(path), byte_letters()
    strings = []
    for entry in tokenizer.get_vocab(with_added_tokens=False):
        try:
            strings.append(bytes(letters[c] for c in entry).decode("utf-8"))
        except (KeyError, UnicodeDecodeError):  # part of a character, or not a byte-level string
            continue
    found = tokenizer.encode_batch(strings, add_special_tokens=False)
    return frozenset(s for s, e in zip(strings, found, strict=True) if len(e.ids) == 1)


class Counter:
    def __init__(self, path: str, proven: frozenset[str]):
        self.proven, self.model = proven, None
        if path.endswith(".model"):
            import sentencepiece

            self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        else:
            self.library = pretokens.Library(path)
            kept = [*pretokens.added_strings(path), pretokens.UNSETTLED]
            self.units = Units(kept, spaced=False, cut=pretokens.cuts_like_byte_bpe(path), uneven=pre_token_units)
            self.store = Store(lambda units: (np.ones(len(units), np.int64), self.of_units(units)), np.int64, most=MOST_UNITS)

    def counts(self, texts: pa.Array) -> np.ndarray:
        texts = pc.fill_null(texts, "")
        if self.model is not None:
            return np.array([len(ids) for ids in self.model.encode(texts.to_pylist(), num_threads=1)], np.int64)
        numbers, units, counts = self.units.cut(texts)
        return sums(self.store.gathered(self.store.places(units))[numbers], counts)

    def of_units(self, units: list[str]) -> np.ndarray:
        counts, rest, owner = np.zeros(len(units), np.int64), [], []
        for n, unit in enumerate(units):
            if unit[0] == WHOLE:
                parts = open_ = [unit[1:]]  # a text with a string that must not be cut
            else:
                text = text_of(unit)
                parts = pretokens.PRE_TOKEN.findall(text) if pretokens.SETTLED.fullmatch(text) else [text]
                open_ = [p for p in parts if p not in self.proven]
            counts[n] = len(parts) - len(open_)
            rest += open_
            owner += [n] * len(open_)
        found = self.library.ids_of_units(rest)
        return counts + np.bincount(owner, np.fromiter(map(len, found), np.int64, len(found)) // 4, len(units)).astype(np.int64)


@functools.lru_cache(maxsize=2)
def counter_of(path: str, proven: frozenset[str]) -> Counter:
    """One per Python worker, so that tasks share what it remembers."""
    return Counter(path, proven)


def token_count(spark, text: str, path: str) -> Column:
    """Tokens of a text column as the library gives them, without begin, end or other added tokens. Null counts as empty."""
    proven = spark.sparkContext.broadcast(frozenset() if path.endswith(".model") else proven_strings(path))

    @F.arrow_udf("long")
    def count(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        counter = counter_of(path, proven.value)
        for part in parts:
            few = [counter.counts(p.column("text")) for p in pieces(pa.RecordBatch.from_arrays([part], names=["text"]))]
            yield pa.array(np.concatenate(few) if few else [], pa.int64())

    return count(F.col(text).cast("string"))


def count_tokens(docs: DataFrame, path: str, limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes (UTF-8), n_tokens and over_limit of every row of a table with doc_id and text.

    Null and empty texts have no bytes and no tokens. Texts are neither cut nor padded; rows may repeat. Other columns are
    ignored. ``path`` is a .json file of the tokenizers library or a .model file of sentencepiece, on every executor.
    """
    text = F.col("text").cast("string")
    counted = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.octet_length(text), F.lit(0)).cast("long").alias("n_bytes"),
        token_count(docs.sparkSession, "text", path).alias("n_tokens"),
    )
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
