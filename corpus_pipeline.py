"""A corpus run in stages: each takes documents and returns those it keeps, and the last one the token file's documents.

Language identification drops documents in none of the languages, the Jaccard join keeps one document of each group, decontamination
drops documents that hold a benchmark item, mixing repeats or drops documents to meet the target of each source, and the rest is
written as token ids. Every stage works on all rows that the one before has kept.
"""

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opinara.llm import decontaminate, jaccard_join, language_id, mixing, token_file
from opinara.llm.common import scratch_path

TOKENIZER = "byte_bpe_50k.json"


def identify_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the languages that the labelled ones teach. Those without a letter go, and those whose shortest code
    takes more bits per byte than texts of its language do. Statistics and limits come from all labelled texts."""
    counts = language_id.gram_counts(docs)
    allowed = language_id.limits(docs, counts)  # its models go before the next is made
    return language_id.fitting(docs, language_id.train(docs, counts), allowed)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that Jaccard links connect: the one with the smallest doc_id."""
    return jaccard_join.one_of_each(docs)


def drop_benchmark_items(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.clean_rows(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it, up to three times."""
    return mixing.copies(docs)


def write_token_file(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document of the mix, read back from the token file."""
    path = scratch_path(spark, "tokens")
    token_file.write_tokens(docs, path, public_tokenizers.path(TOKENIZER), end_id=0)
    return token_file.read_documents(spark, path)


STAGES = [
    ("language ID", identify_languages),
    ("n-gram Jaccard join", drop_near_copies),
    ("benchmark decontamination", drop_benchmark_items),
    ("mixing sources to target weights", mix_sources),
    ("token-ID output", write_token_file),
]

ORACLE_SQL = None  # models, Newton steps and tokens have no SQL; tests hold the stages against brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            path = scratch_path(spark, f"stage-{number}")
            docs.write.parquet(path)
            docs = spark.read.parquet(path)
    return docs
