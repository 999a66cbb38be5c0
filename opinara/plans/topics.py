"""Topic stage: terms, vectors, LDA and NMF models, topic labels and cross statistics."""

from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import inheritable_thread_target
from pyspark.ml.clustering import LDA, LDAModel
from pyspark.ml.feature import CountVectorizerModel, ElementwiseProduct, Normalizer
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from opinara import fixed_values as fixed
from opinara.functions.text import WORD, once, words
from opinara.operators.binding import bind
from opinara.operators.keys import is_unique
from opinara.operators.lineage import cut_lineage
from opinara.operators.small import small_table
from opinara.plans.topic_bound import corpus_bound

MIN_DOCUMENT_WORDS = 3
MODEL_DOCUMENTS = 20_000  # of a model's input in one partition
SEARCH_THREADS = 4
MOST_FREQUENT = 100_000  # terms that are broadcast at most
MOST_OFTEN = 100_000  # words whose pairs are counted by their place
COUNTED_AT_ONCE = 1_000  # documents whose terms are counted side by side
TINY = 1e-12


def prepare_documents(df: DataFrame, column: str = "processed_text") -> DataFrame:
    """Adds ``document``: the trimmed text, or an empty one when it has too few words."""
    text = F.trim(F.coalesce(column, F.lit("")))
    document = once(text, lambda t: F.when(F.size(words(t)) >= MIN_DOCUMENT_WORDS, t).otherwise(""))
    return bind(df.withColumn("document", document), "document")


def non_empty(documents: DataFrame) -> DataFrame:
    return documents.filter("document <> ''")


def has_enough(documents: DataFrame, n: int = fixed.MIN_TOPIC_DOCUMENTS) -> bool:
    """Whether there are ``n`` documents to model; looks at no more than that."""
    return non_empty(documents).limit(n).count() >= n


def terms(document: Column, stop_words=fixed.TOPIC_STOP_WORDS) -> Column:
    """Words of two characters or more that are no stop words, then the pairs of neighbours."""
    found = F.regexp_extract_all(F.lower(document), F.lit(f"[{WORD}]{{2,}}"), F.lit(0))
    return F.filter(found, lambda w: ~w.isin(list(stop_words)))


def with_terms(documents: DataFrame, stop_words=fixed.TOPIC_STOP_WORDS) -> DataFrame:
    single = documents.withColumn("_single", terms(F.col("document"), stop_words))
    count = F.greatest(F.size("_single") - 1, F.lit(0))
    pairs = F.zip_with(F.slice("_single", 1, count), F.slice("_single", 2, count), lambda a, b: F.concat_ws(" ", a, b))
    return single.withColumn("terms", F.concat("_single", pairs)).drop("_single")


@F.arrow_udf(ArrayType(StructType([StructField("term", StringType()), StructField("n", LongType())])))
def _counted(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """The distinct terms of each list, and how often it has them."""
    kind = pa.list_(pa.struct([("term", pa.string()), ("n", pa.int64())]))

    def count(lists: pa.Array) -> pa.Array:
        lengths = pc.list_value_length(lists).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
        coded = lists.flatten().dictionary_encode(null_encoding="encode")
        size = max(len(coded.dictionary), 1)
        found, n = np.unique(np.repeat(np.arange(len(lists)) * size, lengths) + coded.indices.to_numpy(), return_counts=True)
        entries = pa.StructArray.from_arrays([coded.dictionary.take(pa.array(found % size)).cast(pa.string()), pa.array(n)], ["term", "n"])
        ends = np.cumsum(np.bincount(found // size, minlength=len(lists)))
        return pa.ListArray.from_arrays(pa.array(np.r_[0, ends], pa.int32()), entries).cast(kind)

    for lists in parts:
        few = [count(lists.slice(at, COUNTED_AT_ONCE)) for at in range(0, len(lists), COUNTED_AT_ONCE)]
        yield pa.concat_arrays(few) if few else pa.array([], kind)


def term_counts(documents: DataFrame, key: str = "review_seq") -> DataFrame:
    """Long form: key, term and how often the document has it (n). Each row counts its own terms where it is; only where a key
    repeats the counts of its rows are added up by shuffle. Write the documents first: their keys are read before."""
    counts = documents.select(key, F.inline(_counted("terms")))
    if documents.groupBy(key).agg(F.count(F.lit(1)).alias("_rows")).filter("_rows > 1").isEmpty():
        return counts
    return counts.groupBy(key, "term").agg(F.sum("n").alias("n"))


def statistics_of(counts: DataFrame, n_docs: int) -> DataFrame:
    """Occurrences and documents of each term of ``term_counts``, and the number of documents. Sums are added up in the map tasks,
    so a term in every document is no hot key."""
    summed = counts.groupBy("term").agg(F.sum("n").alias("term_count"), F.count(F.lit(1)).alias("doc_count"))
    return summed.withColumn("n_docs", F.lit(n_docs).cast("long"))


def term_statistics(documents: DataFrame, key: str = "review_seq") -> DataFrame:
    """Occurrences and documents of each term, and the number of documents. Write the documents first: they are read twice."""
    return statistics_of(term_counts(documents, key), documents.count())


def usable_terms(statistics: DataFrame, min_docs: int = fixed.MIN_DOC_COUNT, max_share: float = fixed.MAX_DOC_SHARE) -> DataFrame:
    """The terms that are in at least ``min_docs`` and at most ``max_share`` of the documents."""
    return statistics.filter((F.col("doc_count") >= min_docs) & (F.col("doc_count") <= F.col("n_docs") * max_share))


def with_statistics(counts: DataFrame, statistics: DataFrame, most_broadcast: int = MOST_FREQUENT) -> DataFrame:
    """The rows of ``term_counts`` whose term is in ``statistics``, with its doc_count and n_docs.

    A term is frequent if more than one in ``most_broadcast`` of the rows is its own. There are fewer of those than that, so they
    are broadcast, and a term in a third of the rows is no hot key; the rows of all other terms are joined by shuffle.
    """
    bar = counts.count() // most_broadcast
    wanted = statistics.select("term", "doc_count", "n_docs")
    frequent, rare = wanted.filter(F.col("doc_count") > bar), wanted.filter(F.col("doc_count") <= bar)
    found = counts.join(F.broadcast(frequent), "term", "left")
    if bar == 0:
        return found.filter("doc_count is not null")
    others = found.filter("doc_count is null").drop("doc_count", "n_docs").join(rare, "term")
    return found.filter("doc_count is not null").unionByName(others)


def tfidf_weights(counts: DataFrame, statistics: DataFrame, key: str = "review_seq", most_broadcast: int = MOST_FREQUENT) -> DataFrame:
    """Long form of all terms, without a vocabulary on the driver: key, term and weight, the count times the smooth inverse document
    frequency, divided by the length of the document's weights. Only terms of ``statistics`` count."""
    idf = F.log((1 + F.col("n_docs")) / (1 + F.col("doc_count"))) + 1
    weighted = with_statistics(counts, statistics, most_broadcast).select(key, "term", (F.col("n") * idf).alias("weight"))
    norm = F.sqrt(F.sum(F.col("weight") * F.col("weight")).over(Window.partitionBy(key)))
    return weighted.select(key, "term", (F.col("weight") / norm).alias("weight"))


def vocabulary(statistics: DataFrame, size: int, **limits) -> DataFrame:
    """The ``size`` most frequent of the usable terms: the input of a model, which holds a matrix of that width."""
    return usable_terms(statistics, **limits).orderBy(F.desc("term_count"), "term").limit(size)


def count_vectors(documents: DataFrame, vocab: list[str]) -> DataFrame:
    """Adds ``counts``: how often each vocabulary term occurs. Works row by row."""
    model = CountVectorizerModel.from_vocabulary(vocab, inputCol="terms", outputCol="counts")
    return model.transform(documents)


def tfidf_vectors(counted: DataFrame, doc_counts: list[int], n_docs: int) -> DataFrame:
    """Adds ``tfidf``: counts times smooth inverse document frequency, of length 1. Works row by row."""
    idf = [float(np.log((1 + n_docs) / (1 + d)) + 1) for d in doc_counts]
    weighted = ElementwiseProduct(scalingVec=Vectors.dense(idf), inputCol="counts", outputCol="_weighted")
    unit = Normalizer(p=2.0, inputCol="_weighted", outputCol="tfidf")
    return unit.transform(weighted.transform(counted)).drop("_weighted")


def _partial_sums(row: np.ndarray, code: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct codes below ``width``, how often each occurs, and in how many rows."""
    found, n = np.unique(row * width + code, return_counts=True)
    codes, at = np.unique(found % width, return_inverse=True)
    return codes, np.bincount(at, n, len(codes)).astype(np.int64), np.bincount(at, minlength=len(codes))


def _summed(documents: DataFrame, often: pa.Array | None, n_docs: int) -> DataFrame:
    """Occurrences and documents of the words of a list column ``words``, or of the pairs of neighbours that are both in ``often``.
    Every batch adds up its own documents before Spark does."""
    shared = documents.sparkSession.sparkContext.broadcast(often)

    def sums(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        often = shared.value
        for part in parts:
            lists = part.column("words")
            row = np.repeat(np.arange(len(lists)), lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
            words = lists.flatten()
            if often is None:
                coded = words.dictionary_encode()
                codes, n, docs = _partial_sums(row, coded.indices.to_numpy().astype(np.int64), max(len(coded.dictionary), 1))
                found = coded.dictionary.take(pa.array(codes))
            else:
                place = pc.index_in(words, value_set=often).fill_null(-1).to_numpy().astype(np.int64)
                both = np.flatnonzero((row[:-1] == row[1:]) & (place[:-1] >= 0) & (place[1:] >= 0))
                codes, n, docs = _partial_sums(row[both], place[both] * len(often) + place[both + 1], len(often) ** 2)
                first, second = (often.take(pa.array(at)) for at in (codes // len(often), codes % len(often)))
                found = pc.binary_join_element_wise(first, second, " ")
            yield pa.RecordBatch.from_arrays([found.cast(pa.string()), pa.array(n), pa.array(docs)], names=["term", "term_count", "doc_count"])

    parts = documents.select("words").mapInArrow(sums, "term string, term_count long, doc_count long")
    summed = parts.groupBy("term").agg(F.sum("term_count").alias("term_count"), F.sum("doc_count").alias("doc_count"))
    return summed.withColumn("n_docs", F.lit(n_docs).cast("long"))


def learnt_vocabulary(
    documents: DataFrame, size: int, key: str = "review_seq", most_often: int = MOST_OFTEN, **limits
) -> DataFrame:
    """``vocabulary`` of the terms of documents, without counting the pairs that can't be in it.

    A pair occurs no more often than either of its words. So only pairs are counted whose words both occur as often as the last
    of the ``size`` most frequent usable words. With fewer such words, with more than ``most_often`` words that occur as often,
    or where a key repeats, all terms are counted. Write the documents first: they are read several times.
    """
    words = documents.select(key, terms(F.col("document")).alias("words"))
    if is_unique(documents, key):
        n_docs = documents.count()
        of_words = cut_lineage(_summed(words, None, n_docs))
        first = vocabulary(of_words, size, **limits).agg(F.count(F.lit(1)).alias("n"), F.min("term_count").alias("least")).head()
        if first.n == size:
            often = of_words.filter(F.col("term_count") >= first.least).select("term").limit(most_often + 1).toArrow()["term"].combine_chunks()
            if len(often) <= most_often:
                return vocabulary(of_words.unionByName(_summed(words, often, n_docs)), size, **limits)
    return vocabulary(term_statistics(with_terms(documents), key), size, **limits)


def vectorize(documents: DataFrame, size: int, key: str = "review_seq", **limits) -> tuple[DataFrame, list[str]]:
    """Documents with ``counts`` and ``tfidf`` for a model, and its vocabulary (at most ``size`` terms on the driver).
    The vocabulary is learnt from the documents that are not empty; all of them get vectors."""
    listed = with_terms(documents)
    rows = learnt_vocabulary(non_empty(documents), size, key, **limits).collect()
    vocab = [r.term for r in rows]
    if not vocab:
        raise ValueError("no term is frequent enough")
    return tfidf_vectors(count_vectors(listed, vocab), [r.doc_count for r in rows], rows[0].n_docs), vocab


def named_terms(spark: SparkSession, vocab: list[str]) -> DataFrame:
    """index and term of a model's vocabulary."""
    return F.broadcast(small_table(spark, list(enumerate(vocab)), "index int, term string"))


def vector_entries(df: DataFrame, key: str, vector: str, vocab: list[str]) -> DataFrame:
    """Long form of a sparse vector column: key, term, weight."""
    inner = F.unwrap_udt(vector)
    entry = F.inline(F.arrays_zip(inner["indices"].alias("index"), inner["values"].alias("weight")))
    return df.select(key, entry).join(named_terms(df.sparkSession, vocab), "index").select(key, "term", "weight")


# ---------------------------------------------------------------- LDA


def model_input(vectors: DataFrame, key: str = "review_seq", partitions: int | None = None) -> DataFrame:
    """Count vectors of the non-empty documents, written once: every fit reads them many times.

    Models draw and sum by partition, so documents are dealt by the hash of their key over a number of partitions that depends on
    their number alone, and sorted inside: the same topics come out however the input was split and on any number of cores.
    """
    given = cut_lineage(non_empty(vectors).select(key, "counts"))
    partitions = partitions or max(8, given.count() // MODEL_DOCUMENTS)
    dealt = given.repartition(partitions, key).sortWithinPartitions(key)
    return cut_lineage(dealt.select("counts"))


def fit_lda(
    counted: DataFrame,
    k: int = fixed.TOPIC_COUNT,
    iterations: int = 20,
    doc_prior: float | None = 0.1,
    word_prior: float | None = 0.01,
    seed: int = fixed.TOPIC_SEED,
) -> LDAModel:
    """Batch variational LDA: every iteration reads all documents and puts the new topics in place of the old, which is the
    online step with a weight of one (a decay next to nothing). A prior of None is 1/k."""
    lda = LDA(
        k=k, maxIter=iterations, optimizer="online", subsamplingRate=1.0, learningDecay=1e-9, learningOffset=1.0, seed=seed,
        optimizeDocConcentration=False, featuresCol="counts", docConcentration=[doc_prior or 1.0 / k],
        topicConcentration=word_prior or 1.0 / k,
    )
    return lda.fit(counted)


def perplexity(model: LDAModel, counted: DataFrame, word_prior: float | None = 0.01) -> float:
    """The perplexity from the variational bound of all documents (``topic_bound``). ``word_prior`` as in ``fit_lda``."""
    topics = model.topicsMatrix().toArray()
    prior = model.estimatedDocConcentration().toArray()
    return corpus_bound(counted, topics, prior, word_prior or 1.0 / topics.shape[1]).head().perplexity


def topic_count_search(
    counted: DataFrame, max_topics: int = fixed.MAX_TOPIC_COUNT, iterations: int = 10, at_once: int = SEARCH_THREADS
) -> DataFrame:
    """Perplexity for each number of topics from 2. Each fit is a distributed job from a start of its own, derived from its k; one
    row comes back.

    ``at_once`` fits run side by side from threads of the driver, all over the one written input: while one waits for its last
    tasks or for the driver, the others use the cores. With ``spark.scheduler.mode`` FAIR they share them evenly.
    """
    spark = counted.sparkSession

    def figure(k: int) -> tuple[int, float]:
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", f"topics-{k}")
        model = fit_lda(counted, k, iterations, doc_prior=None, word_prior=None, seed=fixed.TOPIC_SEED + k)
        return k, perplexity(model, counted, None)

    with ThreadPoolExecutor(at_once) as pool:
        waiting = [pool.submit(inheritable_thread_target(spark)(figure), k) for k in range(max_topics, 1, -1)]  # the longest first
        rows = sorted(w.result() for w in waiting)
    return small_table(spark, rows, "k int, perplexity double")


def elbow(perplexities: DataFrame, published_offset: bool = True) -> DataFrame:
    """The number of topics where perplexity bends most (first of equals), as one row.

    The published rule is off by one: it picks the k after the bend. ``published_offset=False``
    gives the bend itself. Without a second difference the default number is used.
    """
    by_k = Window.orderBy("k")  # one row per k
    bend = F.lag("perplexity").over(by_k) - 2 * F.col("perplexity") + F.lead("perplexity").over(by_k)
    picked = F.lead("k").over(by_k) if published_offset else F.col("k")
    bends = perplexities.select("k", bend.alias("bend"), picked.alias("picked")).filter("bend is not null")
    best = F.min_by("picked", F.struct(-F.col("bend"), "k"))
    return bends.agg(F.coalesce(best, F.lit(fixed.TOPIC_COUNT)).cast("int").alias("optimal_topics"))


def topic_words(model: LDAModel, vocab: list[str], n: int = 10) -> DataFrame:
    """Top words of each topic: topic_id, word_rank (from 1), word, weight."""
    top = model.describeTopics(n)
    listed = top.select("topic", F.posexplode(F.arrays_zip("termIndices", "termWeights")).alias("at", "entry"))
    listed = listed.select(
        F.col("topic").alias("topic_id"),
        (F.col("at") + 1).alias("word_rank"),
        F.col("entry.termIndices").alias("index"),
        F.col("entry.termWeights").alias("weight"),
    )
    return listed.join(named_terms(top.sparkSession, vocab), "index").select("topic_id", "word_rank", F.col("term").alias("word"), "weight")


def wordcloud_weights(model: LDAModel, vocab: list[str], n: int = 50) -> DataFrame:
    """Term weights for a word cloud per topic; topics with fewer than three words are left out."""
    listed = topic_words(model, vocab, n)
    count = F.count(F.lit(1)).over(Window.partitionBy("topic_id"))
    return listed.withColumn("_n", count).filter("_n >= 3").drop("_n")


def label_topics(topic_word_rows: DataFrame, themes: DataFrame, min_overlap: int = 2) -> DataFrame:
    """Theme that shares most words with each topic, the first theme among equals. With too small an
    overlap the label is made of the two top words. Both inputs are a few hundred rows."""
    named = topic_word_rows.groupBy("topic_id").agg(
        F.sort_array(F.collect_list(F.struct("word_rank", "word"))).alias("_words")
    )
    distinct_words = topic_word_rows.select("topic_id", "word").distinct()
    shared = distinct_words.join(themes, F.col("word") == F.col("keyword"))
    overlaps = shared.groupBy("topic_id", "theme_rank", "theme").agg(F.countDistinct("word").alias("overlap"))
    best = overlaps.groupBy("topic_id").agg(
        F.min_by(F.struct("theme", "overlap"), F.struct(-F.col("overlap"), "theme_rank")).alias("_best")
    )
    fallback = F.concat(F.lit("theme_"), F.array_join(F.slice("_words.word", 1, 2), " "))
    label = F.when(F.col("_best.overlap") >= min_overlap, F.col("_best.theme")).otherwise(fallback)
    return named.join(best, "topic_id", "left").select("topic_id", label.alias("topic_label"))


def assign_topics(distributions: DataFrame, vector: str = "topicDistribution", threshold: float = fixed.TOPIC_THRESHOLD):
    """Adds the most likely topic and its probability. Below the threshold the topic is uncertain;
    a document without any term gets an even distribution."""
    parts = distributions.withColumn("_p", vector_to_array(vector))
    top = F.array_max("_p")
    known = parts.withColumn("topic_probability", F.when(top > 0, top).otherwise(F.lit(1.0) / F.size("_p")))
    place = F.when(top > 0, F.array_position("_p", top) - 1).otherwise(0)
    topic = F.when(F.col("topic_probability") >= threshold, place).otherwise(fixed.UNCERTAIN_TOPIC)
    return known.withColumn("topic_id", topic.cast("int")).drop("_p", vector)


def add_topic_labels(assigned: DataFrame, labels: DataFrame) -> DataFrame:
    """Label of the topic; an uncertain topic has none. ``labels`` has one row per topic."""
    return assigned.join(F.broadcast(labels), "topic_id", "left")


def topics_by_sentiment(df: DataFrame) -> DataFrame:
    """Per certain topic: reviews, count of each label, mean score and mean rating."""
    certain = df.filter(F.col("topic_id") != fixed.UNCERTAIN_TOPIC)
    return certain.groupBy("topic_id").agg(
        F.count(F.lit(1)).alias("total_reviews"),
        *[F.count_if(F.col("sentiment_label") == name).alias(f"{name}_reviews") for name in fixed.LABELS],
        F.avg("ensemble_score").alias("avg_sentiment_score"),
        F.avg("rating").alias("avg_rating"),
    )


def topics_by_bank(df: DataFrame, n: int = 3) -> DataFrame:
    """The main topics of each bank with their counts, uncertain ones included; ties by topic number."""
    counts = df.groupBy("bank_name", "topic_id").agg(F.count(F.lit(1)).alias("n"))
    by_bank = Window.partitionBy("bank_name")
    ranked = counts.withColumns(
        {
            "total_reviews": F.sum("n").over(by_bank),
            "topic_rank": F.row_number().over(by_bank.orderBy(F.desc("n"), "topic_id")),
        }
    )
    return ranked.filter(F.col("topic_rank") <= n)


def report_lines(words_of_topics: DataFrame, labels: DataFrame, n_topics: int, n_documents: int, value: float) -> DataFrame:
    """The lines of the topic report: line_no, value."""
    spark = words_of_topics.sparkSession
    listed = words_of_topics.groupBy("topic_id").agg(F.sort_array(F.collect_list(F.struct("word_rank", "word"))).alias("w"))
    topic_lines = listed.join(F.broadcast(labels), "topic_id").select(
        (F.col("topic_id") + 4).cast("long").alias("line_no"),
        F.format_string("Topic %d (%s): %s", "topic_id", "topic_label", F.array_join("w.word", ", ")).alias("value"),
    )
    head = ["=== STATISTIQUES TOPIC MODELING ===", "", "Mots principaux par topic:"]
    tail = ["", "Informations modèle:", f"Nombre de topics: {n_topics}", f"Documents analysés: {n_documents}",
            f"Perplexité: {value:.2f}"]
    numbered = chain(enumerate(head, 1), enumerate(tail, 4 + n_topics))
    return small_table(spark, list(numbered), "line_no long, value string").unionByName(topic_lines)


def model_topics(
    df: DataFrame,
    themes: DataFrame,
    n_topics: int | None = None,
    column: str = "processed_text",
    key: str = "review_seq",
    vocabulary_size: int = fixed.VOCABULARY_SIZE,
    **limits,
):
    """The whole stage: reviews with topic columns, the top words and the labels, and the model figures.
    Too few documents give topic columns without values, and None."""
    documents = prepare_documents(df, column)
    if not has_enough(documents):
        kinds = {"topic_id": "int", "topic_probability": "double", "topic_label": "string"}
        return df.withColumns({name: F.lit(None).cast(kind) for name, kind in kinds.items()}), None
    vectors, vocab = vectorize(documents, vocabulary_size, key, **limits)
    counted = model_input(vectors, key)
    k = n_topics or elbow(topic_count_search(counted)).head().optimal_topics
    model = fit_lda(counted, k)
    found = topic_words(model, vocab)
    labels = label_topics(found, themes)
    assigned = assign_topics(model.transform(vectors))
    out = add_topic_labels(assigned, labels).drop("document", "terms", "counts", "tfidf")
    figures = {"n_topics": k, "n_documents": counted.count(), "perplexity": perplexity(model, counted)}
    return out, {"words": found, "labels": labels, "model": figures}


# ---------------------------------------------------------------- NMF


class _Rows:
    """Sparse rows of a batch as flat index and value arrays."""

    def __init__(self, batch: pd.DataFrame):
        sizes = batch["indices"].map(len).to_numpy(np.int64)
        self.n = len(sizes)
        self.row = np.repeat(np.arange(self.n), sizes)
        self.index = np.concatenate([np.zeros(0, np.int64), *batch["indices"]]).astype(np.int64)
        self.value = np.concatenate([np.zeros(0), *batch["values"]])

    def times(self, h: np.ndarray) -> np.ndarray:
        """rows @ h.T"""
        out = np.zeros((self.n, h.shape[0]))
        np.add.at(out, self.row, self.value[:, None] * h.T[self.index])
        return out

    def summed(self, w: np.ndarray, size: int) -> np.ndarray:
        """w.T @ rows"""
        out = np.zeros((size, w.shape[1]))
        np.add.at(out, self.index, self.value[:, None] * w[self.row])
        return out.T


def _document_weights(target: np.ndarray, gram: np.ndarray, start: float, rounds: int, l1: float, l2: float) -> np.ndarray:
    """Non-negative weights of documents for fixed topics, by multiplicative updates."""
    w = np.full(target.shape, start)
    for _ in range(rounds):
        w *= target / np.maximum(w @ gram + l1 + l2 * w, TINY)
    return w


def fit_nmf(
    vectors: DataFrame, size: int, k: int = fixed.TOPIC_COUNT, iterations: int = 200, alpha: float = 0.1,
    l1_ratio: float = 0.5, rounds: int = 30, seed: int = fixed.TOPIC_SEED, tolerance: float = 1e-4,
    vector: str = "tfidf",
) -> tuple[np.ndarray, DataFrame]:
    """Topics by penalised non-negative factorisation, and the objective per iteration.

    The topics are a small k × ``size`` matrix. In each iteration every task works out the weights
    of its documents and returns three sums of that size, which Spark adds up: the weights are
    never stored or shuffled, and the plan does not grow with the iterations. There are no more
    than two tasks per core, so that the sums to add up stay few.
    """
    l1, l2 = alpha * l1_ratio, alpha * (1 - l1_ratio)
    spark = vectors.sparkSession
    inner = F.unwrap_udt(vector)
    entries = cut_lineage(vectors.select(inner["indices"].alias("indices"), inner["values"].alias("values")))
    entries = entries.coalesce(2 * spark.sparkContext.defaultParallelism)
    total = F.aggregate("values", F.lit(0.0), lambda acc, x: acc + x)
    whole = entries.agg(F.sum(total).alias("sum"), F.count(F.lit(1)).alias("n")).head()
    start = float(np.sqrt(max((whole["sum"] or 0.0) / max(whole.n * size, 1), TINY) / k))  # the same for all documents
    h = np.random.default_rng(seed).random((k, size)) + 1e-3
    objectives: list[tuple[int, float]] = []
    for step in range(iterations):
        shared = spark.sparkContext.broadcast(h)

        def partial_sums(batches, shared=shared):
            topics = shared.value
            numerator, gram, loss = np.zeros_like(topics), np.zeros((k, k)), 0.0
            of_topics = topics @ topics.T
            for batch in batches:
                rows = _Rows(batch)
                target = rows.times(topics)
                w = _document_weights(target, of_topics, start, rounds, l1, l2)
                numerator += rows.summed(w, size)
                gram += w.T @ w
                rest = (rows.value**2).sum() - 2 * (w * target).sum() + ((w @ of_topics) * w).sum()
                loss += 0.5 * rest + l1 * w.sum() + 0.5 * l2 * (w**2).sum()
            flat = np.concatenate([numerator.ravel(), gram.ravel(), [loss]])
            yield pd.DataFrame({"at": np.arange(flat.size), "part": flat})

        sums = entries.mapInPandas(partial_sums, "at long, part double").groupBy("at").agg(F.sum("part").alias("total"))
        flat = sums.orderBy("at").toPandas()["total"].to_numpy()
        numerator, gram = flat[: k * size].reshape(k, size), flat[k * size : -1].reshape(k, k)
        objectives.append((step, float(flat[-1] + l1 * h.sum() + 0.5 * l2 * (h**2).sum())))
        shared.unpersist()
        if step and objectives[-2][1] - objectives[-1][1] <= tolerance * objectives[0][1]:
            break
        h = h * numerator / np.maximum(gram @ h + l1 + l2 * h, TINY)
    return h, small_table(spark, objectives, "iteration int, objective double")


def factor_words(spark, h: np.ndarray, vocab: list[str], n: int = 10) -> DataFrame:
    """Top words of factorised topics: topic_id, word_rank, word, weight."""
    rows = [
        (topic, rank, vocab[at], float(weights[at]))
        for topic, weights in enumerate(h)
        for rank, at in enumerate(np.argsort(-weights, kind="stable")[:n], 1)
    ]
    return small_table(spark, rows, "topic_id int, word_rank int, word string, weight double")
