import math
from pathlib import Path

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from opinara import fixed_values as fixed
from opinara.operators.lineage import checkpoint_folder
from opinara.operators.small import small_table
from opinara.plans import topic_bound, topics
from opinara.registry.topics import documents
from opinara.sources.seeds import themes


@pytest.mark.parametrize(
    ("bend_at", "published", "expected"),
    [(3, True, 4), (3, False, 3), (8, True, 9), (8, False, 8), (14, True, 15), (14, False, 14)],
)
def test_elbow(spark, bend_at, published, expected):
    # A curve that falls steeply up to the bend and slowly after it.
    curve = [(k, 1000.0 - 50 * min(k, bend_at) - 0.1 * max(k - bend_at, 0)) for k in range(2, 16)]
    df = small_table(spark, curve, "k int, perplexity double")
    assert topics.elbow(df, published).head().optimal_topics == expected


def test_elbow_of_a_short_curve_is_the_default(spark):
    df = small_table(spark, [(2, 5.0), (3, 4.0)], "k int, perplexity double")
    assert topics.elbow(df).head().optimal_topics == fixed.TOPIC_COUNT


def test_topic_labels(spark):
    words = {
        0: ["accueil", "personnel", "frais"], 1: ["frais", "accueil", "vide"], 2: ["a", "b", "c"],
        3: ["attente", "queue", "frais", "tarif"], 4: ["agence", "bureau", "service"],
    }
    rows = [(t, n, w) for t, ws in words.items() for n, w in enumerate(ws, 1)]
    found = topics.label_topics(small_table(spark, rows, "topic_id int, word_rank int, word string"), themes(spark))
    assert {r.topic_id: r.topic_label for r in found.collect()} == {
        0: "service_client", 1: "theme_frais accueil", 2: "theme_a b", 3: "attente_temps", 4: "localisation_agence",
    }


def test_assignment(spark):
    vectors = [[0.3, 0.7, 0.0, 0.0], [0.25, 0.25, 0.25, 0.25], [0.0] * 4, [0.3, 0.25, 0.25, 0.2]]
    df = spark.createDataFrame([(n, Vectors.dense(v)) for n, v in enumerate(vectors)], ["n", "topicDistribution"])
    rows = topics.assign_topics(df).orderBy("n").collect()
    assert [(r.topic_id, r.topic_probability) for r in rows] == [(1, 0.7), (-1, 0.25), (-1, 0.25), (0, 0.3)]
    labels = small_table(spark, [(0, "x"), (1, "y")], "topic_id int, topic_label string")
    named = topics.add_topic_labels(topics.assign_topics(df), labels).orderBy("n").collect()
    assert [r.topic_label for r in named] == ["y", None, None, "x"]


def test_terms_and_vectors(spark):
    rows = [(1, "compte client bon bon"), (2, "compte bon frais"), (3, "frais compte a"), (4, "un deux"), (5, None)]
    df = spark.createDataFrame(rows, "review_seq long, processed_text string")
    docs = topics.prepare_documents(df)
    assert [r.document for r in docs.orderBy("review_seq").collect()] == [r[1] for r in rows[:3]] + ["", ""]
    listed = topics.with_terms(docs).orderBy("review_seq").collect()
    assert listed[0].terms == ["compte", "bon", "bon", "compte bon", "bon bon"]
    assert listed[2].terms == ["frais", "compte", "frais compte"] and listed[3].terms == []
    vectors, vocab = topics.vectorize(docs, size=1000, max_share=1.0)
    assert vocab == ["bon", "compte", "compte bon", "frais"]
    found = {(r.review_seq, r.term): r.weight for r in topics.vector_entries(vectors, "review_seq", "counts", vocab).collect()}
    assert found[(1, "bon")] == 2 and (3, "bon") not in found
    idf = {t: math.log(4 / (1 + n)) + 1 for t, n in {"bon": 2, "compte": 3, "frais": 2, "compte bon": 2}.items()}
    norm = math.sqrt((2 * idf["bon"]) ** 2 + idf["compte"] ** 2 + idf["compte bon"] ** 2)
    weights = {(r.review_seq, r.term): r.weight for r in topics.vector_entries(vectors, "review_seq", "tfidf", vocab).collect()}
    assert weights[(1, "bon")] == pytest.approx(2 * idf["bon"] / norm)
    assert not topics.has_enough(docs)
    few, nothing = topics.model_topics(df, themes(spark))
    assert nothing is None and few.columns == [*df.columns, "topic_id", "topic_probability", "topic_label"]
    assert few.filter("topic_id is null and topic_label is null").count() == 5
    shares = {r.term: (r.term_count, r.doc_count, r.n_docs) for r in topics.term_statistics(topics.with_terms(topics.non_empty(docs))).collect()}
    assert shares["bon"] == (3, 2, 3) and shares["bon bon"] == (1, 1, 3) and shares["compte"] == (3, 3, 3)


@pytest.fixture(scope="module")
def fitted(spark, folder):
    vectors, vocab = topics.vectorize(documents(spark, folder), size=1000)
    counted = topics.model_input(vectors)
    return vectors, vocab, counted, topics.fit_lda(counted, 4, 5)


def test_lda(spark, fitted):
    vectors, vocab, counted, model = fitted
    again = topics.fit_lda(counted, 4, 5)
    first = topics.topic_words(model, vocab).orderBy("topic_id", "word_rank").collect()
    assert first == topics.topic_words(again, vocab).orderBy("topic_id", "word_rank").collect() and len(first) == 40
    assert math.isfinite(topics.perplexity(model, counted)) and topics.perplexity(model, counted) > 1
    shares = model.transform(vectors).select(F.aggregate(topics.vector_to_array("topicDistribution"), F.lit(0.0), lambda a, x: a + x).alias("s"))
    assert all(abs(r.s - 1) < 1e-6 or r.s == 0 for r in shares.collect())
    assigned = topics.assign_topics(model.transform(vectors))
    assert assigned.filter("topic_id >= 0 and topic_probability < 0.3").count() == 0
    assert assigned.filter("topic_id < 0 and topic_probability >= 0.3").count() == 0
    assert topics.wordcloud_weights(model, vocab).filter("word_rank > 50").count() == 0


def _bound_by_loops(counts, topics, prior):
    """The bound of one document (term: count), one number at a time."""
    terms, k = topics.shape
    total = topics.sum(0)
    psi = lambda x: float(topic_bound.digamma(np.array(x)))
    log_words = {t: [psi(topics[t, j]) - psi(total[j]) for j in range(k)] for t in counts}
    gamma = [prior[j] + sum(counts.values()) / k for j in range(k)]
    for _ in range(2000):
        logs = [psi(g) - psi(sum(gamma)) for g in gamma]
        raised = list(prior)
        for t, n in counts.items():
            parts = [math.exp(logs[j] + log_words[t][j]) for j in range(k)]
            raised = [raised[j] + n * parts[j] / sum(parts) for j in range(k)]
        change = sum(abs(a - b) for a, b in zip(raised, gamma, strict=True)) / k
        gamma = raised
        if change < 1e-9:
            break
    logs = [psi(g) - psi(sum(gamma)) for g in gamma]
    bound = sum(n * math.log(sum(math.exp(logs[j] + log_words[t][j]) for j in range(k))) for t, n in counts.items())
    bound += sum((prior[j] - gamma[j]) * logs[j] + math.lgamma(gamma[j]) - math.lgamma(prior[j]) for j in range(k))
    return bound + math.lgamma(sum(prior)) - math.lgamma(sum(gamma))


def test_bound_by_loops(spark, fitted):
    vectors, vocab, _, model = fitted
    topic_matrix, prior = model.topicsMatrix().toArray(), model.estimatedDocConcentration().toArray()
    rows = {r.review_seq: r for r in topic_bound.bounds(vectors, topic_matrix, prior, keep=("review_seq",)).collect()}
    given = {r.review_seq: r.counts for r in vectors.select("review_seq", "counts").collect()}
    assert set(rows) == set(given)
    for n in sorted(given)[:12]:
        counts = dict(zip(given[n].indices.tolist(), given[n].values.tolist(), strict=True))
        wanted = _bound_by_loops(counts, topic_matrix, prior) if counts else 0.0
        assert rows[n].bound == pytest.approx(wanted, rel=1e-6, abs=1e-9) and rows[n].tokens == sum(counts.values())


def test_bound_is_the_published_figure(spark, fitted):
    _, vocab, counted, model = fitted
    row = topic_bound.corpus_bound(counted, model.topicsMatrix().toArray(), model.estimatedDocConcentration().toArray(), 0.01).head()
    assert row.bound == pytest.approx(model.logLikelihood(counted), rel=1e-5)
    assert row.perplexity == pytest.approx(math.exp(model.logPerplexity(counted)), rel=1e-4)
    again = topic_bound.corpus_bound(counted.repartition(3), model.topicsMatrix().toArray(), model.estimatedDocConcentration().toArray(), 0.01)
    assert again.head().bound == pytest.approx(row.bound, rel=1e-12)


def test_search_side_by_side(spark, fitted):
    counted = fitted[2]
    one_by_one = topics.topic_count_search(counted, 5, 3, at_once=1).collect()
    assert topics.topic_count_search(counted, 5, 3, at_once=4).collect() == one_by_one
    assert [r.k for r in one_by_one] == [2, 3, 4, 5] and all(r.perplexity > 1 for r in one_by_one)


def test_terms_are_counted_where_they_are(spark, monkeypatch):
    monkeypatch.setattr(topics, "COUNTED_AT_ONCE", 2)
    rows = [(1, ["b", "a", "b", "a b"]), (2, []), (3, None), (4, ["é", "b", "é"]), (5, ["a"])]
    given = spark.createDataFrame(rows, "review_seq long, terms array<string>").coalesce(1)
    found = topics.term_counts(given)
    once = {(1, "b"): 2, (1, "a"): 1, (1, "a b"): 1, (4, "é"): 2, (4, "b"): 1, (5, "a"): 1}
    assert {(r.review_seq, r.term): r.n for r in found.collect()} == once
    assert "Exchange" not in str(found._jdf.queryExecution().executedPlan())
    more = spark.createDataFrame([(1, ["b", "c"]), (None, ["a"]), (None, ["a", "b"])], given.schema)
    added = topics.term_counts(given.unionByName(more)).collect()
    assert len(added) == 9
    assert {(r.review_seq, r.term): r.n for r in added} == once | {(1, "b"): 3, (1, "c"): 1, (None, "a"): 2, (None, "b"): 1}


@pytest.mark.parametrize("most_broadcast", [1, 3, topics.MOST_FREQUENT])
def test_weights_of_all_terms(spark, most_broadcast):
    rows = [(1, "compte client bon bon"), (2, "compte bon frais"), (3, "frais compte a"), (4, "un deux"), (5, None)]
    docs = topics.with_terms(topics.non_empty(topics.prepare_documents(spark.createDataFrame(rows, "review_seq long, processed_text string"))))
    counts = topics.term_counts(docs)
    assert {(r.review_seq, r.term): r.n for r in counts.collect()}[(1, "bon")] == 2
    usable = topics.usable_terms(topics.statistics_of(counts, docs.count()), max_share=1.0)
    weights = {(r.review_seq, r.term): r.weight for r in topics.tfidf_weights(counts, usable, most_broadcast=most_broadcast).collect()}
    idf = {t: math.log(4 / (1 + n)) + 1 for t, n in {"bon": 2, "compte": 3, "frais": 2, "compte bon": 2}.items()}
    norm = math.sqrt((2 * idf["bon"]) ** 2 + idf["compte"] ** 2 + idf["compte bon"] ** 2)
    assert weights[(1, "bon")] == pytest.approx(2 * idf["bon"] / norm)
    assert set(weights) == {(1, "bon"), (1, "compte"), (1, "compte bon"), (2, "bon"), (2, "compte"), (2, "compte bon"), (2, "frais"),
                            (3, "frais"), (3, "compte")}


def test_lda_on_other_partitions(spark, fitted):
    vectors, _, _, model = fitted
    for n in (1, 8):
        again = topics.fit_lda(topics.model_input(vectors.repartition(n)), 4, 5)
        assert np.allclose(again.topicsMatrix().toArray(), model.topicsMatrix().toArray(), rtol=1e-6)


def test_lda_steps_replace_the_topics(spark, fitted):
    """With a weight of one the topics after a step hold the words of the documents, once each, and the prior."""
    _, vocab, counted, _ = fitted
    one = topics.fit_lda(counted, 2, 1, word_prior=0.01)
    drawn = counted.select(F.aggregate(topics.vector_to_array("counts"), F.lit(0.0), lambda a, x: a + x).alias("n")).agg(F.sum("n")).head()[0]
    total = one.topicsMatrix().toArray().sum() - 2 * len(vocab) * 0.01
    assert 0.7 * drawn < total < 1.3 * drawn


def test_report_lines(spark, fitted):
    _, vocab, counted, model = fitted
    found = topics.topic_words(model, vocab)
    labels = topics.label_topics(found, themes(spark))
    lines = [r.value for r in topics.report_lines(found, labels, 4, 198, 1930.834).orderBy("line_no").collect()]
    assert lines[:3] == ["=== STATISTIQUES TOPIC MODELING ===", "", "Mots principaux par topic:"]
    assert [line[:7] for line in lines[3:7]] == ["Topic 0", "Topic 1", "Topic 2", "Topic 3"]
    assert lines[7:] == ["", "Informations modèle:", "Nombre de topics: 4", "Documents analysés: 198", "Perplexité: 1930.83"]


def test_nmf_objective_falls(spark, folder):
    vectors, vocab = topics.vectorize(topics.non_empty(documents(spark, folder)), size=1000)
    h, objective = topics.fit_nmf(vectors, len(vocab), k=4, iterations=8, tolerance=0.0)
    steps = [r.objective for r in objective.orderBy("iteration").collect()]
    assert all(a >= b - 1e-6 * a for a, b in zip(steps, steps[1:], strict=False)) and steps[-1] < steps[0]
    assert h.shape == (4, len(vocab)) and (h >= 0).all() and np.isfinite(h).all()
    assert topics.factor_words(spark, h, vocab).count() == 40


def test_nmf_on_other_partitions(spark, folder):
    vectors, vocab = topics.vectorize(topics.non_empty(documents(spark, folder)), size=1000)
    one, _ = topics.fit_nmf(vectors.repartition(1), len(vocab), k=3, iterations=4, tolerance=0.0)
    eight, _ = topics.fit_nmf(vectors.repartition(8), len(vocab), k=3, iterations=4, tolerance=0.0)
    assert np.allclose(one, eight, rtol=1e-6, atol=1e-9)


def test_pairs_of_rarer_words_are_not_counted_for_a_vocabulary(spark, monkeypatch):
    rows = [(1, "bon bon compte frais"), (2, "bon compte bon tarif"), (3, "rare seul compte bon"), (4, "rare seul frais"), (5, "")]
    docs = spark.createDataFrame(rows, "review_seq long, document string").repartition(3)
    counted = topics.vocabulary(topics.term_statistics(topics.with_terms(docs)), 4, max_share=0.9).collect()
    with monkeypatch.context() as m:
        m.setattr(topics, "term_statistics", None)
        assert topics.learnt_vocabulary(docs, 4, max_share=0.9).collect() == counted
    for given, size, most in ((docs, 50, 10), (docs, 4, 1), (docs.union(docs), 4, 10)):
        counted = topics.vocabulary(topics.term_statistics(topics.with_terms(given)), size, max_share=0.9).collect()
        assert topics.learnt_vocabulary(given, size, most_often=most, max_share=0.9).collect() == counted


def test_documents_that_come_near_slowly_reach_their_weights():
    """Topics that hardly differ: rounds alone were cut off before the weights stood still."""
    rng = np.random.default_rng(3)
    topics_of = 1000 * rng.dirichlet(np.full(60, 5.0))[:, None] * (1 + 0.2 * rng.standard_normal((60, 5)))
    counts = rng.poisson(10.0, (20, 60)).astype(float)
    row, term = np.nonzero(counts)
    prior = np.full(5, 0.2)
    weights, bound = topic_bound.document_bounds(row, term, counts[row, term], 20, topics_of, prior)
    shares = np.exp(topic_bound.expected_logs(weights))
    words = np.exp(topic_bound.expected_logs(topics_of.T).T)
    raised = prior + shares * ((counts / (shares @ words.T)) @ words)
    assert np.abs(raised - weights).mean(1).max() < 1e-5 and np.isfinite(bound).all()
    empty, nothing = topic_bound.document_bounds(row[:0], term[:0], counts[row, term][:0], 2, topics_of, prior)
    assert np.allclose(empty, prior) and (nothing == 0).all()


def test_weights_keep_few_bytes(spark, folder):
    """What is written for the weights is compressed, and the terms of the documents are not written beside their counts."""
    from opinara.registry.topics import listed_terms, tfidf_vectors

    def kept() -> int:
        return sum(f.stat().st_size for f in Path(checkpoint_folder(spark).removeprefix("file:")).rglob("*") if f.is_file())

    n = topics.term_counts(listed_terms(spark, folder)).count()
    before = kept()
    assert tfidf_vectors(spark, folder).count() > 0
    assert kept() - before < 20 * n
