import numpy as np
import pytest
from pyspark.sql import functions as F

from opinara import fixed_values as fixed
from opinara.functions import labels
from opinara.plans import sentiment

LEXICON = {"bon": 0.6, "mal": -0.6, "rien": 0.0, "top": 0.8}


def _texts(spark, texts):
    rows = [(n, t) for n, t in enumerate(texts)]
    return spark.createDataFrame(rows, "review_seq long, cleaned_text string")


@pytest.mark.parametrize("inline", [5_000, 0])
def test_lexicon_score(spark, inline):
    texts = ["pas bon", "bon pas", "bon mal", "rien", "autre mot", "", None, "bon bon top", "pas rien bon"]
    df = sentiment.add_lexicon_score(_texts(spark, texts), LEXICON, ["pas"], "cleaned_text", inline_terms=inline)
    found = [
        (round(r.custom_sentiment_score, 6), r.positive_words_count, r.negative_words_count)
        for r in df.orderBy("review_seq").collect()
    ]
    assert found == [(-0.6, 0, 1), (0.6, 1, 0), (0.0, 1, 1), (0.0, 0, 0), (0.0, 0, 0), (0.0, 0, 0), (0.0, 0, 0),
                     (round(2.0 / 3, 6), 3, 0), (0.6, 1, 0)]


@pytest.mark.parametrize("inline", [5_000, 0])
def test_a_lexicon_table_gives_all_scores_of_the_dict(spark, inline):
    texts = ["pas bon", "bon mal top", "rien but bon !!", "autre", "", None, "top top mal ??"]
    df = _texts(spark, texts).withColumn("rating", F.lit(3.0))
    rows = [("bon", 0.6), ("mal", -0.6), ("rien", 0.0), ("top", 1.0), ("top", 0.6), (None, 3.0), ("autre", None)]
    table = spark.createDataFrame(rows, "term string, weight double")
    names = ["review_seq", "textblob_polarity", "textblob_subjectivity", "vader_compound", "vader_positive", "custom_sentiment_score",
             "positive_words_count", "ensemble_score", "sentiment_label"]
    given = sentiment.score_reviews(df, LEXICON, negators=["pas"], score_on="cleaned_text").select(*names)
    found = sentiment.score_reviews(df, table, negators=["pas"], score_on="cleaned_text", inline_terms=inline).select(*names)
    plain = [[round(x, 9) if isinstance(x, float) else x for x in r] for r in given.orderBy("review_seq").collect()]
    assert [[round(x, 9) if isinstance(x, float) else x for x in r] for r in found.orderBy("review_seq").collect()] == plain


@pytest.mark.parametrize("inline", [5_000, 0])
def test_lemma_tables_with_repeats_and_nulls(spark, inline):
    from opinara.plans.cleaning import lemmatize

    lemmas = spark.createDataFrame([("aa", None), ("bb", "y"), ("bb", "x"), (None, "z")], "term string, lemma string")
    df = spark.createDataFrame([(1, ["aa", "bb", "cc"]), (2, [])], "review_seq long, tokens array<string>")
    assert [r.tokens for r in lemmatize(df, lemmas, inline_terms=inline).orderBy("review_seq").collect()] == [["aa", "x", "cc"], []]


def test_lexicon_is_complete():
    weights = list(fixed.LEXICON.values())
    assert (len(weights), sum(w > 0 for w in weights), sum(w < 0 for w in weights)) == (106, 53, 45)
    assert [len(ws) for ws in fixed.THEMES.values()] == [20, 16, 16, 16, 16, 17, 14, 18]


def test_ensemble(spark):
    rows = [
        (0.6, 0.0, 0.0, 3.0, "positive", 0.3), (0.5, 0.0, 0.0, None, "neutral", 0.25), (-0.6, 0.0, 0.0, 5.0, "positive", 0.3),
        (0.6, 0.0, 0.0, 2.0, "negative", 0.3), (0.6, 0.0, 0.0, 0.0, "positive", 0.3), (1.0, 1.0, 1.0, 4.0, "positive", 1.0),
        (-0.6, 0.0, 0.0, 2.0, "negative", 0.3),
    ]
    df = spark.createDataFrame(
        rows, "textblob_polarity double, vader_compound double, custom_sentiment_score double, rating double, e string, c double"
    )
    for r in sentiment.add_ensemble(df).collect():
        assert (r.sentiment_label, round(r.sentiment_confidence, 9)) == (r.e, r.c)


def test_labels(value):
    assert value([0.1, -0.1, 0.0999, None], "double", labels.score_label) == ["positive", "negative", "neutral", "neutral"]
    ratings = [5.0, 4.0, 3.0, 2.0, 1.0, 0.0, None, float("nan"), 2.5]
    assert value(ratings, "double", labels.rating_label) == [
        "positive", "positive", "neutral", "negative", "negative", "unknown", "unknown", "unknown", "neutral",
    ]


def test_buckets(value):
    ratings = [5.0, 4.5, 4.0, 3.0, 2.0, 1.0, 0.0, None]
    e, b, m, low = fixed.RATING_NAMES
    no = fixed.RATING_UNRATED
    assert value(ratings, "double", labels.rating_bucket) == [e, no, b, m, low, low, no, no]
    assert value(ratings, "double", labels.rating_bucket_short) == [
        "Excellent", "Faible", "Bon", "Moyen", "Faible", "Faible", "Faible", "Faible",
    ]
    names = ["positive", "Negative", "neutral", None]
    assert value(names, "string", labels.sentiment_bucket) == ["😊 Positif", "❓ Inconnu", "😐 Neutre", "❓ Inconnu"]
    assert value(names, "string", lambda c: labels.sentiment_bucket(c, True))[1] == "😞 Négatif"
    assert value(names, "string", labels.sentiment_bucket_short) == ["Positif 😊", "Negatif 😞", "Neutre 😐", "Neutre 😐"]
    levels = [0.8, 0.6, 0.4, 0.39, None, float("nan")]
    assert value(levels, "double", labels.quality_level) == ["Haute", "Moyenne", "Basse", "Très basse", "Très basse", "Très basse"]
    a, c, d, s = fixed.LENGTH_NAMES
    assert value([51, 50, 20, 19, 10, 9, None], "int", labels.length_bucket) == [a, c, c, d, d, s, s]


def test_quality_score(spark):
    rows = [("12345678901", 3.0, 1.0), ("1234567890", 3.0, 0.7), (None, 0.0, 0.5), ("12345678901", None, 0.8),
            ("12345678901", float("nan"), 0.8)]
    df = spark.createDataFrame(rows, "t string, r double, e double")
    assert all(round(r.q, 9) == r.e for r in df.select("e", labels.quality_score(F.col("t"), F.col("r")).alias("q")).collect())


def test_valence_rules(spark):
    texts = ["top", "tres top", "pas top", "pas tres top", "top but mal", "top !!", "vide mot", "", "mal !"]
    rules = {"boosters": ["tres"], "dampeners": ["peu"]}
    lexicon = {"top": 2.0, "mal": -2.0}
    rows = sentiment.add_valence(_texts(spark, texts), lexicon, ["pas"], rules=rules).orderBy("review_seq").collect()

    def compound(x):
        return round(x / (x * x + 15) ** 0.5, 4)

    expected = [2.0, 2.293, 2.0 * -0.74, 2.293 * -0.74, 2.0 * 0.5 - 2.0 * 1.5, 2.0 + 2 * 0.292, 0.0, 0.0, -2.0 - 0.292]
    assert [r.vader_compound for r in rows] == [compound(x) for x in expected]
    assert (rows[6].vader_neutral, rows[7].vader_neutral) == (1.0, 0.0)
    for r in rows[:7]:
        assert abs(r.vader_positive + r.vader_neutral + r.vader_negative - 1) < 0.002


def test_statistics(spark):
    rows = [("a", "positive", 0.5, 4.0), ("a", "negative", -0.5, 0.0), ("b", None, 0.1, None), ("b", "positive", 0.3, 5.0)]
    df = spark.createDataFrame(rows, "bank_name string, sentiment_label string, ensemble_score double, rating double")
    found = {r.bank_name: r for r in sentiment.summary_by(df, "bank_name").collect()}
    assert found["a"].sentiment_distribution == {"positive": 1, "negative": 1} and found["a"].avg_rating == 2.0
    assert found["b"].total_reviews == 2 and found["b"].sentiment_distribution == {"positive": 1}


def test_correlation_of_a_constant_is_null(spark):
    from opinara.operators.statistics import correlation_matrix

    df = spark.createDataFrame([(1.0, 2.0, 7.0), (2.0, 4.0, 7.0), (3.0, None, 7.0), (4.0, 9.0, 7.0)], "a double, b double, c double")
    found = {(r.metric_a, r.metric_b): r.correlation for r in correlation_matrix(df, ["a", "b", "c"]).collect()}
    assert found[("a", "c")] is None and found[("b", "c")] is None
    assert found[("a", "b")] == pytest.approx(np.corrcoef([1, 2, 4], [2, 4, 9])[0, 1], abs=1e-6)
