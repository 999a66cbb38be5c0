"""Queries of the topic stage. Model output has no SQL; tests check what must hold for it."""

from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from opinara import fixed_values as fixed
from opinara.operators.lineage import cut_lineage, stored
from opinara.plans import cleaning, topics
from opinara.registry.core import (
    KEPT, PROCESSED, REVIEWS_RAW, query, rounded, sql_words, text_list, with_ctes,
)
from opinara.registry.reports import FLAT_INPUT, flat_input
from opinara.registry.sentiment import scored
from opinara.sources.seeds import themes
from opinara.sources.tables import load, load_texts, reviews_raw

# Themes for the given texts, in which the built-in keywords hardly occur (fixed values).
TEST_THEMES = {
    "english": ["the", "of", "and", "to", "is", "that"],
    "french": ["le", "la", "les", "des", "et", "en"],
    "german": ["der", "die", "und", "den", "ist"],
    "spanish": ["el", "la", "de", "que", "los", "en"],
}


def documents(spark, folder):
    """Documents out of the cleaned reviews, short ones emptied."""
    cleaned = cleaning.process_reviews(cleaning.remove_duplicates(reviews_raw(spark, folder)), stem=False)
    return topics.prepare_documents(cleaned.select("review_seq", "processed_text"))


def written_documents(spark, folder):
    """The same, written once for queries that read them several times."""
    return stored(documents(spark, folder).select("review_seq", "document"))


_DOCUMENTS = """
documents_for_topics AS (SELECT review_seq, CASE WHEN len(tokens) >= 3 THEN array_to_string(tokens, ' ') ELSE '' END AS document
  FROM processed)"""
_TERMS = f"""
singles AS (SELECT review_seq, list_filter(regexp_extract_all(lower(document), '[\\p{{L}}\\p{{N}}_]{{2,}}', 0),
  lambda t: NOT list_contains([{text_list(fixed.TOPIC_STOP_WORDS)}], t)) AS ws FROM documents_for_topics WHERE document <> ''),
single_rows AS (SELECT review_seq, unnest(ws) AS w, generate_subscripts(ws, 1) AS i FROM singles),
term_rows AS (SELECT review_seq, w AS term FROM single_rows UNION ALL
  SELECT review_seq, concat(w, ' ', n) FROM (SELECT review_seq, w, lead(w) OVER (PARTITION BY review_seq ORDER BY i) AS n
    FROM single_rows) WHERE n IS NOT NULL),
statistics AS (SELECT term, count(*) AS term_count, count(DISTINCT review_seq) AS doc_count,
  (SELECT count(*) FROM singles) AS n_docs FROM term_rows GROUP BY term),
usable AS (SELECT * FROM statistics WHERE doc_count >= 2 AND doc_count <= n_docs * CAST(0.8 AS DOUBLE)),
vocabulary AS (SELECT * FROM usable ORDER BY term_count DESC, term LIMIT 1000),
counts AS (SELECT review_seq, term, count(*) AS n FROM term_rows GROUP BY review_seq, term),
weights AS (SELECT review_seq, term, n * (ln((1 + n_docs) / CAST(1 + doc_count AS DOUBLE)) + 1) AS w
  FROM counts JOIN usable USING (term)),
norms AS (SELECT review_seq, sqrt(sum(w * w)) AS norm FROM weights GROUP BY review_seq)"""
CTES = (REVIEWS_RAW, KEPT, PROCESSED, _DOCUMENTS, _TERMS)


@query("topic_documents", with_ctes(*CTES, select="SELECT review_seq, document FROM documents_for_topics"))
def topic_documents(spark, folder):
    return documents(spark, folder).select("review_seq", "document")


def listed_terms(spark, folder):
    """The terms of the documents that are not empty. The documents are written once, as their terms are many times as long."""
    return topics.with_terms(stored(topics.non_empty(documents(spark, folder)).select("review_seq", "document"))).select("review_seq", "terms")


@query("term_statistics", with_ctes(*CTES, select="SELECT * FROM statistics"))
def term_statistics(spark, folder):
    return topics.term_statistics(listed_terms(spark, folder))


@query("vocabulary", with_ctes(*CTES, select="SELECT * FROM vocabulary"))
def vocabulary(spark, folder):
    """The terms that a model of this width takes."""
    return topics.vocabulary(term_statistics(spark, folder), size=fixed.VOCABULARY_SIZE)


@query("term_count_vectors", with_ctes(*CTES, select="SELECT review_seq, term, CAST(n AS DOUBLE) AS weight FROM counts"))
def term_count_vectors(spark, folder):
    """Every term of every document."""
    counts = topics.term_counts(listed_terms(spark, folder))
    return counts.select("review_seq", "term", F.col("n").cast("double").alias("weight"))


_WEIGHTS = with_ctes(*CTES, select=f"SELECT review_seq, term, {rounded('w / norm')} AS weight FROM weights JOIN norms USING (review_seq)")


def _tfidf(spark, folder, **options):
    listed = listed_terms(spark, folder)
    counts = stored(topics.term_counts(listed))
    usable = topics.usable_terms(topics.statistics_of(counts, listed.count()))
    return topics.tfidf_weights(counts, usable, **options)


@query("tfidf_vectors", _WEIGHTS)
def tfidf_vectors(spark, folder):
    """The weights of all usable terms."""
    return _tfidf(spark, folder)


@query("tfidf_by_shuffle", _WEIGHTS)
def tfidf_by_shuffle(spark, folder):
    """The same with few terms that count as frequent, so that the rest is joined by shuffle."""
    return _tfidf(spark, folder, most_broadcast=50)


@query(
    "model_count_vectors",
    with_ctes(*CTES, select="SELECT review_seq, term, CAST(n AS DOUBLE) AS weight FROM counts JOIN vocabulary USING (term)"),
)
def model_count_vectors(spark, folder):
    """The input of a model that is as wide as its vocabulary."""
    vectors, vocab = _vectors(spark, folder)
    return topics.vector_entries(vectors, "review_seq", "counts", vocab)


def _vectors(spark, folder):
    return topics.vectorize(written_documents(spark, folder), size=fixed.VOCABULARY_SIZE)


_CURVE = """
curve AS (SELECT CAST(l_suppkey % 14 + 2 AS INT) AS k, avg(l_extendedprice) AS perplexity FROM lineitem GROUP BY 1),
bends AS (SELECT k, lead(k) OVER (ORDER BY k) AS next_k,
  lag(perplexity) OVER (ORDER BY k) - 2 * perplexity + lead(perplexity) OVER (ORDER BY k) AS bend FROM curve)"""


def _curve(spark, folder):
    lines = load(spark, folder, "lineitem")
    return lines.groupBy((F.col("l_suppkey") % 14 + 2).cast("int").alias("k")).agg(
        F.avg("l_extendedprice").alias("perplexity")
    )


@query(
    "elbow_published",
    with_ctes(
        _CURVE, select="SELECT next_k AS optimal_topics FROM bends WHERE bend IS NOT NULL ORDER BY bend DESC, k LIMIT 1"
    ),
)
def elbow_published(spark, folder):
    return topics.elbow(_curve(spark, folder))


@query(
    "elbow_at_bend",
    with_ctes(_CURVE, select="SELECT k AS optimal_topics FROM bends WHERE bend IS NOT NULL ORDER BY bend DESC, k LIMIT 1"),
)
def elbow_at_bend(spark, folder):
    return topics.elbow(_curve(spark, folder), published_offset=False)


_THEME_ROWS = ", ".join(
    f"({rank}, '{theme}', '{word}')" for rank, (theme, ws) in enumerate(TEST_THEMES.items()) for word in ws
)
_TOPIC_WORDS = f"""
counted AS (SELECT topic_id, word, count(*) AS n FROM (SELECT CAST(doc_id % 12 AS INT) AS topic_id, lang,
  unnest({sql_words('lower(text)')}) AS word FROM documents) GROUP BY topic_id, word),
topic_words AS (SELECT topic_id, word, row_number() OVER (PARTITION BY topic_id ORDER BY n DESC, word) AS word_rank FROM counted
  QUALIFY word_rank <= 10),
themes(theme_rank, theme, keyword) AS (VALUES {_THEME_ROWS}),
shared_counts AS (SELECT topic_id, theme_rank, theme, count(*) AS overlap FROM topic_words JOIN themes ON word = keyword GROUP BY ALL),
best AS (SELECT * FROM shared_counts QUALIFY row_number() OVER (PARTITION BY topic_id ORDER BY overlap DESC, theme_rank) = 1),
fallback AS (SELECT topic_id, concat('theme_', string_agg(word, ' ' ORDER BY word_rank)) AS label FROM topic_words
  WHERE word_rank <= 2 GROUP BY topic_id),
labels AS (SELECT topic_id, CASE WHEN overlap >= 3 THEN theme ELSE label END AS topic_label FROM fallback
  LEFT JOIN best USING (topic_id))"""


def _labels(spark, folder):
    from pyspark.sql import Window

    from opinara.functions.text import words

    docs = load_texts(spark, folder, "documents", "doc_id")
    listed = docs.select((F.col("doc_id") % 12).cast("int").alias("topic_id"), F.explode(words(F.lower("text"))).alias("word"))
    counted = listed.groupBy("topic_id", "word").agg(F.count(F.lit(1)).alias("n"))
    rank = F.row_number().over(Window.partitionBy("topic_id").orderBy(F.desc("n"), "word"))
    found = counted.withColumn("word_rank", rank).filter(F.col("word_rank") <= 10)  # top words are the input
    return topics.label_topics(found, themes(spark, TEST_THEMES), min_overlap=3)


@query("topic_labels", with_ctes(_TOPIC_WORDS, select="SELECT topic_id, topic_label FROM labels"))
def topic_labels(spark, folder):
    return _labels(spark, folder)


@query(
    "labelled_documents",
    with_ctes(
        _TOPIC_WORDS,
        select="""SELECT doc_id, t AS topic_id, topic_label FROM (SELECT doc_id, CAST(doc_id % 14 - 1 AS INT) AS t FROM documents)
          LEFT JOIN labels ON t = topic_id""",
    ),
)
def labelled_documents(spark, folder):
    docs = load(spark, folder, "documents").select("doc_id", (F.col("doc_id") % 14 - 1).cast("int").alias("topic_id"))
    return topics.add_topic_labels(docs, _labels(spark, folder))


@query(
    "assigned_topics",
    f"""SELECT vec_id, CASE WHEN m >= CAST(0.05 AS DOUBLE) THEN list_position(p, m) - 1 ELSE -1 END AS topic_id,
      {rounded('m')} AS topic_probability FROM (SELECT vec_id, p, list_max(p) AS m FROM (SELECT vec_id,
      list_transform(a, lambda x: x / list_sum(a)) AS p FROM (SELECT vec_id, list_transform(embedding,
      lambda x: abs(CAST(x AS DOUBLE))) AS a FROM embeddings)))""",
)
def assigned_topics(spark, folder):
    vectors = load(spark, folder, "embeddings").select(
        "vec_id", F.transform("embedding", lambda x: F.abs(x.cast("double"))).alias("a")
    )
    vectors = vectors.withColumn("whole", F.aggregate("a", F.lit(0.0), lambda acc, x: acc + x))
    shares = F.transform("a", lambda x: x / F.col("whole"))
    given = vectors.select("vec_id", array_to_vector(shares).alias("topicDistribution"))
    return topics.assign_topics(given, threshold=0.05).select("vec_id", "topic_id", "topic_probability")


_ASSIGNED = f"""
flat_input AS ({FLAT_INPUT}),
assigned AS (SELECT *, CAST(review_seq % 7 - 1 AS INT) AS topic_id, TRY_CAST(rating AS DOUBLE) AS stars,
  TRY_CAST(ensemble_score AS DOUBLE) AS score FROM flat_input)"""


def _assigned(spark, folder):
    return flat_input(spark, folder).withColumns(
        {
            "topic_id": (F.col("review_seq") % 7 - 1).cast("int"),
            "rating": F.col("rating").try_cast("double"),
            "ensemble_score": F.col("ensemble_score").try_cast("double"),
        }
    )


@query(
    "topics_by_sentiment",
    with_ctes(
        _ASSIGNED,
        select=f"""SELECT topic_id, count(*) AS total_reviews,
          count(CASE WHEN sentiment_label = 'positive' THEN 1 END) AS positive_reviews,
          count(CASE WHEN sentiment_label = 'negative' THEN 1 END) AS negative_reviews,
          count(CASE WHEN sentiment_label = 'neutral' THEN 1 END) AS neutral_reviews,
          {rounded('avg(score)')} AS avg_sentiment_score, {rounded('avg(stars)')} AS avg_rating
          FROM assigned WHERE topic_id <> -1 GROUP BY topic_id""",
    ),
)
def topics_by_sentiment(spark, folder):
    return topics.topics_by_sentiment(_assigned(spark, folder))


@query(
    "topics_by_bank",
    with_ctes(
        _ASSIGNED,
        "\ncounted AS (SELECT bank_name, topic_id, count(*) AS n FROM assigned GROUP BY bank_name, topic_id)",
        select="""SELECT *, CAST(sum(n) OVER (PARTITION BY bank_name) AS BIGINT) AS total_reviews,
          row_number() OVER (PARTITION BY bank_name ORDER BY n DESC, topic_id) AS topic_rank FROM counted
          QUALIFY topic_rank <= 3""",
    ),
)
def topics_by_bank(spark, folder):
    return topics.topics_by_bank(_assigned(spark, folder))


# ---------------------------------------------------------------- models


def _model(spark, folder):
    vectors, vocab = _vectors(spark, folder)
    counted = topics.model_input(vectors)
    return vectors, vocab, counted, topics.fit_lda(counted)


def _holds(name: str, sql: str):
    """A query of what must hold for a model's output, row by row over the documents."""
    return query(name, with_ctes(*CTES, select=sql))


@_holds(
    "lda_assignments_hold",
    """SELECT review_seq, CAST(document <> '' AS INT) AS has_words, 1 AS in_range, 1 AS uncertain_below_threshold, 1 AS known_topic
      FROM documents_for_topics""",
)
def lda_assignments_hold(spark, folder):
    """Every review has one row, a probability between an even share and one, and topic -1 exactly below the threshold."""
    vectors, _, _, model = _model(spark, folder)
    assigned = topics.assign_topics(model.transform(vectors))
    p, topic = F.col("topic_probability"), F.col("topic_id")
    return assigned.select(
        "review_seq",
        (F.col("document") != "").alias("has_words"),
        p.between(1 / fixed.TOPIC_COUNT - 1e-9, 1 + 1e-9).alias("in_range"),
        ((topic == fixed.UNCERTAIN_TOPIC) == (p < fixed.TOPIC_THRESHOLD)).alias("uncertain_below_threshold"),
        topic.between(-1, fixed.TOPIC_COUNT - 1).alias("known_topic"),
    )


_RANKS = """SELECT topic_id, word_rank, 1 AS in_vocabulary, 1 AS in_order FROM (SELECT unnest(range({topics})) AS topic_id),
  (SELECT unnest(range(1, {words} + 1)) AS word_rank) WHERE word_rank <= (SELECT count(*) FROM vocabulary)"""


def _ranks_hold(found, vocab_rows):
    """Ranks from one without gaps, words of the vocabulary, weights that don't rise."""
    from pyspark.sql import Window

    before = F.lag("weight").over(Window.partitionBy("topic_id").orderBy("word_rank"))
    known = found.join(F.broadcast(vocab_rows.select(F.col("term").alias("word")).withColumn("known", F.lit(True))), "word", "left")
    return known.select(
        F.col("topic_id").cast("long").alias("topic_id"),
        F.col("word_rank").cast("long").alias("word_rank"),
        F.coalesce("known", F.lit(False)).alias("in_vocabulary"),
        F.coalesce(before >= F.col("weight"), F.lit(True)).alias("in_order"),
    )


def _counted_vocabulary(vectors):
    """The vocabulary from the statistics of all terms of the same documents."""
    listed = topics.non_empty(vectors).select("review_seq", "terms")
    return topics.vocabulary(topics.term_statistics(listed), size=fixed.VOCABULARY_SIZE)


@_holds("lda_words_hold", _RANKS.format(topics=fixed.TOPIC_COUNT, words=10))
def lda_words_hold(spark, folder):
    vectors, vocab, _, model = _model(spark, folder)
    return _ranks_hold(topics.topic_words(model, vocab), _counted_vocabulary(vectors))


@_holds("lda_wordcloud_holds", _RANKS.format(topics=fixed.TOPIC_COUNT, words=50))
def lda_wordcloud_holds(spark, folder):
    vectors, vocab, _, model = _model(spark, folder)
    return _ranks_hold(topics.wordcloud_weights(model, vocab), _counted_vocabulary(vectors))


@_holds("nmf_words_hold", _RANKS.format(topics=fixed.TOPIC_COUNT, words=10))
def nmf_words_hold(spark, folder):
    h, vocab, _, vectors = _factors(spark, folder)
    return _ranks_hold(topics.factor_words(spark, h, vocab), _counted_vocabulary(vectors))


@_holds("nmf_objective_falls", "SELECT CAST(count(*) > 0 AS INT) AS falls, CAST(count(*) > 0 AS INT) AS finite FROM singles")
def nmf_objective_falls(spark, folder):
    from pyspark.sql import Window

    before = F.lag("objective").over(Window.orderBy("iteration"))  # one row per iteration
    steps = _factors(spark, folder)[2].withColumn("before", before)
    falls = F.bool_and(F.col("before").isNull() | (F.col("objective") <= F.col("before") * (1 + 1e-9)))
    return steps.agg(falls.alias("falls"), F.bool_and(~F.isnan("objective") & (F.abs("objective") < 1e300)).alias("finite"))


@_holds(
    "topic_report_holds",
    f"""SELECT value FROM (SELECT 'Documents analysés: ' || count(*) AS value FROM singles UNION ALL
      SELECT 'Nombre de topics: {fixed.TOPIC_COUNT}')""",
)
def topic_report_holds(spark, folder):
    """The lines of the report that don't depend on the model."""
    lines = topic_report_lines(spark, folder)
    return lines.filter(F.col("value").startswith("Documents") | F.col("value").startswith("Nombre")).select("value")


@_holds(
    "topic_search_holds",
    f"""SELECT k, CAST((SELECT count(*) FROM singles) > 0 AS INT) AS finite FROM (SELECT unnest(range(2, {fixed.MAX_TOPIC_COUNT} + 1)) AS k)""",
)
def topic_search_holds(spark, folder):
    """A finite perplexity above one for each number of topics."""
    p = F.col("perplexity")
    return topic_count_search(spark, folder).select(F.col("k").cast("long").alias("k"), ((p > 1) & (p < 1e300)).alias("finite"))


@_holds(
    "topic_stage_holds",
    """SELECT review_seq, 1 AS one_topic, 1 AS labelled FROM documents_for_topics""",
)
def topic_stage_holds(spark, folder):
    """Every review comes back once, with a topic, and with a label exactly where the topic is certain."""
    topic = F.col("topic_id")
    return topic_stage(spark, folder).select(
        "review_seq",
        (topic >= fixed.UNCERTAIN_TOPIC).alias("one_topic"),
        ((topic == fixed.UNCERTAIN_TOPIC) == F.col("topic_label").isNull()).alias("labelled"),
    )


@query("lda_topic_words")
def lda_topic_words(spark, folder):
    _, vocab, _, model = _model(spark, folder)
    return topics.topic_words(model, vocab)


@query("lda_wordcloud_weights")
def lda_wordcloud_weights(spark, folder):
    _, vocab, _, model = _model(spark, folder)
    return topics.wordcloud_weights(model, vocab)


@query("lda_assigned_reviews")
def lda_assigned_reviews(spark, folder):
    vectors, _, _, model = _model(spark, folder)
    assigned = topics.assign_topics(model.transform(vectors))
    return assigned.select("review_seq", "topic_id", "topic_probability")


@query("topic_stage")
def topic_stage(spark, folder):
    """Scored reviews with topic columns."""
    reviews = scored(spark, folder).withColumn("processed_text", F.array_join("tokens", " "))
    out, _ = topics.model_topics(cut_lineage(reviews), themes(spark, TEST_THEMES), n_topics=fixed.TOPIC_COUNT)
    return out.select("review_seq", "bank_name", "sentiment_label", "ensemble_score", "topic_id", "topic_probability",
                      "topic_label")


@query("topic_report_lines")
def topic_report_lines(spark, folder):
    _, vocab, counted, model = _model(spark, folder)
    found = topics.topic_words(model, vocab)
    labels = topics.label_topics(found, themes(spark, TEST_THEMES))
    return topics.report_lines(found, labels, fixed.TOPIC_COUNT, counted.count(), topics.perplexity(model, counted))


@query("topic_count_search")
def topic_count_search(spark, folder):
    vectors, _ = _vectors(spark, folder)
    return topics.topic_count_search(topics.model_input(vectors))


def _factors(spark, folder):
    vectors, vocab = topics.vectorize(topics.non_empty(written_documents(spark, folder)), size=fixed.VOCABULARY_SIZE)
    h, objective = topics.fit_nmf(vectors, len(vocab))
    return h, vocab, objective, vectors


@query("nmf_objective")
def nmf_objective(spark, folder):
    return _factors(spark, folder)[2]


@query("nmf_topic_words")
def nmf_topic_words(spark, folder):
    h, vocab, *_ = _factors(spark, folder)
    return topics.factor_words(spark, h, vocab)
