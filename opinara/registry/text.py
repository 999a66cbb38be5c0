"""Queries of the cleaning stage."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opinara import fixed_values as fixed
from opinara.functions import text as tx
from opinara.functions.numbers import half_up
from opinara.functions.stemming import stem_tokens, stem_words
from opinara.operators.lineage import cut_lineage, stored
from opinara.operators.small import small_table
from opinara.plans import cleaning, vocabulary
from opinara.registry.core import (
    KEPT, PROCESSED, REVIEWS_RAW, SENTENCE_END, SPACES, query, rounded, sql_clean, sql_tokens, sql_words, text_list, text_literal, with_ctes,
)
from opinara.sources.tables import load, load_texts, reviews_raw

_JOINED = "array_to_string(tokens, ' ')"
_TOKENS = text_literal(tx.TOKEN)


@query("reviews_raw", with_ctes(REVIEWS_RAW, select="SELECT * FROM reviews_raw"))
def raw(spark, folder) -> DataFrame:
    return reviews_raw(spark, folder)


@query(
    "clean_text",
    with_ctes(REVIEWS_RAW, select=f"SELECT review_seq, {sql_clean('review_text')} AS cleaned_text FROM reviews_raw"),
)
def clean_text(spark, folder):
    return reviews_raw(spark, folder).select("review_seq", tx.clean_basic(F.col("review_text")).alias("cleaned_text"))


@query("clean_page_html", f"SELECT page_id, {sql_clean('html')} AS cleaned_text FROM pages")
def clean_page_html(spark, folder):
    return load_texts(spark, folder, "pages", "page_id").select("page_id", tx.clean_basic(F.col("html")).alias("cleaned_text"))


@query(
    "fold_accents",
    f"SELECT doc_id, translate(lower(text), '{fixed.ACCENTED}', '{fixed.UNACCENTED}') AS folded_text FROM documents",
)
def fold_accents(spark, folder):
    docs = load_texts(spark, folder, "documents", "doc_id")
    return docs.select("doc_id", tx.fold_accents(F.lower("text")).alias("folded_text"))


@query(
    "remove_emoji",
    f"SELECT conv_id, turn, regexp_replace(text, {text_literal(tx.EMOJI)}, '', 'g') AS plain_text FROM conversations",
)
def remove_emoji(spark, folder):
    return load(spark, folder, "conversations").select("conv_id", "turn", tx.remove_emoji(F.col("text")).alias("plain_text"))


@query(
    "tokenize",
    f"""SELECT doc_id, array_to_string(toks, ' ') AS tokens, len(toks) AS n_tokens
    FROM (SELECT doc_id, regexp_extract_all({sql_clean('text')}, {_TOKENS}, 0) AS toks FROM documents)""",
)
def tokenize(spark, folder):
    tokens = tx.tokenize(tx.clean_basic(F.col("text")))
    docs = load_texts(spark, folder, "documents", "doc_id").select("doc_id", tokens.alias("t"))
    return docs.select("doc_id", F.array_join("t", " ").alias("tokens"), F.size("t").alias("n_tokens"))


@query(
    "remove_punctuation",
    f"""SELECT doc_id, array_to_string(list_filter(regexp_extract_all(lower(text), {_TOKENS}, 0),
      lambda t: NOT regexp_matches(t, '^[^\\p{{L}}\\p{{N}}_ ]$')), ' ') AS tokens FROM documents""",
)
def remove_punctuation(spark, folder):
    tokens = tx.remove_punctuation(tx.tokenize(F.col("text")))
    return load_texts(spark, folder, "documents", "doc_id").select("doc_id", F.array_join(tokens, " ").alias("tokens"))


@query(
    "remove_stop_words",
    f"""SELECT doc_id, array_to_string(list_filter(regexp_extract_all(lower(text), {_TOKENS}, 0),
      lambda t: NOT list_contains([{text_list(fixed.STOP_WORDS)}], t)), ' ') AS tokens FROM documents""",
)
def remove_stop_words(spark, folder):
    tokens = tx.remove_stop_words(tx.tokenize(F.col("text")))
    return load_texts(spark, folder, "documents", "doc_id").select("doc_id", F.array_join(tokens, " ").alias("tokens"))


@query(
    "keep_plain_words",
    f"""SELECT doc_id, array_to_string(list_filter(regexp_extract_all(lower(text), {_TOKENS}, 0),
      lambda t: regexp_matches(t, '^[a-zA-Z]{{3,}}$')), ' ') AS tokens FROM documents""",
)
def keep_plain_words(spark, folder):
    tokens = tx.keep_plain_words(tx.tokenize(F.col("text")), min_length=3)
    return load_texts(spark, folder, "documents", "doc_id").select("doc_id", F.array_join(tokens, " ").alias("tokens"))


@query("remove_duplicates", with_ctes(REVIEWS_RAW, KEPT, select="SELECT review_seq, bank_name FROM kept"))
def remove_duplicates(spark, folder):
    return cleaning.remove_duplicates(reviews_raw(spark, folder)).select("review_seq", "bank_name")


@query(
    "processed_reviews",
    with_ctes(
        REVIEWS_RAW, KEPT, PROCESSED,
        select=f"""SELECT review_seq, bank_name, cleaned_text, {_JOINED} AS processed_text, len(tokens) AS word_count,
          length({_JOINED}) AS char_count FROM processed WHERE len(tokens) >= 3""",
    ),
)
def processed_reviews(spark, folder):
    out = cleaning.clean_reviews(reviews_raw(spark, folder), stem=False)
    return out.select("review_seq", "bank_name", "cleaned_text", "processed_text", "word_count", "char_count")


@query(
    "processed_without_accents",
    with_ctes(
        REVIEWS_RAW, KEPT,
        f"""
cleaned AS (SELECT *, translate({sql_clean('review_text')}, '{fixed.ACCENTED}', '{fixed.UNACCENTED}') AS cleaned_text
  FROM kept),
processed AS (SELECT *, {sql_tokens('cleaned_text')} AS tokens FROM cleaned)""",
        select=f"SELECT review_seq, {_JOINED} AS processed_text, len(tokens) AS word_count FROM processed WHERE len(tokens) >= 3",
    ),
)
def processed_without_accents(spark, folder):
    out = cleaning.clean_reviews(reviews_raw(spark, folder), fold=True, stem=False)
    return out.select("review_seq", "processed_text", "word_count")


@query("stemmed_reviews")
def stemmed_reviews(spark, folder):
    return cleaning.clean_reviews(reviews_raw(spark, folder)).select(
        "review_seq", "processed_text", "word_count", "char_count"
    )


# A normal form that SQL has too: endings in "s" and "x" go, and "ment" at the end of a longer word.
_NORMAL = "regexp_replace(regexp_replace({}, '([a-z]{{3}})[sx]$', '\\1'), '([a-z]{{4}})ment$', '\\1')"
_TABLE = f"""
word_table AS (SELECT word, {_NORMAL.format('word')} AS normal FROM (SELECT DISTINCT unnest(tokens) AS word FROM processed))"""


def _normal(word):
    return F.regexp_replace(F.regexp_replace(word, "([a-z]{3})[sx]$", "$1"), "([a-z]{4})ment$", "$1")


def _word_tables(spark, folder, normalise):
    """Reviews with plain words, and the word table: stored after the reviews with an even number, extended for all of them."""
    plain = stored(cleaning.plain_tokens(cleaning.remove_duplicates(reviews_raw(spark, folder))).select("review_seq", "tokens"))
    early = plain.filter("review_seq % 2 = 0")
    before = stored(vocabulary.extend_word_table(None, vocabulary.distinct_words(early), normalise))
    return plain, stored(vocabulary.extend_word_table(before, vocabulary.distinct_words(plain), normalise))


@query("word_table", with_ctes(REVIEWS_RAW, KEPT, PROCESSED, _TABLE, select="SELECT * FROM word_table"))
def word_table(spark, folder):
    return _word_tables(spark, folder, _normal)[1]


_NORMALISED = with_ctes(
    REVIEWS_RAW, KEPT, PROCESSED,
    select=f"""SELECT review_seq, array_to_string(list_transform(tokens, lambda t: {_NORMAL.format('t')}), ' ') AS processed_text
      FROM processed""",
)


@query("words_normalised", _NORMALISED)
def words_normalised(spark, folder):
    out = vocabulary.normalise_words(*_word_tables(spark, folder, _normal))
    return out.select("review_seq", F.array_join("tokens", " ").alias("processed_text"))


@query("words_normalised_by_shuffle", _NORMALISED)
def words_normalised_by_shuffle(spark, folder):
    """The same for a table that is too long to share."""
    out = vocabulary.normalise_words(*_word_tables(spark, folder, _normal), most_shared=0)
    return out.select("review_seq", F.array_join("tokens", " ").alias("processed_text"))


@query(
    "stems_of_table_hold",
    with_ctes(REVIEWS_RAW, KEPT, PROCESSED, select="SELECT review_seq, len(tokens) AS n_words, 1 AS as_stemmed FROM processed"),
)
def stems_of_table_hold(spark, folder):
    """Per review: its words, and that the stems of the stored table are those that its words have one by one."""
    plain, table = _word_tables(spark, folder, stem_words)
    both = plain.withColumn("one_by_one", stem_tokens("tokens"))
    out = vocabulary.normalise_words(both, table)
    return out.select("review_seq", F.size("tokens").alias("n_words"), (F.col("tokens") == F.col("one_by_one")).alias("as_stemmed"))


# A short lemma table (fixed values), and a long one: each plain word that ends in "s", without it.
_SHORT_LEMMAS = {"the": "le", "and": "et", "of": "de", "with": "avec", "was": "be", "is": "be"}
_LEMMATIZED = f"array_to_string(list_transform(tokens, lambda t: {{}}), ' ')"
_CHANGED_WORD = (
    "CASE " + " ".join(f"WHEN t = '{a}' THEN '{b}'" for a, b in _SHORT_LEMMAS.items()) + " ELSE t END"
)


@query(
    "lemmas_inline",
    with_ctes(
        REVIEWS_RAW, KEPT, PROCESSED,
        select=f"SELECT review_seq, {_LEMMATIZED.format(_CHANGED_WORD)} AS processed_text FROM processed",
    ),
)
def lemmas_inline(spark, folder):
    table = small_table(spark, list(_SHORT_LEMMAS.items()), "term string, lemma string")
    out = cleaning.process_reviews(cleaning.remove_duplicates(reviews_raw(spark, folder)), lemmas=table)
    return out.select("review_seq", "processed_text")


@query(
    "lemmas_joined",
    with_ctes(
        REVIEWS_RAW, KEPT, PROCESSED,
        select=f"""SELECT review_seq, {_LEMMATIZED.format("CASE WHEN t LIKE '%s' AND length(t) > 3 THEN t[:-2] ELSE t END")}
          AS processed_text FROM processed""",
    ),
)
def lemmas_joined(spark, folder):
    kept = cleaning.remove_duplicates(reviews_raw(spark, folder))
    plain = cut_lineage(cleaning.plain_tokens(kept).select("review_seq", "tokens"))
    ends = plain.select(F.explode("tokens").alias("term")).filter("term like '%s' and length(term) > 3").distinct()
    table = cut_lineage(ends.withColumn("lemma", F.expr("substring(term, 1, length(term) - 1)")))
    out = cleaning.lemmatize(plain, table, inline_terms=0)
    return out.select("review_seq", F.array_join("tokens", " ").alias("processed_text"))


_SENTENCES = (
    f"CASE WHEN review_text IS NULL THEN 0 ELSE len(list_filter(string_split_regex(review_text, "
    f"{text_literal(SENTENCE_END)}), lambda s: regexp_replace(s, {text_literal(f'[{SPACES}]+')}, '', 'g') <> '')) END"
)
_SHOUTED = (
    f"len(list_filter({sql_words('review_text')}, lambda w: length(w) > 2 AND w = upper(w) AND w <> lower(w))) > 0"
)


@query(
    "text_features",
    with_ctes(
        REVIEWS_RAW, KEPT, PROCESSED,
        select=f"""SELECT review_seq, length(review_text) AS original_length, length(cleaned_text) AS cleaned_length,
          {_SENTENCES} AS sentence_count,
          CAST(coalesce(contains(review_text, '!'), false) AS INT) AS has_exclamation,
          CAST(coalesce(contains(review_text, '?'), false) AS INT) AS has_question,
          CAST(coalesce({_SHOUTED}, false) AS INT) AS has_caps FROM processed""",
    ),
)
def text_features(spark, folder):
    kept = cleaning.plain_tokens(cleaning.remove_duplicates(reviews_raw(spark, folder)))
    return cleaning.add_text_features(kept).select(
        "review_seq", "original_length", "cleaned_length", "sentence_count", "has_exclamation", "has_question", "has_caps"
    )


@query(
    "raw_counts",
    f"SELECT doc_id, len({sql_words('text')}) AS word_count, length(text) AS char_count FROM documents",
)
def raw_counts(spark, folder):
    docs = load_texts(spark, folder, "documents", "doc_id")
    return docs.select("doc_id", tx.word_count(F.col("text")).alias("word_count"), F.length("text").alias("char_count"))


@query(
    "cleaning_report",
    with_ctes(
        REVIEWS_RAW, KEPT, PROCESSED,
        "\nfinal AS (SELECT * FROM processed WHERE len(tokens) >= 3)",
        "\nb AS (SELECT count(*) AS o, avg(length(review_text)) AS l FROM reviews_raw)",
        """
a AS (SELECT count(*) AS c, avg(length(cleaned_text)) AS l, avg(len(tokens)) AS w, count(DISTINCT bank_name) AS nb,
  count(DISTINCT branch_name) AS nbr FROM final)""",
        select=f"""SELECT b.o AS original_count, {rounded('b.l')} AS avg_original_length, a.c AS cleaned_count,
          {rounded('a.l')} AS avg_cleaned_length, {rounded('a.w')} AS avg_word_count, a.nb AS banks_count,
          a.nbr AS branches_count, b.o - a.c AS removed_count,
          {rounded('(b.o - a.c) * CAST(100 AS DOUBLE) / b.o')} AS removal_rate FROM a, b""",
    ),
)
def cleaning_report(spark, folder):
    original = reviews_raw(spark, folder)
    return cleaning.cleaning_report(original, cleaning.clean_reviews(original, stem=False))


@query(
    "preview",
    with_ctes(REVIEWS_RAW, select="SELECT review_seq, bank_name, rating FROM reviews_raw ORDER BY review_seq LIMIT 5"),
)
def preview(spark, folder):
    return reviews_raw(spark, folder).select("review_seq", "bank_name", "rating").orderBy("review_seq").limit(5)
