"""Cleaning stage: raw reviews to cleaned text, tokens and text features."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opinara import fixed_values as fixed
from opinara.functions import text as tx
from opinara.functions.numbers import share
from opinara.functions.stemming import stem_tokens
from opinara.operators.binding import bind
from opinara.operators.dedupe import keep_first
from opinara.operators.keys import is_unique
from opinara.operators.lookup import is_small, lookup
from opinara.plans.vocabulary import MOST_SHARED, normalise_words

INLINE_TERMS = 5_000


def usable_reviews(df: DataFrame, min_chars: int = fixed.MIN_REVIEW_CHARS) -> DataFrame:
    """Reviews whose text is there and long enough."""
    return df.filter(F.col("review_text").isNotNull() & (F.length("review_text") >= min_chars))


def remove_duplicates(df: DataFrame, order: str = "review_seq") -> DataFrame:
    """First review of each (text, bank), without short ones.

    Copies have the same length, so short texts can go before the shuffle; the default text
    of an empty review, by far the most frequent one, goes with them.
    """
    return keep_first(usable_reviews(df), "review_text", ["bank_name"], order)


def plain_tokens(df: DataFrame, stop_words=fixed.STOP_WORDS, fold: bool = False) -> DataFrame:
    """Adds ``cleaned_text`` and ``tokens``: plain words that are no stop words. A plain word is never
    a punctuation mark, so those are not even listed."""
    cleaned = tx.clean_basic(F.col("review_text"))
    out = df.withColumn("cleaned_text", tx.fold_accents(cleaned) if fold else cleaned)
    return out.withColumn("tokens", tx.plain_words(tx.cleaned_words(F.col("cleaned_text")), stop_words))


def lemmatize(
    df: DataFrame, lemmas: DataFrame, key: str = "review_seq", inline_terms: int = INLINE_TERMS, most_shared: int = MOST_SHARED
) -> DataFrame:
    """Replace each token that has a lemma in the table (term, lemma).

    Rows of the table with a null are left out, and of several lemmas of a term the smallest counts, whatever the size of the
    table. A short table becomes a literal map, so rows stay where they are. A longer one that every executor can
    hold is looked up in the rows as well, if their keys are unique. Else it is joined to the words of each review, and the words
    are put back by position. Write both tables first: sizes and keys are read before.
    """
    known = lemmas.filter("term is not null and lemma is not null").groupBy("term")
    lemmas = known.agg(F.min("lemma").alias("lemma"))
    if is_small(lemmas, inline_terms):
        pairs = {r.term: r.lemma for r in lemmas.collect()}
        known = F.create_map(*[F.lit(x) for pair in pairs.items() for x in pair]) if pairs else None
        change = lambda t: F.when(t.isin(list(pairs)), F.element_at(known, t)).otherwise(t)
        return df.withColumn("tokens", F.transform("tokens", change)) if pairs else df
    if is_small(lemmas, most_shared) and is_unique(df, key):
        changed = normalise_words(df, lemmas.withColumnsRenamed({"term": "word", "lemma": "normal"}), key=key, most_shared=most_shared)
        return changed.withColumn("tokens", F.coalesce("tokens", F.array().cast("array<string>")))
    words = df.select(key, F.posexplode("tokens").alias("_at", "_token"))
    found = lookup(words, lemmas, {"_token": "term"}, spread_by=[key, "_at"])
    word = F.struct("_at", F.coalesce("lemma", "_token").alias("_word"))
    changed = found.groupBy(key).agg(F.sort_array(F.collect_list(word)).alias("_changed"))
    joined = df.join(changed, key, "left")
    tokens = F.coalesce(F.col("_changed._word"), F.array().cast("array<string>"))
    return joined.withColumn("tokens", tokens).drop("_changed")


def process_reviews(
    df: DataFrame,
    stop_words=fixed.STOP_WORDS,
    fold: bool = False,
    lemmas: DataFrame | None = None,
    stem: bool = True,
    min_words: int = 0,
    word_table: DataFrame | None = None,
) -> DataFrame:
    """Cleaned text, tokens, processed text and their counts. With a lemma table or a word table
    (``plans/vocabulary.py``) the words are looked up there, else stemmed; ``stem=False`` leaves them
    as they are. None of it changes the number of words, so reviews with fewer than ``min_words`` go
    before that."""
    out = plain_tokens(df, stop_words, fold)
    if min_words:
        out = bind(out, "tokens").filter(F.size("tokens") >= min_words)
    if lemmas is not None:
        out = lemmatize(out, lemmas)
    elif word_table is not None:
        out = normalise_words(out, word_table)
    elif stem:
        out = out.withColumn("tokens", stem_tokens("tokens"))
    out = out.withColumn("processed_text", F.array_join("tokens", " "))
    return out.withColumns({"word_count": F.size("tokens"), "char_count": F.length("processed_text")})


def clean_reviews(df: DataFrame, order: str = "review_seq", min_words: int = fixed.MIN_REVIEW_WORDS, **options):
    """The cleaning stage without copies and short reviews; ``options`` go to ``process_reviews``."""
    return process_reviews(remove_duplicates(df, order), min_words=min_words, **options)


def add_text_features(df: DataFrame) -> DataFrame:
    raw = F.col("review_text")
    return df.withColumns(
        {
            "original_length": F.length(raw),
            "cleaned_length": F.length("cleaned_text"),
            "sentence_count": tx.sentence_count(raw),
            "has_exclamation": tx.contains_mark(raw, "!"),
            "has_question": tx.contains_mark(raw, "?"),
            "has_caps": tx.has_shouting(raw),
        }
    )


def cleaning_report(original: DataFrame, cleaned: DataFrame) -> DataFrame:
    """One row: counts before and after, mean lengths, and how many banks and branches are left."""
    before = original.agg(
        F.count(F.lit(1)).alias("original_count"), F.avg(F.length("review_text")).alias("avg_original_length")
    )
    after = cleaned.agg(
        F.count(F.lit(1)).alias("cleaned_count"),
        F.avg(F.length("cleaned_text")).alias("avg_cleaned_length"),
        F.avg("word_count").alias("avg_word_count"),
        F.countDistinct("bank_name").alias("banks_count"),
        F.countDistinct("branch_name").alias("branches_count"),
    )
    removed = F.col("original_count") - F.col("cleaned_count")
    row = after.withColumn("_before", before.select(F.struct("*")).scalar()).select("_before.*", "*").drop("_before")
    return row.select(
        "*", removed.alias("removed_count"), share(removed, F.col("original_count"), None).alias("removal_rate")
    )
