"""Text expressions: cleaning, tokens, flags and counts.

All of them are built-in expressions on one row, so a text stage needs no shuffle. ``\\s`` and
``\\w`` are ASCII in Java and would eat French letters and miss no-break spaces, so ``WORD`` and
``SPACE`` name the Unicode classes.
"""

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from opinara import fixed_values as fixed

SPACE = r"\p{IsWhite_Space}\x1C-\x1F"
WORD = r"\p{L}\p{N}_"
URL = r"https?://[a-zA-Z!$-_]+"
TAG = r"<[^>]+>"
EMOJI = (
    r"[\x{1F600}-\x{1F64F}\x{1F300}-\x{1F5FF}\x{1F680}-\x{1F6FF}\x{1F1E0}-\x{1F1FF}"
    r"\x{2702}-\x{27B0}\x{24C2}-\x{1F251}]+"
)
TOKEN = rf"[{WORD}]+(?:['.-][{WORD}]+)*|[^{WORD} ]"
KEPT_TOKEN = r"^[a-zA-Z]{2,}$"
SENTENCE_END = rf"[.!?]+(?:[{SPACE}]+|$)"

# Patterns in a form that is quick in Java. An address can only start where a word starts, which keeps the
# search linear on long words. Emoji are looked for only where the text holds a character of that kind. Unwanted characters and
# white space become one space in a single step, which leaves a single space between words alone.
_EMAIL_AT_WORD_START = rf"(?<![^{SPACE}])[^{SPACE}]+@[^{SPACE}]+"
PHONE = r"(\+212|0)[5-7]\p{Nd}{8}"
_WIDE = r"[\x{2000}-\x{1FFFF}]"
_GAP = rf"""[^{WORD}.,!?;:'"-]"""
_UNWANTED_OR_SPACES = rf"""[^{WORD}.,!?;:'" -]{_GAP}*| {_GAP}+"""
_CLEANED_WORD = r"""[^ .,!?;:'"-]+(?:['.-][^ .,!?;:'"-]+)*"""


def once(value: Column, *changes: Callable[[Column], Column]) -> Column:
    """The value after some changes one after the other, each input worked out once however often its change names it. Where a
    value is not computed in a plain projection, Spark would work out every copy."""
    return F.get(reduce(F.transform, changes, F.array(value)), F.lit(0))


def _without(pattern: str, *marks: str) -> Callable[[Column], Column]:
    """Takes out the matches of a pattern, each of which holds one of the marks: a plain search for those is quicker."""

    def change(text: Column) -> Column:
        marked = reduce(lambda a, b: a | b, [F.contains(text, F.lit(m)) for m in marks])
        return F.when(marked, F.regexp_replace(text, pattern, "")).otherwise(text)

    return change


def clean_basic(text: Column) -> Column:
    """Lower-case text without URLs, e-mails, phone numbers, tags, emoji and odd characters."""
    phone = _without(PHONE, "+212", "05", "06", "07")
    out = once(F.lower(text), _without(URL, "://"), _without(_EMAIL_AT_WORD_START, "@"), phone, _without(TAG, "<"), remove_emoji)
    return F.coalesce(F.trim(F.regexp_replace(out, _UNWANTED_OR_SPACES, " ")), F.lit(""))


def remove_emoji(text: Column) -> Column:
    return F.when(text.rlike(_WIDE), F.regexp_replace(text, EMOJI, "")).otherwise(text)


def fold_accents(text: Column) -> Column:
    return F.translate(text, fixed.ACCENTED, fixed.UNACCENTED)


def tokenize(text: Column) -> Column:
    """Words and single punctuation marks. A word keeps an inner apostrophe, hyphen or period."""
    return F.regexp_extract_all(F.lower(text), F.lit(TOKEN), F.lit(0))


def cleaned_words(cleaned: Column) -> Column:
    """The words among the tokens of a cleaned text, where everything but a few marks and spaces is part of one."""
    return F.regexp_extract_all(cleaned, F.lit(_CLEANED_WORD), F.lit(0))


def plain_words(tokens: Column, stop_words=fixed.STOP_WORDS) -> Column:
    """``keep_plain_words`` and ``remove_stop_words`` in one pass."""
    return F.filter(tokens, lambda t: t.rlike(KEPT_TOKEN) & ~t.isin(list(stop_words)))


def remove_punctuation(tokens: Column) -> Column:
    return F.filter(tokens, lambda t: ~t.rlike(r"^[^\p{L}\p{N}_ ]$"))


def remove_stop_words(tokens: Column, stop_words=fixed.STOP_WORDS) -> Column:
    return F.filter(tokens, lambda t: ~t.isin(list(stop_words)))


def keep_plain_words(tokens: Column, min_length: int = 2) -> Column:
    """Keep tokens of ASCII letters only; an accented word is dropped."""
    return F.filter(tokens, lambda t: t.rlike(rf"^[a-zA-Z]{{{min_length},}}$"))


def words(text: Column) -> Column:
    """Non-empty words between white space."""
    return F.filter(F.split(text, f"[{SPACE}]+"), lambda w: w != "")


def word_count(text: Column) -> Column:
    return F.coalesce(F.size(words(text)), F.lit(0))


def sentence_count(text: Column) -> Column:
    pieces = F.filter(F.split(text, SENTENCE_END), lambda s: s.rlike(f"[^{SPACE}]"))
    return F.when(text.isNull(), F.lit(0)).otherwise(F.size(pieces))


def contains_mark(text: Column, mark: str) -> Column:
    return F.coalesce(F.contains(text, F.lit(mark)), F.lit(False))


def has_shouting(text: Column) -> Column:
    """True when a word of three characters or more is written in capitals."""
    shouted = F.exists(F.split(text, f"[{SPACE}]+"), lambda w: (F.length(w) > 2) & (w == F.upper(w)) & (w != F.lower(w)))
    return F.coalesce(shouted, F.lit(False))
