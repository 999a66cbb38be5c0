"""French stems for plain words, after the published Snowball rules.

Tokens reach this step as ASCII letters only (see ``keep_plain_words``), so the accented
suffixes of the published rules cannot occur and are left out.
"""

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

VOWELS = "aeiouy"
REMEMBERED_WORDS = 200_000

# Published suffix lists (fixed values).
_R2_DELETE = "ances iqUes ismes ables istes ance iqUe isme able iste eux".split()
_ATION = "atrices ateurs ations atrice ateur ation".split()
_I_VERB = """issantes issaIent issants issante issions issons issent issant issiez issais issait isses issez isse
    issa iraIent irions irons iront iriez irent irais irait irez iras irai ira ies ie ir is it i""".split()
_VERB = """eraIent erions assions assent assiez antes erons eront eriez erais erait ante ants asses asse aIent eras
    erez erai era ais ait ant iez er ez ai as a""".split()
_VERB_WITH_E = {"assions", "assent", "assiez", "antes", "ante", "ants", "asses", "asse", "aIent", "ais", "ait", "ant",
                "ai", "as", "a"}


def _region_after(word: str, start: int) -> int:
    match = re.search(r"[aeiouy][^aeiouy]", word[start:])
    return start + match.end() if match else len(word)


def _mark_consonants(word: str) -> str:
    word = re.sub(r"qu", "qU", word)
    word = re.sub(r"(?<=[aeiouy])([ui])(?=[aeiouy])", lambda m: m[1].upper(), word)
    return re.sub(r"(?<=[aeiouy])y|y(?=[aeiouy])", "Y", word)


def _suffix(word: str, suffixes) -> str:
    found = [s for s in suffixes if word.endswith(s)]
    return max(found, key=len) if found else ""


def _standard_suffix(word: str, rv: int, r1: int, r2: int) -> tuple[str, bool]:
    """The stem after the standard suffixes, and whether verb suffixes must still be tried."""

    def cut(size: int) -> str:
        return word[: len(word) - size]

    def inside(size: int, region: int) -> bool:
        return len(word) - size >= region

    suffix = _suffix(
        word,
        _R2_DELETE + _ATION + """logies logie usions utions usion ution ences ence issements issement ements ement
        amment emment ments ment ifs ives if ive eaux aux euses euse""".split(),
    )
    size = len(suffix)
    if suffix in _R2_DELETE and inside(size, r2):
        return cut(size), False
    if suffix in _ATION and inside(size, r2):
        stem = cut(size)
        if stem.endswith("ic"):
            stem = stem[:-2] if len(stem) - 2 >= r2 else stem[:-2] + "iqU"
        return stem, False
    if suffix in ("logie", "logies") and inside(size, r2):
        return cut(size) + "log", False
    if suffix in ("usion", "ution", "usions", "utions") and inside(size, r2):
        return cut(size) + "u", False
    if suffix in ("ence", "ences") and inside(size, r2):
        return cut(size) + "ent", False
    if suffix in ("issement", "issements"):
        if inside(size, r1) and cut(size)[-1:] not in VOWELS:
            return cut(size), False
        suffix = suffix[3:]
        size = len(suffix)
    if suffix in ("ement", "ements") and inside(size, rv):
        stem = cut(size)
        if stem.endswith("iv") and len(stem) - 2 >= r2:
            stem = stem[:-2]
            if stem.endswith("at") and len(stem) - 2 >= r2:
                stem = stem[:-2]
        elif stem.endswith("eus"):
            if len(stem) - 3 >= r2:
                stem = stem[:-3]
            elif len(stem) - 3 >= r1:
                stem = stem[:-1] + "x"
        elif stem.endswith(("abl", "iqU")) and len(stem) - 3 >= r2:
            stem = stem[:-3]
        return stem, False
    if suffix in ("if", "ive", "ifs", "ives") and inside(size, r2):
        stem = cut(size)
        if stem.endswith("at") and len(stem) - 2 >= r2:
            stem = stem[:-2]
            if stem.endswith("ic"):
                stem = stem[:-2] if len(stem) - 2 >= r2 else stem[:-2] + "iqU"
        return stem, False
    if suffix == "eaux":
        return cut(1), False
    if suffix == "aux" and inside(size, r1):
        return cut(2) + "l", False
    if suffix in ("euse", "euses") and (inside(size, r2) or inside(size, r1)):
        return (cut(size) if inside(size, r2) else cut(size) + "eux"), False
    if suffix in ("amment", "emment") and inside(size, rv):
        return cut(size) + suffix[0] + "nt", True
    if suffix in ("ment", "ments") and len(word) - size - 1 >= rv and word[-size - 1] in VOWELS:
        return cut(size), True
    return word, True


def _verb_suffix(word: str, rv: int, r2: int) -> str:
    suffix = _suffix(word[rv:], _I_VERB)
    start = len(word) - len(suffix)
    if suffix and start - 1 >= rv and word[start - 1] not in VOWELS:
        return word[:start]
    suffix = _suffix(word[rv:], _VERB + ["ions"])
    start = len(word) - len(suffix)
    if suffix == "ions":
        return word[:start] if start >= r2 else word
    if suffix in _VERB_WITH_E and start - 1 >= rv and word[start - 1] == "e":
        return word[: start - 1]
    return word[:start] if suffix else word


def _residual_suffix(word: str, rv: int, r2: int) -> str:
    if re.search(r"[^aious]s$", word):
        word = word[:-1]
    tail = word[rv:]
    if tail.endswith("ion") and len(word) - 3 >= r2 and len(tail) > 3 and tail[-4] in "st":
        return word[:-3]
    if tail.endswith(("ier", "Ier")):
        return word[:-3] + "i"
    return word[:-1] if tail.endswith("e") else word


def stem(word: str) -> str:
    marked = _mark_consonants(word.lower())
    if marked.startswith(("par", "col", "tap")) or re.match(r"[aeiouy]{2}", marked):
        rv = min(3, len(marked))
    else:
        vowel = re.search(r"[aeiouy]", marked[1:])
        rv = 1 + vowel.end() if vowel else len(marked)
    r1 = _region_after(marked, 0)
    r2 = _region_after(marked, r1)

    out, verbs_next = _standard_suffix(marked, rv, r1, r2)
    if verbs_next:
        out = _verb_suffix(out, rv, r2) if out == marked else _verb_suffix(out, min(rv, len(out)), r2)
    if out != marked:
        out = re.sub(r"Y$", "i", out)
    else:
        out = _residual_suffix(out, rv, r2)
    out = re.sub(r"(enn|onn|ett|ell|eill)$", lambda m: m[1][:-1], out)
    return out.lower()


def _stems(words: pa.Array, known: dict[str, str]) -> pa.Array:
    """Stems of a column of words: each distinct word once, in bounded memory."""
    if len(known) > REMEMBERED_WORDS:
        known.clear()
    encoded = words.dictionary_encode()
    distinct = encoded.dictionary.to_pylist()
    for word in distinct:
        if word not in known:
            known[word] = stem(word)
    return pa.array([known[w] for w in distinct], pa.string()).take(encoded.indices)


@F.arrow_udf(StringType())
def stem_words(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """The stem of a word; null for null."""
    known: dict[str, str] = {}
    for words in parts:
        yield _stems(words, known)


def map_lists(lists: pa.Array, change: Callable[[pa.Array], pa.Array]) -> pa.Array:
    """Lists with the values changed, all of a batch at once. A null list stays null."""
    lengths = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
    offsets = pa.array(np.r_[0, np.cumsum(lengths)], pa.int32())
    values = change(lists.flatten())
    return pa.ListArray.from_arrays(offsets, values, mask=lists.is_null() if lists.null_count else None)


@F.arrow_udf(ArrayType(StringType()))
def stem_tokens(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """Stem every token."""
    known: dict[str, str] = {}
    for tokens in parts:
        yield map_lists(tokens, lambda words: _stems(words, known))
