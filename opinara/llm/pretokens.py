"""Text cut into units that a byte-level BPE never merges across, and the library's ids for many units at a time.

A unit is a run without white space with the one space before it, or white space as the pattern of the tokenizer cuts it. The
pattern of byte-level BPE is greedy from the left and looks ahead over white space only, so encoding units one by one gives
what encoding the whole text gives. Texts that hold an added token, or the one sign whose class differs between Unicode
versions, and tokenizers of another kind go to the library as a whole.
"""

import json
import os
import re

import numpy as np
import regex
from tokenizers import Tokenizer

# The characters of the Unicode property White_Space.
WHITE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
UNEVEN = ["  ", " \n", "\n ", "\n\n", *filter(re.compile(f"(?=[^ \n])[{WHITE}]").match, map(chr, range(0x3001)))]
UNIT = re.compile(f" ?[^{WHITE}]+|[{WHITE}]+(?![^{WHITE}])|[{WHITE}]+")
# Fixed value: the published pattern of byte-level BPE, with the white space written out.
PRE_TOKEN = regex.compile(
    rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{WHITE}\p{{L}}\p{{N}}]+|[{WHITE}]+(?![^{WHITE}])|[{WHITE}]+"
)
SETTLED = re.compile("[\\x00-\\u024f\\u2010-\\u2027\\u20ac]*")  # characters whose class no Unicode version changes
UNSETTLED = "\u180e"  # the one sign whose class differs between Unicode versions


def load(path: str) -> Tokenizer:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return Tokenizer.from_file(path)


def cuts_like_byte_bpe(path: str) -> bool:
    """Whether the file is a plain byte-level BPE, for which cutting into units is exact."""
    with open(path, encoding="utf-8") as file:
        made = json.load(file)
    pre, model = made.get("pre_tokenizer") or {}, made.get("model") or {}
    return (
        pre.get("type") == "ByteLevel"
        and pre.get("use_regex", True)
        and not pre.get("add_prefix_space", True)
        and made.get("normalizer") is None
        and not made.get("truncation")
        and not made.get("padding")
        and model.get("type") == "BPE"
        and not model.get("dropout")
        and not any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in made.get("added_tokens", []))
    )


def added_strings(path: str) -> list[str]:
    with open(path, encoding="utf-8") as file:
        return [t["content"] for t in json.load(file).get("added_tokens", [])]


class Library:
    """The library's ids, for many short texts at a time."""

    def __init__(self, path: str):
        self.tokenizer = load(path)
        line_end = self.tokenizer.encode("\n", add_special_tokens=False).ids
        self.line_end = line_end[0] if cuts_like_byte_bpe(path) and len(line_end) == 1 else None
        self.words = re.compile(f" [^{WHITE}]+")

    def ids(self, texts: list[str]) -> list[bytes]:
        """Ids as little-endian unsigned 32-bit integers."""
        return [np.array(e.ids, "<u4").tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def ids_of_units(self, units: list[str]) -> list[bytes]:
        """Ids per unit. Those that are a space and a word are encoded as lines of one text: its line ends are tokens of their
        own, as a space follows each."""
        if self.line_end is None:
            return self.ids(units)
        found: dict[str, bytes] = {}
        words = list(filter(self.words.fullmatch, units))
        for at in range(0, len(words), 20_000):
            some = words[at : at + 20_000]
            ids = self.ids(["\n".join(some)])[0]
            ends = (np.flatnonzero(np.frombuffer(ids, "<u4") == self.line_end) * 4).tolist()
            starts = [0, *(e + 4 for e in ends)]
            found.update((u, ids[a:b]) for u, a, b in zip(some, starts, [*ends, len(ids)], strict=True))
        others = [u for u in units if u not in found]
        found.update(zip(others, self.ids(others), strict=True))
        return [found[u] for u in units]
