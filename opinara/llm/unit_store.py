"""Values of whole batches of texts by way of their distinct units (``pretokens``): Arrow cuts and dictionary-encodes a batch, each
distinct unit is worked out once, and the rest is gathered by number.

Most texts are words with one space or line end between them and are cut at those. A text with other white space, or with a string
that must not be cut, is a unit of its own, marked by ``WHOLE``.
"""

import re
from collections.abc import Callable, Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from opinara.llm.pretokens import UNEVEN, UNIT

WHOLE = "\x00"  # starts a unit that is a whole text
FIRST = "\r"  # starts a unit that is the first word of a text, without a space before it
MOST_UNITS = 300_000  # units in memory per task, and 20 times as many values; past that it starts anew, which changes no result
BATCH_BYTES = 2_000_000

_UNEVEN = "|".join(re.escape(u) if len(u) > 1 else f"\\x{{{ord(u):x}}}" for u in UNEVEN)
_EDGES = "^[ \n]|[ \n]$"


def gather(flat: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The runs ``flat[start : start + length]`` one after another."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return flat[np.arange(total) + np.repeat(starts - (ends - lengths), lengths)]


def sums(values: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Sum of each of the runs of the given lengths that make up ``values``."""
    total = np.concatenate([[0], np.cumsum(values)])
    ends = np.cumsum(lengths)
    return total[ends] - total[ends - lengths]


def pieces(part: pa.RecordBatch, column: str = "text", most: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with about ``most`` bytes of text each; one text is never cut."""
    lengths = pc.fill_null(pc.binary_length(part.column(column)), 0).to_numpy(zero_copy_only=False)
    if not len(lengths):
        return
    number = (np.cumsum(lengths) - lengths) // most
    starts = np.flatnonzero(np.r_[True, number[1:] != number[:-1]])
    for start, end in zip(starts.tolist(), [*starts[1:].tolist(), len(lengths)], strict=True):
        yield part.slice(start, end - start)


class _Growing:
    def __init__(self, kind):
        self.held, self.size = np.zeros(1 << 16, kind), 0

    def extend(self, values: np.ndarray) -> None:
        end = self.size + len(values)
        if end > len(self.held):
            self.held = np.concatenate([self.held[: self.size], np.zeros(max(end, 2 * self.size) - self.size, self.held.dtype)])
        self.held[self.size : end] = values
        self.size = end


class Store:
    """A run of values and some columns per unit. ``of_units`` maps a list of units to the lengths of their runs, the runs one after
    another, and the columns."""

    def __init__(self, of_units: Callable[[list[str]], tuple], kind=np.uint32, columns: tuple = (), most: int = MOST_UNITS):
        self.of_units, self.kinds, self.most = of_units, (np.int64, kind, *columns), most
        self._anew()

    def _anew(self) -> None:
        self.known: dict[str, int] = {}
        self.starts = _Growing(np.int64)
        self.lengths, self.flat, *self.columns = map(_Growing, self.kinds)

    def places(self, units: list[str]) -> np.ndarray:
        """Where distinct units are in ``starts``, ``lengths`` and ``columns``. Places hold until the next call."""
        if len(self.known) > self.most or self.flat.size > 20 * self.most:
            self._anew()
        places = np.fromiter(map(self.known.get, units, repeat(-1)), np.int64, len(units))
        missing = np.flatnonzero(places < 0)
        if len(missing):
            new = [units[n] for n in missing.tolist()]
            lengths, flat, *columns = self.of_units(new)
            places[missing] = np.arange(self.starts.size, self.starts.size + len(new))
            self.known.update(zip(new, places[missing].tolist(), strict=True))
            self.starts.extend(self.flat.size + np.cumsum(lengths) - lengths)
            self.lengths.extend(lengths)
            self.flat.extend(flat)
            for held, column in zip(self.columns, columns, strict=True):
                held.extend(column)
        return places

    def gathered(self, places: np.ndarray) -> np.ndarray:
        """The runs at the places, one after another."""
        return gather(self.flat.held, self.starts.held[places], self.lengths.held[places])


def pre_token_units(text: str) -> list[str]:
    """The units of a text with any white space, for a byte-level BPE."""
    return [u[1:] if u[0] == " " and len(u) > 1 and u[1] not in "\n\r" else FIRST + u for u in UNIT.findall(text)]


def text_of(unit: str) -> str:
    """What a unit stands for."""
    return unit if unit[0] == "\n" else unit[1:] if unit[0] in (WHOLE, FIRST) else " " + unit


class Units:
    """Texts cut to units. ``kept`` are strings that must not be cut: texts with one of them are whole. With ``spaced`` a text is
    taken with a space before it, so that its first word is like any other. ``uneven`` cuts texts with other white space than one
    space or line end between words; without it they are whole."""

    def __init__(self, kept: list[str], spaced: bool, cut: bool = True, uneven: Callable[[str], list[str]] | None = None):
        self.kept = "|".join([r"\x00", *map(re.escape, kept)]) if cut else None
        self.spaced, self.uneven = spaced, uneven

    def cut(self, texts: pa.Array) -> tuple[np.ndarray, list[str], np.ndarray]:
        """For texts without nulls: the number of each unit among the distinct ones, those, and how many units each text has."""
        there = pc.greater(pc.binary_length(texts), 0)
        whole = pc.match_substring_regex(texts, self.kept) if self.kept else pa.array(np.ones(len(texts), bool))
        odd = pc.or_(whole, pc.match_substring_regex(texts, f"{_UNEVEN}|{_EDGES}"))
        plain = pc.and_(there, pc.invert(odd))
        words = texts.filter(plain)
        if not self.spaced:
            words = pc.binary_join_element_wise(FIRST, words, "")
        lists = pc.split_pattern(pc.replace_substring(words, "\n", " \n"), " ")
        counts = np.zeros(len(texts), np.int64)
        counts[plain.to_numpy(zero_copy_only=False)] = np.diff(lists.offsets.to_numpy())
        encoded = lists.flatten().dictionary_encode()
        numbers, units = encoded.indices.to_numpy().astype(np.int64), encoded.dictionary.to_pylist()
        odd = pc.and_(odd, there)
        if pc.any(odd).as_py():
            cuts = [
                [WHOLE + text] if one or self.uneven is None else self.uneven(text)
                for text, one in zip(texts.filter(odd).to_pylist(), whole.filter(odd).to_pylist(), strict=True)
            ]
            at = odd.to_numpy(zero_copy_only=False)
            counts[at] = list(map(len, cuts))
            more = pa.array([u for units_of in cuts for u in units_of]).dictionary_encode()
            merged, of_odd = np.zeros(int(counts.sum()), np.int64), np.repeat(at, counts)
            merged[~of_odd], merged[of_odd] = numbers, more.indices.to_numpy().astype(np.int64) + len(units)
            numbers, units = merged, units + more.dictionary.to_pylist()
        return numbers, units, counts
