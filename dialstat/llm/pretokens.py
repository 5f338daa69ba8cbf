"""Vectorised splitting of texts into the pieces that byte-pair merges never cross.

Both tokenizer files split a text by a regular expression over letters, numbers, white space and
other characters before merging.  The pieces follow from runs of character classes, found here
with numpy over the code points of many texts at once.  That serves texts of characters of the
basic plane that Unicode has had since 3.2, so every library agrees on their classes, and, where
a tokenizer normalises, that stay what they are (:data:`SETTLED`, :data:`COMPOSED`).  Other
texts are left to the tokenizer's own splitter by the callers.

Pieces are identified by a 64-bit hash, so a batch needs each distinct piece once.
"""

from __future__ import annotations

import sys
import types
import unicodedata

import numpy as np
import pandas as pd

PLAIN_LIMIT = 0x10000
LETTER, NUMBER, SPACE, OTHER, BREAK = range(5)  # BREAK: the seam between two texts
_U = np.uint64
_SEED = np.random.default_rng(0xB9E)
_VALUE = _SEED.integers(1, 2**63, PLAIN_LIMIT + 1, dtype=np.uint64) * _U(2) + _U(1)
_BASE = 0xD1342543DE82EF95


def _class_of(c: str) -> int:
    if c.isspace() and c not in "\x1c\x1d\x1e\x1f":
        return SPACE
    return {"L": LETTER, "N": NUMBER}.get(unicodedata.category(c)[0], OTHER)


def _settled(c: str) -> bool:
    return unicodedata.ucd_3_2_0.category(c) not in ("Cn", "Cs", "Co")


def _seconds() -> set[str]:
    """Characters that compose with the one before them."""
    pairs = (unicodedata.decomposition(chr(c)) for c in range(PLAIN_LIMIT))
    split = (p.split() for p in pairs if p and not p.startswith("<"))
    return {chr(int(p[1], 16)) for p in split if len(p) == 2} | {chr(c) for c in range(0x1100, 0x1200)}


_CHARS = [chr(c) for c in range(PLAIN_LIMIT)]
_SECONDS = _seconds()
CLASS = np.array([_class_of(c) for c in _CHARS] + [BREAK], dtype=np.uint8)
# Characters whose class is settled; of them, those that composing (NFC) leaves alone in any text.
SETTLED = np.array([_settled(c) for c in _CHARS] + [False])
COMPOSED = SETTLED & np.array(
    [
        unicodedata.category(c)[0] != "M" and c not in _SECONDS and unicodedata.normalize("NFC", c) == c
        for c in _CHARS
    ]
    + [False]
)


def code_points(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(code points of all texts, each followed by one seam; row bounds of the texts)."""
    joined = "\x00".join(texts) + "\x00"
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype=np.uint32).copy()
    ends = np.cumsum([len(t) + 1 for t in texts])
    points[ends - 1] = PLAIN_LIMIT
    return points, np.concatenate([[0], ends])


def seal_odd_rows(points: np.ndarray, bounds: np.ndarray, odd: list[bool], served: np.ndarray) -> np.ndarray:
    """Mark the rows that are served here; the others (``odd``, or a character that is not
    ``served``) become all seam, so no piece comes from them."""
    strange = ~served[np.minimum(points, PLAIN_LIMIT)]
    strange[bounds[1:] - 1] = False
    plain = ~np.asarray(odd, dtype=bool)
    plain[np.searchsorted(bounds, np.flatnonzero(strange), side="right") - 1] = False
    for row in np.flatnonzero(~plain).tolist():
        points[bounds[row] : bounds[row + 1]] = PLAIN_LIMIT
    return plain


def _contractions(points: np.ndarray) -> np.ndarray:
    """Length of a contraction ('s 't 'm 'd 're 've 'll) that starts at each code point, else 0."""
    out = np.zeros(len(points), dtype=np.int64)
    at = np.flatnonzero(points == ord("'"))
    at = at[at < len(points) - 2]
    one, two = points[at + 1], points[at + 2]
    out[at[np.isin(one, [ord(c) for c in "stmd"])]] = 2
    for a, b in ("re", "ve", "ll"):
        out[at[(one == ord(a)) & (two == ord(b))]] = 3
    return out


def _runs(points: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(class of each code point, run starts, run ends) of the runs of one class; a seam is a run."""
    kind = CLASS[points]
    edge = np.empty(len(kind), dtype=bool)
    edge[0] = True
    np.not_equal(kind[1:], kind[:-1], out=edge[1:])
    edge |= kind == BREAK
    starts = np.flatnonzero(edge)
    return kind, starts, np.append(starts[1:], len(points))


def _pieces(begins: np.ndarray, kind: np.ndarray, dropped: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray]:
    """Pieces from a mask of their begins, without those that begin with a dropped class."""
    begin = np.flatnonzero(begins)
    end = np.append(begin[1:], len(kind))
    kept = ~np.isin(kind[begin], dropped)
    return begin[kept], end[kept]


def _cut_contractions(begins: np.ndarray, points: np.ndarray, at: np.ndarray) -> None:
    """Make contractions at ``at`` pieces; the letters after them begin where they end."""
    short = _contractions(points)[at]
    at, short = at[short > 0], short[short > 0]
    begins[at + 1] = False
    begins[at + short] = True


def split_blank_prefixed(points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pieces of the byte-level splitter: contractions, runs with one leading blank, white space.

    A white-space run before something else gives up its last character: a blank joins the next
    piece, another character is a piece of its own.
    """
    kind, starts, ends = _runs(points)
    run = kind[starts]
    begins = np.zeros(len(points), dtype=bool)
    begins[starts] = True
    space = run == SPACE
    s, e = starts[space], ends[space]
    gives = kind[np.minimum(e, len(kind) - 1)] != BREAK  # something follows inside the text
    s, e = s[gives], e[gives]
    blank = points[e - 1] == 0x20
    begins[e - 1] = True
    begins[e[blank]] = False  # the piece after the blank begins with the blank
    # a run of one apostrophe without a blank before it may start a contraction
    lone = starts[(run == OTHER) & (ends - starts == 1)]
    lone = lone[(points[lone] == ord("'")) & begins[lone]]
    _cut_contractions(begins, points, lone)
    return _pieces(begins, kind, (BREAK,))


def split_words(points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pieces of the word splitter: contractions, runs of letters, single numbers, runs of others;
    white space is dropped."""
    kind, starts, ends = _runs(points)
    begins = kind == NUMBER
    begins[starts] = True
    lone = starts[(kind[starts] == OTHER) & (ends - starts == 1)]
    _cut_contractions(begins, points, lone[points[lone] == ord("'")])
    return _pieces(begins, kind, (SPACE, BREAK))


class KeyNumbers:
    """Numbers of 64-bit keys in an open-addressing table of numpy arrays."""

    def __init__(self, bits: int = 16):
        self.size, self._bits = 0, bits
        self._keys = np.zeros(1 << bits, dtype=np.uint64)  # 0: empty
        self._numbers = np.zeros(1 << bits, dtype=np.int32)

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * _U(0x9E3779B97F4A7C15)) >> _U(64 - self._bits)).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Numbers of distinct keys (not 0), -1 for unknown ones."""
        out = np.full(len(keys), -1, dtype=np.int64)
        todo, slots, last = np.arange(len(keys)), self._slots(keys), (1 << self._bits) - 1
        while len(todo):
            held = self._keys[slots]
            hit = held == keys[todo]
            out[todo[hit]] = self._numbers[slots[hit]]
            on = ~hit & (held != 0)
            todo, slots = todo[on], (slots[on] + 1) & last
        return out

    def add(self, keys: np.ndarray) -> np.ndarray:
        """Number keys that are distinct and unknown, from the table's size on."""
        numbers = self.size + np.arange(len(keys))
        self.size += len(keys)
        while 2 * self.size > 1 << self._bits:
            held = np.flatnonzero(self._keys)
            old_keys, old_numbers = self._keys[held], self._numbers[held]
            self._bits += 1
            self._keys = np.zeros(1 << self._bits, dtype=np.uint64)
            self._numbers = np.zeros(1 << self._bits, dtype=np.int32)
            self._place(old_keys, old_numbers)
        self._place(keys, numbers)
        return numbers

    def _place(self, keys: np.ndarray, numbers: np.ndarray) -> None:
        todo, slots, last = np.arange(len(keys)), self._slots(keys), (1 << self._bits) - 1
        while len(todo):
            free = self._keys[slots] == 0
            self._keys[slots[free]] = keys[todo[free]]  # of several keys for a slot one stays
            placed = self._keys[slots] == keys[todo]
            self._numbers[slots[placed]] = numbers[todo[placed]]
            todo, slots = todo[~placed], (slots[~placed] + 1) & last


class PieceTable:
    """Distinct pieces of a worker, numbered as they are met; numbers stand for pieces."""

    def __init__(self):
        self._table = KeyNumbers()
        self._up = self._down = np.ones(1, dtype=np.uint64)

    def __len__(self) -> int:
        return self._table.size

    def clear(self) -> None:
        self._table = KeyNumbers()

    def number(self, points: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(number of every piece, places in ``begin`` of the pieces that are new, in the order of
        their numbers)."""
        if len(self._up) <= len(points):
            size = max(len(points) + 1, 1 << 20)
            for name, base in (("_up", _BASE), ("_down", pow(_BASE, -1, 2**64))):
                steps = np.full(size, base, dtype=np.uint64)
                steps[0] = 1
                setattr(self, name, np.cumprod(steps, dtype=np.uint64))
        sums = np.zeros(len(points) + 1, dtype=np.uint64)
        np.cumsum(_VALUE[points] * self._up[: len(points)], out=sums[1:])
        keys = (sums[end] - sums[begin]) * self._down[begin] + (end - begin).astype(np.uint64)
        keys ^= keys >> _U(31)
        keys *= _U(0x9FB21C651E98DF25)
        keys |= _U(1)  # never the empty key
        codes, distinct = pd.factorize(keys)
        numbers = self._table.find(distinct)
        new = np.flatnonzero(numbers < 0)
        if not len(new):
            return numbers[codes], new
        numbers[new] = self._table.add(distinct[new])
        first = np.empty(len(distinct), dtype=np.int64)
        first[codes[::-1]] = np.arange(len(codes) - 1, -1, -1)
        return numbers[codes], first[new]


class IdPool:
    """Token ids of numbered pieces, in one growing array."""

    def __init__(self):
        self._ids, self._bounds = np.zeros(1 << 12, dtype=np.uint32), np.zeros(1 << 12, dtype=np.int64)
        self.pieces = 0

    @staticmethod
    def _room(array: np.ndarray, used: int, more: int) -> np.ndarray:
        if used + more <= len(array):
            return array
        grown = np.zeros(max(2 * len(array), used + more), dtype=array.dtype)
        grown[:used] = array[:used]
        return grown

    def add(self, ids: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Append pieces; returns their numbers."""
        numbers, used = self.pieces + np.arange(len(sizes)), int(self._bounds[self.pieces])
        self._ids = self._room(self._ids, used, len(ids))
        self._bounds = self._room(self._bounds, self.pieces + 1, len(sizes))
        self._ids[used : used + len(ids)] = ids
        self._bounds[self.pieces + 1 : self.pieces + 1 + len(sizes)] = used + np.cumsum(sizes)
        self.pieces += len(sizes)
        return numbers

    def gather(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of the pieces one after the other, bounds per piece)."""
        begin = self._bounds[numbers]
        sizes = self._bounds[numbers + 1] - begin
        total = np.concatenate([[0], np.cumsum(sizes)])
        return self._ids[np.arange(total[-1]) - np.repeat(total[:-1] - begin, sizes)], total


def joined_lines(points: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[str, np.ndarray]:
    """(pieces as one text, a line break after each, bounds of the lines)."""
    sizes = end - begin + 1
    bounds = np.concatenate([[0], np.cumsum(sizes)])
    at = np.arange(bounds[-1]) - np.repeat(bounds[:-1] - begin, sizes)
    out = points[np.minimum(at, len(points) - 1)] if len(points) else points
    out[bounds[1:] - 1] = ord("\n")
    return out.astype("<u4").tobytes().decode("utf-32-le"), bounds


# Byte-level tokenizers write a byte as a printable character: printable Latin-1 stands for
# itself, the other bytes follow in order from U+0100.
def byte_characters() -> list[str]:
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    spare = iter(range(0x100, 0x200))
    return [chr(b) if b in shown else chr(next(spare)) for b in range(256)]


def worker_keeps(name: str, source: str, make):
    """An object kept in a Python worker between tasks, made anew for another source.

    What it holds must be bounded; a new worker starts without it.
    """
    kept = sys.modules.setdefault("_kept_between_tasks", types.ModuleType("_kept_between_tasks")).__dict__
    if kept.get(name, (None,))[0] != source:
        kept[name] = (source, make(source))
    return kept[name][1]
