"""Cutting texts where byte-level and piece tokenizers cut as well, so that each unit is encoded once.

A unit begins at a space that stands between two plain characters (visible ASCII or the Latin-1 letters
that UTF-8 writes with a lead of 0xC3). No token of either kind of vocabulary crosses such a place: the
byte-level pattern takes a space only at a piece's front, and the piece vocabulary has no piece with a
space behind another character (``PieceAligner`` checks that). So a text's tokens are its units' tokens
in a row, and a worker keeps those of the units that it has seen. Units are told apart by two 64-bit
hashes; those with other characters simply are longer.
"""

from __future__ import annotations

import numpy as np

from .common import Texts, codes
from .token_store import IdTable

#: Units that a Python worker remembers, and bytes of what it remembers of them; beyond, it starts anew.
CACHE_UNITS = 1_000_000
CACHE_BYTES = 96 << 20


def plain_bytes() -> np.ndarray:
    out = np.zeros(256, bool)
    out[0x21:0x7F] = True
    return out


PLAIN = plain_bytes()
LETTER = np.isin(np.arange(256), [*range(0x41, 0x5B), *range(0x61, 0x7B)])
MARK = PLAIN & ~LETTER & ~np.isin(np.arange(256), [*range(0x30, 0x3A)])


def cut(t: Texts, marks: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end) of the units of a step, and the first unit of each text with one past the last.

    ``marks``: a unit also begins at a mark behind an ASCII letter, where the byte-level pattern always ends a
    piece; not for steps with a ``<|``, so that no special token is cut.
    """
    buf, n = t.buf, len(t.buf)
    begin = np.zeros(n + 1, bool)
    at = np.flatnonzero(buf == 0x20)
    at = at[(at > 1) & (at + 1 < n)]
    after = PLAIN[buf[at + 1]] | (buf[at + 1] == 0xC3)
    before = PLAIN[buf[at - 1]] | ((buf[at - 2] == 0xC3) & (buf[at - 1] >= 0x80))
    begin[at[after & before]] = True
    if marks and b"<|" not in buf.tobytes():
        begin[1:-1] |= LETTER[buf[:-1]] & MARK[buf[1:]]
    begin[t.bounds] = True
    edges = np.flatnonzero(begin)
    return edges[:-1], edges[1:], np.searchsorted(edges, t.bounds)


class Units:
    """What is known of units seen before. ``learn`` gets new units as bytes and keeps a payload of each."""

    def __init__(self):
        self.table = IdTable(np.uint8, 1 + (CACHE_UNITS - 1).bit_length())
        self.forget()

    def forget(self) -> None:
        self.table.forget()
        self.held = 0

    def learn(self, units: list[bytes]) -> None:
        raise NotImplementedError

    def numbers(self, buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Number of each unit in the order in which they were learnt."""
        a, b = (codes(buf, start, end, seed) for seed in (0, 1))
        number = self.table.find(a, b)
        new = np.flatnonzero(number < 0)
        if not len(new):
            return number
        if self.table.count and (self.table.count + len(new) > CACHE_UNITS or self.held > CACHE_BYTES):
            self.forget()
            new = np.arange(len(a))
        one = new[np.unique(np.stack([a[new], b[new]]), axis=1, return_index=True)[1]] if len(new) < 1000 else new[_first_of(a[new], b[new])]
        raw = buf.tobytes()
        self.table.fit(len(one))
        units = [raw[i:j] for i, j in zip(start[one].tolist(), end[one].tolist(), strict=True)]
        self.table.add(a[one], b[one], [b""] * len(one))
        self.held += sum(map(len, units))
        self.learn(units)
        return self.table.find(a, b)


def _first_of(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Index of the first of each different pair."""
    order = np.lexsort((b, a))
    keep = np.ones(len(a), bool)
    keep[1:] = (a[order][1:] != a[order][:-1]) | (b[order][1:] != b[order][:-1])
    return order[keep]


class Ragged:
    """Lists of numbers one after another, added to at the end."""

    def __init__(self, kind: type):
        self.flat, self.at, self.n, self.rows = np.zeros(1 << 16, kind), np.zeros(1 << 14, np.int64), 0, 0

    def add(self, values: np.ndarray, sizes: np.ndarray) -> None:
        while self.n + len(values) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        while self.rows + len(sizes) + 1 > len(self.at):
            self.at = np.concatenate([self.at, np.zeros_like(self.at)])
        self.flat[self.n : self.n + len(values)] = values
        self.at[self.rows + 1 : self.rows + 1 + len(sizes)] = self.n + np.cumsum(sizes)
        self.n, self.rows = self.n + len(values), self.rows + len(sizes)

    def take(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The values of the rows in a row, and where each one's values end."""
        size = self.at[rows + 1] - self.at[rows]
        ends = np.cumsum(size)
        total = int(ends[-1]) if len(ends) else 0
        return self.flat[np.repeat(self.at[rows] - (ends - size), size) + np.arange(total)], ends
