"""Packing documents into token windows by best fit decreasing.

Every document is its ids with the end id last. A document longer than a window is first cut into full
windows and a rest; all pieces are then placed in the order of falling length, each in the open window
with the least room that still takes it. How the pieces are placed depends on their lengths alone, so the
driver gets a histogram (a row per length, at most ``window`` of them whatever the input) and places all
pieces of one length together: windows with equal room are runs of consecutive numbers, and a segment
tree over the room left finds the tightest run. Which piece of a length is the how-many-th is counted in
Spark: within each input partition while its texts are encoded, and over the partitions by a sum.

The plan has a row for each run and length that meet. A length splits at most two runs, so there are
no more than two runs for each length and at most about sqrt(2 * window) lengths in a window: the plan is
bounded by the window's size, not by the input.

Cases: a null text is an empty one and has the end id alone; a null document id stays null; repeated rows
are documents of their own; texts of any length are encoded whole; no row makes no piece; other columns
are ignored.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Texts, scope, steps, written
from .token_store import _byte_letters
from .units import Ragged, Units, cut

WINDOW = 2048


class ByteEncoder(Units):
    """Ids of a byte-level vocabulary, unit by unit; a special token's string is that token. Letters here are those of \\p{L}."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.full = Tokenizer.from_file(path)
        self.level = _byte_letters()
        super().__init__()

    def forget(self) -> None:
        super().forget()
        self.ids = Ragged(np.uint32)

    def learn(self, units: list[bytes]) -> None:
        """Words of ASCII letters are one piece of the pattern and go to the BPE model itself; all else goes through the whole tokenizer."""
        got: list[list[int]] = [[]] * len(units)
        rest, model, level = [], self.full.model, self.level
        for i, u in enumerate(units):
            if u.isascii() and (u[1:] if u[:1] == b" " else u).isalpha():
                got[i] = [x.id for x in model.tokenize(u.decode().replace(" ", level[0x20]))]
            elif (word := u.decode())[1:].isalpha() and word[0] == " " and max(word) < "\u0100":
                got[i] = [x.id for x in model.tokenize("".join([level[b] for b in u]))]
            else:
                rest.append(i)
        for i, e in zip(rest, self.full.encode_batch([units[i].decode() for i in rest], add_special_tokens=False), strict=True):
            got[i] = e.ids
        self.ids.add(np.array(list(chain.from_iterable(got)), np.uint32), np.fromiter(map(len, got), np.int64, len(got)))

    def encode(self, t: Texts, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row with ``end_id`` after each, and the texts' bounds in them."""
        start, end, first = cut(t, marks=True)
        values, ends = self.ids.take(self.numbers(t.buf, start, end))
        bounds = np.r_[0, ends][first] + np.arange(len(t) + 1)
        out = np.empty(len(values) + len(t), np.uint32)
        hole = np.ones(len(out), bool)
        hole[bounds[1:] - 1] = False
        out[hole] = values
        out[bounds[1:] - 1] = end_id
        return out, bounds


# ---------------------------------------------------------------- the plan


class Tightest:
    """A segment tree over the room left, 0 to ``window``: which rooms have an open window."""

    def __init__(self, window: int):
        self.size = 1 << window.bit_length()
        self.some = np.zeros(2 * self.size, bool)

    def mark(self, room: int, some: bool) -> None:
        i = self.size + room
        self.some[i] = some
        while i > 1:
            i >>= 1
            self.some[i] = self.some[2 * i] or self.some[2 * i + 1]

    def at_least(self, room: int) -> int | None:
        """The least room marked that is not below ``room``."""
        i = self.size + room
        if self.some[i]:
            return room
        while i > 1:  # up until a right neighbour has one, then down to its first
            if not i & 1 and self.some[i + 1]:
                i += 1
                break
            i >>= 1
        if i <= 1:
            return None
        while i < self.size:
            i = 2 * i if self.some[2 * i] else 2 * i + 1
        return i - self.size


@dataclass
class Plan:
    """Placements by length and first rank: pieces ``rank`` on go to windows ``seq`` on, ``each`` in one, from ``offset``."""

    length: np.ndarray
    rank: np.ndarray
    seq: np.ndarray
    each: np.ndarray
    offset: np.ndarray
    windows: int

    def of(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(window, offset) of pieces."""
        place = np.empty(len(length), np.int64)
        for n in np.unique(length).tolist():  # at most ``window`` lengths
            at = np.flatnonzero(length == n)
            low, high = np.searchsorted(self.length, [n, n + 1])
            place[at] = low + np.searchsorted(self.rank[low:high], rank[at], "right") - 1
        k = rank - self.rank[place]
        each = self.each[place]
        return self.seq[place] + k // each, self.offset[place] + k % each * length


def best_fit_decreasing(lengths: dict[int, int], window: int = WINDOW) -> Plan:
    """Where all pieces go; ``lengths``: how many pieces of each length there are."""
    tree, runs = Tightest(window), [[] for _ in range(window + 1)]
    out: list[tuple[int, int, int, int, int]] = []
    opened = 0

    def put(room: int, seq: int, n: int) -> None:
        if room and n:
            runs[room].append((seq, n))
            tree.mark(room, True)

    for length in sorted(lengths, reverse=True):
        rank, left = 0, lengths[length]
        while left:
            room = tree.at_least(length)
            if room is None:
                room, seq, n = window, opened, -(-left // (window // length))
                opened += n
            else:
                seq, n = runs[room].pop()
                tree.mark(room, bool(runs[room]))
            each = room // length
            full = min(n, left // each)
            rest = left - full * each if full < n else 0  # fewer than ``each``: they share the next window
            for windows, k in ((full, each), (1 if rest else 0, rest)):
                if windows:
                    out.append((length, rank, seq, k, window - room))
                    put(room - k * length, seq, windows)
                    rank, left, seq, n = rank + windows * k, left - windows * k, seq + windows, n - windows
            put(room, seq, n)
    cols = np.array(sorted(out), np.int64).reshape(-1, 5).T
    return Plan(*cols, windows=opened)


# ---------------------------------------------------------------- in Spark

PIECES = "doc_id long, start long, length int, ids_crc32 long, doc_tokens long, part int, place long"
_encoders: dict[str, ByteEncoder] = {}


def pieces(docs: DataFrame, vocab_path: str, end_id: int, window: int, doc_id: str, text: str, with_ids: bool) -> DataFrame:
    """Pieces of all documents, each with its partition and its number among the partition's pieces of that length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = _encoders.setdefault(vocab_path, None) or ByteEncoder(vocab_path)
        _encoders[vocab_path] = enc
        seen, part = np.zeros(window + 1, np.int64), TaskContext.get().partitionId()
        for b in batches:
            for t in steps(b.column(1), 4 << 20):
                ids, bounds = enc.encode(t, end_id)
                size = np.diff(bounds)
                n = -(-size // window)
                doc = np.repeat(np.arange(len(t)), n)
                start = (np.arange(len(doc)) - np.repeat(np.cumsum(n) - n, n)) * window
                length = np.minimum(size[doc] - start, window)
                at = bounds[doc] + start
                raw = memoryview(ids.astype("<u4", copy=False).tobytes())
                parts = [raw[4 * i : 4 * j] for i, j in zip(at.tolist(), (at + length).tolist(), strict=True)]
                crc = np.fromiter(map(zlib.crc32, parts), np.int64, len(parts))
                order = np.argsort(length, kind="stable")
                count = np.bincount(length, minlength=window + 1)
                place = np.empty(len(doc), np.int64)
                place[order] = np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count) + np.repeat(seen, count)
                seen += count
                cols = [b.column(0).take(pa.array(t.first + doc)), pa.array(start), pa.array(length.astype(np.int32)), pa.array(crc), pa.array(size[doc]), pa.array(np.full(len(doc), part, np.int32)), pa.array(place)]
                names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "part", "place"]
                if with_ids:
                    cols, names = [*cols, pa.array([bytes(p) for p in parts], pa.binary())], [*names, "ids"]
                yield pa.RecordBatch.from_arrays(cols, names)

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(run, PIECES + (", ids binary" if with_ids else ""))


def pack(docs: DataFrame, vocab_path: str, end_id: int = 1, window: int = WINDOW, doc_id: str = "doc_id", text: str = "text", with_ids: bool = False) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset), and ``ids`` (32-bit, little-endian) if wanted; a row per piece."""
    with scope(docs.sparkSession) as keep:
        got = written(pieces(docs, vocab_path, end_id, window, doc_id, text, with_ids), "pieces")
        keep.append(got)
        per_part = got.groupBy("length", "part").agg(F.count(F.lit(1)).alias("n"))
        before = F.sum("n").over(Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
        counts = written(per_part.select("length", "part", "n", F.coalesce(before, F.lit(0)).alias("before")), "counts")
        keep.append(counts)
        plan = best_fit_decreasing({r.length: r.n for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}, window)  # a row per length

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            length, rank = b.column("length").to_numpy().astype(np.int64), b.column("rank").to_numpy()
            seq, offset = plan.of(length, rank)
            kept = [b.column(c) for c in names]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(seq), pa.array(offset)], [*names, "sequence_id", "offset"])

    ranked = got.join(counts.select("length", "part", "before"), ["length", "part"])
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", *(["ids"] if with_ids else [])]
    ranked = ranked.select(*[F.col("length").cast("long").alias("length") if c == "length" else c for c in names], (F.col("before") + F.col("place")).alias("rank"))
    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, " + ("ids binary, " if with_ids else "") + "sequence_id long, offset long"
    return ranked.mapInArrow(place, schema)
