"""Alignment of two tokenizers' ids over the same bytes, with how often ids are linked in the corpus.

Each text is encoded after a space by a byte-level vocabulary (A) and a piece vocabulary (B). Where tokens
of both end at the same byte, the ids are cut into groups: the cumulative ends of each side are the keys
of a dictionary to the token's index, the keys that both have are sorted, and each slice between two of
them is a group with its links. This is done for each unit (see ``units``) once; a text's groups are its units'
groups in a row.

Tokens that end together agree backwards until the shorter one begins, so one's bytes are a suffix of the
other's. The pairs of ids that can be linked at all are therefore listed from the vocabularies alone
(``Pairs``), about eight for each id at most, and the corpus-wide counts are an array of that size: it is summed in
Spark, and only it goes to the driver and back to the tasks.

Cases: texts that are null, empty, or that B writes otherwise than they are (a U+2581 in them) have no tokens:
zeros and an empty digest. Strings of special tokens are plain text. Null ids stay, repeated rows count
each, texts of any length are aligned whole, an empty table gives no row, other columns are ignored.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Texts, _parts, scope, steps, written
from .token_store import _byte_letters
from .units import Ragged, Units, cut


@dataclass
class Vocabularies:
    """Both tokenizers and the bytes of each id; an id without bytes of its own has none."""

    a: object
    b: object
    a_bytes: list[bytes]
    b_bytes: list[bytes]

    @classmethod
    def load(cls, a_path: str, b_path: str) -> Vocabularies:
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        a, b = Tokenizer.from_file(a_path), SentencePieceProcessor(model_file=b_path)
        a.encode_special_tokens = True
        byte = {c: i for i, c in enumerate(_byte_letters())}
        a_bytes = [b""] * a.get_vocab_size()
        for token, i in a.get_vocab().items():
            a_bytes[i] = bytes(map(byte.__getitem__, token))
        b_bytes = []
        for i in range(b.get_piece_size()):
            piece = b.id_to_piece(i)
            if "▁" in piece.lstrip("▁"):
                raise ValueError("only for piece vocabularies without a space behind another character")
            b_bytes.append(bytes([int(piece[3:5], 16)]) if b.is_byte(i) else b"" if b.is_control(i) or b.is_unknown(i) else piece.replace("▁", " ").encode())
        return cls(a, b, a_bytes, b_bytes)


class Pairs:
    """All pairs of ids whose bytes are a suffix of one another, numbered."""

    def __init__(self, v: Vocabularies):
        found = {}
        of_a, of_b = by_bytes(v.a_bytes), by_bytes(v.b_bytes)
        for mine, others, flip in ((of_a, of_b, False), (of_b, of_a, True)):
            for raw, ids in mine.items():
                for k in range(len(raw)):
                    for j in others.get(raw[k:], ()):
                        for i in ids:
                            found[(j << 32 | i) if flip else (i << 32 | j)] = None
        self.keys = np.sort(np.fromiter(found, np.int64, len(found)))
        self.b_id = (self.keys & 0xFFFFFFFF).astype(np.int64)

    def number(self, keys: np.ndarray) -> np.ndarray:
        at = np.searchsorted(self.keys, keys)
        if len(keys) and not (self.keys[np.minimum(at, len(self.keys) - 1)] == keys).all():
            raise ValueError("a link of tokens that are no suffix of one another")
        return at

    def best(self, counts: np.ndarray) -> np.ndarray:
        """Which pairs have the highest count of their B id."""
        top = np.zeros(int(self.b_id.max()) + 1, np.int64)
        np.maximum.at(top, self.b_id, counts)
        return counts == top[self.b_id]


def by_bytes(vocabulary: list[bytes]) -> dict[bytes, list[int]]:
    out: dict[bytes, list[int]] = {}
    for i, raw in enumerate(vocabulary):
        if raw:
            out.setdefault(raw, []).append(i)
    return out


def align(a_ids: list[int], a_sizes: list[int], b_ids: list[int], b_sizes: list[int]) -> Iterator[tuple[list[int], list[int], list[tuple[int, int]]]]:
    """Groups of A and B ids between common ends, each with its links (pairs of ids that end together)."""
    ends = []
    for sizes in (a_sizes, b_sizes):
        at, own = 0, {}
        for i, n in enumerate(sizes):
            at += n
            own.setdefault(at, []).append(i)  # a token without bytes ends where the one before does
        ends.append(own)
    low_a = low_b = 0
    for end in sorted(ends[0].keys() & ends[1].keys()):
        last_a, last_b = ends[0][end], ends[1][end]
        high_a, high_b = last_a[-1] + 1, last_b[-1] + 1
        yield a_ids[low_a:high_a], b_ids[low_b:high_b], [(a_ids[i], b_ids[j]) for i in last_a for j in last_b]
        low_a, low_b = high_a, high_b


class PieceAligner(Units):
    """Aligned units: each one's groups as text, its numbers of tokens and groups, and its links as numbered pairs."""

    def __init__(self, a_path: str, b_path: str):
        self.v = Vocabularies.load(a_path, b_path)
        self.pairs = Pairs(self.v)
        super().__init__()

    def forget(self) -> None:
        super().forget()
        self.links, self.texts, self.sizes = Ragged(np.uint32), [], Ragged(np.int64)

    def learn(self, units: list[bytes]) -> None:
        texts = [u.decode() for u in units]
        got_a = [e.ids for e in self.v.a.encode_batch(texts, add_special_tokens=False)]
        got_b = self.v.b.encode([x[1:] for x in texts], num_threads=1)  # it adds the space
        a_bytes, b_bytes = self.v.a_bytes, self.v.b_bytes
        keys, n_links, sizes = [], [], []
        for unit, a_ids, b_ids in zip(units, got_a, got_b, strict=True):
            a_raw, b_raw = [a_bytes[i] for i in a_ids], [b_bytes[i] for i in b_ids]
            same = b"".join(a_raw) == unit == b"".join(b_raw)
            groups = list(align(a_ids, list(map(len, a_raw)), b_ids, list(map(len, b_raw)))) if same else []
            self.texts.append(b";".join(f"{','.join(map(str, a))}|{','.join(map(str, b))}".encode() for a, b, _ in groups))
            links = [x << 32 | y for _, _, pairs in groups for x, y in pairs]
            keys += links
            n_links.append(len(links))
            sizes += [len(a_ids), len(b_ids), len(groups), not same]
            self.held += len(self.texts[-1]) + 8 * len(links)
        self.links.add(self.pairs.number(np.array(keys, np.int64)), np.array(n_links, np.int64))
        self.sizes.add(np.array(sizes, np.int64), np.full(len(units), 4))

    def aligned(self, t: Texts) -> Iterator[tuple[int, int, int, str, bytes]]:
        """(tokens of A, of B, groups, digest of the groups, pair numbers of the links) of each text."""
        n = np.diff(t.bounds)
        bounds = np.r_[0, np.cumsum(n + (n > 0))]
        buf = np.full(bounds[-1], 0x20, np.uint8)
        own = np.ones(len(buf), bool)
        own[bounds[:-1][n > 0]] = False  # a space before each text
        buf[own] = t.buf
        start, end, first = cut(Texts(t.first, buf, bounds))
        number = self.numbers(buf, start, end)
        links, ends = self.links.take(number)
        at = np.r_[0, ends][first].tolist()
        total = np.r_[np.zeros((1, 4), np.int64), np.cumsum(self.sizes.flat[: self.sizes.n].reshape(-1, 4)[number], axis=0)][first]
        sums, raw, first = np.diff(total, axis=0).tolist(), memoryview(links.astype("<u4").tobytes()), first.tolist()
        texts, number = self.texts, number.tolist()
        for k, (a, b, groups, bad) in enumerate(sums):
            if bad or first[k] == first[k + 1]:
                yield 0, 0, 0, "", b""
            else:
                text = b";".join([texts[i] for i in number[first[k] : first[k + 1]]])
                yield a, b, groups, hashlib.sha256(text).hexdigest(), bytes(raw[4 * at[k] : 4 * at[k + 1]])


_aligners: dict[tuple[str, str], PieceAligner] = {}


def aligner(a_path: str, b_path: str) -> PieceAligner:
    if (a_path, b_path) not in _aligners:
        _aligners[a_path, b_path] = PieceAligner(a_path, b_path)
    return _aligners[a_path, b_path]


def link_counts(aligned: DataFrame, n_pairs: int) -> np.ndarray:
    """How often each pair is linked in the corpus: summed in tasks, then over them; a row per pair reaches the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(n_pairs, np.int64)
        for b in batches:
            total += np.bincount(_parts(b.column(0))[0].view("<u4"), minlength=n_pairs)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], ["pair", "n"])

    got = aligned.select("links").mapInArrow(run, "pair int, n long").groupBy("pair").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(n_pairs, np.int64)
    out[got["pair"].to_numpy()] = got["n"].to_numpy()
    return out


def align_tokenizers(docs: DataFrame, a_path: str, b_path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256): a row per document.

    ``n_best``: links whose pair is the most frequent one of its B id in the corpus; ``count_sum``: the sum of
    the links' corpus-wide counts.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with_ = aligner(a_path, b_path)
        for batch in batches:
            for t in steps(batch.column(1), 2 << 20):
                a, b, groups, digest, links = zip(*with_.aligned(t), strict=True)
                cols = [pa.array(x, pa.int64()) for x in (a, b, groups)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(t.first, len(t)), *cols, pa.array(digest), pa.array(links, pa.binary())], ["doc_id", "n_a", "n_b", "n_groups", "groups_sha256", "links"])

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    pairs = aligner(a_path, b_path).pairs
    with scope(docs.sparkSession) as keep:
        got = written(rows.mapInArrow(run, "doc_id long, n_a long, n_b long, n_groups long, groups_sha256 string, links binary"), "aligned")
        keep.append(got)
        counts = link_counts(got, len(pairs.keys))
    best = pairs.best(counts)

    def rated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            raw, at = _parts(b.column("links"))
            found, at = raw.view("<u4"), at // 4
            total = lambda x: np.diff(np.r_[0, np.cumsum(x, dtype=np.int64)][at])
            add = {"n_links": np.diff(at), "n_best": total(best[found]), "count_sum": total(counts[found])}
            yield pa.RecordBatch.from_arrays([*[b.column(c) for c in plain], *[pa.array(v, pa.int64()) for v in add.values()]], [*plain, *add])

    plain = ["doc_id", "n_a", "n_b", "n_groups", "groups_sha256"]
    return got.mapInArrow(rated, "doc_id long, n_a long, n_b long, n_groups long, groups_sha256 string, n_links long, n_best long, count_sum long")
