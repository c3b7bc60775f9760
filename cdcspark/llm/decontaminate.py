"""Benchmark decontamination: BM25 with block-max WAND, then question and answer overlap.

The test items are indexed: per term a list of (item, impact) by item number, in blocks of
``BLOCK`` items with each block's largest impact. An impact is the term's BM25 share of the item's
own score, so a passage that holds all of an item scores 1. Every text is cut into passages that
overlap by the longest item, and every passage is a query for all items of score ``THETA`` or more:

* block bounds: the sum of the block maxima of the passage's terms; a block under the threshold
  cannot hold a hit (computed for all passages of a step at once);
* WAND in what is left: terms by their next item, pivot where the summed term maxima reach the
  threshold, the pivot's block maxima checked before it is scored, skips to the end of the block.

A hit counts when the passage holds ``overlap`` of the item's five-word shingles (three quarters)
and half of both its question (the words before the last sentence) and its answer (the rest).

An item of more than ``PART`` words is indexed in parts of that length at most, which overlap so that
every shingle lies in one of them: a text that holds ``overlap`` of the item holds as much of one part.
A part that is hit has the whole item compared with passages of twice the item's length around it; the
score of such an item is that of its best part there.

A shard is ``SHARD`` items or ``SHARD_BYTES`` of their text, or a single longer item; more items are
more shards, whose hits are written before the next shard is built. Words are lower-cased letters and digits.

Cases: null and empty texts have no hits; items without a word are skipped; items of fewer than five
words have one shingle of all words, looked for among the passage's runs of as many; repeated documents and items report each; a document's hit is
reported once per item with its best passage; empty tables give no rows.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Texts, codes, folded, mix, powers, steps, written

K1, B = 1.2, 0.75
THETA = 0.6
BLOCK = 8
SHARD = 4096
SHARD_BYTES = 1 << 22
#: Most words of an item that are indexed as one.
PART = 512
#: Sums of block maxima that are made at once.
CELLS = 1 << 22

WORD = np.zeros(256, bool)
WORD[48:58] = WORD[65:91] = WORD[97:123] = WORD[128:] = True


def terms(t: Texts) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of a step, and each text's first word."""
    solid = WORD[t.buf]
    edge = np.zeros(len(t.buf) + 1, bool)
    edge[t.bounds] = True
    before, after = np.r_[False, solid], np.r_[solid, False]
    start = np.flatnonzero(after & (~before | edge))
    end = np.flatnonzero(before & (~after | edge))
    return codes(folded(t.buf), start, end), np.searchsorted(start, t.bounds)


def grams(h: np.ndarray, width: int) -> np.ndarray:
    """Hashes of the runs of ``width`` words; of all words if there are fewer."""
    n = min(width, len(h))
    if n == 0:
        return h
    m = powers(width + 1)[0]
    return mix(sum(mix(h[j : len(h) - n + j + 1]) * m[j + 1] for j in range(n)))


@dataclass
class Item:
    place: int
    number: int
    length: int
    shingles: np.ndarray  # in order of the item
    question: int  # the first so many belong to the question

    def overlaps(self, passage: np.ndarray, width: int) -> tuple[float, float, float]:
        has = np.isin(self.shingles, grams(passage, min(width, self.length)))
        q, a = has[: self.question], has[self.question :]
        return float(has.mean()), float(q.mean()) if len(q) else 1.0, float(a.mean()) if len(a) else 1.0


class Index:
    """Inverted index of one shard of items, with the block maxima of each term's own blocks.

    ``corpus``: number of parts of all items, their mean length and a function from terms to how many
    parts have each; without it the shard is all there is.
    """

    def __init__(self, rows: list[tuple[int, str]], width: int, corpus: tuple[int, float, Callable[[np.ndarray], np.ndarray]] | None = None):
        self.width = width
        self.items: list[Item] = []  # the item of each part
        sizes = []
        lists: dict[int, list[tuple[int, float]]] = {}
        bags = []
        for number, text in rows:
            cut = max((text.rstrip(" .!?").rfind(c) for c in ".!?"), default=-1)
            parts = [terms(Texts(0, np.frombuffer(x.encode(), np.uint8), np.array([0, len(x.encode())])))[0] for x in (text, text[: cut + 1])]
            h = parts[0]
            if not len(h):
                continue
            g = grams(h, width)
            item = Item(len(bags), number, len(h), g, min(max(len(parts[1]) - width + 1, 0), len(g)))
            for part in parts_of(h, width):
                self.items.append(item)
                sizes.append(len(part))
                bags.append(np.unique(part, return_counts=True))
        n = len(self.items)
        self.vocab, df = np.unique(np.concatenate([t for t, _ in bags]) if bags else np.zeros(0, np.uint64), return_counts=True)
        total, mean = n, sum(sizes) / max(n, 1)
        if corpus:
            total, mean = corpus[:2]
            df = corpus[2](self.vocab)
        idf_of = np.log(1 + (total - df + 0.5) / (df + 0.5))
        for k, (t, c) in enumerate(bags):
            idf = idf_of[np.searchsorted(self.vocab, t)]
            impact = idf * c * (K1 + 1) / (c + K1 * (1 - B + B * sizes[k] / mean))
            for x, s in zip(t.tolist(), (impact / impact.sum()).tolist(), strict=True):
                lists.setdefault(x, []).append((k, s))
        self.posts = [([k for k, _ in lists[x]], [s for _, s in lists[x]]) for x in self.vocab.tolist()]
        self.upper = [max(s) for _, s in self.posts]
        self.block, self.blocks = BLOCK, -(-n // BLOCK)
        # the blocks that a term's postings lie in, and its largest impact in each
        self.peaks: list[dict[int, float]] = []
        for ks, ss in self.posts:
            top: dict[int, float] = {}
            for k, x in zip(ks, ss, strict=True):
                top[k // BLOCK] = max(top.get(k // BLOCK, 0.0), x * 1.000001)
            self.peaks.append(top)
        self.peak_at = np.r_[0, np.cumsum([len(x) for x in self.peaks])].astype(np.int64)
        self.peak_block = np.array([k for x in self.peaks for k in x], np.int64)
        self.peak_value = np.array([v for x in self.peaks for v in x.values()])
        self.longest = max(sizes, default=0)

    def bounds(self, term: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
        """(n, blocks): sums of the block maxima of the terms of each of ``n`` passages."""
        size = self.peak_at[term + 1] - self.peak_at[term]
        ends = np.cumsum(size)
        at = np.repeat(self.peak_at[term] - (ends - size), size) + np.arange(int(ends[-1]) if len(ends) else 0)
        return np.bincount(np.repeat(owner, size) * self.blocks + self.peak_block[at], self.peak_value[at], n * self.blocks).reshape(n, self.blocks)

    def wand(self, query: np.ndarray, open_blocks: np.ndarray, theta: float) -> list[tuple[int, float]]:
        """Items of score ``theta`` or more for the distinct term numbers ``query``."""
        lists = [self.posts[t] for t in query.tolist()]
        upper = [self.upper[t] for t in query.tolist()]
        at = [0] * len(lists)
        ends = [len(items) for items, _ in lists]
        after = np.append(np.flatnonzero(open_blocks), self.blocks).tolist()  # open blocks, then the end
        out, start = [], 0

        def seek(item: int) -> None:
            for i, (items, _) in enumerate(lists):
                if at[i] < ends[i] and items[at[i]] < item:
                    at[i] = bisect_left(items, item, at[i])

        while True:
            block = after[bisect_left(after, start // self.block)]
            if block * self.block > start:  # to the next open block
                start = block * self.block
            if block == self.blocks:
                return out
            seek(start)
            live = sorted((lists[i][0][at[i]], i) for i in range(len(lists)) if at[i] < ends[i])
            total, pivot = 0.0, None
            for item, i in live:
                total += upper[i]
                if total >= theta:
                    pivot = item
                    break
            if pivot is None:
                return out
            if pivot >= (block + 1) * self.block:
                start = pivot
                continue
            # block maxima of the terms up to the pivot; below the threshold, go on at the next term's item
            bound = sum(self.peaks[query[i]].get(block, 0.0) for item, i in live if item <= pivot)
            if bound < theta:
                start = min([(block + 1) * self.block] + [item for item, _ in live if item > pivot])
                continue
            score = 0.0
            for i, (items, impacts) in enumerate(lists):
                k = bisect_left(items, pivot, at[i])
                if k < ends[i] and items[k] == pivot:
                    score += impacts[k]
            if score >= theta:
                out.append((pivot, score))
            start = pivot + 1

    def hits(self, h: np.ndarray, first: np.ndarray, theta: float) -> Iterator[tuple[int, Item, float, np.ndarray]]:
        """(text, item, score, words of the passage) of a step's passages."""
        long: dict[tuple[int, int, int], tuple[float, Item]] = {}
        if not len(self.vocab) or not len(h):
            return
        at = np.minimum(np.searchsorted(self.vocab, h), len(self.vocab) - 1)
        word = np.flatnonzero(self.vocab[at] == h)
        if not len(word):
            return
        term, text = at[word], np.searchsorted(first, word, "right") - 1
        # a passage is two strides long and begins at each stride, so a word lies in two of them
        stride = max(self.longest, 1)
        chunk = (word - first[text]) // stride
        text, chunk, term = np.r_[text, text], np.r_[chunk, chunk - 1], np.r_[term, term]
        ok = chunk >= 0
        wide = int(chunk.max()) + 1
        passage, where = np.unique(text[ok] * wide + chunk[ok], return_inverse=True)
        pair = np.unique(where * len(self.vocab) + term[ok])
        owner, term = pair // len(self.vocab), pair % len(self.vocab)
        start = np.searchsorted(owner, np.arange(len(passage) + 1))
        step = max(1, CELLS // (max(self.blocks, 1) * 64))  # passages whose bounds are summed at once
        for lo in range(0, len(passage), step):
            hi = min(lo + step, len(passage))
            at = slice(start[lo], start[hi])
            open_ = self.bounds(term[at], owner[at] - lo, hi - lo) >= theta * 0.999
            for k in np.flatnonzero(open_.any(1)).tolist():
                p = lo + k
                i, c = divmod(int(passage[p]), wide)
                a = first[i] + c * stride
                words_ = h[a : min(a + 2 * stride, first[i + 1])]
                for part, score in self.wand(term[start[p] : start[p + 1]], open_[k], theta):
                    item = self.items[part]
                    if item.length <= PART:
                        yield i, item, score, words_
                        continue
                    # the item's own passages, two of its lengths long, that meet this one
                    for d in range(max(c * stride // item.length - 1, 0), (c * stride + len(words_) - 1) // item.length + 1):
                        if score > long.get((i, item.place, d), (0.0,))[0]:
                            long[i, item.place, d] = score, item
        for (i, _, d), (score, item) in long.items():
            yield i, item, score, h[first[i] + d * item.length : min(first[i] + (d + 2) * item.length, first[i + 1])]


def parts_of(h: np.ndarray, width: int) -> Iterator[np.ndarray]:
    """The words of an item in parts of ``PART`` words at most, which overlap so that every shingle lies in one."""
    n = max(len(h) - width + 1, 1)
    edges = np.linspace(0, n, -(-n // max(PART - width + 1, 1)) + 1).astype(int).tolist()
    for lo, hi in zip(edges[:-1], edges[1:], strict=True):
        yield h[lo : hi + width - 1]


def term_counts(items: DataFrame, text: str, width: int) -> tuple[int, float, DataFrame]:
    """Number of parts of all items, their mean length, and (term, n): in how many parts a term is."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for t in steps(b.column(0)):
                h, first = terms(t)
                every = [p for i in range(len(t)) if first[i + 1] > first[i] for p in parts_of(h[first[i] : first[i + 1]], width)]
                one, n = np.unique(np.concatenate([np.unique(p) for p in every]) if every else np.zeros(0, np.uint64), return_counts=True)
                at = len(one) + 1  # the last row: parts and their words
                yield pa.RecordBatch.from_arrays([pa.array(np.r_[one.view(np.int64), 0], mask=np.arange(at) == at - 1), pa.array(np.r_[n, len(every)].astype(np.int64)), pa.array(np.r_[np.zeros(at - 1, np.int64), sum(map(len, every))])], ["term", "n", "words"])

    rows = items.select(F.coalesce(F.col(text).cast("string"), F.lit("")).alias("t")).mapInArrow(run, "term long, n long, words long").groupBy("term").agg(F.sum("n").alias("n"), F.sum("words").alias("words"))
    rows = written(rows, "terms")
    of = rows.filter("term is null").first()
    return (of.n or 0, (of.words or 0) / max(of.n or 0, 1), rows.filter("term is not null").select("term", "n")) if of else (0, 1.0, rows.select("term", "n"))


def shards(items: DataFrame, item_id: str, text: str, width: int) -> Iterator[tuple[Index, bool]]:
    """The items' indexes by id, and whether it is the last; items stream to the driver, a shard at a time.

    With several shards all use the counts of all items, made in Spark, so a score does not hang on the
    items that share a shard; of these counts a shard's own terms come to the driver.
    """
    rows: list[tuple[int, str]] = []
    size, corpus = 0, None
    spark = items.sparkSession

    def index(rows: list[tuple[int, str]], last: bool) -> tuple[Index, bool]:
        nonlocal corpus
        if corpus is None and not last:
            n, mean, counts = term_counts(items, text, width)

            def df(vocab: np.ndarray) -> np.ndarray:
                own = F.broadcast(spark.createDataFrame(pa.table({"term": pa.array(vocab.view(np.int64))})))  # the terms of a shard
                got = counts.join(own, "term").toArrow()
                out = np.ones(len(vocab))
                out[np.searchsorted(vocab, got["term"].to_numpy().view(np.uint64))] = got["n"].to_numpy()
                return out

            corpus = (n, mean, df)
        return Index(rows, width, corpus), last

    for r in items.select(F.col(item_id).alias("i"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("t")).orderBy("i", "t").toLocalIterator():
        n = len(r.t.encode())
        if rows and (len(rows) == SHARD or size + n > SHARD_BYTES):
            yield index(rows, False)
            rows, size = [], 0
        rows.append((r.i, r.t))
        size += n
    if rows:
        yield index(rows, True)


def search(docs: DataFrame, items: DataFrame, theta: float = THETA, overlap: float = 0.75, width: int = 5, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """(doc_id, item_id, score, overlap, question_overlap, answer_overlap): documents that hold an item."""
    d = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    kinds = (d.schema["doc_id"].dataType.simpleString(), items.schema[item_id].dataType.simpleString())
    out = None
    for index, last in shards(items, item_id, item_text, width):
        shared = docs.sparkSession.sparkContext.broadcast(index)  # SHARD_BYTES of items, or one longer item

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            ix = shared.value
            for b in batches:
                for t in steps(b.column(1)):
                    best: dict[tuple[int, int], tuple] = {}
                    for i, item, score, passage in ix.hits(*terms(t), theta):
                        whole, q, a = item.overlaps(passage, ix.width)
                        if whole >= overlap and q >= 0.5 and a >= 0.5:
                            k = item.place
                            best[i, k] = max(best.get((i, k), (0.0,)), (whole, score, q, a))
                    if best:
                        at = pa.array([t.first + i for i, _ in best])
                        cols = list(zip(*best.values(), strict=True))
                        yield pa.RecordBatch.from_arrays([b.column(0).take(at), pa.array([ix.items[k].number for _, k in best]), *(pa.array(cols[c], pa.float64()) for c in (1, 0, 2, 3))], ["doc_id", "item_id", "score", "overlap", "question_overlap", "answer_overlap"])

        part = d.mapInArrow(run, f"doc_id {kinds[0]}, item_id {kinds[1]}, score double, overlap double, question_overlap double, answer_overlap double")
        if not last:
            part = written(part, "hits")
            shared.unpersist()
        out = part if out is None else out.unionByName(part)
    if out is None:
        return docs.sparkSession.createDataFrame([], f"doc_id {kinds[0]}, item_id {kinds[1]}, score double, overlap double, question_overlap double, answer_overlap double")
    return out


def without_items(docs: DataFrame, items: DataFrame, theta: float = THETA, overlap: float = 0.75, width: int = 5) -> DataFrame:
    """``docs`` without the rows whose text holds an item; all columns stay, nothing is shuffled."""
    at = docs.columns.index("text")
    for index, _ in shards(items, "item_id", "text", width):
        shared = docs.sparkSession.sparkContext.broadcast(index)  # SHARD_BYTES of items, or one longer item

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            ix = shared.value
            for b in batches:
                for t in steps(b.column(at)):
                    keep = np.ones(len(t), bool)
                    for i, item, _, passage in ix.hits(*terms(t), theta):
                        whole, q, a = item.overlaps(passage, ix.width)
                        if whole >= overlap and q >= 0.5 and a >= 0.5:
                            keep[i] = False
                    yield b.slice(t.first, len(t)).filter(pa.array(keep))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
