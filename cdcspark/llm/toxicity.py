"""Toxicity by weak supervision: many voters, a generative label model, a linear classifier.

1. *Voters* come from labelled texts of the learning part: words and word beginnings that stand out
   in toxic ones (lexicon voters for toxic), shouting and exclamation marks (pattern voters for toxic),
   and calm writing in a text long enough to tell (pattern voters for clean). A word is taken when its
   log-likelihood ratio is beyond chance for so many words, and its odds are ``LIFT`` times the others'.
2. The *label model* knows no labels when it runs: EM estimates from the votes alone, starting from the
   rates of the labelled texts, the prior, each voter's rate of voting in both classes (its accuracy),
   and its correlation with one other voter: a vote's chance depends on the class and on the vote of a
   parent, and the parents make the tree of the strongest dependence within the classes. It runs on the
   labelled texts and on as many others, without their labels.
3. A *linear classifier* (logistic, L2) over the same evidence is trained on the posteriors.

At most ``MAX_FIT`` labelled and ``MAX_FIT`` other texts are used, those with the smallest hashes of
their ids, none of the held-out part; voters are counted in Spark and only their counts and hits reach
the driver. Scoring reads every whole text.

Cases: null and empty texts have no evidence and get the score of the intercept; without usable
labels of both kinds every score is 0; labels with a null id or value are not used; of a document's
several labels the largest counts; repeated rows keep their rows; empty tables give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Texts, codes, folded, steps

MAX_FIT = 20_000
MAX_VOTERS = 256
#: Bytes of word beginnings that count as evidence besides whole words.
STEMS = (4, 5, 6, 7)
#: Odds of a lexicon voter; letters of a text that a voter for clean needs.
LIFT, CALM = 8.0, (100, 400)
#: Least log-likelihood ratio (chi-squared of one degree): one chance in 5 million.
CHANCE = 27.5
#: Pattern voters for toxic, then for clean.
SHOUTS, PATTERNS = 2, 4

LETTER = np.zeros(256, bool)
LETTER[65:91] = LETTER[97:123] = LETTER[128:] = True


def units(t: Texts) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words and word beginnings of a step, and the text of each."""
    solid = LETTER[t.buf]
    edge = np.zeros(len(t.buf) + 1, bool)
    edge[t.bounds] = True
    before, after = np.r_[False, solid], np.r_[solid, False]
    start = np.flatnonzero(after & (~before | edge))
    end = np.flatnonzero(before & (~after | edge))
    text = np.searchsorted(t.bounds, start, "right") - 1
    low = folded(t.buf)
    out, of = [codes(low, start, end)], [text]
    for k in STEMS:
        long = end - start > k
        out.append(codes(low, start[long], start[long] + k))
        of.append(text[long])
    return np.concatenate(out), np.concatenate(of)


def patterns(t: Texts) -> np.ndarray:
    """Per text: a tenth of its letters are capitals; one byte in a hundred is an exclamation mark; neither, by ``CALM`` letters."""
    sums = lambda mask: np.diff(np.r_[0, np.cumsum(mask)][t.bounds])
    size = np.maximum(np.diff(t.bounds), 1)
    upper, letters = sums((t.buf >= 65) & (t.buf <= 90)), np.maximum(sums(LETTER[t.buf]), 1)
    shout, mark = upper * 10 >= letters, sums(t.buf == 33) * 100 >= size
    return np.stack([shout, mark, *(~shout & ~mark & (letters >= n) for n in CALM)], 1) & (np.diff(t.bounds) > 0)[:, None]


def present(t: Texts, voters: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(text, voter) once for each voter (sorted hashes) that a text holds."""
    h, of = units(t)
    at = np.minimum(np.searchsorted(voters, h), max(len(voters) - 1, 0))
    hit = voters[at] == h if len(voters) else np.zeros(len(h), bool)
    pair = np.unique(of[hit] * max(len(voters), 1) + at[hit])
    return pair // max(len(voters), 1), pair % max(len(voters), 1)


# ---------------------------------------------------------------- the models


def parents(v: np.ndarray, post: np.ndarray, least: float = 10.0, times: np.ndarray | float = 1.0) -> np.ndarray:
    """Of each voter the one that it depends on most within the classes, or -1: a maximum spanning forest.

    Edges weigh twice the texts times the conditional mutual information of two votes given the class;
    weaker ones than ``least`` are chance.
    """
    weight = np.zeros((v.shape[1], v.shape[1]))
    for p in (post * times, (1 - post) * times):
        n, one = p.sum() + 1e-9, p @ v
        both = (v * p[:, None]).T @ v
        cells = ((both, one[:, None], one[None]), (one[:, None] - both, one[:, None], n - one[None]), (one[None] - both, n - one[:, None], one[None]), (n - one[:, None] - one[None] + both, n - one[:, None], n - one[None]))
        for joint, a, b in cells:
            joint = np.maximum(joint, 0)
            weight += 2 * joint * np.log(np.maximum(joint * n, 1e-12) / np.maximum(a * b, 1e-12)) * (joint > 1e-9)
    np.fill_diagonal(weight, 0)
    m = len(weight)
    out = np.full(m, -1)
    best, via, free = np.zeros(m), np.full(m, -1), np.ones(m, bool)
    for _ in range(m):
        k = int(np.argmax(np.where(free, best, -1)))
        if best[k] >= least:
            out[k] = via[k]
        free[k] = False
        nearer = free & (weight[k] > best)
        best[nearer], via[nearer] = weight[k][nearer], k
    return out


def vote_rates(v: np.ndarray, p: np.ndarray, parent: np.ndarray, least: float) -> np.ndarray:
    """(2, voters): the rate of a vote among the texts (weighted by ``p``) on which the parent is silent, and votes.

    Without a parent both are the plain rate. Rates are drawn towards the plain one by one text, and that
    towards ``least``.
    """
    n, one = p.sum(), p @ v
    plain = np.clip((one + least) / (n + 1), 1e-5, 1 - 1e-4)
    has = np.flatnonzero(parent >= 0)
    out = np.stack([plain, plain])
    up = v[:, parent[has]]
    both, seen = np.einsum("n,nm,nm->m", p, v[:, has], up), p @ up
    out[1, has] = (both + plain[has]) / (seen + 1)
    out[0, has] = (one[has] - both + plain[has]) / (n - seen + 1)
    return np.clip(out, 1e-5, 1 - 1e-4)


def label_model(votes: np.ndarray, up: np.ndarray, down: np.ndarray, prior: float, rounds: int = 25, clean: int = 0, times: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Posterior of the positive class, and the voters' parents.

    ``votes``: 0/1 by text and voter, the last ``clean`` of them for the other class; ``up`` and ``down``:
    first guesses of the rates of a vote in the positive and the other class; ``times``: how many
    texts have each row of votes.
    """
    m = votes.shape[1]
    times = np.ones(len(votes)) if times is None else times
    n = times.sum()
    v = votes.astype(np.float64)
    speaks = np.r_[np.ones(m - clean), -np.ones(clean)]  # the class that a voter is for; it never speaks for the other
    parent = np.full(m, -1)
    rates = np.stack([np.tile(up, (2, 1)), np.tile(down, (2, 1))])
    for k in range(rounds):
        on = np.log(rates[0] / rates[1])
        off = np.log((1 - rates[0]) / (1 - rates[1]))
        wrong = on * speaks < 0
        on, off = np.where(wrong, 0, on), np.where(wrong, 0, off)
        given = v[:, np.maximum(parent, 0)] * (parent >= 0)
        each = v * (on[0] * (1 - given) + on[1] * given) + (1 - v) * (off[0] * (1 - given) + off[1] * given)
        post = 1 / (1 + np.exp(-np.clip(np.log(prior / (1 - prior)) + each.sum(1), -40, 40)))
        prior = float(np.clip((post @ times + 1) / (n + 2), 1e-3, 0.999))
        if k in (1, 5, 10):
            parent = parents(v, post, times=times)
        rates = np.stack([vote_rates(v, post * times, parent, 0.5), vote_rates(v, (1 - post) * times, parent, 0.5)])
    return post, parent


def logistic(x: np.ndarray, target: np.ndarray, l2: float = 1e-5, rounds: int = 40, times: np.ndarray | None = None) -> np.ndarray:
    """Weights, then the intercept, by Newton steps. Classes weigh the same; a row counts ``times``."""
    times = np.ones(len(x)) if times is None else times
    n, m = x.shape
    one = target > 0.5
    share = times * np.where(one, 0.5 / max(times[one].sum(), 1), 0.5 / max(times[~one].sum(), 1))
    share /= share.sum()
    a = np.c_[x, np.ones(n)].astype(np.float64)
    ridge = np.r_[np.full(m, l2), 1e-6]
    w = np.zeros(m + 1)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -40, 40)))
        grad = a.T @ (share * (p - target)) + ridge * w
        curve = (a * (share * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ a + np.diag(ridge)
        move = np.linalg.solve(curve, grad)
        w = w - move * min(1.0, 4 / max(np.abs(move).max(), 1e-9))
        if np.abs(move).max() < 1e-4:
            break
    return w


@dataclass
class Model:
    voters: np.ndarray
    weights: np.ndarray
    intercept: float

    def scores(self, t: Texts) -> np.ndarray:
        text, voter = present(t, self.voters)
        k = len(self.voters)
        z = self.intercept + np.bincount(text, self.weights[voter], len(t)) + patterns(t) @ self.weights[k:]
        return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


# ---------------------------------------------------------------- Spark


def held_out(doc_id: str) -> Column:
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1


def fit(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "toxic") -> Model | None:
    """Train on labelled rows outside the held-out third; None without both kinds of labels."""
    learn = labels.select(F.col(doc_id).alias("doc_id"), F.col(label).cast("int").alias("y")).filter("doc_id is not null and y is not null").filter(~held_out("doc_id"))
    learn = learn.groupBy("doc_id").agg(F.max("y").alias("y")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(MAX_FIT)
    learn = F.broadcast(learn)  # MAX_FIT rows at most
    every = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    texts = every.join(learn, "doc_id").select("text", "y")
    share = min(1.0, MAX_FIT / max(docs.count(), 1))
    others = every.filter(F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(1 << 30)) < int(share * (1 << 30))).filter("doc_id is not null").filter(~held_out("doc_id"))
    others = others.join(learn, "doc_id", "left_anti").select("text", F.lit(-1).alias("y"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            y = b.column(1).to_numpy()
            for t in steps(b.column(0)):
                h, of = units(t)
                pair = np.unique(np.rec.fromarrays([h, of], names="h,t"))
                h, toxic = pair.h, y[t.first + pair.t]
                one, at = np.unique(h, return_inverse=True)
                pos = np.bincount(at, toxic, len(one)).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(one.view(np.int64)), pa.array(pos), pa.array(np.bincount(at, minlength=len(one)) - pos)], ["unit", "pos", "neg"])

    totals = {r.y: r.n for r in texts.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    n_pos, n_neg = totals.get(1, 0), totals.get(0, 0)
    if not n_pos or not n_neg:
        return None
    units_ = texts.mapInArrow(count, "unit long, pos long, neg long").groupBy("unit").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    # log-likelihood ratio of a unit's texts: as toxic as it is, against as toxic as all; beyond chance for all units
    rate = n_pos / (n_pos + n_neg)
    n, share = F.col("pos") + F.col("neg"), F.col("pos") / (F.col("pos") + F.col("neg"))
    term = lambda k, q: F.when(k > 0, k * F.log(q)).otherwise(0.0)
    ratio = 2 * (term(F.col("pos"), share / rate) + term(F.col("neg"), (1 - share) / (1 - rate)))
    lift = F.col("pos") / n_pos * n_neg / (F.col("neg") + 3)  # three more than seen: what may be there unseen
    units_ = units_.filter(n > 2).select("unit", ratio.alias("ratio"), lift.alias("lift"))
    best = units_.filter((F.col("ratio") > CHANCE) & (F.col("lift") > LIFT)).orderBy(F.col("ratio").desc(), "unit").limit(MAX_VOTERS).toArrow().to_pandas()
    best = best.sort_values("unit", key=lambda s: s.astype("int64").to_numpy().view(np.uint64))
    voters = best["unit"].to_numpy(np.int64).view(np.uint64)

    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(voters)
        for b in batches:
            for t in steps(b.column(0)):
                text, voter = present(t, voters)
                row, col = np.nonzero(patterns(t))
                text, voter = np.r_[text, row], np.r_[voter, col + k]
                order = np.argsort(text, kind="stable")
                ends = np.searchsorted(text[order], np.arange(len(t) + 1)).astype(np.int32)
                yield pa.RecordBatch.from_arrays([b.column(1).slice(t.first, len(t)), pa.ListArray.from_arrays(pa.array(ends), pa.array(voter[order].astype(np.int32)))], ["y", "votes"])

    rows = texts.unionByName(others).mapInArrow(vote, "y int, votes array<int>").toArrow().to_pandas()  # 2 * MAX_FIT rows or so of voter numbers
    return train(rows, voters)


def train(rows: pd.DataFrame, voters: np.ndarray) -> Model:
    """``rows``: y (-1 where there is no label) and the numbers of the voters that vote.

    Texts with the same votes are one row from there on, with their number.
    """
    votes = np.zeros((len(rows), len(voters) + PATTERNS), bool)
    for i, v in enumerate(rows["votes"]):
        votes[i, v] = True
    y = rows["y"].to_numpy()
    up = np.clip((votes[y == 1].sum(0) + 0.5) / ((y == 1).sum() + 1), 1e-4, 0.99)
    down = np.clip((votes[y == 0].sum(0) + 0.5) / ((y == 0).sum() + 1), 1e-5, 0.99)
    clean = PATTERNS - SHOUTS
    better = np.where(np.arange(len(up)) < len(up) - clean, up >= 2 * down, down >= up)
    votes[:, ~better] = False  # no better than chance on the labelled texts: such a voter falls silent
    packed = np.ascontiguousarray(np.packbits(votes, 1))
    _, first, times = np.unique(packed.view(np.dtype((np.void, packed.shape[1])))[:, 0], return_index=True, return_counts=True)
    votes, times = votes[first].astype(np.float32), times.astype(np.float64)
    post, _ = label_model(votes, up, down, float(np.clip((y == 1).sum() / max((y >= 0).sum(), 1), 0.01, 0.9)), clean=clean, times=times)
    w = logistic(votes, post, times=times)
    return Model(voters, w[:-1], float(w[-1]))


def score(docs: DataFrame, model: Model | None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, score) of every row."""
    if model is None:
        return docs.select(F.col(doc_id).alias("doc_id"), F.lit(0.0).alias("score"))
    d = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    kind = d.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for t in steps(b.column(1)):
                yield pa.RecordBatch.from_arrays([b.column(0).slice(t.first, len(t)), pa.array(model.scores(t))], ["doc_id", "score"])

    return d.mapInArrow(run, f"doc_id {kind}, score double")


def toxicity(docs: DataFrame, labels: DataFrame, cut: float = 0.7) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every document."""
    s = score(docs, fit(docs, labels))
    return s.select("doc_id", F.coalesce(held_out("doc_id"), F.lit(False)).alias("held_out"), "score", (F.col("score") >= cut).cast("int").alias("predicted"))


def without_toxic(docs: DataFrame, labels: DataFrame, cut: float = 0.7) -> DataFrame:
    """``docs`` without the rows that score ``cut`` or more; all columns stay."""
    model = fit(docs, labels)
    if model is None:
        return docs
    names = docs.columns
    at = names.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for t in steps(b.column(at)):
                yield b.slice(t.first, len(t)).filter(pa.array(model.scores(t) < cut))

    return docs.mapInArrow(run, docs.schema)
