"""Hard negatives by inner product: length buckets, sorted coordinate lists, feasible ranges.

Rows are put in order by label and falling length and dealt over shelves (partitions); a shelf's rows are cut
into blocks of one label and of nearly one length. For an anchor that needs scores of at least t, a
block whose longest row cannot reach t is passed over; in any other, a row's cosine with the anchor must
be at least t / (|anchor| * longest), which leaves each coordinate of the row, as a unit vector, a feasible
range. The block holds its rows' coordinates as sorted lists, so the ranges of the anchor's largest
coordinates (the focus) are found by binary search; rows inside all of them are candidates, and these
are scored exactly. Where the ranges leave most of a block, all its rows are scored. t is the score that
an anchor's worst kept row has so far, so no row is lost, ties included.

Two searches: the best rows of the anchor's own label give the positives; then, for all positives of an
anchor at once, the best rows of other labels with scores from ``low`` to ``high`` percent of the positive's.
Anchors travel to the shelves and pass by their blocks in a stream; each shelf gives its best rows of each anchor, and
a window over them picks the best of all. A label or length that most rows have is spread over
shelves like any other.

Cases: rows with a null id or label, a null vector, or a component that is null or not finite take no part.
Components are held to 2**26 after scaling, so that scores fit in a long for up to 1,024 of them; a
shorter vector counts as filled up with zeros. Rows alike in id, label and vector count once; rows that
share an id only are rows of their own, but none is a positive of its own id. An anchor without
positives, and a positive without a row in its range, give no row. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import _parts, hot_join, scope, written

#: Bytes of vectors that a shelf holds, rows of a block, and how much shorter than its longest row a block's rows may be.
SHELF_BYTES, BLOCK, NEARLY = 32 << 20, 4096, 0.8
#: Coordinates in focus, anchors that are scored together, and the share of a block beyond which all of it is scored.
FOCUS, GROUP, OPEN = 4, 256, 0.25
LARGEST = 1 << 26
#: Room for rounding in feasible ranges.
SLACK = 1e-9

ROWS = "vec_id long, label long, vec binary, length double"


def quantised(rows: DataFrame, vec_id: str, label: str, vector: str, scale: int) -> DataFrame:
    """Rows that take part, with components floor(scale * x) as 32-bit integers and their length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            values, at = b.column("vec").flatten().to_numpy(zero_copy_only=False), np.r_[0, np.cumsum(b.column("n").to_numpy())].astype(np.int64)
            q = np.clip(np.floor(values * scale), -LARGEST, LARGEST).astype("<i4")
            total = np.r_[0.0, np.cumsum(q.astype(np.float64) ** 2)]
            own = pa.Array.from_buffers(pa.binary(), len(b), [None, pa.py_buffer((4 * at).astype(np.int32)), pa.py_buffer(q)])
            length = np.array([np.linalg.norm(q[i:j].astype(np.float64)) for i, j in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]) if np.ptp(total) > 2.0**50 else np.sqrt(np.diff(total[at]))
            yield pa.RecordBatch.from_arrays([b.column("vec_id"), b.column("label"), own, pa.array(length)], ["vec_id", "label", "vec", "length"])

    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    good = rows.filter(F.col(vec_id).isNotNull() & F.col(label).isNotNull() & F.col(vector).isNotNull() & finite)
    return good.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(label).cast("long").alias("label"), F.col(vector).cast("array<double>").alias("vec"), F.size(vector).alias("n")).mapInArrow(run, ROWS)


# ---------------------------------------------------------------- shelves


@dataclass
class Block:
    """Rows of one label, longest first: their ids, integer vectors and, once asked for, sorted coordinates."""

    label: int
    ids: np.ndarray
    vec: np.ndarray
    length: np.ndarray
    lists: tuple[np.ndarray, np.ndarray] | None = None

    def __post_init__(self):
        self.longest = float(self.length.max())
        self.largest = int(np.abs(self.vec).max()) if self.vec.size else 0

    def sorted_lists(self) -> tuple[np.ndarray, np.ndarray]:
        """Per coordinate: the rows in its order, and its values in that order."""
        if self.lists is None:
            unit = self.vec / np.maximum(self.length, 1e-300)[:, None]
            order = np.argsort(unit, axis=0)
            self.lists = order.T.copy(), np.take_along_axis(unit, order, 0).T.copy()
        return self.lists

    def scores(self, anchors: np.ndarray, rows: np.ndarray | None = None) -> np.ndarray:
        """Inner products of all anchors with all (or some) rows; by floats where these hold them exactly."""
        vec = self.vec if rows is None else self.vec[rows]
        d = min(anchors.shape[1], vec.shape[1])
        a, v = anchors[:, :d], vec[:, :d]
        if float(np.abs(a).max(initial=0)) * self.largest * d < 2.0**53:
            return (a.astype(np.float64) @ v.T.astype(np.float64)).astype(np.int64)
        return a.astype(np.int64) @ v.T.astype(np.int64)


def as_matrix(vectors: pa.Array) -> np.ndarray:
    """Vectors as rows; shorter ones are filled up with zeros."""
    raw, at = _parts(vectors)
    values, at = raw.view("<i4"), at // 4
    size = np.diff(at)
    width = int(size.max()) if len(size) else 0
    if (size == width).all():
        return values.reshape(len(size), width)
    out = np.zeros((len(size), width), np.int32)
    out[np.repeat(np.arange(len(size)), size), np.arange(len(values)) - np.repeat(at[:-1], size)] = values
    return out


def blocks_of(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Cut rows in order of label and falling length where the label changes, the length falls, or a block is full."""
    label, length = batch.column("label").to_numpy(), batch.column("length").to_numpy()
    i, n = 0, len(label)
    while i < n:
        j = i + int(np.searchsorted(label[i : i + BLOCK], label[i], "right"))
        short = np.flatnonzero(length[i:j] < NEARLY * length[i])
        j = i + int(short[0]) if len(short) and j - i > 64 and short[0] >= 64 else j
        yield batch.slice(i, j - i)
        i = j


SHELF = "shelf int, label long, ids binary, lengths binary, vectors binary, n int"


def shelves(rows: DataFrame, n: int) -> DataFrame:
    """Blocks of the rows, ``n`` shelves of them: equal rows meet and count once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shelf = TaskContext.get().partitionId()
        before = None
        for b in batches:
            key = [b.column(c) for c in ("vec_id", "label", "vec")]
            same = np.ones(len(b), bool)  # as the row before
            for x, y in zip(key, before or key, strict=True):
                same[:1] &= bool(before) and x[:1].equals(y)
                same[1:] &= pc.equal(x[1:], x[:-1]).to_numpy(zero_copy_only=False)
            before = [x[-1:] for x in key] if len(b) else before
            for x in blocks_of(b.filter(pa.array(~same))):
                vec = as_matrix(x.column("vec"))
                cols = [pa.array([shelf], pa.int32()), x.column("label").slice(0, 1), *[pa.array([v.tobytes()], pa.binary()) for v in (x.column("vec_id").to_numpy(), x.column("length").to_numpy(), vec)], pa.array([len(x)], pa.int32())]
                yield pa.RecordBatch.from_arrays(cols, ["shelf", "label", "ids", "lengths", "vectors", "n"])

    order = [F.col("label"), F.desc("length"), F.col("vec_id"), F.col("vec")]
    return rows.repartitionByRange(n, *order).sortWithinPartitions(*order).mapInArrow(run, SHELF)


# ---------------------------------------------------------------- search


class Search:
    """The best rows in the bands of a batch of anchors, block after block.

    ``low`` and ``high``: bands of scores, an array per anchor (falling ``high``). Of each band the first ``k`` rows are kept.
    """

    def __init__(self, ids: np.ndarray, labels: np.ndarray, vec: np.ndarray, low: list[np.ndarray], high: list[np.ndarray], k: int, same: bool):
        self.ids, self.labels, self.vec, self.low, self.high, self.k, self.same = ids, labels, vec, low, high, k, same
        self.length = np.sqrt((vec.astype(np.float64) ** 2).sum(1))
        self.unit = vec / np.maximum(self.length, 1e-300)[:, None]
        self.focus = np.argsort(-np.abs(self.unit), axis=1, kind="stable")[:, :FOCUS]
        self.pool = [(np.zeros(0, np.int64), np.zeros(0, np.int64)) for _ in ids]
        self.least = np.array([x.min() if len(x) else np.iinfo(np.int64).max for x in low], np.int64)
        self.most = np.array([x.max() if len(x) else np.iinfo(np.int64).min for x in high], np.int64)

    def ranges(self, block: Block, who: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Places in the sorted lists between which each anchor's focus coordinates are feasible; and the share of rows that is to be expected inside all."""
        _, values = block.sorted_lists()
        focus = self.focus[who]
        low, high = np.zeros(focus.shape, np.int64), np.full(focus.shape, len(block.ids), np.int64)
        theta = self.least[who] / np.maximum(self.length[who] * block.longest, 1e-300)
        theta = np.clip(theta, 0.0, 1.0)[:, None]
        a = np.take_along_axis(self.unit[who], focus, 1)
        spread = np.sqrt(np.maximum(1 - a * a, 0) * (1 - theta * theta))
        top = np.where(a >= theta, 1.0, a * theta + spread) + SLACK
        bottom = np.where(a <= -theta, -1.0, a * theta - spread) - SLACK
        bound = (theta > 0) & (focus < values.shape[0])
        for f in np.unique(focus[bound]).tolist():  # a step per coordinate
            at = bound & (focus == f)
            low[at], high[at] = np.searchsorted(values[f], bottom[at], "left"), np.searchsorted(values[f], top[at], "right")
        return low, high, np.prod(np.maximum(high - low, 0) / len(block.ids), axis=1)

    def meet(self, block: Block) -> None:
        wanted = (self.labels == block.label) == self.same
        reach = self.length * block.longest * (1 + SLACK) + 1
        who = np.flatnonzero(wanted & (self.least <= reach) & (self.most >= -reach))
        for i in range(0, len(who), GROUP):
            self._meet(block, who[i : i + GROUP])

    def _meet(self, block: Block, who: np.ndarray) -> None:
        if (self.least[who] > 0).any():
            low, high, share = self.ranges(block, who)
        else:
            share = np.ones(len(who))
        some = np.flatnonzero(share >= OPEN)
        if len(some):
            s = block.scores(self.vec[who[some]])
            row, col = np.nonzero((s >= self.least[who[some]][:, None]) & (s <= self.most[who[some]][:, None]))
            cuts = np.searchsorted(row, np.arange(len(some) + 1))
            for j, (x, y) in zip(who[some].tolist(), zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True), strict=True):
                if x < y:
                    self.add(j, s[row[x], col[x:y]], block.ids[col[x:y]])
        for j in np.flatnonzero((share > 0) & (share < OPEN)).tolist():
            rows = self.candidates(block, who[j], low[j], high[j])
            if len(rows):
                s = block.scores(self.vec[who[j] : who[j] + 1], rows)[0]
                ok = (s >= self.least[who[j]]) & (s <= self.most[who[j]])
                self.add(int(who[j]), s[ok], block.ids[rows[ok]])

    def candidates(self, block: Block, j: int, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Rows inside all feasible ranges."""
        order, _ = block.sorted_lists()
        seen = np.zeros(len(block.ids), np.uint8)
        for f, x, y in zip(self.focus[j].tolist(), low.tolist(), high.tolist(), strict=True):
            if f < len(order):
                seen[order[f, x:y]] += 1
            else:
                seen += 1
        return np.flatnonzero(seen == len(low))

    def add(self, j: int, scores: np.ndarray, ids: np.ndarray) -> None:
        if self.same:
            scores, ids = scores[ids != self.ids[j]], ids[ids != self.ids[j]]
        s, i = np.r_[self.pool[j][0], scores], np.r_[self.pool[j][1], ids]
        order = np.lexsort((i, -s))
        s, i = s[order], i[order]
        self.pool[j] = s, i
        keep, least = np.zeros(len(s), bool), np.iinfo(np.int64).max
        for band, low in enumerate(self.low[j].tolist()):  # a few
            begin, last = self.places(j, band)
            keep[begin:last] = True
            least = min(least, low if last - begin < self.k else int(s[last - 1]))
        self.pool[j], self.least[j] = (s[keep], i[keep]), least

    def places(self, j: int, band: int) -> tuple[int, int]:
        """Where an anchor's kept rows of a band begin and end: the first ``k`` of it."""
        s = -self.pool[j][0]
        begin, end = np.searchsorted(s, -self.high[j][band], "left"), np.searchsorted(s, -self.low[j][band], "right")
        return int(begin), int(min(begin + self.k, max(begin, end)))


def searched(index: DataFrame, n_shelves: int, anchors: DataFrame, k: int, same: bool) -> DataFrame:
    """(anchor, low, high, other, score): each shelf's best ``k`` rows in each band of each anchor that came to it.

    ``anchors``: shelf, anchor (its number), vec_id, label, vec, low and high (arrays of bounds).
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[Block]] = {}
        for b in batches:
            shelf = b.column("shelf").to_numpy()
            kind = b.column("ids").is_valid().to_numpy(zero_copy_only=False)
            for i in np.flatnonzero(kind).tolist():
                n = b.column("n")[i].as_py()
                part = lambda c, t: np.frombuffer(b.column(c)[i].as_buffer(), t)  # noqa: B023, E731
                held.setdefault(int(shelf[i]), []).append(Block(b.column("label")[i].as_py(), part("ids", "<i8"), part("vectors", "<i4").reshape(n, -1), part("lengths", "<f8")))
            rest = np.flatnonzero(~kind)
            for s in np.unique(shelf[rest]).tolist():
                own = b.take(pa.array(rest[shelf[rest] == s]))
                low, high = ([np.array(x, np.int64) for x in own.column(c).to_pylist()] for c in ("low", "high"))
                find = Search(own.column("vec_id").to_numpy(), own.column("label").to_numpy(), as_matrix(own.column("vec")), low, high, k, same)
                for block in held.get(s, ()):
                    find.meet(block)
                kept = [(i, low[i][j], high[i][j], *find.pool[i], *find.places(i, j)) for i in range(len(own)) for j in range(len(low[i]))]
                n = [last - begin for *_, begin, last in kept]
                if sum(n):
                    each = lambda k: pa.array(np.repeat([x[k] for x in kept], n).astype(np.int64))  # noqa: B023, E731
                    rows = [pa.array(np.concatenate([x[k][x[5] : x[6]] for x in kept])) for k in (4, 3)]
                    yield pa.RecordBatch.from_arrays([own.column("anchor").take(each(0)), each(1), each(2), *rows], ["anchor", "low", "high", "other", "score"])
            held = {s: x for s, x in held.items() if s == shelf[-1]} if len(b) else held  # rows come shelf by shelf

    fields = "shelf int, anchor long, vec_id long, label long, vec binary, low array<bigint>, high array<bigint>, ids binary, lengths binary, vectors binary, n int"
    names = [x.split()[0] for x in fields.split(", ")]
    both = [df.select(*[F.col(c) if c in df.columns else F.lit(None).cast(t).alias(c) for c, t in (x.split() for x in fields.split(", "))]) for df in (index, anchors)]
    dealt = both[0].unionByName(both[1]).repartitionById(n_shelves, F.col("shelf")).sortWithinPartitions("shelf", F.col("ids").isNull())
    return dealt.select(*names).mapInArrow(run, "anchor long, low long, high long, other long, score long")


def mine(rows: DataFrame, every: int = 100, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90, scale: int = 256, vec_id: str = "vec_id", label: str | Column = "label", vector: str = "embedding") -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score): hard negatives of the anchors, rows with ids divisible by ``every``.

    ``low`` and ``high``: percent of the positive's score that a negative's may have.
    """
    spark = rows.sparkSession
    with scope(spark) as keep:
        named = rows.select(F.col(vec_id).alias("vec_id"), (F.col(label) if isinstance(label, str) else label).alias("label"), F.col(vector).alias("vec"))
        data = written(quantised(named, "vec_id", "label", "vec", scale), "rows")
        n, size = data.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("vec") + 16), F.lit(0))).first()
        n_shelves = max(1, -(-size // SHELF_BYTES), min(spark.sparkContext.defaultParallelism, n // BLOCK))
        index = written(shelves(data, n_shelves), "index")
        top = index.agg(F.max("shelf")).first()[0]
        n_shelves = 1 if top is None else top + 1
        anchors = data.filter(F.pmod("vec_id", F.lit(every)) == 0).select("vec_id", "label", "vec").distinct()
        anchors = written(anchors.withColumn("anchor", F.monotonically_increasing_id()), "anchors")
        keep += [anchors]

        # the shelves of a label are neighbours: an anchor goes to those of its own
        places = index.groupBy("label").agg(F.min("shelf").alias("first"), F.max("shelf").alias("last"), F.sum("n").alias("rows"))
        weights = places.select("label", F.struct("first", "last").alias("at"), "rows")
        bound = lambda x: F.array(F.lit(x).cast("long"))
        own = hot_join(anchors, weights, ["label"], "rows").select("anchor", "vec_id", "label", "vec", F.explode(F.sequence("at.first", "at.last")).alias("shelf"), bound(-(1 << 62)).alias("low"), bound(1 << 62).alias("high"))
        found = searched(index, n_shelves, own, positives, True)
        by_score = Window.partitionBy("anchor").orderBy(F.desc("score"), "other")
        best = found.withColumn("place", F.row_number().over(by_score)).filter(F.col("place") <= positives)
        best = written(best.select("anchor", "place", F.col("other").alias("positive_id"), F.col("score").alias("positive_score")), "positives")
        keep += [best]

        share = lambda of, way: F.expr(f"cast({way}(cast(positive_score as decimal(20)) * {of} / 100) as bigint)")
        bands = written(best.withColumns({"low": share(low, "ceil"), "high": share(high, "floor")}).filter("low <= high"), "bands")
        keep += [bands]
        asked = bands.groupBy("anchor").agg(F.array_sort(F.collect_set(F.struct(F.col("high"), F.col("low")))).alias("b"))  # at most ``positives``
        asked = anchors.join(asked, "anchor").select("anchor", "vec_id", "label", "vec", F.transform("b", lambda x: x["low"]).alias("low"), F.transform("b", lambda x: x["high"]).alias("high"), F.explode(F.sequence(F.lit(0), F.lit(n_shelves - 1))).alias("shelf"))
        first = Window.partitionBy("anchor", "low", "high").orderBy(F.desc("score"), "other")
        others = searched(index, n_shelves, asked, negatives, False).withColumn("rank", F.row_number().over(first))
        others = written(others.filter(F.col("rank") <= negatives), "others")
        keep += [others]
    out = bands.join(others, ["anchor", "low", "high"]).join(anchors.select("anchor", F.col("vec_id").alias("anchor_id")), "anchor")
    return out.select("anchor_id", "positive_id", "rank", F.col("other").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))


#: The same by brute force, for ``mine`` with the label rule of the registered query.
SQL = """
WITH r AS (SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, a.label = r.label AS same, r.vec_id, CAST(list_dot_product(a.v, r.v) AS BIGINT) AS score FROM r a JOIN r ON a.vec_id % 100 = 0 AND r.vec_id <> a.vec_id),
p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
n AS (SELECT p.*, s.vec_id AS negative_id, s.score AS negative_score, row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY s.score DESC, s.vec_id) AS rank
  FROM p JOIN s ON p.anchor_id = s.anchor_id AND NOT s.same AND 30 * positive_score <= 100 * s.score AND 100 * s.score <= 90 * positive_score)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 10
"""
