"""Exact Jaccard join on word n-grams by vertical partitioning.

Every text becomes its set of distinct word shingles (64-bit hashes). Equal sets form one class, named
by 64 bits of the set; a second, independent name tells whether two sets share a name by chance, and
then all are named anew. One member stands for its class.

1. *Classes without a partner.* Of a fixed part of the shingles (``SAMPLE`` of all hashes) those that
   one class alone has are counted. A class that has too many of them to reach the threshold with any
   other goes no further; that is most of an ordinary corpus. Shingles are packed by ranges of hashes
   for the exchange, and one that several classes of a task have travels without them.
2. *Global order* of the shingles of the classes left, rare ones first, by exact counts. Frequent ones
   (over ``HEAVY`` plus twice the mean of a table of ``CELLS`` counters) are counted in that table by
   cell and never gathered; all others are counted in the range of hashes they belong to. Shingles of
   one class are dropped: they come first in its order, and only their number matters.
3. *Candidates.* Of two sets over the threshold the smaller one has a shingle of the other within its
   first seventh (for 75 percent), the larger one within its first quarter. In a small group (a
   shingle's sets) every pair is a candidate. In a large one a leader meets all others: the set whose
   shingles are the most frequent ones on average, as that is the one most others are copies of.
4. *Vertical counts.* The order is cut into ``FRAGMENTS`` stretches of equal weight. Each set is
   cut there too; a candidate's overlap is counted in each fragment by itself and summed per pair.
5. *Components* of the links, by alternating star contraction in Spark.
6. *Later turns.* What is left are pairs of large groups, neither of them a leader, whose components
   differ. Turn by turn about ``LEADERS`` more sets of a group lead, four times as many each time, and
   meet only sets of other components, each pair in the group of the first shingle that both have; in the
   last turn all pairs that still differ meet, a large group over a grid of tasks (``GRID``). Sets that
   meet are candidates only if their signatures allow it: parities of the shingles by hash, of which no
   more can differ than shingles do. So no link between components is missed, and what is counted in
   step 4 follows the links, not the pairs of a group; the comparisons of signatures in the last turn
   are still those of all pairs of a group that differ.

Cases: null and empty texts have no shingles, link with nothing and are their own component; a text
of fewer words than ``width`` has one shingle of all its words; repeated rows are equal sets, each
with its row; ties in the order fall to the hash; other columns of any name are ignored; an empty
table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Texts, codes, distinct_by_text, in_map, key_map, lower_ascii, mix, scope, shingles, steps, words, written

#: Hashes below this belong to the part of all shingles that the first step looks at: three eighths.
SAMPLE = np.uint64(3 << 61)
#: Bits of the number of counters (a table of 8 MB whatever the input), and the least count of a frequent shingle.
CELL_BITS, HEAVY = 20, 64
CELL_BLOCKS = 64
FRAGMENTS = 4
LEADERS, TURNS = 4, 4
#: Groups of up to so many times ``LEADERS`` sets are done in turn 1.
MIDDLING = 16
#: Sets of a group in a task of the last turn, and the most words of a signature.
GRID, SIGNATURE = 4096, 64
RANK_BITS = 57
#: Shingles that a task holds before it packs them.
FLUSH = 1 << 21

# ---------------------------------------------------------------- sets and their names


def sets_of(t: Texts, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of a step and the text of each, by text."""
    buf = lower_ascii(t.buf)
    w = words(Texts(t.first, buf, t.bounds))
    return distinct_by_text(*shingles(codes(buf, w.start, w.end), w.first, width))


def names_of(hashes: np.ndarray, bounds: np.ndarray, salt: int) -> np.ndarray:
    """Name of each set: from the sum of its mixed hashes; 0 for the empty set. Salts are independent."""
    sums = np.concatenate([[np.uint64(0)], np.cumsum(mix(hashes ^ mix(np.array([0x5851F42D4C957F2D + salt], np.uint64))), dtype=np.uint64)])
    n = np.diff(bounds)
    got = mix((sums[bounds[1:]] - sums[bounds[:-1]]) + n.astype(np.uint64) * np.uint64(0x2545F4914F6CDD1D))
    return np.where(n > 0, got, np.uint64(0)).view(np.int64)


def order_keys(rank: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Places in the global order: the class of the count (high bits), then the hash (low bits)."""
    return ((rank.astype(np.uint64) << np.uint64(RANK_BITS)) | (mix(hashes) >> np.uint64(64 - RANK_BITS))).astype(np.int64)


def rank_of(counts: np.ndarray) -> np.ndarray:
    return np.minimum(np.round(2 * np.log2(counts + 1.0)), 63).astype(np.uint8)


def signatures(keys: np.ndarray, of: np.ndarray, n: int, words: int) -> np.ndarray:
    """Of each of ``n`` sets the parities of its keys in 64 * ``words`` cells, as rows of 64-bit words."""
    cell = ((mix(keys.view(np.uint64)) >> np.uint64(32)) % np.uint64(64 * words)).astype(np.int64)
    odd = np.bincount(of * (64 * words) + cell, minlength=n * 64 * words) & 1
    return np.packbits(odd.astype(bool).reshape(n, -1), axis=1, bitorder="little").view(np.int64)


# ---------------------------------------------------------------- packing by ranges of hashes


def _binaries(values: np.ndarray, ends: np.ndarray) -> pa.Array:
    """Binary values: stretches of ``values`` between the element offsets ``ends``."""
    size = (ends * values.itemsize).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(ends) - 1, [None, pa.py_buffer(size), pa.py_buffer(np.ascontiguousarray(values))])


def bucket_of(hashes: np.ndarray, buckets: int) -> np.ndarray:
    return (((hashes & np.uint64(0xFFFFFFFF)) * np.uint64(buckets)) >> np.uint64(32)).astype(np.int32)


PACKED = "bucket int, owners binary, counts binary, hashes binary, shared binary"


def pack(hashes: np.ndarray, cls: np.ndarray, shared: np.ndarray, buckets: int, by: np.ndarray | None = None) -> dict[str, pa.Array]:
    """Columns of ``PACKED``: of each bucket the classes, how many hashes each has, the hashes; and ``shared`` ones.

    Buckets are ranges of the hashes, or of what is given in ``by``.
    """
    bucket = bucket_of(hashes if by is None else by, buckets)
    rank = np.lexsort((cls, bucket))
    hashes, cls, bucket = hashes[rank], cls[rank], bucket[rank]
    new = np.flatnonzero(np.r_[True, (bucket[1:] != bucket[:-1]) | (cls[1:] != cls[:-1])]) if len(cls) else np.zeros(0, np.int64)
    runs = np.diff(np.r_[new, len(cls)]).astype(np.uint32)
    own = bucket_of(shared, buckets)
    shared, own = shared[np.argsort(own, kind="stable")], np.sort(own)
    every = np.arange(buckets + 1)
    a, b, c = (np.searchsorted(x, every) for x in (bucket[new], bucket, own))
    used = np.flatnonzero((np.diff(b) > 0) | (np.diff(c) > 0))
    cols = {"bucket": pa.array(every[:-1].astype(np.int32)), "owners": _binaries(cls[new], a), "counts": _binaries(runs, a), "hashes": _binaries(hashes, b), "shared": _binaries(shared, c)}
    return {k: v.take(pa.array(used)) for k, v in cols.items()}


def by_bucket(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch | tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Rows that are not packed as they come; (hashes, classes, shared) of each bucket, whose rows follow each other."""
    held: dict[str, list[bytes]] = {}
    last = None
    names = ("owners", "counts", "hashes", "shared")
    kinds = (np.int64, np.uint32, np.uint64, np.uint64)

    def done() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        owners, counts, hashes, shared = (np.frombuffer(b"".join(held[k]), t) for k, t in zip(names, kinds, strict=True))
        return hashes, np.repeat(owners, counts), shared

    for b in batches:
        packed = b.column("hashes").is_valid()
        rest = b.filter(pa.compute.invert(packed))
        if rest.num_rows:
            yield rest
        part = b.filter(packed)
        for k, *row in zip(part.column("bucket").to_pylist(), *(part.column(n).to_pylist() for n in names), strict=True):
            if k != last:
                if held:
                    yield done()
                held, last = {n: [] for n in names}, k
            for n, v in zip(names, row, strict=True):
                held[n].append(v)
    if held:
        yield done()


def _gathered(batches: Iterator[pa.RecordBatch], solve) -> Iterator[pa.RecordBatch]:
    """``solve(rows, hashes, classes)`` of each bucket: its rows that are not packed, and what the others hold."""
    rows: list[pa.RecordBatch] = []
    packed: list[tuple[np.ndarray, np.ndarray]] = []
    last = None

    def done() -> Iterator[pa.RecordBatch]:
        if rows:
            none = (np.zeros(0, np.uint64), np.zeros(0, np.int64))
            yield from solve(rows, *(np.concatenate(x) for x in zip(none, *packed, strict=True)))

    for b in batches:
        bucket = b.column("bucket").to_numpy()
        edges = np.r_[0, np.flatnonzero(np.diff(bucket)) + 1, len(bucket)].tolist() if len(bucket) else [0]
        for lo, hi in zip(edges[:-1], edges[1:], strict=True):
            if bucket[lo] != last:
                yield from done()
                rows, packed, last = [], [], bucket[lo]
            for x in by_bucket(iter([b.slice(lo, hi - lo)])):
                if isinstance(x, pa.RecordBatch):
                    rows.append(x)
                else:
                    packed.append(x[:2])
    yield from done()


def distinct_members(hashes: np.ndarray, cls: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash, class) pairs once, by hash."""
    rank = np.lexsort((cls, hashes))
    h, c = hashes[rank], cls[rank]
    keep = np.ones(len(h), bool)
    keep[1:] = (h[1:] != h[:-1]) | (c[1:] != c[:-1])
    return h[keep], c[keep]


def _batch(schema: pa.Schema, n_rows: int, **columns: pa.Array) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([columns[f.name].cast(f.type) if f.name in columns else pa.nulls(n_rows, f.type) for f in schema], schema=schema)


# ---------------------------------------------------------------- the join


def least_overlap(n: Column, percent: int) -> Column:
    """Least overlap for two sets of ``n`` shingles together: ceil(percent * n / (100 + percent))."""
    return F.ceil(n * percent / F.lit(100 + percent))


class Join:
    def __init__(self, docs: DataFrame, doc_id: str, text: str, width: int, percent: int):
        self.docs = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text")).withColumn("k", F.xxhash64("doc_id"))
        self.width, self.percent, self.kind = width, percent, self.docs.schema["doc_id"].dataType.simpleString()
        self.spark = docs.sparkSession
        self.parts = max(int(self.spark.conf.get("spark.sql.shuffle.partitions")), self.docs.rdd.getNumPartitions())

    def bucketed(self, rows: DataFrame) -> DataFrame:
        return rows.repartition(self.parts, "bucket").sortWithinPartitions("bucket")

    # -------------------------------------------------------- step 1

    def named(self, salt: int) -> DataFrame:
        """Rows (doc_id, k, n, cls, again) of all texts, and packed ones: how many shingles of a range a class has alone."""
        width, buckets = self.width, 2 * self.parts
        out = f"doc_id {self.kind}, k long, n long, cls long, again long"

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            schema, seen, held, size = None, set(), [], 0

            def flush() -> Iterator[pa.RecordBatch]:
                h, c = (np.concatenate(x) for x in zip(*held, strict=True))
                if not len(h):
                    return
                rank = np.argsort(h, kind="stable")
                h, c = h[rank], c[rank]
                same = h[1:] == h[:-1]
                many = np.r_[False, same] | np.r_[same, False]
                cols = pack(h[~many], c[~many], h[many & ~np.r_[False, same]], buckets)
                yield _batch(schema, len(cols["bucket"]), **cols)

            for b in batches:
                if schema is None:
                    schema = pa.schema([b.schema.field(0), ("k", pa.int64()), ("n", pa.int64()), ("cls", pa.int64()), ("again", pa.int64()), ("bucket", pa.int32()), *((x, pa.binary()) for x in ("owners", "counts", "hashes", "shared"))])
                for t in steps(b.column(1)):
                    h, of = sets_of(t, width)
                    bounds = np.searchsorted(of, np.arange(len(t) + 1))
                    cls, again, n = names_of(h, bounds, 2 * salt), names_of(h, bounds, 2 * salt + 1), np.diff(bounds)
                    k = b.column(2).slice(t.first, len(t))
                    where = pa.array((k.to_numpy().view(np.uint64) % np.uint64(buckets)).astype(np.int32))
                    yield _batch(schema, len(t), doc_id=b.column(0).slice(t.first, len(t)), k=k, n=pa.array(n), cls=pa.array(cls), again=pa.array(again), bucket=where)
                    new = np.zeros(len(t), bool)
                    for i, c in enumerate(cls.tolist()):
                        if c not in seen:
                            seen.add(c)
                            new[i] = True
                    take = (h < SAMPLE) & new[of]
                    held.append((h[take], cls[of[take]]))
                    size += len(held[-1][0])
                    if size > FLUSH or len(seen) > 1_000_000:
                        yield from flush()
                        held, size = [], 0
                        if len(seen) > 1_000_000:
                            seen.clear()
            if held:
                yield from flush()

        def alone(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            first = next(batches, None)
            if first is None:
                return
            schema = first.schema
            for x in by_bucket(chain([first], batches)):
                if isinstance(x, pa.RecordBatch):
                    yield x
                    continue
                h, c = distinct_members(x[0], x[1])
                every = np.concatenate([h, x[2], x[2]])
                rank = np.argsort(every, kind="stable")
                s = every[rank]
                edge = np.r_[True, s[1:] != s[:-1], True]
                own, n = np.unique(c[rank[edge[1:] & edge[:-1]]], return_counts=True)
                cols = pack(n.astype(np.uint64), own, np.zeros(0, np.uint64), buckets, own.view(np.uint64))
                yield _batch(schema, len(cols["bucket"]), **cols)

        packed = self.docs.select("doc_id", "text", "k").mapInArrow(run, f"{out}, {PACKED}")
        return written(self.bucketed(packed).mapInArrow(alone, f"{out}, {PACKED}"), "named")

    def classes(self, named: DataFrame) -> DataFrame:
        """(cls, n, k, rows, clash) of each class; ``clash`` where different sets have one name."""

        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for n, cls, _ in by_bucket(batches):  # a class is in one bucket
                own, at = np.unique(cls, return_inverse=True)
                yield pa.RecordBatch.from_arrays([pa.array(own), pa.array(np.bincount(at, n).astype(np.int64))], ["cls", "alone"])

        sets = named.filter("hashes is null and n > 0").groupBy("cls").agg(F.max("n").alias("n"), F.min("k").alias("k"), (F.min("again") != F.max("again")).alias("clash"))
        alone = self.bucketed(named.filter("hashes is not null").select(*[x.split()[0] for x in PACKED.split(", ")])).mapInArrow(add, "cls long, alone long")
        left = F.col("n") - F.coalesce("alone", F.lit(0))  # that another class may have
        return sets.join(alone, "cls", "left").select("cls", "n", "k", "clash", (100 * left >= self.percent * F.col("n")).alias("open"))

    # -------------------------------------------------------- step 2

    def open_sets(self, classes: DataFrame, salt: int) -> DataFrame:
        """(cls, n, hashes) of a text of each open class (and of a few others)."""
        width = self.width
        shared = self.spark.sparkContext.broadcast(key_map(classes, "k"))  # a map of fixed size

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                b = b.filter(pa.array(in_map(shared.value, b.column(1).to_numpy())))
                for t in steps(b.column(0)):
                    h, of = sets_of(t, width)
                    bounds = np.searchsorted(of, np.arange(len(t) + 1))
                    lists = pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(h.view(np.int64)))
                    yield pa.RecordBatch.from_arrays([pa.array(names_of(h, bounds, 2 * salt)), pa.array(np.diff(bounds)), lists], ["cls", "n", "hashes"])

        return written(self.docs.select("text", "k").mapInArrow(run, "cls long, n long, hashes array<long>"), "open")

    def heavy(self, sets: DataFrame) -> np.ndarray:
        """Rank of each cell of shingles that is frequent; 0 for the others."""
        per = (1 << CELL_BITS) // CELL_BLOCKS

        def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros(1 << CELL_BITS, np.int64)
            for b in batches:
                h = b.column(0).flatten().to_numpy().view(np.uint64)
                total += np.bincount((h >> np.uint64(64 - CELL_BITS)).astype(np.int64), minlength=len(total))
            if total.any():
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(CELL_BLOCKS, dtype=np.int32)), _binaries(total, np.arange(CELL_BLOCKS + 1) * per)], ["block", "counts"])

        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            have: dict[int, np.ndarray] = {}
            for b in batches:
                for k, raw in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                    have[k] = have.get(k, 0) + np.frombuffer(raw, np.int64)
            for k, v in have.items():
                yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([v.tobytes()])], ["block", "counts"])

        rows = sets.select("hashes").mapInArrow(count, "block int, counts binary").repartition(CELL_BLOCKS, "block").mapInArrow(add, "block int, counts binary")
        total = np.zeros((CELL_BLOCKS, per), np.int64)
        for r in rows.toArrow().to_pylist():  # CELL_BLOCKS rows, 8 MB
            total[r["block"]] = np.frombuffer(r["counts"], np.int64)
        total = total.reshape(-1)
        return np.where(total >= HEAVY + 2 * total.mean(), rank_of(total), 0).astype(np.uint8)

    def ordered(self, sets: DataFrame) -> DataFrame:
        """(cls, n, keys): the shingles that other classes have as well, in the global order."""
        level = self.spark.sparkContext.broadcast(self.heavy(sets))  # one byte per cell
        buckets = 2 * self.parts
        schema = pa.schema([("cls", pa.int64()), ("n", pa.int64()), ("keys", pa.list_(pa.int64())), ("bucket", pa.int32()), *((x, pa.binary()) for x in ("owners", "counts", "hashes", "shared"))])

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held, size, none = [], 0, np.zeros(0, np.uint64)

            def flush() -> Iterator[pa.RecordBatch]:
                cols = pack(*(np.concatenate(x) for x in zip(*held, strict=True)), none, buckets)
                yield _batch(schema, len(cols["bucket"]), **cols)

            for b in batches:
                cls, lists = b.column(0).to_numpy(), b.column(2)
                h = lists.flatten().to_numpy().view(np.uint64)
                ends = lists.offsets.to_numpy().astype(np.int64)
                of = np.repeat(np.arange(len(cls)), np.diff(ends))
                rank = level.value[(h >> np.uint64(64 - CELL_BITS)).astype(np.int64)]
                hot = rank > 0
                at = np.searchsorted(of[hot], np.arange(len(cls) + 1)).astype(np.int32)
                where = bucket_of(cls.view(np.uint64), buckets)
                yield _batch(schema, len(cls), cls=b.column(0), n=b.column(1), keys=pa.ListArray.from_arrays(pa.array(at), pa.array(order_keys(rank[hot], h[hot]))), bucket=pa.array(where))
                held.append((h[~hot], cls[of[~hot]]))
                size += len(held[-1][0])
                if size > FLUSH:
                    yield from flush()
                    held, size = [], 0
            if held:
                yield from flush()

        def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for x in by_bucket(batches):
                if isinstance(x, pa.RecordBatch):
                    yield x
                    continue
                h, c = distinct_members(x[0], x[1])
                _, at, n = np.unique(h, return_inverse=True, return_counts=True)
                n = n[at]
                many = n > 1
                cols = pack(order_keys(rank_of(n[many]), h[many]).view(np.uint64), c[many], np.zeros(0, np.uint64), buckets, c[many].view(np.uint64))
                yield _batch(schema, len(cols["bucket"]), **cols)

        def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            out = pa.schema([schema.field(i) for i in range(3)])

            def classes(rows: list[pa.RecordBatch], keys: np.ndarray, cls: np.ndarray) -> Iterator[pa.RecordBatch]:
                t = pa.Table.from_batches(rows).combine_chunks()
                own, sizes = t.column("cls").to_numpy(), t.column("n").to_numpy()
                own, at = np.unique(own, return_index=True)  # a class of several rows may come more than once
                lists = t.column("keys").combine_chunks()
                lists = lists.chunk(0) if isinstance(lists, pa.ChunkedArray) else lists
                heavy = lists.flatten().to_numpy()
                of = np.repeat(t.column("cls").to_numpy(), np.diff(lists.offsets.to_numpy()))
                cls, keys = distinct_members(np.r_[of, cls], np.r_[heavy, keys.view(np.int64)])
                ends = np.r_[np.searchsorted(cls, own), len(cls)].astype(np.int32)
                yield _batch(out, len(own), cls=pa.array(own), n=pa.array(sizes[at]), keys=pa.ListArray.from_arrays(pa.array(ends), pa.array(keys)))

            yield from _gathered(batches, classes)

        rows = self.bucketed(sets.mapInArrow(run, f"cls long, n long, keys array<long>, {PACKED}")).mapInArrow(count, f"cls long, n long, keys array<long>, {PACKED}")
        return written(self.bucketed(rows).mapInArrow(gather, "cls long, n long, keys array<long>"), "ordered")

    # -------------------------------------------------------- steps 3 and 4

    def groups(self, sets: DataFrame) -> DataFrame:
        """(key, cls, n, pos, small, m, turn): the first shingles of each set that may lead to a partner."""
        p, n = self.percent, F.col("n")
        mean = F.aggregate("keys", F.lit(0).cast("long"), lambda s, x: s + F.shiftright(x, RANK_BITS)) * 1000 / n
        sets = sets.withColumn("mean", mean.cast("int")).withColumn("u", n - F.size("keys")).withColumn("probe", (n - F.ceil(n * p / F.lit(100)) + 1).cast("int"))
        sets = sets.withColumn("index", n - F.ceil(n * (2 * p) / F.lit(100 + p)) + 1).withColumn("keys", F.slice("keys", F.lit(1), F.greatest(F.col("probe") - F.col("u"), F.lit(0)).cast("int")))
        rows = sets.select("cls", "n", "u", "index", "mean", F.posexplode("keys").alias("at", "key"))
        pos = (F.col("u") + F.col("at")).cast("int")
        rows = written(rows.select("key", "cls", F.col("n").cast("int").alias("n"), pos.alias("pos"), (pos < F.col("index")).alias("small"), "mean"), "prefixes")
        lead = F.struct((-F.col("mean")).alias("mean"), F.xxhash64("cls").alias("h"), "cls")
        group = rows.groupBy("key").agg(F.count(F.lit(1)).alias("m"), F.max("small").alias("any"), F.min(lead).alias("first")).filter("m > 1 and any").select("key", "m", F.col("first.cls").alias("first"))
        # turn 0: all of a small group, or the first of a large one; then all of a middling one, or ever more of them, by the share of a hash
        share = F.pmod(F.xxhash64("cls", F.lit(1)), F.lit(1 << 20)) * F.col("m")
        turn = F.when((F.col("m") <= LEADERS) | (F.col("cls") == F.col("first")), 0).when(F.col("m") <= MIDDLING * LEADERS, 1)
        for k in range(1, TURNS):
            turn = turn.when(share < (LEADERS * 4 ** (k - 1)) << 20, k)
        return written(rows.join(group, "key").withColumn("turn", turn.otherwise(TURNS)).drop("first", "mean"), "groups")

    def signed(self, sets: DataFrame) -> DataFrame:
        """(cls, keys) with signatures ``s0``, ``s1``, ...: of at least twice as many bits as a set has shingles on average, at most ``SIGNATURE`` words."""
        mean = sets.agg(F.avg(F.size("keys"))).first()[0] or 0
        words = 4
        while words < SIGNATURE and 32 * words < mean:
            words *= 2
        own = [f"s{i}" for i in range(words)]

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                for lo in range(0, b.num_rows, 1024):
                    part = b.slice(lo, 1024)
                    lists = part.column(1)
                    of = np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy()))
                    bits = signatures(lists.flatten().to_numpy(), of, len(lists), words)
                    yield pa.RecordBatch.from_arrays([part.column(0), lists, *(pa.array(bits[:, i]) for i in range(words))], ["cls", "keys", *own])

        return sets.select("cls", "keys").mapInArrow(run, f"cls long, keys array<long>, {', '.join(f'{x} long' for x in own)}")

    def candidates(self, rows: DataFrame, turn: int) -> DataFrame:
        """Pairs (a, b, both) of one group, led in ``turn``, that sizes and places do not rule out, each pair once.

        ``rows``: (key, cls, n, pos, small, turn, label); sets of one label need no comparison. Where rows
        also have the shingles ``before`` theirs, a pair is looked at only where it first meets; where they
        have signatures, only if those allow the overlap.
        """
        x, y, same = rows.filter(F.col("turn") == turn), rows.filter(F.col("turn") >= turn), F.col("x.key") == F.col("y.key")
        if turn == TURNS:  # each set meets each other one in one cell of its group's grid
            side = F.ceil(F.col("m") / GRID).cast("int")
            of, every = F.pmod(F.xxhash64("cls", F.lit(2)), side).cast("int"), F.explode(F.sequence(F.lit(0), side - 1))
            x, y = x.withColumn("row", of).withColumn("col", every), y.withColumn("col", of).withColumn("row", every)
            same = same & (F.col("x.row") == F.col("y.row")) & (F.col("x.col") == F.col("y.col"))
        x, y = x.alias("x"), y.alias("y")
        once = (F.col("y.turn") > turn) | (F.col("x.cls") < F.col("y.cls"))
        need = least_overlap(F.col("x.n") + F.col("y.n"), self.percent)
        rest = F.least(F.col("x.n") - F.col("x.pos"), F.col("y.n") - F.col("y.pos"))
        sizes = 100 * F.least("x.n", "y.n") >= self.percent * F.greatest("x.n", "y.n")
        less = (F.col("x.n") < F.col("y.n")) | (F.col("x.n") == F.col("y.n")) & (F.col("x.cls") < F.col("y.cls"))
        early = F.when(less, F.col("x.small")).otherwise(F.col("y.small"))
        first = ~F.arrays_overlap("x.before", "y.before") if "before" in rows.columns else F.lit(True)
        words = [c for c in rows.columns if c[0] == "s" and c[1:].isdigit()]
        differ = sum((F.bit_count(F.col(f"x.{c}").bitwiseXOR(F.col(f"y.{c}"))) for c in words), F.lit(0))
        close = F.col("x.shared") + F.col("y.shared") - differ >= 2 * need if words else F.lit(True)
        j = x.join(y, same & (F.col("x.label") != F.col("y.label")) & once & sizes & early & (rest >= need) & close & first)
        return j.select(F.least("x.cls", "y.cls").alias("a"), F.greatest("x.cls", "y.cls").alias("b"), (F.col("x.n") + F.col("y.n")).alias("both")).distinct()

    def cuts(self, sets: DataFrame) -> list[int]:
        """Places of the order between the fragments, by the shingles of all sets."""
        rows = sets.select(F.explode(F.transform("keys", lambda x: F.shiftright(x, RANK_BITS))).alias("r")).groupBy("r").agg(F.count(F.lit(1)).alias("n")).collect()  # 64 ranks
        weight = np.zeros(64)
        for r in rows:
            weight[r.r] = r.n
        ends = np.cumsum(weight)
        out = []
        for k in range(1, FRAGMENTS):
            want = ends[-1] * k / FRAGMENTS
            r = int(np.searchsorted(ends, want))
            if r < 64 and weight[r]:
                out.append((r << RANK_BITS) + int((want - (ends[r] - weight[r])) / weight[r] * 2**RANK_BITS * 0.999999))
        return out

    def fragments(self, sets: DataFrame, pairs: DataFrame, cuts: list[int]) -> DataFrame:
        """(cls, frag, keys): the cut sets of the classes in ``pairs``."""
        wanted = pairs.select(F.col("a").alias("cls")).distinct().unionByName(pairs.select(F.col("b").alias("cls")).distinct()).distinct()
        edges = [None, *cuts, None]
        inside = lambda lo, hi: lambda x: (F.lit(True) if lo is None else x >= lo) & (F.lit(True) if hi is None else x < hi)
        parts = [F.struct(F.lit(i).alias("frag"), F.filter("keys", inside(lo, hi)).alias("keys")) for i, (lo, hi) in enumerate(zip(edges[:-1], edges[1:], strict=True))]
        rows = sets.join(wanted, "cls", "left_semi").select("cls", F.explode(F.array(*parts)).alias("f")).select("cls", "f.*").filter(F.size("keys") > 0)
        return written(rows, "fragments")

    def links(self, pairs: DataFrame, fragments: DataFrame) -> DataFrame:
        """The pairs (a, b) over the threshold: overlaps counted by fragment and summed."""
        left = fragments.select(F.col("cls").alias("a"), "frag", F.col("keys").alias("ka"))
        right = fragments.select(F.col("cls").alias("b"), "frag", F.col("keys").alias("kb"))
        part = pairs.join(left, "a").join(right, ["b", "frag"]).select("a", "b", "both", F.size(F.array_intersect("ka", "kb")).alias("o"))
        total = part.groupBy("a", "b", "both").agg(F.sum("o").alias("o"))
        return total.filter(100 * F.col("o") >= self.percent * (F.col("both") - F.col("o"))).select("a", "b")


def star_components(links: DataFrame) -> DataFrame:
    """(cls, label) of every class in ``links`` (a, b): the smallest class reachable.

    Alternating large and small stars until the edges stay the same; each step is a minimum per
    node (combined before the shuffle) and a join.
    """
    spark = links.sparkSession
    edges = written(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct(), "edges")
    mark = None
    while True:
        with scope(spark) as keep:
            both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
            low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
            large = both.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
            large = written(large, "edges")
            low = large.groupBy("u").agg(F.min("v").alias("m"))
            small = large.join(low, "u").select(F.explode(F.array(F.struct("v", "m"), F.struct(F.col("u").alias("v"), "m"))).alias("e")).select(F.col("e.v").alias("u"), F.col("e.m").alias("v")).filter("u <> v").distinct()
            edges = written(small, "edges")
            keep.append(edges)
        now = edges.agg(F.count(F.lit(1)), F.expr("bit_xor(xxhash64(u, v))")).first()
        if now == mark:
            return edges.select(F.col("u").alias("cls"), F.col("v").alias("label")).unionByName(edges.select(F.col("v").alias("cls"), F.col("v").alias("label")).distinct())
        mark = now


class Labels:
    """Components of the links found so far: (cls, label)."""

    def __init__(self, join: Join):
        self.join = join
        self.table = join.spark.createDataFrame([], "cls long, label long")

    def add(self, pairs: DataFrame, fragments: DataFrame) -> None:
        with scope(self.join.spark) as keep:
            links = written(self.join.links(pairs, fragments), "links")
            if not links.isEmpty():
                self.table = written(star_components(links.unionByName(self.table.select(F.col("cls").alias("a"), F.col("label").alias("b")))), "labels")
                keep.append(self.table)


def link_classes(j: Join, sets: DataFrame) -> DataFrame:
    """(cls, label) of the classes that are linked with others."""
    labels = Labels(j)
    rows = j.groups(sets).withColumn("label", F.col("cls"))
    before = F.slice("keys", F.lit(1), (F.col("pos") - F.col("n") + F.size("keys")).cast("int"))
    cuts = None
    for turn in range(TURNS + 1):
        if turn:  # large groups of more than one component
            rows = rows.filter(F.col("m") > LEADERS).drop("label").join(labels.table, "cls", "left").withColumn("label", F.coalesce("label", "cls"))
            rows = written(rows, "marked")
            apart = rows.groupBy("key").agg((F.min("label") != F.max("label")).alias("apart")).filter("apart").select("key")
            rows = written(rows.filter(F.col("turn") >= turn).join(apart, "key"), "marked")
            if turn == 1:
                own = written(sets.select("cls", "keys").join(rows.select("cls").distinct(), "cls", "left_semi"), "own")
                own = written(j.signed(own).withColumn("shared", F.size("keys")), "own")
        pairs = written(j.candidates(rows.join(own, "cls").withColumn("before", before).drop("keys") if turn else rows, turn), "pairs")
        if pairs.isEmpty():
            if rows.isEmpty():
                break
            continue
        cuts = j.cuts(sets) if cuts is None else cuts
        labels.add(pairs, j.fragments(sets, pairs, cuts))
    return labels.table


def jaccard_components(docs: DataFrame, width: int = 5, percent: int = 75, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id): texts are linked when 100 * |A & B| >= percent * |A | B|.

    ``component_id`` is the smallest doc_id reachable by links, the row's own included.
    """
    j = Join(docs, doc_id, text, width, percent)
    with scope(j.spark) as keep:
        salt = 0
        while True:
            with scope(j.spark) as kept:
                named = j.named(salt)
                classes = written(j.classes(named), "classes")
                if clash := not classes.filter("clash").isEmpty():
                    salt += 1
                else:
                    kept += [named, classes]
            if not clash:
                break
        with scope(j.spark) as kept:
            sets = j.ordered(j.open_sets(classes.filter("open"), salt))
            kept.append(sets)
        with scope(j.spark) as kept:
            labels = link_classes(j, sets)
            kept.append(labels)
        rows = named.filter("hashes is null").select("doc_id", "n", "cls").join(labels, "cls", "left")
        rows = written(rows.select("doc_id", "n", F.coalesce("label", "cls").alias("label")), "labelled")
        least = written(rows.filter("n > 0").groupBy("label").agg(F.min("doc_id").alias("least")), "least")
        keep += [rows, least]
    out = rows.join(least, "label", "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("least")).otherwise(F.col("doc_id")).alias("component_id"))
