"""Exact substring deduplication: suffix sorting of repeated windows by deep-shallow sorting.

Every byte covered by a ``WINDOW``-byte string that starts at two places or more is removed.

1. *Anchors.* Each window has an anchor, the ``GRAM``-byte string of least hash in it (the leftmost of
   equal ones); equal windows have equal anchors at equal places. Windows in a row with one anchor
   form a chunk; a text has about two chunks per window length. Anchors that occur once in the
   corpus are dropped after a count that is summed before the shuffle.
2. *Chunks.* Chunks of equal bytes repeat as a whole; each different one goes on once.
3. *Suffix sorting.* The suffixes at all windows of an anchor's different chunks are sorted up to the
   window length: multikey quicksort to ``SHALLOW`` bytes, then a blind trie for each group that is
   still together. Suffixes that stay together to the end are equal windows.
4. *Hot anchors.* An anchor of more than ``LIMIT`` different chunks is dealt over several tasks. Their
   windows' classes are then counted again across tasks by hash, packed by ranges of hashes, so
   nothing is gathered in one.

   Chunks are equal when both their anchor's hash and their own are, windows across tasks when their
   hashes are; these are of 371 bytes at most, for which ``RangeHash`` tells texts apart.
5. *Removal.* The runs of repeated windows go back to their texts.

Texts go through the exchange only where they have a chunk to look at or bytes to remove (a bit
map of fixed size tells, the join that follows is exact).

Cases: a null text has no bytes; shorter texts than a window keep all bytes; rows with equal ids and
texts are copies of each other and both are emptied of their windows; rows with equal ids and
different texts are different texts; an empty table gives no rows; texts of any length are cut into
overlapping pieces of ``PIECE`` bytes for the anchors.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import RangeHash, Texts, hot_join, in_map, key_map, mix, scope, steps, written

WINDOW, GRAM = 200, 32
SPAN = WINDOW - GRAM + 1  # grams of a window
SHALLOW = 64
LIMIT = 1024
PIECE = 1 << 20
#: Bytes of text whose anchors are found at once: there are about twenty longs a byte meanwhile.
STEP = 1 << 18
#: Windows that one sort works on.
SORT_WINDOWS = 1 << 17

# ---------------------------------------------------------------- anchors


def window_anchors(buf: np.ndarray, grams: np.ndarray) -> np.ndarray:
    """Place of the least gram of each window of ``buf`` (leftmost of equal ones)."""
    n = len(buf) - WINDOW + 1
    low = np.uint64((1 << 24) - 1)
    best = (grams & ~low) | np.arange(len(grams), dtype=np.uint64)
    size = 1
    while size * 2 <= SPAN:
        best = np.minimum(best[:-size], best[size:])
        size *= 2
    return (np.minimum(best[:n], best[SPAN - size : SPAN - size + n]) & low).astype(np.int64)


def chunks(t: Texts) -> Iterator[tuple[np.ndarray, ...]]:
    """(text, anchor hash, chunk hash, first window, last window, anchor's place) of a step's chunks."""
    pieces = [(0, len(t.buf))] if len(t.buf) <= PIECE else [(i, min(i + PIECE + WINDOW - 1, len(t.buf))) for i in range(0, max(len(t.buf) - WINDOW + 1, 1), PIECE)]
    for lo, hi in pieces:
        buf = t.buf[lo:hi]
        n = len(buf) - WINDOW + 1
        if n <= 0:
            continue
        h = RangeHash(buf)
        start = np.arange(len(buf) - GRAM + 1)
        grams = h.of(start, start + GRAM)
        at = window_anchors(buf, grams)
        first = np.arange(n)
        text = np.searchsorted(t.bounds - lo, first, "right") - 1
        ok = first + WINDOW <= (t.bounds - lo)[text + 1]
        first, at, text = first[ok], at[ok], text[ok]
        if not len(first):
            continue
        new = np.flatnonzero(np.r_[True, (at[1:] != at[:-1]) | (text[1:] != text[:-1])])
        s0, s1, a, text = first[new], first[np.r_[new[1:], len(first)] - 1], at[new], text[new]
        shift = t.bounds[text] - lo
        yield text, grams[a], mix(h.of(s0, s1 + WINDOW) + (a - s0).astype(np.uint64)), s0 - shift, s1 - shift, a - shift


# ---------------------------------------------------------------- deep-shallow sorting


class Suffixes:
    """Suffixes of ``buf`` at ``pos``, compared by their first ``WINDOW`` bytes, eight at a time."""

    def __init__(self, buf: np.ndarray, pos: np.ndarray):
        raw = np.concatenate([buf, np.zeros(8, np.uint8)])
        self.words = np.ndarray(len(buf) + 1, ">u8", raw, strides=(1,))
        self.pos = pos

    def word(self, which: np.ndarray, depth: np.ndarray) -> np.ndarray:
        return self.words[self.pos[which] + depth].astype(np.uint64)


def quicksort(s: Suffixes, order: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Multikey quicksort of the suffixes ``order`` within their groups down to ``SHALLOW`` bytes.

    All open groups take a step together: each splits by its pivot into less, equal and greater;
    the equal part goes eight bytes deeper. Returns the suffixes that are not alone, by group, and
    the groups' bounds as (order, group numbers); those alone are done.
    """
    depth = np.zeros(len(order), np.int64)
    done_order, done_group, base = [], [], 0
    while len(order):
        edge = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
        size = np.diff(np.r_[edge, len(order)])
        keep = np.repeat(size > 1, size)
        order, depth = order[keep], depth[keep]
        size = size[size > 1]
        number = np.repeat(np.arange(len(size)), size)
        deep = depth >= SHALLOW
        if deep.any():
            done_order.append(order[deep])
            done_group.append(number[deep] + base)
            base += len(size)
            order, number, depth = order[~deep], number[~deep], depth[~deep]
        if not len(order):
            break
        edge = np.flatnonzero(np.r_[True, number[1:] != number[:-1]])
        size = np.diff(np.r_[edge, len(order)])
        key = s.word(order, depth)
        pivot = np.repeat(key[edge + size // 2], size)
        side = (key > pivot).astype(np.int64) - (key < pivot) + 1
        group = np.repeat(np.arange(len(size)), size) * 3 + side
        depth = np.where(side == 1, depth + 8, depth)
        rank = np.argsort(group, kind="stable")
        order, group, depth = order[rank], group[rank], depth[rank]
    if not done_order:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), depth
    return np.concatenate(done_order), np.concatenate(done_group), depth


def blind_tries(s: Suffixes, order: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order the groups of long common prefixes: (suffixes, class), a class having equal windows.

    Each group's trie grows from its root: a node skips to the first eight bytes in which any of
    its suffixes differs from its first one, and branches there only. A node without such a place
    is a leaf of equal suffixes. Nodes of one level of all tries are handled together.
    """
    out_order, out_class, leaves = [], [], 0
    depth = np.full(len(order), SHALLOW, np.int64)
    while len(order):
        edge = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
        size = np.diff(np.r_[edge, len(order)])
        head = np.repeat(order[edge], size)
        common = depth.copy()  # bytes in common with the head
        live = np.arange(len(order))
        while len(live):
            same = s.word(order[live], common[live]) == s.word(head[live], common[live])
            live = live[same]
            common[live] += 8
            live = live[common[live] < WINDOW]
        skip = np.minimum.reduceat(common, edge)
        leaf = np.repeat(skip >= WINDOW, size)
        if leaf.any():
            number = np.repeat(np.arange(len(size)), size)[leaf]
            out_order.append(order[leaf])
            out_class.append(number + leaves)
            leaves += len(size)
        order, depth, node = order[~leaf], np.repeat(skip, size)[~leaf], np.repeat(np.arange(len(size)), size)[~leaf]
        if not len(order):
            break
        key = s.word(order, depth)
        rank = np.lexsort((key, node))
        order, depth, node, key = order[rank], depth[rank], node[rank], key[rank]
        group = np.cumsum(np.r_[0, (node[1:] != node[:-1]) | (key[1:] != key[:-1])])
        size = np.bincount(group)
        many = np.repeat(size > 1, size)
        order, depth, group = order[many], depth[many] + 8, group[many]
        whole = depth >= WINDOW
        if whole.any():
            out_order.append(order[whole])
            out_class.append(group[whole] + leaves)
            leaves += int(group.max()) + 1
            order, depth, group = order[~whole], depth[~whole], group[~whole]
    if not out_order:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(out_order), np.concatenate(out_class)


def equal_windows(buf: np.ndarray, pos: np.ndarray, group: np.ndarray) -> np.ndarray:
    """Class of each suffix: equal numbers of 0 or more for equal windows, -1 for those alone."""
    out = np.full(len(pos), -1, np.int64)
    if len(pos):
        s = Suffixes(buf, pos)
        order = np.argsort(group, kind="stable")
        order, number, _ = quicksort(s, order, group[order])
        rank = np.argsort(number, kind="stable")
        order, classes = blind_tries(s, order[rank], number[rank])
        out[order] = classes
    return out


# ---------------------------------------------------------------- Spark


def _pack(s0: np.ndarray, s1: np.ndarray, a: np.ndarray) -> np.ndarray:
    """First window, last window and anchor of a chunk in one long."""
    return (s0 << 16) | ((s1 - s0) << 8) | (a - s1)


def _rows(docs: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys = b.column(0).to_numpy()
            for t in steps(b.column(1), STEP):
                for text, h, c, s0, s1, a in chunks(t):
                    yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(c.view(np.int64)), pa.array(keys[t.first + text]), pa.array(_pack(s0, s1, a))], ["h", "c", "key", "at"])

    return docs.select("key", "text").mapInArrow(run, "h long, c long, key long, at long")


def _passing(docs: DataFrame, bits, wanted: bool) -> DataFrame:
    """Rows whose key is (not) in the broadcast bit map."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            hit = in_map(bits.value, b.column("key").to_numpy())
            yield b.filter(pa.array(hit if wanted else ~hit))

    return docs.mapInArrow(run, docs.schema)


def _chunk_texts(docs: DataFrame, todo: DataFrame) -> DataFrame:
    """``todo`` (key, list of (h, at, n, salt, salts)) with the bytes of each chunk."""
    schema = pa.schema([("h", pa.int64()), ("salt", pa.int32()), ("salts", pa.int32()), ("key", pa.int64()), ("at", pa.int64()), ("n", pa.int64()), ("chunk", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lists = b.column(2)
            ends = lists.offsets.to_numpy()  # of the whole array, so its values are taken whole too
            parts = {k: np.asarray(lists.values.field(k)) for k in ("h", "at", "n", "salt", "salts")}
            keys = b.column(0).to_numpy()
            for t in steps(b.column(1)):
                raw = t.buf.tobytes()
                lo, hi = ends[t.first], ends[t.first + len(t)]
                owner = np.repeat(np.arange(len(t)), np.diff(ends[t.first : t.first + len(t) + 1]))
                at = parts["at"][lo:hi]
                s0 = (at >> 16) + t.bounds[owner]
                s1 = s0 + ((at >> 8) & 255)
                got = [raw[i : j + WINDOW] for i, j in zip(s0.tolist(), s1.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(parts["h"][lo:hi]), pa.array(parts["salt"][lo:hi]), pa.array(parts["salts"][lo:hi]), pa.array(keys[t.first + owner]), pa.array(at), pa.array(parts["n"][lo:hi]), pa.array(got, pa.binary())], schema=schema)

    return docs.join(todo, "key").select("key", "text", "todo").mapInArrow(run, "h long, salt int, salts int, key long, at long, n long, chunk binary")


WINDOWS = "key long, first long, last long, block int, hashes array<long>, ns array<long>, keys array<long>, firsts array<long>"


def _sorted_windows(rows: DataFrame, blocks: int) -> DataFrame:
    """Runs of repeated windows (key, first, last), and packed windows to count across tasks.

    Packed rows hold a task's windows of one of ``blocks`` ranges of hashes; ``keys`` is null where a
    window needs no answer.
    """
    longs = pa.list_(pa.int64())
    schema = pa.schema([("key", pa.int64()), ("first", pa.int64()), ("last", pa.int64()), ("block", pa.int32()), ("hashes", longs), ("ns", longs), ("keys", longs), ("firsts", longs)])

    def out(columns: dict[str, pa.Array], n: int) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([columns.get(f.name, pa.nulls(n, f.type)).cast(f.type) for f in schema], schema=schema)

    def solve(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = pa.Table.from_batches(held).combine_chunks()
        h, salts, key, at, n = (t.column(k).to_numpy() for k in ("h", "salts", "key", "at", "n"))
        (text,) = steps(t.column("chunk").combine_chunks() if isinstance(t.column("chunk"), pa.ChunkedArray) else t.column("chunk"), 1 << 62)
        count = ((at >> 8) & 255) + 1
        owner = np.repeat(np.arange(len(h)), count)
        k = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
        pos = text.bounds[:-1][owner] + k
        place = (at & 255)[owner] + (count - 1)[owner] - k  # of the anchor in the window
        group = np.unique(np.rec.fromarrays([h[owner], place], names="h,p"), return_inverse=True)[1]
        cls = equal_windows(text.buf, pos, group)
        weight = np.minimum(n, 2)[owner]
        total = weight.astype(np.int64)
        own = cls >= 0
        if own.any():
            total[own] = np.bincount(cls[own], weight[own])[cls[own]].astype(np.int64)
        # runs of the chunks that occur once (the others are known to repeat)
        hit = (total >= 2) & (n[owner] == 1)
        idx = np.flatnonzero(hit)
        if len(idx):
            new = np.flatnonzero(np.r_[True, (np.diff(idx) != 1) | (owner[idx[1:]] != owner[idx[:-1]])])
            a, z = idx[new], idx[np.r_[new[1:], len(idx)] - 1]
            s0 = (at >> 16)[owner[a]]
            yield out({"key": pa.array(key[owner[a]]), "first": pa.array(s0 + k[a]), "last": pa.array(s0 + k[z])}, len(a))
        # anchors dealt over several tasks: each class once a task, with its place if it is undecided
        hot = salts[owner] > 1
        if hot.any():
            one = np.unique(np.where(own, cls, len(own) + np.arange(len(own))), return_index=True)[1]
            one = one[hot[one]]
            codes = RangeHash(text.buf).of(pos[one], pos[one] + WINDOW)
            block = (codes % np.uint64(blocks)).astype(np.int64)
            rank = np.argsort(block, kind="stable")
            one, codes, block = one[rank], codes[rank], block[rank]
            open_ = (total[one] < 2) & (n[owner[one]] == 1)
            new = np.flatnonzero(np.r_[True, block[1:] != block[:-1]])
            ends = pa.array(np.r_[new, len(block)].astype(np.int32))
            packed = lambda x: pa.ListArray.from_arrays(ends, x)
            yield out({"block": pa.array(block[new]), "hashes": packed(pa.array(codes.view(np.int64))), "ns": packed(pa.array(np.minimum(total[one], 2))), "keys": packed(pa.array(key[owner[one]], mask=~open_)), "firsts": packed(pa.array((at >> 16)[owner[one]] + k[one]))}, len(new))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, windows, last = [], 0, None
        for b in batches:
            for i in range(0, b.num_rows, 256):
                part = b.slice(i, 256)
                ids = np.stack([part.column("h").to_numpy(), part.column("salt").to_numpy()], 1)
                cuts = np.flatnonzero((ids[1:] != ids[:-1]).any(1)) + 1
                if windows > SORT_WINDOWS and (len(cuts) or tuple(ids[0]) != last):
                    cut = 0 if tuple(ids[0]) != last else int(cuts[0])
                    if cut:
                        held.append(part.slice(0, cut))
                    yield from solve(held)
                    held, windows, part = [], 0, part.slice(cut)
                held.append(part)
                windows += int((((part.column("at").to_numpy() >> 8) & 255) + 1).sum())
                last = tuple(ids[-1])
        if held:
            yield from solve(held)

    return rows.mapInArrow(run, WINDOWS)


def _across(packed: DataFrame) -> DataFrame:
    """(key, first, last) of the open windows that several tasks have; the rows of a block follow each other."""

    def solve(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        t = pa.Table.from_batches(held)
        hashes, ns, keys, firsts = (t.column(c).combine_chunks() for c in ("hashes", "ns", "keys", "firsts"))
        hashes, ns, keys, firsts = (c.chunk(0) if isinstance(c, pa.ChunkedArray) else c for c in (hashes, ns, keys, firsts))
        keys = keys.flatten()
        _, at = np.unique(hashes.flatten().to_numpy(), return_inverse=True)
        hit = keys.is_valid().to_numpy(zero_copy_only=False) & (np.bincount(at, ns.flatten().to_numpy())[at] >= 2)
        first = firsts.flatten().to_numpy()[hit]
        return pa.RecordBatch.from_arrays([keys.filter(pa.array(hit)), pa.array(first), pa.array(first)], ["key", "first", "last"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for b in batches:
            block = b.column("block").to_numpy()
            edges = np.r_[0, np.flatnonzero(np.diff(block)) + 1, len(block)] if len(block) else np.zeros(1, np.int64)
            for lo, hi in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
                if held and held[-1].column("block")[0].as_py() != block[lo]:
                    yield solve(held)
                    held = []
                held.append(b.slice(lo, hi - lo))
        if held:
            yield solve(held)

    return packed.mapInArrow(run, "key long, first long, last long")


def _remove(docs: DataFrame) -> DataFrame:
    """Final columns from (doc_id, text, runs); ``runs`` holds first * 256 + (last - first) or null."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            runs = b.column(2).to_pylist()
            for t in steps(b.column(1)):
                out = []
                for i in range(len(t)):
                    buf = t.buf[t.bounds[i] : t.bounds[i + 1]]
                    if runs[t.first + i]:
                        r = np.array(runs[t.first + i], np.int64)
                        mark = np.zeros(len(buf) + 1, np.int64)
                        np.add.at(mark, r >> 8, 1)
                        np.add.at(mark, (r >> 8) + (r & 255) + WINDOW, -1)
                        gone = np.cumsum(mark[:-1]) > 0
                        spans = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())
                        out.append((len(buf), int(gone.sum()), spans, hashlib.sha256(buf[~gone].tobytes()).hexdigest()))
                    else:
                        out.append((len(buf), 0, 0, hashlib.sha256(buf.tobytes()).hexdigest()))
                cols = list(zip(*out, strict=True))
                yield pa.RecordBatch.from_arrays([b.column(0).slice(t.first, len(t)), *(pa.array(c, pa.int64()) for c in cols[:3]), pa.array(cols[3])], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    return docs.mapInArrow(run, f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def repeated_runs(docs: DataFrame) -> DataFrame:
    """(key, first, last): runs of repeated windows of the texts ``docs`` (key, text)."""
    spark = docs.sparkSession
    with scope(spark) as keep:
        rows = written(_rows(docs), "anchors")
        twice = written(rows.groupBy("h").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "anchors")
        rows = written(hot_join(rows, twice, ["h"], "n").select("h", "c", "key", "at"), "repeated")
        variants = written(rows.groupBy("h", "c").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("key", "at")).alias("one")), "variants")
        # chunks that occur twice or more: all their windows repeat
        many = written(variants.filter("n > 1").select("h", "c", "n"), "many")
        whole = hot_join(rows, many, ["h", "c"], "n").select("key", F.expr("shiftright(at, 16)").alias("first"), F.expr("shiftright(at, 16) + (shiftright(at, 8) & 255)").alias("last"))
        whole = written(whole.distinct(), "whole")  # equal rows have the same runs
        # anchors with a chunk that occurs once and others beside it
        open_ = written(variants.groupBy("h").agg(F.count(F.lit(1)).alias("v"), F.min("n").alias("least")).filter("v > 1 and least = 1").select("h", "v"), "open")
        todo = hot_join(variants, open_, ["h"], "v").select("h", "n", "one.key", "one.at", F.expr(f"cast(ceil(v / {LIMIT}) as int)").alias("salts"), F.col("c"))
        todo = todo.withColumn("salt", F.expr("cast(pmod(xxhash64(c), salts) as int)"))
        todo = written(todo.groupBy("key").agg(F.collect_list(F.struct("h", "at", "n", "salt", "salts")).alias("todo")), "todo")  # a text's own chunks
        bits = spark.sparkContext.broadcast(key_map(todo, "key"))
        parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
        texts = _chunk_texts(_passing(docs.select("key", "text"), bits, True), todo)
        dealt = texts.repartition(parts, "h", "salt").sortWithinPartitions("h", "salt")
        got = written(_sorted_windows(dealt, 8 * parts), "windows")
        resolved = got.filter("block is null").select("key", "first", "last")
        packed = got.filter("block is not null").select("block", "hashes", "ns", "keys", "firsts")
        crossed = written(_across(packed.repartition(parts, "block").sortWithinPartitions("block")), "crossed")
        keep += [whole, got, crossed]
    return whole.unionByName(resolved).unionByName(crossed)


def keyed(rows: DataFrame, salt: int = 0) -> DataFrame:
    """Rows (doc_id, text) with a ``key`` of 64 bits that no two different ones share: a second, independent hash and the
    length tell whether two do by chance, and then all are named anew."""
    while True:
        d = rows.withColumn("key", F.xxhash64(F.lit(salt), "doc_id", "text"))
        again = F.struct(F.xxhash64("text", "doc_id", F.lit(salt)), F.octet_length("text"))
        if d.select("key", again.alias("again")).groupBy("key").agg((F.min("again") != F.max("again")).alias("clash")).filter("clash").isEmpty():
            return d
        salt += 1


def dedup_substrings(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) of every row."""
    d = keyed(docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text")))
    with scope(d.sparkSession) as keep:
        runs = repeated_runs(d).select("key", (F.col("first") * 256 + (F.col("last") - F.col("first"))).alias("run"))
        lists = written(runs.groupBy("key").agg(F.collect_set("run").alias("runs")), "runs")  # a text's own runs, once
        keep.append(lists)
    bits = d.sparkSession.sparkContext.broadcast(key_map(lists, "key"))
    whole = _remove(_passing(d, bits, False).select("doc_id", "text", F.lit(None).cast("array<long>").alias("runs")))
    return whole.unionByName(_remove(_passing(d, bits, True).join(lists, "key", "left").select("doc_id", "text", "runs")))
