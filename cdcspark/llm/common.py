"""Helpers shared by the corpus operators: shared scratch tables and vectorised text handling.

Conventions of every operator here: a null text counts as an empty one, input rows are never
dropped unless the operator is a filter, repeated rows each keep their own output row, columns
other than the named ones are ignored, and an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

U64 = np.uint64
#: Bytes of text that one vectorised step works on; a longer single text is a step of its own.
STEP_BYTES = 1 << 20


# ---------------------------------------------------------------- scratch tables


def scratch_dir(spark: SparkSession) -> str:
    """Folder that driver and executors share: ``spark.checkpoint.dir``.

    Where it is unset, it is set here: to a folder of the warehouse, which a cluster shares as well, or
    to a temporary one where the whole of Spark is this one process.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if spark.sparkContext.master.split("[")[0] == "local":
            base = "file://" + tempfile.mkdtemp(prefix="spark-")
        else:
            base = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/scratch-{uuid.uuid4().hex}"
        spark.conf.set("spark.checkpoint.dir", base)
    return base.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder; the scope that is open deletes it at its end."""
    path = f"{scratch_dir(spark)}/{name}-{uuid.uuid4().hex}"
    if _scopes:
        _scopes[-1].append(path)
    return path


_scopes: list[list[str]] = []


def discard(spark: SparkSession, paths: list[str]) -> None:
    """Delete scratch folders through the file system that holds them."""
    conf = spark._jsc.hadoopConfiguration()
    for path in paths:
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(conf).delete(p, True)


@contextmanager
def scope(spark: SparkSession) -> Iterator[list[DataFrame]]:
    """Scratch tables written inside are deleted at the end, except the tables (of ``written``) in the list given.

    Kept tables belong to the scope around, or stay where there is none: a query's result reads them.
    """
    keep: list[DataFrame] = []
    _scopes.append([])
    try:
        yield keep
    finally:
        paths = _scopes.pop()
        kept = [p for p in paths if any(p == getattr(df, "scratch", None) for df in keep)]
        if _scopes:
            _scopes[-1].extend(kept)
        discard(spark, [p for p in paths if p not in kept])


#: Spark then deletes the shuffle files of a query at its end, not when the driver collects garbage.
CLEAN = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def written(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage: write ``df`` to the shared folder and read it back."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    before = spark.conf.get(CLEAN, None)
    spark.conf.set(CLEAN, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(CLEAN, before) if before else spark.conf.unset(CLEAN)
    out = spark.read.schema(df.schema).parquet(path)
    out.scratch = path
    return out


#: Keys that are broadcast as hot ones: those with more than this share of all rows, so at most so many.
HOT_KEYS = 50_000


def hot_join(rows: DataFrame, keys: DataFrame, on: list[str], weight: str) -> DataFrame:
    """Inner join of ``rows`` with ``keys``, unique on ``on``; ``weight`` tells how many rows a key has.

    A key with more than one ``HOT_KEYS``th of the rows is joined by broadcast (there are at most
    ``HOT_KEYS`` of them), so its rows stay where they are; all others meet in an exchange.
    """
    limit = max(64, -(-rows.count() // HOT_KEYS))
    hot = F.broadcast(keys.filter(F.col(weight) > limit))
    return rows.join(hot, on).unionByName(rows.join(hot, on, "left_anti").join(keys.filter(F.col(weight) <= limit), on))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# ---------------------------------------------------------------- vectorised text


def is_space() -> np.ndarray:
    """Lookup table of the bytes that separate words: space and 0x09-0x0D."""
    out = np.zeros(256, bool)
    out[0x20] = True
    out[0x09:0x0E] = True
    return out


SPACE = is_space()


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads the bits of 64-bit values."""
    x = x ^ (x >> U64(32))
    x = x * U64(0xD6E8FEB86659FD93)
    x = x ^ (x >> U64(32))
    x = x * U64(0xD6E8FEB86659FD93)
    return x ^ (x >> U64(32))


MASKS = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)
#: Byte ranges longer than this are hashed one by one by a library function.
LONG_RANGE = 256
SEEDS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)


def codes(buf: np.ndarray, start: np.ndarray, end: np.ndarray, seed: int = 0) -> np.ndarray:
    """64-bit hashes of byte ranges of ``buf``, eight bytes at a time; equal for equal bytes.

    Every step mixes what is there before the next eight bytes come in, so no arithmetic relation
    between texts makes them equal. ``seed`` 0 and 1 are independent of each other.
    """
    raw = np.concatenate([buf, np.zeros(8, np.uint8)])
    words_ = np.ndarray(len(buf) + 1, "<u8", raw, strides=(1,))
    size = end - start
    factor = U64(SEEDS[seed])
    out = (size.astype(np.uint64) + U64(1)) * factor
    live = np.flatnonzero((size > 0) & (size <= LONG_RANGE))
    at, left, h = start[live], size[live], out[live]
    while len(live):
        h = (h ^ (words_[at] & MASKS[np.minimum(left, 8)])) * factor
        h ^= h >> U64(29)
        more = left > 8
        out[live[~more]] = h[~more]
        live, at, left, h = live[more], at[more] + 8, left[more] - 8, h[more]
    out = mix(out)
    for i in np.flatnonzero(size > LONG_RANGE).tolist():
        out[i] = int.from_bytes(hashlib.blake2b(buf[start[i] : end[i]], digest_size=8, salt=bytes([seed])).digest(), "little")
    return out


_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INV = pow(_BASE, -1, 1 << 64)
BYTE_CODES = mix(np.arange(1, 257, dtype=np.uint64) * U64(0xA0761D6478BD642F))
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the hash base and of its inverse modulo 2**64, at least ``n`` of each."""
    if len(_powers[0]) < n:
        m = max(n, 2 * STEP_BYTES)
        for i, b in enumerate((_BASE, _BASE_INV)):
            x = np.full(m, U64(b), np.uint64)
            x[0] = 1
            _powers[i] = np.cumprod(x, dtype=np.uint64)
    return _powers[0], _powers[1]


class RangeHash:
    """64-bit hashes of any byte range of a buffer, equal for equal bytes, from sums of powers.

    Only for ranges of a few hundred bytes: a sum of powers modulo 2**64 is the same for certain
    different ranges of 1,024 bytes and more. ``codes`` is for ranges of any length.
    """

    def __init__(self, buf: np.ndarray, codes: np.ndarray = BYTE_CODES):
        n = len(buf)
        up, self.down = powers(n + 1)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(codes[buf] * up[:n], dtype=np.uint64, out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        raw = (self.sums[end] - self.sums[start]) * self.down[start]
        return mix(raw + (end - start).astype(np.uint64) * U64(0xE7037ED1A0B428DB))


@dataclass
class Texts:
    """A step of texts as one UTF-8 buffer. ``bounds``: byte offsets, one more than texts."""

    first: int
    buf: np.ndarray
    bounds: np.ndarray

    def __len__(self) -> int:
        return len(self.bounds) - 1


def _parts(arr: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Byte buffer and offsets of a string or binary array; nulls have no bytes."""
    kind = np.int64 if pa.types.is_large_string(arr.type) or pa.types.is_large_binary(arr.type) else np.int32
    if arr.null_count:
        empty = pa.scalar(b"" if "binary" in str(arr.type) else "", arr.type)
        arr = arr.fill_null(empty)
    _, offs, data = arr.buffers()
    if len(arr) == 0 or offs is None:
        return np.zeros(0, np.uint8), np.zeros(len(arr) + 1, np.int64)
    at = np.frombuffer(offs, kind)[arr.offset : arr.offset + len(arr) + 1].astype(np.int64)
    buf = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None else np.zeros(0, np.uint8)
    return buf, at - at[0]


def steps(texts: pa.Array, limit: int = STEP_BYTES) -> Iterator[Texts]:
    """Consecutive runs of whole texts of about ``limit`` bytes."""
    buf, at = _parts(texts)
    i, n = 0, len(at) - 1
    while i < n:
        j = int(np.searchsorted(at, at[i] + limit, "right")) - 1
        j = min(max(j, i + 1), n)
        yield Texts(i, buf[at[i] : at[j]], at[i : j + 1] - at[i])
        i = j


@dataclass
class Words:
    """Words of a step: byte ranges, the text that each belongs to, and each text's first word."""

    start: np.ndarray
    end: np.ndarray
    text: np.ndarray
    first: np.ndarray


def words(t: Texts) -> Words:
    """Maximal runs of bytes outside space and 0x09-0x0D; no word crosses texts."""
    n = len(t.buf)
    solid = ~SPACE[t.buf]
    edge = np.zeros(n + 1, bool)
    edge[t.bounds] = True
    before = np.concatenate([[False], solid])
    after = np.concatenate([solid, [False]])
    start = np.flatnonzero(after & (~before | edge))
    end = np.flatnonzero(before & (~after | edge))
    text = np.searchsorted(t.bounds, start, "right") - 1
    # empty texts share a bound with their neighbour: the last text that begins there owns it
    first = np.searchsorted(start, t.bounds, "left")
    return Words(start, end, text, first)


def folded(buf: np.ndarray) -> np.ndarray:
    """Lower case of ASCII and Latin-1 letters, as UTF-8 bytes."""
    out = np.where((buf >= 65) & (buf <= 90), buf + np.uint8(32), buf)
    second = np.zeros(len(buf), bool)
    second[1:] = buf[:-1] == 0xC3
    return np.where(second & (buf >= 0x80) & (buf <= 0x9E) & (buf != 0x97), buf + np.uint8(32), out)


def lower_ascii(buf: np.ndarray) -> np.ndarray:
    """A-Z to a-z; bytes of longer UTF-8 sequences are untouched."""
    return np.where((buf >= 65) & (buf <= 90), buf + np.uint8(32), buf)


def shingles(codes: np.ndarray, first: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of ``width`` consecutive words and each one's text; a shorter text gives one of all its words."""
    counts = np.diff(first)
    n_texts = len(counts)
    mult = powers(width + 1)[0]
    spread = mix(codes + U64(0x589965CC75374CC3))
    total = len(codes)
    rolled = np.zeros(max(total - width + 1, 0), np.uint64)
    for j in range(width):
        rolled += spread[j : j + len(rolled)] * mult[j + 1]
    owner = np.repeat(np.arange(n_texts), counts)
    full = owner[: len(rolled)] == owner[width - 1 :] if len(rolled) else np.zeros(0, bool)
    hashes, texts = mix(rolled[full]), owner[: len(rolled)][full]
    short = np.flatnonzero((counts > 0) & (counts < width))
    if len(short):
        extra = np.zeros(len(short), np.uint64)
        for j in range(width - 1):
            has = counts[short] > j
            extra[has] += spread[first[short[has]] + j] * mult[j + 1]
        extra = mix(extra ^ (counts[short].astype(np.uint64) * U64(0x1D8E4E27C47D124F)))
        hashes, texts = np.concatenate([hashes, extra]), np.concatenate([texts, short])
        order = np.argsort(texts, kind="stable")
        hashes, texts = hashes[order], texts[order]
    return hashes, texts


def distinct_by_text(hashes: np.ndarray, texts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each text's hashes once, ascending within the text."""
    order = np.lexsort((hashes, texts))
    h, t = hashes[order], texts[order]
    keep = np.ones(len(h), bool)
    keep[1:] = (h[1:] != h[:-1]) | (t[1:] != t[:-1])
    return h[keep], t[keep]


# ---------------------------------------------------------------- maps of keys


#: Bits of a map of 64-bit keys: a broadcast of 8 MB whatever the input. Where many bits are set,
#: more rows pass than needed; an exact join always follows.
MAP_BITS = 26


def key_map(keys: DataFrame, name: str) -> np.ndarray:
    """Bit map of the low bits of a long column, put together in tasks, a block of it in each."""
    block = MAP_BITS - 6

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        have: dict[int, np.ndarray] = {}
        for b in batches:
            bit = b.column(0).to_numpy()
            for k in np.unique(bit >> block).tolist():
                mark = have.setdefault(k, np.zeros(1 << block, bool))
                mark[bit[bit >> block == k] & ((1 << block) - 1)] = True
        for k, mark in have.items():
            yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([np.packbits(mark, bitorder="little").tobytes()])], ["block", "bits"])

    cells = keys.select(F.expr(f"cast(pmod({name}, {1 << MAP_BITS}) as int)").alias("bit")).repartition(64, F.expr(f"shiftright(bit, {block})"))
    out = np.zeros(1 << (MAP_BITS - 5), np.uint32)
    for row in cells.mapInArrow(run, "block int, bits binary").toArrow().to_pylist():  # 64 blocks
        part = np.frombuffer(row["bits"], "<u4")
        out[row["block"] * len(part) : (row["block"] + 1) * len(part)] |= part
    return out


def in_map(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    cell = keys & ((1 << MAP_BITS) - 1)
    return ((bits[cell >> 5] >> (cell & 31).astype(np.uint32)) & 1).astype(bool)
