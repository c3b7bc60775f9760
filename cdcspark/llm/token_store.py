"""Token ids on disk: public tokenizers, canonical length-limited Huffman coding, table decoding.

``tokenize`` turns texts into ids, ``write_store`` orders documents by id and writes one file per
range of document ids, ``read_store`` decodes the files again. Code lengths come from the counts of
all ids (one row per id reaches the driver, bounded by the vocabulary).

File layout, all integers little-endian::

    magic 8 bytes | block payloads | footer (zstd) | footer length u64 | magic 8 bytes
    footer: JSON head {max_length, symbols, docs, ids, block_ids, stride}, then
            code lengths u8[symbols], doc ids i64[docs], null flags u8[docs], tokens i64[docs],
            per block: byte offset i64, bit offsets of every ``stride``-th id i64[...]

A block holds up to ``block_ids`` ids and is decoded without any other; the bit offsets let a
reader decode all stretches of a block side by side, one table look-up per id.

Cases: a null text is an empty one and gives the end id alone; null document ids sort first;
repeated rows and equal ids are all kept, ordered by a hash of their tokens; an empty table writes no
file and reads back as no rows. Ids must fit in 32 bits.
"""

from __future__ import annotations

import json
import os
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import SPACE, Texts, codes, folded, scratch_path, scope, steps, words, written

MAGIC = b"HUFTOK01"
BLOCK_IDS = 1 << 16
STRIDE = 256
MAX_LENGTH = 20
#: Words that a Python worker remembers; when there are more it starts anew.
CACHE_WORDS = 1_000_000
#: Fixed value: how the vocabulary cuts words into pieces.
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"

# ---------------------------------------------------------------- tokenizing


#: Classes of bytes for cutting plain words: letters run together, digits stand alone, others run together.
NONE, LETTER, DIGIT, OTHER, WHOLE = range(5)


def byte_classes() -> tuple[np.ndarray, np.ndarray]:
    """Class of each byte in a plain word, and the bytes that make a word another than plain.

    Plain words hold ASCII without apostrophes (contractions are cut by a rule of their own) and the
    Latin-1 letters that two bytes with a lead of 0xC3 make.
    """
    kind = np.full(256, OTHER, np.uint8)
    kind[97:123], kind[65:91], kind[48:58], kind[0x80:0xC0], kind[0xC3] = LETTER, LETTER, DIGIT, LETTER, LETTER
    odd = np.zeros(256, bool)
    odd[:0x21] = odd[0x7F] = odd[0x27] = odd[0xC0:] = True
    odd[0xC3] = False
    return kind, odd


CLASS, ODD = byte_classes()


class IdTable:
    """Ids of known byte strings: an open-addressing table of two 64-bit hashes, looked up all at once."""

    def __init__(self, kind: type, bits: int):
        self.kind, self.bits = kind, bits
        self.forget()

    def fit(self, more: int) -> None:
        """Begin anew with a larger table if ``more`` strings leave less than half of it free."""
        if 2 * (self.count + more) > 1 << self.bits and not self.count:
            self.bits = (2 * more - 1).bit_length()
            self.forget()

    def forget(self) -> None:
        self.keys = np.zeros((2, 1 << self.bits), np.uint64)
        self.number = np.full(1 << self.bits, -1, np.int32)
        self.count = 0
        self.flat = np.zeros(0, self.kind)
        self.at = np.zeros(1, np.int64)

    def find(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Number of each string, or -1."""
        out = np.full(len(a), -1, np.int32)
        live = np.arange(len(a))
        slot = (a >> np.uint64(64 - self.bits)).astype(np.int64)
        while len(live):
            got = self.number[slot]
            same = (got >= 0) & (self.keys[0][slot] == a[live]) & (self.keys[1][slot] == b[live])
            out[live[same]] = got[same]
            on = (got >= 0) & ~same
            live, slot = live[on], (slot[on] + 1) & ((1 << self.bits) - 1)
        return out

    def add(self, a: np.ndarray, b: np.ndarray, ids: list[bytes]) -> None:
        """Different new strings, numbered from ``count`` on."""
        number = np.arange(self.count, self.count + len(a), dtype=np.int32)
        live = np.arange(len(a))
        slot = (a >> np.uint64(64 - self.bits)).astype(np.int64)
        while len(live):
            free = self.number[slot] < 0
            take = np.flatnonzero(free)[np.unique(slot[free], return_index=True)[1]]
            at = slot[take]
            self.number[at], self.keys[0][at], self.keys[1][at] = number[live[take]], a[live[take]], b[live[take]]
            on = np.ones(len(live), bool)
            on[take] = False
            live, slot = live[on], slot[on]
            slot = np.where(self.number[slot] >= 0, slot + 1, slot) & ((1 << self.bits) - 1)
        self.flat = np.concatenate([self.flat, np.frombuffer(b"".join(ids), self.kind)])
        size = np.fromiter(map(len, ids), np.int64, len(ids)) // self.flat.itemsize
        self.at = np.concatenate([self.at, self.at[-1] + np.cumsum(size)])
        self.count += len(a)


class WordEncoder:
    """Encodes word by word, with a table of what is known.

    The tokenizer's pieces never contain white space and its normaliser keeps words apart, so a
    text's ids are its words' ids in a row. Plain words are cut into pieces here, for all words of a
    step at once, and only new pieces go through the BPE model; every other word goes through the
    whole tokenizer. A vocabulary whose settings don't allow this is refused.
    """

    def __init__(self, path: str, width: int):
        from tokenizers import Tokenizer

        self.full = Tokenizer.from_file(path)
        self.kind = {2: np.uint16, 4: np.uint32}[width]
        with open(path, encoding="utf-8") as f:
            self.check(json.load(f))
        self.model = self.full.model
        self.level = dict(enumerate(_byte_letters()))
        self.table = IdTable(self.kind, 1 + (CACHE_WORDS - 1).bit_length())

    @staticmethod
    def check(spec: dict) -> None:
        """The normaliser and the cutting of words must be those that ``encode`` relies on."""
        steps_ = spec.get("normalizer") or {}
        steps_ = [x["type"] for x in steps_.get("normalizers", [steps_])]
        cut = (spec.get("pre_tokenizer") or {}).get("pretokenizers", [{}])
        if steps_ != ["NFC", "Replace", "Lowercase"] or [x.get("type") for x in cut] != ["Split", "ByteLevel"] or cut[0]["pattern"] != {"Regex": PIECES} or cut[1]["add_prefix_space"] or cut[1]["use_regex"] or (cut[0]["behavior"], cut[0]["invert"]) != ("Removed", True):
            raise ValueError("only for vocabularies that normalise by NFC, single spaces and lower case, and drop the white space between words")

    def _slow(self, word: str) -> bytes:
        return np.array(self.full.encode(word, add_special_tokens=False).ids, self.kind).tobytes()

    def _piece(self, raw: bytes) -> bytes:
        letters = raw.decode() if raw.isascii() else "".join([self.level[b] for b in raw])
        return struct.pack(f"<{len(got)}{'H' if self.kind is np.uint16 else 'I'}", *got) if (got := [t.id for t in self.model.tokenize(letters)]) else b""

    def encode(self, t: Texts, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row with ``end_id`` after each, and the texts' bounds in them."""
        special = b"<|" in t.buf.tobytes()
        buf = t.buf if special else folded(t.buf)  # upper and lower case encode alike but in special tokens
        w = words(Texts(t.first, buf, t.bounds))
        odd = ODD[buf]
        if special:  # nothing is folded then
            odd |= (buf == 0x3C) | (buf == 0xC3) | (buf >= 65) & (buf <= 90)
        odd[1:] |= (buf[:-1] == 0xC3) & ((buf[1:] == 0x97) | (buf[1:] == 0xB7))  # a sign, not a letter
        odd = np.r_[0, np.cumsum(odd)]
        whole = odd[w.end] > odd[w.start]
        kind = CLASS[buf]
        kind[SPACE[buf]] = NONE
        mark = np.zeros(len(buf) + 1, np.int32)
        mark[w.start[whole]] += 1
        mark[w.end[whole]] -= 1
        kind[np.cumsum(mark[:-1]) > 0] = WHOLE
        cut = np.zeros(len(buf) + 1, bool)  # a piece begins or the one before ends
        cut[1:-1] = (kind[1:] != kind[:-1]) | (kind[1:] == DIGIT)
        cut[w.start] = cut[w.end] = True
        start = np.flatnonzero(cut[:-1] & (kind != NONE))
        end = np.flatnonzero(cut)
        end = end[np.searchsorted(end, start, "right")]
        a, b = (codes(buf, start, end, seed) for seed in (0, 1))
        number = self.table.find(a, b)
        raw = None
        while len(new := np.flatnonzero(number < 0)):
            one = new[np.unique(a[new], return_index=True)[1]]
            if self.table.count + len(one) > CACHE_WORDS and self.table.count:
                self.table.forget()
                one = np.unique(a, return_index=True)[1]
            self.table.fit(len(one))
            raw = raw or buf.tobytes()
            slow = (kind[start[one]] == WHOLE).tolist()
            got = [self._slow(raw[i:j].decode()) if s else self._piece(raw[i:j]) for i, j, s in zip(start[one].tolist(), end[one].tolist(), slow, strict=True)]
            self.table.add(a[one], b[one], got)
            number = self.table.find(a, b)
        size = self.table.at[number + 1] - self.table.at[number]
        ends = np.cumsum(size)
        before = np.r_[0, ends][np.searchsorted(start, t.bounds)]  # of each text's first piece
        total = int(ends[-1]) if len(ends) else 0
        pick = np.repeat(self.table.at[number] - (ends - size), size) + np.arange(total)
        bounds = before + np.arange(len(t) + 1)
        out = np.empty(total + len(t), self.kind)
        hole = np.ones(len(out), bool)
        hole[bounds[1:] - 1] = False
        out[hole] = self.table.flat[pick]
        out[bounds[1:] - 1] = end_id
        return out, bounds


def _byte_letters() -> list[str]:
    """The letter that a byte-level vocabulary uses for each byte: printable ones are themselves."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = iter(range(0x100, 0x200))
    return [chr(b) if b in own else chr(next(rest)) for b in range(256)]


_encoders: dict[tuple, WordEncoder] = {}


def tokenize(docs: DataFrame, vocab_path: str, end_id: int, doc_id: str = "doc_id", text: str = "text", width: int = 2) -> DataFrame:
    """(doc_id, ids binary of little-endian unsigned ``width``-byte ids with ``end_id`` last)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        enc = _encoders.setdefault((vocab_path, width), None) or WordEncoder(vocab_path, width)
        _encoders[vocab_path, width] = enc
        for b in batches:
            for t in steps(b.column(1), 4 << 20):
                ids, bounds = enc.encode(t, end_id)
                ids = pa.Array.from_buffers(pa.binary(), len(t), [None, pa.py_buffer((bounds * width).astype(np.int32)), pa.py_buffer(ids)])
                yield pa.RecordBatch.from_arrays([b.column(0).slice(t.first, len(t)), ids], ["doc_id", "ids"])

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")).mapInArrow(run, "doc_id long, ids binary")


# ---------------------------------------------------------------- canonical Huffman codes


def code_lengths(counts: np.ndarray, limit: int) -> np.ndarray:
    """Optimal code lengths of at most ``limit`` bits by package-merge; 0 for ids that never occur."""
    used = np.flatnonzero(counts)
    out = np.zeros(len(counts), np.uint8)
    n = len(used)
    if n <= 1:
        out[used] = 1
        return out
    if n > 1 << limit:
        raise ValueError(f"{n} ids don't fit in codes of {limit} bits")
    order = used[np.argsort(counts[used], kind="stable")]
    leaves = counts[order].astype(object if counts.sum() > 2**55 else np.int64)
    levels = []
    items = leaves
    leaf = np.ones(n, bool)
    for _ in range(limit - 1):
        levels.append(leaf)
        pairs = len(items) // 2
        packs = items[0 : 2 * pairs : 2] + items[1 : 2 * pairs : 2]
        both = np.concatenate([leaves, packs])
        rank = np.argsort(both, kind="stable")
        items, leaf = both[rank], rank < n
    levels.append(leaf)
    lengths = np.zeros(n, np.int64)
    take = 2 * n - 2
    for leaf in reversed(levels):
        k = int(leaf[:take].sum())
        lengths[:k] += 1
        take = 2 * (take - k)
    out[order] = lengths
    return out


def canonical(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Codes by (length, id), and the ids in that order."""
    order = np.lexsort((np.arange(len(lengths)), lengths))
    order = order[lengths[order] > 0]
    codes = np.zeros(len(lengths), np.uint32)
    if len(order):
        ls = lengths[order].astype(np.int64)
        top = int(ls[-1])
        steps_ = np.int64(1) << (top - ls)
        first = np.concatenate([[0], np.cumsum(steps_)[:-1]])
        codes[order] = (first >> (top - ls)).astype(np.uint32)
    return codes, order


def pack_bits(ids: np.ndarray, codes: np.ndarray, lengths: np.ndarray) -> tuple[bytes, np.ndarray]:
    """The ids' codes in a row, high bits first, and each id's bit offset."""
    size = lengths[ids].astype(np.int64)
    ends = np.cumsum(size)
    at = ends - size
    n_words = int((ends[-1] + 31) // 32) + 1 if len(ids) else 0
    wide = codes[ids].astype(np.uint64) << (np.uint64(64) - (size + (at & 31)).astype(np.uint64))
    high = np.bincount(at >> 5, (wide >> np.uint64(32)).astype(np.float64), n_words)
    low = np.bincount((at >> 5) + 1, (wide & np.uint64(0xFFFFFFFF)).astype(np.float64), n_words)
    out = (high + low).astype(np.uint64).astype(">u4").tobytes()
    return out[: int((ends[-1] + 7) // 8)] if len(ids) else b"", at


class Decoder:
    """Table-driven: the next ``top`` bits name the id and its length."""

    def __init__(self, lengths: np.ndarray):
        _, order = canonical(lengths)
        self.top = int(lengths.max()) if len(order) else 0
        ls = lengths[order].astype(np.int64)
        spans = np.int64(1) << (self.top - ls)
        self.ids = np.repeat(order.astype(np.uint32), spans)
        self.sizes = np.repeat(ls, spans)
        short = (1 << self.top) - len(self.ids)
        if short:
            self.ids = np.concatenate([self.ids, np.zeros(short, np.uint32)])
            self.sizes = np.concatenate([self.sizes, np.ones(short, np.int64)])

    def block(self, payload: bytes, n: int, at: np.ndarray, stride: int) -> np.ndarray:
        """The ``n`` ids of a block; ``at`` has the bit offset of every ``stride``-th."""
        raw = np.frombuffer(payload + bytes(8), np.uint8)
        words = np.ndarray(len(raw) - 3, ">u4", raw, strides=(1,))
        out = np.zeros((stride, len(at)), np.uint32)
        at = at.copy()
        last = len(payload) * 8
        for k in range(min(stride, n)):
            np.minimum(at, last, out=at)
            key = (words[at >> 3].astype(np.int64) >> (32 - self.top - (at & 7))) & ((1 << self.top) - 1)
            out[k] = self.ids[key]
            at += self.sizes[key]
        return out.T.reshape(-1)[:n]


# ---------------------------------------------------------------- files


def id_counts(encoded: DataFrame, width: int = 2) -> np.ndarray:
    """How often each id occurs in all documents; index = id."""
    kind = {2: np.uint16, 4: np.uint32}[width]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)
        for b in batches:
            for t in steps(b.column(0), 8 << 20):
                c = np.bincount(np.frombuffer(t.buf.tobytes(), kind))
                if len(c) > len(total):
                    total, c = c.astype(np.int64), total
                total[: len(c)] += c
        ids = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(total[ids], pa.int64())], ["id", "n"])

    rows = encoded.select("ids").mapInArrow(run, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).toArrow()
    ids, n = rows["id"].to_numpy(), rows["n"].to_numpy()
    out = np.zeros(int(ids.max()) + 1 if len(ids) else 0, np.int64)
    out[ids] = n
    return out


def write_store(encoded: DataFrame, path: str, width: int = 2, max_length: int = MAX_LENGTH, block_ids: int = BLOCK_IDS, stride: int = STRIDE) -> DataFrame:
    """Write ``encoded`` (doc_id, ids) below the URI ``path``; one row (part, file, docs, ids) per file.

    ``encoded`` is read twice (counts, then coding), so give a written table. Files are numbered in
    ascending ranges of doc_id. A task writes under a name of its own and renames at the end, so a
    repeated or speculative task leaves one whole file.
    """
    spark = encoded.sparkSession
    kind = {2: np.uint16, 4: np.uint32}[width]
    lengths = code_lengths(id_counts(encoded, width), max_length)
    shared = spark.sparkContext.broadcast(lengths)  # one byte per id of the vocabulary
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lengths = shared.value
        codes, _ = canonical(lengths)
        part = TaskContext.get().partitionId()
        disk, base = pafs.FileSystem.from_uri(path)
        disk.create_dir(base, recursive=True)
        own = f"{base}/.{part}-{uuid.uuid4().hex}"
        out, where = None, len(MAGIC)
        doc_ids, nulls, sizes, offsets, marks, left, held = [], [], [], [], [], [], 0

        def block(ids: np.ndarray) -> None:
            nonlocal where
            payload, at = pack_bits(ids, codes, lengths)
            out.write(payload)
            offsets.append(where)
            marks.append(at[::stride])
            where += len(payload)

        for b in batches:
            if b.num_rows and out is None:
                out = disk.open_output_stream(own)
                out.write(MAGIC)
            ids_of = b.column(0)
            nulls.append(ids_of.is_null().to_numpy(zero_copy_only=False).astype(np.uint8))
            doc_ids.append(ids_of.fill_null(0).to_numpy())
            for t in steps(b.column(1), 2 << 20):
                sizes.append(np.diff(t.bounds) // width)
                left.append(np.frombuffer(t.buf.tobytes(), kind))
                held += len(left[-1])
                if held >= block_ids:
                    ids = np.concatenate(left)
                    cut = held - held % block_ids
                    for i in range(0, cut, block_ids):
                        block(ids[i : i + block_ids])
                    left, held = [ids[cut:]], held - cut
        if out is None:
            return
        if held:
            block(np.concatenate(left))
        sizes_, docs_ = np.concatenate(sizes).astype("<i8"), np.concatenate(doc_ids).astype("<i8")
        head = json.dumps({"max_length": max_length, "symbols": len(lengths), "docs": len(docs_), "ids": int(sizes_.sum()), "block_ids": block_ids, "stride": stride}).encode()
        body = [struct.pack("<I", len(head)), head, lengths.tobytes(), docs_.tobytes(), np.concatenate(nulls).tobytes(), sizes_.tobytes(), np.array(offsets + [where], "<i8").tobytes(), *(m.astype("<i8").tobytes() for m in marks)]
        footer = pa.compress(b"".join(body), "zstd", asbytes=True)
        out.write(struct.pack("<Q", len(b"".join(body))) + footer + struct.pack("<Q", len(footer) + 8) + MAGIC)
        out.close()
        name = f"{base}/part-{part:06d}.huf"
        disk.move(own, name)
        yield pa.RecordBatch.from_pylist([{"part": part, "file": name.rsplit("/", 1)[1], "docs": len(docs_), "ids": int(sizes_.sum())}], pa.schema([("part", pa.int32()), ("file", pa.string()), ("docs", pa.int64()), ("ids", pa.int64())]))

    # rows of one id may be many, so their tokens' hash takes part in the ranges
    tie = F.xxhash64("ids")
    ranged = encoded.select("doc_id", "ids").repartitionByRange(parts, "doc_id", tie).sortWithinPartitions("doc_id", tie, "ids")
    return written(ranged.mapInArrow(run, "part int, file string, docs long, ids long"), "files")


class StoreFile:
    """Range reads of one file."""

    def __init__(self, disk: pafs.FileSystem, name: str):
        self.f = disk.open_input_file(name)
        size = self.f.size()
        n, magic = struct.unpack("<Q8s", self.f.read_at(16, size - 16))
        if magic != MAGIC:
            raise ValueError(f"{name}: not a token file")
        raw = self.f.read_at(n, size - 16 - n)
        body = pa.decompress(raw[8:], struct.unpack("<Q", raw[:8])[0], "zstd", asbytes=True)
        k = struct.unpack_from("<I", body)[0]
        self.head = json.loads(body[4 : 4 + k])
        at = 4 + k

        def take(kind: str, n: int) -> np.ndarray:
            nonlocal at
            got = np.frombuffer(body, kind, n, at)
            at += got.nbytes
            return got

        h = self.head
        self.lengths = take("u1", h["symbols"])
        self.doc_ids, self.nulls, self.sizes = take("<i8", h["docs"]), take("u1", h["docs"]), take("<i8", h["docs"])
        blocks = -(-h["ids"] // h["block_ids"])
        self.offsets = take("<i8", blocks + 1)
        self.marks = take("<i8", -(-h["ids"] // h["stride"])) if h["block_ids"] % h["stride"] == 0 else None
        self.decoder = Decoder(self.lengths)

    def block(self, k: int) -> np.ndarray:
        h = self.head
        n = min(h["block_ids"], h["ids"] - k * h["block_ids"])
        per = h["block_ids"] // h["stride"]
        payload = self.f.read_at(int(self.offsets[k + 1] - self.offsets[k]), int(self.offsets[k]))
        return self.decoder.block(payload, n, self.marks[k * per : (k + 1) * per], h["stride"])


def read_store(spark: SparkSession, path: str, files: DataFrame) -> DataFrame:
    """(doc_id, start, ids) per document, decoded from the files: ``start`` counts all ids before it.

    ``ids`` are little-endian unsigned 32-bit. Only the number of ids of each file (a row per file,
    as many as tasks wrote) is summed on the driver.
    """
    listed = sorted((r.part, r.file, r.ids) for r in files.collect())
    starts, total = [], 0
    for _, name, n in listed:
        starts.append((name, total))
        total += n
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("ids", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        disk, base = pafs.FileSystem.from_uri(path)
        for b in batches:
            for row in b.to_pylist():
                f = StoreFile(disk, f"{base}/{row['file']}")
                ends = np.cumsum(f.sizes)
                left, first, doc = [], 0, 0  # ids decoded and not given out, the number of the first of them
                for k in range(len(f.offsets) - 1):
                    left.append(f.block(k))
                    have = first + sum(map(len, left))
                    upto = int(np.searchsorted(ends, have, "right"))
                    if upto == doc:
                        continue
                    ids = np.concatenate(left).astype("<u4")
                    raw = ids.tobytes()
                    out, at = [], first
                    for e in ends[doc:upto].tolist():
                        out.append(raw[(at - first) * 4 : (e - first) * 4])
                        at = e
                    docs = pa.array(f.doc_ids[doc:upto], mask=f.nulls[doc:upto].astype(bool))
                    yield pa.RecordBatch.from_arrays([docs, pa.array(row["start"] + ends[doc:upto] - f.sizes[doc:upto]), pa.array(out, pa.binary())], schema=schema)
                    left, first, doc = [ids[at - first :]], at, upto

    if not starts:
        return spark.createDataFrame([], "doc_id long, start long, ids binary")
    todo = spark.createDataFrame(starts, "file string, start long").repartition(len(starts))
    return todo.mapInArrow(run, "doc_id long, start long, ids binary")


def digests(decoded: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of ``read_store``'s rows."""
    return decoded.select("doc_id", "start", F.expr("cast(octet_length(ids) div 4 as long)").alias("n_tokens"), F.crc32("ids").alias("ids_crc32"))


def token_store(docs: DataFrame, vocab_path: str, end_id: int = 1, width: int = 2) -> DataFrame:
    """Tokenize, write and read back all of ``docs``; see the module's text for the cases."""
    spark = docs.sparkSession
    path = scratch_path(spark, "tokens")
    with scope(spark):
        encoded = written(tokenize(docs, vocab_path, end_id, width=width), "ids")
        return digests(read_store(spark, path, write_store(encoded, path, width)))
