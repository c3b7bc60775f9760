"""Quality rules: distribution divergence from language references.

References are made from the corpus itself: per language label the histogram of character classes
and the histogram of common words (the ``COMMON`` most frequent words that are at least one in
``RARE`` of the language's words, lower case in A-Z, and one place for all others; words are counted by
their 64-bit hashes). A text's two histograms are compared with every reference
by Jensen-Shannon distance (base 2, 0 to 1); the nearest reference counts. A text is kept when it
passes the base rules, and its distances are within the limits; histograms of fewer than
``MIN_WORDS`` words (or ``MIN_CHARS`` characters) are too thin to judge and pass.

The word distance of an ordinary text falls with its length, and a text without any common word
comes to about 0.4, so the limit of words is taken from the corpus: per reference and band of lengths
(powers of two) ``FENCE`` quartile ranges above the third quartile of the distances, counted over all
texts of ``MIN_WORDS`` words that pass the base rules, copies once. A quartile range counts as
``LEAST_SPREAD`` of the median at least. A band of fewer than ``MIN_BAND`` texts has the limit of the
band over all references, or else that of the next shorter band. ``MAX_WORDS`` is the limit in any case.

Base rules: n_words < 50, or more than half of the words lie in three-word windows that occur twice
or more in the text.

Cases: null and empty texts have no words and fail; a null language is a reference of its own;
references of fewer than ``MIN_REFERENCE`` words are not used, and without any no text is rejected
for its distance; equal texts get equal results; repeated rows keep their rows; an empty table
gives no rows. Of more than ``MAX_LANGUAGES`` languages those with most words are references; all texts
are held against these.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import STEP_BYTES, Texts, codes, lower_ascii, mix, powers, scope, steps, words, written

COMMON, RARE = 64, 2000
MIN_WORDS, MIN_CHARS, MIN_REFERENCE = 50, 200, 1000
MAX_CLASS, MAX_WORDS = 0.25, 0.75
MAX_LANGUAGES = 1000
FENCE, LEAST_SPREAD, MIN_BAND, BINS = 2.0, 0.1, 20, 4096

#: Character classes by first byte of a UTF-8 character; continuation bytes have none (-1).
CLASSES = ("lower", "upper", "digit", "space", "line", "stop", "quote", "symbol", "latin", "greek", "cyrillic", "semitic", "indic", "signs", "east", "beyond", "other")


def class_table() -> np.ndarray:
    at = CLASSES.index
    out = np.full(256, at("symbol"), np.int64)
    out[97:123], out[65:91], out[48:58] = 0, 1, 2
    out[[0x20, 0x09]], out[[0x0A, 0x0B, 0x0C, 0x0D]] = 3, 4
    out[list(b".,;:!?")], out[list(b"'\"()-")] = 5, 6
    out[0x80:0xC0], out[0xC0:] = -1, at("other")
    out[0xC3:0xCA], out[0xCE:0xD0], out[0xD0:0xD4], out[0xD6:0xDC] = at("latin"), at("greek"), at("cyrillic"), at("semitic")
    out[0xE0], out[0xE2], out[0xE3:0xEE], out[0xF0:0xF5] = at("indic"), at("signs"), at("east"), at("beyond")
    return out


CLASS = class_table()
SYMBOL = np.zeros(256, bool)
SYMBOL[list(b"[#*$%&|<>]"[1:-1])] = True


def histogram(rows: np.ndarray, cells: np.ndarray, n: int, width: int) -> np.ndarray:
    return np.bincount(rows * width + cells, minlength=n * width).reshape(n, width)


def js_distance(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Jensen-Shannon distance of each row of counts ``p`` to the distribution ``q``; empty rows 0."""
    total = p.sum(1, keepdims=True)
    p = p / np.maximum(total, 1)
    m = (p + q) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        d = np.where(p > 0, p * np.log2(p / m), 0).sum(1) + np.where(q > 0, q * np.log2(q / m), 0).sum(1)
    return np.where(total[:, 0] > 0, np.sqrt(np.clip(d / 2, 0, 1)), 0.0)


# ---------------------------------------------------------------- references


class References:
    """Of each language: class distribution, hashes of its common words, and the distribution over them and the rest."""

    def __init__(self, counts: pd.DataFrame):
        self.langs: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for _, g in counts.groupby("lang", dropna=False, sort=True):
            w, c = g[g.kind == "w"], g[g.kind == "c"]
            total = g[g.kind == "n"].n.sum()
            if total < MIN_REFERENCE:
                continue
            top = w.sort_values(["n", "cell"], ascending=[False, True]).head(COMMON)
            code, n = top.cell.to_numpy(np.int64).view(np.uint64), top.n.to_numpy()
            rank = np.argsort(code)
            p = np.zeros(len(CLASSES))
            p[c.cell.to_numpy(np.int64)] = c.n.to_numpy()
            self.langs.append((p / max(p.sum(), 1), code[rank], np.r_[n[rank], total - n.sum()] / total))


def places(words_: np.ndarray, common: np.ndarray) -> np.ndarray:
    """Place of each word among the sorted hashes ``common``; the last one for all others."""
    at = np.searchsorted(common, words_)
    hit = common[np.minimum(at, len(common) - 1)] == words_ if len(common) else np.zeros(len(words_), bool)
    return np.where(hit, at, len(common))


def reference_counts(docs: DataFrame) -> pd.DataFrame:
    """(lang, kind, cell, n): counts over all texts of classes (c), all words (n) and words that are common (w)."""

    out = lambda lang, kind, cell, n: pa.RecordBatch.from_arrays([pa.array([lang] * len(cell), pa.string()), pa.array([kind] * len(cell), pa.string()), pa.array(cell.astype(np.int64)), pa.array(n.astype(np.int64))], ["lang", "kind", "cell", "n"])

    def classes(total: dict[str | None, np.ndarray]) -> Iterator[pa.RecordBatch]:
        for lang, a in total.items():
            cell = np.flatnonzero(a)
            yield out(lang, "c", cell, a[cell])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str | None, np.ndarray] = {}
        for b in batches:
            enc = b.column(1).dictionary_encode()
            names = enc.dictionary.to_pylist()
            code = enc.indices.fill_null(len(names)).to_numpy().astype(np.int64)
            names.append(None)
            held: list[tuple[np.ndarray, np.ndarray]] = []
            for t in steps(b.column(0)):
                lang = code[t.first : t.first + len(t)]
                w = words(t)
                held.append((lang[w.text].astype(np.int32), codes(lower_ascii(t.buf), w.start, w.end)))
                cls = CLASS[t.buf]
                at = np.flatnonzero(cls >= 0)
                cc = histogram(np.repeat(lang, np.diff(t.bounds))[at], cls[at], len(names), len(CLASSES))
                for k in np.unique(lang).tolist():
                    have = total.setdefault(names[k], np.zeros(len(CLASSES), np.int64))
                    have += cc[k]
                if len(held) >= 8 or t.first + len(t) == len(b):  # words of several steps are counted together
                    of, each = (np.concatenate(x) for x in zip(*held, strict=True))
                    held = []
                    for k in np.unique(of).tolist():
                        one, n = np.unique(each[of == k], return_counts=True)
                        yield out(names[k], "w", one.view(np.int64), n)
                if len(total) > MAX_LANGUAGES:  # counts of a task may come in parts
                    yield from classes(total)
                    total.clear()
        yield from classes(total)

    with scope(docs.sparkSession):
        counts = written(docs.mapInArrow(run, "lang string, kind string, cell long, n long").groupBy("lang", "kind", "cell").agg(F.sum("n").alias("n")), "counts")
        totals = counts.filter("kind = 'w'").groupBy("lang").agg(F.sum("n").alias("n")).filter(f"n >= {MIN_REFERENCE}").orderBy(F.desc("n"), F.asc_nulls_last("lang")).limit(MAX_LANGUAGES)
        least = F.broadcast(totals.select(F.col("lang").alias("of"), (F.col("n") / RARE).alias("least")))  # MAX_LANGUAGES rows
        common = counts.filter("kind = 'w'").join(least, F.col("lang").eqNullSafe(F.col("of"))).filter("n >= least").select(counts.columns)  # RARE words a language at most
        known = counts.filter("kind = 'c'").join(least, F.col("lang").eqNullSafe(F.col("of")), "left_semi")
        rows = known.select(counts.columns).unionByName(common).unionByName(totals.select("lang", F.lit("n").alias("kind"), F.lit(0).cast("long").alias("cell"), "n"))
        return rows.toArrow().to_pandas()


# ---------------------------------------------------------------- base counts


def repeated_words(word: np.ndarray, first: np.ndarray, width: int = 3) -> np.ndarray:
    """Per text: words in windows of ``width`` words that occur twice or more in it."""
    n, counts = len(first) - 1, np.diff(first)
    owner = np.repeat(np.arange(n), counts)
    m = len(word) - width + 1
    if m <= 0:
        return np.zeros(n, np.int64)
    mult, spread = powers(width + 1)[0], mix(word)
    h = mix(sum(spread[j : j + m] * mult[j + 1] for j in range(width)))
    at = np.flatnonzero(owner[:m] == owner[width - 1 :])
    rank = np.lexsort((h[at], owner[at]))
    s, o = h[at][rank], owner[at][rank]
    same = (s[1:] == s[:-1]) & (o[1:] == o[:-1])
    again = np.zeros(len(at), bool)
    again[rank] = np.r_[False, same] | np.r_[same, False]
    mark = np.zeros(len(word) + 1, np.int64)
    np.add.at(mark, at[again], 1)
    np.add.at(mark, at[again] + width, -1)
    return np.bincount(owner[np.cumsum(mark[:-1]) > 0], minlength=n)


def repeated_lines(t: Texts) -> np.ndarray:
    """Per text: \\n-split lines with a word that equal an earlier line of it."""
    brk = np.flatnonzero(t.buf == 10)
    start = np.unique(np.concatenate([t.bounds[:-1], brk + 1]))
    start = start[start < len(t.buf)]
    text = np.searchsorted(t.bounds, start, "right") - 1
    end = np.minimum(np.r_[start[1:], len(t.buf)], t.bounds[text + 1])
    end = end - ((end > start) & (t.buf[np.maximum(end - 1, 0)] == 10))
    solid = np.r_[0, np.cumsum(~np.isin(t.buf, np.frombuffer(b" \t\n\x0b\x0c\r", np.uint8)))]
    has = solid[end] > solid[start]
    start, end, text = start[has], end[has], text[has]
    h = codes(t.buf, start, end)
    rank = np.lexsort((h, text))
    s, o = h[rank], text[rank]
    dup = (s[1:] == s[:-1]) & (o[1:] == o[:-1])
    return np.bincount(o[1:][dup], minlength=len(t))


# ---------------------------------------------------------------- limits


def word_limits(measured: DataFrame) -> list[tuple[int, int, float]]:
    """(ref, band, limit) of the word distance, from all measured texts; bands without a limit are left out."""
    of = measured.filter(f"not base_failed and n_words >= {MIN_WORDS} and ref >= 0").select("ref", "band", "n_words", "word_chars", "word_distance").distinct()
    bins = of.groupBy("ref", "band", F.expr(f"cast(word_distance * {BINS} as int)").alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    bins = bins.unionByName(bins.withColumn("ref", F.lit(-1)))  # -1: over all references
    rows = bins.groupBy("ref", "band").agg(F.sum("n").alias("n"), F.expr("percentile(bin, array(0.25D, 0.5D, 0.75D), n)").alias("q")).collect()  # a row per reference and band
    at: dict[tuple[int, int], float] = {}
    for r in rows:
        if r.n >= MIN_BAND:
            q1, q2, q3 = ((x + 0.5) / BINS for x in r.q)
            at[r.ref, r.band] = q3 + FENCE * max(q3 - q1, LEAST_SPREAD * q2)
    out: list[tuple[int, int, float]] = []
    for ref in sorted({r.ref for r in rows} - {-1}):
        limit = None
        for band in range(64):
            limit = at.get((ref, band), at.get((-1, band), limit))
            if limit is not None:
                out.append((ref, band, limit))
    return out


def judge(docs: DataFrame, lang: str = "lang", doc_id: str = "doc_id", text: str = "text", max_class: float = MAX_CLASS, max_words: float = MAX_WORDS) -> DataFrame:
    """(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, class_distance, word_distance, kept)."""
    d = docs.select(F.col(text).cast("string").alias("text"), F.col(lang).cast("string").alias("lang"), F.col(doc_id).alias("doc_id"))
    refs = docs.sparkSession.sparkContext.broadcast(References(reference_counts(d.select("text", "lang"))))  # a few tables per language
    kind = d.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        langs = refs.value.langs
        for b in batches:
            for t in steps(b.column(0)):
                n, w = len(t), words(t)
                n_words = np.diff(w.first)
                lead = np.r_[0, np.cumsum((t.buf & 0xC0) != 0x80)]
                chars = np.bincount(w.text, lead[w.end] - lead[w.start], n).astype(np.int64)
                symbols = np.diff(np.r_[0, np.cumsum(SYMBOL[t.buf])][t.bounds])
                rep = repeated_words(codes(t.buf, w.start, w.end), w.first)
                failed = (n_words < 50) | (100 * rep > 50 * n_words)
                cls = CLASS[t.buf]
                at = np.flatnonzero(cls >= 0)
                c = histogram(np.repeat(np.arange(n), np.diff(t.bounds))[at], cls[at], n, len(CLASSES))
                each_word = codes(lower_ascii(t.buf), w.start, w.end)
                far_c, far_w, near = np.zeros(n), np.zeros(n), np.full(n, -1)
                if langs:
                    each = [(js_distance(c, p), js_distance(histogram(w.text, places(each_word, common), n, len(q)), q)) for p, common, q in langs]
                    near = np.argmin([x + y for x, y in each], 0)
                    far_c, far_w = (np.stack([e[k] for e in each])[near, np.arange(n)] for k in (0, 1))
                far = (far_c > max_class) & (c.sum(1) >= MIN_CHARS)
                band = np.frexp(np.maximum(n_words, 1))[1] - 1
                longs = (pa.array(x.astype(np.int64)) for x in (n_words, chars, symbols, repeated_lines(t), rep))
                ints = (pa.array(x.astype(np.int32)) for x in (near, band))
                yield pa.RecordBatch.from_arrays([b.column(2).slice(t.first, n), *longs, pa.array(failed), pa.array(far_c), pa.array(far_w), pa.array(far), *ints], ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "class_distance", "word_distance", "class_far", "ref", "band"])

    measured = written(d.mapInArrow(run, f"doc_id {kind}, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, class_distance double, word_distance double, class_far boolean, ref int, band int"), "measured")
    limits = docs.sparkSession.createDataFrame(word_limits(measured), "ref int, band int, word_limit double")
    word_far = (F.col("n_words") >= MIN_WORDS) & (F.col("word_distance") > F.least(F.lit(max_words), "word_limit"))  # least() passes over nulls
    return measured.join(F.broadcast(limits), ["ref", "band"], "left").withColumn("kept", ~F.col("base_failed") & ~F.col("class_far") & ~word_far).drop("ref", "band", "class_far", "word_limit")
