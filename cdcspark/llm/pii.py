"""Personal data: base patterns, and a character BiLSTM with CRF transitions trained in numpy.

The tagger learns from labelled spans: those of the base patterns, and secrets (access keys, and values
given to a name such as ``password``), which have a kind of their own and no base pattern. Each window
with a span is learnt twice, once as it is and once with the span in another writing (an address with
``[at]``, an ip with ``[.]``, a card with other separators, a phone number without its plus, a secret of
other letters). At most
``MAX_FIT`` distinct windows are drawn by the smallest hashes, in fixed shares of classes at every
size of the corpus: one for each kind of span (a window with several kinds is of the one that its
hash says) and two for windows without a span; a class with fewer windows is taken whole. Every
``HOLD``th window drawn is not learnt from: on these the least margin of each kind is set, at which
``PRECISION`` of the spans found are right.

A text is cut into windows that overlap by half. Windows are run where they hold an ``@``, a bracketed
``at``, ``MIN_DIGITS`` digits, or a run of ``MIN_RUN`` letters and digits with a digit in it; no kind of
span fits in any other. All these are decoded (Viterbi with the CRF transitions) and reconciled over the
whole text: what one kind has in overlapping windows is put together, and of all spans, whole ones and
put together ones, the set without overlaps of the greatest total margin is taken, base spans first.

A span that the tagger adds must read as its kind, whatever the writing: an address with a dotted domain,
four parts up to 255, Luhn, 10 to 15 digits, or a secret of letters and digits.

Cases: null and empty texts have no spans; positions are code points; without any labelled span in the
corpus no tagger is trained and the base spans are all; repeated rows keep their rows; an empty
table gives no rows; texts of any length are windowed whole.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from .common import scope, written

KINDS = ("email", "ip", "card", "phone", "secret")
MAX_FIT = 2100
#: Windows of each class that are drawn: of each kind, and without a span.
SHARES = (*[MAX_FIT // 7] * len(KINDS), 2 * MAX_FIT // 7)
SIZE, STRIDE = 64, 32
MIN_DIGITS, MIN_RUN = 4, 12
HIDDEN, EMBED, BATCH, STEPS, SEED = 16, 10, 64, 460, 7
HOLD, PRECISION = 6, 0.98
#: Task results that one task merges when windows are drawn.
FAN_IN = 8
TAGS = 1 + 2 * len(KINDS)  # O, then B and I of each kind

# ---------------------------------------------------------------- base patterns

DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# possessive digits, begun at a run's first digit: the same matches as plain ones in linear time
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DIGIT = re.compile(r"[0-9]")
#: Texts without any of these have no window to look at.
ANY = re.compile(r"[0-9@]|[\[(][Aa][Tt][\])]")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _digits(s: str) -> str:
    return "".join(DIGIT.findall(s))


#: Other writings that the tagger's spans may have, and what they stand for.
PLAIN = ((re.compile(r"\s*[\[(]\s*at\s*[\])]\s*", re.I), "@"), (re.compile(r"\s*[\[(]\s*(?:dot|\.)\s*[\])]\s*", re.I), "."))
#: What labels secrets: access keys by their prefix, and values of names that tell.
SECRETS = re.compile(r"\bAKIA[0-9A-Z]{16}\b|(?i:\b(?:password|passwd|pwd|secret|token|api_?key)\s*[=:]\s*[\"']?)([A-Za-z0-9+/_-]{12,})")
SECRET = re.compile(r"[A-Za-z0-9+/_=-]{12,}")


def plain(s: str) -> str:
    for pattern, to in PLAIN:
        s = pattern.sub(to, s)
    return s


def is_email(s: str) -> bool:
    name, _, domain = s.partition("@")
    return bool(name) and bool(DOMAIN.fullmatch(domain)) and set(name) <= LOCAL


def is_ip(s: str) -> bool:
    return bool(IP.fullmatch(s)) and all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in s.split("."))


def is_card(s: str) -> bool:
    return bool(CARD.fullmatch(s)) and 14 <= len(_digits(s)) <= 19 and luhn(_digits(s))


CHECK = {
    "email": lambda s: is_email(plain(s)),
    "ip": lambda s: is_ip(plain(s)),
    "card": lambda s: is_card(re.sub(r"[./_]", "-", s)),
    "phone": lambda s: 10 <= len(_digits(s)) <= 15 and s[0] in "+(0123456789" and set(s[1:]) <= set(" ().-0123456789"),
    "secret": lambda s: bool(SECRET.fullmatch(s)) and any(c.isdigit() for c in s) and any(c.isalpha() for c in s),
}


def emails(text: str) -> Iterator[tuple[int, int]]:
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        m = DOMAIN.match(text, at + 1) if start < at else None
        if m:
            yield start, m.end()
            done = m.end()
        at = text.find("@", max(at + 1, done))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind's number, end), by start and kind."""
    out = [(a, 0, z) for a, z in emails(text)]
    if DIGIT.search(text):
        out += [(m.start(), 1, m.end()) for m in IP.finditer(text) if is_ip(m[0])]
        out += [(m.start(), 2, m.end()) for m in CARD.finditer(text) if m.end() - m.start() < 40 and is_card(m[0])]
        if "+" in text:
            out += [(m.start(), 3, m.end()) for m in PHONE.finditer(text) if 10 <= len(_digits(m[0])) <= 15]
    return sorted(out)


# ---------------------------------------------------------------- the tagger


def codes(text: str) -> np.ndarray:
    """Character classes: ASCII as it is, all other characters one class."""
    c = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    return np.minimum(c, 128).astype(np.int64)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def lse(x: np.ndarray, axis: int) -> np.ndarray:
    m = x.max(axis, keepdims=True)
    return (m + np.log(np.exp(x - m).sum(axis, keepdims=True))).squeeze(axis)


class Tagger:
    """Embedding, an LSTM in each direction, tag scores, CRF transitions. Code 129 is padding."""

    def __init__(self, seed: int = SEED):
        r = np.random.default_rng(seed)
        w = lambda *s: (r.normal(0, 1, s) / np.sqrt(s[0])).astype(np.float32)
        self.least = np.zeros(len(KINDS))  # margins, by kind
        self.p = {"e": w(130, EMBED), "out": w(2 * HIDDEN, TAGS), "bias": np.zeros(TAGS, np.float32), "move": np.zeros((TAGS, TAGS), np.float32)}
        for d in "fb":
            b = np.zeros(4 * HIDDEN, np.float32)
            b[HIDDEN : 2 * HIDDEN] = 1
            self.p |= {f"x{d}": w(EMBED, 4 * HIDDEN), f"h{d}": w(HIDDEN, 4 * HIDDEN), f"b{d}": b}

    def lstm(self, x: np.ndarray, d: str) -> tuple[np.ndarray, list]:
        """Hidden states of (time, batch, embed) input; ``b`` runs from the end."""
        t, n, _ = x.shape
        pre = x @ self.p[f"x{d}"] + self.p[f"b{d}"]
        h, c = np.zeros((n, HIDDEN), np.float32), np.zeros((n, HIDDEN), np.float32)
        out, tape = np.zeros((t, n, HIDDEN), np.float32), []
        for k in range(t) if d == "f" else range(t - 1, -1, -1):
            z = pre[k] + h @ self.p[f"h{d}"]
            i, f, o = (sigmoid(z[:, j * HIDDEN : (j + 1) * HIDDEN]) for j in (0, 1, 2))
            g = np.tanh(z[:, 3 * HIDDEN :])
            c_new = f * c + i * g
            tc = np.tanh(c_new)
            tape.append((k, i, f, o, g, c, tc, h))
            h, c = o * tc, c_new
            out[k] = h
        return out, tape

    def scores(self, x: np.ndarray) -> tuple[np.ndarray, tuple]:
        e = self.p["e"][x.T]
        (hf, tf), (hb, tb) = self.lstm(e, "f"), self.lstm(e, "b")
        h = np.concatenate([hf, hb], 2)
        return h @ self.p["out"] + self.p["bias"], (e, h, tf, tb)

    def gradient(self, x: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        """Of the mean negative log likelihood of the tags ``y`` (batch, time)."""
        s, (e, h, tf, tb) = self.scores(x)
        t, n, _ = s.shape
        move = self.p["move"]
        a, b = np.zeros_like(s), np.zeros_like(s)
        a[0] = s[0]
        for k in range(1, t):
            a[k] = s[k] + lse(a[k - 1][:, :, None] + move, 1)
        for k in range(t - 2, -1, -1):
            b[k] = lse(move[None] + (s[k + 1] + b[k + 1])[:, None, :], 2)
        z = lse(a[-1], 1)
        ds = np.exp(a + b - z[None, :, None])
        g = {"move": np.zeros_like(move)}
        for k in range(t - 1):
            g["move"] += np.exp(a[k][:, :, None] + move + (s[k + 1] + b[k + 1] - z[:, None])[:, None, :]).sum(0)
            np.add.at(g["move"], (y[:, k], y[:, k + 1]), -1)
        ds[np.arange(t)[:, None], np.arange(n), y.T] -= 1
        ds /= n
        g["move"] /= n
        g["out"], g["bias"] = np.einsum("tnh,tnk->hk", h, ds), ds.sum((0, 1))
        dh = ds @ self.p["out"].T
        de = np.zeros_like(e)
        for d, tape, part in (("f", tf, dh[:, :, :HIDDEN]), ("b", tb, dh[:, :, HIDDEN:])):
            wx, wh = self.p[f"x{d}"], self.p[f"h{d}"]
            gx, gh, gb = np.zeros_like(wx), np.zeros_like(wh), np.zeros(4 * HIDDEN, np.float32)
            up, cc = np.zeros((n, HIDDEN), np.float32), np.zeros((n, HIDDEN), np.float32)
            for k, i, f, o, gg, c, tc, h0 in reversed(tape):
                dhk = part[k] + up
                dc = dhk * o * (1 - tc**2) + cc
                dz = np.concatenate([dc * gg * i * (1 - i), dc * c * f * (1 - f), dhk * tc * o * (1 - o), dc * i * (1 - gg**2)], 1)
                gx += e[k].T @ dz
                gh += h0.T @ dz
                gb += dz.sum(0)
                de[k] += dz @ wx.T
                up, cc = dz @ wh.T, dc * f
            g |= {f"x{d}": gx, f"h{d}": gh, f"b{d}": gb}
        g["e"] = np.zeros_like(self.p["e"])
        np.add.at(g["e"], x.T, de)
        return g

    def train(self, x: np.ndarray, y: np.ndarray, steps: int = STEPS, rate: float = 0.02) -> None:
        """Adam over shuffled batches, so many passes as ``steps`` batches need."""
        epochs = -(-steps * BATCH // max(len(x), BATCH))
        r = np.random.default_rng(SEED)
        m, v, k = {n: np.zeros_like(p) for n, p in self.p.items()}, {n: np.zeros_like(p) for n, p in self.p.items()}, 0
        for epoch in range(epochs):
            order = r.permutation(len(x))
            for lo in range(0, len(x), BATCH):
                at = order[lo : lo + BATCH]
                k += 1
                for n, g in self.gradient(x[at], y[at]).items():
                    g = np.clip(g, -1, 1)
                    m[n] = 0.9 * m[n] + 0.1 * g
                    v[n] = 0.99 * v[n] + 0.01 * g * g
                    self.p[n] = (self.p[n] - rate * (1 - epoch / epochs) * (m[n] / (1 - 0.9**k)) / (np.sqrt(v[n] / (1 - 0.99**k)) + 1e-6)).astype(np.float32)

    def decode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Best tags (batch, time), and each place's margin of its tag over O."""
        s, _ = self.scores(x)
        t, n, _ = s.shape
        move, best, back = self.p["move"], s[0], np.zeros((t, n, TAGS), np.int8)
        for k in range(1, t):
            z = best[:, :, None] + move
            back[k] = z.argmax(1)
            best = s[k] + z.max(1)
        out = np.zeros((n, t), np.int64)
        out[:, -1] = best.argmax(1)
        for k in range(t - 1, 0, -1):
            out[:, k - 1] = back[k][np.arange(n), out[:, k]]
        return out, np.take_along_axis(s, out.T[:, :, None], 2)[:, :, 0].T - s[:, :, 0].T


# ---------------------------------------------------------------- windows and reconciliation


def windows(c: np.ndarray) -> np.ndarray:
    """Starts of the windows (half overlapping, the last one shorter) that can hold a span."""
    digits = (c >= 48) & (c <= 57)
    solid = digits | ((c >= 65) & (c <= 90)) | ((c >= 97) & (c <= 122))
    edge = np.diff(np.r_[0, solid.astype(np.int8), 0])
    lo, hi = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    digit = np.r_[0, np.cumsum(digits)]
    run = (hi - lo >= MIN_RUN) & (digit[hi] > digit[lo])
    mark = (c == 64).astype(np.int64)
    np.add.at(mark, lo[run], 1)
    np.add.at(mark, hi[run] - 1, 1)
    if len(c) > 3:
        low = c | 32
        mark[:-3] += ((c[:-3] == 40) | (c[:-3] == 91)) & (low[1:-2] == 97) & (low[2:-1] == 116) & ((c[3:] == 41) | (c[3:] == 93))
    mark = np.r_[0, np.cumsum(mark)]
    start = np.arange(0, max(len(c) - STRIDE, 1), STRIDE)
    end = np.minimum(start + SIZE, len(c))
    return start[(digit[end] - digit[start] >= MIN_DIGITS) | (mark[end] > mark[start])]


def padded(c: np.ndarray, starts: np.ndarray) -> np.ndarray:
    full = np.r_[c, np.full(SIZE, 129)]
    return full[starts[:, None] + np.arange(SIZE)]


def tagged(tags: np.ndarray, margin: np.ndarray) -> Iterator[tuple[int, int, int, float]]:
    """(start, kind, end, score) in a window: a B or I and the I of its kind after it."""
    k = 0
    while k < len(tags):
        if tags[k] == 0:
            k += 1
            continue
        kind, a = (tags[k] - 1) // 2, k
        k += 1
        while k < len(tags) and tags[k] == 2 * kind + 2:
            k += 1
        yield a, int(kind), k, float(margin[a:k].mean())


def put_together(found: list[tuple[int, int, int, float]]) -> list[tuple[int, int, int, float]]:
    """Spans (start, kind, end, margin per place), and the unions of those of a kind that overlap."""
    out: dict[tuple[int, int, int], float] = {}
    chain: dict[int, tuple[int, int, float]] = {}
    for a, kind, z, score in sorted(found):
        out[a, kind, z] = max(score, out.get((a, kind, z), -np.inf))
        lo, hi, m = chain.get(kind, (a, a, score))
        chain[kind] = (lo, max(hi, z), max(m, score)) if a < hi else (a, z, score)
        lo, hi, m = chain[kind]
        out[lo, kind, hi] = max(m, out.get((lo, kind, hi), -np.inf))
    return [(*k, v) for k, v in out.items()]


def reconcile(base: list[tuple[int, int, int]], found: list[tuple[int, int, int, float]]) -> list[tuple[int, int, int]]:
    """Base spans, and the non-overlapping others of the greatest total margin (per place, times the length)."""
    taken, upto = sorted((a, z) for a, _, z in base), []
    for _, z in taken:
        upto.append(max(z, upto[-1] if upto else 0))
    best: dict[tuple[int, int, int], float] = {}
    for a, kind, z, score in found:
        k = bisect_left(taken, (z, 0))  # base spans that begin before this one ends
        if score > 0 and not (k and upto[k - 1] > a):
            best[a, kind, z] = max(score * (z - a), best.get((a, kind, z), 0.0))
    spans = sorted(best, key=lambda s: (s[2], s[0], s[1]))
    ends = [s[2] for s in spans]
    total, pick = [0.0], [None]
    for i, s in enumerate(spans):
        j = bisect_right(ends, s[0], 0, i)
        got = total[j] + best[s]
        total.append(max(got, total[-1]))
        pick.append(j if got > total[i] else None)
    out, i = list(base), len(spans)
    while i:
        if pick[i] is None:
            i -= 1
        else:
            out.append(spans[i - 1])
            i = pick[i]
    return sorted(out)


def trimmed(text: str):
    """Of a span: without white space around it, or None where it doesn't read as its kind or ends within a word."""

    def of(span: tuple[int, int, int, float]) -> tuple[int, int, int, float] | None:
        a, kind, z, score = span
        got = text[a:z]
        a, z = a + len(got) - len(got.lstrip()), z - (len(got) - len(got.rstrip()))
        if a >= z or not CHECK[KINDS[kind]](text[a:z]) or (z < len(text) and text[z].isalnum()) or (a and text[a - 1].isalnum()):
            return None
        return a, kind, z, score

    return of


# ---------------------------------------------------------------- Spark


def secret_spans(text: str) -> list[tuple[int, int, int]]:
    """Labels only: secrets are no base spans."""
    out = []
    for m in SECRETS.finditer(text):
        a, z = m.span(1) if m[1] else m.span()
        if CHECK["secret"](text[a:z]):
            out.append((a, KINDS.index("secret"), z))
    return out


def written_otherwise(kind: str, s: str, choice: int) -> str:
    if kind == "email":
        at, dot = ((" (at) ", "."), ("[at]", "[dot]"), (" [at] ", " [dot] "), ("(at)", "(dot)"))[choice % 4]
        name, _, domain = s.partition("@")
        return name + at + domain.replace(".", dot)
    if kind == "ip":
        return s.replace(".", ("[.]", "(.)", "[dot]")[choice % 3])
    if kind == "card":
        d, sep = _digits(s), (".", "/", "_")[choice % 3]
        return sep.join(d[i : i + 4] for i in range(0, len(d), 4))
    if kind == "phone":
        return s[1:]
    # a secret: other letters and digits in the same places, in small letters or capitals
    seed = hashlib.sha256(s.encode()).digest() * (len(s) // 32 + 1)
    pools = ("0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ")
    out = "".join(next((p[b % len(p)] for p in pools if c in p), c) for c, b in zip(s, seed, strict=False))
    return (out, out.upper(), out.lower())[choice % 3]


def tagged_text(pieces: list[tuple[str, int]]) -> tuple[str, list[int]]:
    """A window's text and tags from its pieces (text, kind or -1)."""
    tags: list[int] = []
    for s, kind in pieces:
        tags += [0] * len(s) if kind < 0 else [2 * kind + 1] + [2 * kind + 2] * (len(s) - 1)
    return "".join(s for s, _ in pieces)[:SIZE], tags[:SIZE]


def labelled(text: str) -> Iterator[tuple[str, list[int]]]:
    """Windows with tags: around each labelled span, as it is and written otherwise, and around digits that are none."""
    spans = base_spans(text)
    taken = [(a, z) for a, _, z in spans]
    spans = sorted(spans + [x for x in secret_spans(text) if not any(x[0] < z and a < x[2] for a, z in taken)])
    lows = [a for a, _, _ in spans]
    for s in windows(codes(text)).tolist():
        s = max(0, s - SIZE // 4)
        pieces, at = [], s
        for a, kind, z in spans[max(bisect_left(lows, s - SIZE) - 1, 0) : bisect_left(lows, s + SIZE)]:
            a, z = max(a, at), min(z, s + SIZE)
            if z > a:
                pieces += [(text[at:a], -1), (text[a:z], kind)]
                at = z
        pieces.append((text[at : s + SIZE], -1))
        pieces = [x for x in pieces if x[0]]
        yield tagged_text(pieces)
        if any(kind >= 0 for _, kind in pieces):
            choice = hashlib.md5(text[s : s + SIZE].encode("utf-8", "replace")).digest()[0]
            whole = [(written_otherwise(KINDS[k], p, choice), k) if k >= 0 and CHECK[KINDS[k]](p) else (p, k) for p, k in pieces]
            yield tagged_text([x for x in whole if x[0]])


def drawn(docs: DataFrame, text: str = "text") -> list[Row]:
    """(class, rank, part, tags): of each class its share of the distinct windows, by hash."""
    Rows = list[dict[int, tuple[str, list[int]]]]

    def lowest(rows: Rows, k: int) -> list[int]:
        return sorted(rows[k])[: SHARES[k]]

    def out(rows: Rows) -> Iterator[pa.RecordBatch]:
        for k, of in enumerate(rows):
            keep = lowest(rows, k)
            yield pa.RecordBatch.from_arrays([pa.array([k] * len(keep), pa.int32()), pa.array(keep, pa.int64()), pa.array([of[r][0] for r in keep], pa.string()), pa.array([of[r][1] for r in keep], pa.list_(pa.int32()))], ["class", "rank", "part", "tags"])

    def add(rows: Rows, k: int, rank: int, part: str, tags: list[int]) -> None:
        rows[k][rank] = (part, tags)
        if len(rows[k]) > 4 * SHARES[k]:
            rows[k] = {r: rows[k][r] for r in lowest(rows, k)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: Rows = [{} for _ in SHARES]
        for b in batches:
            for x in b.column(0):
                s = x.as_py()
                if s and ANY.search(s):
                    for part, tags in labelled(s):
                        rank = int.from_bytes(hashlib.md5(part.encode("utf-8", "replace") + bytes(tags)).digest()[:7], "big")
                        has = sorted({(t - 1) // 2 for t in tags if t})
                        add(rows, has[rank % len(has)] if has else len(KINDS), rank, part, tags)
        yield from out(rows)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: Rows = [{} for _ in SHARES]
        for b in batches:
            for r in b.to_pylist():
                add(rows, r["class"], r["rank"], r["part"], r["tags"])
        yield from out(rows)

    # each task has its lowest ranks; they are merged in levels, so no task and no driver reads more than FAN_IN results
    kind = "class int, rank long, part string, tags array<int>"
    with scope(docs.sparkSession):
        found = written(docs.select(F.col(text).cast("string")).mapInArrow(run, kind), "windows")
        parts = docs.rdd.getNumPartitions()
        while parts > 1:
            parts = -(-parts // FAN_IN)
            found = written(found.repartition(parts).mapInArrow(merge, kind), "windows")
        return sorted(found.collect(), key=lambda r: (r["class"], r["rank"]))  # MAX_FIT rows at most


def as_arrays(rows: list[Row]) -> tuple[np.ndarray, np.ndarray]:
    x, y = np.full((len(rows), SIZE), 129), np.zeros((len(rows), SIZE), np.int64)
    for i, r in enumerate(rows):
        c = codes(r.part)
        x[i, : len(c)] = c
        y[i, : len(r.tags)] = r.tags
    return x, y


def margins(tagger: Tagger, rows: list[Row]) -> np.ndarray:
    """Of each kind the least margin at which ``PRECISION`` of the spans found in windows, and reading as their kind, are right."""
    x, y = as_arrays(rows)
    tags, margin = tagger.decode(x)
    found: list[list[tuple[float, bool]]] = [[] for _ in KINDS]
    for i, r in enumerate(rows):
        for span in map(trimmed(r.part), tagged(tags[i], margin[i])):
            if span:
                a, kind, z, score = span
                found[kind].append((score, bool((y[i, a:z] > 0).all()) and kind == (y[i, a] - 1) // 2))
    out = np.zeros(len(KINDS))
    for k, of in enumerate(map(sorted, found)):
        for i, (score, _) in enumerate(of):
            if sum(right for _, right in of[i:]) >= PRECISION * len(of[i:]):
                out[k] = max(score - 1e-6, 0.0) if i else 0.0
                break
    return out


def fit(docs: DataFrame, text: str = "text") -> Tagger | None:
    """Train on at most ``MAX_FIT`` windows; None if the corpus has no labelled span."""
    rows = [r for r in drawn(docs, text) if r.part]
    if not any(any(r.tags) for r in rows):
        return None
    hold = np.arange(len(rows)) % HOLD == 0 if len(rows) >= 20 * HOLD else np.zeros(len(rows), bool)
    tagger = Tagger()
    tagger.train(*as_arrays([r for r, h in zip(rows, hold, strict=True) if not h]))
    if hold.any():
        tagger.least = margins(tagger, [r for r, h in zip(rows, hold, strict=True) if h])
    return tagger


def find(docs: DataFrame, tagger: Tagger | None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, base, spans): arrays of (kind, start, end), by start and kind's place."""
    d = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    kind = d.schema["doc_id"].dataType.simpleString()
    item = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])
    schema = pa.schema([("base", pa.list_(item)), ("spans", pa.list_(item))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        named = lambda spans: [{"kind": KINDS[k], "start": a, "end": z} for a, k, z in spans]
        for b in batches:
            for lo in range(0, b.num_rows, 256):
                part = b.slice(lo, 256)
                texts = part.column(1).to_pylist()
                base = [base_spans(t) if t else [] for t in texts]
                found: list[list] = [[] for _ in texts]
                if tagger:
                    owner, starts, xs = [], [], []
                    for i, t in enumerate(texts):
                        if t and ANY.search(t):
                            c = codes(t)
                            s = windows(c)
                            owner += [i] * len(s)
                            starts += s.tolist()
                            xs.append(padded(c, s))
                    if owner:
                        x = np.concatenate(xs)
                        for k in range(0, len(x), 512):
                            tags, margin = tagger.decode(x[k : k + 512])
                            for j in np.flatnonzero(tags.any(1)).tolist():
                                i, s = owner[k + j], starts[k + j]
                                for a, kd, z, score in tagged(tags[j], margin[j]):
                                    found[i].append((a + s, kd, min(z + s, len(texts[i])), score - tagger.least[kd]))
                found = [[x for x in map(trimmed(t), put_together(f)) if x] if f else f for t, f in zip(texts, found, strict=True)]
                every = [reconcile(x, f) if f else x for x, f in zip(base, found, strict=True)]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([named(x) for x in base], schema.field("base").type), pa.array([named(x) for x in every], schema.field("spans").type)], ["doc_id", "base", "spans"])

    return d.mapInArrow(run, f"doc_id {kind}, base array<struct<kind string, start long, end long>>, spans array<struct<kind string, start long, end long>>")


def find_pii(docs: DataFrame) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_secret, n_spans): counts and text of all spans."""
    got = find(docs, fit(docs))
    text = lambda c: F.array_join(F.transform(c, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    counts = [F.expr(f"cast(size(filter(spans, s -> s.kind = '{k}')) as long)").alias(f"n_{k}") for k in KINDS]
    return got.select("doc_id", *counts[:-1], F.sha2(text("base").cast("binary"), 256).alias("base_sha256"), text("spans").alias("spans"), counts[-1], F.size("spans").cast("long").alias("n_spans"))
