"""Hard negatives, packing and tokenizer alignment against plain versions; nulls, ties, repeats, empty tables."""

import collections
import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from cdcspark.llm import alignment, hard_negatives, packing, queries, units
from cdcspark.llm.common import Texts

BYTE, PIECE = "byte_bpe_50k.json", "piece_bpe_32k.model"
ODD = ["", " ", "  two  spaces ", "Ünïcode é à  ß", "tab\tand\nline\r\n  end\n", "a b c", "non breaking 　wide space", "don't we'll it's", "x<|endoftext|> y <|endoftext|>", "<s> </s> <unk> <0x41>", "▁ and ▁x", "\x00nul", "emoji 👍🏽 text", "word " * 3000, "z" * 5000, "1234567 89 0,5", "日本語 の 文章", "é é é", "end é", "trailing  ", "É É x"]


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


# ---------------------------------------------------------------- hard negatives


def plain_negatives(data, every=100, k=5, m=10):
    live = {}
    for vec_id, label, vec in data:
        if vec_id is None or label is None or vec is None or any(x is None or not np.isfinite(x) for x in vec):
            continue
        live[vec_id, label, tuple(int(np.floor(256 * x)) for x in vec)] = None
    score = lambda a, b: sum(x * y for x, y in zip(a[2], b[2]))
    out = []
    for a in live:
        if a[0] % every:
            continue
        s = sorted((-score(a, r), r[0], r[1]) for r in live)
        for p, pid, _ in [x for x in s if x[2] == a[1] and x[1] != a[0]][:k]:
            hits = [x for x in s if x[2] != a[1] and 30 * -p <= 100 * -x[0] <= 90 * -p][:m]
            out += [(a[0], pid, i + 1, nid, -p, -n) for i, (n, nid, _) in enumerate(hits)]
    return sorted(out, key=str)


def mined(spark, data, **more):
    df = spark.createDataFrame(data, "vec_id long, label int, embedding array<float>").withColumns({c: F.lit("x") for c in ("shelf", "anchor", "score", "n")})
    return rows(hard_negatives.mine(df.repartition(3), **more))


def test_negatives_with_ties_repeats_and_nulls(spark):
    rng = random.Random(3)
    vec = lambda: [rng.choice([-1.0, -0.25, 0.0, 0.125, 0.5, 1.0]) for _ in range(6)]
    data = [(i, rng.choice([1, 1, 1, 2, 3]), vec()) for i in range(400)]
    data += data[:30] + [(7, 1, [1.0] * 6), (100, 2, [0.5] * 6)]  # repeated rows; one id with two contents
    data += [(500 + i, 1, [0.5] * 6) for i in range(60)] + [(800 + i, 2, [0.5, 0.5, 0.5, 0.5, 0.0, 0.0]) for i in range(60)]  # many alike
    data += [(None, 1, vec()), (900, None, vec()), (1000, 1, None), (1100, 1, [1.0, None]), (1200, 1, [float("nan")] * 6), (1300, 1, [float("inf")] * 6), (1400, 1, []), (1500, 2, [1.0]), (1501, 2, [1.0, 1.0]), (-100, 1, vec())]
    got = mined(spark, data)
    assert got == plain_negatives(data) and len({r[0] for r in got}) > 5


def test_negatives_of_few_or_no_rows(spark):
    assert mined(spark, []) == []
    assert mined(spark, [(0, 1, [1.0])]) == []
    assert mined(spark, [(0, 1, [1.0]), (1, 1, [1.0]), (2, 2, [0.5])]) == [(0, 1, 1, 2, 65536, 32768)]
    assert mined(spark, [(0, 1, [3e38]), (1, 1, [3e38]), (2, 2, [2e5])])[0][3] == 2  # held to the largest component


@pytest.mark.parametrize("spread", [0.0, 2.0])
def test_pruned_search_finds_what_all_scores_find(spread):
    """Blocks are passed over and cut down by feasible ranges, and yet no row is lost."""
    rng = np.random.default_rng(5)
    centre = rng.normal(size=(20, 16))
    vec = centre[rng.integers(0, 20, 6000)] + 0.15 * rng.normal(size=(6000, 16))
    vec *= np.exp(spread * rng.random(6000))[:, None] * 60
    vec = np.floor(vec).astype(np.int32)
    ids, length = np.arange(6000), np.linalg.norm(vec, axis=1)
    order = np.argsort(-length, kind="stable")
    blocks = [hard_negatives.Block(1, ids[o], vec[o], length[o]) for o in np.array_split(order, 12)]
    who = np.arange(0, 6000, 60)
    low, high = np.full(1, -(1 << 62)), np.full(1, 1 << 62)
    find = hard_negatives.Search(ids[who], np.ones(len(who), int), vec[who], [low] * len(who), [high] * len(who), 5, True)
    scored = [0]
    whole = hard_negatives.Block.scores
    for b in blocks:
        b.scores = lambda a, r=None, b=b: (scored.__setitem__(0, scored[0] + len(a) * (len(b.ids) if r is None else len(r))), whole(b, a, r))[1]
        find.meet(b)
    exact = vec[who].astype(np.int64) @ vec.T.astype(np.int64)
    for j, w in enumerate(who):
        best = sorted((-s, i) for i, s in enumerate(exact[j].tolist()) if i != w)[:5]
        assert [(-s, i) for s, i in zip(*map(list, find.pool[j]))] == best
    assert scored[0] < 0.6 * exact.size
    # bands below a cap, of which some overlap
    bands = [np.array([s * 3 // 10 for s in x]) for x in np.sort(exact)[:, -5:].tolist()], [np.array([s * 9 // 10 for s in x]) for x in np.sort(exact)[:, -5:].tolist()]
    find = hard_negatives.Search(ids[who], np.zeros(len(who), int), vec[who], *bands, 10, False)
    for b in blocks:
        find.meet(b)
    for j in range(len(who)):
        every = sorted((-s, i) for i, s in enumerate(exact[j].tolist()))
        have = {(-s, i) for s, i in zip(*map(list, find.pool[j]))}
        for a, z in zip(bands[0][j], bands[1][j]):
            assert set([x for x in every if a <= -x[0] <= z][:10]) <= have


# ---------------------------------------------------------------- packing


def plain_best_fit(lengths, window):
    """Fill of each window, one piece after another."""
    rooms = []
    for n in sorted(lengths, reverse=True):
        fits = [r for r in rooms if r >= n]
        if fits:
            rooms.remove(min(fits))
            rooms.append(min(fits) - n)
        else:
            rooms.append(window - n)
    return sorted(window - r for r in rooms)


@pytest.mark.parametrize("seed", range(6))
def test_plan_is_best_fit_decreasing(seed):
    rng = random.Random(seed)
    window = [16, 64, 100, 2048][seed % 4]
    pool = [rng.randint(1, window) for _ in range(rng.randint(1, 30))]
    lengths = [rng.choice(pool) for _ in range(600)] if seed % 2 else [rng.randint(1, window) for _ in range(600)]
    count = collections.Counter(lengths)
    plan = packing.best_fit_decreasing(count, window)
    n, rank = np.array([x for x, c in count.items() for _ in range(c)]), np.array([i for c in count.values() for i in range(c)])
    seq, offset = plan.of(n, rank)
    fill = collections.defaultdict(list)
    for s, o, x in zip(seq.tolist(), offset.tolist(), n.tolist()):
        fill[s].append((o, x))
    for s in fill.values():
        assert [o for o, _ in sorted(s)] == np.r_[0, np.cumsum([x for _, x in sorted(s)])][:-1].tolist()
    assert set(fill) == set(range(plan.windows))
    assert sorted(sum(x for _, x in s) for s in fill.values()) == plain_best_fit(lengths, window)


def test_tightest_room():
    tree = packing.Tightest(20)
    for room in (0, 3, 7, 20):
        tree.mark(room, True)
    assert [tree.at_least(k) for k in (0, 1, 3, 4, 8, 20)] == [0, 3, 3, 7, 20, 20]
    tree.mark(20, False)
    assert tree.at_least(8) is None and packing.best_fit_decreasing({}, 8).windows == 0


def test_packs_odd_texts(spark):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(queries.vocabulary(BYTE))
    data = list(enumerate(ODD)) + [(None, "no id"), (99, None), (3, ODD[3])]
    df = spark.createDataFrame(data, "doc_id long, text string").withColumns({c: F.lit(1) for c in ("length", "part", "place", "n")})
    got = packing.pack(df.repartition(3), queries.vocabulary(BYTE), window=256, with_ids=True).collect()
    want = collections.Counter()
    for i, text in data:
        ids = [*tok.encode(text or "", add_special_tokens=False).ids, 1]
        want.update((i, k, zlib.crc32(np.array(ids[k : k + 256], "<u4").tobytes()), len(ids)) for k in range(0, len(ids), 256))
    assert collections.Counter((r.doc_id, r.start, r.ids_crc32, r.doc_tokens) for r in got) == want
    assert all(len(r.ids) == 4 * r.length and zlib.crc32(r.ids) == r.ids_crc32 for r in got)
    by = collections.defaultdict(list)
    for r in got:
        by[r.sequence_id].append((r.offset, r.length))
    assert all([o for o, _ in sorted(s)] == np.r_[0, np.cumsum([n for _, n in sorted(s)])][:-1].tolist() and sum(n for _, n in s) <= 256 for s in by.values())
    assert sorted(sum(n for _, n in s) for s in by.values()) == plain_best_fit([r.length for r in got], 256)
    assert packing.pack(df.limit(0), queries.vocabulary(BYTE)).count() == 0


# ---------------------------------------------------------------- alignment


def plain_alignment(texts):
    v = alignment.Vocabularies.load(queries.vocabulary(BYTE), queries.vocabulary(PIECE))
    each = []
    for text in texts:
        a, b = ([], []) if not text else (v.a.encode(" " + text, add_special_tokens=False).ids, v.b.encode(text))
        ra, rb = [v.a_bytes[i] for i in a], [v.b_bytes[i] for i in b]
        if not text or b"".join(ra) != f" {text}".encode() or b"".join(rb) != f" {text}".encode():
            each.append(None)
            continue
        ends = np.intersect1d(np.cumsum(list(map(len, ra))), np.cumsum(list(map(len, rb))))
        i, j = (np.r_[0, np.searchsorted(np.cumsum(list(map(len, r))), ends) + 1] for r in (ra, rb))
        groups = [(a[x:y], b[p:q]) for x, y, p, q in zip(i, i[1:], j, j[1:])]
        each.append((len(a), len(b), groups))
    links = [[(g[-1], h[-1]) for g, h in x[2]] if x else [] for x in each]
    count = collections.Counter(p for x in links for p in x)
    top = collections.Counter()
    for (_, b), n in count.items():
        top[b] = max(top[b], n)
    for x, own in zip(each, links):
        if not x:
            yield 0, 0, 0, 0, 0, 0, ""
        else:
            text = ";".join(f"{','.join(map(str, a))}|{','.join(map(str, b))}" for a, b in x[2])
            yield x[0], x[1], len(x[2]), len(own), sum(count[p] == top[p[1]] for p in own), sum(count[p] for p in own), hashlib.sha256(text.encode()).hexdigest()


def test_aligns_odd_texts(spark):
    data = list(enumerate(ODD)) + [(None, "no id"), (99, None), (3, ODD[3])]
    df = spark.createDataFrame(data, "doc_id long, text string").withColumns({c: F.lit(1) for c in ("links", "n_a", "pair")})
    got = alignment.align_tokenizers(df.repartition(3), queries.vocabulary(BYTE), queries.vocabulary(PIECE))
    want = [(i, *x) for (i, _), x in zip(data, plain_alignment([t for _, t in data]))]
    assert rows(got.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")) == sorted(want, key=str)
    assert alignment.align_tokenizers(df.limit(0), queries.vocabulary(BYTE), queries.vocabulary(PIECE)).count() == 0


def test_tokens_without_bytes_end_with_the_one_before():
    got = list(alignment.align([1, 2, 3], [2, 0, 3], [7, 8], [2, 3]))
    assert got == [([1, 2], [7], [(1, 7), (2, 7)]), ([3], [8], [(3, 8)])]


def test_units_cover_texts_and_are_told_apart():
    raw = [t.encode() for t in ODD]
    t = Texts(0, np.frombuffer(b"".join(raw), np.uint8), np.r_[0, np.cumsum(list(map(len, raw)))])
    start, end, first = units.cut(t)
    for k, text in enumerate(raw):
        assert b"".join(t.buf[i:j].tobytes() for i, j in zip(start[first[k] : first[k + 1]], end[first[k] : first[k + 1]])) == text

    class Names(units.Units):
        def forget(self):
            super().forget()
            self.names = []

        def learn(self, more):
            self.names += more

    for limit in (1_000_000, 5):
        units.CACHE_UNITS, keep = limit, units.CACHE_UNITS
        try:
            own = Names()
            for _ in range(3):
                got = [own.names[i] for i in own.numbers(t.buf, start, end)]
                assert got == [t.buf[i:j].tobytes() for i, j in zip(start, end)]
        finally:
            units.CACHE_UNITS = keep
