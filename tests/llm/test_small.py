"""Edge cases and brute-force comparisons of the corpus operators on small fixtures."""

import hashlib
import io
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from cdcspark.llm import common, decontaminate, divergence, mixing, ngram_join, pii, suffix_dedup, token_store, toxicity, url_filter, zip_warc

WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def corpus():
    """Null, empty, long, repeated and near-copied texts; ids with ties and a null."""
    rng = random.Random(11)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7)))
    text = lambda n: " ".join(word() for _ in range(n))
    rows = [(i, text(rng.randint(1, 140)), rng.choice(["en", "de", None]), rng.choice(["s1", "s2", None, "S0"])) for i in range(80)]
    base = text(120).split()
    for i in range(80, 110):
        copy = list(base)
        for _ in range(rng.randint(0, 6)):
            copy[rng.randrange(len(copy))] = word()
        rows.append((i, " ".join(copy), "en", "s1"))
    rows += [(200, None, None, None), (201, "", "en", "s1"), (202, " \n\t", "en", "s1"), (203, rows[5][1], "en", "s1"), (203, rows[5][1], "en", "s1"), (5, text(60), "en", "s2"), (None, text(80), "en", "s1"), (204, "x " * 5000 + "Ünïcode " * 300, "en", "s2"), (205, "A b\nA b\n\nA b", "en", "s1")]
    return rows


@pytest.fixture(scope="module")
def docs(spark, corpus):
    return spark.createDataFrame([(*r, 1, "x") for r in corpus], "doc_id long, text string, lang string, source string, n long, cls string").repartition(3)


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_empty_tables(spark, docs):
    none = docs.limit(0)
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    items = spark.createDataFrame([], "item_id long, text string")
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    import public_tokenizers

    vocab = public_tokenizers.path("word_bpe_49k.json")
    for df in (divergence.judge(none), mixing.mix_sources(none), url_filter.filter_urls(pages), pii.find_pii(none), decontaminate.search(none, items), decontaminate.search(docs, items), suffix_dedup.dedup_substrings(none), toxicity.toxicity(none, labels), token_store.token_store(none, vocab), ngram_join.jaccard_components(none), zip_warc.zip_warc(pages)):
        assert df.count() == 0
    assert toxicity.toxicity(docs, labels).filter("predicted = 1").count() == 0


def test_base_quality_counts(corpus, docs):
    def brute(t):
        t = t or ""
        w, seen, dup = WORD.findall(t), set(), 0
        for line in t.split("\n"):
            if WORD.search(line):
                dup += line in seen
                seen.add(line)
        c = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
        hit = {j for i in range(len(w) - 2) if c[tuple(w[i : i + 3])] > 1 for j in range(i, i + 3)}
        return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), dup, len(hit), len(w) < 50 or 100 * len(hit) > 50 * len(w)

    got = divergence.judge(docs).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    assert rows(got) == sorted(((r[0], *brute(r[1])) for r in corpus), key=str)
    assert divergence.judge(docs).filter("base_failed and kept").count() == 0


def test_js_distance_tells_junk(spark):
    rng = random.Random(2)
    word = lambda: rng.choice(["the", "of", "and", *("".join(rng.choice("abcdeilnorst") for _ in range(6)) for _ in range(3))])
    good = [(i, " ".join(word() for _ in range(150)), "en") for i in range(60)]
    junk = [(1000 + i, " ".join(word() + "%%%#$" for _ in range(150)), "en") for i in range(3)]
    out = {r.doc_id: r for r in divergence.judge(spark.createDataFrame(good + junk, "doc_id long, text string, lang string")).collect()}
    assert all(out[r[0]].kept for r in good) and not any(out[r[0]].kept for r in junk)


def test_js_distance_tells_junk_of_plain_letters(spark):
    rng = random.Random(3)
    made = lambda: "".join(rng.choice("abcdeilnorst") for _ in range(rng.randint(2, 8)))
    vocab = [made() for _ in range(400)]
    weights = [1 / (k + 1) for k in range(400)]
    good = [(i, " ".join(rng.choices(vocab, weights, k=rng.randint(130, 250))), rng.choice(["en", "de"])) for i in range(150)]
    good += [(i, good[0][1], "en") for i in range(150, 300)]  # many copies do not narrow the limits
    junk = [(1000 + i, " ".join(made() for _ in range(200)), "en") for i in range(5)]
    out = {r.doc_id: r for r in divergence.judge(spark.createDataFrame(good + junk, "doc_id long, text string, lang string")).collect()}
    assert all(out[r[0]].kept for r in good)
    assert not any(out[r[0]].kept or out[r[0]].base_failed or out[r[0]].class_distance > divergence.MAX_CLASS for r in junk)


def test_mixing_targets_and_caps(docs, corpus):
    assert mixing.targets([10, 10, 80], [5, 2, 1], 3) == [30.0, 30.0, 40.0]
    assert mixing.targets([0, 5], [5, 2], 3) == [0.0, 5.0]
    got = mixing.mix_sources(docs).collect()
    assert len(got) == len(corpus) and all(r.taken <= 3 * r.size for r in got)
    assert rows(mixing.mix_sources(docs.repartition(5))) == rows(mixing.mix_sources(docs))
    src = {(r[0], len(WORD.findall(r[1] or ""))): r[3] for r in corpus}
    taken, target, most = Counter(), {}, Counter()
    for r in got:
        s = src[r.doc_id, r.size]
        taken[s] += r.taken
        target[s] = r.target
        most[s] = max(most[s], r.size)
    assert all(abs(taken[s] - target[s]) <= most[s] for s in target)


def test_url_rules_and_trust(spark):
    link = lambda *hosts: "".join(f'<a href="https://{h}/x">' for h in hosts)
    pages = [
        (1, "https://A.Example.ORG/es/1", link("bad.com")), (2, "http://example.org/en/12", ""), (3, "http://example.org/en/2?u=1", link("good.net")), (4, "http://x.com/fr/", link("good.net")),
        (5, "http://bad.com/de/x", ""), (6, "http://good.net/a", ""), (7, "http://spam.net/#z", link("bad.com", "bad.com")), (8, None, None), (9, "no scheme", "x"), (10, "://", None), (11, "http://notorg/", ""), (6, "http://good.net/a", ""),
    ]
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_filter.filter_urls(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()}
    assert got[1] == ("a.example.org", "/es/1", "example.org/es/", "block")
    assert got[2][2:] == ("example.org/en/1", "block") and got[3][2:] == ("org/", "allow") and got[4][2:] == ("com/fr/", "allow") and got[5][2:] == ("com/de/", "block")
    assert got[6] == ("good.net", "/a", None, "allow") and got[7] == ("spam.net", "/", None, "block")
    assert got[8] == got[9] == ("", "", None, "allow") and got[10][0] == "" and got[11] == ("notorg", "/", None, "allow")


def test_base_spans_match_the_patterns():
    kinds = [r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]"]

    def brute(t):
        out = []
        for k, p in enumerate(kinds):
            for m in re.finditer(p, t):
                d = re.sub("[^0-9]", "", m[0])
                ok = (True, k != 1 or all(int(x) <= 255 for x in m[0].split(".")), 14 <= len(d) <= 19 and pii.luhn(d), 10 <= len(d) <= 15)[k]
                out += [(m.start(), k, m.end())] * ok
        return sorted(out)

    rng = random.Random(4)
    for _ in range(5000):
        t = "".join(rng.choice(["a", "1", "0", "25", "@", ".", "-", "+", " ", "(", ")", "é", "_", "4111 1111 1111 1111"]) for _ in range(rng.randint(1, 25)))
        assert pii.base_spans(t) == brute(t), t


def test_tagger_gradient_and_reconciliation():
    t, r = pii.Tagger(1), np.random.default_rng(0)
    x, y = r.integers(0, 130, (3, 7)), r.integers(0, pii.TAGS, (3, 7))
    t.p = {k: v.astype(np.float64) for k, v in t.p.items()}

    def loss():
        s, _ = t.scores(x)
        a = s[0]
        for k in range(1, len(s)):
            a = s[k] + pii.lse(a[:, :, None] + t.p["move"], 1)
        path = sum(s[k][np.arange(3), y[:, k]] for k in range(7)) + sum(t.p["move"][y[:, k], y[:, k + 1]] for k in range(6))
        return float((pii.lse(a, 1) - path).mean())

    g = t.gradient(x, y)
    for k in ("move", "out", "xf", "hb"):
        i = tuple(r.integers(0, n) for n in t.p[k].shape)
        v = t.p[k][i]
        t.p[k][i] = v + 1e-3
        up = loss()
        t.p[k][i] = v - 1e-3
        down = loss()
        t.p[k][i] = v
        assert abs((up - down) / 2e-3 - g[k][i]) < 1e-3
    assert pii.reconcile([(5, 0, 9)], [(0, 1, 4, 1.0), (3, 1, 5, 0.5), (8, 2, 12, 9.0), (10, 3, 14, 2.0), (10, 3, 14, 1.0)]) == [(0, 1, 4), (5, 0, 9), (10, 3, 14)]


def test_pii_query_keeps_base_spans(spark):
    data = [(i, f"mail a{i}.b@mail{i}.example.com now, ip 10.0.{i}.7 and +1 (555) 555-01{i:02d} or card 4111 1111 1111 1111") for i in range(30)] + [(100, None), (101, ""), (102, "no data " * 4000)]
    got = {r.doc_id: r for r in pii.find_pii(spark.createDataFrame(data, "doc_id long, text string")).collect()}
    for i, t in data:
        base = [f"{pii.KINDS[k]}:{a}:{z}" for a, k, z in pii.base_spans(t or "")]
        assert got[i].base_sha256 == hashlib.sha256(",".join(base).encode()).hexdigest() and set(base) <= set(filter(None, got[i].spans.split(",")))
    assert got[3].n_email == 1 and got[3].n_card == 1 and got[100].spans == got[102].spans == ""


def test_pii_trains_on_every_class_of_windows(spark):
    rng = random.Random(5)
    digits = lambda n: "".join(rng.choice("0123456789") for _ in range(n))
    phone = lambda: f"({rng.randint(200, 999)}) {digits(3)}-{digits(4)}"
    fill = lambda: " ".join(rng.choice(["call", "the", "office", "about", "it", "today", "or", "then"]) for _ in range(rng.randint(8, 14)))
    data = [(i, f"{fill()} +1 {phone()} {fill()}") for i in range(1600)]
    data += [(5000 + i, f"{fill()} {digits(12)} {fill()}") for i in range(600)]  # clean numbers
    bare = [(9000 + i, f"{fill()} 1 {phone()} {fill()}") for i in range(100)]  # only the tagger finds these
    df, bare = (spark.createDataFrame(x, "doc_id long, text string") for x in (data, bare))
    tagger = pii.fit(df)
    count = lambda d: sum(len(r.spans) > 0 for r in pii.find(d, tagger).collect())
    assert count(df.filter("doc_id >= 5000")) <= 6 and count(bare) >= 80
    assert Counter(r["class"] for r in pii.drawn(df)) == {3: pii.SHARES[3], len(pii.KINDS): pii.SHARES[-1]}
    assert [r.rank for r in pii.drawn(df.union(df).repartition(3))] == [r.rank for r in pii.drawn(df)]


def test_decontamination_against_brute_force(spark):
    rng = random.Random(6)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 6)))
    items = [(i, " ".join(word() for _ in range(rng.randint(12, 50))) + ". " + " ".join(word() for _ in range(6)) + ".") for i in range(40)] + [(99, ""), (98, None)]
    texts, truth = [], set()
    for d in range(150):
        t = " ".join(word() for _ in range(rng.randint(0, 300)))
        if d % 3 == 0:
            i = rng.randrange(40)
            t += " " + items[i][1].upper() + " " + " ".join(word() for _ in range(rng.randint(0, 200)))
            truth.add((d, i))
        if d % 10 == 1:  # half an item is none
            t += " " + items[0][1][: len(items[0][1]) // 2]
        texts.append((d, t))
    df = spark.createDataFrame([*texts, (500, None), (501, "")], "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    assert {(r.doc_id, r.item_id) for r in decontaminate.search(df, bench).collect()} == truth
    assert {r.doc_id for r in decontaminate.without_items(df, bench).collect()} == {*range(150), 500, 501} - {d for d, _ in truth}


@pytest.mark.parametrize("shard", [1 << 22, 1 << 17])
def test_decontamination_with_long_items(spark, monkeypatch, shard):
    monkeypatch.setattr(decontaminate, "SHARD_BYTES", shard)
    rng = random.Random(9)
    text = lambda n: " ".join("".join(rng.choice("abcdefghijkl") for _ in range(rng.randint(3, 7))) for _ in range(n))
    long = text(15_000).split()
    items = [(1, " ".join(long)), (2, text(40) + ". " + text(6)), (4, text(3000))]
    assert len(items[0][1]) > 1 << 16
    docs = [
        (0, text(900) + " " + " ".join(long) + " " + text(500)), (1, " ".join(long[:7000])), (2, text(100) + " " + items[1][1] + " " + text(100)),
        (4, text(300)), (5, " ".join(long[2000:])), (6, text(20) + " " + items[2][1]),
    ]
    df, bench = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    assert rows(decontaminate.search(df, bench).select("doc_id", "item_id")) == [(0, 1), (2, 2), (5, 1), (6, 4)]
    assert rows(decontaminate.without_items(df, bench).select("doc_id")) == [(1,), (4,)]


def test_decontamination_finds_items_of_a_few_words(spark):
    items = [(1, "quartz xylophone zeppelin"), (2, "Marzipan."), (3, "one two three four five six seven eight nine ten")]
    docs = [(0, "so it was Quartz xylophone, zeppelin! and then more of it"), (1, "zeppelin of quartz or xylophone and so on"), (2, "a lot of marzipan for all of us"), (3, "nothing at all of the kind")]
    df, bench = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    assert rows(decontaminate.search(df, bench).select("doc_id", "item_id")) == [(0, 1), (2, 2)]


def test_wand_finds_what_full_scoring_finds():
    rng = random.Random(8)
    vocab = [f"w{i}" for i in range(60)]
    ix = decontaminate.Index([(i, " ".join(rng.choice(vocab) for _ in range(rng.randint(3, 15)))) for i in range(100)], 5)
    for _ in range(100):
        q = np.array(sorted(rng.sample(range(len(ix.vocab)), rng.randint(1, 20))))
        full = Counter()
        for t in q.tolist():
            for k, s in zip(*ix.posts[t], strict=True):
                full[k] += s
        bounds = ix.bounds(q, np.zeros(len(q), np.int64), 1)[0]
        assert {k for k, _ in ix.wand(q, bounds >= 0.4 * 0.999, 0.4)} == {k for k, s in full.items() if s >= 0.4}


@pytest.mark.parametrize("limit", [1024, 3])
def test_suffix_dedup_against_brute_force(spark, docs, corpus, monkeypatch, limit):
    monkeypatch.setattr(suffix_dedup, "LIMIT", limit)
    rng = random.Random(limit)
    shared = ["".join(rng.choice("abé ") for _ in range(rng.randint(180, 500))) for _ in range(4)]
    data = [(r[0], r[1]) for r in corpus] + [(1000 + i, "".join(rng.choice(shared)[rng.randint(0, 60) :] + rng.choice(["", "x" * 230, str(i)]) for _ in range(3))) for i in range(40)] + [(2000, "ab" * 500), (2001, shared[0][:200])]
    count = Counter((t or "").encode()[j : j + 200] for _, t in data for j in range(len((t or "").encode()) - 199))
    want = []
    for i, t in data:
        b = (t or "").encode()
        gone = np.zeros(len(b), bool)
        for j in range(len(b) - 199):
            if count[b[j : j + 200]] > 1:
                gone[j : j + 200] = True
        want.append((i, len(b), int(gone.sum()), int(np.sum(gone & ~np.r_[False, gone[:-1]])) if len(b) else 0, hashlib.sha256(bytes(np.frombuffer(b, np.uint8)[~gone])).hexdigest()))
    assert rows(suffix_dedup.dedup_substrings(spark.createDataFrame(data, "doc_id long, text string"))) == sorted(want, key=str)


def test_toxicity_held_out(spark):
    rng = random.Random(1)
    plain = [f"{a}{b}" for a in ("an", "ter", "lo", "mi") for b in ("der", "in", "ost", "ure", "al")]
    bad = ["idiotic", "scumbag", "vermino", "vermina"]
    data, labels = [], []
    for i in range(900):
        words = [rng.choice(plain) for _ in range(60)]
        y = int(i % 5 == 0)
        if y:
            for _ in range(3):
                words[rng.randrange(60)] = rng.choice(bad)
        data.append((i, " ".join(words)))
        labels.append((i, y))
    out = toxicity.toxicity(spark.createDataFrame([*data, (5000, None)], "doc_id long, text string"), spark.createDataFrame([*labels, (None, 1), (7, None)], "doc_id long, toxic int")).collect()
    want = dict(labels)
    held = [r for r in out if r.held_out and r.doc_id in want]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in out)
    assert len(held) > 200 and sum(r.predicted == want[r.doc_id] for r in held) / len(held) > 0.98
    assert all(0 <= r.score <= 1 for r in out) and [r.predicted for r in out if r.doc_id == 5000] == [0]


def test_huffman_round_trip():
    rng = np.random.default_rng(0)
    for n, limit in ((5, 4), (1000, 12), (30_000, 18), (1, 5), (2, 3)):
        c = (rng.zipf(1.4, n) % 10**6).astype(np.int64) + 1
        lengths = token_store.code_lengths(c, limit)
        assert lengths.max() <= limit and (0.5 ** lengths.astype(float)).sum() <= 1 + 1e-9
        codes, _ = token_store.canonical(lengths)
        ids = rng.choice(n, 5000, p=c / c.sum()).astype(np.uint32)
        raw, at = token_store.pack_bits(ids, codes, lengths)
        assert (token_store.Decoder(lengths).block(raw, len(ids), at[::64], 64) == ids).all()


def test_token_store_against_the_library(docs, corpus):
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    t = Tokenizer.from_file(path)
    odd = [(300, "It's <|endoftext|> A<|ENDOFTEXT|>\x1c x\xa0y ́ é ÀÉ 1234 don't!!'s ß İ 中文")]
    got = token_store.token_store(docs.select("doc_id", "text").union(docs.sparkSession.createDataFrame(odd, "doc_id long, text string")), path).collect()
    want = Counter()
    for i, text in [(r[0], r[1]) for r in corpus] + odd:
        ids = t.encode(text or "", add_special_tokens=False).ids + [1]
        want[i, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())] += 1
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == want
    start = 0
    for r in sorted(got, key=lambda r: r.start):
        assert r.start == start
        start += r.n_tokens
    ids = [r.doc_id for r in sorted(got, key=lambda r: r.start)]
    assert ids[0] is None and ids[1:] == sorted(ids[1:])


def brute_components(corpus, width=5, percent=75):
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    sets = []
    for r in corpus:
        w = WORD.findall((r[1] or "").translate(low))
        sets.append({tuple(w[j : j + width]) for j in range(len(w) - width + 1)} if len(w) >= width else {tuple(w)} if w else set())
    part = list(range(len(corpus)))
    for i in range(len(corpus)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                a, b = part[i], part[j]
                part = [b if p == a else p for p in part]
    ids = {}
    for r, p in zip(corpus, part, strict=True):
        ids[p] = min(ids.get(p, math.inf), math.inf if r[0] is None else r[0])
    return sorted(((r[0], len(s), r[0] if ids[p] == math.inf or not s else ids[p]) for r, s, p in zip(corpus, sets, part, strict=True)), key=str)


@pytest.mark.parametrize("leaders", [10, 2])
def test_jaccard_components_against_brute_force(docs, corpus, monkeypatch, leaders):
    monkeypatch.setattr(ngram_join, "LEADERS", leaders)
    assert rows(ngram_join.jaccard_components(docs)) == brute_components(corpus)


def test_zip_reader_and_warc(spark):
    out = io.BytesIO()
    z = zip_warc.ZipWriter(out)
    z.begin("a")
    z.add(b"xyz")
    z.end()
    z.close()
    raw = out.getvalue()
    import zipfile

    assert zipfile.ZipFile(io.BytesIO(raw)).read("a") == b"xyz"
    plain = io.BytesIO()
    with zipfile.ZipFile(plain, "w", zipfile.ZIP_STORED) as f:
        f.writestr("b", b"12345")
        f.comment = b"PK\x05\x06 in a comment, long enough to look like an end record"
    for data, name, size in ((raw, "a", 3), (plain.getvalue(), "b", 5)):
        r = zip_warc.ZipReader(lambda at, n, d=data: d[at : at + n], len(data))
        m = r.member(name)
        assert m.size == size and data[m.data_at : m.data_at + size] in (b"xyz", b"12345")
    with pytest.raises(ValueError):
        zip_warc.ZipReader(lambda at, n: b"no zip"[at : at + n], 6)
    pages = [(1, "u", "same"), (2, "u\r\nX: y", "same"), (3, None, None), (4, "u", ""), (None, "u", "same"), (2, "u", "same"), (9, "u", "é" * 50_000)]
    got = sorted(((r.page_id, r.payload_bytes, r.record_type, r.refers_to) for r in zip_warc.zip_warc(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()), key=str)
    assert got == sorted([(1, 4, "revisit", 2), (2, 4, "response", None), (2, 4, "response", None), (3, 0, "revisit", 4), (4, 0, "response", None), (None, 4, "revisit", 2), (9, 100_000, "response", None)], key=str)


def test_key_maps(spark):
    df = spark.range(0, 1_000_000, 997).select((F.col("id") * 7_919_191 - 5_000_000).alias("k"))
    bits = common.key_map(df, "k")
    keys = np.array([r.k for r in df.collect()])
    assert common.in_map(bits, keys).all() and common.in_map(bits, keys + 1).mean() < 0.01


def thue_morse(n):
    """Two texts of ``n`` letters that sums of powers modulo 2**64 take for one."""
    bits = [bin(i).count("1") % 2 for i in range(n)]
    return "".join("ab"[b] for b in bits), "".join("ba"[b] for b in bits)


def test_texts_that_sums_of_powers_confuse(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    a, b = thue_morse(4096)
    raw = np.frombuffer((a + b).encode(), np.uint8)
    assert len(set(common.codes(raw, np.array([0, 4096]), np.array([4096, 8192])).tolist())) == 2
    for n in (40, 200, 1024):  # below and above the length from which a library hashes
        x, y = thue_morse(n)
        raw = np.frombuffer((x + y).encode(), np.uint8)
        assert len(set(common.codes(raw, np.array([0, n]), np.array([n, 2 * n])).tolist())) == 2
    data = [(1, f"{a}\n{b}\n{a}"), (2, a), (3, b), (4, f"{a} {b} x y z"), (5, f"{b} {a} x y z")]
    df = spark.createDataFrame([(i, t, "en") for i, t in data], "doc_id long, text string, lang string")
    assert {r.doc_id: r.n_dup_lines for r in divergence.judge(df).collect()}[1] == 1
    assert {(r.doc_id, r.component_id) for r in ngram_join.jaccard_components(df).collect()} == {(i, i) for i, _ in data}
    t = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = {(i, zlib.crc32(np.array(t.encode(x, add_special_tokens=False).ids + [1], "<u4").tobytes())) for i, x in data}
    assert {(r.doc_id, r.ids_crc32) for r in token_store.token_store(df, public_tokenizers.path("word_bpe_49k.json")).collect()} == want
    x, y = thue_morse(1024)
    got = {r.doc_id: r.n_removed for r in suffix_dedup.dedup_substrings(spark.createDataFrame([(1, x), (2, "q" + y[:199])], "doc_id long, text string")).collect()}
    count = Counter(d[j : j + 200] for d in (x, "q" + y[:199]) for j in range(len(d) - 199))
    assert got[2] == 0 and (got[1] > 0) == (max(count.values()) > 1)


def test_jaccard_join_of_unlike_texts_with_one_passage(spark):
    """Two thousand texts share a passage of half their words; only a few are alike beyond it."""
    rng = random.Random(12)
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(6))
    text = lambda n: " ".join(word() for _ in range(n))
    passage, own = text(60), text(80)
    data = [(i, f"{text(rng.randint(40, 80))} {passage} {text(rng.randint(1, 9))}") for i in range(2000)]
    data += [(3000 + i, f"{own} {passage} {text(4)}") for i in range(6)]
    data += [(4000 + i, f"{passage} {text(rng.randint(6, 16))}") for i in range(300)]  # some of these are alike by the passage alone
    df = spark.createDataFrame(data, "doc_id long, text string").repartition(4)
    sets = [{tuple(w[j : j + 5]) for j in range(len(w) - 4)} for w in (t.split() for _, t in data)]
    part = list(range(len(data)))

    def root(i):
        while part[i] != i:
            i = part[i]
        return i

    for i in range(2000, len(data)):
        for j in range(2000, i):
            if 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
                part[max(root(i), root(j))] = min(root(i), root(j))
    want = sorted((d, len(s), data[root(i)][0]) for i, ((d, _), s) in enumerate(zip(data, sets, strict=True)))
    assert sorted(map(tuple, ngram_join.jaccard_components(df).collect())) == want


def test_jaccard_names_that_clash_are_given_anew(docs, corpus, monkeypatch):
    real = ngram_join.names_of
    monkeypatch.setattr(ngram_join.Join, "classes", lambda self, named, real=ngram_join.Join.classes: real(self, named).withColumn("clash", F.lit(self.__dict__.setdefault("tries", 0) == 0)) if not self.__dict__.update(tries=self.__dict__.get("tries", -1) + 1) else None)
    assert rows(ngram_join.jaccard_components(docs)) == brute_components(corpus) and real is ngram_join.names_of


def test_mixing_of_tied_rows(spark):
    words = "a b c " * 100
    data = [(None, words, "x", "en")] * 1000 + [(i, "w " * (i % 50), "y", "en") for i in range(300)] + [(7, "q r", "z", f"l{i % 3}") for i in range(90)]
    df = spark.createDataFrame(data, "doc_id long, text string, source string, lang string").repartition(3)
    got = mixing.mix_sources(df, keep=("lang",)).collect()
    assert Counter((r.doc_id, r.lang) for r in got) == Counter((r[0], r[3]) for r in data)
    x = [r for r in got if r.doc_id is None]
    assert abs(sum(r.taken for r in x) - x[0].target) <= 300 and {r.copies for r in x} == {0, 1}
    assert rows(mixing.mix_sources(df.repartition(5), keep=("lang",))) == sorted(map(tuple, got), key=str)


def test_equal_rows_have_their_runs_once(spark):
    rng = random.Random(13)
    text = "".join(rng.choice("abcdef ") for _ in range(3000))
    df = spark.createDataFrame([(1, text)] * 200 + [(2, text[500:900])], "doc_id long, text string")
    assert Counter((r.doc_id, r.n_removed, r.n_spans) for r in suffix_dedup.dedup_substrings(df).collect()) == {(1, 3000, 1): 200, (2, 400, 1): 1}


def test_packages_are_read_by_as_many_tasks(spark):
    pages = spark.createDataFrame([(i, f"http://h{i}/", f"text {i}") for i in range(400)], "page_id long, url string, html string").repartition(6)
    path = common.scratch_path(spark, "warc")
    got = zip_warc.read_archives(spark, path, zip_warc.write_archives(pages, path))
    n = zip_warc.write_archives(pages, common.scratch_path(spark, "warc")).count()
    assert n > 1 and got.select(F.spark_partition_id().alias("p")).distinct().count() == n
    assert got.filter("intact").count() == 400


def test_divergence_against_a_plain_version(spark):
    """Distances, limits and verdicts by plain counting, on texts of two languages, one null, and junk."""
    rng = random.Random(21)
    made = lambda k: "".join(rng.choice("abcdeilnorst") for _ in range(rng.randint(2, 8))) + k
    vocab = {lang: [made(k) for _ in range(300)] for lang, k in (("en", ""), ("de", "ß"), (None, "’"))}
    data = []
    for i in range(240):
        lang = ("en", "de", None)[i % 3]
        data.append((i, " ".join(rng.choices(vocab[lang], [1 / (k + 1) for k in range(300)], k=rng.randint(30, 250))) + rng.choice([".", "\n", ""]), lang))
    data += [(900 + i, " ".join(made("") for _ in range(150)), "en") for i in range(3)] + [(910, "%% ## " * 80 + " ".join(vocab["en"][:60]), "en"), (911, "", "en"), (912, None, "de"), (913, "Слово и дело " * 9 + " ".join(vocab["de"]), "de")]
    got = {r.doc_id: r for r in divergence.judge(spark.createDataFrame(data, "doc_id long, text string, lang string").repartition(3)).collect()}

    table = divergence.CLASS
    classes = lambda t: Counter(int(c) for c in table[np.frombuffer(t.encode(), np.uint8)] if c >= 0)
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")

    def js(p, q):
        a, b = sum(p.values()), sum(q.values())
        if not a:
            return 0.0
        d = 0.0
        for k in {*p, *q}:
            x, y = p.get(k, 0) / a, q.get(k, 0) / b
            d += (x * math.log2(2 * x / (x + y)) if x else 0) + (y * math.log2(2 * y / (x + y)) if y else 0)
        return math.sqrt(min(max(d / 2, 0), 1))

    refs = []
    for lang in ("de", "en", None):
        w, c = Counter(), Counter()
        for _, t, g in data:
            if g == lang and t:
                w.update(WORD.findall(t.translate(low)))
                c.update(classes(t))
        if sum(w.values()) >= divergence.MIN_REFERENCE:
            hashed = lambda x: int(common.codes(np.frombuffer(x.encode(), np.uint8), np.array([0]), np.array([len(x.encode())])).view(np.int64)[0])
            top = dict(sorted(((x, n) for x, n in w.items() if n * divergence.RARE >= sum(w.values())), key=lambda x: (-x[1], hashed(x[0])))[: divergence.COMMON])
            refs.append((c, top | {"": sum(w.values()) - sum(top.values())}, set(top)))
    far = {}
    for i, t, _ in data:
        w = WORD.findall((t or "").translate(low))
        each = [(js(classes(t or ""), c), js(Counter(x if x in top else "" for x in w), q)) for c, q, top in refs]
        near = min(range(len(each)), key=lambda k: sum(each[k]))
        far[i] = (*each[near], near, len(w))
        assert abs(got[i].class_distance - each[near][0]) < 1e-9 and abs(got[i].word_distance - each[near][1]) < 1e-9
    groups = {}
    for i, t, _ in data:
        if not got[i].base_failed and far[i][3] >= divergence.MIN_WORDS:
            for ref in (far[i][2], -1):
                groups.setdefault((ref, int(math.log2(far[i][3]))), []).append(int(far[i][1] * divergence.BINS))
    at = {}
    for k, v in groups.items():
        if len(v) >= divergence.MIN_BAND:
            q1, q2, q3 = ((x + 0.5) / divergence.BINS for x in np.percentile(v, [25, 50, 75]))
            at[k] = q3 + divergence.FENCE * max(q3 - q1, divergence.LEAST_SPREAD * q2)
    for i, t, _ in data:
        c, w, ref, n = far[i]
        limit = None
        for band in range((n or 1).bit_length()):
            limit = at.get((ref, band), at.get((-1, band), limit))
        chars = sum(classes(t or "").values())
        want = not got[i].base_failed and not (c > divergence.MAX_CLASS and chars >= divergence.MIN_CHARS) and not (n >= divergence.MIN_WORDS and w > min(divergence.MAX_WORDS, limit if limit is not None else 9))
        assert got[i].kept == want, i
    assert not any(got[i].kept for i in (900, 901, 902, 910, 911, 912))


def plain_label_model(votes, up, down, prior, rounds, clean):
    """The same EM in plain loops."""
    n, m = len(votes), len(votes[0])
    parent = [-1] * m
    rate = [[[up[j]] * 2 for j in range(m)], [[down[j]] * 2 for j in range(m)]]
    clip = lambda x: min(max(x, 1e-5), 1 - 1e-4)
    for k in range(rounds):
        post = []
        for v in votes:
            z = math.log(prior / (1 - prior))
            for j in range(m):
                g = v[parent[j]] if parent[j] >= 0 else 0
                a, b = rate[0][j][g], rate[1][j][g]
                if (a < b) == (j < m - clean) and a != b:
                    continue
                z += math.log(a / b) if v[j] else math.log((1 - a) / (1 - b))
            post.append(1 / (1 + math.exp(-min(max(z, -40), 40))))
        prior = min(max((sum(post) + 1) / (n + 2), 1e-3), 0.999)
        if k in (1, 5, 10):
            parent = toxicity.parents(np.array(votes, float), np.array(post)).tolist()
        for y in (0, 1):
            p = [x if y == 0 else 1 - x for x in post]
            for j in range(m):
                plain = clip((sum(q for q, v in zip(p, votes, strict=True) if v[j]) + 0.5) / (sum(p) + 1))
                rate[y][j] = [plain, plain]
                if parent[j] >= 0:
                    for g in (0, 1):
                        of = [(q, v[j]) for q, v in zip(p, votes, strict=True) if v[parent[j]] == g]
                        rate[y][j][g] = clip((sum(q for q, x in of if x) + plain) / (sum(q for q, _ in of) + 1))
    return post, parent


def test_label_model_against_plain_loops():
    rng = np.random.default_rng(5)
    y = rng.random(240) < 0.25
    votes = (rng.random((240, 7)) < np.where(y[:, None], [0.6, 0.5, 0.4, 0.3, 0.5, 0.2, 0.3], [0.05, 0.02, 0.05, 0.02, 0.05, 0.6, 0.7])).astype(np.float32)
    votes[:, 1] = np.where(rng.random(240) < 0.9, votes[:, 0], votes[:, 1])  # nearly a copy of the first
    up, down = np.full(7, 0.4), np.full(7, 0.1)
    up[5:], down[5:] = 0.1, 0.4
    post, parent = toxicity.label_model(votes, up, down, 0.3, clean=2)
    want, want_parent = plain_label_model(votes.astype(int).tolist(), up, down, 0.3, 25, 2)
    assert parent.tolist() == want_parent and np.allclose(post, want, atol=1e-6)
    assert (parent[1] == 0) or (parent[0] == 1)
    assert ((post > 0.5) == y).mean() > 0.9


def test_strongest_dependences_make_the_tree():
    rng = np.random.default_rng(6)
    v = (rng.random((500, 6)) < 0.3).astype(float)
    v[:, 2] = np.where(rng.random(500) < 0.8, v[:, 0], v[:, 2])
    v[:, 4] = np.where(rng.random(500) < 0.7, v[:, 2], v[:, 4])
    post = rng.random(500)

    def weight(i, j):
        out = 0.0
        for p in (post, 1 - post):
            n = p.sum()
            for a in (0, 1):
                for b in (0, 1):
                    joint, x, y = p[(v[:, i] == a) & (v[:, j] == b)].sum(), p[v[:, i] == a].sum(), p[v[:, j] == b].sum()
                    out += 2 * joint * math.log(joint * n / (x * y)) if joint else 0.0
        return out

    edges, part = set(), list(range(6))
    for w, i, j in sorted(((weight(i, j), i, j) for i in range(6) for j in range(i)), reverse=True):  # one edge after the other
        if w >= 10 and part[i] != part[j]:
            edges.add((i, j))
            part = [part[j] if x == part[i] else x for x in part]
    got = {(max(i, int(k)), min(i, int(k))) for i, k in enumerate(toxicity.parents(v, post)) if k >= 0}
    assert got == edges and {(2, 0), (4, 2)} <= got


def test_classifier_is_at_its_least_loss():
    rng = np.random.default_rng(7)
    x = (rng.random((200, 4)) < 0.4).astype(np.float32)
    target = 1 / (1 + np.exp(-(x @ np.array([2, -1, 0.5, 0]) - 0.5 + rng.normal(0, 0.3, 200))))
    w = toxicity.logistic(x, target)

    def loss(w):
        p = 1 / (1 + np.exp(-(np.c_[x, np.ones(200)] @ w)))
        one = target > 0.5
        share = np.where(one, 0.5 / one.sum(), 0.5 / (~one).sum())
        return float(-(share * (target * np.log(p) + (1 - target) * np.log(1 - p))).sum() + (np.r_[np.full(4, 1e-5), 1e-6] * w**2 / 2).sum())

    best = loss(w)
    for k in range(5):
        for step in (-0.01, 0.01):
            v = w.copy()
            v[k] += step
            assert loss(v) > best


def test_scores_do_not_hang_on_shards(spark, monkeypatch):
    rng = random.Random(31)
    vocab = ["".join(rng.choice("abcdefgh") for _ in range(4)) for _ in range(120)]
    items = [(i, " ".join(rng.choices(vocab, [1 / (k + 1) for k in range(120)], k=rng.randint(10, 40)))) for i in range(60)] + [(60, None), (3, items_text := "only one of its kind and no other")]
    docs = [(i, " ".join(rng.choices(vocab, k=80)) + " " + (items[i][1] or "") + " " + items_text * (i % 2)) for i in range(40)] * 2
    df, bench = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    one = rows(decontaminate.search(df, bench))
    monkeypatch.setattr(decontaminate, "SHARD", 7)
    many = rows(decontaminate.search(df, bench))
    assert len(one) >= 80 and [r[:2] for r in one] == [r[:2] for r in many]
    assert all(abs(a[2] - b[2]) < 1e-9 for a, b in zip(one, many, strict=True))
