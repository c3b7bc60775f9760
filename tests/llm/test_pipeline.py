"""The pipeline's stages, each against a plain version on rows with repeated and null ids and clashing columns."""

import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from cdcspark.llm import common, mixing, queries
from test_small import WORD, brute_components

SF = "/root/testdata/sf0.001"
STAGE = dict(corpus_pipeline.STAGES)
#: Columns whose names the operators use themselves.
CLASH = ["size", "copies", "target", "source_size", "taken", "_root", "_q", "key", "row", "cls", "n", "k", "copy", "label", "many"]


def key(r):
    return tuple(map(str, r))


def names_clash(df):
    for i, c in enumerate(CLASH):
        df = df.withColumn(c, F.lit(i))
    return df


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7)))
    text = lambda n: " ".join(word() for _ in range(n))
    out = [(i, text(rng.randint(1, 120)), "en", rng.choice(["s1", "s2", None]), 1) for i in range(60)]
    base = text(100).split()
    for i in range(60, 80):
        copy = list(base)
        copy[rng.randrange(100)] = word()
        out.append((i, " ".join(copy), "en", "s1", 1))
    out += [out[3], out[3], (3, text(70), "de", "s1", 2), (None, text(80), "en", "s1", 3), (None, out[4][1], "en", "s1", 3), (None, None, None, None, None), (None, None, None, None, None), (90, "", "en", "s2", 0), (91, None, "en", "s2", 0)]
    return out


@pytest.fixture(scope="module")
def docs(spark, rows):
    return names_clash(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3))


def test_deduplication_keeps_one_of_each_component(spark, docs, rows):
    # components over the different (id, text) rows, the smallest of each (nulls last) stays once
    ids = {r: i for i, r in enumerate(sorted({(r[0] is None, r[0] or 0, r[1] or "") for r in rows}))}
    number = [ids[r[0] is None, r[0] or 0, r[1] or ""] for r in rows]
    found = brute_components([(n, r[1]) for n, r in zip(number, rows, strict=True)])
    part = {n: c for n, _, c in found}
    want = Counter()
    for n, r in zip(number, rows, strict=True):
        if part[n] == n:
            want[key(r)] = want[key(r)] + 1 if not WORD.search(r[1] or "") else 1
    got = STAGE["ngram_jaccard"](spark, docs, SF)
    assert got.columns == docs.columns
    assert Counter(key(r[:5]) for r in got.collect()) == want


def test_mixing_repeats_what_the_mix_takes(spark, docs, rows):
    out = STAGE["mixing"](spark, docs, SF)
    assert out.columns == docs.columns
    got = Counter(key(r[:5]) for r in out.collect())
    have = Counter(map(key, rows))
    assert set(got) <= set(have) and all(got[k] <= 3 * have[k] for k in got)
    size = {key(r): len(WORD.findall(r[1] or "")) for r in rows}
    names = sorted({r[3] for r in rows}, key=lambda s: (s is None, s or ""))
    total = [sum(size[key(r)] for r in rows if r[3] == s) for s in names]
    goal = mixing.targets(total, [float((5, 2, 1)[i % 3]) for i in range(len(names))], 3)
    for s, t in zip(names, goal, strict=True):
        of = {key(r) for r in rows if r[3] == s}
        assert abs(sum(got[k] * size[k] for k in of) - t) <= max(size[k] for k in of)


def test_other_stages_on_the_tables(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    docs = names_clash(common.table(spark, SF, "documents").limit(150)).unionByName(names_clash(spark.createDataFrame([(None, None, None, None, None)] * 2, common.table(spark, SF, "documents").schema)))
    docs = common.written(docs, "docs")
    before = {key(r) for r in docs.collect()}
    for name in ("toxicity", "decontamination"):
        out = STAGE[name](spark, docs, SF)
        assert out.columns == docs.columns and {key(r) for r in out.collect()} <= before
        assert out.filter("doc_id is null").count() == 2
    items = [" ".join(WORD.findall(r.text.lower())) for r in common.table(spark, SF, "benchmark").collect()]
    left = STAGE["decontamination"](spark, docs, SF).collect()
    assert not any(i in " ".join(WORD.findall((r.text or "").lower())) for r in left for i in items)
    t = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = Counter()
    for r in docs.collect():
        ids = t.encode(r.text or "", add_special_tokens=False).ids + [1]
        want[r.doc_id, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())] += 1
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in STAGE["token_ids"](spark, docs, SF).collect()) == want
    none = docs.limit(0)
    assert all(f(spark, none, SF).count() == 0 for _, f in corpus_pipeline.STAGES)


def test_run_is_the_stages_in_a_row(spark):
    docs = common.table(spark, SF, "documents")
    for name, stage in corpus_pipeline.STAGES:
        docs = common.written(stage(spark, docs, SF), name)
    assert Counter(docs.collect()) == Counter(corpus_pipeline.run(spark, SF).collect())


def test_registered():
    assert [n.split("_")[0] for n in queries.queries()] == [f"op{i}" for i in range(1, 11)]
