"""op9 on large groups of sets that share much and link with few: pairs counted, and results."""

import random

import pytest

from cdcspark.llm import ngram_join

from test_small import brute_components


def paragraphs(n):
    """Texts of 10 of 20 common paragraphs each, in their order; few of them link."""
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(6))
    parts = [" ".join(word() for _ in range(12)) for _ in range(20)]
    return [(i, " ".join(parts[k] for k in sorted(rng.sample(range(20), 10)))) for i in range(n)]


def copies(n):
    """Copies of one text with changes at some of its places, which make most of them unlike each other."""
    rng = random.Random(6)
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(6))
    base = [word() for _ in range(90)]
    spare = [word() for _ in range(3)]
    out = []
    for i in range(n):
        w = list(base)
        for k in rng.sample(range(90), rng.randint(1, 4)):
            w[k] = rng.choice(spare)
        out.append((i, " ".join(w)))
    return out


def run(spark, data, monkeypatch):
    """(result, pairs whose overlap was counted)"""
    real, made = ngram_join.Join.links, []

    def links(self, pairs, fragments):
        made.append(pairs.count())
        return real(self, pairs, fragments)

    with monkeypatch.context() as m:
        m.setattr(ngram_join.Join, "links", links)
        df = spark.createDataFrame(data, "doc_id long, text string").repartition(4)
        return sorted(map(tuple, ngram_join.jaccard_components(df).collect())), sum(made)


@pytest.mark.parametrize("of", [paragraphs, copies])
@pytest.mark.parametrize("grid", [4096, 50])
def test_pairs_follow_the_sets(spark, monkeypatch, of, grid):
    monkeypatch.setattr(ngram_join, "GRID", grid, raising=False)
    data = of(300)
    got, made = run(spark, data, monkeypatch)
    assert sorted(got, key=str) == brute_components(data)
    assert made <= 10 * len(data)
