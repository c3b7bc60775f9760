"""More languages than references: the largest ones are kept, and nothing depends on how texts are dealt out."""

import random

from pyspark.sql import functions as F

from cdcspark.llm import divergence


def test_many_small_languages_change_nothing(spark):
    rng = random.Random(2)
    word = lambda letters: "".join(rng.choice(letters) for _ in range(rng.randint(2, 8)))
    pool = {k: [word(x) for _ in range(150)] for k, x in {"en": "abcdefgh", "fr": "mnopqrs"}.items()}
    data = [(i, " ".join(rng.choice(pool[k]) for _ in range(120)), k) for i in range(60) for k in ("en", "fr")]
    data += [(1000 + i, " ".join(word("xyz") for _ in range(30)), f"l{i}") for i in range(1300)]
    df = spark.createDataFrame(data, "doc_id long, text string, lang string")
    big = divergence.reference_counts(df.repartition(2).select("text", "lang"))
    assert set(big.lang) == {"en", "fr"} and big.n.sum() > 0
    few = divergence.judge(df.repartition(1)).orderBy("doc_id", "class_distance", "word_distance").collect()
    many = divergence.judge(df.repartition(9)).orderBy("doc_id", "class_distance", "word_distance").collect()
    assert few == many and len(few) == len(data)
    only = divergence.judge(df.filter(F.col("lang").isin("en", "fr"))).filter("not base_failed").select("doc_id", F.round("class_distance", 9), F.round("word_distance", 9))
    part = spark.createDataFrame(many).filter("not base_failed and doc_id < 1000").select("doc_id", F.round("class_distance", 9), F.round("word_distance", 9))
    assert sorted(only.collect()) == sorted(part.collect())
