"""The corpus pipeline: five stages, each reading what its predecessor wrote.

``run`` applies them to ``documents``. Every stage takes (spark, docs, sf_dir); all but the last
return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cdcspark.llm import decontaminate, mixing, ngram_join, queries, token_store, toxicity
from cdcspark.llm.common import discard, scope, table, written


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Toxicity: documents that the classifier rejects go.

    Null and empty texts have no evidence and stay; repeated rows are judged alike; without usable labels
    nothing goes; an empty table stays one; other columns of any name are carried along.
    """
    return toxicity.without_toxic(docs, table(spark, sf_dir, "labels"))


def deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """N-gram Jaccard join: of each component the document with the smallest id stays.

    A null id counts as the largest. Rows are told apart by id and text, so different texts with one id
    are documents of their own; of equal rows of one id and text one stays. Texts without words link
    with nothing, so all their rows stay; an empty table stays one; columns of any name are carried along.
    """
    key = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), F.xxhash64("text").alias("text"))
    found = ngram_join.jaccard_components(docs.select(key.alias("key"), F.col("text").alias("text")), doc_id="key").filter("doc_id = component_id")
    kept = written(found.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"), F.max("n_shingles").alias("n_shingles")).select("doc_id", F.expr("n > 1 and n_shingles > 0").alias("many")), "kept")
    rows = docs.select(key.alias("doc_id"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")).join(kept, "doc_id")
    out = rows.filter("not many")
    if not kept.filter("many").isEmpty():
        out = out.unionByName(rows.filter("many").dropDuplicates(["doc_id"]))
    return out.select("row.*")


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark decontamination: documents that hold a test item go.

    Null and empty texts hold none and stay; repeated rows go or stay together; without items nothing
    goes; an empty table stays one; other columns of any name are carried along.
    """
    return decontaminate.without_items(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mixing: each document as often as the mix takes it, up to three times; ids repeat.

    Null and empty texts have no size and are not taken, no more than sources without words; equal rows
    are taken so many of them as fit; an empty table stays one; columns of any name are carried along.
    """
    packed = docs.select("doc_id", "text", "source", F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    taken = mixing.mix_sources(packed, keep=("row",)).filter("copies > 0")
    return taken.select("row", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy")).select("row.*")


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids: written in the Huffman format and read back, a row per document of the mix.

    Null and empty texts are the end id alone; repeated rows each have their ids; other columns are left
    out; an empty table writes no file and has no rows.
    """
    return token_store.token_store(docs, queries.word_vocabulary())


STAGES = [
    ("toxicity", clean),
    ("ngram_jaccard", deduplicate),
    ("decontamination", decontaminated),
    ("mixing", mix),
    ("token_ids", tokens),
]

#: The stages are trained models and hashes, which SQL has not: tests hold each one against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage wrote is deleted when the next one has been written."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        before = docs
        with scope(spark) as keep:
            docs = written(stage(spark, before, sf_dir), name)
            keep.append(docs)
        if hasattr(before, "scratch"):
            discard(spark, [before.scratch])
    return STAGES[-1][1](spark, docs, sf_dir)
