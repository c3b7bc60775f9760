"""The registered queries of this subpackage and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import alignment, decontaminate, divergence, hard_negatives, mixing, ngram_join, packing, pii, suffix_dedup, token_store, toxicity, url_filter, zip_warc
from .common import table


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def word_vocabulary() -> str:
    return vocabulary("word_bpe_49k.json")


def op1_js_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.judge(table(spark, sf_dir, "documents"))


def op2_pareto_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(table(spark, sf_dir, "documents"))


def op3_link_trust(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.filter_urls(table(spark, sf_dir, "pages"))


def op4_lstm_crf_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find_pii(table(spark, sf_dir, "documents"))


def op5_bm25_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.dedup_substrings(table(spark, sf_dir, "documents"))


def op7_weak_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_huffman_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_store.token_store(table(spark, sf_dir, "documents"), word_vocabulary())


def op9_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.jaccard_components(table(spark, sf_dir, "documents"))


def op10_zip_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return zip_warc.zip_warc(table(spark, sf_dir, "pages"))


def op11_lemp_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.pmod("vec_id", F.lit(7)) == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(table(spark, sf_dir, "embeddings"), label=label)


def op12_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"))


def op13_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align_tokenizers(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"), vocabulary("piece_bpe_32k.model"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_js_divergence, op2_pareto_mix, op3_link_trust, op4_lstm_crf_pii, op5_bm25_decontaminate, op6_suffix_dedup, op7_weak_toxicity, op8_huffman_tokens, op9_ngram_jaccard, op10_zip_warc, op11_lemp_negatives, op12_best_fit_packing, op13_tokenizer_alignment)}


def oracle_sql() -> dict[str, str]:
    return {"op2_pareto_mix": mixing.SQL, "op3_link_trust": url_filter.sql(), "op10_zip_warc": zip_warc.SQL, "op11_lemp_negatives": hard_negatives.SQL}
