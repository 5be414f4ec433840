"""The corpus queries, one per operator, over whole tables with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bazaar.llm import (byte_bpe, exact_dedup, jaccard_join, language_id, lexical_search, line_dedup, mixing, packing,
                        quality, sharding, spelling, token_counts, topk_search)
from bazaar.llm.common import table


def vocabulary(name: str) -> str:
    """Where the installed package says that a public vocabulary file lies."""
    import public_tokenizers
    return public_tokenizers.path(name)


def op1_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk_search.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, k=10, scale=1024,
                             pivots=32)


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(table(spark, sf_dir, "documents"), sharding.topology(40), sharding.topology(41))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(table(spark, sf_dir, "documents"), held_out=language_id.crc_held_out("doc_id", 5),
                                per_class=400, train_rows=2400, landmarks=64)


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_dedup(table(spark, sf_dir, "documents"), min_len=40, min_docs=5)


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents"))


def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.components(table(spark, sf_dir, "documents"), n=4, percent=85)


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(table(spark, sf_dir, "documents"), threshold=0.5, sample_rows=3000)


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"), weights=(5, 2, 1), share=1.5, cap=2.0)


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed_documents(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"), length=2048)


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"), limit=512)


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.rank(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=10)


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"), min_len=6, min_count=5, one_in=199, factor=5)


def op13_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    return byte_bpe.round_trips(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.tiktoken"),
                                public_tokenizers.PATTERN)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_topk_search": op1_topk_search,
    "op2_sharding": op2_sharding,
    "op3_language_id": op3_language_id,
    "op4_line_dedup": op4_line_dedup,
    "op5_exact_dedup": op5_exact_dedup,
    "op6_jaccard_join": op6_jaccard_join,
    "op7_quality": op7_quality,
    "op8_mixing": op8_mixing,
    "op9_packing": op9_packing,
    "op10_token_counts": op10_token_counts,
    "op11_lexical_search": op11_lexical_search,
    "op12_spelling_variants": op12_spelling_variants,
    "op13_byte_bpe": op13_byte_bpe,
}

ORACLE: dict[str, str] = {
    "op1_topk_search": topk_search.SQL,
    "op2_sharding": sharding.sql(sharding.topology(40), sharding.topology(41)),
    "op4_line_dedup": line_dedup.SQL,
    "op5_exact_dedup": exact_dedup.SQL,
    "op6_jaccard_join": jaccard_join.SQL,
    "op8_mixing": mixing.SQL,
    "op11_lexical_search": lexical_search.SQL,
    "op12_spelling_variants": spelling.SQL,
}
