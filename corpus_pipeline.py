"""From documents to packed training sequences, stage by stage.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; its output is written and read
again as the next one's input. All but the last return the columns of `documents`, and every
stage works on all rows that its predecessor kept. Nulls, empty and repeated rows are treated as the
operators' docstrings say; a null or blank text has no words and goes in the first stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from bazaar.llm import jaccard_join, line_dedup, mixing, packing, quality
from bazaar.llm.common import materialize, table
from bazaar.llm.registry import vocabulary


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that the quality classifier rejects."""
    return quality.kept(docs, threshold=0.5)


def cut_common_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut lines of 40 code points and more that five documents share, but for their last document."""
    return line_dedup.deduped(docs, min_len=40, min_docs=5)


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that link at five words and 0.8, directly or through others, keep the smallest id."""
    return jaccard_join.representatives(docs, n=5, percent=80)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Take each source to its target; documents may come twice."""
    return mixing.mixed(docs, weights=(5, 2, 1), share=1.5, cap=2.0)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pack the tokens of all documents into sequences of 2048; one row per piece."""
    return packing.packed_documents(docs, vocabulary("word_bpe_49k.json"), length=2048)


STAGES = [
    ("quality", keep_good),
    ("line_dedup", cut_common_lines),
    ("near_duplicates", keep_one_of_each),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

#: No SQL expresses the classifier and the packing; the tests hold every stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
