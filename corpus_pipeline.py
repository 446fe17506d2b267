"""The corpus pipeline: stages over ``documents``, each written as Parquet and reread by the next.

Every stage takes ``(spark, docs, sf_dir)`` and works on all rows that its predecessor kept; all but the
last return the columns of ``documents``. Nulls, repeated rows, empty tables and further columns are
handled as the operators' texts state.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from voxlake.llm import jaccard_rtree, langid_nb, packing_dp, pii_boost, quality_mcd
from voxlake.llm.common import written


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality_mcd.passing(docs)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised; ``lang`` becomes the recognised one."""
    model = langid_nb.train(docs.where(~langid_nb.held_out()))
    return langid_nb.known(docs, model)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by a Jaccard similarity of 0.8 or more on 5-word shingles."""
    return jaccard_rtree.one_of_each(docs, width=5, share=80, whole=100)


def private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data replaced by its kind; ``n_chars`` follows the text."""
    return pii_boost.redacted(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of at most 1024 ids."""
    return packing_dp.pack(docs, public_tokenizers.path("byte_bpe_50k.json"), added=True)


STAGES = [("quality", quality), ("language", language), ("near_duplicates", near_duplicates), ("private", private),
          ("packing", packing)]

# Robust estimates, learned models and dynamic programming have no SQL form; tests hold the stages
# against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
