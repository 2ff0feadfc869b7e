"""The corpus pipeline over ``documents``: language, near duplicates, benchmark passages, source mix, shards.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written
as Parquet and reread as the next stage's docs.  All stages but the last return
the columns of ``documents``.

Defined cases: rows without text have no language and go in the first stage;
rows with null ids or sources, repeated rows, ties and empty tables are treated
as the operators' docstrings say; further columns stay until the last stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ambry.llm import decontaminate, hash_tree, signature_tree, source_mix, string_kernel
from ambry.llm.common import brought_back, set_aside, table, written


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a learned language; unknown ones and those that resemble none go."""
    own = ["doc_id", "text", "lang"]
    found = string_kernel.identify(set_aside(docs, own))
    kept = found.where(f"lang_pred <> '{string_kernel.UNKNOWN}' AND resembles")
    return brought_back(kept, docs.columns, own)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of the smallest id of each group of near duplicates."""
    return signature_tree.one_of_each(docs)


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of a benchmark item."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's target weight asks for."""
    return source_mix.mixed_documents(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Shard and slot of every row that the other stages kept."""
    return hash_tree.shard_documents(docs)


STAGES = [("language", language), ("near_duplicates", near_duplicates), ("benchmark_passages", benchmark_passages),
          ("mix_sources", mix_sources), ("shard", shard)]

#: A trained classifier decides in the first stage, which SQL can't express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows for ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
