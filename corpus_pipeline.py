"""The document pipeline: toxic documents go, one of each group of
near-duplicates stays, documents that hold benchmark items go, sources are
mixed to target weights and the result is cut into shards.

``STAGES`` lists the stages in order; each takes (spark, docs, sf_dir) and all
but the last return the columns of ``docs``. ``run`` writes every stage to the
shared folder and reads it back. SQL can't express the first four stages, so
``ORACLE_SQL`` is None and tests compare them with brute force.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from unnestor.llm import decontaminate, mixing, sharding, simhash, toxicity
from unnestor.llm.common import stage, table

N_SHARDS = 40


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the toxicity model, fitted on the labels, doesn't reject."""
    return toxicity.keep_clean(docs, table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component: the one with the smallest id."""
    return simhash.deduplicate(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that hold no benchmark item."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as often as the mix of the sources takes them."""
    return mixing.mix(docs)


def cut_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with the number of their shard."""
    return sharding.shard_documents(docs, N_SHARDS)


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
    ("sharding", cut_shards),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
