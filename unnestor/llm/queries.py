"""Queries of this package (``queries``) and DuckDB SQL for those that SQL can
express (``oracle_sql``). Each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.staging import staging_path
from . import collocations, compression_quality, decontaminate, html_text, mixing, ngram_lm, personal_data, pq_dedup, prefix_trie, sharding, simhash, token_files, toxicity
from .common import table

N_SHARDS = 40


def op1_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes of every document."""
    return mixing.taken(mixing.copies(table(spark, sf_dir, "documents")))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expected severity of every document."""
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs.select("doc_id", "text"), model).select("doc_id", "severity", "p_toxic", "toxic")


def op3_embedding_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and near-duplicate component of every vector."""
    return pq_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


def op4_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The benchmark items that documents hold."""
    return decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_byte_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shards of near equal bytes, contiguous in the order of the id."""
    keys = sharding.shard_keys(table(spark, sf_dir, "documents"))
    cut = sharding.contiguous_shards(keys, N_SHARDS, sharding.ORDER)
    return cut.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", F.col("slot").cast("bigint").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


OP5_SQL = f"""
with d as (
  select doc_id, coalesce(octet_length(encode(text)), 0) + {sharding.OVERHEAD} as size, text from documents
), p as (
  select *, sum(size) over (order by doc_id) - size as start, sum(size) over () as total,
         row_number() over (order by doc_id) - 1 as place
  from d
), s as (
  select *, cast(least({N_SHARDS - 1}, ((2 * start + size) * {N_SHARDS}) // (2 * total)) as integer) as shard from p
)
select doc_id, size, shard, place - min(place) over (partition by shard) as slot from s
"""


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate component of every document."""
    found = simhash.components(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op7_page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    found = html_text.main_text(table(spark, sf_dir, "pages"))
    return found.select("page_id", "url", "text", F.length("text").cast("bigint").alias("n_chars"))


def op8_backoff_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language-model score of every document."""
    return ngram_lm.score(table(spark, sf_dir, "documents"))


def op9_compression_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document, learnt from four fifths of the labels."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    model = compression_quality.fit(docs, table(spark, sf_dir, "labels").where(~held_out))
    return compression_quality.score(docs, model).select(
        "doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "score", "predicted")


def tokenizer_file(name: str = "byte_bpe_50k.json") -> str:
    """Path of a public tokenizer's vocabulary."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of every document, read back from the files they were written to."""
    path = staging_path(spark, "tokens")
    token_files.write(table(spark, sf_dir, "documents"), path, tokenizer_file())
    return token_files.read(spark, path)


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every node of the trie of the rebuilt conversations."""
    return prefix_trie.prefix_trie(table(spark, sf_dir, "conversations"))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best collocations of every language."""
    return collocations.collocations(table(spark, sf_dir, "documents"))


def op13_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The personal data of every document."""
    return personal_data.personal_data(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = (
        op1_source_mix, op2_toxicity, op3_embedding_components, op4_leaks, op5_byte_shards, op6_simhash, op7_page_text, op8_backoff_scores,
        op9_compression_quality, op10_token_files, op11_prefix_trie, op12_collocations, op13_personal_data,
    )
    return {f.__name__: f for f in found}


def oracle_sql() -> dict[str, str]:
    return {}
