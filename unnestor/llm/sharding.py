"""Contiguous shards of near equal bytes by a global prefix sum.

Rows are ordered by range partitions. A running sum inside each partition plus
the totals of the partitions before it is a row's place in the whole, and the
whole is cut at equal targets. Only keys and sizes are shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import attach, partitions, stage, utf8_size

OVERHEAD = 16  # bytes a document takes besides its text


def document_size(text: Column) -> Column:
    """UTF-8 bytes of the text (null: none) plus ``OVERHEAD``."""
    return utf8_size(text) + F.lit(OVERHEAD)


def contiguous_shards(df: DataFrame, n_shards: int, order: list[str], size: str = "size") -> DataFrame:
    """Add ``start`` (bytes before the row), ``shard`` and ``slot`` (place in
    the shard, from 0) to the rows of ``df`` in the order of ``order`` (nulls
    first). A row belongs to the shard that holds the middle of its bytes, so
    no shard is off its equal share by more than the rows at its two ends.

    ``order`` should end in a column that tells repeated rows apart, such as
    ``monotonically_increasing_id``: range partitions can then split a key
    that holds many rows. Sizes must be positive and not null. An empty table
    gives an empty result.
    """
    spark = df.sparkSession
    ranged = df.repartitionByRange(partitions(spark), *order).withColumn("__part", F.spark_partition_id())
    placed = stage(ranged, "ranged")
    inside = Window.partitionBy("__part").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    running = placed.withColumn("__sum", F.sum(size).over(inside)).withColumn("__row", F.row_number().over(
        Window.partitionBy("__part").orderBy(*order)))
    # one row per partition from here
    totals = placed.groupBy("__part").agg(F.sum(size).alias("__bytes"), F.count(F.lit(1)).alias("__rows"))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy()
    offsets = totals.select(
        "__part",
        F.coalesce(F.sum("__bytes").over(before), F.lit(0)).alias("__before"),
        F.coalesce(F.sum("__rows").over(before), F.lit(0)).alias("__rows_before"),
        F.sum("__bytes").over(whole).alias("__total"),
    )
    rows = attach(running, offsets, ["__part"])
    start = F.col("__before") + F.col("__sum") - F.col(size)
    middle = F.expr(f"least({n_shards - 1}, ((2 * start + `{size}`) * {n_shards}) div (2 * __total))")
    cut = stage(
        rows.withColumn("start", start)
        .withColumn("shard", middle.cast("int"))
        .withColumn("__at", F.col("__rows_before") + F.col("__row") - 1)
        .drop("__part", "__before", "__sum", "__row", "__rows_before", "__total"),
        "shards",
    )
    # one row per shard
    firsts = cut.groupBy("shard").agg(F.min("__at").alias("__first"))
    return attach(cut, firsts, ["shard"]).withColumn("slot", F.col("__at") - F.col("__first")).drop("__at", "__first")


def shard_keys(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The slim rows that decide the shards of ``docs``: id, size, checksum of
    the text (null text: 0, the checksum of no bytes) and a row number that
    tells repeated rows apart."""
    text = F.col(f"`{text_col}`")
    return docs.select(
        F.col(f"`{id_col}`").alias("doc_id"),
        document_size(text).alias("size"),
        F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"),
        F.monotonically_increasing_id().alias("row"),
    )


ORDER = ["doc_id", "text_crc32", "size", "row"]


def shard_documents(docs: DataFrame, n_shards: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with a column ``shard``: contiguous in the order of the id, of
    near equal bytes. Texts are not shuffled: the shards of the slim rows give
    each shard's first and last key (``n_shards`` rows on the driver), and
    every document compares its key with those. The rows of a key that a cut
    divides are dealt to its shards in proportion, by hash of their place.
    An input column ``shard`` is replaced."""
    parts = ["doc_id", "text_crc32", "size"]
    cut = contiguous_shards(shard_keys(docs, id_col, text_col), n_shards, ORDER)
    key = F.struct(*parts)
    cuts = cut.groupBy("shard").agg(F.min(key).alias("first"), F.max(key).alias("last")).orderBy("shard").collect()
    literal = lambda k: F.struct(*[F.lit(k[c]).cast("bigint").alias(c) for c in parts])
    own = F.col("__key")
    shard = F.lit(cuts[0]["shard"] if cuts else 0)
    for r in cuts[1:]:
        shard = F.when(own >= literal(r["first"]), F.lit(r["shard"])).otherwise(shard)
    divided = {b["first"] for a, b in zip(cuts, cuts[1:]) if a["last"] == b["first"]}
    for k in divided:
        same = cut.where(key.eqNullSafe(literal(k))).groupBy("shard").count().orderBy("shard").collect()
        end = sum(r["count"] for r in same)
        place = F.pmod(F.xxhash64("__place"), F.lit(end))
        dealt = F.lit(same[-1]["shard"])
        for r in reversed(same):
            dealt = F.when(place < end, F.lit(r["shard"])).otherwise(dealt)
            end -= r["count"]
        shard = F.when(own.eqNullSafe(literal(k)), dealt).otherwise(shard)
    text = F.col(f"`{text_col}`")
    mine = F.struct(
        F.col(f"`{id_col}`").cast("bigint").alias("doc_id"), F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"),
        document_size(text).alias("size"),
    )
    placed = docs.withColumn("__key", mine).withColumn("__place", F.monotonically_increasing_id())
    return placed.withColumn("shard", shard.cast("int")).drop("__key", "__place")
