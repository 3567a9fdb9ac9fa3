"""Helpers shared by the operators of this package."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..plans.sizing import fits_broadcast, measure
from ..plans.staging import stage, stage_at, unstage

__all__ = [
    "WORD", "attach", "expand", "fits_broadcast", "measure", "null_safe", "number_rows",
    "partitions", "stage", "stage_at", "table", "unstage", "utf8_size", "word_count",
]

# A word: a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def partitions(spark: SparkSession) -> int:
    """The session's shuffle width."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def word_count(text: Column) -> Column:
    """Number of words of ``text`` (null: 0)."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def utf8_size(text: Column) -> Column:
    """Bytes of ``text`` in UTF-8 (null: 0)."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("bigint")


def null_safe(left: DataFrame, right: DataFrame, keys: list[str]) -> Column:
    """Equality of ``keys`` in which null equals null."""
    cond = F.lit(True)
    for k in keys:
        cond = cond & left[f"`{k}`"].eqNullSafe(right[f"`{k}`"])
    return cond


def attach(big: DataFrame, small: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Join a per-key table to its rows, null keys included. The per-key table
    is broadcast only if its measured size is under the session's threshold;
    otherwise a sort-merge join, whose hot keys the adaptive planner splits."""
    spark = big.sparkSession
    side = small.withColumnsRenamed({k: f"__{k}" for k in keys})
    cond = F.lit(True)
    for k in keys:
        cond = cond & big[f"`{k}`"].eqNullSafe(side[f"`__{k}`"])
    side = F.broadcast(side) if fits_broadcast(spark, *measure(side, side.columns)) else side.hint("merge")
    return big.join(side, cond, how).drop(*[f"__{k}" for k in keys])


def expand(df: DataFrame, n: str, chunk: int = 10_000) -> DataFrame:
    """Every row ``n`` times (none if ``n`` is 0); ``n`` is dropped. Two steps
    keep the generated arrays short whatever ``n`` is."""
    steps = F.sequence(F.lit(0).cast("bigint"), F.expr(f"(`{n}` - 1) div {chunk}"))
    here = F.least(F.lit(chunk).cast("bigint"), F.col(f"`{n}`") - F.col("__step") * chunk)
    return (
        df.where(F.col(f"`{n}`") > 0)
        .withColumn("__step", F.explode(steps))
        .withColumn("__one", F.explode(F.array_repeat(F.lit(1), here.cast("int"))))
        .drop("__step", "__one", n)
    )


def number_rows(df: DataFrame, keys: list[str], name: str) -> DataFrame:
    """Number the rows of every key from 1 without gathering a key in one
    task: rows are numbered inside the partitions they lie in, and offset by
    the counts of the key's earlier partitions. ``df`` is staged."""
    placed = stage(
        df.withColumn("__part", F.spark_partition_id()).withColumn("__seq", F.monotonically_increasing_id()), "numbered"
    )
    at = [*keys, "__part"]
    inner = placed.withColumn("__in", F.row_number().over(Window.partitionBy(*at).orderBy("__seq")))
    before = Window.partitionBy(*keys).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    counts = placed.groupBy(*at).agg(F.count(F.lit(1)).alias("__n"))
    offsets = counts.select(*at, F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__offset"))
    joined = attach(inner, offsets, at)
    return joined.withColumn(name, F.col("__in") + F.col("__offset")).drop("__part", "__seq", "__in", "__offset")
