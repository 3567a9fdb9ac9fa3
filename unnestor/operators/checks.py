"""Statistics and checks (A1-A3, C4, C5), each a single distributed job."""

from __future__ import annotations

from dataclasses import dataclass
from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..plans.catalog import TableSpec


# -- A1 ----------------------------------------------------------------------
def row_counts(tables: Sequence[tuple[str, DataFrame]]) -> DataFrame:
    """``(table_name, rows)`` for every table, in one job: a union of global
    counts (each a partial count per task, no data shuffle)."""
    if not tables:
        raise ValueError("no tables to count")
    parts = [
        df.agg(F.count(F.lit(1)).alias("rows")).select(
            F.lit(name).alias("table_name"), F.col("rows")
        )
        for name, df in tables
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# -- A2 ----------------------------------------------------------------------
def column_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """``(column_name, non_null, total)`` per column, from one aggregate pass."""
    cols = list(columns or df.columns)
    aggs = [F.count(F.col(f"`{c}`")).alias(f"_c{i}") for i, c in enumerate(cols)]
    one = df.agg(F.count(F.lit(1)).alias("_total"), *aggs)
    pairs = F.array(
        *[
            F.struct(F.lit(c).alias("column_name"), F.col(f"_c{i}").alias("non_null"))
            for i, c in enumerate(cols)
        ]
    )
    return one.select(F.inline(pairs), F.col("_total").alias("total"))


# -- A3 ----------------------------------------------------------------------
def reconcile(expected: DataFrame, loaded: DataFrame, key: str = "table_name") -> DataFrame:
    """Compare ``(table_name, rows)`` frames: expected vs loaded, with a status
    ``ok`` / ``mismatch`` / ``missing``. Both inputs hold one row per table."""
    e = expected.select(F.col(key), F.col("rows").alias("expected"))
    l = loaded.select(F.col(key), F.col("rows").alias("loaded"))
    j = e.join(l, key, "full_outer")
    status = (
        F.when(F.col("loaded").isNull() | F.col("expected").isNull(), F.lit("missing"))
        .when(F.col("loaded") == F.col("expected"), F.lit("ok"))
        .otherwise(F.lit("mismatch"))
    )
    return j.select(F.col(key), "expected", "loaded", status.alias("status"))


def content_checksum(columns: Sequence[str], where: Column | None = None) -> Column:
    """An aggregate over the content of rows that doesn't depend on their
    order: the exact sum of their 64-bit hashes. Equal rows count each time."""
    value = F.xxhash64(*[F.col(f"`{c}`") for c in columns]).cast("decimal(20,0)")
    return F.coalesce(F.sum(value if where is None else F.when(where, value)), F.lit(0).cast("decimal(30,0)"))


def reconcile_content(pairs: Sequence[tuple[str, DataFrame, DataFrame]]) -> DataFrame:
    """``(table_name, expected, loaded, status)`` of ``(name, expected rows,
    loaded rows)``: ``ok``, ``mismatch`` (another number of rows) or
    ``changed`` (as many rows, but not the same). One pass over each side."""
    if not pairs:
        raise ValueError("no tables to compare")
    parts = []
    for name, expected, loaded in pairs:
        names = expected.columns
        sides = [
            df.agg(F.count(F.lit(1)).alias(f"{side}"), content_checksum(names).alias(f"{side}_sum"))
            for side, df in (("expected", expected), ("loaded", loaded))
        ]
        both = sides[0].join(sides[1])  # one row each
        status = F.when(F.col("expected") != F.col("loaded"), "mismatch").when(F.col("expected_sum") != F.col("loaded_sum"), "changed").otherwise("ok")
        parts.append(both.select(F.lit(name).alias("table_name"), "expected", "loaded", status.alias("status")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@dataclass(frozen=True)
class SchemaDiff:
    missing: tuple[str, ...]
    extra: tuple[str, ...]
    mismatched: tuple[tuple[str, str, str], ...]

    @property
    def ok(self) -> bool:
        return not (self.missing or self.extra or self.mismatched)


# -- C4 ----------------------------------------------------------------------
def schema_matches(df: DataFrame, expected: T.StructType) -> bool:
    return df.schema == expected


# -- C5 ----------------------------------------------------------------------
def schema_diff(actual: T.StructType, expected: T.StructType) -> SchemaDiff:
    """Missing and extra column names, and type mismatches on common names
    (compared by name, so a mismatch is reported as such and not as one
    missing plus one extra column)."""
    a = {f.name: f.dataType for f in actual.fields}
    e = {f.name: f.dataType for f in expected.fields}
    return SchemaDiff(
        missing=tuple(n for n in e if n not in a),
        extra=tuple(n for n in a if n not in e),
        mismatched=tuple(
            (n, a[n].simpleString(), e[n].simpleString())
            for n in e if n in a and a[n] != e[n]
        ),
    )


def schema_drift(docs: DataFrame, spec: TableSpec, doc_col: str = "doc") -> DataFrame:
    """Drift of the documents against a layout: for every top-level key seen
    in the documents or declared, ``(key, documents, status)`` where status is
    ``ok`` (declared and seen), ``extra`` (seen, not declared) or ``missing``
    (declared, never seen). The key count is a partial aggregate, so it is
    cheap even if one key is in every document."""
    keys = docs.select(F.explode_outer(F.json_object_keys(F.col(doc_col))).alias("key"))
    seen = (
        keys.where(F.col("key").isNotNull())  # outer form: keys are extracted once
        .groupBy("key")
        .agg(F.count(F.lit(1)).alias("documents"))
    )
    declared_names = [f.source for f in spec.data_fields()]
    declared = F.explode(F.array(*[F.lit(n) for n in declared_names])).alias("key")
    decl = docs.sparkSession.range(1).select(declared, F.lit(True).alias("declared"))
    j = seen.join(decl, "key", "full_outer")
    status = (
        F.when(F.col("declared").isNull(), F.lit("extra"))
        .when(F.col("documents").isNull(), F.lit("missing"))
        .otherwise(F.lit("ok"))
    )
    return j.select(
        "key", F.coalesce(F.col("documents"), F.lit(0)).alias("documents"), status.alias("status")
    )
