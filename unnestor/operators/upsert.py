"""Keyed upsert (K4) and bad-row split (K6), as DataFrame operators.

The store semantics are "insert, and on a key conflict the later row replaces
the earlier one". Distributed input has no arrival order, so the caller names
an ordering column (or columns); without one the greatest row wins, which is
the same on every run but says nothing about which arrived last.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.values import strip_control
from ..plans.sizing import fits_broadcast, measure
from ..plans.staging import stage_at, unstage


def _q(name: str) -> Column:
    return F.col(f"`{name}`")


def _keys(key: str | Sequence[str]) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def latest_per_key(
    df: DataFrame,
    key: str | Sequence[str],
    order_by: str | Sequence[str] | None = None,
    tiebreak: str | None = None,
) -> DataFrame:
    """One row per key: the row with the greatest ``order_by`` value (ties and
    ``order_by=None`` broken by the whole row, so the result is deterministic).

    ``max`` over ``struct(order..., row)`` is a partial aggregate: every task
    first keeps its own latest row per key, so a key that holds a large share
    of the rows is reduced map-side before the shuffle and never gathered in
    one place. ``tiebreak`` names a cheap deterministic column (a hash of the
    row's source) to break ties with instead of the whole row.
    """
    keys = _keys(key)
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.select(*[_q(k) for k in keys]).distinct()
    orders = [] if order_by is None else _keys(order_by)
    row = F.struct(*[_q(c) for c in rest]).alias("_row")
    group = df.groupBy(*[_q(k) for k in keys])
    if tiebreak is not None:
        rank = F.struct(*[_q(o).alias(f"_o{i}") for i, o in enumerate(orders)], _q(tiebreak).alias("_t"))
        picked = group.agg(F.max_by(row, rank).alias("_r")).select(*[_q(k) for k in keys], "_r.*")
    elif all(_orderable(df.schema[c].dataType) for c in rest):
        # one struct per key in the buffer: (ordering..., row); its maximum is
        # the latest version, the whole row breaking ties (and standing in for
        # an ordering that is null)
        ranked = F.struct(*[_q(o).alias(f"_o{i}") for i, o in enumerate(orders)], row)
        picked = group.agg(F.max(ranked).alias("_m")).select(*[_q(k) for k in keys], "_m._row.*")
    else:
        # maps and variants have no order: rank by (ordering..., row as JSON)
        tie = F.to_json(F.struct(*[_q(c) for c in rest]))
        rank = F.struct(*[_q(o).alias(f"_o{i}") for i, o in enumerate(orders)], tie.alias("_t"))
        picked = group.agg(F.max_by(row, rank).alias("_r")).select(*[_q(k) for k in keys], "_r.*")
    return picked.select(*[_q(c) for c in df.columns])


def superseded(
    df: DataFrame, key: Column, row_id: str, order_by: str | Sequence[str] | None = None, tiebreak: str | None = None
) -> tuple[DataFrame, str]:
    """``DataFrame[row_id]`` and its staged folder: the rows that ``latest_per_key`` would not keep,
    found from (key, order, tiebreak, row id) alone, so no payload is moved or
    compared. Rows with a null ``key`` are never superseded. ``row_id`` must
    be a stored column: both passes over ``df`` have to agree on it."""
    orders = [] if order_by is None else _keys(order_by)
    ranks = [*[_q(o).alias(f"_o{i}") for i, o in enumerate(orders)], *([_q(tiebreak).alias("_t")] if tiebreak else []), _q(row_id).alias("_id")]
    slim = df.select(key.alias("_k"), F.struct(*ranks).alias("_v")).where(F.col("_k").isNotNull())
    # keys that repeat first, by a hash aggregate of the keys alone: only their rows are ranked
    spark = df.sparkSession
    repeated, repeated_at = stage_at(slim.groupBy("_k").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("_k"), "repeated")
    size = measure(repeated, ["_k"])
    if not size[0]:
        unstage(spark, repeated_at)
        return stage_at(slim.where("false").select(F.col("_v._id").alias(row_id)), "superseded")
    side = F.broadcast(repeated) if fits_broadcast(spark, *size) else repeated.hint("merge")
    ranked = slim.join(side, "_k", "left_semi")
    several, several_at = stage_at(ranked.groupBy("_k").agg(F.max("_v").alias("_best")).select("_k", F.col("_best._id").alias("_best")), "versions")
    side = F.broadcast(several) if fits_broadcast(spark, *size) else several.hint("merge")
    lost = stage_at(slim.join(side, "_k").where("_v._id <> _best").select(F.col("_v._id").alias(row_id)), "superseded")
    unstage(spark, repeated_at)
    unstage(spark, several_at)
    return lost


def without_rows(df: DataFrame, lost: DataFrame, row_id: str) -> DataFrame:
    """``df`` without the rows of ``lost``. Their ids are broadcast where they
    measure under the limit, so that the payload stays where it is; beyond
    it both sides are dealt out by row id, which is even."""
    size = measure(lost, [row_id])
    if not size[0]:
        return df
    side = F.broadcast(lost) if fits_broadcast(df.sparkSession, *size) else lost.hint("merge")
    return df.join(side, row_id, "left_anti")


def _orderable(t: T.DataType) -> bool:
    if isinstance(t, (T.MapType, T.VariantType)):
        return False
    if isinstance(t, T.ArrayType):
        return _orderable(t.elementType)
    if isinstance(t, T.StructType):
        return all(_orderable(f.dataType) for f in t.fields)
    return True


def merge_upsert(
    target: DataFrame,
    incoming: DataFrame,
    key: str | Sequence[str],
    order_by: str | Sequence[str] | None = None,
) -> DataFrame:
    """Target rows whose key does not arrive, plus the latest incoming row per
    key. Both sides carry unique keys after deduplication, so the anti join
    is free of skew. The arriving keys are broadcast only after their size is
    measured (see ``plans.sizing``); a large increment is a sort-merge join."""
    keys = _keys(key)
    latest = latest_per_key(incoming, keys, order_by)
    # the arriving keys are broadcast only when the raw arriving rows (an
    # upper bound on the distinct keys) measure under the broadcast limit;
    # otherwise both sides are shuffled on the key
    rows, nbytes = measure(incoming, keys)
    arriving = latest.select(*[_q(k) for k in keys])
    arriving = F.broadcast(arriving) if fits_broadcast(incoming.sparkSession, rows, nbytes) else arriving.hint("merge")
    kept = target.join(arriving, keys, "left_anti")
    return kept.unionByName(latest.select(*[_q(c) for c in target.columns]))


def blank_key(key: str | Sequence[str], schema: T.StructType) -> Column:
    """True where any key column is null, or text that is empty once control
    characters are gone (it becomes null on load, so such a row could never
    be stored)."""
    conds = []
    for k in _keys(key):
        c = _q(k)
        if isinstance(schema[k].dataType, T.StringType):
            conds.append(c.isNull() | (strip_control(c) == ""))
        else:
            conds.append(c.isNull())
    out = conds[0]
    for c in conds[1:]:
        out = out | c
    return out


def split_bad_rows(df: DataFrame, key: str | Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """K6: ``(good, bad)`` where bad rows have a null or blank key. Every good
    row is kept; bad rows go to quarantine instead of being lost."""
    bad = blank_key(key, df.schema)
    return df.where(~bad), df.where(bad)
