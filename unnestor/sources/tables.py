"""Documents from relational tables: the inverse of normalisation, used to
turn the driver's tables into document databases.

A parent's children are packed into arrays in a fixed order. Documents are
bounded objects (a document store caps their size), so a parent with more
than ``page_size`` children spans several documents ``<key>-<page>``; no group
of children, however large, is ever gathered into one row or one task.
"""

from __future__ import annotations

from typing import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..plans.sizing import fits_broadcast, measure
from ..plans.staging import stage

PAGE_SIZE = 1000

_ID_BITS = 33  # monotonically_increasing_id: partition index << 33 | row index


# Compressed input bytes per task when a small scan is spread out (they
# expand several times into rows, and into JSON for the documents).
SPREAD_BYTES_PER_TASK = 256 * 1024


def spread(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """Give a narrow pipeline enough tasks: when a scan yields fewer partitions
    than the cluster's default parallelism (a small table stored as one row
    group), redistribute its rows round-robin, over at most one task per
    ``SPREAD_BYTES_PER_TASK`` of input, so a tiny table is never cut into
    thousands of tasks. Large inputs already have many more splits than cores
    and are returned unchanged (no shuffle)."""
    sc = df.sparkSession.sparkContext
    want = min_partitions or sc.defaultParallelism
    have = df.rdd.getNumPartitions()
    if have >= want:
        return df
    conf = sc._jsc.hadoopConfiguration()
    size = 0
    for f in df.inputFiles():
        path = sc._jvm.org.apache.hadoop.fs.Path(f)
        size += path.getFileSystem(conf).getFileStatus(path).getLen()
    want = min(want, -(-size // SPREAD_BYTES_PER_TASK))
    return df.repartition(want) if want > have else df


def group_positions(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str = "pos"
) -> DataFrame:
    """Exact 0-based position of every row inside its ``keys`` group, in
    ``order`` (ties broken by input position), without a window over the
    group.

    A window partitioned by the key would put a whole group in one task. Here
    the rows are range-partitioned on ``keys + order`` (Spark samples the full
    sort key, so a large group is spread over many partitions), each row gets
    its index inside its sorted partition, and a small per-(key, partition)
    summary supplies how many rows of the same key sit in earlier partitions.
    The summary has at most one row per key and partition boundary, so its
    window partitions stay small even for a key that holds most rows.

    The sorted, numbered rows are written once to the checkpoint folder and
    both the summary and the final join read that copy: partition numbers
    must be the same on both sides, and two evaluations of the sort could be
    coalesced differently by adaptive execution (or re-run after a lost
    executor).
    """
    keys, order = list(keys), list(order)
    s = df.withColumn("_tb", F.monotonically_increasing_id())
    s = s.orderBy(*[F.col(c) for c in keys + order], F.col("_tb"))
    gid = F.monotonically_increasing_id()
    s = s.withColumn("_gid", gid).select(
        *df.columns,
        F.shiftright("_gid", _ID_BITS).alias("_part"),
        F.col("_gid").bitwiseAND((1 << _ID_BITS) - 1).alias("_idx"),
    )
    s = stage(s, "positions")
    runs = s.groupBy(*keys, "_part").agg(
        F.min("_idx").alias("_first"), F.count(F.lit(1)).alias("_n")
    )
    before = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select(
        *[F.col(k).alias(f"_r_{k}") for k in keys],
        F.col("_part").alias("_r_part"),
        "_first",
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"),
    )
    cond = F.col("_part") == F.col("_r_part")
    for k in keys:
        cond = cond & F.col(k).eqNullSafe(F.col(f"_r_{k}"))
    # with keys, the summary has about one row per key: it grows with the
    # data, so it is shuffled, never broadcast on a size estimate; without
    # keys it has one row per partition and the planner may broadcast it
    joined = s.join(runs.hint("merge") if keys else runs, cond)
    pos = F.col("_idx") - F.col("_first") + F.col("_before")
    return joined.select(*df.columns, pos.alias(name))


def in_slot_order(arr: Column) -> Column:
    """Sort an array of ``struct(_slot, ...)`` by ``_slot`` (items may hold
    maps, which have no ordering of their own)."""
    return F.array_sort(
        arr,
        lambda a, b: F.when(a["_slot"] < b["_slot"], -1).when(a["_slot"] > b["_slot"], 1).otherwise(0),
    )


# Upper bound on the number of over-full keys whose list is broadcast to split
# the children into the cheap and the exact path; the list's measured size
# must also be under the session's broadcast threshold.
MAX_BROADCAST_KEYS = 100_000


def _key_match(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    cond = F.lit(True)
    for k in keys:
        cond = cond & left[k].eqNullSafe(right[k])
    return cond


def _order_struct(order: Sequence[str]) -> Column:
    return F.struct(*[F.col(c) for c in order])


ItemBuilder = Callable[[Column], Column]


def _pages_by_positions(
    src: DataFrame, keys: list[str], order: list[str], page_size: int, raw: Sequence[str] | None = None
) -> DataFrame:
    # ties fall back on the whole row, as they do in a single page
    ties = [] if raw is None else ["_item"]
    ranked = group_positions(src, keys, [*order, *ties])
    paged = ranked.select(
        *keys,
        F.expr(f"pos div {int(page_size)}").alias("page"),
        F.pmod(F.col("pos"), F.lit(page_size)).alias("_slot"),
        "_item",
    )
    if raw is None:
        collected = F.collect_list(F.struct("_slot", "_item"))
        grouped = paged.groupBy(*keys, "page").agg(in_slot_order(collected).alias("_items"))
        return grouped.select(*keys, "page", F.transform("_items", lambda x: x["_item"]).alias("items"))
    # raw rows: one flat struct (slot first, then the row's fields), sorted by
    # the natural (compiled) order
    collected = F.collect_list(F.struct(F.col("_slot"), F.col("_item.*")))
    grouped = paged.groupBy(*keys, "page").agg(F.array_sort(collected).alias("_items"))
    return grouped.select(*keys, "page", F.transform("_items", lambda x: F.struct(*[x[c].alias(c) for c in raw])).alias("items"))


def _single_pages(
    src: DataFrame, keys: list[str], order: list[str], raw: Sequence[str] | None = None
) -> DataFrame:
    """Keys with at most one page of children: one bounded list per key,
    sorted by ``order`` (no positions needed)."""
    if raw is None:
        entry = F.struct(_order_struct(order).alias("_o"), F.col("_item"))
        by_order = lambda a, b: F.when(a["_o"] < b["_o"], -1).when(a["_o"] > b["_o"], 1).otherwise(0)
        items = F.transform(F.array_sort(F.collect_list(entry), by_order), lambda x: x["_item"])
    else:
        # the raw row leads with the order columns: natural (compiled) sort of
        # the rows themselves (an extra struct around them costs over 2x here)
        items = F.array_sort(F.collect_list(F.col("_item")))
    grouped = src.groupBy(*keys).agg(items.alias("items"))
    return grouped.select(*keys, F.lit(0).cast("long").alias("page"), "items")


def pack_pages(
    children: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    item: Column | ItemBuilder,
    page_size: int = PAGE_SIZE,
    payload: Sequence[str] = (),
) -> DataFrame:
    """``(keys..., page, items)``: the children of every key as arrays of at
    most ``page_size`` items, in ``order`` (which should be a total order of
    the children for a deterministic result). ``item`` may be null (kept as a
    null element).

    ``item`` is either a column, built before the grouping, or a function
    that builds the item from the raw row (a struct of the ``order`` and
    ``payload`` columns) after it, so that the shuffle carries the compact
    typed columns instead of the finished items.

    Per-key counts come from a partial aggregate. Keys with at most
    ``page_size`` children are packed with one bounded ``collect_list`` per
    key. Keys with more (the only ones that could be large) go through
    ``group_positions``, which never puts a key in one task. Their list is
    broadcast to route the rows only when its measured size is under the
    session's broadcast threshold (and it has at most ``MAX_BROADCAST_KEYS``
    keys); otherwise every key takes the exact path.
    """
    if callable(item) and not isinstance(item, Column):
        pages = pack_rows(children, keys, order, page_size, payload)[0]
        return pages.select(*keys, "page", F.transform("items", item).alias("items"))
    order = [c for c in order if c not in keys]
    return _packed(children, children.select(*keys, *order, item.alias("_item")), list(keys), order, page_size)[0]


def pack_rows(
    children: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    page_size: int = PAGE_SIZE,
    payload: Sequence[str] = (),
) -> tuple[DataFrame, bool]:
    """Pages (as of ``pack_pages``) whose items are the raw rows, structs of the
    ``order`` and ``payload`` columns, and whether no key has more than one
    page. What is made of the items is best built after the pages are joined,
    so that the join sorts compact rows."""
    order = [c for c in order if c not in keys]
    raw = [*order, *[c for c in payload if c not in order]]
    return _packed(children, children.select(*keys, *order, F.struct(*raw).alias("_item")), list(keys), order, page_size, raw)


def _packed(
    children: DataFrame, src: DataFrame, keys: list[str], order: list[str], page_size: int, raw: Sequence[str] | None = None
) -> tuple[DataFrame, bool]:
    if not keys:
        return _pages_by_positions(src, keys, order, page_size, raw), False
    counts = children.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    hot = counts.where(F.col("_n") > page_size).select(*keys)
    n_hot, hot_bytes = measure(hot, keys)
    if n_hot == 0:
        return _single_pages(src, keys, order, raw), True
    if not fits_broadcast(children.sparkSession, n_hot, hot_bytes, MAX_BROADCAST_KEYS):
        return _pages_by_positions(src, keys, order, page_size, raw), False
    b = F.broadcast(hot)
    cold = src.join(b, _key_match(src, b, keys), "left_anti")
    heavy = src.join(b, _key_match(src, b, keys), "left_semi")
    return _single_pages(cold, keys, order, raw).unionByName(
        _pages_by_positions(heavy, keys, order, page_size, raw)
    ), False


def attach_pages(
    parents: DataFrame, parent_key: str, pages: DataFrame, child_key: str, items_as: str, single: bool = False
) -> DataFrame:
    """Parents with their pages: one row per (parent, page); a parent without
    children gets page 0 and a null array.

    ``single``: no key has more than one page, so a left join is free of skew
    and reads both sides once. Else written as an inner join plus the parents that have no page, not as a
    left join: a parent with very many children has very many pages, and
    adaptive execution can split a skewed partition on either side of an
    inner join, but only on the preserved side of an outer one. The parents
    without pages come from an anti join against the distinct page keys (a
    partial aggregate, so it is small and skew-free)."""
    # Both sides grow with the data (no proven size bound), so the joins are
    # sort-merge joins, never broadcasts chosen from a size estimate.
    # Parents without a key are apart, so that both joins read the same rows
    # and share one shuffle of them.
    p = pages.select(F.col(child_key).alias("_ck"), "page", F.col("items").alias(items_as)).hint("merge")
    cols = [parents[c] for c in parents.columns]
    keyed = parents.where(parents[parent_key].isNotNull())
    if single:
        page = F.coalesce("page", F.lit(0).cast("long")).alias("page")
        left = keyed.join(p, keyed[parent_key] == p["_ck"], "left").select(*cols, page, items_as)
        none = [*cols, F.lit(0).cast("long").alias("page"), F.lit(None).cast(p.schema[items_as].dataType).alias(items_as)]
        return left.unionByName(parents.where(parents[parent_key].isNull()).select(*none))
    with_pages = keyed.join(p, keyed[parent_key] == p["_ck"], "inner").select(*cols, "page", items_as)
    keys = pages.select(F.col(child_key).alias("_ck")).distinct().hint("merge")
    none = [*cols, F.lit(0).cast("long").alias("page"), F.lit(None).cast(p.schema[items_as].dataType).alias(items_as)]
    lonely = keyed.join(keys, keyed[parent_key] == keys["_ck"], "left_anti").select(*none)
    return with_pages.unionByName(lonely).unionByName(parents.where(parents[parent_key].isNull()).select(*none))


def doc_id(key: Column | str, page: Column | str = "page") -> Column:
    k = F.col(key) if isinstance(key, str) else key
    p = F.col(page) if isinstance(page, str) else page
    return F.concat(k.cast("string"), F.lit("-"), p.cast("string"))
