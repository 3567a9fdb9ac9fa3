"""SimHash near-duplicates: word-shingle fingerprints linked by a self-join of
a binary trie over their bits.

Two nodes of the trie are traversed together; the bits in which their paths
differ add up, and a pair whose sum exceeds the error budget is pruned. A pair
within ``max_bits`` bits has either at most ``max_bits // 2`` of them in its
first 32 bits or fewer in the rest than are left, so two tries, the second
with the halves exchanged, allow a small budget in the upper 32 levels and lose
no pair. Node pairs at a depth chosen by the number of fingerprints are Spark
groups; large nodes are dealt in blocks, so a group is bounded.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import ceil, log2

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import attach, partitions, stage, stage_at, unstage
from .components import Groups, connected_components

SHINGLE = 4
MAX_BITS = 4
NODE = 8192  # fingerprints of a trie node that starts a group, on average
LEAF = 32  # pairs below which two nodes are compared fingerprint by fingerprint
FRONT = 1 << 18  # node pairs that a task advances at once


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The SimHash of a text: a bit is set if it is in over half the hashes of
    the shingles, repeats included. ASCII letters count as lower case."""
    data = b" ".join((text or "").encode("utf-8", "surrogatepass").lower().split())
    if not data:
        return 0
    gaps = np.flatnonzero(np.frombuffer(data, np.uint8) == 32)
    starts = [0, *(gaps + 1).tolist()]
    ends = [*gaps.tolist(), len(data)]
    last = max(1, len(starts) - shingle + 1)
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(data[a:b], 42) for a, b in zip(starts[:last], ends[-last:])], dtype="<u8")
    ones = np.zeros(64, np.int64)
    for part in range(0, last, 1 << 16):
        bits = np.unpackbits(hashes[part : part + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > last, bitorder="little").view("<u8")[0])


def fingerprint_column(text: str, shingle: int = SHINGLE):
    """The fingerprints of a text column as signed longs."""

    @F.arrow_udf("bigint")
    def fingerprints(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            values = np.array([fingerprint(t.as_py(), shingle) for t in texts], np.uint64)
            yield pa.array(values.view(np.int64), pa.int64())

    return fingerprints(F.col(f"`{text}`"))


def _pairs(a: np.ndarray, b: np.ndarray, same: bool, depth: int, differ: int, head: int, total: int) -> Iterator[tuple]:
    """Index pairs of the sorted fingerprints ``a`` and ``b`` (two trie nodes
    at ``depth`` whose paths differ in ``differ`` bits) that differ in at most
    ``total`` bits, at most ``head`` of them among the first 32. ``same``:
    ``a`` and ``b`` are one node; each pair then comes once."""
    one = np.array
    stack = [(depth, one([0]), one([len(a)]), one([0]), one([len(b)]), one([differ]))]
    while stack:
        t, alo, ahi, blo, bhi, diff = stack.pop()
        if len(alo) > FRONT:
            for i in range(0, len(alo), FRONT):
                stack.append((t, *(x[i : i + FRONT] for x in (alo, ahi, blo, bhi, diff))))
            continue
        small = (ahi - alo) * (bhi - blo) <= LEAF
        if t == 64:
            small[:] = True
        if small.any():
            na, nb = (ahi - alo)[small], (bhi - blo)[small]
            # a leaf of many alike can't be: fingerprints are distinct, so leaves at 64 are single
            count = na * nb
            at = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
            width = np.repeat(nb, count)
            ia, ib = np.repeat(alo[small], count) + at // width, np.repeat(blo[small], count) + at % width
            near = np.bitwise_count(a[ia] ^ b[ib]) <= total
            if same:
                near &= ia < ib
            yield ia[near], ib[near]
        if small.all():
            continue
        alo, ahi, blo, bhi, diff = (x[~small] for x in (alo, ahi, blo, bhi, diff))
        bit = np.uint64(1 << (63 - t))
        path = np.uint64((~0 << (64 - t)) & (2**64 - 1))
        amid = np.searchsorted(a, (a[alo] & path) | bit)
        bmid = np.searchsorted(b, (b[blo] & path) | bit)
        budget = head if t < 32 else total
        cross = diff < budget
        kids = [
            (alo, amid, blo, bmid, diff), (amid, ahi, bmid, bhi, diff),
            *((x[cross] for x in k) for k in ((alo, amid, bmid, bhi, diff + 1), (amid, ahi, blo, bmid, diff + 1))),
        ]
        alo, ahi, blo, bhi, diff = (np.concatenate(x) for x in zip(*kids))
        full = (alo < ahi) & (blo < bhi)
        if same:
            full &= alo < bhi  # its mirror image holds the same pairs
        if full.any():
            stack.append((t + 1, *(x[full] for x in (alo, ahi, blo, bhi, diff))))


def _halves_exchanged(x: np.ndarray) -> np.ndarray:
    return (x << np.uint64(32)) | (x >> np.uint64(32))


def _links_in(rows: pd.DataFrame, depth: int, tries: list[tuple[int, int]], total: int) -> pd.DataFrame:
    """Links among the fingerprints of one group: a pair of trie nodes, or of
    blocks of them. A link to the smallest of each set that the group joins."""
    trie, lo, hi, i, j = (int(rows[c].iloc[0]) for c in ("trie", "lo", "hi", "i", "j"))
    head = tries[trie][1]
    fps = rows["fp"].to_numpy(np.int64).view(np.uint64)
    keys = _halves_exchanged(fps) if trie else fps
    order = np.argsort(keys)
    keys = keys[order]
    left = rows["left"].to_numpy(bool)[order]
    alone = lo == hi and i == j
    own = np.arange(len(keys))
    ia, ib = (own, own) if alone else (own[left], own[~left])
    groups = Groups(len(keys))
    differ = (lo ^ hi).bit_count()
    for x, y in _pairs(keys[ia], keys[ib], alone, depth, differ, head, total):
        groups.link(ia[x], ib[y])
    joined = groups.root != own
    back = fps[order].view(np.int64)
    return pd.DataFrame({"a": back[own[joined]], "b": back[groups.root[joined]]})


def fingerprint_links(fps: DataFrame, max_bits: int = MAX_BITS, node: int = NODE) -> DataFrame:
    """Links (a, b) that connect the distinct fingerprints ``fp`` (long) of
    ``fps`` as the pairs within ``max_bits`` bits do; ``fps`` is a stored table."""
    spark = fps.sparkSession
    n = fps.count()
    depth = max(1, min(20, ceil(log2(max(n, 2) / node))))
    # (trie, bits that the first half may differ in)
    tries = [(0, max_bits // 2)] + ([(1, max_bits - max_bits // 2 - 1)] if max_bits else [])
    swapped = F.expr("shiftrightunsigned(fp, 32) | shiftleft(fp, 32)")
    key = F.when(F.col("trie") == 0, F.col("fp")).otherwise(swapped)
    path = F.shiftrightunsigned(key, 64 - depth)
    placed = fps.withColumn("trie", F.explode(F.array(*[F.lit(t) for t, _ in tries]))).withColumn("at", path)
    nodes = placed.groupBy("trie", "at").agg(F.ceil(F.count(F.lit(1)) / node).alias("blocks"))
    nodes, nodes_at = stage_at(nodes, "trie-nodes")

    def masks(head: int) -> list[int]:
        return [sum(1 << k for k in c) for m in range(min(head, depth) + 1) for c in combinations(range(depth), m)]

    # by trie node: the node pairs it is in, with the blocks of both
    other = F.explode(
        F.when(F.col("trie") == 0, F.array(*[F.lit(m).cast("bigint") for m in masks(tries[0][1])]))
        .otherwise(F.array(*[F.lit(m).cast("bigint") for m in masks(tries[-1][1])]))
    )
    met = nodes.withColumn("mask", other).withColumn("partner", F.col("at").bitwiseXOR(F.col("mask")))
    partner = nodes.select("trie", F.col("at").alias("partner"), F.col("blocks").alias("partner_blocks"))
    met = met.join(partner, ["trie", "partner"]).select(
        "trie", "at", F.struct("partner", F.col("blocks"), "partner_blocks").alias("pair"))
    dealt = attach(placed, met, ["trie", "at"])
    block = F.pmod(F.xxhash64("fp"), F.col("pair.blocks"))
    first = F.col("at") <= F.col("pair.partner")
    alone = F.col("at") == F.col("pair.partner")
    # a block meets every block of the partner; of its own node, each pair of blocks once
    meets = F.explode(F.transform(F.sequence(F.lit(0).cast("bigint"), F.col("pair.partner_blocks") - 1), lambda k: F.when(
        alone, F.struct(F.least(F.col("block"), k).alias("i"), F.greatest(F.col("block"), k).alias("j"), (F.col("block") <= k).alias("left")),
    ).when(
        first, F.struct(F.col("block").alias("i"), k.alias("j"), F.lit(True).alias("left"))
    ).otherwise(F.struct(k.alias("i"), F.col("block").alias("j"), F.lit(False).alias("left")))))
    rows = dealt.withColumn("block", block).withColumn("meets", meets).select(
        "fp", "trie", F.least("at", "pair.partner").alias("lo"), F.greatest("at", "pair.partner").alias("hi"), "meets.*")

    def links(part: pd.DataFrame) -> pd.DataFrame:
        return _links_in(part, depth, tries, max_bits)

    found = rows.repartition(partitions(spark), "trie", "lo", "hi", "i", "j").groupBy("trie", "lo", "hi", "i", "j").applyInPandas(
        links, "a bigint, b bigint")
    found, _ = stage_at(found, "trie-links")
    unstage(spark, nodes_at)
    return found


def components(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, max_bits: int = MAX_BITS
) -> DataFrame:
    """One row per document: doc_id, fp (long), text_hash, component_id.

    Documents whose fingerprints differ in at most ``max_bits`` bits are
    linked; component_id is the smallest id that links reach (null if only
    null ids are reached; nulls don't count otherwise). Null, empty and blank
    texts have fingerprint 0 and are linked like others. Equal fingerprints
    are one node of the search. An empty table gives no rows.
    """
    rows = stage(
        docs.select(
            F.col(f"`{id_col}`").alias("doc_id"), fingerprint_column(text_col, shingle).alias("fp"),
            F.xxhash64(F.col(f"`{text_col}`")).alias("text_hash"),
        ),
        "fingerprints",
    )
    fps = stage(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "fingerprint-table")
    found = connected_components(fingerprint_links(fps.select("fp"), max_bits))
    rooted = stage(
        fps.join(found.withColumnRenamed("node", "fp").hint("merge"), "fp", "left")
        .select("fp", "least", F.coalesce("component", "fp").alias("root")),
        "fingerprint-roots",
    )
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = rooted.join(least.hint("merge"), "root").select("fp", "component_id", "root")
    return rows.join(named.hint("merge"), "fp").select("doc_id", "fp", "text_hash", "component_id", "root")


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """One document of each component, with all its columns: the one with the
    smallest id (null ids only where there is no other); of several with that
    id, the one whose text hash is smallest; of equal rows, one."""
    found = stage(components(docs, id_col, text_col, **how), "simhash-components")
    first = F.struct(F.col("doc_id").isNull().alias("bare"), F.col("doc_id"), F.col("text_hash"))
    kept = found.groupBy("root").agg(F.min(first).alias("k")).select("k.doc_id", "k.text_hash", "root")
    # the same id and text can only be in one component
    rows = found.select("doc_id", "text_hash").groupBy("doc_id", "text_hash").agg(F.count(F.lit(1)).alias("rows"))
    keys = stage(
        attach(rows, kept.select("doc_id", "text_hash").distinct().withColumn("keep", F.lit(True)), ["doc_id", "text_hash"])
        .select("doc_id", "text_hash", "rows"),
        "simhash-kept",
    )
    names = ["__id", "__hash"]
    marked = docs.withColumn("__id", F.col(f"`{id_col}`")).withColumn("__hash", F.xxhash64(F.col(f"`{text_col}`")))
    chosen = attach(marked, keys.toDF(*names, "__rows").where("__rows = 1"), names)
    single = chosen.drop(*names, "__rows")
    several = attach(marked, keys.toDF(*names, "__rows").where("__rows > 1"), names).dropDuplicates(names).drop(*names, "__rows")
    return single.unionByName(several)
