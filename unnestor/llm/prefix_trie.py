"""The prefix trie of a conversation table, screened by a count-min sketch.

Conversations are rebuilt first (``rebuild``): conversation ``c`` begins with
the first ``h`` original turns of its donor ``c - c % 20`` and goes on with its
own turns after its first ``h``. A prefix is named by its length and a 128-bit
digest, the exclusive or of digests of its (position, role, text): a running
aggregate, so a conversation of any length is cut into blocks and never lies
in one task.

A count-min sketch of all prefix digests is made by the tasks and merged by
cell. Its estimates are never too small, so an estimate of one proves that a
prefix belongs to one conversation: such rows (the tails) are finished where
they lie. Only prefixes that may be shared are shuffled, grouped exactly and
added up over the tree. The sketch has a fixed greatest size; a larger corpus
makes it less selective and changes no result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import attach, partitions, stage_at, unstage, word_count

PERIOD, HEAD = 20, 4  # a donor is a multiple of PERIOD; fewer than HEAD turns come from it
BLOCK = 1024  # turns of a conversation that one window holds
SKETCH_ROWS = 4
LEAST_WIDTH, MOST_WIDTH = 1 << 14, 1 << 24  # cells of a row; the merged sketch has one bit a cell, so 8 MB at most
CHUNK = 1 << 14  # cells that are merged together
PIECE = 4096  # conversation ids of a node that are joined in one text
NODE = ["depth", "d1", "d2"]


def _ordered_turns(conversations: DataFrame) -> tuple[DataFrame, str]:
    """(conv_id, pos, words, t1, t2), staged: position from 0 in the order of
    turn (null first), role and text, and a digest of role and text. The rows
    are range-partitioned by the whole order, so one conversation may lie in
    many partitions."""
    spark = conversations.sparkSession
    text = F.coalesce(F.col("text"), F.lit(""))
    role = F.coalesce(F.col("role"), F.lit(""))
    turns = conversations.select(
        F.col("conv_id").cast("bigint").alias("conv_id"), "turn", role.alias("role"), text.alias("text")
    ).where("conv_id is not null")
    said = F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"))
    place = F.monotonically_increasing_id()
    placed, at = stage_at(
        turns.orderBy("conv_id", "turn", "role", "text").select(
            "conv_id", word_count(F.col("text")).alias("words"), said.alias("said"), place.alias("place")), "turns")
    part = F.shiftright("place", 33)
    placed = placed.withColumn("part", part).withColumn("at", F.col("place").bitwiseAND((1 << 33) - 1))
    runs = placed.groupBy("conv_id", "part").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    runs, runs_at = stage_at(runs.select(
        "conv_id", "part", (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first")).alias("shift")), "runs")
    numbered, numbered_at = stage_at(
        attach(placed, runs, ["conv_id", "part"]).select("conv_id", (F.col("at") + F.col("shift")).alias("pos"), "words", "said"), "numbered")
    unstage(spark, at)
    unstage(spark, runs_at)
    return numbered, numbered_at


def _rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rebuilt turns (conv_id, pos, words, said), and (conv_id, len) of
    every conversation, turnless ones included."""
    own = turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("own"))
    id_hash = F.crc32(F.col("conv_id").cast("string").cast("binary"))
    convs = own.select(
        "conv_id", "own", (id_hash % HEAD).alias("h"), (F.col("conv_id") - F.col("conv_id") % PERIOD).alias("donor"))
    donors = own.where(F.col("conv_id") % PERIOD == 0).select(F.col("conv_id").alias("donor"), F.col("own").alias("theirs"))
    taken = F.least("h", F.coalesce("theirs", F.lit(0)))
    convs = convs.join(donors.hint("merge"), "donor", "left").select(
        "conv_id", "donor", "h", taken.alias("taken"), (taken + F.greatest(F.col("own") - F.col("h"), F.lit(0))).alias("len"))
    heads = turns.where((F.col("conv_id") % PERIOD == 0) & (F.col("pos") < HEAD - 1)).select(
        F.col("conv_id").alias("donor"), "pos", "words", "said")
    begun = convs.join(heads.hint("merge"), "donor").where("pos < taken").select("conv_id", "pos", "words", "said")
    rest = attach(turns, convs.select("conv_id", "h", "taken"), ["conv_id"]).where("pos >= h").select(
        "conv_id", (F.col("pos") - F.col("h") + F.col("taken")).alias("pos"), "words", "said")
    return begun.unionByName(rest), convs.select("conv_id", "len")


def _running(rows: DataFrame, key: str, order: str, values: list[str], total, down: bool = False) -> DataFrame:
    """``values`` replaced by their running ``total`` (an aggregate function)
    per ``key`` in the order of the number ``order``, rows of equal order
    counted together. A key is cut into blocks of ``BLOCK`` orders, whose
    totals are added up apart."""
    spark = rows.sparkSession
    block = F.floor(F.col(order) / BLOCK).cast("bigint")
    rows = rows.withColumn("block", -block if down else block)
    up = Window.partitionBy(key, "block").orderBy(F.desc(order) if down else F.asc(order)).rangeBetween(Window.unboundedPreceding, 0)
    inner, inner_at = stage_at(rows.select(
        *[c for c in rows.columns if c not in values], *[total(v).over(up).alias(v) for v in values],
        F.row_number().over(Window.partitionBy(key, "block").orderBy(F.asc(order) if down else F.desc(order))).alias("last")), "running")
    several = inner.groupBy(key).agg(F.min("block").alias("lo"), F.max("block").alias("hi")).where("lo < hi").select(key)
    ends = inner.where("last = 1").join(several.hint("merge"), key, "left_semi")
    before = Window.partitionBy(key).orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    offsets, offsets_at = stage_at(ends.select(key, "block", *[total(v).over(before).alias(f"{v}_before") for v in values]), "offsets")
    joined = attach(inner, offsets, [key, "block"], "left")
    both = [total_of(total, v) for v in values]
    out, at = stage_at(joined.select(*[c for c in inner.columns if c not in (*values, "block", "last")], *both), "running")
    unstage(spark, inner_at)
    unstage(spark, offsets_at)
    return out, at


def total_of(total, value: str) -> Column:
    before = F.coalesce(F.col(f"{value}_before"), F.lit(0).cast("bigint"))
    return (F.col(value).bitwiseXOR(before) if total is F.bit_xor else F.col(value) + before).alias(value)


def _prefixes(turns: DataFrame, lengths: DataFrame) -> tuple[DataFrame, str]:
    """(conv_id, depth, words, ends, d1, d2, p1, p2) of every prefix of every
    rebuilt conversation, the empty one included, staged: the digest of the
    prefix, and of that without its last turn."""
    spark = turns.sparkSession
    depth = (F.col("pos") + 1).alias("depth")
    salted = turns.select("conv_id", depth, "words", F.xxhash64("said", F.col("pos")).alias("s1"), F.xxhash64(F.col("pos"), "said", F.lit(1)).alias("s2"))
    salted = salted.withColumns({"d1": F.col("s1"), "d2": F.col("s2")})
    run, run_at = _running(salted, "conv_id", "depth", ["d1", "d2"], F.bit_xor)
    rows = attach(run, lengths, ["conv_id"]).select(
        "conv_id", "depth", "words", (F.col("depth") == F.col("len")).alias("ends"), "d1", "d2",
        F.col("d1").bitwiseXOR(F.col("s1")).alias("p1"), F.col("d2").bitwiseXOR(F.col("s2")).alias("p2"))
    zero, none = F.lit(0).cast("bigint"), F.lit(None).cast("bigint")
    roots = lengths.select(
        "conv_id", zero.alias("depth"), zero.alias("words"), (F.col("len") == 0).alias("ends"),
        zero.alias("d1"), zero.alias("d2"), none.alias("p1"), none.alias("p2"))
    out = stage_at(rows.unionByName(roots), "prefixes")
    unstage(spark, run_at)
    return out


def _cells(depth: np.ndarray, d1: np.ndarray, d2: np.ndarray, width: int) -> np.ndarray:
    """Cells of each prefix, one a row of the sketch."""
    a = d1.view(np.uint64) + depth.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    b = d2.view(np.uint64) | np.uint64(1)
    a ^= a >> np.uint64(29)
    found = [((a + np.uint64(j) * b) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(20)) % np.uint64(width) + np.uint64(j * width)
             for j in range(SKETCH_ROWS)]
    return np.stack(found).astype(np.int64)


def _columns(batch: pa.RecordBatch, *names: str) -> list[np.ndarray]:
    return [batch.column(n).fill_null(0).to_numpy(zero_copy_only=False) for n in names]


def shared_cells(prefixes: DataFrame, width: int) -> np.ndarray:
    """One bit for each cell of the count-min sketch: 1 if its count is over
    one. Tasks count their rows, chunks of cells are merged one by one, and
    ``SKETCH_ROWS * width / 8`` bytes reach the driver."""
    n_chunks = SKETCH_ROWS * width // CHUNK

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            cells, n = np.unique(_cells(*_columns(batch, *NODE), width), return_counts=True)
            at = np.searchsorted(cells, np.arange(n_chunks + 1) * CHUNK)
            for c in np.flatnonzero(np.diff(at)):
                own = held.setdefault(int(c), np.zeros(CHUNK, np.uint8))
                here = cells[at[c] : at[c + 1]] - c * CHUNK
                own[here] = np.minimum(2, own[here] + np.minimum(n[at[c] : at[c + 1]], 2).astype(np.uint8))
        for c, own in held.items():
            yield pa.RecordBatch.from_arrays([pa.array([c], pa.int32()), pa.array([own.tobytes()], pa.binary())], names=["chunk", "counts"])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for c, counts in zip(batch.column("chunk").to_pylist(), batch.column("counts")):
                own = held.setdefault(c, np.zeros(CHUNK, np.uint8))
                np.minimum(2, own + np.frombuffer(counts.as_buffer(), np.uint8), out=own)
        for c, own in held.items():
            bits = np.packbits(own > 1)
            if bits.any():
                yield pa.RecordBatch.from_arrays([pa.array([c], pa.int32()), pa.array([bits.tobytes()], pa.binary())], names=["chunk", "bits"])

    spark = prefixes.sparkSession
    counted = prefixes.select(*NODE).mapInArrow(count, "chunk int, counts binary")
    merged = counted.repartition(partitions(spark), "chunk").mapInArrow(merge, "chunk int, bits binary")
    bits = np.zeros(n_chunks * CHUNK // 8, np.uint8)
    for c, found in merged.collect():
        bits[c * CHUNK // 8 : (c + 1) * CHUNK // 8] = np.frombuffer(found, np.uint8)
    return bits


def _screened(prefixes: DataFrame) -> tuple[DataFrame, str]:
    """The prefixes with ``shared`` (the sketch can't prove that the prefix has
    one member) and ``forked`` (that, of the prefix one turn shorter), staged."""
    spark = prefixes.sparkSession
    width = LEAST_WIDTH
    n = prefixes.count()
    while width < min(2 * n, MOST_WIDTH):
        width *= 2
    bits = spark.sparkContext.broadcast(shared_cells(prefixes, width))

    def screen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def over_one(*digest: np.ndarray) -> np.ndarray:
            cells = _cells(*digest, width)
            return ((bits.value[cells >> 3] >> (7 - (cells & 7)).astype(np.uint8)) & 1).all(axis=0)

        for batch in batches:
            depth, d1, d2, p1, p2 = _columns(batch, *NODE, "p1", "p2")
            flags = over_one(depth, d1, d2), (depth > 0) & over_one(depth - 1, p1, p2)
            yield pa.RecordBatch.from_arrays([*batch.columns, *map(pa.array, flags)], names=[*batch.schema.names, "shared", "forked"])

    out = stage_at(prefixes.mapInArrow(screen, f"{_ddl(prefixes)}, shared boolean, forked boolean"), "screened")
    bits.unpersist()
    return out


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)


def _end_hashes(ends: DataFrame) -> tuple[DataFrame, str]:
    """``NODE`` and the SHA-256 of the conversations that end there, in
    numerical order, comma-joined. Ids are joined in pieces of at most
    ``PIECE``; only these texts of a node come together, one after another in
    a stream whose state is the hash."""
    spark = ends.sparkSession
    place = F.monotonically_increasing_id()
    placed, at = stage_at(ends.orderBy(*NODE, "conv_id").select(*NODE, "conv_id", place.alias("place")), "ends")
    placed = placed.withColumn("piece", F.floor(F.col("place") / PIECE).cast("bigint"))
    ids = F.transform(F.array_sort(F.collect_list("conv_id")), lambda c: c.cast("string"))
    pieces = placed.groupBy(*NODE, "piece").agg(F.array_join(ids, ",").alias("ids"))

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, sha = None, None

        def done():
            return pa.RecordBatch.from_arrays([*[pa.array([x], pa.int64()) for x in node], pa.array([sha.hexdigest()])], names=[*NODE, "ends_sha256"])

        for batch in batches:
            for *here, text in zip(*[batch.column(c).to_pylist() for c in (*NODE, "ids")]):
                if here == node:
                    sha.update(b",")
                else:
                    if node is not None:
                        yield done()
                    node, sha = here, hashlib.sha256()
                sha.update(text.encode())
        if node is not None:
            yield done()

    dealt = pieces.repartition(partitions(spark), *NODE).sortWithinPartitions(*NODE, "piece").select(*NODE, "ids")
    out = stage_at(dealt.mapInArrow(digest, "depth bigint, d1 bigint, d2 bigint, ends_sha256 string"), "end-hashes")
    unstage(spark, at)
    return out


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """One row per node of the trie of the rebuilt conversations: conv_id (its
    smallest member), depth, parent_conv_id (null at the root), n_convs,
    n_children, n_leaves, saved_tokens and ends_sha256.

    Turns are ordered by turn (null first), then role, then text; repeated
    rows are turns of their own. Null roles and texts are empty; rows without
    conv_id are no conversation and are left out. A conversation whose rebuilt
    sequence is empty is a member of the root alone. An empty table gives no
    rows, not even a root. Other columns are ignored. The remainder of a
    negative id has its sign. Texts of any length are hashed whole. Prefixes
    are told apart by 128-bit digests.
    """
    spark = conversations.sparkSession
    turns, turns_at = _ordered_turns(conversations)
    rebuilt, lengths = _rebuilt(turns)
    lengths, lengths_at = stage_at(lengths, "lengths")
    prefixes, prefixes_at = _prefixes(rebuilt, lengths)
    unstage(spark, turns_at)
    rows, rows_at = _screened(prefixes)
    unstage(spark, prefixes_at)
    unstage(spark, lengths_at)

    shared, tails = rows.where("shared"), rows.where("not shared")
    nodes, nodes_at = stage_at(shared.groupBy(*NODE).agg(
        F.count(F.lit(1)).alias("n_convs"), F.min("conv_id").alias("conv_id"), F.max("words").alias("words"),
        F.max("p1").alias("p1"), F.max("p2").alias("p2")), "nodes")
    up = [(F.col("depth") - 1).alias("depth"), F.col("p1").alias("d1"), F.col("p2").alias("d2")]
    # a tail hangs on the trie of shared prefixes by its first row alone
    first = tails.where("forked")
    children = nodes.where("depth > 0").select(*up).unionByName(first.select(*up))
    children, children_at = stage_at(children.groupBy(*NODE).agg(F.count(F.lit(1)).alias("n_children")), "children")
    nodes2, nodes2_at = stage_at(
        nodes.join(children.hint("merge"), NODE, "left").fillna(0, ["n_children"]), "nodes")

    # what a node adds to those above it, in the row of its smallest member; each sum of a subtree is then
    # one over the members' rows, and a member adds what it holds at that depth and below
    zero = F.lit(0).cast("bigint")
    own = nodes2.select(
        "conv_id", "depth", *[F.lit(None).cast("bigint").alias(c) for c in ("d1", "d2")],
        ((F.col("n_convs") - 1) * F.col("words")).alias("saved"), (F.col("n_children") == 0).cast("bigint").alias("leaves"))
    single = tails.where("ends").select(*[c for c in own.columns if c not in ("d1", "d2", "saved", "leaves")],
                                        *[F.lit(None).cast("bigint").alias(c) for c in ("d1", "d2")], zero.alias("saved"), F.lit(1).cast("bigint").alias("leaves"))
    members = shared.select("conv_id", "depth", "d1", "d2", zero.alias("saved"), zero.alias("leaves"))
    below, below_at = _running(members.unionByName(own).unionByName(single), "conv_id", "depth", ["saved", "leaves"], F.sum, down=True)
    sums, sums_at = stage_at(
        below.where("d1 is not null and (saved > 0 or leaves > 0)").groupBy(*NODE).agg(
            F.sum("leaves").alias("n_leaves"), F.sum("saved").alias("saved_tokens")), "subtrees")
    hashes, hashes_at = _end_hashes(shared.where("ends").select(*NODE, "conv_id"))

    nothing = F.sha2(F.lit("").cast("binary"), 256)
    parents, parents_at = stage_at(nodes.select(*NODE, F.col("conv_id").alias("parent_conv_id")), "parents")
    named = nodes2.join(sums.hint("merge"), NODE, "left").join(hashes.hint("merge"), NODE, "left").select(
        "conv_id", *up, F.col("n_convs"), "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", nothing).alias("ends_sha256"))
    id_hash = F.when(F.col("ends"), F.sha2(F.col("conv_id").cast("string").cast("binary"), 256)).otherwise(nothing)
    alone = [F.lit(1).cast("bigint").alias("n_convs"), (~F.col("ends")).cast("bigint").alias("n_children"),
             F.lit(1).cast("bigint").alias("n_leaves"), zero.alias("saved_tokens"), id_hash.alias("ends_sha256")]
    hung = named.unionByName(first.select("conv_id", *up, *alone))
    hung, hung_at = stage_at(hung, "hung")
    # the root's parent is no node: its row has depth -1 here and null digests. A lone prefix that the sketch calls
    # shared may follow a proven tail, which is no row of parents and has the same one member
    linked = attach(hung.where("depth >= 0"), parents, NODE, "left").withColumn("parent_conv_id", F.coalesce("parent_conv_id", "conv_id"))
    out = ["conv_id", (F.col("depth") + 1).alias("depth"), "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    root = hung.where("depth < 0").withColumn("parent_conv_id", F.lit(None).cast("bigint"))
    free = tails.where("not forked and depth > 0").select(
        "conv_id", "depth", F.col("conv_id").alias("parent_conv_id"), *alone)
    # a lone conversation's root is a tail without a parent
    lone = tails.where("depth = 0").select("conv_id", "depth", F.lit(None).cast("bigint").alias("parent_conv_id"), *alone)
    result, _ = stage_at(linked.select(*out).unionByName(root.select(*out)).unionByName(free).unionByName(lone), "trie")
    for path in (rows_at, nodes_at, children_at, nodes2_at, below_at, sums_at, hashes_at, parents_at, hung_at):
        unstage(spark, path)
    return result
