"""Mixing sources to target weights by pivotal dependent rounding.

Every source gets a target number of words; a document's expected number of
copies is its source's target over its size. The whole part is taken for
certain. The fractional parts are rounded by pivotal sampling on word mass: two
documents exchange mass, in a random direction that keeps both expectations,
until one of them is integral. A source's taken words so stay at its target
until one document is left, which goes to the nearer side; documents of the
last block then change sides where that brings the words nearer the target.
Blocks of ``BLOCK`` documents are rounded by a fold each, and their residuals
form the next level of a reduction tree, so no source is gathered in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import attach, expand, number_rows, stage, word_count

WEIGHTS = (3.0, 1.0, 2.0)
SHARE = 1.5
CAP = 2.0
BLOCK = 64  # documents a fold rounds on average


def source_targets(
    items: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, cap: float = CAP
) -> DataFrame:
    """(source, source_size, target) from rows (source, size, m): sources in
    the order of their code points, null last, take ``weights`` in turn and
    share ``share`` times all words; none gets over ``cap`` times its own, and
    the excess goes to the others by weight.

    The shares that no cap binds are one number times their weight. Going
    through the sources by cap per weight, the capped ones are those whose cap
    is under the share that the rest would leave them. One row per source.
    """
    stats = items.groupBy("source").agg(F.sum(F.col("size") * F.col("m")).alias("source_size"))
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (place % len(weights) + 1).cast("int"))
    rows = stats.withColumn("w", weight).withColumn("cap", F.col("source_size") * F.lit(float(cap)))
    order = [F.col("cap") / F.col("w"), F.col("source").asc_nulls_last()]
    through = Window.orderBy(*order)
    left = F.sum("source_size").over(Window.partitionBy()) * F.lit(float(share)) - F.coalesce(
        F.sum("cap").over(through.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    weight_left = F.sum("w").over(through.rowsBetween(0, Window.unboundedFollowing))
    rows = rows.withColumn("level", left / weight_left)
    # the level at the first source that its cap doesn't bind
    free = F.min(F.when(F.col("level") * F.col("w") <= F.col("cap"), F.struct(F.col("cap") / F.col("w"), F.col("level")))).over(
        Window.partitionBy())
    level = F.coalesce(free["level"], F.lit(float("inf")))
    return rows.withColumn("target", F.least(F.col("cap"), level * F.col("w"))).select("source", "source_size", "target")


def _uniform(*parts: Column) -> Column:
    """A number in [0, 1) that the given values decide."""
    return F.shiftrightunsigned(F.xxhash64(*parts), 11) / F.lit(float(1 << 53))


def _round_block(rows: Column) -> Column:
    """Fold over an array of structs with ``p`` (share of a copy), ``mass``
    (words) and ``u`` (uniform): structs (at, up) of what became integral and
    the index ``i`` and share ``p`` of the residual."""
    start = F.expr(
        "named_struct('i', cast(null as int), 'p', cast(null as double), 'mass', cast(null as double), 'next', 0, "
        "'done', cast(array() as array<struct<at: int, up: int>>))"
    )

    def fold(acc: Column, e: Column) -> Column:
        give, room = acc["p"] * acc["mass"], (1 - acc["p"]) * acc["mass"]
        e_give, e_room = e["p"] * e["mass"], (1 - e["p"]) * e["mass"]
        gain, loss = F.least(room, e_give), F.least(give, e_room)
        up = F.coalesce(e["u"] < F.try_divide(loss, gain + loss), F.lit(False))
        # is it the residual that becomes integral, or the next document?
        first = F.when(up, room <= e_give).otherwise(give <= e_room)
        e_p = F.when(up, e["p"] - room / e["mass"]).otherwise(e["p"] + give / e["mass"])
        acc_p = F.when(up, acc["p"] + e_give / acc["mass"]).otherwise(acc["p"] - e_room / acc["mass"])
        hit = F.struct(
            F.when(first, acc["i"]).otherwise(acc["next"]).alias("at"),
            F.when(first == up, F.lit(1)).otherwise(F.lit(0)).alias("up"),
        )
        mine = F.struct(
            acc["next"].alias("i"), e["p"].alias("p"), e["mass"].alias("mass"), (acc["next"] + 1).alias("next"),
            acc["done"].alias("done"),
        )
        met = F.struct(
            F.when(first, acc["next"]).otherwise(acc["i"]).alias("i"),
            F.when(first, e_p).otherwise(acc_p).alias("p"),
            F.when(first, e["mass"]).otherwise(acc["mass"]).alias("mass"),
            (acc["next"] + 1).alias("next"),
            F.concat(acc["done"], F.array(hit)).alias("done"),
        )
        return F.when(acc["i"].isNull(), mine).otherwise(met)

    return F.aggregate(rows, start, fold)


def _balance(entries: Column, folded: Column) -> Column:
    """Of a source's last block: its residual goes to the nearer side, and in
    falling order of size a document changes sides if the words then miss the
    target by less. All structs (at, up)."""
    up = folded["p"] >= 0.5
    miss = F.when(up, (1 - folded["p"]) * folded["mass"]).otherwise(-folded["p"] * folded["mass"])
    mass = lambda d: F.element_at(entries, d["at"] + 1)["mass"]
    done = F.array_sort(F.transform(folded["done"], lambda d: F.struct((-mass(d)).alias("order"), d["at"].alias("at"), d["up"].alias("up"))))
    last = F.filter(F.array(F.struct(folded["i"].alias("at"), up.cast("int").alias("up"))), lambda d: d["at"].isNotNull())

    def turn(acc: Column, d: Column) -> Column:
        after = acc["miss"] + F.when(d["up"] == 1, d["order"]).otherwise(-d["order"])
        turned = F.abs(after) < F.abs(acc["miss"])
        side = F.struct(d["at"].alias("at"), F.when(turned, 1 - d["up"]).otherwise(d["up"]).alias("up"))
        return F.struct(F.when(turned, after).otherwise(acc["miss"]).alias("miss"), F.concat(acc["done"], F.array(side)).alias("done"))

    start = F.struct(F.coalesce(miss, F.lit(0.0)).alias("miss"), last.alias("done"))
    return F.aggregate(done, start, turn)["done"]


def _round(items: DataFrame, seed: int) -> DataFrame:
    """Add ``up`` (0 or 1) to ``items``: rows (source, doc_id, size, p, ...)
    with 0 < p < 1. Documents without words are rounded among themselves."""
    fields = [c for c in items.columns if c != "p"]
    tree = items.withColumn("bare", F.col("size") == 0)
    counts = tree.groupBy("source", "bare").agg(F.count(F.lit(1)).alias("n"))
    counts = stage(counts.withColumn("n", F.ceil(F.col("n") / BLOCK)), "mix-blocks")
    most = counts.agg(F.max("n")).first()[0] or 0
    level, settled = 0, items.withColumn("up", F.lit(0)).drop("p").limit(0)
    while most >= 1:
        sized = attach(tree, counts, ["source", "bare"])
        block = F.pmod(F.xxhash64("source", "doc_id", "size", F.lit(seed + level)), F.col("n"))
        # the largest first: they then meet their like, and what is left is small
        entry = F.struct(
            (-F.col("size")).alias("order"), F.col("doc_id").alias("tie"), F.col("p"),
            F.greatest(F.col("size"), F.lit(1)).cast("double").alias("mass"),
            _uniform(F.col("source"), F.col("doc_id"), F.col("size"), F.lit(seed + 101 * (level + 1))).alias("u"),
            F.struct(*[F.col(c) for c in fields]).alias("item"),
        )
        blocks = sized.groupBy("source", "bare", "n", block.alias("block")).agg(F.array_sort(F.collect_list(entry)).alias("e"))
        folded = blocks.withColumn("f", _round_block(F.col("e"))).withColumn(
            "done", F.when(F.col("n") == 1, _balance(F.col("e"), F.col("f"))).otherwise(F.col("f.done")))
        item = lambda i: F.element_at(F.col("e"), i + 1)["item"]
        done = F.transform("done", lambda d: F.struct(
            item(d["at"]).alias("item"), d["up"].alias("up"), F.lit(None).cast("double").alias("p")))
        rest = F.filter(F.array(F.struct(
            F.when(F.col("n") > 1, item(F.col("f.i"))).alias("item"), F.lit(None).cast("int").alias("up"), F.col("f.p").alias("p"),
        )), lambda r: r["item"].isNotNull())
        out = stage(folded.select(F.explode(F.concat(done, rest)).alias("r")).select("r.item.*", "r.up", "r.p"), "mix-level")
        settled = settled.unionByName(out.where("up is not null").drop("p"))
        tree = out.where("up is null").drop("up").withColumn("bare", F.col("size") == 0)
        counts = counts.where("n > 1").withColumn("n", F.ceil(F.col("n") / BLOCK))
        most = -(-most // BLOCK) if most > 1 else 0
        level += 1
    return settled


def copies(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
    weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, cap: float = CAP, seed: int = 42,
) -> DataFrame:
    """One row per distinct (source, doc_id, size): how often the mix takes
    the document. Columns source, doc_id, size, source_size, target, ``m``
    (rows that share the three), ``low`` (copies that each of them gets) and
    ``extra`` (how many of them get one more).

    Null and empty texts have size 0. A null source is a source of its own,
    a null id an id like any other. Repeated rows count each. A source
    without words has target 0. An empty table gives no rows. The same input
    gives the same result whatever its partitioning.
    """
    slim = docs.select(
        F.col(f"`{source_col}`").alias("source"), F.col(f"`{id_col}`").alias("doc_id"),
        word_count(F.col(f"`{text_col}`")).alias("size"),
    )
    items = stage(slim.groupBy("source", "doc_id", "size").agg(F.count(F.lit(1)).alias("m")), "mix-items")
    targets = stage(source_targets(items, weights, share, cap), "mix-targets")
    rate = F.coalesce(F.try_divide(F.col("target"), F.col("source_size")), F.lit(0.0))
    rated = attach(items, targets, ["source"]).withColumn("rate", rate).withColumn("low", F.floor("rate"))
    # of rows alike, the whole part of their shares is taken for certain
    parts = (F.col("rate") - F.col("low")) * F.col("m")
    rated = rated.withColumn("sure", F.floor(parts)).withColumn("p", parts - F.col("sure")).drop("rate")
    sure = rated.where("p = 0").withColumn("up", F.lit(0)).drop("p")
    rounded = _round(rated.where("p > 0"), seed)
    return sure.unionByName(rounded).select(
        "source", "doc_id", "size", "source_size", "target", "m", "low", (F.col("sure") + F.col("up")).alias("extra")
    )


def taken(decided: DataFrame) -> DataFrame:
    """One row per document row from the rows of ``copies``: doc_id, size,
    source_size, target, source and ``taken`` (its words in the mix)."""
    kinds = F.array(
        F.struct((F.col("low") + 1).alias("copies"), F.col("extra").alias("n")),
        F.struct(F.col("low").alias("copies"), (F.col("m") - F.col("extra")).alias("n")),
    )
    rows = expand(decided.withColumn("k", F.explode(kinds)).select("*", "k.copies", "k.n"), "n")
    return rows.select(
        "doc_id", F.col("size").cast("bigint").alias("size"), F.col("source_size").cast("bigint").alias("source_size"), "target",
        (F.col("size") * F.col("copies")).cast("bigint").alias("taken"), "source",
    )


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **how) -> DataFrame:
    """The mixed documents: the rows of ``docs`` as often as the mix takes
    them, with all their columns and no others."""
    keys = ["source", "doc_id", "size"]
    decided = stage(copies(docs, id_col, text_col, source_col, **how), "mix-copies")
    size = word_count(F.col(f"`{text_col}`"))
    mine = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), F.col(f"`{source_col}`").alias("source"),
        F.col(f"`{id_col}`").alias("doc_id"), size.alias("size"),
    )
    plan = decided.where("low > 0 or extra > 0").select(*keys, "m", "low", "extra")
    single = attach(mine, plan.where("m = 1"), keys).withColumn("n", F.col("low") + F.col("extra"))
    numbered = number_rows(attach(mine, plan.where("m > 1"), keys), keys, "place")
    shared = numbered.withColumn("n", F.col("low") + (F.col("place") <= F.col("extra")).cast("bigint"))
    parts = [expand(d.select("doc", "n"), "n").select("doc.*") for d in (single, shared)]
    return parts[0].unionByName(parts[1])
