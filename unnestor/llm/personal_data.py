"""Personal data by bootstrapped contextual extraction, in DataFrame functions.

Fixed expressions find the seed entities of four kinds. Their surroundings
induce lexical patterns: the words before, the words after, both, and the shape
of the entity itself. Patterns and values (entities without their writing) form
a bipartite graph over all documents, which Spark scores in rounds: a pattern of
a kind is worth the share of that kind among the values it brings, those that
are still unknown but could be of the kind weighing little, and a value what its
best pattern is worth. Values that score at least ``ACCEPT`` are entities of
the kind too, teach patterns in the next round (half as much as seeds, so that
one finding alone doesn't lead to the next), and their places are added to the
spans.

Nothing here runs in Python: places come from the gaps that a split leaves
between matches, added up per document row and kind.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import attach, stage_at, unstage

KINDS = ("email", "ip", "card", "phone")
ROUNDS = 3
ACCEPT = 0.85  # least score of a value that becomes an entity
PRIOR = 1.0  # values of no kind that every pattern starts with
UNKNOWN = 0.25  # weight against a pattern of a value that may yet be of its kind
TEACH = 0.5  # weight for a pattern of a value that was found, not a seed
AROUND = 64  # code points kept on either side of a match for its context

# Fixed expressions of the seed entities. They find what the plain forms find,
# in time that grows with the text alone: a run is entered at its beginning or
# at the end of the match before (\G), and never given back.
_MAIL = "[A-Za-z0-9._%+-]"
SEEDS = {
    "email": rf"(?:\G|(?<!{_MAIL})){_MAIL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# Other writings that only a pattern can make an entity: runs of digits with
# single signs between them (no letter beside them), a bracketed area code, and
# spelt-out addresses.
OTHERS = (
    r"\([0-9]{2,4}\)\x20?[0-9]{2,4}[\x20.-][0-9]{3,4}|(?<![0-9A-Za-z])[0-9]++(?:[./_-][0-9]++)*+(?![A-Za-z])"
    rf"|(?:\G|(?<!{_MAIL})){_MAIL}++\x20?(?:\(at\)|\[at\])\x20?[A-Za-z0-9-]++(?:\x20?(?:\(dot\)|\[dot\]|\.)\x20?[A-Za-z0-9-]++)++"
)
LEAST_DIGITS = 7  # of another writing


def _luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    def term(c: Column, i: Column) -> Column:
        d = c.cast("int")
        return F.when(i % 2 == 0, d).otherwise(F.when(d > 4, 2 * d - 9).otherwise(2 * d))

    each = F.transform(F.split(F.reverse(digits), ""), term)
    return F.aggregate(each, F.lit(0), lambda s, x: s + x) % 10 == 0


def _octets(text: Column) -> Column:
    """Whether a text is four numbers of at most 255 between dots."""
    part = "0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]{1,2})"
    return F.rlike(text, F.lit(rf"^{part}(?:\.{part}){{3}}$"))


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _valid(kind: Column, text: Column, digits: Column, least_phone: int) -> Column:
    """Whether a match of a kind passes its check."""
    n = F.length(digits)
    return (
        F.when(kind == "email", True)
        .when(kind == "ip", _octets(text))
        .when(kind == "card", F.when(n.between(13, 19), _luhn(digits)).otherwise(False))
        .otherwise(n.between(least_phone, 15))
    )


def _matches(text: Column, kind: str, expression: str, may: Column) -> Column:
    """Array of (kind, i, skip, before, said, after): matches in their order,
    the code points between a match and the one before it, and what is beside
    it. ``may`` is a cheap test without which there is no match."""
    said = F.when(may, F.regexp_extract_all(text, F.lit(expression), F.lit(0)))
    gaps = F.split(text, expression, -1)
    one = F.transform(said, lambda m, i: F.struct(
        F.lit(kind).alias("kind"), i.alias("i"), m.alias("said")))
    beside = F.transform(gaps, lambda g: F.struct(
        F.length(g).alias("skip"), F.right(g, F.lit(AROUND)).alias("before"), F.left(g, F.lit(AROUND)).alias("after")))
    return F.when(F.size(said) > 0, F.zip_with(one, beside, lambda m, g: F.struct(
        F.coalesce(m["kind"], F.lit(kind)).alias("kind"), m["i"].alias("i"), g["skip"].alias("skip"), g["before"].alias("before"),
        m["said"].alias("said"), g["after"].alias("after"))))


def mentions(docs: DataFrame) -> tuple[DataFrame, DataFrame, list[str]]:
    """The document rows (row, doc_id), the matches (row, kind, start, end,
    said, left, right) of all expressions, kind "" being another writing, and
    the staged folders. Starts are code points, ends exclusive."""
    text = F.coalesce(F.col("text"), F.lit(""))
    has_digit = F.rlike(F.col("text"), F.lit("[0-9]"))
    may = {
        "email": F.contains("text", F.lit("@")), "ip": has_digit, "card": has_digit, "phone": F.contains("text", F.lit("+")),
        "": has_digit | F.rlike(F.col("text"), F.lit(r"[\[(]at[\])]")),
    }
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("bigint").alias("doc_id"), text.alias("text"))
    found = [_matches(F.col("text"), k, e, may[k]) for k, e in (*SEEDS.items(), ("", OTHERS))]
    all_of = F.concat(*[F.coalesce(c, F.array().cast("array<struct<kind:string,i:int,skip:int,before:string,said:string,after:string>>")) for c in found])
    rows, rows_at = stage_at(rows.select("row", "doc_id", all_of.alias("found")), "matches")
    each = rows.select("row", F.explode("found").alias("m")).select("row", "m.*")
    # gaps and matches take turns; the gap after the last match has no match and is the last row of its kind
    by_kind = Window.partitionBy("row", "kind").orderBy(F.asc_nulls_last("i"))
    so_far = by_kind.rowsBetween(Window.unboundedPreceding, 0)
    length = F.coalesce(F.length("said"), F.lit(0)).cast("bigint")
    end = F.sum(F.col("skip").cast("bigint") + length).over(so_far)
    placed = each.select(
        "row", "kind", "i", (end - length).alias("start"), end.alias("end"), "said", "before", F.lead("after").over(by_kind).alias("after"))
    before = F.slice(F.split(F.lower(F.trim("before")), r"\s+"), -2, 2)
    after = F.element_at(F.split(F.lower(F.trim("after")), r"\s+"), 1)
    placed = placed.where("i is not null").select(
        "row", "kind", "start", "end", "said",
        F.when(F.rlike("before", F.lit(r"\S")), F.array_join(before, " ")).otherwise("").alias("left"), F.coalesce(after, F.lit("")).alias("right"))
    placed, placed_at = stage_at(placed, "mentions")
    return rows.select("row", "doc_id"), placed, [rows_at, placed_at]


def _others(placed: DataFrame, seeds: DataFrame) -> DataFrame:
    """Other writings that lie on no seed, with the kinds that they could be."""
    both = seeds.select("row", "start", "end", F.lit(True).alias("seed"), F.lit("").alias("said"), F.lit("").alias("left"), F.lit("").alias("right")).unionByName(
        placed.where("kind = ''").select("row", "start", "end", F.lit(False).alias("seed"), "said", "left", "right"))
    row = Window.partitionBy("row")
    ended = F.max(F.when(F.col("seed"), F.col("end"))).over(row.orderBy("start").rangeBetween(Window.unboundedPreceding, 0))
    begins = F.min(F.when(F.col("seed"), F.col("start"))).over(row.orderBy(F.desc("start")).rangeBetween(Window.unboundedPreceding, 0))
    free = both.withColumn("ended", ended).withColumn("begins", begins).where(
        "not seed and coalesce(ended, 0) <= start and coalesce(begins, end) >= end")
    digits = _digits(F.col("said"))
    n = F.length(digits)
    spelt = F.rlike("said", F.lit(r"[\[(]at[\])]"))
    kinds = F.array_compact(F.array(
        F.when(spelt, F.lit("email")),
        F.when(~spelt & _octets(F.col("said")), F.lit("ip")),
        F.when(~spelt & F.when(n.between(13, 19), _luhn(digits)).otherwise(False), F.lit("card")),
        F.when(~spelt & n.between(LEAST_DIGITS, 15), F.lit("phone")),
    ))
    return free.select("row", "start", "end", "said", "left", "right", kinds.alias("kinds")).where(spelt | (n >= LEAST_DIGITS))


def _value(said: Column) -> Column:
    """An entity without its writing: the digits, or the address."""
    plain = F.regexp_replace(F.regexp_replace(F.regexp_replace(F.lower(said), r"\x20?[\[(]at[\])]\x20?", "@"), r"\x20?[\[(]dot[\])]\x20?", "."), " ", "")
    return F.when(F.contains(plain, F.lit("@")), plain).otherwise(_digits(said))


def _patterns() -> Column:
    """The lexical patterns of a mention."""
    last = F.element_at(F.split("left", " "), -1)
    shape = F.regexp_replace(F.regexp_replace("said", "[0-9]", "9"), "[A-Za-z]+", "a")
    return F.array(
        F.concat(F.lit("before:"), last), F.concat(F.lit("two before:"), F.col("left")), F.concat(F.lit("after:"), F.col("right")),
        F.concat(F.lit("between:"), last, F.lit(" _ "), F.col("right")), F.concat(F.lit("shape:"), shape))


def bootstrap(seeds: DataFrame, others: DataFrame, rounds: int = ROUNDS, accept: float = ACCEPT) -> tuple[DataFrame, list[str]]:
    """(value, kind, score) of the values of ``others`` that became entities,
    and the staged folders. ``seeds`` has kind, ``others`` the kinds it could be."""
    spark = seeds.sparkSession
    known = seeds.select(F.array("kind").alias("kinds"), F.lit(True).alias("seed"), "said", "left", "right")
    both = known.unionByName(others.select("kinds", F.lit(False).alias("seed"), "said", "left", "right"))
    edge = both.select(_value(F.col("said")).alias("value"), "kinds", "seed", F.explode(_patterns()).alias("pattern"))
    # a value counts once for a pattern, so copies of a document teach nothing
    edges, edges_at = stage_at(edge.groupBy("pattern", "value").agg(F.max("seed").alias("seed")), "graph")
    could, could_at = stage_at(
        both.select(_value(F.col("said")).alias("value"), "seed", F.explode("kinds").alias("kind"))
        .groupBy("value", "kind").agg(F.max("seed").alias("seed")), "values")
    sizes, sizes_at = stage_at(edges.groupBy("pattern").agg(F.count(F.lit(1)).alias("n")), "patterns")
    state, state_at = stage_at(could.select("value", "kind", "seed", F.when(F.col("seed"), 1.0).alias("score")), "scores")
    for _ in range(rounds):
        held = edges.select("pattern", "value").join(state.hint("merge"), "value").groupBy("pattern", "kind").agg(
            F.coalesce(F.sum(F.col("score") * F.when(F.col("seed"), 1.0).otherwise(TEACH)), F.lit(0.0)).alias("held"), F.count_if(F.col("score").isNull()).alias("open"))
        against = F.col("n") - F.col("held") - (1 - UNKNOWN) * F.col("open") + PRIOR
        worth = held.join(sizes.hint("merge"), "pattern").select("pattern", "kind", (F.col("held") / (F.col("held") + against)).alias("worth"))
        worth, worth_at = stage_at(worth.where(F.col("worth") >= accept), "worth")
        best = edges.select("pattern", "value").join(worth.hint("merge"), "pattern").groupBy("value", "kind").agg(F.max("worth").alias("best"))
        after, after_at = stage_at(could.join(best.hint("merge"), ["value", "kind"], "left").select(
            "value", "kind", "seed", F.when(F.col("seed"), 1.0).otherwise(F.col("best")).alias("score")), "scores")
        unstage(spark, worth_at)
        unstage(spark, state_at)
        state, state_at = after, after_at
    return state.where("score is not null").select("value", "kind", "score"), [edges_at, could_at, sizes_at, state_at]


def personal_data(docs: DataFrame, rounds: int = ROUNDS, accept: float = ACCEPT) -> DataFrame:
    """One row per document row: doc_id, n_email, n_ip, n_card, n_phone (base
    spans), base_sha256 and spans, the latter of all spans: base ones and those
    that the bootstrapping added.

    A span is kind:start:end in code points, end exclusive; spans are in the
    order of email, ip, card, phone, then start, and comma-joined. An added
    span lies on no base span and passes the check of its kind (7 to 15 digits
    for a phone); one that could be of several kinds is of the best
    scored, ties to the first in that order.

    Null texts are empty; empty texts have no spans and the hash of the empty
    string. Rows that repeat, or share an id, null among them, each give a
    row; a value counts once for a pattern however often it is repeated.
    Other columns are ignored. Long texts are searched whole, in time that
    grows with their length. An empty table gives no rows.
    """
    spark = docs.sparkSession
    rows, placed, paths = mentions(docs)
    good = _valid(F.col("kind"), F.col("said"), _digits(F.col("said")), 9)
    seeds, seeds_at = stage_at(placed.where(F.col("kind") != "").where(good), "seeds")
    others, others_at = stage_at(_others(placed, seeds), "others")
    scores, more = bootstrap(seeds, others, rounds, accept)
    order = F.array_position(F.lit(list(KINDS)), F.col("kind")).cast("int")
    could = others.select("row", "start", "end", _value(F.col("said")).alias("value"), F.explode("kinds").alias("kind"))
    taken = could.join(scores.hint("merge"), ["value", "kind"])
    added = taken.groupBy("row", "start", "end").agg(F.max_by("kind", F.struct("score", -order)).alias("kind"))
    spans = seeds.select("row", "kind", "start", "end", F.lit(True).alias("base")).unionByName(
        added.select("row", "kind", "start", "end", F.lit(False).alias("base")))
    one = F.struct(order.alias("o"), "start", "end", "kind", "base")
    said = spans.groupBy("row").agg(
        F.array_sort(F.collect_list(one)).alias("s"), *[F.count_if((F.col("kind") == k) & F.col("base")).alias(f"n_{k}") for k in KINDS])

    def joined(which: Column) -> Column:
        return F.array_join(F.transform(which, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")

    said = said.select("row", *[f"n_{k}" for k in KINDS], joined(F.filter("s", lambda x: x["base"])).alias("base"), joined(F.col("s")).alias("spans"))
    said, said_at = stage_at(said, "spans")
    out = attach(rows, said, ["row"], "left").select(
        "doc_id", *[F.coalesce(f"n_{k}", F.lit(0)).cast("bigint").alias(f"n_{k}") for k in KINDS],
        F.sha2(F.coalesce("base", F.lit("")).cast("binary"), 256).alias("base_sha256"), F.coalesce("spans", F.lit("")).alias("spans"))
    result, _ = stage_at(out, "personal-data")
    for path in (*paths, seeds_at, others_at, *more, said_at):
        unstage(spark, path)
    return result
