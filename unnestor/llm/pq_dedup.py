"""Embedding near-duplicates by product quantisation.

A coarse codebook deals unit vectors to inverted lists; a vector's residual to
its list's centre is coded by the nearest of ``CODES`` centres in each subspace.
Every vector searches the lists that can hold a vector within the threshold:
the half-space that bounds another list's cell must come within the radius.
In a list, squared distances are sums from a table of the query's distances to
the code centres; a member whose table distance exceeds the radius by more
than its own quantisation error is out of reach. What remains is compared by
exact cosine. So the probes are sufficient and no link is lost. Equal vectors
of a label are searched once.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import attach, partitions, stage, stage_at, unstage
from .components import Groups, connected_components

THRESHOLD = 0.98
SUBSPACES = 8
CODES = 64
LIST = 512  # vectors of an inverted list, on average
MAX_LISTS = 8192
SAMPLE = 20_000  # vectors the codebooks are trained on at least, or 16 a list, if there are as many
ROUNDS = 8
BLOCK = 2048  # members, and queries, that meet in one group, on average
SLACK = 1e-6  # for rounding in the bounds


@dataclass
class Codebooks:
    centres: np.ndarray  # lists x dimensions
    subspaces: list[np.ndarray]  # of each subspace: codes x its dimensions
    cuts: list[int]  # where the subspaces begin and end

    @property
    def width(self) -> int:
        return self.centres.shape[1]

    def encode(self, x: np.ndarray, lists: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Codes of the residuals of ``x`` and their quantisation errors."""
        rest = x - self.centres[lists]
        codes = np.zeros((len(x), len(self.subspaces)), np.uint8)
        error = np.zeros(len(x))
        for s, book in enumerate(self.subspaces):
            d = _squared(rest[:, self.cuts[s] : self.cuts[s + 1]], book)
            codes[:, s] = d.argmin(axis=1)
            error += np.maximum(d.min(axis=1), 0)
        return codes, np.sqrt(error)


def _squared(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return (x * x).sum(axis=1)[:, None] - 2 * (x @ y.T) + (y * y).sum(axis=1)[None, :]


def _centres(x: np.ndarray, k: int, rng: np.random.Generator) -> np.ndarray:
    """k-means centres of ``x``."""
    centres = x[rng.choice(len(x), size=min(k, len(x)), replace=False)].copy()
    for _ in range(ROUNDS):
        own = np.concatenate([_squared(x[i : i + 8192], centres).argmin(axis=1) for i in range(0, len(x), 8192)])
        sums = np.zeros_like(centres)
        np.add.at(sums, own, x)
        n = np.bincount(own, minlength=len(centres))
        centres[n > 0] = sums[n > 0] / n[n > 0, None]
    return centres


def train(x: np.ndarray, lists: int) -> Codebooks:
    """Codebooks of the rows of ``x``, the same for the same rows."""
    rng = np.random.default_rng(42)
    centres = _centres(x, lists, rng)
    own = np.concatenate([_squared(x[i : i + 8192], centres).argmin(axis=1) for i in range(0, len(x), 8192)])
    rest = x - centres[own]
    cuts = np.linspace(0, x.shape[1], min(SUBSPACES, x.shape[1]) + 1).astype(int).tolist()
    return Codebooks(centres, [_centres(rest[:, a:b], CODES, rng) for a, b in zip(cuts, cuts[1:])], cuts)


def unit_rows(vectors: list, width: int) -> np.ndarray:
    """Vectors as rows of length 1 in double precision, padded with zeros."""
    out = np.zeros((len(vectors), width))
    for i, v in enumerate(vectors):
        out[i, : len(v)] = v
    # the largest component first, so that squares neither overflow nor vanish
    out /= np.abs(out).max(axis=1, initial=0.0)[:, None]
    return out / np.sqrt((out * out).sum(axis=1))[:, None]


def _placed(vector: Column, books: Codebooks, radius: float) -> Column:
    """A vector's list, the lists it probes (its own included), codes and error."""
    between = np.sqrt(np.maximum(_squared(books.centres, books.centres), 0))

    @F.arrow_udf("struct<list: int, probes: array<int>, codes: binary, error: double>")
    def place(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for vectors in batches:
            out = []
            rows = vectors.to_pylist()
            for i in range(0, len(rows), 2048):
                x = unit_rows(rows[i : i + 2048], books.width)
                d = _squared(x, books.centres)
                own = d.argmin(axis=1)
                codes, error = books.encode(x, own)
                reach = d - d[np.arange(len(x)), own][:, None] <= 2 * (radius + SLACK) * between[own] + SLACK
                for j in range(len(x)):
                    out.append({"list": int(own[j]), "probes": np.flatnonzero(reach[j]).tolist(), "codes": codes[j].tobytes(), "error": float(error[j])})
            kind = pa.struct([("list", pa.int32()), ("probes", pa.list_(pa.int32())), ("codes", pa.binary()), ("error", pa.float64())])
            yield pa.array(out, kind)

    return place(vector)


def _compare(part: pd.DataFrame, books: Codebooks, threshold: float, radius: float) -> pd.DataFrame:
    """A group's queries against its members: how many vectors each query links
    to, and for each vector the smallest of those that links join it to here."""
    member = part["member"].to_numpy(bool)
    ids = part["cid"].to_numpy(np.int64)
    x = unit_rows(part["vector"].tolist(), books.width)
    dims = np.array([len(v) for v in part["vector"]])
    q, m = np.flatnonzero(~member), np.flatnonzero(member)
    if not len(q) or not len(m):
        return pd.DataFrame({"cid": [], "links": [], "root": []})
    codes = np.array([np.frombuffer(c, np.uint8) for c in part["codes"].iloc[m]])
    reach = (radius + part["error"].to_numpy(float)[m] + SLACK) ** 2
    n = part["n"].to_numpy(np.int64)
    rest = x[q] - books.centres[int(part["list"].iloc[0])]
    links = np.zeros(len(q), np.int64)
    order = np.unique(ids)
    at = np.searchsorted(order, ids)
    groups = Groups(len(order))
    for a in range(0, len(q), 512):
        b = min(a + 512, len(q))
        far = np.zeros((b - a, len(m)))
        for s, book in enumerate(books.subspaces):
            far += _squared(rest[a:b, books.cuts[s] : books.cuts[s + 1]], book)[:, codes[:, s]]
        i, j = np.nonzero(far <= reach[None, :])
        for c in range(0, len(i), 1 << 17):
            u, v = q[i[c : c + (1 << 17)] + a], m[j[c : c + (1 << 17)]]
            near = (np.einsum("ij,ij->i", x[u], x[v]) >= threshold) & (ids[u] != ids[v]) & (dims[u] == dims[v])
            np.add.at(links, i[c : c + (1 << 17)][near] + a, n[v[near]])
            groups.link(at[u[near]], at[v[near]])
    total = np.zeros(len(order), np.int64)
    np.add.at(total, at[q], links)
    told = (total > 0) | (groups.root != np.arange(len(order)))
    return pd.DataFrame({"cid": order[told], "links": total[told], "root": order[groups.root[told]]})


def near_duplicates(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
    threshold: float = THRESHOLD, lists: int | None = None,
) -> DataFrame:
    """One row per vector: vec_id, n_links (other vectors of its label with a
    cosine of at least ``threshold``), component_id (the smallest id that links
    reach, its own included) and kept (is it that one?).

    Vectors that are null, empty or zero, hold null or non-finite components
    or have a null label have no links; vectors of different lengths don't
    link. Repeated rows are vectors like others. Null ids don't count as
    smallest; a component of null ids alone has the id null. ``threshold``
    must be over 0. An empty table gives no rows.
    """
    spark = vectors.sparkSession
    v = F.col("vector")
    finite = F.forall(v, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < F.lit(float("inf"))))
    usable = F.coalesce(v.isNotNull() & F.col("label").isNotNull() & finite & F.exists(v, lambda e: e != 0), F.lit(False))
    slim = vectors.select(
        F.col(f"`{id_col}`").alias("vec_id"), F.col(f"`{label_col}`").alias("label"), F.col(f"`{vector_col}`").cast("array<double>").alias("vector"))
    # two hashes name a vector
    rows = stage(slim.withColumn("usable", usable).withColumn("h1", F.xxhash64("vector")).withColumn(
        "h2", F.xxhash64(F.lit(1), F.col("vector"))), "vectors")
    key = ["label", "h1", "h2"]
    distinct = rows.where("usable").groupBy(*key).agg(
        F.first("vector").alias("vector"), F.count(F.lit(1)).alias("n"), F.min("vec_id").alias("least"))
    classes = stage(distinct.withColumn("cid", F.monotonically_increasing_id()), "vector-classes")
    alone = rows.where("not usable").select("vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id"))
    kept = F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False))
    count, width = classes.agg(F.count(F.lit(1)), F.max(F.size("vector"))).first()
    if not count:
        return alone.withColumn("kept", kept)
    lists = lists or max(1, min(MAX_LISTS, count // LIST))
    sample = classes.orderBy(F.xxhash64("h1"), "h2", "label").limit(max(SAMPLE, 16 * lists)).select("vector")
    books = train(unit_rows([r["vector"] for r in sample.toLocalIterator()], width), lists)
    radius = float(np.sqrt(max(0.0, 2 - 2 * threshold)))
    placed = stage(
        classes.withColumn("p", _placed(F.col("vector"), books, radius)).select("cid", "label", "n", "vector", "p.*"), "vectors-placed")
    members = placed.select("label", "list", "cid", "n", "vector", "codes", "error")
    queries = placed.select("label", F.explode("probes").alias("list"), "cid", "vector")
    size = lambda df, name: df.groupBy("label", "list").agg(F.ceil(F.count(F.lit(1)) / BLOCK).alias(name))
    cells = stage(size(members, "blocks").join(size(queries, "chunks").hint("merge"), ["label", "list"]), "vector-cells")
    cell = ["label", "list"]
    spread = lambda n: F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(n) - 1))
    mine = lambda n: F.pmod(F.xxhash64("cid"), F.col(n))
    there = attach(members, cells, cell).select(
        *cell, mine("blocks").alias("block"), spread("chunks").alias("chunk"), F.lit(True).alias("member"), "cid", "n", "vector", "codes", "error")
    asked = attach(queries, cells, cell).select(
        *cell, spread("blocks").alias("block"), mine("chunks").alias("chunk"), F.lit(False).alias("member"), "cid",
        F.lit(0).cast("bigint").alias("n"), "vector", F.lit(None).cast("binary").alias("codes"), F.lit(None).cast("double").alias("error"))
    group = [*cell, "block", "chunk"]

    def compare(part: pd.DataFrame) -> pd.DataFrame:
        return _compare(part, books, threshold, radius)

    met = there.unionByName(asked).repartition(partitions(spark), *group).groupBy(*group).applyInPandas(
        compare, "cid bigint, links bigint, root bigint")
    found, found_at = stage_at(met, "vector-links")
    joined = connected_components(found.select(F.col("cid").alias("a"), F.col("root").alias("b")))
    links = found.groupBy("cid").agg(F.sum("links").alias("links"))
    roots = stage(
        classes.select("cid", *key, "n", "least")
        .join(links.hint("merge"), "cid", "left").join(joined.withColumnRenamed("node", "cid").hint("merge"), "cid", "left")
        .select(*key, "least", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), F.coalesce("component", "cid").alias("root")),
        "vector-roots",
    )
    unstage(spark, found_at)
    least = roots.groupBy("root").agg(F.min("least").alias("component_id"))
    named = stage(roots.join(least.hint("merge"), "root").select(*key, "n_links", "component_id"), "vector-components")
    linked = attach(rows.where("usable"), named, key).select("vec_id", "n_links", "component_id")
    return linked.unionByName(alone).withColumn("kept", kept)
