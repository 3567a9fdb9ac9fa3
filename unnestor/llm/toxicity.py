"""Toxicity: a cumulative-link (proportional odds) ordinal regression of
severity grades on sparse text features.

P(grade > k) = sigmoid(w.x - t_k): one weight vector, ordered thresholds t_k.
x says how often words, and word beginnings of 4, 5 and 6 bytes, occur in the
text, on two scales: 1 from one word in 600 on, so that a long text isn't
marked by chance, and 1 from one word in 50 on, for what clean texts hold at
times. An L1 penalty leaves few weights, so scoring a text is a set
intersection. The labels are binary; a toxic text's grade is the third it
falls in by how many distinct marked features it holds.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from math import log

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stage_at, unstage

SAMPLE = 3000  # labelled rows of each class that the fit uses at most, by hash of the id
FEATURES = 3000  # features it uses at most
TELLING = 4  # they are as many times as frequent in toxic rows at least
CERTAIN = 15  # chi-squared statistic they have at least: hundreds of thousands are tried
MIN_ROWS = 3  # sample rows a feature occurs in at least
STARTS = (4, 5, 6)
GRADES = 4
PENALTY = 5e-4
STEPS = 400
SCALES = (600, 50)
WINDOW = 200  # words that are scored together; this and the allowance were chosen on held-out labels
ALLOWANCE = 0.2
LIMIT = 0.15  # a text that holds marked features is rejected if P(grade > 0) is at least this

# everything but ASCII letters and digits and bytes over 127 separates words
_SEPARATORS = bytes(b if chr(b).isalnum() and b < 128 or b > 127 else 32 for b in range(256))


def sequence(text: str | None) -> list[bytes]:
    """The words of a text in their order, lower case, as UTF-8."""
    return (text or "").lower().encode("utf-8", "surrogatepass").translate(_SEPARATORS).split()


def words(text: str | None) -> Counter:
    """The words of a text with their counts."""
    return Counter(sequence(text))


def occurrences(own: Counter, start: int, names) -> Counter:
    """Counts of those of ``names`` that words begin with (``start`` 0: that are words)."""
    if not start:
        return Counter({w: own[w] for w in names & own.keys()})
    held = names & {w[:start] for w in own}
    found: Counter = Counter()
    if held:
        for w, n in own.items():
            if w[:start] in held:
                found[w[:start]] += n
    return found


def features(text: str | None, names: dict[int, set[bytes]] | None = None) -> dict[bytes, float]:
    """Features of a text and their shares of its words, all or those named by
    kind: words and beginnings of words, marked by their length."""
    own = words(text)
    total = max(1, own.total())
    found = {}
    for n in (0, *STARTS):
        for w, k in occurrences(own, n, own.keys() | {w[:n] for w in own} if names is None else names.get(n, set())).items():
            found[(b"%d" % n if n else b"w") + w] = k / total
    return found


def scaled(share: float) -> tuple[float, ...]:
    return tuple(min(1.0, share * s) for s in SCALES)


def by_kind(names) -> dict[int, set[bytes]]:
    """Feature names by the bytes of the beginning they mean, 0 for whole words."""
    kinds: dict[int, set[bytes]] = {}
    for f in names:
        kinds.setdefault(0 if f[:1] == b"w" else int(f[:1]), set()).add(f[1:])
    return kinds


@dataclass
class Model:
    """Weights by feature, one per scale, and the ascending thresholds of the grades."""

    weights: dict[bytes, tuple[float, ...]] = field(default_factory=dict)
    thresholds: list[float] = field(default_factory=lambda: [50.0] * (GRADES - 1))


def worst_window(text: str | None, weights: dict[bytes, tuple[float, ...]], kinds: dict[int, set[bytes]]) -> float:
    """The greatest score of a text's windows, less the allowance for their number."""
    own = sequence(text)
    marks: dict[bytes, list[bytes]] = {}
    for w in set(own):
        held = [b"w" + w] if w in kinds.get(0, ()) else []
        held += [b"%d" % n + w[:n] for n in STARTS if w[:n] in kinds.get(n, ())]
        if held:
            marks[w] = held
    at = [i for i, w in enumerate(own) if w in marks]
    half = WINDOW // 2
    starts = range(0, max(1, len(own) - half), half)
    best = None
    for a in starts if at else ():
        lo, hi = bisect_left(at, a), bisect_left(at, a + WINDOW)
        found = Counter(f for i in at[lo:hi] for f in marks[own[i]])
        total = min(WINDOW, len(own) - a)
        score = sum(w * x for f, k in found.items() for w, x in zip(weights[f], scaled(k / total)))
        best = score if best is None else max(best, score)
    return (best or 0.0) - ALLOWANCE * log(len(starts))


def _scores(text: Column, model: Model) -> Column:
    weights, kinds = model.weights, by_kind(model.weights)

    @F.arrow_udf("double")
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            yield pa.array([float(worst_window(t.as_py(), weights, kinds)) for t in texts], pa.float64())

    return score(text)


def _feature_names(text: Column) -> Column:
    """The frequent features of a text, as latin-1."""

    @F.arrow_udf("array<string>")
    def names(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            out = [[f.decode("latin-1") for f, share in features(t.as_py()).items() if scaled(share)[0] >= 0.5] for t in texts]
            yield pa.array(out, pa.list_(pa.string()))

    return names(text)


def _feature_values(text: Column, ids: dict[bytes, int]) -> Column:
    """Numbers and shares of the features that ``ids`` names."""
    kinds = by_kind(ids)
    kind = pa.list_(pa.struct([("i", pa.int32()), ("x", pa.float64())]))

    @F.arrow_udf("array<struct<i: int, x: double>>")
    def values(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            found = (features(t.as_py(), kinds) for t in texts)
            yield pa.array([[{"i": ids[f], "x": x} for f, x in sorted(fs.items())] for fs in found], kind)

    return values(text)


def fit_ordinal(rows: np.ndarray, cols: np.ndarray, x: np.ndarray, grades: np.ndarray, n_features: int, n_grades: int) -> tuple[np.ndarray, np.ndarray]:
    """Weights and thresholds by accelerated proximal gradient steps on the
    summed likelihoods of the thresholds, which is convex and keeps them in
    order; ``x`` are the values of a sparse matrix at ``rows`` and ``cols``."""
    n = len(grades)
    over = (grades[:, None] > np.arange(n_grades - 1)).astype(float)
    share = np.clip(over.mean(axis=0), 1e-4, 1 - 1e-4)
    cut = np.log(1 / share - 1)
    w = np.zeros(n_features)
    step = 4.0 / (n_grades - 1) / max(1.0, np.bincount(rows, minlength=n).mean())
    z, z_cut, t = w, cut, 1.0
    for _ in range(STEPS):
        s = np.bincount(rows, weights=z[cols] * x, minlength=n)
        off = (1 / (1 + np.exp(np.clip(z_cut - s[:, None], -40, 40))) - over) / n
        new = z - step * np.bincount(cols, weights=off.sum(axis=1)[rows] * x, minlength=n_features)
        new = np.sign(new) * np.maximum(np.abs(new) - step * PENALTY, 0)
        new_cut = z_cut + off.sum(axis=0)
        if ((z - new) * (new - w)).sum() + ((z_cut - new_cut) * (new_cut - cut)).sum() > 0:
            t = 1.0  # the momentum points uphill
        t_next = (1 + np.sqrt(1 + 4 * t * t)) / 2
        z, z_cut = new + (t - 1) / t_next * (new - w), new_cut + (t - 1) / t_next * (new_cut - cut)
        w, cut, t = new, new_cut, t_next
    return w, np.maximum.accumulate(cut)


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", sample: int = SAMPLE) -> Model:
    """Fit on at most ``sample`` labelled rows of each class, chosen by hash of
    the id; of rows that share an id, the text of the least hash counts once,
    and it is toxic if any of its labels says so.
    Labels that are null or of documents that aren't there don't count; without both classes the model rejects nothing."""
    spark = docs.sparkSession
    known = labels.select(F.col(f"`{id_col}`").alias("doc_id"), (F.col(f"`{label_col}`") > 0).cast("int").alias("label")).where(
        "label is not null and doc_id is not null")
    known = known.groupBy("doc_id").agg(F.max("label").alias("label"))
    pick = [known.where(f"label = {c}").orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample) for c in (1, 0)]
    chosen = pick[0].unionByName(pick[1])
    texts = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    # at most 2 * sample ids: small enough to send to every task
    held = texts.join(F.broadcast(chosen), "doc_id").groupBy("doc_id").agg(
        F.min("label").alias("label"), F.min_by("text", F.xxhash64("text")).alias("text"))
    rows, at = stage_at(held, "toxicity-sample")
    sizes = dict(rows.groupBy("label").count().collect())
    if not sizes.get(0) or not sizes.get(1):
        unstage(spark, at)
        return Model()
    n1, n0 = sizes[1], sizes[0]
    seen = rows.select("label", F.explode(_feature_names(F.col("text"))).alias("f")).groupBy("f").agg(
        F.sum("label").alias("bad"), F.count(F.lit(1)).alias("all")).where(F.col("all") >= MIN_ROWS)
    rate = F.col("all") / (n0 + n1)
    good = F.col("all") - F.col("bad")
    strength = F.pow(F.col("bad") / n1 - good / n0, F.lit(2)) / F.greatest(rate * (1 - rate), F.lit(1e-9))
    best = seen.select("f", ((F.col("bad") + 0.5) / (n1 + 1) / ((good + 0.5) / (n0 + 1))).alias("ratio"), strength.alias("s")).where(
        (F.col("ratio") >= TELLING) & (F.col("s") * (n1 * n0 / (n1 + n0)) >= CERTAIN)).orderBy(
        F.desc("s"), "f").limit(FEATURES).collect()
    names = [r["f"].encode("latin-1") for r in best]
    marked = np.array([r["ratio"] >= 20 for r in best], bool)
    held = rows.select("doc_id", "label", _feature_values(F.col("text"), {f: i for i, f in enumerate(names)}).alias("held")).orderBy(
        "doc_id", "label").collect()
    unstage(spark, at)
    counts = np.array([len(r["held"]) for r in held])
    cols = np.array([f["i"] for r in held for f in r["held"]], np.int64)
    share = np.array([f["x"] for r in held for f in r["held"]], float)
    at_row = np.repeat(np.arange(len(held)), counts)
    bad = np.array([r["label"] for r in held], bool)
    hits = np.bincount(at_row, weights=marked[cols] * 1.0, minlength=len(held)) if len(cols) else np.zeros(len(held))
    edges = np.quantile(hits[bad], [i / (GRADES - 1) for i in range(1, GRADES - 1)])
    grades = np.where(bad, 1 + (hits[:, None] > edges).sum(axis=1), 0)
    k = len(names)
    weights, thresholds = fit_ordinal(
        np.tile(at_row, len(SCALES)), np.concatenate([cols + i * k for i in range(len(SCALES))]),
        np.concatenate([np.minimum(1.0, share * s) for s in SCALES]), grades, k * len(SCALES), GRADES)
    by_name = weights.reshape(len(SCALES), k).T
    return Model({f: tuple(map(float, w)) for f, w in zip(names, by_name) if w.any()}, [float(t) for t in thresholds])


def score(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` with ``severity`` (expected grade, 0 to 3), ``p_toxic`` (chance
    of a grade over 0) and ``toxic`` (p_toxic >= ``LIMIT``, on marked features).
    Null and empty texts hold no features; they get the scores of any text
    without marks and are never toxic. Long texts are scored whole, window by
    window; equal texts have equal scores, and an empty table gives no rows.
    Input columns of these names are replaced."""
    out = docs.withColumn("__score", _scores(F.col(f"`{text_col}`"), model))
    above = [F.lit(1.0) / (F.lit(1.0) + F.exp(F.lit(t) - F.col("__score"))) for t in model.thresholds]
    total = above[0]
    for a in above[1:]:
        total = total + a
    return out.withColumn("severity", total).withColumn("p_toxic", above[0]).withColumn(
        "toxic", (F.col("p_toxic") >= LIMIT) & (F.col("__score") > 0)).drop("__score")


def keep_clean(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents that the fitted model doesn't reject, with their columns.
    Null and empty texts stay, equal texts share their fate, texts of any
    length are judged whole; an empty table gives no rows, and without labels
    of both classes all rows stay."""
    model = fit(docs, labels, id_col, text_col)
    marked = docs.withColumn("__score", _scores(F.col(f"`{text_col}`"), model))
    # p_toxic < LIMIT, or nothing marked
    least = model.thresholds[0] + float(np.log(LIMIT / (1 - LIMIT)))
    return marked.where(F.col("__score") < F.greatest(F.lit(least), F.lit(1e-12))).drop("__score")
