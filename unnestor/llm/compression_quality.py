"""Compression classifier of text quality.

Two zstandard dictionaries, one of good and one of bad labelled text, compress
every text in blocks. The better a dictionary fits, the smaller the blocks:
the difference of the two sizes over the bytes of the text, calibrated by a
logistic curve, is the chance that the text is good. (Over the sum of the
sizes it would say little of texts that repeat a word, which any dictionary
compresses well.)
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stage_at, unstage

SAMPLE = 4000  # labelled rows of each class that are used at most, by hash of the id
TEXT_BYTES = 1 << 15  # a sample text is at most as long
DICTIONARY = 1 << 18
PIECE = 1024  # bytes of the pieces that it is trained on
BLOCK = 512  # bytes compressed at once, so that the dictionary counts throughout a long text
LEVEL = 3
LIMIT = 0.3


@dataclass
class Model:
    """Raw dictionaries and the logistic curve of the difference."""

    good: bytes = b""
    bad: bytes = b""
    slope: float = 0.0
    offset: float = 0.0


def _dictionary(texts: list[bytes]) -> bytes:
    """A dictionary of ``DICTIONARY`` bytes trained on pieces of the texts, or
    the texts themselves where they are too few to train on."""
    pieces = [t[i : i + PIECE] for t in texts for i in range(0, len(t), PIECE)]
    try:
        return zstandard.train_dictionary(DICTIONARY, pieces, level=LEVEL).as_bytes()
    except zstandard.ZstdError:
        return b"\n".join(texts)[-DICTIONARY:]


def _compressor(dictionary: bytes) -> zstandard.ZstdCompressor:
    data = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
    if data:
        data.precompute_compress(level=LEVEL)
    return zstandard.ZstdCompressor(
        level=LEVEL, dict_data=data, write_checksum=False, write_content_size=False, write_dict_id=False)


def _difference(text: Column, model: Model) -> Column:
    """(bad - good) / bytes of the compressed sizes; 0 for null and empty texts."""
    dictionaries = (model.good, model.bad)

    @F.arrow_udf("double")
    def difference(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        good, bad = (_compressor(d).compress for d in dictionaries)
        for texts in batches:
            out = []
            for t in texts:
                data = (t.as_py() or "").encode("utf-8", "surrogatepass")
                g = b = 0
                for i in range(0, len(data), BLOCK):
                    g += len(good(data[i : i + BLOCK]))
                    b += len(bad(data[i : i + BLOCK]))
                out.append((b - g) / len(data) if data else 0.0)
            yield pa.array(out, pa.float64())

    return difference(text)


def _calibrate(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the weighted logistic regression of y on x, by Newton steps."""
    scale = max(float(np.std(x)), 1e-9)
    z = np.column_stack([x / scale, np.ones_like(x)])
    beta = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ beta, -30, 30)))
        # a small penalty keeps the slope finite where the classes don't overlap
        grad = z.T @ (weight * (p - y)) + 1e-5 * len(x) * beta * [1, 0]
        hess = (z * (weight * p * (1 - p))[:, None]).T @ z + np.diag([1e-5 * len(x), 1e-9])
        beta -= np.linalg.solve(hess, grad)
    return float(beta[0] / scale), float(beta[1])


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", sample: int = SAMPLE) -> Model:
    """Fit on at most ``sample`` labelled rows of each class, chosen by hash of
    the id among texts of 1 to ``TEXT_BYTES`` bytes: three
    quarters of them make the dictionaries, the rest, weighted to the classes' shares of
    all ``labels``, the calibration. Null labels don't count; without both classes every
    score is the share of good labels (one half without labels). An id with
    several labels is good if all of them say so."""
    spark = docs.sparkSession
    known = labels.select(F.col(f"`{id_col}`").alias("doc_id"), (F.col(f"`{label_col}`") > 0).cast("int").alias("label")).where(
        "label is not null and doc_id is not null").groupBy("doc_id").agg(F.min("label").alias("label"))
    sizes = dict(known.groupBy("label").count().collect())
    good_share = sizes.get(1, 0) / max(1, sum(sizes.values())) if sizes else 0.5
    # more than are needed, as some have no text that fits
    pick = [known.where(f"label = {c}").orderBy(F.xxhash64("doc_id"), "doc_id").limit(2 * sample) for c in (0, 1)]
    texts = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text")).where(
        F.octet_length("text").between(1, TEXT_BYTES))
    # at most 4 * sample ids: small enough to send to every task
    joined, at = stage_at(texts.join(F.broadcast(pick[0].unionByName(pick[1])), "doc_id"), "quality-sample")
    of = [joined.where(f"label = {c}").orderBy(F.xxhash64("doc_id"), "doc_id", "text").limit(sample) for c in (0, 1)]
    quarter = F.pmod(F.xxhash64(F.lit(7), F.col("doc_id")), F.lit(4))
    rows, at2 = stage_at(of[0].unionByName(of[1]).withColumn("quarter", quarter), "quality-rows")
    held: dict[int, list[bytes]] = {0: [], 1: []}
    for r in rows.where("quarter > 0").orderBy("label", "doc_id").toLocalIterator():
        held[r["label"]].append(r["text"].encode("utf-8", "surrogatepass"))
    if not held[0] or not held[1]:
        for path in (at, at2):
            unstage(spark, path)
        share = min(max(good_share, 1e-3), 1 - 1e-3)
        return Model(offset=float(np.log(share / (1 - share))))
    model = Model(_dictionary(held[1]), _dictionary(held[0]))
    found = rows.where("quarter = 0").select("label", _difference(F.col("text"), model).alias("x")).collect()
    for path in (at, at2):
        unstage(spark, path)
    x, y = np.array([r["x"] for r in found], float), np.array([r["label"] for r in found], float)
    share = np.array([1 - good_share, good_share])
    seen = np.array([max(1, (y == c).sum()) for c in (0, 1)])
    weight = (share / seen * max(1, len(y)))[y.astype(int)]
    if len(set(y.tolist())) == 2:
        model.slope, model.offset = _calibrate(x, y, weight)
    else:
        model.slope = 50.0
    return model


def score(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` with ``score`` (0 to 1, chance of label 1) and ``predicted``
    (1 if the score is at least ``LIMIT``). Null and empty texts have
    difference 0 and so the curve's value there. Input columns of these names
    are replaced."""
    x = _difference(F.col(f"`{text_col}`"), model)
    out = docs.withColumn("__x", x)
    chance = F.lit(1.0) / (F.lit(1.0) + F.exp(-(F.col("__x") * model.slope + F.lit(model.offset))))
    return out.withColumn("score", chance).withColumn("predicted", (F.col("score") >= LIMIT).cast("int")).drop("__x")
