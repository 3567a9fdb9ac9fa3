"""Toxicity: windows of long texts, and the fit against brute force."""

import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import TESTDATA, needs_testdata
from unnestor.llm import toxicity


def loss(x, grades, w, cut):
    """The penalised objective, term by term."""
    total = 0.0
    for row, g in zip(x, grades):
        for k, t in enumerate(cut):
            p = 1 / (1 + np.exp(t - row @ w))
            total -= np.log(p if g > k else 1 - p)
    return total / len(grades) + toxicity.PENALTY * np.abs(w).sum()


def test_the_fit_is_the_minimum():
    rng = np.random.default_rng(1)
    x = (rng.random((300, 6)) < 0.4) * rng.random((300, 6))
    grades = np.clip(np.digitize(x @ [3, 2, 0, 0, 1, 0] + rng.logistic(size=300), [1, 2, 4]), 0, 3)
    rows, cols = np.nonzero(x)
    w, cut = toxicity.fit_ordinal(rows, cols, x[rows, cols], grades, 6, 4)
    assert (np.diff(cut) >= 0).all()
    best = loss(x, grades, w, cut)
    for _ in range(300):
        step = rng.normal(size=9) * rng.choice([1e-3, 1e-2, 1e-1])
        assert loss(x, grades, w + step[:6], cut + step[6:]) >= best - 1e-6


def by_hand(text, model):
    """The score of the worst window, by counting each window anew."""
    own = toxicity.sequence(text)
    half = toxicity.WINDOW // 2
    parts = [own[a : a + toxicity.WINDOW] for a in range(0, max(1, len(own) - half), half)]
    scores = []
    for part in parts:
        counts = Counter()
        for w in part:
            counts[b"w" + w] += 1
            counts.update(b"%d" % n + w[:n] for n in toxicity.STARTS)
        scores.append(sum(x * s for f, weight in model.weights.items() for x, s in zip(weight, toxicity.scaled(counts[f] / max(1, len(part))))))
    return max(scores) - toxicity.ALLOWANCE * np.log(len(parts))


def test_windows_against_brute_force(spark):
    rng = random.Random(3)
    model = toxicity.Model({b"wbad": (2.0, 1.0), b"4awfu": (1.5, 0.0), b"5nasty": (0.5, 3.0), b"wugh": (-1.0, 0.5)}, [3.0, 5.0, 7.0])
    vocabulary = ["fine", "good", "words", "Bad", "awful", "awfully", "nastyness", "ugh", "été", "nast"]
    texts = [" ".join(rng.choices(vocabulary, [40, 40, 40, 1, 1, 1, 1, 1, 5, 5], k=n)) for n in (0, 1, 10, 149, 150, 151, 299, 300, 301, 450, 451, 5000)]
    df = spark.createDataFrame(list(enumerate([*texts, None])), "doc_id bigint, text string")
    got = dict(df.select("doc_id", toxicity._scores(F.col("text"), model)).collect())
    assert got == pytest.approx({i: by_hand(t, model) if t else 0.0 for i, t in enumerate([*texts, None])})


@needs_testdata
def test_passages_inside_long_texts(spark):
    docs = spark.read.parquet(f"{TESTDATA}/sf0.1/documents.parquet")
    labels = spark.read.parquet(f"{TESTDATA}/sf0.1/labels.parquet")
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    model = toxicity.fit(docs, labels.where(~held))
    rows = toxicity.score(docs.join(labels.where(held).withColumnRenamed("toxic", "truth"), "doc_id"), model).select("text", "truth", "toxic").collect()
    alone = [r.text for r in rows if r.truth and r.toxic]
    clean = [r.text for r in rows if not r.truth and not r.toxic and r.text]
    assert len(alone) > 100
    rng = random.Random(1)

    def long_text():
        out = []
        while len(out) < 20_000:
            out += rng.choice(clean).split()
        return out[:20_000]

    made = []
    for i, text in enumerate(alone):
        around, at = long_text(), rng.randrange(20_000)
        made.append((i, " ".join([*around[:at], text, *around[at:]])))
    made += [(10_000 + i, " ".join(long_text())) for i in range(200)]
    found = dict(toxicity.score(spark.createDataFrame(made, "doc_id bigint, text string").repartition(8), model).select("doc_id", "toxic").collect())
    assert sum(found[i] for i in range(len(alone))) >= 0.95 * len(alone)
    assert sum(found[10_000 + i] for i in range(200)) <= 2


def test_an_id_with_both_labels_is_toxic(spark):
    docs = spark.createDataFrame([(i, "awful nasty words here" if i % 2 else "kind and fine words") for i in range(60)], "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)] + [(1, 0), (2, 1)], "doc_id bigint, toxic int")
    models = [toxicity.fit(docs, labels.repartition(n)) for n in (1, 5)]
    assert models[0] == models[1] and models[0].weights
