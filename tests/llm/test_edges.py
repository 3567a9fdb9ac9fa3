"""Every operator on nulls in any column, empty and very long texts, ties,
repeated rows, clashing column names and empty tables."""

import time
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from unnestor.llm import (
    compression_quality, decontaminate, html_text, mixing, ngram_lm, pq_dedup, sharding, simhash, token_files, toxicity,
)
from unnestor.llm.queries import tokenizer_file

LONG = "the quick brown fox jumps over a lazy dog " * 4000
ROWS = [
    (1, "the cat sat on the mat and then it left", "a"), (1, "the cat sat on the mat and then it left", "a"),
    (1, "another text with this id", "a"), (2, None, "a"), (3, "", None), (None, "no id here but words", "b"),
    (None, None, None), (4, " \t\n ", "b"), (5, LONG, "b"), (6, "ünï 漢字   \U0001f600 x", None), (7, "one", "c"), (8, "one", "c"),
    (9, "<|endoftext|> a  b   c\n d ", "c"),
]
CLASH = ["size", "target", "row", "fp", "n", "label", "h1", "list", "word", "host", "part", "doc", "source_size", "text_hash", "root", "m", "x"]
N = len(ROWS)


@pytest.fixture(scope="module")
def docs(spark):
    df = spark.createDataFrame(ROWS, "doc_id bigint, text string, source string").repartition(3)
    for c in CLASH:
        df = df.withColumn(c, F.lit(None).cast("string"))
    return df.withColumn("score", F.lit("mine")).withColumn("lang", F.lit(None).cast("string")).withColumn("n_chars", F.length("text"))


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame(
        [(1, 1, 0), (1, 1, 0), (5, 0, 1), (7, None, None), (None, 1, 1), (99, 0, 0)], "doc_id bigint, quality int, toxic int"
    ).withColumn("text", F.lit("label text"))


@pytest.fixture(scope="module")
def benchmark(spark):
    return spark.createDataFrame([(1, "no id here but words"), (2, None), (3, ""), (None, "the cat sat on the mat and")], "item_id bigint, text string")


def none_of(df):
    return df.limit(0)


def test_mix(docs):
    found = mixing.taken(mixing.copies(docs))
    rows = found.collect()
    assert len(rows) == N
    assert all(r.taken <= 2 * r["size"] and r["size"] >= 0 for r in rows)
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns
    copies = {}
    for r in mixed.collect():
        copies[r.doc_id, r.text] = copies.get((r.doc_id, r.text), 0) + 1
    words = lambda t: len((t or "").encode().split())
    assert sum(words(t) * n for (_, t), n in copies.items()) == sum(r.taken for r in rows)
    assert mixing.copies(none_of(docs)).count() == 0 and mixing.mix(none_of(docs)).count() == 0


def test_shards(docs):
    cut = sharding.shard_documents(docs, 4)
    assert cut.count() == N and set(cut.columns) == {*docs.columns, "shard"}
    keys = sharding.contiguous_shards(sharding.shard_keys(docs), 4, sharding.ORDER).collect()
    for s in range(4):
        slots = sorted(r.slot for r in keys if r.shard == s)
        assert slots == list(range(len(slots)))
    key = lambda r: (r.doc_id is not None, r.doc_id, r.text_crc32, r["size"], r["row"])
    ordered = sorted(keys, key=lambda r: key(r) if r.doc_id is not None else (False, -1, r.text_crc32, r["size"], r["row"]))
    assert [r.shard for r in ordered] == sorted(r.shard for r in keys)
    unique = lambda rows: sorted((r.shard, r.doc_id) for r in rows if r.doc_id not in (1, None))
    assert unique(cut.collect()) == unique(keys)
    same = docs.where("doc_id = 9").withColumn("k", F.explode(F.sequence(F.lit(1), F.lit(400))))
    dealt = [r["count"] for r in sharding.shard_documents(same, 4).groupBy("shard").count().collect()]
    assert len(dealt) == 4 and min(dealt) > 60
    assert sharding.shard_documents(none_of(docs), 4).count() == 0


def test_simhash(docs):
    found = {(r.doc_id, r.fp, r.component_id) for r in simhash.components(docs).collect()}
    assert {(2, 0, 2), (3, 0, 2), (4, 0, 2), (None, 0, 2)} <= found
    assert {c for d, _, c in found if d in (7, 8)} == {7}
    kept = simhash.deduplicate(docs)
    assert kept.columns == docs.columns
    rows = [(r.doc_id, r.text) for r in kept.collect()]
    assert len(rows) == len(set(rows)) and (1, ROWS[0][1]) in rows and (1, ROWS[2][1]) in rows
    assert (7, "one") in rows and (8, "one") not in rows and (2, None) in rows and (3, "") not in rows
    assert simhash.components(none_of(docs)).count() == 0 and simhash.deduplicate(none_of(docs)).count() == 0


def test_toxicity(docs, labels):
    model = toxicity.fit(docs, labels)
    out = toxicity.score(docs, model)
    assert out.count() == N and out.where("severity is null or severity < 0 or severity > 3").count() == 0
    assert toxicity.keep_clean(docs, labels).columns == docs.columns
    none = toxicity.fit(docs, none_of(labels))
    assert toxicity.score(docs, none).where("toxic").count() == 0
    assert toxicity.keep_clean(none_of(docs), labels).count() == 0


def test_leaks(docs, benchmark):
    found = sorted((r.doc_id or -1, r.item_id or -1, r.start, r.n_words, r.distance) for r in decontaminate.leaks(docs, benchmark).collect())
    assert found == [(-1, 1, 0, 5, 0), (1, -1, 0, 7, 0), (1, -1, 0, 7, 0)]
    clean = decontaminate.decontaminate(docs, benchmark)
    assert clean.columns == docs.columns and clean.count() == N - 3
    assert decontaminate.leaks(docs, none_of(benchmark)).count() == 0
    assert decontaminate.leaks(none_of(docs), benchmark).count() == 0
    assert decontaminate.decontaminate(docs, none_of(benchmark)).count() == N
    in_blocks = decontaminate.leaks(docs, benchmark, block=1).collect()
    assert len(in_blocks) == 3


def test_quality(docs, labels):
    model = compression_quality.fit(docs, labels)
    out = compression_quality.score(docs, model).collect()
    assert len(out) == N and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in out)
    assert compression_quality.score(docs, compression_quality.fit(docs, none_of(labels))).where("score is null").count() == 0
    assert compression_quality.score(none_of(docs), model).count() == 0


def test_language_model(docs):
    found = {r.doc_id: r for r in ngram_lm.score(docs).collect()}
    assert set(found) == {r[0] for r in ROWS}
    assert found[2].n_words == 0 and found[2].log_score <= 0 and found[5].n_words == 36000
    assert ngram_lm.score(none_of(docs)).count() == 0


def test_token_files(docs, spark, tmp_path):
    path = f"file://{tmp_path}/tokens"
    token_files.write(docs, path, tokenizer_file())
    rows = token_files.read(spark, path).orderBy("start").collect()
    assert len(rows) == N and rows[0].start == 0 and rows[0].doc_id is None
    assert all(a.start + a.n_tokens == b.start for a, b in zip(rows, rows[1:]))
    assert [r.doc_id for r in rows][2:] == sorted(r[0] for r in ROWS if r[0] is not None)
    assert {r.n_tokens for r in rows if r.doc_id in (2, 3)} == {1}
    token_files.write(none_of(docs), path + "0", tokenizer_file())
    assert token_files.read(spark, path + "0").count() == 0


def test_pages(spark):
    page = "<html><nav>x</nav><article><p>Body &amp; soul</p></article></html>"
    rows = [(1, "http://h/a", page), (1, "http://h/a", page), (2, None, page), (3, "not a url", None), (4, "http://h/b", ""), (None, "http://h/c", "<p>a" * 5000)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").withColumn("row", F.lit("r")).withColumn("text", F.lit("t")).withColumn(
        "lines", F.lit("l")).withColumn("host", F.lit(None).cast("string"))
    out = html_text.main_text(pages)
    assert set(out.columns) == {"page_id", "url", "text", "row", "lines", "host"}
    text = sorted((r.page_id or -1, r.text) for r in out.collect())
    assert text[1:] == [(1, "Body & soul"), (1, "Body & soul"), (2, "Body & soul"), (3, ""), (4, "")] and text[0][1].count("\n") == 4999
    assert html_text.main_text(none_of(pages)).count() == 0


def test_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [1.0, 0.0], 1), (2, [2.0, 0.0], 1), (2, [2.0, 0.0], 1), (3, [1.0, 0.0], 2), (4, [1.0, 0.0], None), (5, None, 1), (6, [0.0, 0.0], 1),
        (7, [nan, 1.0], 1), (8, [inf, 1.0], 1), (9, [None, 1.0], 1), (10, [], 1), (None, [1.0, 0.0], 1), (11, [1.0, 0.0, 0.0], 1), (12, [0.0, 1e-30], 1),
        (13, [0.0, 3e38], 1),
    ]
    vectors = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int").withColumn("cid", F.lit("c")).withColumn("n", F.lit("n"))
    found = sorted((r.vec_id or 0, r.n_links, r.component_id, r.kept) for r in pq_dedup.near_duplicates(vectors).collect())
    alone = [(i, 0, i, True) for i in (3, 4, 5, 6, 7, 8, 9, 10, 11)]
    assert found == [(0, 3, 1, False), (1, 3, 1, True), (2, 3, 1, False), (2, 3, 1, False), *alone, (12, 1, 12, True), (13, 1, 12, False)]
    assert pq_dedup.near_duplicates(none_of(vectors)).count() == 0


def test_pipeline_stages(docs, labels, benchmark, spark, tmp_path):
    slim = docs.select("doc_id", "text", "lang", "source", "n_chars")
    for rows, sub in ((slim, "some"), (none_of(slim), "none")):
        d = f"{tmp_path}/{sub}"
        rows.write.parquet(f"{d}/documents.parquet")
        labels.drop("text").write.parquet(f"{d}/labels.parquet")
        benchmark.write.parquet(f"{d}/benchmark.parquet")
        out = corpus_pipeline.run(spark, d)
        assert out.columns == [*slim.columns, "shard"]
        assert (out.count() > 0) == (sub == "some")


def test_the_marked_part_of_a_page():
    lines = lambda html: [t for t, _ in html_text.page_lines(html)]
    article = "<article><p>one two three four</p></article>"
    assert lines(f"<main><h1>Headline</h1>{article}<div>Aside words</div></main>") == ["Headline", "one two three four"]
    assert lines(f"<h1>Site</h1>{article}") == ["one two three four"]
    teaser = "<main><p>long main text of many words here</p><article><p>teaser</p></article></main>"
    assert lines(teaser) == ["long main text of many words here", "teaser"]


def test_many_equal_lines_are_compared_in_time():
    started = time.time()
    assert html_text.common_lines(["x"] * 20_000, ["x"] * 20_000) == set(range(20_000))
    assert html_text.common_lines(["x", "y"] * 10_000, ["y"] * 5_000) and not html_text.common_lines(["x"] * 9, ["y"] * 9)
    assert time.time() - started < 20
