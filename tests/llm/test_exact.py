"""Operators against brute force, exact round trips and held-out accuracy."""

import math
import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import corpus_pipeline
from tests.conftest import TESTDATA, needs_testdata
from unnestor.llm import decontaminate, html_text, mixing, ngram_lm, pq_dedup, queries, sharding, simhash, token_files, toxicity
from unnestor.llm.components import connected_components

SMALL = f"{TESTDATA}/sf0.001"
MEDIUM = f"{TESTDATA}/sf0.01"


def joined(pairs, nodes):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_connected_components(spark):
    rng = random.Random(1)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(i, i + 1) for i in range(400, 460)] + [(999, i) for i in range(500, 560)]
    found = dict(connected_components(spark.createDataFrame(links, "a bigint, b bigint")).collect())
    links = [(a, b) for a, b in links if a != b]
    assert found == joined(links, {x for p in links for x in p})


# --- mixing -----------------------------------------------------------------

@needs_testdata
def test_mix_meets_targets_and_reruns_agree(spark):
    docs = spark.read.parquet(f"{MEDIUM}/documents.parquet")
    rows = mixing.taken(mixing.copies(docs)).toPandas()
    per = rows.groupby("source").agg(size=("size", "sum"), stated=("source_size", "first"), target=("target", "first"), taken=("taken", "sum"))
    assert (per["size"] == per.stated).all() and (rows.taken <= 2 * rows["size"]).all()
    weights, target = np.array([(3, 1, 2)[i % 3] for i in range(len(per))], float), np.zeros(len(per))
    cap, capped = 2.0 * per.stated.to_numpy(), np.zeros(len(per), bool)
    while True:
        share = (1.5 * per.stated.sum() - cap[capped].sum()) * weights / weights[~capped].sum()
        target = np.where(capped, cap, share)
        if not (over := ~capped & (target > cap)).any():
            break
        capped |= over
    assert np.allclose(per.target, target)
    assert (abs(per.taken - per.target) / per.target).max() < 0.02
    again = mixing.taken(mixing.copies(docs.repartition(7))).toPandas()
    key = ["doc_id", "taken"]
    assert rows.sort_values(key)[key].reset_index(drop=True).equals(again.sort_values(key)[key].reset_index(drop=True))


def test_mix_of_one_hot_key(spark):
    docs = spark.range(3000).select(F.lit(7).cast("bigint").alias("doc_id"), F.lit("a b c d").alias("text"), F.when(F.col("id") < 2000, "s").otherwise("t").alias("source"))
    rows = mixing.taken(mixing.copies(docs)).groupBy("source").agg(F.sum("taken").alias("taken"), F.first("target").alias("target"), F.count("*").alias("n")).collect()
    assert {r.source: r.n for r in rows} == {"s": 2000, "t": 1000}
    assert all(abs(r.taken - r.target) <= 4 for r in rows)
    assert mixing.mix(docs).count() * 4 == sum(r.taken for r in rows)


# --- sharding ---------------------------------------------------------------

@needs_testdata
def test_shards_equal_sql(spark):
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{MEDIUM}/documents.parquet'")
    con.create_function("crc", lambda t: zlib.crc32(t.encode()), ["VARCHAR"], "BIGINT")
    want = con.execute(f"select s.*, crc(d.text) as text_crc32 from ({queries.OP5_SQL}) s join documents d using (doc_id)").df()
    got = queries.op5_byte_shards(spark, MEDIUM).toPandas()
    cols = ["doc_id", "size", "shard", "slot", "text_crc32"]
    a, b = (x.sort_values("doc_id")[cols].astype("int64").reset_index(drop=True) for x in (want, got))
    assert a.equals(b)
    per = got.groupby("shard")["size"].sum()
    assert len(per) == 40 and per.max() - per.min() <= 2 * got["size"].max()


# --- simhash ----------------------------------------------------------------

def slow_fingerprint(text, n=4):
    words = text.encode().lower().split()
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[i : i + n]), 42) for i in range(max(1, len(words) - n + 1))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@pytest.mark.parametrize("node", [16, 4096])
def test_trie_links_equal_brute_force(spark, node):
    rng = random.Random(3)
    fps = {rng.getrandbits(64) for _ in range(150)}
    for f in list(fps)[:60]:
        for _ in range(4):
            x = f
            for b in rng.sample(range(64), rng.randrange(1, 7)):
                x ^= 1 << b
            fps.add(x)
    hot = rng.getrandbits(64)
    fps |= {hot ^ (1 << a) ^ (1 << b) for a in range(20) for b in range(a)}
    fps = sorted(f - (1 << 64) if f >> 63 else f for f in fps)
    table = spark.createDataFrame([(f,) for f in fps], "fp bigint")
    links = [(r.a, r.b) for r in simhash.fingerprint_links(table, node=node).collect()]
    pairs = [(a, b) for i, a in enumerate(fps) for b in fps[:i] if ((a ^ b) & (2**64 - 1)).bit_count() <= 4]
    assert joined(links, fps) == joined(pairs, fps)


@needs_testdata
def test_simhash_equals_brute_force(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    want = {d: slow_fingerprint(t) for d, t in docs.items()}
    ids = sorted(docs)
    roots = joined([(a, b) for i, a in enumerate(ids) for b in ids[:i] if (want[a] ^ want[b]).bit_count() <= 4], ids)
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in queries.op6_simhash(spark, SMALL).collect()}
    assert got == {d: (f"{want[d]:016x}", roots[d]) for d in ids}
    kept = simhash.deduplicate(spark.read.parquet(f"{SMALL}/documents.parquet"))
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(roots.values()))


# --- embeddings -------------------------------------------------------------

def test_vector_links_equal_brute_force(spark):
    rng = np.random.default_rng(5)
    base = rng.normal(size=(60, 16))
    x = np.concatenate([base + rng.normal(size=base.shape) * s for s in (0, 0.05, 0.1, 0.15, 0.2)]).astype(np.float32)
    x = np.concatenate([x, x[:9], 3 * x[:5]])
    label = rng.integers(0, 2, len(x))
    rows = spark.createDataFrame([(i, v.tolist(), int(k)) for i, (v, k) in enumerate(zip(x, label))], "vec_id bigint, embedding array<float>, label int")
    unit = x.astype(float) / np.linalg.norm(x.astype(float), axis=1)[:, None]
    near = (unit @ unit.T >= 0.98) & (label[:, None] == label[None, :])
    roots = joined(list(zip(*np.nonzero(near))), range(len(x)))
    for lists in (1, 12):
        got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in pq_dedup.near_duplicates(rows, lists=lists).collect()}
        assert got == {i: (int(near[i].sum()) - 1, int(roots[i]), roots[i] == i) for i in range(len(x))}


# --- decontamination --------------------------------------------------------

def slow_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a):
        last, row[0] = row[0], i + 1
        for j, y in enumerate(b):
            last, row[j + 1] = row[j + 1], min(row[j + 1] + 1, row[j] + 1, last + (x != y))
    return row[-1]


def test_nearest_equals_brute_force():
    rng = random.Random(2)
    for _ in range(40):
        item, window = ([rng.randrange(1, 5) for _ in range(rng.randrange(1, n))] for n in (8, 14))
        got = decontaminate.nearest(np.array(item), np.array(window), len(item))
        want = min(slow_distance(item, window[i:j]) for i in range(len(window) + 1) for j in range(i, len(window) + 1))
        assert got[0] == want == slow_distance(item, window[got[1] : got[1] + got[2]])


def test_edited_items_are_found():
    rng = random.Random(4)
    vocabulary = [f"w{i}" for i in range(400)]
    items = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.randrange(10, 60)))) for i in range(60)]
    index = decontaminate.Index(items)
    hits = 0
    texts, most = [], []
    for i, text in items * 4:
        words, k = text.split(), rng.randrange(decontaminate.allowed(len(text.split())) + 1)
        for _ in range(k):
            at = rng.randrange(len(words))
            words[at : at + 1] = rng.choice([[], ["other"], [words[at], "more"]])
        around = [" ".join(rng.choice(vocabulary) for _ in range(30)) for _ in range(2)]
        texts.append(f"{around[0]} {' '.join(words)} {around[1]}")
        most.append((i, k))
    for (i, k), found in zip(most, index.search(texts)):
        mine = [f for f in found if f["item_id"] == i]
        hits += bool(mine)
        assert all(f["item_id"] == i and f["distance"] <= k for f in found)
    assert hits >= 0.95 * len(most)
    clean = [" ".join(rng.choice(vocabulary) for _ in range(300)) for _ in range(30)]
    assert index.search(clean) == [[]] * 30


@needs_testdata
def test_leaks_hold_every_exact_passage(spark):
    docs = spark.read.parquet(f"{MEDIUM}/documents.parquet").collect()
    items = spark.read.parquet(f"{MEDIUM}/benchmark.parquet").collect()
    want = {(d.doc_id, i.item_id) for d in docs for i in items if i.text in d.text}
    got = {(r.doc_id, r.item_id): r.distance for r in queries.op4_leaks(spark, MEDIUM).collect()}
    assert want and want <= set(got) and all(got[w] == 0 for w in want)


# --- toxicity and quality ---------------------------------------------------

@needs_testdata
def test_toxicity_held_out(spark):
    docs, labels = (spark.read.parquet(f"{TESTDATA}/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    held = F.pmod(F.xxhash64(F.lit(5), "doc_id"), F.lit(4)) == 0
    model = toxicity.fit(docs, labels.where(~held))
    truth = labels.where(held).select("doc_id", F.col("toxic").alias("truth"))
    found = toxicity.score(docs, model).join(truth, "doc_id").groupBy("truth", "toxic").count().collect()
    n = {(r.truth, r.toxic): r["count"] for r in found}
    assert n[1, True] >= 0.95 * (n[1, True] + n.get((1, False), 0))
    assert n[0, False] >= 0.99 * (n[0, False] + n.get((0, True), 0))
    assert model.thresholds == sorted(model.thresholds)


def test_toxicity_of_repeated_rows(spark):
    rows = [(i, f"vile foul words number{i} here", 1) for i in range(30)] + [(100 + i, f"plain good words number{i} here", 0) for i in range(60)]
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id bigint, toxic int")
    once = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id bigint, text string")
    again = once.where("doc_id = 7").withColumn("k", F.explode(F.sequence(F.lit(1), F.lit(300)))).drop("k")
    model = toxicity.fit(once, labels)
    assert model.weights and toxicity.fit(once.unionByName(again), labels) == model


@needs_testdata
def test_quality_held_out(spark):
    truth = spark.read.parquet(f"{TESTDATA}/sf0.1/labels.parquet").select("doc_id", "quality")
    found = queries.op9_compression_quality(spark, f"{TESTDATA}/sf0.1").join(truth, "doc_id").where("held_out").toPandas()
    assert (found.predicted == found.quality).mean() >= 0.96
    rank, good = found.score.rank(), found.quality == 1
    assert (rank[good].sum() - good.sum() * (good.sum() + 1) / 2) / (good.sum() * (~good).sum()) >= 0.98


# --- html -------------------------------------------------------------------

PAGE = """<html><head><title>T</title><script>var a="<p>x</p>";</script></head><body class="has-sidebar"><header>Site</header>
<div class="cookie-notice">We use cookies</div>{menu}<div id="story"><h1>A &amp; B</h1><p class="lead">First<b> bold</b> line<p>Second&nbsp;line<br>third
 line<ul><li>one<li>two</ul><form><input value=x>Search</form><div class="share">Share me</div><p>{tail}</p></div>
<section id="comments"><article><p>I disagree</p></article></section><aside>Side</aside><footer>Foot</footer></body></html>"""


def test_page_lines():
    lines = [t for t, _ in html_text.page_lines(PAGE.format(menu="<div>Loose menu</div>", tail="end"))]
    assert lines == ["A & B", "First bold line", "Second line", "third line", "one", "two", "end"]
    assert html_text.page_lines("<p>a<p>b</p>c &lt;i&gt; <!-- x --> d") == [("a", False), ("b", False), ("c <i> d", False)]


def test_pages_of_a_host_lose_what_they_share(spark):
    page = "<div>{0} intro words of its own</div><div>Read our other news</div><p>{0} text with many words that differ from the others {0}</p><div>Contact us</div>"
    rows = [(i, f"http://Host.example/a/{i}", page.format(f"n{i}")) for i in range(4)] + [(9, "http://alone.example/a", page.format("n9"))]
    out = html_text.main_text(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()
    text = {r.page_id: r.text.split("\n") for r in out}
    assert all(len(text[i]) == 2 and not any("news" in t or "Contact" in t for t in text[i]) for i in range(4)) and len(text[9]) == 4


def test_neighbours_pass_over_runs_of_copies(spark):
    rng = random.Random(5)
    rows, k = [], 0
    for host in ("a", "b", "c", None):
        while len(rows) < 60 * (1 + "abc".find(host or "d") % 4):
            longest = rng.choice([1, 2, 3, None])
            for _ in range(rng.choice([1, 1, 2, 25])):
                rows.append((f"r{k:04}", host, f"/p/{k:04}", longest))
                k += 1
    got = dict(html_text.neighbours(spark.createDataFrame(rows, "row string, host string, path string, longest bigint").repartition(5)).collect())

    near = {}
    for i, (row, host, path, longest) in enumerate(rows):
        before = next((r for r in reversed(rows[:i]) if host and r[1] == host and r[3] != longest), None)
        after = next((r for r in rows[i + 1 :] if host and r[1] == host and r[3] != longest), None)
        near[row] = {r[0] for r in (before, after) if r}
    assert all((got.get(row) in near[row]) if near[row] else row not in got for row in near)
    assert any(len(v) == 2 for v in near.values()) and any(not v for v in near.values())


def test_template_longer_than_the_article_goes_and_copies_stay(spark):
    menu = "".join(f"<div>{w} and more</div>" for w in "home news sport money travel science culture video".split())
    page = "<html><body>" + menu + "<div>{0}</div><div>Buy one and get one free today</div><div>All rights reserved by the paper</div></body></html>"
    texts = ["the harbour reopened on monday after a storm had closed it", "voters in the north chose a new council this week"]
    rows = [(0, "http://h.example/n/a", page.format(texts[0])), (1, "http://h.example/n/b", page.format(texts[1]))]
    # copies of an article stand between others in the order of the URLs
    rows += [(i, f"http://g.example/n/{i:02}", page.format(texts[0])) for i in range(2, 20)] + [(20, "http://g.example/n/z", page.format(texts[1]))]
    # only copies: nothing to compare with
    rows += [(i, f"http://k.example/n/{i}", "<div>Menu</div><div>" + texts[0] + "</div>") for i in (30, 31)]
    # two versions of one article: what they share is no template
    body = "<div>Some paragraph number {} that both versions hold unchanged from the first to the last word</div>"
    rows += [(40 + i, f"http://v.example/n/{i}", "".join(body.format(n) for n in range(5)) + f"<div>{'a last line that was edited ' * 5} {i}</div>") for i in (0, 1)]
    out = {r.page_id: r.text for r in html_text.main_text(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()}
    assert [out[i] for i in range(21)] == [texts[0], texts[1]] + [texts[0]] * 18 + [texts[1]]
    assert all(out[i] == "Menu\n" + texts[0] for i in (30, 31)) and all(len(out[i].split("\n")) == 6 for i in (40, 41))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.sampled_from("abcd"), max_size=12), st.lists(st.sampled_from("abcd"), max_size=12))
def test_common_lines_are_a_longest_common_subsequence(a, b):
    table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(len(a)):
        for j in range(len(b)):
            table[i + 1][j + 1] = table[i][j] + 1 if a[i] == b[j] else max(table[i][j + 1], table[i + 1][j])
    places = sorted(html_text.common_lines(a, b))
    rest = iter(b)
    assert len(places) == table[-1][-1] and all(a[i] in rest for i in places)


# --- language model ---------------------------------------------------------

def test_backoff_scores_equal_brute_force(spark):
    texts = {1: "a b a c", 2: "a b rare", 3: "", 4: "b A b", 5: "a c"}
    got = {r.doc_id: r for r in ngram_lm.score(spark.createDataFrame(list(texts.items()), "doc_id bigint, text string"), rare=0.15).collect()}
    words = {d: t.lower().split() for d, t in texts.items()}
    flat = [w for ws in words.values() for w in ws]
    known = {w for w in flat if flat.count(w) >= 0.15 * len(flat)}
    lines = {d: ["<s>", *[w if w in known else "?" for w in ws], "</s>"] for d, ws in words.items()}
    uni = [w for x in lines.values() for w in x]
    pairs = [p for x in lines.values() for p in zip(x, x[1:])]
    for d, x in lines.items():
        own, logs, back = list(zip(x, x[1:])), [], 0
        for a, b in own:
            n = pairs.count((a, b)) - own.count((a, b))
            back += n == 0
            logs.append(np.log10(n / uni.count(a) if n else 0.4 * uni.count(b) / (len(flat) + len(lines))))
        assert got[d].n_words == len(words[d]) and got[d].n_backoff == back
        assert got[d].log_score == pytest.approx(sum(logs)) and got[d].word_score == pytest.approx(np.mean(logs))


def test_backoff_scores_keep_every_word(spark):
    # of 600,000 words two occur once: they may not share a class
    common = " ".join(f"w{i}" for i in range(1000))
    texts = {1: "zebra eats quince", 2: "zebra eats quince", 3: "zebra eats medlar", 4: "zebra eats damson", **{10 + i: common for i in range(600)}}
    got = {r.doc_id: r for r in ngram_lm.score(spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")).collect()}
    total = sum(len(t.split()) + 1 for t in texts.values())
    n_rows = len(texts)
    # of the others: <s> zebra 3, zebra eats 3, eats quince 1, quince </s> 1
    assert got[1].n_backoff == 0 and got[1].log_score == pytest.approx(np.log10([3 / n_rows, 3 / 4, 1 / 4, 1 / 2]).sum())
    # eats medlar and medlar </s> are its own
    assert got[3].n_backoff == 2 and got[3].log_score == pytest.approx(np.log10([3 / n_rows, 3 / 4, 0.4 * 1 / total, 0.4 * n_rows / total]).sum())


@pytest.mark.parametrize("sample", [1.0, 1e-9])
def test_backoff_scores_do_not_depend_on_what_is_frequent(spark, monkeypatch, sample):
    # with every word and bigram in the sample most are scored where they are
    # read; with none all are looked up by long names
    monkeypatch.setattr(ngram_lm, "SAMPLE", sample)
    rng = random.Random(3)
    vocabulary = [f"w{i}" for i in range(30)] + ["x" * 60, "y" * 60]
    texts = {i: " ".join(rng.choice(vocabulary) if rng.random() < 0.8 else f"r{rng.randrange(300)}" for _ in range(rng.randrange(40))) for i in range(80)}
    texts[80] = texts[3]
    rows = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string").repartition(3)
    got = {r.doc_id: r for r in ngram_lm.score(rows).collect()}
    lines = {d: ["<s>", *t.split(), "<s>"] for d, t in texts.items()}
    uni = Counter(w for x in lines.values() for w in x[:-1])
    pairs = Counter(p for x in lines.values() for p in zip(x, x[1:]))
    assert set(got) == set(texts)
    for d, x in lines.items():
        own = Counter(zip(x, x[1:]))
        logs, back = 0.0, 0
        for (a, b), n in own.items():
            other = pairs[a, b] - n
            back += n * (other == 0)
            logs += n * np.log10(other / uni[a] if other else 0.4 * uni[b] / sum(uni.values()))
        assert got[d].n_words == len(x) - 2 and got[d].n_backoff == back
        assert got[d].log_score == pytest.approx(logs) and got[d].word_score == pytest.approx(logs / (len(x) - 1))


def test_backoff_scores_of_a_text_with_many_frequent_bigrams(spark, monkeypatch):
    """More of them back off than there are short names."""
    monkeypatch.setattr(ngram_lm, "SAMPLE", 1.0)
    n = ngram_lm.SHORT
    row = ngram_lm.score(spark.createDataFrame([(1, "a b " * n)], "doc_id bigint, text string")).collect()[0]
    assert (row.n_words, row.n_backoff) == (2 * n, 2 * n + 1)


@pytest.mark.parametrize("frequent", [5, 1 << 18])
def test_backoff_rows_are_no_more_than_unsettled_bigrams(spark, monkeypatch, frequent):
    """Whatever the number of tasks and documents: a bigram makes at most one row,
    and none if its row alone has it and the count of its second word is at hand."""
    monkeypatch.setattr(ngram_lm, "SAMPLE", 1.0)
    monkeypatch.setattr(ngram_lm, "FREQUENT", frequent)
    made, found = [], ngram_lm._found

    def counted(exploded, model):
        made.append(found(exploded, model).count())
        return found(exploded, model)

    monkeypatch.setattr(ngram_lm, "_found", counted)
    rng = random.Random(5)
    # words that occur once have long names
    texts = {i: " ".join(rng.choice([f"w{rng.randrange(40)}", f"r{rng.randrange(4000)}"]) for _ in range(rng.randrange(30))) for i in range(200)}
    got = {r.doc_id: r for r in ngram_lm.score(spark.createDataFrame(list(texts.items()), "doc_id bigint, text string").repartition(3)).collect()}
    lines = {d: ["<s>", *t.split(), "<s>"] for d, t in texts.items()}
    uni = Counter(w for x in lines.values() for w in x[:-1])
    pairs = Counter(p for x in lines.values() for p in zip(x, x[1:]))
    rows = len(texts)
    shared = 0
    for d, x in lines.items():
        own = Counter(zip(x, x[1:]))
        back = {p: pairs[p] == n for p, n in own.items()}
        rows += sum(back[p] and uni[p[1]] == 1 for p in own)
        shared += sum(not b for b in back.values())
        logs = sum(n * math.log10(0.4 * uni[p[1]] / sum(uni.values()) if back[p] else (pairs[p] - n) / uni[p[0]]) for p, n in own.items())
        assert got[d].n_words == len(x) - 2 and got[d].n_backoff == sum(n for p, n in own.items() if back[p])
        assert got[d].log_score == pytest.approx(logs)
    assert rows <= made[0] <= rows + shared
    # those of the large table are scored where they are read
    assert (made[0] == rows) == (frequent > 5)


def test_backoff_rows_of_a_key_come_in_any_order(spark):
    """Spark sorts them by the key alone."""
    long, both = ngram_lm.word_hash("x"), 5 * ngram_lm.SHORT + 6
    model = ngram_lm._Model(np.arange(1, ngram_lm.SHORT + 1), np.zeros(0, np.int64), np.zeros(0, np.int64), 100.0, 0.4)
    rows = [
        (1, long, ngram_lm.FIRST_LONG, 3, 2, None), (2, long, ngram_lm.FIRST_LONG, 3, 1, None), (3, long, ngram_lm.FIRST_LONG, long, 1, None),
        (1, long, ngram_lm.SECOND_LONG, 3, 1, None), (2, long, ngram_lm.SECOND_LONG, 4, 2, None), (3, long, ngram_lm.SECOND_LONG, 3, 2, None),
        (1, both, ngram_lm.BOTH_SHORT, 0, 1, None), (2, both, ngram_lm.BOTH_SHORT, 0, 3, None),
        (1, ngram_lm.LAST_KEY + 7, ngram_lm.SCORED, 300_000, 9, -1.5),
    ]
    found = []
    for seed in range(5):
        random.Random(seed).shuffle(rows)
        rows.sort(key=lambda r: r[1])
        table = pa.table(dict(zip(["doc_id", "key", "kind", "rest", "n", "log_score"], zip(*rows))))
        found.append(sorted((r["doc_id"], r["word"] or 0, r["n_words"], r["rows"], r["n_backoff"], round(r["log_score"], 9)) for r in ngram_lm._scores(table, model).to_pylist()))
    assert all(f == found[0] for f in found)
    assert (3, long, 0, 0, 1, 0.0) in found[0] and (1, 0, 9, 1, 300_000, -1.5) in found[0]
    # 4 of the word are first; 3 and 1 of the pair, the first word 6 times
    assert (1, 0, 0, 0, 0, round(math.log10(3 / 6), 9)) in found[0] and (1, 0, 0, 0, 0, round(2 * math.log10(1 / 4), 9)) in found[0]
    docs = spark.createDataFrame([(1, "a")], "doc_id bigint, text string")
    plan = ngram_lm._looked_up(ngram_lm._explode(docs, ngram_lm._Reader({}), model), model)._jdf.queryExecution().toString()
    assert re.search(r"Sort \[key#\d+L ASC NULLS FIRST\], false", plan)


# --- tokens -----------------------------------------------------------------

@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.one_of(st.integers(0, 50), st.integers(0, 2**32 - 1)), max_size=400), min_size=1, max_size=5))
def test_segment_round_trip(docs):
    ids = np.array([i for d in docs for i in d], np.uint32)
    data = token_files.write_segment(list(range(len(docs) - 1)) + [None], [len(d) for d in docs], ids, 17)
    rows, before, back = token_files.read_segment(data)
    assert before == 17 and rows["n"].tolist() == [len(d) for d in docs] and rows["null"].tolist()[-1] == 1
    assert back.tolist() == ids.tolist()


PIECES = [*"ab1.,'s\n\t   é漢\u0301\U0001f600\xa0\u2003\x1c<|>", "<|endoftext|>", "  ", " \n", "\r\n ", "it's", "THE"]
ALPHABET = st.lists(st.sampled_from(PIECES), max_size=30).map("".join)


@settings(max_examples=300, deadline=None)
@given(st.lists(ALPHABET, min_size=1, max_size=3))
def test_encoder_equals_the_tokenizer(texts):
    encoder = ENCODER.setdefault(0, None) or ENCODER.setdefault(1, token_files.Encoder(queries.tokenizer_file()))
    want = [np.array(e.ids, "<u4").tobytes() for e in encoder.tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert encoder.encode(texts) == want


@settings(max_examples=200, deadline=None)
@given(st.lists(ALPHABET, min_size=1, max_size=3))
def test_encoder_equals_a_fresh_tokenizer(texts):
    from tokenizers import Tokenizer

    if "fresh" not in ENCODER:
        ENCODER["fresh"] = Tokenizer.from_file(queries.tokenizer_file()), token_files.Encoder(queries.tokenizer_file())
    fresh, encoder = ENCODER["fresh"]
    texts = [*texts, "hello <|endoftext|> world", "a<|endoftext|>", "<|ENDOFTEXT|> b", ""]
    want = [np.array(fresh.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
    assert encoder.encode(texts) == want and 50256 in np.frombuffer(want[-4], "<u4")


ENCODER = {}


def test_encoder_learns_a_piece_once(monkeypatch):
    """A piece is encoded in the first batch that holds it, and a full store
    of pieces is emptied without a change of any id."""
    encoder = token_files.Encoder(queries.tokenizer_file())
    learnt, spaced = [], encoder._spaced_ids
    monkeypatch.setattr(encoder, "_spaced_ids", lambda pieces: (learnt.append(sorted(pieces)), spaced(pieces)))
    texts = ["a word, a (word) x\0y", "b word, c  word"]
    want = [np.array(e.ids, "<u4").tobytes() for e in encoder.tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert encoder.encode(texts) == want and ["a", "c", "word"] in learnt and ["(word)"] in learnt
    learnt.clear()
    assert encoder.encode(texts) == want and not sum(learnt, [])
    monkeypatch.setattr(token_files, "CACHE", 4)
    more = [f"{t} other{k}, word" for k, t in enumerate(texts)]
    assert encoder.encode(more) == [np.array(e.ids, "<u4").tobytes() for e in encoder.tokenizer.encode_batch(more, add_special_tokens=False)]
    assert "c" in encoder.later and "(word)" in encoder.later


def test_encoder_cuts_pieces_at_line_breaks(monkeypatch):
    """Letters after a single line break are learnt by themselves, and pieces
    met before a full store was emptied aren't encoded again."""
    encoder = token_files.Encoder(queries.tokenizer_file())
    texts = ["the end.\nThe naïve\nÜber, x", "an end.\nNext\n\nThe e\n f \ng.\n\tThe", "the\nend. The\r\nend"]
    want = [np.array(e.ids, "<u4").tobytes() for e in encoder.tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert encoder.by_line and encoder.by_word
    assert encoder.encode(texts) == want and {"The", "Über", "Next"} & encoder.lines.keys() == {"The", "Über"}
    monkeypatch.setattr(token_files, "CACHE", 4)
    assert encoder.encode(["b other"]) and "naïve\nÜber," not in encoder.later
    learnt = []
    monkeypatch.setattr(encoder, "_spaced_ids", learnt.extend)
    monkeypatch.setattr(token_files, "CACHE", 1000)
    assert encoder.encode(texts[:1]) == want[:1] and not learnt
    # without these shortcuts the ids are the same
    plain = token_files.Encoder(queries.tokenizer_file())
    plain.by_word = False
    assert plain.encode(texts) == want and plain.lines == encoder.lines | plain.lines
    plain.by_line = False
    plain.later.clear()
    assert plain.encode(texts) == want


def test_packed_ids_are_read_by_their_bytes():
    for width in range(1, 33):
        values = np.random.default_rng(width).integers(0, 1 << width, (5, token_files.BLOCK), dtype=np.uint64).astype(np.uint32)
        values[0] = (1 << width) - 1
        assert (token_files._unpack(token_files._pack(values, width), width) == values).all()


@needs_testdata
def test_token_files_equal_the_tokenizer(spark):
    docs = sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect())
    tokenizer = token_files.Encoder(queries.tokenizer_file()).tokenizer
    start, want = 0, []
    for d, t in docs:
        ids = np.array([*tokenizer.encode(t, add_special_tokens=False).ids, 2], "<u4")
        want.append((d, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    got = queries.op10_token_files(spark, SMALL).collect()
    assert sorted((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in got) == want


# --- pipeline ---------------------------------------------------------------

@needs_testdata
def test_pipeline_keeps_what_its_stages_keep(spark):
    out = [r for r in corpus_pipeline.run(spark, MEDIUM).collect()]
    docs = spark.read.parquet(f"{MEDIUM}/documents.parquet")
    model = toxicity.fit(docs, spark.read.parquet(f"{MEDIUM}/labels.parquet"))
    clean = {r.doc_id: r.text for r in toxicity.score(docs, model).where("not toxic").collect()}
    want = {d: slow_fingerprint(t) for d, t in clean.items()}
    ids = sorted(clean)
    fps = np.array([want[d] for d in ids], np.uint64)
    near = [(ids[i], ids[j]) for i in range(len(ids)) for j in np.flatnonzero(np.bitwise_count(fps[:i] ^ fps[i]) <= 4)]
    single = set(joined(near, ids).values())
    items = decontaminate.Index([(r.item_id, r.text) for r in spark.read.parquet(f"{MEDIUM}/benchmark.parquet").collect()])
    single = [d for d, found in zip(sorted(single), items.search([clean[d] for d in sorted(single)])) if not found]
    times = {d: sum(r.doc_id == d for r in out) for d in single}
    assert {r.doc_id for r in out} <= set(single) and max(times.values()) <= 2
    words = lambda t: len(t.encode().split())
    assert sum(words(r.text) for r in out) == pytest.approx(1.5 * sum(words(clean[d]) for d in single), rel=0.01)
    assert {r.shard for r in out} == set(range(40))
    by_id = sorted((r.doc_id, r.shard) for r in out)
    assert [s for _, s in by_id] == sorted(s for _, s in by_id)


def test_shard_keys_name_null_texts(spark):
    rows = spark.createDataFrame([(1, None), (2, "é")], "doc_id bigint, text string")
    assert [(r["size"], r.text_crc32) for r in sharding.shard_keys(rows).orderBy("doc_id").collect()] == [(16, 0), (18, zlib.crc32("é".encode()))]
