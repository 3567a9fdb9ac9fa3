"""Prefix trie, collocations and personal data against brute force."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tests.conftest import TESTDATA, needs_testdata
from unnestor.llm import collocations, personal_data, prefix_trie

TURNS = "conv_id bigint, turn bigint, role string, text string"
DOCS = "doc_id bigint, text string, lang string"


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


# --- prefix trie ------------------------------------------------------------

def trie_by_hand(rows):
    convs = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            convs[c].append(((turn is not None, turn or 0), role or "", text or ""))
    own = {c: [(role, text) for _, role, text in sorted(v)] for c, v in convs.items()}
    rebuilt = {}
    for c, s in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        rebuilt[c] = own.get(c - int(math.fmod(c, 20)), [])[:h] + s[h:]
    members, below = defaultdict(list), defaultdict(list)
    for c, s in rebuilt.items():
        for d in range(len(s) + 1):
            members[tuple(s[:d])].append(c)
    for p in members:
        if p:
            below[p[:-1]].append(p)
    leaves, saved, out = {}, {}, []
    for p in sorted(members, key=len, reverse=True):
        leaves[p] = sum(leaves[k] for k in below[p]) or 1
        n_words = len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) if p else 0
        saved[p] = (len(members[p]) - 1) * n_words + sum(saved[k] for k in below[p])
    for p, m in members.items():
        ends = ",".join(str(c) for c in sorted(c for c in m if len(rebuilt[c]) == len(p)))
        out.append((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), len(below[p]), leaves[p], saved[p],
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def random_turns(n):
    rng = random.Random(1)
    return [(rng.choice([None, *range(-3, 45)]), rng.choice([None, 0, 1, 2, 3]), rng.choice([None, "u", "a"]),
             rng.choice([None, "", "x y", "z", "w " * 2000])) for _ in range(n)]


def test_trie_of_random_turns(spark, monkeypatch):
    turns = random_turns(500)
    df = spark.createDataFrame(turns, TURNS)
    want = trie_by_hand(turns)
    # clashing names, and rows in other partitions
    assert rows_of(prefix_trie.prefix_trie(df.withColumn("depth", F.lit(1)).withColumn("d1", F.lit("x")).repartition(5))) == want
    monkeypatch.setattr(prefix_trie, "BLOCK", 3)
    monkeypatch.setattr(prefix_trie, "PIECE", 2)
    assert rows_of(prefix_trie.prefix_trie(df)) == want


def test_trie_when_the_sketch_proves_nothing(spark, monkeypatch):
    """A sketch in which every cell is full: all prefixes are grouped exactly."""
    turns = [(c, t, "u", f"{c % 5} {t}" if t < 2 else f"{c} {t}") for c in range(300) for t in range(4)]
    df = spark.createDataFrame(turns, TURNS)
    monkeypatch.setattr(prefix_trie, "shared_cells", lambda prefixes, width: prefix_trie.np.full(4 * width // 8, 255, prefix_trie.np.uint8))
    assert rows_of(prefix_trie.prefix_trie(df)) == trie_by_hand(turns)


def test_trie_when_the_sketch_is_often_wrong(spark, monkeypatch):
    """Many cells of others are full: lone prefixes count as shared, also such
    as follow a proven tail, and none is lost."""
    turns = [(c, t, "u", f"{c % 5} {t}" if t < 2 else f"{c} {t}") for c in range(300) for t in range(c % 7)]
    exact = prefix_trie.shared_cells

    def overfull(prefixes, width):
        bits = exact(prefixes, width)
        return bits | prefix_trie.np.random.default_rng(1).integers(0, 256, len(bits), prefix_trie.np.uint8) | prefix_trie.np.uint8(0x5A)

    monkeypatch.setattr(prefix_trie, "shared_cells", overfull)
    assert rows_of(prefix_trie.prefix_trie(spark.createDataFrame(turns, TURNS))) == trie_by_hand(turns)


def test_trie_of_one_long_conversation(spark):
    """Two copies of a conversation that hold two thirds of the rows, over a block's length."""
    turns = [(c, t, "u", f"{t % 9} word") for c in (40, 41) for t in range(1500)] + [(c, 0, "u", "hello") for c in range(60, 900)]
    got = rows_of(prefix_trie.prefix_trie(spark.createDataFrame(turns, TURNS).repartition(8)))
    assert got == trie_by_hand(turns)


def test_trie_edges(spark):
    empty = prefix_trie.prefix_trie(spark.createDataFrame([], TURNS))
    assert empty.count() == 0 and empty.columns[:2] == ["conv_id", "depth"]
    for turns in ([(5, 1, "u", "a b")], [(None, 1, "u", "a")], [(3, 0, None, None)] * 3):
        assert rows_of(prefix_trie.prefix_trie(spark.createDataFrame(turns, TURNS))) == trie_by_hand(turns)


@needs_testdata
def test_trie_of_the_table(spark):
    df = spark.read.parquet(f"{TESTDATA}/sf0.01/conversations.parquet")
    want = trie_by_hand([tuple(r) for r in df.select("conv_id", "turn", "role", "text").collect()])
    assert rows_of(prefix_trie.prefix_trie(df)) == want


def test_sketch_never_estimates_too_little(spark):
    """Every prefix that occurs twice has all its cells over one."""
    df = spark.range(4000).select((F.col("id") % 2500).alias("d1")).select(
        F.lit(1).cast("bigint").alias("depth"), F.xxhash64("d1").alias("d1"), F.xxhash64("d1", F.lit(2)).alias("d2")).repartition(7)
    width = 1 << 14
    bits = prefix_trie.shared_cells(df, width)
    import numpy as np
    n = Counter((r.d1, r.d2) for r in df.collect())
    cells = lambda keys: prefix_trie._cells(np.ones(len(keys), np.int64), *np.array(keys, np.int64).T.copy(), width)
    over = lambda keys: ((bits[cells(keys) >> 3] >> (7 - (cells(keys) & 7))) & 1).all(axis=0)
    assert over([k for k in n if n[k] > 1]).all()
    assert over([k for k in n if n[k] == 1]).mean() < 0.05


# --- collocations -----------------------------------------------------------

def collocations_by_hand(rows, support=30, top=2000):
    counts, totals = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")):
            w = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(w)
            for k in range(1, 5):
                counts[lang].update(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, c in counts.items():
        found = {p: a for p, a in c.items() if len(p) > 1 and a >= support}
        inside = {p[i : i + k] for p, a in found.items() for k in range(2, len(p)) for i in range(len(p) - k + 1) if 100 * a >= 80 * c[p[i : i + k]]}
        rows = []
        for p, a in found.items():
            if p not in inside:
                score, k = min((2_000_000 * a // (c[p[:k]] + c[p[k:]]), k) for k in range(1, len(p)))
                rows.append((-score, -a, " ".join(p).encode(), c[p[:k]], c[p[k:]]))
        out += [(lang, i, p.decode(), -a, left, right, totals[lang], -s) for i, (s, a, p, left, right) in enumerate(sorted(rows)[:top], 1)]
    return sorted(out, key=repr)


def random_texts(n):
    rng = random.Random(1)
    texts = [None, "", ". ! ?", *[" ".join(rng.choice(["A", "b", "ç", "d.", "e,", "x\x1cy", "\t", "É\n"]) for _ in range(rng.randrange(60))) for _ in range(20)]]
    return [(i % 90, rng.choice(texts), rng.choice([None, "en", "und", "", "de"])) for i in range(n)]


def test_collocations_of_random_texts(spark, monkeypatch):
    rows = random_texts(400)
    df = spark.createDataFrame(rows, DOCS).withColumn("phrase", F.lit("x")).withColumn("n", F.lit(1)).repartition(9)
    assert rows_of(collocations.collocations(df)) == collocations_by_hand([r[1:] for r in rows])
    # chunks, long texts, several groups of hashes
    for name, value in (("CHUNK", 500), ("SEGMENT", 64), ("GROUP", 1000), ("MERGED", 4)):
        monkeypatch.setattr(collocations, name, value)
    assert rows_of(collocations.collocations(df, 5, 50)) == collocations_by_hand([r[1:] for r in rows], 5, 50)


def test_collocations_spread_thinly(spark):
    """A phrase that no partition holds more often than once or twice is found."""
    rows = [(i, f"filler{i} strong tea word{i}", "en") for i in range(30)] + [(i, f"weak{i % 29} tea{i % 29}", "en") for i in range(29 * 29)]
    df = spark.createDataFrame(rows, DOCS).repartition(30)
    got = rows_of(collocations.collocations(df))
    assert got == collocations_by_hand([r[1:] for r in rows]) and [r[2] for r in got] == ["strong tea"]


def test_collocations_of_empty_tables(spark):
    for rows in ([], [(1, None, None)], [(1, "!!!", "en")]):
        assert collocations.collocations(spark.createDataFrame(rows, DOCS)).count() == 0


def test_local_support_misses_nothing():
    for support in (1, 2, 29, 30, 31, 1000):
        least = collocations.local_support(support)
        assert collocations.SHARDS * (least - 1) < support


@needs_testdata
def test_collocations_of_the_table(spark):
    df = spark.read.parquet(f"{TESTDATA}/sf0.01/documents.parquet")
    assert rows_of(collocations.collocations(df)) == collocations_by_hand([tuple(r) for r in df.select("text", "lang").collect()])


# --- personal data ----------------------------------------------------------

# Fixed patterns of the base spans, in their plain form
PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def passes(kind, said):
    digits = re.sub("[^0-9]", "", said)
    if kind == "ip":
        return all(int(p) <= 255 for p in said.split("."))
    if kind == "card":
        doubled = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
        return 13 <= len(digits) <= 19 and sum(d - 9 if d > 9 else d for d in doubled) % 10 == 0
    return kind == "email" or 9 <= len(digits) <= 15


def base_spans(text):
    return [f"{k}:{m.start()}:{m.end()}" for k, p in PLAIN.items() for m in re.finditer(p, text or "") if passes(k, m[0])]


def check_base(df):
    got = personal_data.personal_data(df).collect()
    want = []
    for r in df.select("doc_id", "text").collect():
        base = base_spans(r.text)
        want.append((r.doc_id, *[sum(s.startswith(k + ":") for s in base) for k in PLAIN], hashlib.sha256(",".join(base).encode()).hexdigest()))
    assert sorted((tuple(r[:6]) for r in got), key=repr) == sorted(want, key=repr)
    return got


def test_base_spans_of_random_texts(spark):
    rng = random.Random(1)
    parts = ["1", "23", "4539 1488 0343 6467", "4539148803436467", "+", "+1 (743) 555-3824", "a.b+c@d-e.f.g", "@", "_", ".", "192.168.1.255", "300.1.1.1",
             "0001.2.3.4", "1.2.3.4.5.6.7.8", " ", "-", "é", "😀", "\n", "x@y", "%", "(743) 555-3824", "bob (at) mail (dot) com"]
    rows = [(None if i % 40 == 0 else i % 700, rng.choice([None, ""]) if i % 50 == 0 else "".join(rng.choice(parts) for _ in range(rng.randrange(30)))) for i in range(1500)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("row", F.lit("x")).withColumn("kind", F.lit(1)).repartition(5)
    for r in check_base(df):
        spans = r.spans.split(",") if r.spans else []
        order = [(list(PLAIN).index(s.split(":")[0]), int(s.split(":")[1])) for s in spans]
        assert order == sorted(order)


def test_contexts_find_other_writings(spark):
    rng = random.Random(2)

    def number():
        return f"({rng.randrange(200, 999)}) 555-{rng.randrange(1000, 9999)}"

    rows = [(i, f"some words {rng.random()} telephone number +1 {number()} thanks") for i in range(100)]
    rows += [(1000 + i, f"other text telephone number {number()} thanks") for i in range(20)]
    rows += [(2000 + i, f"the order {number()} came") for i in range(5)] + [(3000, "(743) 555-3824"), (3001, "")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = {r.doc_id: r.spans for r in check_base(df)}
    assert all(found[1000 + i] == "phone:28:42" for i in range(20))
    assert not any(found[2000 + i] for i in range(5)) and found[3000] == found[3001] == ""


def test_copies_teach_a_pattern_nothing(spark):
    """One number in a thousand copies is one value."""
    rows = [(i, "ticket number +1 (743) 555-3824 end") for i in range(1000)] + [(5000, "ticket number (212) 555-1234 end")]
    found = {r.doc_id: r.spans for r in personal_data.personal_data(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert found[5000] == "" and found[0] == "phone:14:31"


def test_long_texts_take_time_in_proportion(spark):
    rows = [(1, "a" * 2_000_000 + "@" + "b" * 500_000), (2, "1" * 2_000_000), (3, "+1" + "(" * 2_000_000), (4, "1." * 100_000), (5, "me@x.y " * 20_000)]
    check_base(spark.createDataFrame(rows[3:], "doc_id bigint, text string"))
    got = personal_data.personal_data(spark.createDataFrame(rows[:3], "doc_id bigint, text string")).collect()
    assert [r.spans for r in got] == ["", "", ""]


def test_personal_data_of_an_empty_table(spark):
    assert personal_data.personal_data(spark.createDataFrame([], "doc_id bigint, text string")).count() == 0


@needs_testdata
def test_base_spans_of_the_table(spark):
    check_base(spark.read.parquet(f"{TESTDATA}/sf0.01/documents.parquet"))


@pytest.mark.parametrize("text", ["4465758382889437", "0.0.0.0", "1 2 3", "+1-2", "a@b.c"])
def test_passes_agrees(spark, text):
    check_base(spark.createDataFrame([(1, text)], "doc_id bigint, text string"))
