"""Skew-safe positions and bounded document pages, against brute force."""

import random

from pyspark.sql import functions as F

from unnestor.sources.tables import attach_pages, group_positions, pack_pages

from .conftest import needs_testdata


def brute(data, key_idx, order_idx):
    out = {}
    groups = {}
    for r in data:
        groups.setdefault(r[key_idx], []).append(r)
    for k, g in groups.items():
        for i, r in enumerate(sorted(g, key=lambda r: tuple(r[j] for j in order_idx))):
            out[r] = i
    return out


def test_positions_with_a_hot_key(spark):
    rnd = random.Random(7)
    data = [(0 if rnd.random() < 0.4 else rnd.randint(1, 50), rnd.randint(0, 10**6), i) for i in range(3000)]
    df = spark.createDataFrame(data, "k int, o int, u int").repartition(7)
    got = {(r.k, r.o, r.u): r.pos for r in group_positions(df, ["k"], ["o", "u"]).collect()}
    assert got == brute(data, 0, (1, 2))


def test_global_positions_and_null_keys(spark):
    data = [(None, i) for i in range(50)] + [("a", i) for i in range(30)]
    df = spark.createDataFrame(data, "k string, o int")
    got = {(r.k, r.o): r.pos for r in group_positions(df, ["k"], ["o"]).collect()}
    assert got[(None, 49)] == 49 and got[("a", 0)] == 0
    g = group_positions(df, [], ["o"]).agg(F.countDistinct("pos"), F.max("pos")).first()
    assert tuple(g) == (80, 79)


def test_pages_are_bounded_and_ordered(spark):
    data = [("hot", i) for i in range(2500)] + [("cold", i) for i in range(3)]
    df = spark.createDataFrame(data, "k string, o int")
    pages = pack_pages(df, ["k"], ["o"], F.col("o"), page_size=1000)
    got = {(r.k, r.page): r["items"] for r in pages.collect()}
    assert sorted(got) == [("cold", 0), ("hot", 0), ("hot", 1), ("hot", 2)]
    assert got[("hot", 1)] == list(range(1000, 2000)) and len(got[("hot", 2)]) == 500
    parents = spark.createDataFrame([("hot",), ("cold",), ("none",)], "pk string")
    docs = attach_pages(parents, "pk", pages, "k", "items")
    assert docs.count() == 5
    assert docs.where("pk = 'none'").first()["items"] is None


def test_exact_path_beyond_broadcast_bound(spark, monkeypatch):
    import unnestor.sources.tables as tables
    monkeypatch.setattr(tables, "MAX_BROADCAST_KEYS", 0)  # force the all-keys sort path
    data = [("hot", i) for i in range(25)] + [("cold", i) for i in range(3)]
    df = spark.createDataFrame(data, "k string, o int")
    pages = tables.pack_pages(df, ["k"], ["o"], lambda x: x["o"], page_size=10)
    got = {(r.k, r.page): r["items"] for r in pages.collect()}
    assert got == {("hot", 0): list(range(10)), ("hot", 1): list(range(10, 20)),
                   ("hot", 2): list(range(20, 25)), ("cold", 0): [0, 1, 2]}


@needs_testdata
def test_multi_page_order_documents_match_sql(spark):
    """Order documents with a page size of 3, so most orders span several
    documents; keys and values checked against the same rule in DuckDB."""
    import duckdb

    from unnestor import normalize
    from unnestor.queries.documents import LINE_ORDER, SHOP, order_documents

    sf = "/root/testdata/sf0.001"
    docs = order_documents(spark, sf, page_size=3)
    lines = dict(normalize(docs, SHOP, "shop_order"))["shop_order_lines"]
    got = sorted((r.nested_id, r.order_id, r.linenumber, r.partkey) for r in lines.collect())
    want = sorted(duckdb.sql(f"""
        SELECT l_orderkey || '-' || (rn // 3) || '_' || (rn % 3), l_orderkey || '-' || (rn // 3),
               l_linenumber, CAST(l_partkey AS INTEGER)
        FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY {', '.join(LINE_ORDER)}) - 1 AS rn
              FROM read_parquet('{sf}/lineitem.parquet'))""").fetchall())
    assert got == want
    n_docs = docs.count()
    want_docs = duckdb.sql(f"""
        SELECT count(*) FROM read_parquet('{sf}/orders.parquet') o
        LEFT JOIN (SELECT DISTINCT l_orderkey, (row_number() OVER (PARTITION BY l_orderkey ORDER BY {', '.join(LINE_ORDER)}) - 1) // 3 AS page
                   FROM read_parquet('{sf}/lineitem.parquet')) p ON p.l_orderkey = o.o_orderkey""").fetchall()[0][0]
    assert n_docs == want_docs


def test_exact_path_when_broadcast_disabled(spark):
    import unnestor.sources.tables as tables
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = spark.createDataFrame([("hot", i) for i in range(12)] + [("cold", 0)], "k string, o int")
        got = {(r.k, r.page): r["items"] for r in tables.pack_pages(df, ["k"], ["o"], F.col("o"), 5).collect()}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert got == {("hot", 0): [0, 1, 2, 3, 4], ("hot", 1): [5, 6, 7, 8, 9], ("hot", 2): [10, 11], ("cold", 0): [0]}


@needs_testdata
def test_spread_keeps_tiny_tables_whole(spark, tmp_path):
    from unnestor.sources.tables import spread
    tiny = spark.createDataFrame([(i,) for i in range(10)], "x int").coalesce(1)
    tiny.write.parquet(str(tmp_path / "tiny"))
    df = spark.read.parquet(str(tmp_path / "tiny"))
    assert spread(df).rdd.getNumPartitions() == df.rdd.getNumPartitions()
    assert spread(spark.read.parquet("/root/testdata/sf0.01/orders.parquet")).rdd.getNumPartitions() > 1


def test_parents_are_shuffled_once_for_their_pages(spark):
    from pyspark.sql import functions as F
    parents = spark.range(0, 40, 1, 8).select(F.when(F.col("id") < 38, F.col("id")).alias("pk"), (F.col("id") * 2).alias("w"))
    df = spark.range(60).select((F.col("id") % 30).alias("k"), F.col("id").alias("o"))
    pages = pack_pages(df, ["k"], ["o"], F.col("o"), page_size=5)
    docs = attach_pages(parents, "pk", pages, "k", "items")
    got = sorted(docs.collect(), key=lambda r: r.w)
    assert [(r.pk, r.w, r.page, r["items"]) for r in got] == [
        (i if i < 38 else None, i * 2, 0, [i, i + 30] if i < 30 else None) for i in range(40)]
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = attach_pages(parents, "pk", pages, "k", "items")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert "ReusedExchange [pk" in plan


def test_single_pages_are_joined_once_as_raw_rows(spark):
    """Where no key has more than one page, parents and children are read once
    each, and what is made of the items is made after the join sorted them."""
    from unnestor.sources import tables

    rows = [("a", 2, None), ("a", 1, "x"), ("b", 1, "y"), (None, 1, "z")]
    df = spark.createDataFrame(rows, "k string, o int, v string")
    parents = spark.createDataFrame([("a", 1), ("b", 2), ("b", 3), ("none", 4), (None, 5)], "pk string, w int")
    pages, single = tables.pack_rows(df, ["k"], ["o"], payload=["v"])
    assert single and not tables.pack_rows(df, ["k"], ["o"], 1)[1]
    docs = attach_pages(parents, "pk", pages, "k", "items", single).select("w", "page", F.transform("items", lambda x: F.concat_ws("-", x["o"], x["v"])).alias("items"))
    want = [(1, 0, ["1-x", "2"]), (2, 0, ["1-y"]), (3, 0, ["1-y"]), (4, 0, None), (5, 0, None)]
    assert sorted((r.w, r.page, r["items"]) for r in docs.collect()) == want
    plan = docs.select("*")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("SortMergeJoin") == 1 and "LeftAnti" not in plan
    assert "transform(items" in plan and "transform(items" not in plan[plan.index("SortMergeJoin"):]
    # several pages of a key: the raw rows are the same, without a position
    several, single = tables.pack_rows(df, ["k"], ["o"], 1, ["v"])
    assert several.schema["items"].dataType.elementType.names == ["o", "v"]
    got = attach_pages(parents, "pk", several, "k", "items", single).collect()
    assert sorted((r.w, r.page, [tuple(i) for i in r["items"] or []]) for r in got) == [
        (1, 0, [(1, "x")]), (1, 1, [(2, None)]), (2, 0, [(1, "y")]), (3, 0, [(1, "y")]), (4, 0, []), (5, 0, [])]


@needs_testdata
def test_order_documents_sort_rows_and_not_what_is_made_of_them(spark):
    from unnestor.queries.documents import order_documents

    plan = order_documents(spark, "/root/testdata/sf0.001", numbers=True, fabric=True)._jdf.queryExecution().executedPlan().toString()
    below = plan[plan.index("SortMergeJoin"):]
    assert plan.count("SortMergeJoin") == 1 and "map(" in plan and "map(" not in below and "to_json" not in below
