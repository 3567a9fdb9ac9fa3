"""Per-database load, multi-database run, quarantine."""

import pytest

from unnestor.plans.pipeline import ENTITIES, load_database, run_databases
from unnestor.sinks.tables import ParquetStore
from unnestor.sources.documents import read_envelope

from .conftest import docs_df, needs_database, needs_testdata, rows

DOCS = [
    '{"_id":"a","prim":[1,2],"arr":[{"k":"1","v":"x"}],"st":{"p":"1","items":[{"ID":"i1","v":"q"}]}}',
    '{"_id":"b","n":2}',
    '{"x":1}',
]


def test_load_database(spark, edge_catalog, tmp_path):
    store = ParquetStore(str(tmp_path / "out"))
    q = ParquetStore(str(tmp_path / "q"))
    run = load_database(docs_df(spark, DOCS), edge_catalog, "t", store, quarantine=q)
    by = {r.table: r for r in run.tables}
    assert list(by) == ["t", "t_prim", "t_arr", "t_st", "t_path"]
    assert all(r.status == "ok" for r in run.tables)
    assert by["t"].loaded == 2 and by["t"].rejected == 1  # document without _id set aside
    assert by["t_prim"].loaded == 2 and by["t_path"].loaded == 1
    main = store.read(spark, "t")
    assert set(main.columns) >= {"relationship_id", "m", "prim"}
    assert main.where("relationship_id = 'b'").first()["m"] == "{}"


def test_permissive_run_quarantines_documents(spark, edge_catalog, tmp_path):
    store, q = ParquetStore(str(tmp_path / "o")), ParquetStore(str(tmp_path / "q"))
    docs = docs_df(spark, ['{"_id":"a","n":"bad"}', '{"_id":"b","n":1}'])
    run = load_database(docs, edge_catalog, "t", store, mode="permissive", quarantine=q)
    assert run.rejected_documents == 1
    assert q.read(spark, "t__documents_rejected").count() == 1
    assert store.read(spark, "t").count() == 2


def test_run_databases(spark, edge_catalog, tmp_path):
    p = tmp_path / "dump.txt"
    p.write_text("\n".join(DOCS))
    store = ParquetStore(str(tmp_path / "o"))
    runs = run_databases(spark, {"things": str(p)}, edge_catalog, store, bindings={"things": "t"})
    assert runs[0].database == "t"
    with pytest.raises(ValueError):
        run_databases(spark, {"nope": str(p)}, edge_catalog, store, bindings={"things": "t"})
    assert set(ENTITIES) == {"user", "company", "order", "orderline-steps"}


def test_command_line(spark, tmp_path):
    from tests.conftest import EDGE_LAYOUT
    from unnestor.__main__ import main

    (tmp_path / "schema").mkdir()
    (tmp_path / "schema" / "t.yml").write_text(EDGE_LAYOUT)
    dump = tmp_path / "d.txt"
    dump.write_text("\n".join(DOCS))
    rc = main(["--schema-dir", str(tmp_path / "schema"), "--dump", f"things={dump}", "--bind", "things=t",
               "--parquet", str(tmp_path / "out"), "--quarantine", str(tmp_path / "q")])
    assert rc == 0
    assert spark.read.parquet(str(tmp_path / "out" / "t_prim")).count() == 2


def test_command_line_keeps_going(spark, tmp_path, capsys):
    import json

    from tests.conftest import EDGE_LAYOUT
    from unnestor.__main__ import main

    (tmp_path / "schema").mkdir()
    (tmp_path / "schema" / "t.yml").write_text(EDGE_LAYOUT)
    good, bad = tmp_path / "good.txt", tmp_path / "bad.txt"
    good.write_text("\n".join(DOCS[:2]))
    bad.write_text('{"_id":')
    args = ["--schema-dir", str(tmp_path / "schema"), "--dump", f"a={bad}", "--dump", f"b={good}", "--bind", "a=t", "--bind", "b=t",
            "--parquet", str(tmp_path / "out"), "--parallel", "2", "--keep-going", "--buckets", "3", "--verify", "content"]
    assert main(args) == 1
    said = [json.loads(line) for line in capsys.readouterr().out.splitlines() if line.startswith("{")]
    assert said[0]["status"] == "failed" and [x["status"] for x in said[1:]] == ["ok"] * 5
    assert ParquetStore(str(tmp_path / "out")).read(spark, "t_prim").count() == 2
    assert list((tmp_path / "out" / "t").glob("_bucket_of_3=*"))


def test_standalone_path_table_load(spark, edge_catalog, tmp_path, monkeypatch):
    import unnestor.plans.pipeline as P
    monkeypatch.setitem(P.STANDALONE_PATH_TABLES, "items_only", "t_path")
    p = tmp_path / "dump.txt"
    p.write_text("\n".join(DOCS))
    runs = run_databases(spark, {"items_only": str(p)}, edge_catalog, ParquetStore(str(tmp_path / "o")),
                         bindings={})
    assert runs[0].tables[0].loaded == 1 and runs[0].tables[0].status == "ok"


def test_document_versions_resolved_once(spark, edge_catalog, tmp_path):
    """Two versions of one document: the later one (by ``n``) supplies the
    main row and all its children; nothing of the earlier one remains."""
    docs = docs_df(spark, ['{"_id":"a","n":1,"prim":[1,2,3],"m":{"k":"v"}}',
                           '{"_id":"a","n":2,"prim":[9]}',
                           '{"_id":"b","n":5}'])
    store = ParquetStore(str(tmp_path / "o"))
    run = load_database(docs, edge_catalog, "t", store, order_by="n")
    assert all(r.status == "ok" for r in run.tables)
    from .conftest import needs_database, rows
    assert rows(store.read(spark, "t").select("relationship_id", "n")) == [("a", 2), ("b", 5)]
    assert rows(store.read(spark, "t_prim")) == [("a_0", "a", 9)]


def test_keyless_documents_are_not_merged(spark, edge_catalog, tmp_path):
    docs = docs_df(spark, ['{"x":1}', '{"x":1}', '{"_id":""}', '{"_id":"a","n":1}', '{"_id":"a","n":2}'])
    store = ParquetStore(str(tmp_path / "o"))
    run = load_database(docs, edge_catalog, "t", store, order_by="n")
    main = next(r for r in run.tables if r.table == "t")
    assert (main.loaded, main.rejected) == (1, 3)


@needs_testdata
def test_load_of_multi_page_documents_matches_sql(spark, tmp_path):
    import duckdb

    from unnestor.queries.documents import LINE_ORDER, SHOP, order_documents

    sf = "/root/testdata/sf0.001"
    store = ParquetStore(str(tmp_path / "o"))
    run = load_database(order_documents(spark, sf, numbers=True, fabric=True, page_size=3), SHOP,
                        "shop_order", store)
    assert all(r.status == "ok" and r.rejected == 0 for r in run.tables)
    got = sorted(tuple(r) for r in store.read(spark, "shop_order_lines")
                 .select("nested_id", "order_id", "linenumber").collect())
    want = sorted(duckdb.sql(f"""
        SELECT l_orderkey || '-' || (rn // 3) || '_' || (rn % 3), l_orderkey || '-' || (rn // 3), l_linenumber
        FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY {', '.join(LINE_ORDER)}) - 1 AS rn
              FROM read_parquet('{sf}/lineitem.parquet'))""").fetchall())
    assert got == want


@needs_database
def test_command_line_jdbc(spark, tmp_path):
    from tests.conftest import EDGE_LAYOUT
    from unnestor.__main__ import main

    (tmp_path / "schema").mkdir()
    (tmp_path / "schema" / "t.yml").write_text(EDGE_LAYOUT)
    dump = tmp_path / "d.txt"
    dump.write_text("\n".join(DOCS))
    rc = main(["--schema-dir", str(tmp_path / "schema"), "--dump", f"things={dump}", "--bind", "things=t",
               "--jdbc-url", "jdbc:derby:memory:unnestor_cli;create=true",
               "--jdbc-property", "driver=org.apache.derby.iapi.jdbc.AutoloadedDriver"])
    assert rc == 1  # the document without a key is set aside with nowhere to keep it


def test_versions_by_stored_key_and_unknown_order(spark, edge_catalog, tmp_path):
    from unnestor.plans.catalog import CatalogError

    docs = docs_df(spark, ['{"_id":"a","n":1,"prim":[1,2]}', '{"_id":"a\\u0000","n":2,"prim":[7]}', '{"_id":"  ","n":3}'])
    store = ParquetStore(str(tmp_path / "s"))
    load_database(docs, edge_catalog, "t", store, order_by="n")
    assert rows(store.read(spark, "t"), "relationship_id", "n") == sorted([("  ", 3), ("a", 2)], key=repr)
    assert rows(store.read(spark, "t_prim"), "value") == [(7,)]
    with pytest.raises(CatalogError):
        load_database(docs, edge_catalog, "t", store, order_by="nn")


def test_unreadable_envelopes_are_quarantined(spark, edge_catalog, tmp_path):
    d = tmp_path / "dump"
    d.mkdir()
    (d / "a.json").write_text('{"rows":[{"id":"a","doc":{"_id":"a","n":1}},\n{"id":"z","doc":null}]}')
    cut = '{"rows":[{"id":"b","doc":{"_id":"b","n":1}},{"id":"c","doc":{"_id":'
    (d / "b.json").write_text(cut)
    (d / "c.json").write_text('{"other":1}')
    q = ParquetStore(str(tmp_path / "q"))
    store = ParquetStore(str(tmp_path / "o"))
    run = run_databases(spark, {"things": str(d)}, edge_catalog, store, bindings={"things": "t"}, layout="envelope",
                        mode="permissive", quarantine=q)[0]
    assert run.rejected_documents == 2
    kept = {r["doc"].rsplit("/", 1)[1]: r["_reject_reason"] for r in q.read(spark, "things__envelopes_rejected").collect()}
    assert kept == {"b.json": "envelope is cut short", "c.json": "not an envelope"}
    # the row that ends before the cut is read
    assert sorted(r["relationship_id"] for r in store.read(spark, "t").collect()) == ["a", "b"]
    with pytest.raises(ValueError, match="cut short|not an envelope"):
        read_envelope(spark, str(d))


def test_databases_report_their_own_failure(spark, edge_catalog, tmp_path):
    good, bad = tmp_path / "good.txt", tmp_path / "bad.txt"
    good.write_text("\n".join(DOCS[:2]))
    bad.write_text('{"_id":"a"')
    dumps, bind = {"one": str(bad), "two": str(good)}, {"one": "t", "two": "t"}
    for parallel in (1, 2):
        store = ParquetStore(str(tmp_path / f"o{parallel}"))
        runs = run_databases(spark, dumps, edge_catalog, store, bind, parallel=parallel, on_error="report")
        assert [r.status for r in runs] == ["failed", "ok"] and "not a JSON object" in runs[0].error
    with pytest.raises(Exception, match="not a JSON object"):
        run_databases(spark, dumps, edge_catalog, ParquetStore(str(tmp_path / "x")), bind)
    assert not (tmp_path / "x" / "t").exists()  # one after another, the failure stops the rest


def test_tables_load_at_the_same_time(spark, edge_catalog, tmp_path):
    one, many = ParquetStore(str(tmp_path / "one")), ParquetStore(str(tmp_path / "many"))
    runs = [load_database(docs_df(spark, DOCS), edge_catalog, "t", s, parallel=n) for s, n in ((one, 1), (many, 5))]
    assert runs[0] == runs[1]
    for r in runs[0].tables:
        assert rows(one.read(spark, r.table)) == rows(many.read(spark, r.table))


@pytest.mark.parametrize("buckets", [None, 1, 7])
def test_upsert_replaces_children_by_document(spark, edge_catalog, tmp_path, buckets):
    def doc(i, n, prim, items):
        return f'{{"_id":"{i}","n":{n},"prim":{prim},"arr":[{{"k":"{n}"}}],"st":{{"p":"{n}","items":{items}}}}}'

    store = ParquetStore(str(tmp_path / "o"), buckets=buckets)
    first = [doc(f"d_{i}", i, [1, 2, 3], '[{"ID":"x_1"},{"ID":"y"}]') for i in range(20)] + [doc("d", 99, [4], "[]"), doc("1", 98, [5], "[]")]
    load_database(docs_df(spark, first), edge_catalog, "t", store)
    # one loses children, one all of them, one comes anew; keys that begin another stay apart
    load_database(docs_df(spark, [doc("d_1", 50, [7], '[{"ID":"z"}]'), '{"_id":"d_2","n":51}', doc("new", 52, [8], "[]")]), edge_catalog, "t", store, load_mode="upsert")
    got = {n: store.read(spark, n).collect() for n in ("t", "t_prim", "t_arr", "t_st", "t_path")}
    assert {r.relationship_id: r.n for r in got["t"]} == {**{f"d_{i}": i for i in range(20)}, "d": 99, "1": 98, "d_1": 50, "d_2": 51, "new": 52}
    prim = {}
    for r in got["t_prim"]:
        prim.setdefault(r.t_id, []).append(r.value)
    assert {k: sorted(v) for k, v in prim.items()} == {**{f"d_{i}": [1, 2, 3] for i in range(20) if i != 2}, "d_1": [7], "d": [4], "1": [5], "new": [8]}
    assert len(got["t_st"]) == 23 and len(got["t_arr"]) == 22
    assert sorted(r.nested_id for r in got["t_path"] if "d%5F1_" in r.nested_id) == ["t_path_z_d%5F1_0"]
    assert len(got["t_path"]) == 2 * 18 + 1


def test_upsert_empties_a_bucket(spark, edge_catalog, tmp_path):
    """All children of a bucket go, and its folder with them."""
    store = ParquetStore(str(tmp_path / "o"), buckets=64)
    load_database(docs_df(spark, ['{"_id":"a","prim":[1]}', '{"_id":"b","prim":[2]}']), edge_catalog, "t", store)
    load_database(docs_df(spark, ['{"_id":"a","prim":[]}']), edge_catalog, "t", store, load_mode="upsert")
    assert rows(store.read(spark, "t_prim")) == [("b_0", "b", 2)]


def test_versions_move_no_document_where_keys_are_unique(spark, edge_catalog, tmp_path):
    from pyspark.sql import functions as F

    from unnestor.operators.upsert import superseded, without_rows
    df = spark.range(50).select(F.col("id").cast("string").alias("k"), F.col("id").alias("row"), F.lit("payload").alias("p"))
    lost, _ = superseded(df, F.col("k"), "row", "row")
    out = without_rows(df, lost, "row")
    assert lost.count() == 0 and out is df
    many = df.unionByName(df.withColumn("row", F.col("row") + 100)).unionByName(df.where("k is null"))
    lost, _ = superseded(many, F.col("k"), "row", "row")
    left = without_rows(many, lost, "row")
    assert rows(left, "k", "row") == sorted(((str(i), i + 100) for i in range(50)), key=repr)
    plan = left._jdf.queryExecution().toString()
    assert "BroadcastHashJoin" in plan and "Sort " not in plan


def test_owners_that_arrive_are_measured_once(spark, edge_catalog, tmp_path, monkeypatch):
    """For every table of the tree: their size, and the buckets that they touch."""
    from unnestor.sinks import tables

    store = ParquetStore(str(tmp_path), buckets=2)
    load_database(docs_df(spark, ['{"_id":"a","prim":[1,2]}', '{"_id":"b","prim":[3]}']), edge_catalog, "t", store)
    sizes, buckets, measure, of = [], [], tables.measure, tables.bucket_of
    monkeypatch.setattr(tables, "measure", lambda df, columns: (sizes.append(columns), measure(df, columns))[1])
    monkeypatch.setattr(tables, "bucket_of", lambda key, n: (buckets.append(n), of(key, n))[1])
    run = load_database(docs_df(spark, ['{"_id":"b","prim":[4,5]}']), edge_catalog, "t", store, load_mode="upsert")
    assert [t.status for t in run.tables] == ["ok"] * 5 and sizes == [["_key"]]
    assert len(buckets) == 6  # the five tables' own rows, and the owners once
    assert rows(store.read(spark, "t_prim"), "id", "value") == [("a_0", 1), ("a_1", 2), ("b_0", 4), ("b_1", 5)]


def test_versions_of_unique_keys_are_not_ranked(spark, monkeypatch):
    """Only rows of keys that repeat are ranked: of unique keys, nothing but the keys is grouped."""
    from pyspark.sql import functions as F

    from unnestor.operators import upsert

    staged, stage_at = [], upsert.stage_at
    monkeypatch.setattr(upsert, "stage_at", lambda df, name: (staged.append((name, df._jdf.queryExecution().executedPlan().toString())), stage_at(df, name))[1])
    df = spark.createDataFrame([("a", 1, 10), ("b", 1, 11), (None, 1, 12), (None, 2, 13)], "k string, o int, i long")
    assert upsert.superseded(df, F.col("k"), "i", "o")[0].count() == 0
    assert [n for n, _ in staged] == ["repeated", "superseded"] and not any("max(" in p for _, p in staged)
    more = df.unionByName(spark.createDataFrame([("a", 3, 14), ("a", 2, 15), ("b", None, 16)], df.schema))
    assert rows(upsert.superseded(more, F.col("k"), "i", "o")[0]) == [(10,), (15,), (16,)]
