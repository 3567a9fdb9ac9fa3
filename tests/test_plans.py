"""Plan shape: children are narrow (no Exchange), documents parsed once,
pruning reaches the scan."""

from unnestor import normalize
from unnestor.plans.staging import stage


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_children_do_not_shuffle_and_parse_once(spark, edge_catalog):
    docs = spark.createDataFrame([('{"_id":"a","prim":[1],"arr":[{"k":"1"}],"st":{"p":"x"}}',)], "doc string")
    staged = stage(docs, "plan_docs")
    for name, df in normalize(staged, edge_catalog, "t"):
        p = plan(df)
        assert "Exchange" not in p, name
        # a path table parses its items too, and ids of unclear kind (four kinds, each only where needed); v and v.w are two parses
        assert p.count("from_json") <= (7 if name == "t_path" else 1), (name, p)


def test_struct_paths_prune_at_scan(spark, tmp_path):
    from unnestor.operators.unnest import flatten_struct
    from pyspark.sql import types as T
    df = spark.createDataFrame([("a", ("x", "y", "z"), 1)], "k string, s struct<p:string,q:string,r:string>, n int")
    df.write.parquet(str(tmp_path / "t"))
    src = spark.read.parquet(str(tmp_path / "t"))
    out = flatten_struct(src, "k", "s", "fk", [("p", T.StringType())])
    p = plan(out)
    assert "struct<k:string,s:struct<p:string>>" in p.replace(" ", "") or "s:struct<p:string>" in p


def test_staged_fan_out_prunes_columns(spark, edge_catalog):
    import re

    from unnestor.plans.normalize import normalize_staged

    docs = spark.createDataFrame(
        [('{"_id":"a","n":1,"prim":[1],"arr":[{"k":"1"}],"st":{"p":"x","items":[{"ID":"i"}]}}',)], "doc string")
    tables = dict(normalize_staged(docs, edge_catalog, "t"))

    def read_schema(df):
        return re.search(r"ReadSchema: (struct<.*?>)(?:,|$|\n)", plan(df)).group(1)

    assert read_schema(tables["t_arr"]).startswith("struct<relationship_id:string,arr:array<map<string,string>>")
    assert "prim" not in read_schema(tables["t_arr"]) and "_path" not in read_schema(tables["t_arr"])
    path_schema = read_schema(tables["t_path"])
    assert "_path0:array<string>" in path_schema and "relationship_id" not in path_schema and "arr:" not in path_schema
