"""C5 along paths."""

from unnestor import Catalog
from unnestor.operators.drift import declared_paths, path_drift, path_kinds, paths_of

from .conftest import docs_df, rows


def test_shapes_are_taken_apart():
    assert paths_of("OBJECT<a: BIGINT, `b c`: OBJECT<e: ARRAY<VOID>, x: ARRAY<OBJECT<y: VARIANT, z: VOID>>>, `d:<>, `: BOOLEAN>") == {
        "a": "BIGINT", "b c": "OBJECT", "b c.e": "ARRAY", "b c.e[]": "VOID", "b c.x": "ARRAY", "b c.x[]": "OBJECT",
        "b c.x[].y": "MIXED", "b c.x[].z": "VOID", "d:<>, ": "BOOLEAN"}
    assert paths_of("OBJECT<>") == {} and paths_of("BIGINT") == {}
    assert paths_of("OBJECT<g: DECIMAL(20,0), h: OBJECT<>, i: ARRAY<ARRAY<STRING>>>") == {
        "g": "DECIMAL", "h": "OBJECT", "i": "ARRAY", "i[]": "ARRAY", "i[][]": "STRING"}
    assert paths_of("OBJECT<`a``b.c`: STRING>") == {"`a`b.c`": "STRING"}


def test_kinds_along_paths(spark):
    docs = docs_df(spark, ['{"a":1,"b":[{"c":"x"}]}'] * 3 + ['{"a":"s","b":[{"c":1},{"c":"y"}]}', '{"a":1', '{"a":1,"a":2}', None])
    assert rows(path_kinds(docs)) == sorted([
        ("a", "BIGINT", 3), ("a", "STRING", 1), ("b", "ARRAY", 4), ("b[]", "OBJECT", 4), ("b[].c", "STRING", 3), ("b[].c", "MIXED", 1),
        ("", "UNREADABLE", 2)], key=repr)


def test_drift_of_nested_layouts(spark, edge_catalog):
    assert declared_paths(edge_catalog, "t") == {
        "_id": "string", "n": "integer", "f": "float", "ts": "timestamp", "b": "boolean", "m": "map<string,string>", "prim": "array<integer>",
        "arr": "array<map<string,string>>", "st": "struct", "st.p": "string", "st.q": "string", "st.items": "string", "arr[].k": "integer", "arr[].v": "string",
        "st.items[].v": "string", "st.items[].v.w": "string", "st.items[].ID": "string"}
    docs = docs_df(spark, [
        '{"_id":"a","n":1,"f":2,"ts":"2020-01-01","b":true,"m":{"x":{"y":1}},"prim":[1],"arr":[{"k":"7","v":"x","z":1}],"st":{"p":"1","r":2,"items":[{"ID":1,"v":{"w":1}}]}}',
        '{"_id":"b","n":"1","f":"x","ts":5,"b":"t","m":[1],"prim":{"a":1},"arr":null,"st":"text"}'])
    got = {(r.path, r.kind): r.status for r in path_drift(docs, edge_catalog, "t").collect()}
    assert got == {
        ("_id", "STRING"): "ok", ("n", "BIGINT"): "ok", ("n", "STRING"): "type", ("f", "BIGINT"): "ok", ("f", "STRING"): "ok", ("ts", "STRING"): "ok",
        ("ts", "BIGINT"): "type", ("b", "BOOLEAN"): "ok", ("b", "STRING"): "type", ("m", "OBJECT"): "ok", ("m.x", "OBJECT"): "ok", ("m.x.y", "BIGINT"): "ok",
        ("m", "ARRAY"): "type", ("m[]", "BIGINT"): "ok", ("prim", "ARRAY"): "ok", ("prim[]", "BIGINT"): "ok", ("prim", "OBJECT"): "type", ("prim.a", "BIGINT"): "ok",
        ("arr", "ARRAY"): "ok", ("arr", "VOID"): "ok", ("arr[]", "OBJECT"): "ok", ("arr[].k", "STRING"): "type", ("arr[].v", "STRING"): "ok", ("arr[].z", "BIGINT"): "ok",
        ("st", "OBJECT"): "ok", ("st", "STRING"): "type", ("st.p", "STRING"): "ok", ("st.r", "BIGINT"): "extra", ("st.items", "ARRAY"): "ok", ("st.items[]", "OBJECT"): "ok",
        ("st.items[].ID", "BIGINT"): "ok", ("st.items[].v", "OBJECT"): "ok", ("st.items[].v.w", "BIGINT"): "ok", ("st.q", None): "missing"}


def test_drift_without_documents(spark):
    cat = Catalog.from_dict({"m": {"fields": [{"name": "relationship_id", "source_field": "_id"}, {"name": "x"}]}})
    got = rows(path_drift(spark.createDataFrame([], "doc string"), cat, "m"), "path", "kind", "status")
    assert got == sorted([("_id", None, "missing"), ("x", None, "missing")], key=repr)
