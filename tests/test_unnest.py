"""G1-G6 with F1-F6 and P1-P10 on the FIXTURES edge-case documents."""

from pyspark.sql import types as T

from unnestor import normalize
from unnestor.operators.unnest import extract_path_items, flatten_struct, unnest_records, unnest_values

from .conftest import docs_df, rows

DOCS = [
    '{"_id":"a","prim":[1,null,2]}',
    '{"_id":"b","prim":[]}',
    '{"_id":"c"}',
    '{"_id":"d","arr":[null,{"k":"7","v":"x","extra":"1"},{"v":"y"}]}',
    '{"_id":"e","arr":[{"k":"abc"}]}',
    '{"_id":"g"}',
    '{"_id":"h","f":5}',
    '{"_id":"i","f":"2.5"}',
    '{"x":1}',
    None,
    '{"_id":"l","st":null}',
    '{"_id":"m","st":{"items":"text"}}',
    '{"_id":"n","st":{"items":{"ID":"z"}}}',
    '{"_id":"o","st":{"items":[5,{"ID":""},{"v":"noid"},{"ID":0},{"ID":"z","v":{"w":1}},{"ID":"0"},{"ID":false},{"ID":[]},{"ID":2.5}]}}',
]


def tables(spark, cat):
    return dict(normalize(docs_df(spark, DOCS), cat, "t"))


def test_tree_order_and_names(spark, edge_catalog):
    assert [n for n, _ in normalize(docs_df(spark, DOCS), edge_catalog, "t")] == [
        "t", "t_prim", "t_arr", "t_st", "t_path"
    ]


def test_main_table_keeps_nested_columns_and_renames_id(spark, edge_catalog):
    main = tables(spark, edge_catalog)["t"]
    assert main.columns == ["relationship_id", "n", "f", "ts", "b", "m", "prim", "arr", "st"]
    got = dict(rows(main.select("relationship_id", "f")))
    assert got["h"] == 5.0 and got["i"] == 2.5
    assert None in got  # document without _id: key null, row kept (set aside at the sink)
    assert main.count() == 13  # null document dropped


def test_primitive_keeps_null_elements(spark, edge_catalog):
    t = tables(spark, edge_catalog)["t_prim"]
    assert t.columns == ["id", "t_id", "value"]
    assert rows(t) == sorted([("a_0", "a", 1), ("a_1", "a", None), ("a_2", "a", 2)], key=repr)


def test_records_drop_null_elements_keep_positions(spark, edge_catalog):
    t = tables(spark, edge_catalog)["t_arr"]
    assert t.columns == ["nested_id", "t_id", "k", "v"]
    assert rows(t) == sorted([("d_1", "d", 7, "x"), ("d_2", "d", None, "y"), ("e_0", "e", None, None)], key=repr)


def test_single_struct_one_row_per_parent(spark, edge_catalog):
    t = tables(spark, edge_catalog)["t_st"]
    assert t.count() == 13
    assert ("g_st", "g", None, None) in rows(t)


def test_path_extraction_filters(spark, edge_catalog):
    t = tables(spark, edge_catalog)["t_path"]
    assert t.columns == ["nested_id", "id", "parent_id", "v", "deep"]
    got = rows(t)
    assert [r[2] for r in got] == sorted(["z", "0", "2.5"], key=repr)
    z = next(r for r in got if r[2] == "z")
    assert z == ("t_path_z_o_4", "footprint_o_4", "z", '{"w":1}', "1")
    zero = next(r for r in got if r[2] == "0")
    assert zero[3] == "" and zero[4] == ""


def test_path_single_item_and_document_id(spark):
    docs = docs_df(spark, ['{"_id":"p","a":{"b":{"ID":"q","x":true}}}', '{"_id":"r","a":{"b":[1]}}']).selectExpr(
        "get_json_object(doc, '$._id') AS rid", "doc")
    t = extract_path_items(docs, "rid", ["a", "b"], [("nested_id", "nested_id"), ("parent_id", "id"), ("x", "x")],
                           "tab", is_array=False, with_document_id=True)
    assert rows(t) == [("tab_q_p_0", "q", "true", "p")]


def test_operators_on_plain_dataframes(spark):
    df = spark.createDataFrame(
        [("k1", [1.5, None], [{"a": 1, "b": "x"}, None], {"a": 3})],
        "key string, xs array<double>, recs array<struct<a:int,b:string>>, st struct<a:int>",
    )
    assert rows(unnest_values(df, "key", "xs", "fk", "v", T.StringType())) == [
        ("k1_0", "k1", "1.5"), ("k1_1", "k1", None)]
    assert rows(unnest_records(df, "key", "recs", "fk", [("a", T.IntegerType()), ("zz", T.IntegerType())])) == [
        ("k1_0", "k1", 1, None)]
    assert rows(flatten_struct(df, "key", "st", "fk", [("a", T.StringType())])) == [("k1_st", "k1", "3")]


def test_ambiguous_case_names_parse(spark):
    from unnestor import Catalog
    cat = Catalog.from_dict({"u": {"primary_key": "relationship_id", "fields": [
        {"name": "relationship_id", "source_field": "_id"}, {"name": "ID"}, {"name": "idx", "source_field": "id"}]}})
    main = dict(normalize(docs_df(spark, ['{"_id":"a","ID":"upper","id":"lower"}']), cat, "u"))["u"]
    assert rows(main) == [("a", "upper", "lower")]


def test_standalone_path_table(spark, edge_catalog):
    from unnestor.plans.normalize import extract_table
    t = extract_table(docs_df(spark, DOCS), edge_catalog, "t_path", with_document_id=True)
    assert sorted(r.parent_id for r in t.collect()) == ["0", "2.5", "z"]
    assert {r.document_id for r in t.collect()} == {"o"}


def test_typed_nested_input_without_json(spark):
    from unnestor import Catalog, normalize_parsed
    cat = Catalog.from_dict({
        "m": {"table_name": "m", "primary_key": "relationship_id",
              "nested_tables": [{"field": "xs", "target_table": "m_xs", "foreign_key": "m_id"},
                                {"field": "recs", "target_table": "m_recs", "foreign_key": "m_id"}],
              "fields": [{"name": "relationship_id"}, {"name": "xs", "type": "array<integer>"},
                         {"name": "recs", "type": "array<map<string,string>>"}]},
        "m_xs": {"is_array": True, "fields": [{"name": "id", "generated": True}, {"name": "x", "type": "integer"}]},
        "m_recs": {"is_array": True, "fields": [{"name": "nested_id", "generated": True},
                                                {"name": "a", "type": "integer"}, {"name": "b"}]},
    })
    df = spark.createDataFrame([("r1", [4, 5], [{"a": 1, "b": "x"}])],
                               "relationship_id string, xs array<int>, recs array<struct<a:int,b:string>>")
    out = dict(normalize_parsed(df, cat, "m"))
    assert rows(out["m_xs"]) == [("r1_0", "r1", 4), ("r1_1", "r1", 5)]
    assert rows(out["m_recs"]) == [("r1_0", "r1", 1, "x")]


def test_awkward_field_names(spark, tmp_path):
    from unnestor import Catalog, load_database
    from unnestor.sinks.tables import ParquetStore
    cat = Catalog.from_dict({
        "w": {"table_name": "w-docs", "primary_key": "doc id",
              "nested_tables": [{"field": "line.items", "target_table": "w_items", "foreign_key": "w id"}],
              "fields": [{"name": "doc id", "source_field": "_id"}, {"name": "a.b", "type": "integer"},
                         {"name": "line.items", "type": "array<map<string,string>>"}]},
        "w_items": {"table_name": "w-items", "is_array": True,
                    "fields": [{"name": "nested_id", "generated": True}, {"name": "x-y", "type": "integer"},
                               {"name": "p q"}]},
    })
    docs = docs_df(spark, ['{"_id":"d","a.b":3,"line.items":[{"x-y":"7","p q":"z"}]}'])
    tables = dict(normalize(docs, cat, "w"))
    assert rows(tables["w-docs"].select("`doc id`", "`a.b`")) == [("d", 3)]
    assert rows(tables["w-items"]) == [("d_0", "d", 7, "z")]
    run = load_database(docs, cat, "w", ParquetStore(str(tmp_path / "o")))
    assert [r.table for r in run.tables] == ["w_docs", "w_items"] and all(r.status == "ok" for r in run.tables)


def test_parent_table_override_uses_that_tables_key(spark):
    from unnestor import Catalog
    cat = Catalog.from_dict({
        "m": {"primary_key": "relationship_id",
              "nested_tables": [{"field": "s", "target_table": "m_s", "foreign_key": "m_id"}],
              "fields": [{"name": "relationship_id", "source_field": "_id"}, {"name": "xs", "type": "array<integer>"},
                         {"name": "s", "type": "struct", "fields": [{"name": "p"}]}]},
        "m_s": {"primary_key": "id", "fields": [{"name": "id", "generated": True}, {"name": "m_id"}, {"name": "p"}],
                "nested_tables": [{"field": "xs", "target_table": "m_xs", "foreign_key": "m_id", "parent_table": "m"}]},
        "m_xs": {"is_array": True, "fields": [{"name": "id", "generated": True}, {"name": "x", "type": "integer"}]},
    })
    out = dict(normalize(docs_df(spark, ['{"_id":"a","xs":[1,2],"s":{"p":"q"}}']), cat, "m"))
    assert rows(out["m_xs"]) == [("a_0", "a", 1), ("a_1", "a", 2)]


def test_empty_input_loads_empty_tables(spark, edge_catalog, tmp_path):
    from unnestor import ParquetStore, load_database
    run = load_database(spark.createDataFrame([], "doc string"), edge_catalog, "t", ParquetStore(str(tmp_path / "o")))
    assert [(r.written, r.loaded, r.status) for r in run.tables] == [(0, 0, "ok")] * 5


def test_layout_errors_are_clear(spark):
    import pytest
    from unnestor import Catalog, CatalogError
    base = {"primary_key": "relationship_id",
            "fields": [{"name": "relationship_id", "source_field": "_id"}, {"name": "s"}]}
    child = {"is_array": True, "fields": [{"name": "nested_id", "generated": True}, {"name": "a"}, {"name": "b"}]}
    docs = docs_df(spark, ['{"_id":"a","s":"x"}'])
    missing = Catalog.from_dict({"m": {**base, "nested_tables": [{"field": "nope", "target_table": "c", "foreign_key": "m_id"}]}, "c": child})
    with pytest.raises(CatalogError, match="does not have"):
        normalize(docs, missing, "m")
    wrong = Catalog.from_dict({"m": {**base, "nested_tables": [{"field": "s", "target_table": "c", "foreign_key": "m_id"}]}, "c": child})
    with pytest.raises(CatalogError, match="is string"):
        normalize(docs, wrong, "m")


def test_single_layout_over_array_reads_as_array(spark):
    import warnings
    from unnestor import Catalog
    cat = Catalog.from_dict({
        "m": {"primary_key": "relationship_id",
              "nested_tables": [{"field": "photos", "target_table": "m_photos", "foreign_key": "m_id"}],
              "fields": [{"name": "relationship_id", "source_field": "_id"},
                         {"name": "photos", "type": "array<map<string,string>>"}]},
        "m_photos": {"fields": [{"name": "url"}, {"name": "status", "type": "integer"}]},  # no is_array
    })
    with warnings.catch_warnings():
        warnings.simplefilter("ignore")
        out = dict(normalize(docs_df(spark, ['{"_id":"a","photos":[{"url":"u","status":"2"}]}']), cat, "m"))
    assert rows(out["m_photos"]) == [("a_0", "a", "u", 2)]


def test_path_items_of_quirky_json(spark):
    docs = docs_df(spark, [
        '{"_id":"1_2","a":{"items":[{"ID":"x","v":1, "v" : 17.0},"{\\"ID\\":\\"t\\"}",{"ID":"y","v":"{braced","w":{"k":"{in","n":null}}]}}',
        '{"_id":"2","a":{"items":[{"ID":"x_1","v":"\\u0001{odd"},{"ID":"p%q","v":[1,2]}]}}',
        '{"_id":"3","a":{"items":"[{\\"ID\\":1}]"}}',
        '{"_id":"4","a":{"items":[{"ID":"old"}]},"a":{"items":[{"ID":"new","v":123456789012345678901234567890}]}}',
        '{"_id":"5","a":{"items":[{"ID":0},{"ID":"0"},{"ID":0.0},{"ID":"false"},{"ID":false},{"ID":"[]"},{"ID":[]},{"ID":"{}"},{"ID":{}},{"ID":null}]}}',
        '{"_id":"6","a":"text"}', '{"_id":"7","a":[{"items":[{"ID":"no"}]}]}',
    ]).selectExpr("get_json_object(doc, '$._id') AS rid", "doc")
    fields = [("nested_id", ""), ("parent_id", ""), ("v", "v"), ("w", "w"), ("k", "w.k")]
    got = {r.nested_id: tuple(r)[1:] for r in extract_path_items(docs, "rid", ["a", "items"], fields, "t").collect()}
    assert got == {
        "t_x_1%5F2_0": ("x", "17.0", "", ""),
        "t_y_1%5F2_2": ("y", "{braced", '{"k":"{in","n":null}', "{in"),
        "t_x%5F1_2_0": ("x_1", "\x01{odd", "", ""),
        "t_p%25q_2_1": ("p%q", "[1,2]", "", ""),
        "t_new_4_0": ("new", "123456789012345678901234567890", "", ""),
        "t_0_5_1": ("0", "", "", ""), "t_false_5_3": ("false", "", "", ""), "t_[]_5_5": ("[]", "", "", ""), "t_{}_5_7": ("{}", "", "", ""),
    }


def test_path_keys_can_be_undone(spark):
    from unnestor.operators.unnest import key_part, split_path_key
    from pyspark.sql import functions as F
    ids = ["x_1", "2", "x", "1_2", "%5F", "_", "%", "a%_b", "%25"]
    df = spark.createDataFrame([(a, b, i) for i, a in enumerate(ids) for b in ids], "a string, b string, i int")
    keyed = df.withColumn("key", F.concat(F.lit("t_"), key_part(F.col("a")), F.lit("_"), key_part(F.col("b")), F.lit("_"), F.col("i").cast("string")))
    assert keyed.select("key").distinct().count() == len(ids) ** 2
    back = keyed.select("a", "b", "i", *[c.alias(n) for c, n in zip(split_path_key(F.col("key"), "t"), ("a2", "b2", "i2"))])
    assert back.where("a <> a2 or b <> b2 or i <> i2").count() == 0


def test_paths_that_overlap(spark):
    """A path that begins another is read by a parse of its own."""
    from unnestor import Catalog
    path = lambda *steps: [{"field": s} for s in steps]
    items = {"use_nested_transformer": True, "is_array": True, "fields": [{"name": "nested_id", "generated": True}, {"name": "v"}]}
    cat = Catalog.from_dict({
        "m": {"primary_key": "relationship_id", "nested_tables": [
                {"field": "a", "target_table": "one", "foreign_key": "f"}, {"field": "a", "target_table": "two", "foreign_key": "f"}],
              "fields": [{"name": "relationship_id", "source_field": "_id"}]},
        "one": {**items, "table_name": "one", "path": path("a")}, "two": {**items, "table_name": "two", "path": path("a", "b")},
    })
    out = dict(normalize(docs_df(spark, ['{"_id":"p","a":[{"ID":1,"v":"x"}]}', '{"_id":"q","a":{"b":[{"ID":2,"v":"y"}]}}']), cat, "m"))
    assert rows(out["one"]) == [("one_1_p_0", "x")] and rows(out["two"]) == [("two_2_q_0", "y")]
