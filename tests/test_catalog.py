"""Layout compilation (metadata only)."""

import pytest
from pyspark.sql import types as T

from unnestor import Catalog, CatalogError
from unnestor.plans.catalog import PATH, PRIMITIVE, RECORDS, SINGLE, spark_type


def test_type_names_and_fallback():
    assert spark_type("integer") == T.IntegerType()
    assert spark_type("float") == T.FloatType()
    assert spark_type("array<map<string, string>>") == T.ArrayType(T.MapType(T.StringType(), T.StringType()))
    assert spark_type("decimal(10,2)") == T.StringType()  # unknown -> string


def test_schema_skips_generated_and_nests_structs(edge_catalog):
    s = edge_catalog["t"].schema
    assert s.fieldNames()[:3] == ["relationship_id", "n", "f"]
    assert s["st"].dataType == T.StructType(
        [T.StructField(n, T.StringType()) for n in ("p", "q", "items")]
    )
    assert "id" not in edge_catalog["t_prim"].schema.fieldNames()


def test_nullable_flag():
    cat = Catalog.from_dict({"x": {"fields": [{"name": "a", "nullable": False}]}})
    assert cat["x"].schema["a"].nullable is False


def test_field_type_lookup_defaults_to_string(edge_catalog):
    assert edge_catalog["t_arr"].type_of("k") == T.IntegerType()
    assert edge_catalog["t_arr"].type_of("nope") == T.StringType()


def test_kinds(edge_catalog):
    t = edge_catalog["t"]
    links = {l.target: l for l in t.children}
    assert edge_catalog["t_prim"].kind(links["t_prim"]) == PRIMITIVE
    assert edge_catalog["t_arr"].kind(links["t_arr"]) == RECORDS
    assert edge_catalog["t_st"].kind(links["t_st"]) == SINGLE
    assert edge_catalog["t_path"].kind(edge_catalog["t_st"].children[0]) == PATH


def test_tree_is_depth_first(edge_catalog):
    assert edge_catalog.tree("t") == ["t", "t_prim", "t_arr", "t_st", "t_path"]
    assert edge_catalog.table_names("t")[0] == "t"


def test_duplicate_yaml_keys_rejected():
    text = """
a:
  fields: [{name: x}]
a:
  fields: [{name: y}]
"""
    with pytest.raises(CatalogError, match="duplicate key"):
        Catalog.from_yaml_text(text)


def test_duplicate_across_files_and_sanitised_names(tmp_path):
    (tmp_path / "one.yml").write_text("a:\n  table_name: My-T\n  fields: [{name: x}]\n")
    (tmp_path / "two.yaml").write_text("b:\n  table_name: my_t\n  fields: [{name: x}]\n")
    with pytest.raises(CatalogError, match="collides"):
        Catalog.load_dir(str(tmp_path))


def test_load_dir(tmp_path):
    (tmp_path / "one.yml").write_text("a:\n  fields: [{name: x, type: integer}]\n")
    (tmp_path / "notes.txt").write_text("ignored")
    cat = Catalog.load_dir(str(tmp_path))
    assert cat["a"].schema["x"].dataType == T.IntegerType()


def test_bad_layouts():
    with pytest.raises(CatalogError):
        Catalog.from_dict({"x": {"fields": []}})
    with pytest.raises(CatalogError):
        Catalog.from_dict({"x": {"fields": [{"name": "s", "type": "struct"}]}})
    with pytest.raises(CatalogError):
        Catalog.from_dict({"x": {"fields": [{"name": "a"}, {"name": "a"}]}})
    with pytest.raises(CatalogError):
        Catalog()["missing"]


def test_duplicate_policy_first_and_last():
    text = """
a:
  table_name: first
  fields: [{name: x}]
  table_name: second
"""
    import warnings
    with warnings.catch_warnings():
        warnings.simplefilter("ignore")
        assert Catalog.from_yaml_text(text, duplicates="first")["a"].table_name == "first"
        assert Catalog.from_yaml_text(text, duplicates="last")["a"].table_name == "second"


def test_validate_tree(edge_catalog):
    edge_catalog.validate("t")
    bad = Catalog.from_dict({
        "m": {"fields": [{"name": "x"}],
              "nested_tables": [{"field": "nope", "target_table": "c"}, {"field": "x", "target_table": "gone"}]},
        "c": {"is_array": True, "fields": [{"name": "a"}, {"name": "b"}]},
    })
    found = bad.problems("m")
    assert any("unknown layout 'gone'" in p for p in found)
    assert any("no primary_key" in p for p in found)
    assert any("does not declare" in p for p in found)
    with pytest.raises(CatalogError):
        bad.validate("m")
    assert Catalog().problems("m") == ["unknown root layout 'm'"]


def test_layouts_of_the_bound_databases(tmp_path):
    """Written as YAML and read back as a folder of layouts, one file a table."""
    import yaml

    from unnestor.layouts import catalog, layouts
    from unnestor.plans.pipeline import ENTITIES
    for i, (key, layout) in enumerate(layouts().items()):
        (tmp_path / f"{i}.yml").write_text(yaml.safe_dump({key: layout}, sort_keys=False))
    cat = Catalog.load_dir(str(tmp_path))
    assert cat.tables == catalog().tables
    assert set(ENTITIES.values()) - set(cat.tables) == {"channel1_order"}
    sizes = {root: len(cat.tree(root)) for root in ENTITIES.values() if root in cat.tables}
    assert sizes == {"channel1_user": 2, "channel1_company": 12, "channel1_orderline-steps": 2}
    fields = {k: len(t.fields) for k, t in cat.tables.items()}
    assert fields["channel1_company"] == 53 and fields["channel1_company_sustainability"] == 29 and fields["channel1_company_officeAddresses"] == 24
    assert all(not cat.problems(root) for root in sizes)
