"""A1-A3, C4, C5."""

from pyspark.sql import types as T

from unnestor import Catalog
from unnestor.operators.checks import (
    column_profile, reconcile, row_counts, schema_diff, schema_drift, schema_matches,
)

from .conftest import docs_df, rows


def test_row_counts_and_profile(spark):
    a = spark.createDataFrame([("x", None), ("y", 1)], "s string, n int")
    assert rows(row_counts([("a", a), ("b", a.limit(0))])) == [("a", 2), ("b", 0)]
    assert rows(column_profile(a)) == [("n", 1, 2), ("s", 2, 2)]


def test_reconcile(spark):
    e = spark.createDataFrame([("a", 2), ("b", 3), ("c", 1)], "table_name string, rows long")
    l = spark.createDataFrame([("a", 2), ("b", 2)], "table_name string, rows long")
    assert rows(reconcile(e, l)) == [("a", 2, 2, "ok"), ("b", 3, 2, "mismatch"), ("c", 1, None, "missing")]


def test_schema_equality_and_diff():
    exp = T.StructType([T.StructField("a", T.StringType()), T.StructField("b", T.IntegerType())])
    act = T.StructType([T.StructField("a", T.StringType()), T.StructField("b", T.LongType()),
                        T.StructField("c", T.StringType())])
    d = schema_diff(act, exp)
    assert d.missing == () and d.extra == ("c",) and d.mismatched == (("b", "bigint", "int"),)
    assert not d.ok and schema_diff(exp, exp).ok


def test_schema_matches(spark):
    df = spark.createDataFrame([("a",)], "a string")
    assert schema_matches(df, T.StructType([T.StructField("a", T.StringType())]))


def test_schema_drift(spark):
    cat = Catalog.from_dict({"x": {"fields": [{"name": "rid", "source_field": "_id"}, {"name": "n"}, {"name": "gone"}]}})
    docs = docs_df(spark, ['{"_id":"a","n":1}', '{"_id":"b","extra":2}'])
    assert rows(schema_drift(docs, cat["x"])) == [
        ("_id", 2, "ok"), ("extra", 1, "extra"), ("gone", 0, "missing"), ("n", 1, "ok")]
