"""V1-V9 column functions."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from unnestor.functions.values import (
    apply_null_policy, as_float, as_timestamp, fill_defaults, json_text, key_of, sanitize_name,
    sanitize_name_col, stringify, strip_control, typed,
)

from .conftest import rows


def test_stringify(spark):
    df = spark.createDataFrame([('{"s":"x","n":3,"b":false,"o":{"a":[1]},"z":null,"f":17.0}',)], "j string")
    p = df.select(F.from_json("j", "s string, n string, b string, o string, z string, q string, f string").alias("p"))
    got = p.select(*[stringify(F.col("p")[k]).alias(k) for k in "snbozqf"]).first()
    assert tuple(got) == ("x", "3", "false", '{"a":[1]}', "", "", "17.0")


def test_float_coercion_strict_and_permissive(spark):
    df = spark.createDataFrame([("5",), ("2.5",), ("abc",), (None,)], "x string")
    assert [r[0] for r in df.select(as_float("x", strict=False)).collect()] == [5.0, 2.5, None, None]
    with pytest.raises(Exception):
        df.select(as_float("x", strict=True)).collect()


def test_timestamp_parse(spark):
    df = spark.createDataFrame([("2024-01-02T03:04:05Z",), ("garbage",)], "x string")
    got = [r[0] for r in df.select(as_timestamp("x", strict=False)).collect()]
    assert got[0] == dt.datetime(2024, 1, 2, 3, 4, 5) and got[1] is None
    with pytest.raises(Exception):
        df.select(as_timestamp("x", strict=True)).collect()


def test_typed_cast_never_fails(spark):
    df = spark.createDataFrame([("12",), ("12.7",), ("abc",), ("true",)], "x string")
    from pyspark.sql import types as T
    assert [r[0] for r in df.select(typed("x", T.IntegerType())).collect()] == [12, None, None, None]
    assert [r[0] for r in df.select(typed("x", T.BooleanType())).collect()] == [None, None, None, True]


def test_key_of_propagates_null(spark):
    df = spark.createDataFrame([("a", 1), (None, 2)], "k string, p int")
    assert [r[0] for r in df.select(key_of(F.col("k"), "_", F.col("p").cast("string"))).collect()] == ["a_1", None]


def test_strip_control_and_json(spark):
    df = spark.createDataFrame([("a\x00b\x0bc", {"k": "v"})], "s string, m map<string,string>")
    r = df.select(strip_control("s"), json_text("m")).first()
    assert tuple(r) == ("abc", '{"k":"v"}')


def test_sanitize_names(spark):
    assert sanitize_name("channel1_orderline-steps_evidencePhotos") == "channel1_orderline_steps_evidencephotos"
    df = spark.createDataFrame([("5-LOW",)], "n string")
    assert df.select(sanitize_name_col("n")).first()[0] == "5_low"


def test_null_policy(spark):
    df = spark.createDataFrame(
        [(None, None, "", None, None, None, None, 1.5), ({"a": "1"}, [1], "x\x0b", True, 7, 3, {"p": 1}, None)],
        "m map<string,string>, a array<int>, s string, b boolean, l bigint, i int, st struct<p:int>, f float",
    )
    out = apply_null_policy(df)
    assert out.columns == df.columns
    assert rows(out) == sorted([
        ("{}", "[]", None, False, 0, None, None, 1.5),
        ('{"a":"1"}', "[1]", "x", True, 7, 3, '{"p":1}', None),
    ], key=repr)


def test_fill_defaults(spark):
    df = spark.createDataFrame([("a", None), ("b", "x")], "k string, v string")
    assert rows(fill_defaults(df, {"v": "dflt"})) == [("a", "dflt"), ("b", "x")]


def test_strict_coercion_fails_without_ansi(spark):
    df = spark.createDataFrame([("1.5",), ("abc",)], "x string")
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        with pytest.raises(Exception, match="not a float"):
            df.select(as_float("x", strict=True)).collect()
        with pytest.raises(Exception, match="not a timestamp"):
            df.select(as_timestamp("x", strict=True)).collect()
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")
