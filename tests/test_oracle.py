"""Every catalogue query against its DuckDB oracle on the smallest tables."""

import math
import os

import pytest

import __spark_entry__ as E
from unnestor.queries import catalogue

SF = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


def _norm(v):
    if isinstance(v, float):
        return round(v, 6) if math.isfinite(v) else str(v)
    return v


def _sorted(rs):
    return sorted((tuple(_norm(x) for x in r) for r in rs), key=repr)


@pytest.fixture(scope="module")
def duck():
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def test_every_query_has_an_oracle():
    assert set(catalogue.oracle_sql()) == set(catalogue.queries())
    assert set(catalogue.queries()) <= set(E.queries())


_TYPES = {"string": "VARCHAR", "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE",
          "boolean": "BOOLEAN", "float": "FLOAT"}


@pytest.mark.parametrize("name", sorted(catalogue.queries()))
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF)
    cols = sorted(df.columns)
    got = _sorted(tuple(r[c] for c in cols) for r in df.collect())
    rel = duck.sql(E.oracle_sql()[name])
    assert sorted(rel.columns) == cols
    spark_types = {f.name: _TYPES.get(f.dataType.simpleString(), f.dataType.simpleString())
                   for f in df.schema.fields}
    assert spark_types == dict(zip(rel.columns, map(str, rel.types)))
    idx = [rel.columns.index(c) for c in cols]
    want = _sorted(tuple(r[i] for i in idx) for r in rel.fetchall())
    assert got == want


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0 and "nested_id" in df.columns
