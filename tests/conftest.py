"""Shared Spark session (local, small shuffle) and edge-case layouts."""

from __future__ import annotations

import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from unnestor import Catalog  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from unnestor.plans.staging import ensure_checkpoint_dir

    scratch = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    s = (
        SparkSession.builder.master("local[4]")
        .appName("unnestor-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.local.dir", scratch)
        .getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(s, os.path.join(scratch, "checkpoints"))
    yield s
    s.stop()


EDGE_LAYOUT = """
t:
  table_name: t
  primary_key: relationship_id
  nested_tables:
    - {field: prim, target_table: t_prim, foreign_key: t_id}
    - {field: arr, target_table: t_arr, foreign_key: t_id}
    - {field: st, target_table: t_st, foreign_key: t_id}
  fields:
    - {name: relationship_id, type: string, source_field: _id}
    - {name: n, type: integer}
    - {name: f, type: float}
    - {name: ts, type: timestamp}
    - {name: b, type: boolean}
    - {name: m, type: "map<string,string>"}
    - {name: prim, type: "array<integer>"}
    - {name: arr, type: "array<map<string,string>>"}
    - name: st
      type: struct
      fields: [{name: p, type: string}, {name: q, type: string}, {name: items, type: string}]
t_prim:
  table_name: t_prim
  is_array: true
  fields: [{name: id, generated: true}, {name: t_id}, {name: value, type: integer}]
t_arr:
  table_name: t_arr
  is_array: true
  fields: [{name: nested_id, generated: true}, {name: t_id}, {name: k, type: integer}, {name: v}]
t_st:
  table_name: t_st
  primary_key: id
  fields: [{name: id, generated: true}, {name: t_id}, {name: p}, {name: q}]
  nested_tables:
    - {field: items, target_table: t_path, foreign_key: parent_id, use_nested_transformer: true}
t_path:
  table_name: t_path
  is_array: true
  path: [{field: st}, {field: items}]
  source_id_field: ID
  fields:
    - {name: nested_id, generated: true}
    - {name: id, generated: true}
    - {name: parent_id, source_field: id}
    - {name: v}
    - {name: deep, source_field: v.w}
"""


@pytest.fixture(scope="session")
def edge_catalog() -> Catalog:
    return Catalog.from_yaml_text(EDGE_LAYOUT)


def docs_df(spark, docs):
    return spark.createDataFrame([(d,) for d in docs], "doc string")


def rows(df, *cols):
    cols = cols or tuple(df.columns)
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)


TESTDATA = "/root/testdata"
needs_testdata = pytest.mark.skipif(not os.path.isdir(TESTDATA), reason="driver tables not present")

# Tests that open an embedded database in this process run on request only.
needs_database = pytest.mark.skipif(not os.environ.get("UNNESTOR_TEST_JDBC"), reason="opens an embedded database; set UNNESTOR_TEST_JDBC to run")
