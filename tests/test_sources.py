"""Dump readers and typed parse, strict and permissive."""

import pytest

from unnestor import parse_documents, read_document_lines, read_envelope, rejected_documents
from unnestor.sources.documents import documents_from, rejected_lines, unwrap_envelope

from .conftest import docs_df, rows


def test_envelope_file(spark, tmp_path):
    p = tmp_path / "db.json"
    p.write_text('{"total_rows":3,"offset":0,"rows":[\n'
                 '{"id":"d1","key":"d1","doc":{"_id":"d1","price":5,"orderLines":[{"lineID":"L1"}]}},\n'
                 '{"id":"d2","doc":null},\n'
                 '{"id":"d3","doc":{"_id":"d3"}}\n]}')
    got = rows(read_envelope(spark, str(p)))
    assert [r[0] for r in got] == ["d1", "d3"]
    assert '"orderLines":[{"lineID":"L1"}]' in got[0][1]


def test_line_dump(spark, tmp_path):
    p = tmp_path / "db.txt"
    p.write_text('{"total_rows":4,"offset":0,"rows":[\n'
                 '{"id":"d1","doc":{"_id":"d1","n":1}},\n'
                 '{"id":"d2","doc":null},\n'
                 '{"_id":"d3","n":3},\n'
                 '\n]}\n')
    got = rows(read_document_lines(spark, str(p)))
    assert [r[0] for r in got] == ["d1", "d3"]


BROKEN = ['{"id":"a","doc":{"_id":"a"}},', '{"id":"b","doc":{"_id":', "text", '{"x":1}', '{"_id":"d","doc":"free text"}', '{"id":"e","doc":"text"}',
          '{"id":"f","doc":null}', "", "]}", '{"rows":[']


def test_broken_lines(spark, tmp_path):
    p = tmp_path / "db.txt"
    p.write_text("\n".join(BROKEN))
    with pytest.raises(Exception, match="not a JSON object|doc is not an object"):
        read_document_lines(spark, str(p)).collect()
    got = rows(read_document_lines(spark, str(p), "permissive"))
    assert got == sorted([("a", '{"_id":"a"}'), (None, '{"x":1}'), ("d", BROKEN[4])], key=repr)
    bad = rows(rejected_lines(spark.read.text(str(p))))
    assert sorted(b[1] for b in bad) == sorted([BROKEN[1], BROKEN[5], "text"])


def test_broken_envelope(spark):
    texts = spark.createDataFrame([('{"rows":[{"id":"a","doc":{"_id":"a"}},{"id":"b","doc":{"_id":',)], "value string")
    with pytest.raises(Exception):
        unwrap_envelope(texts).collect()


def test_documents_from_struct(spark):
    df = spark.createDataFrame([("a", 1)], "_id string, n int")
    from pyspark.sql import functions as F
    assert documents_from(df, F.struct("_id", "n")).first()[0] == '{"_id":"a","n":1}'


def test_strict_fails_on_type_mismatch(spark, edge_catalog):
    with pytest.raises(Exception):
        parse_documents(docs_df(spark, ['{"_id":"k","n":"3"}']), edge_catalog["t"]).collect()
    with pytest.raises(Exception):
        parse_documents(docs_df(spark, ['{"_id":"j","f":"abc"}']), edge_catalog["t"]).collect()
    with pytest.raises(Exception):
        parse_documents(docs_df(spark, ['{"_id":"q","ts":"garbage"}']), edge_catalog["t"]).collect()


def test_permissive_nulls_and_quarantine(spark, edge_catalog):
    docs = docs_df(spark, ['{"_id":"j","f":"abc"}', '{"_id":"k","n":"3"}', '{"_id":"ok","n":3}',
                           '{"_id":"q","ts":"garbage"}'])
    parsed = parse_documents(docs, edge_catalog["t"], "permissive")
    got = {r["relationship_id"]: r for r in parsed.collect()}
    assert got["ok"]["_reject_reason"] is None and got["ok"]["n"] == 3
    assert got["j"]["f"] is None and "f: not a float" in got["j"]["_reject_reason"]
    assert got["k"]["n"] is None and got["k"]["_reject_reason"]
    assert [r[0] for r in rows(rejected_documents(docs, edge_catalog["t"]))] == ["j", "k", "q"]


def test_empty_result_keeps_schema(spark, edge_catalog):
    from unnestor import normalize
    t = dict(normalize(docs_df(spark, ['{"_id":"a"}']), edge_catalog, "t"))
    assert t["t_path"].count() == 0
    assert t["t_path"].columns == ["nested_id", "id", "parent_id", "v", "deep"]
