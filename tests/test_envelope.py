"""Envelope files read by several tasks."""

import json
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from unnestor.sources import envelope
from unnestor.sources.documents import read_envelope, read_envelopes


def text_of(docs, indent=None, **more):
    rows = [{"id": d["_id"], "value": {"rev": "1-}"}, "doc": d} for d in docs]
    return json.dumps({"total_rows": len(docs), "offset": 0, **more, "rows": rows}, indent=indent)


def awkward_documents(n):
    rng = random.Random(3)
    bits = ["}{", '"quoted\\ "', "\\", '{"a":[1,{"b":2}]}', "[", "é😀", ",", "\n]}", ""]
    return [{"_id": str(i), "a": rng.choice(bits) * rng.randrange(4), "n": {"x": [{"id": 1, "t": rng.choice(bits)}, {"id": 2}]},
             "big": "z}" * rng.choice([0, 0, 0, 0, 0, 2500])} for i in range(n)]


@pytest.fixture
def small_splits(spark):
    conf = {"spark.sql.files.maxPartitionBytes": "4k", "spark.sql.files.openCostInBytes": "0"}
    was = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield
    for k, v in was.items():
        spark.conf.set(k, v)


def found(rows):
    return sorted(json.dumps(json.loads(r.value)["doc"], sort_keys=True) for r in rows.collect())


def test_one_file_in_many_tasks(spark, tmp_path, small_splits):
    docs = awkward_documents(60)
    (tmp_path / "a.json").write_text(text_of(docs, **{"meta {": {"a": 1}}))
    assert envelope._fragments(spark, str(tmp_path)).rdd.getNumPartitions() > 4
    rows, rejects = envelope.scan_envelopes(spark, str(tmp_path))
    assert found(rows) == sorted(json.dumps(d, sort_keys=True) for d in docs)
    assert rejects.count() == 0
    assert read_envelope(spark, str(tmp_path)).count() == 60


def test_files_that_are_no_whole_envelopes(spark, tmp_path):
    docs = awkward_documents(20)
    for name, text in {"a": text_of(docs, 2) + "\n", "b": text_of([]), "c": text_of(docs)[:-40], "d": '{"other":{"x":{"y":[{"z":1}]}}}\n',
                       "e": "", "f": "[1, 2]", "g": '{"_id":"1"}\n{"_id":"2"}\n'}.items():
        (tmp_path / f"{name}.json").write_text(text)
    rows, rejects = envelope.scan_envelopes(spark, str(tmp_path))
    assert found(rows) == sorted(json.dumps(d, sort_keys=True) for d in docs + docs[:19])
    assert {r.file[-6]: r.reason for r in rejects.collect()} == {
        "c": "envelope is cut short", "d": "not an envelope", "f": "not an envelope", "g": "not an envelope"}
    docs_df, bad = read_envelopes(spark, str(tmp_path), "permissive")
    assert docs_df.count() == 39 and bad.count() == 4


def test_splits_without_a_broadcast(spark, tmp_path, small_splits):
    docs = awkward_documents(30)
    (tmp_path / "a.json").write_text(text_of(docs))
    was = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows, _ = envelope.scan_envelopes(spark, str(tmp_path))
        assert found(rows) == sorted(json.dumps(d, sort_keys=True) for d in docs)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", was)


json_values = st.recursive(
    st.none() | st.booleans() | st.integers() | st.text(alphabet='{}[]",\\\\ab\n', max_size=8),
    lambda v: st.lists(v, max_size=3) | st.dictionaries(st.text(alphabet='{}[]"\\\\a', max_size=4), v, max_size=3), max_leaves=12)


@settings(max_examples=200, deadline=None)
@given(st.lists(json_values, max_size=5), st.data())
def test_any_split_gives_the_same_rows(values, data):
    """The two passes, without Spark, over an envelope cut anywhere at braces."""
    import pyarrow as pa
    text = json.dumps({"total_rows": len(values), "rows": [{"id": str(i), "doc": v} for i, v in enumerate(values)]})
    fragments = text.split("}")[:-1]
    blocks, block = [], 0
    for _ in fragments:
        block += data.draw(st.booleans())
        blocks.append(block)
    blocks = [b - blocks[0] for b in blocks]

    def batch(**columns):
        return pa.RecordBatch.from_pydict({k: v for k, v in columns.items()})

    sums = pa.Table.from_batches(list(envelope._sum_up([batch(file=["f"] * len(blocks), block=blocks, value=fragments)])))
    starts = {r["block"]: r for r in envelope._follow(("f",), sums).to_pylist()}
    at = [starts[b] for b in blocks]
    pieces = [r for b in envelope._cut([batch(file=["f"] * len(blocks), block=blocks, in_text=[s["in_text"] for s in at], depth=[s["depth"] for s in at],
                                              owner=[s["owner"] for s in at], value=fragments)]) for r in b.to_pylist()]
    rows = [r for r in pieces if r["owner"] is None]
    for owner in {r["owner"] for r in pieces} - {None}:
        own = sorted((r for r in pieces if r["owner"] == owner), key=lambda r: (r["block"], r["part"]))
        rows.append({"file": "f", "ends": any(r["ends"] for r in own), "first": any(r["first"] for r in own), "value": "".join(r["value"] for r in own)})
    out = [r for b in envelope._rows_of([pa.RecordBatch.from_pylist([{k: r[k] for k in ("file", "ends", "first", "value")} for r in rows])]) for r in b.to_pylist()] if rows else []
    assert not any(r["reason"] for r in out)
    got = sorted((json.loads(r["value"]) for r in out), key=lambda r: int(r["id"]))
    assert got == [{"id": str(i), "doc": v} for i, v in enumerate(values)]
    assert starts[max(starts)]["end"] == 0
