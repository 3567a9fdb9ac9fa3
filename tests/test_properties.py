"""Properties of normalisation over generated documents."""

import json

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from unnestor import normalize

from .conftest import docs_df

elem = st.one_of(st.none(), st.fixed_dictionaries({}, optional={
    "k": st.integers(-5, 5).map(str), "v": st.text(max_size=3)}))
doc = st.fixed_dictionaries(
    {"_id": st.text(alphabet="abcdef", min_size=1, max_size=4)},
    optional={"prim": st.one_of(st.none(), st.lists(st.one_of(st.none(), st.integers(-9, 9)), max_size=4)),
              "arr": st.one_of(st.none(), st.lists(elem, max_size=4))},
)


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(doc, min_size=1, max_size=12, unique_by=lambda d: d["_id"]), st.integers(1, 5))
def test_counts_keys_and_partition_invariance(spark, edge_catalog, docs, parts):
    df = docs_df(spark, [json.dumps(d) for d in docs])
    out = dict(normalize(df, edge_catalog, "t"))
    again = dict(normalize(df.repartition(parts), edge_catalog, "t"))
    n_prim = sum(len(d.get("prim") or []) for d in docs)
    n_arr = sum(sum(e is not None for e in (d.get("arr") or [])) for d in docs)
    prim = out["t_prim"].collect()
    arr = out["t_arr"].collect()
    assert len(prim) == n_prim and len(arr) == n_arr
    assert len({r.id for r in prim}) == n_prim and len({r.nested_id for r in arr}) == n_arr
    parents = {d["_id"] for d in docs}
    assert {r.t_id for r in prim} <= parents and {r.t_id for r in arr} <= parents
    for name in ("t_prim", "t_arr", "t_st"):
        assert sorted(map(tuple, out[name].collect())) == sorted(map(tuple, again[name].collect()))


rows_st = st.lists(
    st.tuples(st.one_of(st.none(), st.sampled_from(["a", "b", "c"])), st.integers(0, 5), st.integers(0, 1000)),
    min_size=0, max_size=40,
)


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(rows_st, st.integers(1, 4), st.booleans())
def test_pack_pages_matches_brute_force(spark, rows, page_size, as_builder):
    from pyspark.sql import functions as F

    from unnestor.sources.tables import pack_pages

    df = spark.createDataFrame(rows, "k string, o int, p int")
    item = (lambda x: x["p"]) if as_builder else F.col("p")
    got = {(r.k, r.page): list(r["items"]) for r in pack_pages(df, ["k"], ["o", "p"], item, page_size).collect()}
    want: dict = {}
    for k in {r[0] for r in rows}:
        ordered = [r[2] for r in sorted((r for r in rows if r[0] == k), key=lambda r: (r[1], r[2]))]
        for i in range(0, len(ordered), page_size):
            want[(k, i // page_size)] = ordered[i:i + page_size]
    assert got == want


versions_st = st.lists(
    st.tuples(st.sampled_from(["a", "b", "c"]), st.one_of(st.none(), st.integers(0, 3)), st.integers(0, 50)),
    min_size=1, max_size=30,
)


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(versions_st, st.booleans())
def test_latest_per_key_matches_brute_force(spark, rows, with_map):
    from pyspark.sql import functions as F

    from unnestor.operators.upsert import latest_per_key

    df = spark.createDataFrame(rows, "k string, o int, v int")
    if with_map:  # a map column: no ordering of its own -> the max_by path
        df = df.withColumn("m", F.create_map(F.lit("v"), F.col("v")))
    got = {r.k: (r.o, r.v) for r in latest_per_key(df, "k", "o").collect()}
    want = {}
    for k in {r[0] for r in rows}:
        versions = [r for r in rows if r[0] == k]
        # greatest ordering wins, nulls lowest; ties broken by the whole row
        want[k] = max(((o, v) for _, o, v in versions), key=lambda t: (t[0] is not None, t[0] or 0, t[1]))
    if not with_map:
        assert got == want
    else:  # the tie-break is the row's JSON text: only the ordering is pinned
        assert {k: o for k, (o, _) in got.items()} == {k: o for k, (o, _) in want.items()}
