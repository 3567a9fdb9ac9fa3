"""Incremental load over arriving dump files: later versions replace earlier ones."""

from unnestor.sinks.tables import ParquetStore
from unnestor.streaming import start_incremental_load

from .conftest import rows


def test_incremental_upsert(spark, edge_catalog, tmp_path):
    src = tmp_path / "incoming"
    src.mkdir()
    store = ParquetStore(str(tmp_path / "tables"))
    ckpt = str(tmp_path / "stream-ckpt")
    (src / "part1.txt").write_text('{"_id":"a","n":1,"prim":[1,2]}\n{"_id":"b","n":2}\n')
    q = start_incremental_load(spark, str(src), edge_catalog, "t", store, available_now=True,
                               checkpoint_location=ckpt)
    q.awaitTermination(120)
    assert rows(store.read(spark, "t").select("relationship_id", "n")) == [("a", 1), ("b", 2)]
    (src / "part2.txt").write_text('{"_id":"a","n":10,"prim":[7]}\n')
    q = start_incremental_load(spark, str(src), edge_catalog, "t", store, available_now=True,
                               checkpoint_location=ckpt)
    q.awaitTermination(120)
    assert rows(store.read(spark, "t").select("relationship_id", "n")) == [("a", 10), ("b", 2)]
    # the arriving version replaces all children of the stored one
    assert rows(store.read(spark, "t_prim")) == [("a_0", "a", 7)]
