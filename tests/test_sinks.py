"""K1-K6 and A3: stores, key choice, DDL, dedupe, merge, quarantine, reconcile."""


import pytest
from pyspark.sql import types as T

from unnestor.operators.upsert import latest_per_key, merge_upsert, split_bad_rows
from unnestor.sinks.tables import (
    JdbcStore, ParquetStore, choose_primary_key, create_table_sql, load_table,
)

from .conftest import needs_database, rows


def test_primary_key_choice():
    s = T.StructType([T.StructField("n", T.IntegerType()), T.StructField("a", T.StringType()),
                      T.StructField("b", T.StringType())])
    assert choose_primary_key(s, "b") == "b"
    assert choose_primary_key(s, "missing") == "a"
    with pytest.raises(ValueError):
        choose_primary_key(T.StructType([T.StructField("n", T.IntegerType())]))


def test_create_table_sql():
    s = T.StructType([T.StructField("id", T.StringType()), T.StructField("m", T.MapType(T.StringType(), T.StringType())),
                      T.StructField("n", T.IntegerType()), T.StructField("f", T.FloatType()),
                      T.StructField("b", T.BooleanType()), T.StructField("l", T.LongType())])
    sql = create_table_sql(s, "t", "id")
    assert sql == ('CREATE TABLE "t" ("id" TEXT, "m" JSONB, "n" INTEGER, "f" REAL, "b" BOOLEAN, '
                   '"l" BIGINT, PRIMARY KEY ("id"))')


def test_latest_per_key(spark):
    df = spark.createDataFrame([("k", 1, "old"), ("k", 2, "new"), ("j", 1, "only")], "key string, o int, v string")
    assert rows(latest_per_key(df, "key", "o")) == [("j", 1, "only"), ("k", 2, "new")]
    # without an order the greatest row wins (deterministic)
    assert rows(latest_per_key(df, "key")) == [("j", 1, "only"), ("k", 2, "new")]


def test_merge_upsert(spark):
    target = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    inc = spark.createDataFrame([("b", 20, 1), ("b", 21, 2), ("c", 3, 1)], "k string, v int, o int")
    assert rows(merge_upsert(target, inc, "k", "o")) == [("a", 1), ("b", 21), ("c", 3)]


def test_split_bad_rows(spark):
    df = spark.createDataFrame([("a",), ("",), ("  ",), (None,)], "k string")
    good, bad = split_bad_rows(df, "k")
    assert good.count() == 2 and bad.count() == 2


def test_load_table_refresh_and_upsert(spark, tmp_path):
    store = ParquetStore(str(tmp_path / "store"))
    quarantine = ParquetStore(str(tmp_path / "quarantine"))
    df = spark.createDataFrame([("a", "x", 1), ("a", "y", 2), ("", "z", 1), ("b", "", 1)], "k string, v string, o int")
    rep = load_table(df, store, "My-Table", "k", order_by="o", quarantine=quarantine)
    assert (rep.table, rep.written, rep.loaded, rep.rejected, rep.status) == ("my_table", 2, 2, 1, "ok")
    assert rows(store.read(spark, "my_table")) == [("a", "y", 2), ("b", None, 1)]
    assert quarantine.read(spark, "my_table__rejected").count() == 1
    inc = spark.createDataFrame([("b", "new", 5), ("c", "w", 1)], "k string, v string, o int")
    rep2 = load_table(inc, store, "My-Table", "k", mode="upsert", order_by="o")
    assert rep2.status == "ok"
    assert rows(store.read(spark, "my_table")) == [("a", "y", 2), ("b", "new", 5), ("c", "w", 1)]


@needs_database
def test_jdbc_round_trip_embedded_derby(spark):
    """Spark's bundled embedded Derby, in memory, in process (no port)."""
    store = JdbcStore("jdbc:derby:memory:unnestor;create=true",
                      {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}, batchsize=2)
    df = spark.createDataFrame([("a", 1, True), ("b", None, None), ("c", 3, False)], "k string, n int, b boolean")
    rep = load_table(df, store, "derby-t", "k")
    assert rep.status == "ok" and rep.loaded == 3
    got = {r[0].strip() if isinstance(r[0], str) else r[0]: r for r in store.read(spark, "derby_t").collect()}
    assert got["b"][2] is False  # boolean null -> false


@needs_database
def test_jdbc_partitioned_reads_embedded_derby(spark):
    store = JdbcStore("jdbc:derby:memory:unnestor2;create=true",
                      {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}, num_partitions=3,
                      partition_column='"n"', lower_bound=0, upper_bound=30)  # Derby: quoted lower case
    df = spark.createDataFrame([(f"k{i}", i) for i in range(30)], "k string, n int")
    rep = load_table(df, store, "derby_parts", "k", dedupe=False)
    assert rep.loaded == 30
    assert store.read(spark, "derby_parts").rdd.getNumPartitions() == 3
    by_pred = JdbcStore(store.url, store.properties, predicates=['"n" < 10', '"n" >= 10'])
    assert by_pred.read(spark, "derby_parts").count() == 30


def test_rejected_counted_on_write_pass(spark, tmp_path):
    store = ParquetStore(str(tmp_path / "s"))
    df = spark.createDataFrame([("a", 1), ("", 2), (None, 3), ("b", 4)], "k string, v int")
    rep = load_table(df, store, "t", "k", dedupe=False)
    assert (rep.written, rep.loaded, rep.rejected, rep.status) == (2, 2, 2, "ok")
    rep = load_table(df, store, "t", "k", dedupe=True)
    assert (rep.written, rep.rejected) == (2, 2)


@needs_database
def test_jdbc_upsert_embedded_derby(spark):
    store = JdbcStore("jdbc:derby:memory:unnestor3;create=true",
                      {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"})
    first = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    load_table(first, store, "derby_up", "k")
    later = spark.createDataFrame([("b", 20), ("c", 3)], "k string, v int")
    rep = load_table(later, store, "derby_up", "k", mode="upsert")
    assert rep.status == "ok" and rep.loaded == 3
    assert rows(store.read(spark, "derby_up")) == [("a", 1), ("b", 20), ("c", 3)]


def test_upsert_reads_touched_buckets_only(spark, tmp_path, monkeypatch):
    from pyspark.sql import functions as F
    store = ParquetStore(str(tmp_path / "s"), buckets=16)
    load_table(spark.range(1000).select(F.col("id").cast("string").alias("k"), F.col("id").alias("v")), store, "t", "k", dedupe=False)
    plans = []
    write = ParquetStore.write_buckets
    monkeypatch.setattr(ParquetStore, "write_buckets", lambda self, df, *a, **k: (plans.append(df._jdf.queryExecution().executedPlan().toString()), write(self, df, *a, **k))[1])
    folders = lambda: {p.name: sorted(f.name for f in p.glob("*.parquet")) for p in (tmp_path / "s" / "t").glob("_bucket*")}
    before = folders()
    rep = load_table(spark.createDataFrame([("5", -5), ("1001", 7)], "k string, v long"), store, "t", "k", mode="upsert", dedupe=False, verify="content")
    assert rep.status == "ok" and rep.content == "ok" and rep.loaded < 300
    changed = [b for b, files in folders().items() if files != before[b]]
    assert 1 <= len(changed) <= 2 and len(before) == 16
    assert "PartitionFilters: [_bucket_of_16" in plans[0]
    got = dict(store.read(spark, "t").collect())
    assert len(got) == 1001 and got["5"] == -5 and got["1001"] == 7 and got["6"] == 6


def test_a_table_in_buckets_keeps_their_number(spark, tmp_path):
    df = spark.createDataFrame([(str(i), i) for i in range(40)], "k string, v int")
    load_table(df, ParquetStore(str(tmp_path), buckets=4), "t", "k", dedupe=False)
    other = ParquetStore(str(tmp_path), buckets=32)
    load_table(df.where("v < 3").withColumn("v", df.v + 100), other, "t", "k", mode="upsert", dedupe=False)
    assert sorted(p.name.split("=")[0] for p in (tmp_path / "t").glob("_b*"))[0] == "_bucket_of_4"
    assert sorted(v for _, v in other.read(spark, "t").collect()) == [*range(3, 40), 100, 101, 102]
    flat = ParquetStore(str(tmp_path))
    load_table(df, flat, "t", "k", dedupe=False)
    assert not list((tmp_path / "t").glob("_b*")) and flat.read(spark, "t").columns == ["k", "v"]


def test_rejects_are_written_with_their_reason_in_one_pass(spark, tmp_path):
    from pyspark.sql import functions as F
    store, aside = ParquetStore(str(tmp_path / "s")), ParquetStore(str(tmp_path / "q"))
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    df = spark.createDataFrame([("a", 1), ("", 2), (None, 3), ("\x0b", 4), ("b", 5)], "k string, v int").mapInArrow(count, "k string, v int")
    for dedupe in (False, True):
        was = seen.value
        rep = load_table(df, store, "t", "k", quarantine=aside, dedupe=dedupe)
        assert (rep.written, rep.loaded, rep.rejected, rep.status) == (2, 2, 3, "ok")
        assert seen.value - was == 5
        assert rows(aside.read(spark, "t__rejected").select("v", "_reject_column", "_reject_reason")) == [
            (2, "k", "blank key"), (3, "k", "null key"), (4, "k", "blank key")]
        assert store.read(spark, "t").columns == ["k", "v"] and rows(store.read(spark, "t")) == [("a", 1), ("b", 5)]
    # nothing to set aside, and nothing but that
    rep = load_table(df.where("v = 1"), store, "t", "k", quarantine=aside, dedupe=False)
    assert (rep.written, rep.rejected) == (1, 0) and aside.read(spark, "t__rejected").count() == 0
    rep = load_table(df.where("v = 3"), store, "t", "k", quarantine=aside, dedupe=False)
    assert (rep.written, rep.loaded, rep.rejected) == (0, 0, 1) and store.read(spark, "t").columns == ["k", "v"]


def test_content_is_verified(spark, tmp_path):
    class Losing(ParquetStore):
        """A store that changes a value."""

        def read(self, spark, table):
            from pyspark.sql import functions as F
            return super().read(spark, table).withColumn("v", F.when(F.col("k") == "a", 9).otherwise(F.col("v")))

    df = spark.createDataFrame([("a", 1), ("b", 2), ("c", None)], "k string, v int")
    assert load_table(df, ParquetStore(str(tmp_path / "s")), "t", "k", dedupe=False, verify="content").content == "ok"
    rep = load_table(df, Losing(str(tmp_path / "s")), "t", "k", dedupe=False, verify="content")
    assert (rep.content, rep.status, rep.loaded) == ("changed", "mismatch", 3)


def test_a_failed_refresh_leaves_the_table(spark, tmp_path):
    from pyspark.sql import functions as F
    store = ParquetStore(str(tmp_path / "s"))
    df = spark.createDataFrame([("a", 1)], "k string, v int")
    load_table(df, store, "t", "k", dedupe=False)
    with pytest.raises(Exception, match="broken"):
        load_table(df.withColumn("v", F.raise_error(F.lit("broken")).cast("int")), store, "t", "k", dedupe=False)
    assert rows(store.read(spark, "t")) == [("a", 1)]


def test_jdbc_tables_are_created_as_declared(spark, tmp_path, monkeypatch):
    """What a JDBC store runs, without a database: its statements, then an append."""
    store, said, written = JdbcStore("jdbc:none:"), [], []
    monkeypatch.setattr(JdbcStore, "execute", lambda self, spark, *sql: said.extend(sql))
    stored = spark.createDataFrame([("a", 1, "{}")], "k string, n bigint, m string")
    monkeypatch.setattr(JdbcStore, "read", lambda self, spark, table: stored if said else (_ for _ in ()).throw(ValueError()))
    df = spark.createDataFrame([("a", 1, {})], "k string, n bigint, m map<string,string>")

    class Writer:
        def __init__(self, df):
            self.df, self.seen = df, {}

        def format(self, name):
            return self

        def options(self, **kw):
            self.seen.update(kw)
            return self

        def option(self, k, v):
            self.seen[k] = v
            return self

        def mode(self, mode):
            self.seen["mode"] = mode
            return self

        def save(self):
            written.append((self.seen["mode"], self.seen["dbtable"], self.df.columns))

    from pyspark.sql.classic.dataframe import DataFrame as Frame
    real = Frame.write
    monkeypatch.setattr(Frame, "write", property(Writer))
    store.write(df, "t_x", "overwrite", primary_key="k")
    store.write(df, "t_x", "overwrite", primary_key="k")
    monkeypatch.setattr(Frame, "write", real)
    made = 'CREATE TABLE "t_x" ("k" TEXT, "n" BIGINT, "m" JSONB, PRIMARY KEY ("k"))'
    assert said == [made, 'DROP TABLE "t_x"', made]
    assert written == [("append", '"t_x"', ["k", "n", "m"])] * 2


def _plans_written(monkeypatch):
    plans, write = [], ParquetStore.write_buckets
    monkeypatch.setattr(ParquetStore, "write_buckets", lambda self, df, *a, **k: (plans.append(df._jdf.queryExecution().executedPlan().toString()), write(self, df, *a, **k))[1])
    return plans


def test_a_large_upsert_moves_owners_and_not_rows(spark, tmp_path, monkeypatch):
    """Arriving owners too many to broadcast: stored rows are neither shuffled nor sorted, only marked."""
    from pyspark.sql import functions as F

    def table(of, v):
        return of.select(F.concat("k", F.lit("_"), "i").alias("id"), "k", F.lit(v).alias("payload"))

    ids = spark.range(0, 80_000, 1, 1).select(F.concat(F.lit("d"), (F.col("id") % 20_000).cast("string")).alias("k"), (F.col("id") % 7).cast("string").alias("i"))
    arriving = spark.range(0, 30_000, 3).select(F.concat(F.lit("d"), F.col("id").cast("string")).alias("k"))
    some = arriving.where("k not like '%0'").withColumn("i", F.lit("new"))
    for buckets, name in ((1, "one"), (3, "three"), (None, "flat")):
        store = ParquetStore(str(tmp_path), buckets=buckets)
        stored = table(ids, "old").unionByName(table(ids.limit(5).withColumn("k", F.lit(None).cast("string")), "old").withColumn("id", F.lit("nobody")))
        load_table(stored, store, name, "id", dedupe=False, owner=F.col("k"))
        plans = _plans_written(monkeypatch)
        monkeypatch.setattr("unnestor.sinks.tables.stage_at", None)
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "0")
        try:
            rep = load_table(table(some, "new"), store, name, "id", mode="upsert", dedupe=False, owner=F.col("k"), arriving=arriving, verify="content")
        finally:
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        assert rep.status == "ok" and rep.content == "ok"
        come = {r.k for r in arriving.collect()}
        want = sorted([tuple(r) for r in stored.collect() if r.k not in come] + [tuple(r) for r in table(some, "new").collect()], key=str)
        assert sorted(map(tuple, store.read(spark, name).collect()), key=str) == want
        assert not buckets or "LeftSemi" in plans[-1] and "LeftAnti" not in plans[-1]
    # a table with more rows than may be marked
    monkeypatch.setattr("unnestor.sinks.tables.MAX_MARKED_BYTES", 0)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "0")
    try:
        load_table(table(some, "newer"), ParquetStore(str(tmp_path)), "three", "id", mode="upsert", dedupe=False, owner=F.col("k"), arriving=arriving)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "LeftAnti" in plans[-1] and sorted((r[0], r[1], r[2].replace("newer", "new")) for r in store.read(spark, "three").collect() if r.k) == [r for r in want if r[1]]


def test_a_table_in_buckets_is_written_once(spark, tmp_path, monkeypatch):
    """No copy before the buckets, nothing shuffled into them; a failed refresh leaves the stored table."""
    from pyspark.sql import functions as F
    store = ParquetStore(str(tmp_path / "s"), buckets=4)
    monkeypatch.setattr("unnestor.sinks.tables.staging_path", None)
    plans = _plans_written(monkeypatch)
    df = spark.range(0, 500, 1, 3).select(F.col("id").cast("string").alias("k"), F.col("id").alias("v"))
    rep = load_table(df.unionByName(spark.createDataFrame([("", 1)], "k string, v long")), store, "t", "k", dedupe=False, verify="content")
    assert (rep.loaded, rep.rejected, rep.content) == (500, 1, "ok") and "Exchange" not in plans[0]
    assert [p.name for p in (tmp_path / "s").iterdir()] == ["t"] and len(list((tmp_path / "s" / "t").glob("_bucket_of_4=*"))) == 4
    bad = df.withColumn("v", F.raise_error(F.lit("cut")).cast("long"))
    with pytest.raises(Exception, match="cut"):
        load_table(bad, store, "t", "k", dedupe=False)
    assert store.read(spark, "t").count() == 500
    # more buckets than a task keeps files of
    many = ParquetStore(str(tmp_path / "m"), buckets=40)
    assert load_table(df, many, "t", "k", dedupe=False).loaded == 500 and rows(many.read(spark, "t")) == rows(df)
    # a table without any good row
    assert load_table(df.limit(0), store, "u", "k", dedupe=False).loaded == 0 and store.read(spark, "u").columns == ["k", "v"]


def test_the_last_of_several_writes_takes_the_setting_back(spark):
    from unnestor.sinks.tables import OPEN_FILES, _open_files
    setting = lambda: spark.conf.get("spark.sql.maxConcurrentOutputFileWriters", "0")
    one, two = _open_files(spark), _open_files(spark)
    one.__enter__()
    two.__enter__()
    one.__exit__(None, None, None)
    assert setting() == str(OPEN_FILES)
    two.__exit__(None, None, None)
    assert setting() == "0"
    spark.conf.set("spark.sql.maxConcurrentOutputFileWriters", "5")
    try:
        with _open_files(spark):
            assert setting() == "5"
        assert setting() == "5"
    finally:
        spark.conf.unset("spark.sql.maxConcurrentOutputFileWriters")


def test_marks_of_every_row_of_a_chunk(spark):
    """A bitmap as whole numbers: every bit is where the mark of a row is looked for."""
    import random

    from pyspark.sql import functions as F

    from unnestor.sinks.tables import _CHUNK, _marked, _words
    some = random.Random(3)
    want = {0, 7, 8, 31, 32, 63, _CHUNK - 1} | {some.randrange(_CHUNK) for _ in range(5000)}
    bits = spark.createDataFrame([(b,) for b in want], "b long").agg(F.bitmap_construct_agg("b").alias("m"))
    at = spark.range(_CHUNK, 2 * _CHUNK).select(F.col("id").alias("_at"))  # the second chunk of a file
    found = at.join(F.broadcast(bits.select(_words(F.col("m")).alias("_gone")))).where(_marked())
    assert {r["_at"] - _CHUNK for r in found.collect()} == want
