"""Table sinks (K1-K3, K5, K6) with load reconciliation (A3).

A store is either a directory of Parquet tables or a JDBC database; both are
written by Spark's distributed writers (each task writes its own partition,
JDBC in batches), never by collecting rows on the driver.
"""

from __future__ import annotations

import json
import threading
import uuid
from collections import Counter
from contextlib import contextmanager
from dataclasses import dataclass, field
from functools import cached_property
from typing import Sequence

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.values import null_policy_exprs, sanitize_name
from ..operators.checks import content_checksum
from ..operators.upsert import blank_key, latest_per_key
from ..plans.sizing import broadcast_limit, fits_broadcast, measure
from ..plans.staging import stage_at, staging_path, unstage

QUARANTINE_SUFFIX = "__rejected"


# -- K2 ----------------------------------------------------------------------
def column_sql_type(dt: T.DataType, json_type: str = "JSONB") -> str:
    """Relational type of a column: text, boolean, integers, reals and
    timestamps keep their kind; maps, arrays and structs are JSON."""
    if isinstance(dt, T.StringType):
        return "TEXT"
    if isinstance(dt, T.BooleanType):
        return "BOOLEAN"
    if isinstance(dt, T.LongType):
        return "BIGINT"
    if isinstance(dt, (T.IntegerType, T.ShortType, T.ByteType)):
        return "INTEGER"
    if isinstance(dt, T.FloatType):
        return "REAL"
    if isinstance(dt, T.DoubleType):
        return "DOUBLE PRECISION"
    if isinstance(dt, (T.TimestampType, T.TimestampNTZType)):
        return "TIMESTAMP"
    if isinstance(dt, T.DateType):
        return "DATE"
    if isinstance(dt, (T.MapType, T.ArrayType, T.StructType)):
        return json_type
    return "TEXT"


def create_table_sql(schema: T.StructType, table: str, primary_key: str | None) -> str:
    cols = [f'"{f.name}" {column_sql_type(f.dataType)}' for f in schema.fields]
    if primary_key:
        cols.append(f'PRIMARY KEY ("{primary_key}")')
    return f'CREATE TABLE "{table}" ({", ".join(cols)})'


# -- K3 ----------------------------------------------------------------------
def choose_primary_key(schema: T.StructType, declared: str | None = None) -> str:
    """The declared key when the table has it, else the first text column."""
    if declared and declared in schema.fieldNames():
        return declared
    for f in schema.fields:
        if isinstance(f.dataType, T.StringType):
            return f.name
    raise ValueError("no declared key and no text column to use as key")


# -- stores ------------------------------------------------------------------
class Store:
    exact = False  # whether values come back as they were written, to the bit

    def write(self, df: DataFrame, table: str, mode: str = "overwrite", primary_key: str | None = None) -> None:
        raise NotImplementedError

    def read(self, spark: SparkSession, table: str) -> DataFrame:
        raise NotImplementedError

    def exists(self, spark: SparkSession, table: str) -> bool:
        try:
            self.read(spark, table).schema
            return True
        except Exception:
            return False


BUCKET = "_bucket_of_"  # with the number of buckets, the partition column of a table in buckets


# Up to so many buckets, every task keeps a file of each open and rows are written where they are; with more,
# they are brought together by bucket first.
OPEN_FILES = 32

# The rows of a stored table that go are marked in broadcast bitmaps (a bit a row) up to so many bytes.
MAX_MARKED_BYTES = 64 << 20
_AT_BITS = 15
_CHUNK = 1 << _AT_BITS  # positions of one ``bitmap_construct_agg``
_CHUNK_BITS = 24  # a file has fewer than 2 ** 24 chunks (500 billion rows)


def bucket_of(key: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key.cast("string")), F.lit(buckets)).cast("int")


class Arriving:
    """The owners that arrive (a DataFrame of one column), for every table of a
    tree: their size and their buckets are found once."""

    def __init__(self, keys: DataFrame):
        self.keys, self.name = keys, keys.columns[0]
        self._buckets: dict[int, list[int]] = {}

    @staticmethod
    def of(keys: DataFrame | Arriving) -> Arriving:
        return keys if isinstance(keys, Arriving) else Arriving(keys)

    @cached_property
    def small(self) -> bool:
        """Whether they can be broadcast, by their measured size."""
        return fits_broadcast(self.keys.sparkSession, *measure(self.keys, [self.name]))

    def buckets(self, n: int) -> list[int]:
        if n not in self._buckets:
            found = self.keys.select(bucket_of(F.col(f"`{self.name}`"), n)).distinct().collect()
            self._buckets[n] = sorted(r[0] for r in found)
        return self._buckets[n]

    def side(self) -> DataFrame:
        """The keys as ``_arriving``; beyond a broadcast both sides are sorted."""
        out = self.keys.select(F.col(f"`{self.name}`").alias("_arriving"))
        return F.broadcast(out) if self.small else out.hint("merge")


@dataclass
class ParquetStore(Store):
    """One Parquet directory per table under ``root`` (a shared file system
    or object store path).

    With ``buckets``, tables are laid out by the hash of their owner key (the
    document's, for a tree of tables), and an upsert reads and rewrites the
    buckets of the arriving keys alone. A table keeps the number of buckets
    it was written with; a flat one gets buckets at its next refresh.
    ``compression`` is the codec of the files."""

    root: str
    buckets: int | None = None
    compression: str = "zstd"
    exact = True

    def path(self, table: str) -> str:
        return f"{self.root.rstrip('/')}/{table}"

    def write(self, df: DataFrame, table: str, mode: str = "overwrite", primary_key: str | None = None) -> None:
        df.write.mode(mode).option("compression", self.compression).parquet(self.path(table))

    def read_buckets(self, spark: SparkSession, table: str) -> tuple[DataFrame, str | None]:
        """The table with its bucket column, and that column's name."""
        df = spark.read.parquet(self.path(table))
        found = [c for c in df.columns if c.startswith(BUCKET)]
        return df, found[0] if found else None

    def read(self, spark: SparkSession, table: str) -> DataFrame:
        df, bucket = self.read_buckets(spark, table)
        return df.drop(bucket) if bucket else df

    def exists(self, spark: SparkSession, table: str) -> bool:
        """A file system check (no read is attempted on a missing folder)."""
        return _folder(spark, self.path(table)).exists()

    def write_buckets(self, df: DataFrame, table: str, owner: Column, buckets: int, only: bool = False) -> None:
        """Write ``df`` in buckets of ``owner``; ``only``: the buckets that it
        has rows of, leaving the others as they are. Every task writes its
        rows into the buckets' files, so nothing is shuffled or sorted. More
        than ``OPEN_FILES`` buckets would be too many files: rows come together
        by bucket, and the planner splits a bucket that is too large."""
        name = f"{BUCKET}{buckets}"
        out = df.withColumn(name, bucket_of(owner, buckets))
        if buckets > OPEN_FILES:
            out = out.hint("rebalance", name)
        with _open_files(df.sparkSession):
            (out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic" if only else "static")
             .option("compression", self.compression).partitionBy(name).parquet(self.path(table)))
        self._keep_schema(df, table, name)

    def _keep_schema(self, df: DataFrame, table: str, bucket: str) -> None:
        """A table without any rows has an empty file in its first bucket."""
        if not any(n.startswith(f"{bucket}=") for n in _folder(df.sparkSession, self.path(table)).names()):
            df.limit(0).write.mode("overwrite").parquet(f"{self.path(table)}/{bucket}=0")

    def replace_owned(self, rows: DataFrame, table: str, owner: Column, arriving: DataFrame | Arriving, observe) -> DataFrame:
        """Remove every stored row whose owner is in ``arriving`` (one column)
        and add ``rows``; returns what is stored where rows were written. Of a
        table in buckets only the touched ones are read and written.
        ``observe`` is applied to the rows on their way out."""
        spark, arriving = rows.sparkSession, Arriving.of(arriving)
        current, bucket = self.read_buckets(spark, table)
        if bucket is None:
            merged = observe(_kept(current, F.lit(True), owner, arriving).unionByName(rows.select(*current.columns)))
            swap_in(merged, self, table)
            return self.read(spark, table)
        buckets = int(bucket[len(BUCKET):])
        touched = arriving.buckets(buckets)
        folders = {t: _folder(spark, f"{self.path(table)}/{bucket}={t}") for t in touched}
        before = {t: f.names() for t, f in folders.items()}
        columns = [c for c in current.columns if c != bucket]
        kept = _kept(current, F.col(bucket).isin(touched), owner, arriving) if touched else current.limit(0)
        merged = observe(kept.select(*columns).unionByName(rows.select(*columns)))
        self.write_buckets(merged, table, owner, buckets, only=True)
        for t, f in folders.items():  # a bucket that has no rows left was not written
            if before[t] & f.names():
                f.delete()
        self._keep_schema(rows.select(*columns), table, bucket)
        after = self.read_buckets(spark, table)[0]
        return (after.where(F.col(bucket).isin(touched)) if touched else after.limit(0)).drop(bucket)


def _unowned(current: DataFrame, owner: Column, arriving: Arriving) -> DataFrame:
    """Rows whose owner doesn't arrive."""
    return current.withColumn("_owner", owner).join(arriving.side(), F.col("_owner") == F.col("_arriving"), "left_anti").drop("_owner")


def _kept(current: DataFrame, where: Column, owner: Column, arriving: Arriving) -> DataFrame:
    """Rows of a stored Parquet table ``where`` their owner doesn't arrive. Where the arriving keys are too
    many to broadcast, only the stored rows' owners and places (file and row) are sorted with them; the places
    of the rows that go come back as bitmaps, and the rows themselves stay where they are."""
    spark = current.sparkSession
    here, files = current.where(where), current.inputFiles()
    if (arriving.small or broadcast_limit(spark) < 0
            or here.count() // 8 + len(files) * (_CHUNK // 8) > MAX_MARKED_BYTES or not _told_apart(spark, files)):
        return _unowned(here, owner, arriving)
    at = F.col("_metadata.row_index")
    chunk = (_file_hash("_metadata.file_path") + F.shiftright(at, _AT_BITS)).alias("_chunk")
    placed = current.select("*", chunk, at.alias("_at")).where(where)
    gone = (placed.select(owner.alias("_owner"), "_chunk", F.expr(f"_at % {_CHUNK}").alias("_bit"))
            .join(arriving.side(), F.col("_owner") == F.col("_arriving"), "left_semi")
            .groupBy("_chunk").agg(F.bitmap_construct_agg(F.col("_bit")).alias("_gone"))
            .select("_chunk", _words(F.col("_gone")).alias("_gone")))
    return (placed.join(F.broadcast(gone), "_chunk", "left")
            .where(F.col("_gone").isNull() | ~_marked()).select(*current.columns))


def _file_hash(path: str) -> Column:
    """A number of a file, with room for the numbers of its chunks."""
    return F.xxhash64(path).bitwiseAND(F.lit(-1 << _CHUNK_BITS))


def _words(bitmap: Column) -> Column:
    """A bitmap as an array of whole numbers of four bytes: one is read for
    each row, and a row that reads of a binary copies all of it."""
    def word(i: Column) -> Column:
        n = F.conv(F.hex(F.substring(bitmap, i * 4 + 1, F.lit(4))), 16, 10).cast("long")
        return F.when(n >= 1 << 31, n - (1 << 32)).otherwise(n).cast("int")

    return F.transform(F.sequence(F.lit(0), F.lit(_CHUNK // 32 - 1)), word)


def _marked() -> Column:
    """Whether the row at ``_at`` is marked in the words of its chunk, ``_gone``
    (whose bytes are in the order of a number's digits)."""
    return F.expr(f"getbit(_gone[cast(_at % {_CHUNK} div 32 as int)], cast(_at % 8 + 24 - 8 * (_at % 32 div 8) as int))") != 0


def _told_apart(spark: SparkSession, files: list[str]) -> bool:
    """Whether no two of the files have the same hash."""
    each = spark.range(1).select(F.explode(F.from_json(F.lit(json.dumps(files)), "array<string>")).alias("f"))
    return each.select(_file_hash("f")).distinct().count() == len(files)


_WRITERS = "spark.sql.maxConcurrentOutputFileWriters"
_writing, _writing_lock = Counter(), threading.Lock()


@contextmanager
def _open_files(spark: SparkSession):
    """Tasks that write into folders keep up to ``OPEN_FILES`` files open, and
    sort nothing up to there. Of tables written at the same time the last one
    takes the setting back: a write that is planned with it must run with it."""
    session = spark._jsparkSession.hashCode()
    with _writing_lock:
        if _writing[session] or spark.conf.get(_WRITERS, "0") == "0":
            spark.conf.set(_WRITERS, str(OPEN_FILES))
            _writing[session] += 1
            ours = True
        else:
            ours = False
    try:
        yield
    finally:
        with _writing_lock:
            if ours:
                _writing[session] -= 1
                if not _writing[session]:
                    spark.conf.unset(_WRITERS)


class _folder:
    """A folder of any file system that the cluster's client reaches."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, jvm = spark, spark.sparkContext._jvm
        self.path = jvm.org.apache.hadoop.fs.Path(path)
        self.fs = self.path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def exists(self) -> bool:
        return bool(self.fs.exists(self.path))

    def names(self) -> set[str]:
        return {f.getPath().getName() for f in self.fs.listStatus(self.path)} if self.exists() else set()

    def delete(self) -> None:
        self.fs.delete(self.path, True)

    def move(self, to: "_folder") -> None:
        to.delete()
        to.fs.mkdirs(to.path.getParent())
        if not self.fs.rename(self.path, to.path):
            raise OSError(f"can't move {self.path} to {to.path}")

    def beside(self, other: "_folder") -> bool:
        return self.fs.getUri().toString() == other.fs.getUri().toString()


INCOMING = "__incoming"


def swap_in(df: DataFrame, store: ParquetStore, table: str) -> None:
    """Write a table next to the stored one and put it in its place: a job
    that fails leaves the stored table as it was, and it may be read by it."""
    at = store.path(table) + INCOMING
    df.write.mode("overwrite").option("compression", store.compression).parquet(at)
    _folder(df.sparkSession, at).move(_folder(df.sparkSession, store.path(table)))


@dataclass
class JdbcStore(Store):
    """A relational database through Spark's JDBC data source. Rows are
    inserted by the executors in batches of ``batchsize`` (K5); at most
    ``num_partitions`` connections are open at once.

    Reads (the stored table an upsert merges into, the read-back count) are
    parallel when a numeric ``partition_column`` with bounds, or a list of
    ``predicates`` (one per partition, in the database's SQL), is given;
    otherwise a table is read through one connection. Counts and limits are
    pushed down to the database. Names are quoted, as in ``create_table_sql``."""

    url: str
    properties: dict = field(default_factory=dict)
    batchsize: int = 1000
    num_partitions: int | None = None
    partition_column: str | None = None
    lower_bound: int | None = None
    upper_bound: int | None = None
    predicates: list[str] | None = None

    def _opts(self, table: str) -> dict:
        opts = {"url": self.url, "dbtable": f'"{table}"', "pushDownAggregate": "true",
                "pushDownLimit": "true", **self.properties}
        if self.num_partitions:
            opts["numPartitions"] = str(self.num_partitions)
        return opts

    def execute(self, spark: SparkSession, *statements: str) -> None:
        """Run statements on one connection of the driver (metadata only: rows
        are written by the executors)."""
        jvm = spark.sparkContext._jvm
        if "driver" in self.properties:
            jvm.org.apache.spark.sql.execution.datasources.jdbc.DriverRegistry.register(self.properties["driver"])
        props = jvm.java.util.Properties()
        for k, v in self.properties.items():
            props.setProperty(k, str(v))
        connection = jvm.java.sql.DriverManager.getConnection(self.url, props)
        try:
            for sql in statements:
                connection.createStatement().execute(sql)
        finally:
            connection.close()

    def create(self, df: DataFrame, table: str, primary_key: str) -> None:
        """K2: the table anew, with the declared types and the key constraint."""
        drop = [f'DROP TABLE "{table}"'] if self.exists(df.sparkSession, table) else []
        self.execute(df.sparkSession, *drop, create_table_sql(df.schema, table, primary_key))

    def write(self, df: DataFrame, table: str, mode: str = "overwrite", primary_key: str | None = None) -> None:
        """With a key, the table is created by ``create_table_sql`` and the rows
        are appended to it; else Spark's dialect picks the types."""
        if mode == "overwrite" and primary_key:
            self.create(df, table, primary_key)
            mode = "append"
        (df.write.format("jdbc").options(**self._opts(table))
         .option("batchsize", str(self.batchsize))
         .mode(mode).save())

    def read(self, spark: SparkSession, table: str) -> DataFrame:
        opts = self._opts(table)
        if self.predicates:
            props = {k: v for k, v in opts.items() if k not in ("url", "dbtable")}
            return spark.read.jdbc(self.url, f'"{table}"', predicates=self.predicates, properties=props)
        if self.partition_column and self.num_partitions:
            opts.update(partitionColumn=self.partition_column, lowerBound=str(self.lower_bound),
                        upperBound=str(self.upper_bound))
        return spark.read.format("jdbc").options(**opts).load()


@dataclass(frozen=True)
class LoadReport:
    """Rows written, read back and set aside. ``content`` compares the
    checksums of both where that was asked for: ``ok`` or ``changed``."""

    table: str
    written: int
    loaded: int
    rejected: int
    content: str | None = None

    @property
    def status(self) -> str:
        return "ok" if self.written == self.loaded and self.content in (None, "ok") else "mismatch"


REJECT_COLUMN, REJECT_REASON = "_reject_column", "_reject_reason"
_NULL_PART = "__HIVE_DEFAULT_PARTITION__"  # fixed value: folder of a null partition column


def split_write(rows: DataFrame, folder: str) -> tuple[str, list[str]]:
    """K6: write good and rejected rows in one pass. Rows that have a
    ``_reject_reason`` go to folders of their column and reason, the others to
    one of their own; returns it and those of the rejected. Tasks keep a file
    open for each, so nothing is sorted."""
    spark = rows.sparkSession
    with _open_files(spark):
        rows.write.mode("overwrite").partitionBy(REJECT_COLUMN, REJECT_REASON).parquet(folder)
    own = [n for n in _folder(spark, folder).names() if n.startswith(f"{REJECT_COLUMN}=")]
    good = f"{REJECT_COLUMN}={_NULL_PART}"
    return f"{folder}/{good}/{REJECT_REASON}={_NULL_PART}", [f"{folder}/{n}" for n in own if n != good]


# -- K1 / K4 / K6 ------------------------------------------------------------
def load_table(
    df: DataFrame,
    store: Store,
    table_name: str,
    primary_key: str | None = None,
    mode: str = "refresh",
    order_by: str | Sequence[str] | None = None,
    quarantine: Store | None = None,
    dedupe: bool = True,
    owner: Column | None = None,
    arriving: DataFrame | Arriving | None = None,
    verify: str = "rows",
) -> LoadReport:
    """Write one table and reconcile it.

    * rows with a null or blank key are set aside and counted, never silently
      dropped; with ``quarantine`` they are written there, with the column and
      the reason, by the pass that writes the good rows;
    * the null policy and control-character strip are applied (V6, V9);
    * several rows with one key collapse to the latest (``order_by``); with
      keys unique by construction (document ids and the keys derived from
      them) ``dedupe=False`` skips this shuffle;
    * ``mode="refresh"`` replaces the table. ``mode="upsert"`` replaces the
      stored rows of the arriving keys. ``owner`` is the key that a stored row
      goes with (an expression over the table's columns, by default its own
      key) and ``arriving`` the owners that arrive (by default those of the
      rows): a child whose parent arrives without it is removed;
    * a Parquet table is written beside the stored one and takes its place
      when it is whole; one in buckets is rewritten where keys arrive;
    * the written count is observed during the write itself, then compared
      with a read-back count (A3), and with ``verify="content"`` the checksums
      of both too (for stores that give back what they got). Of an upsert in
      buckets both are those of the touched buckets.
    """
    if mode not in ("refresh", "upsert"):
        raise ValueError(f"mode must be 'refresh' or 'upsert', not {mode!r}")
    if verify not in ("rows", "content"):
        raise ValueError(f"verify must be 'rows' or 'content', not {verify!r}")
    spark = df.sparkSession
    name = sanitize_name(table_name)
    pk = choose_primary_key(df.schema, primary_key)
    owner = F.col(f"`{pk}`") if owner is None else owner
    reason = reject_reason(pk, df.schema)
    rows = df.select(*null_policy_exprs(df.schema), reason.alias(REJECT_REASON))
    if dedupe:
        rows = _latest_good(rows, pk, order_by)
    good = F.col(REJECT_REASON).isNull()
    rows = rows.withColumn(REJECT_COLUMN, F.when(~good, F.lit(pk)))

    # Counts come from observations in a write's final stage, where only
    # successful task attempts are merged.
    def observed(frame: DataFrame, obs: Observation, where: Column) -> DataFrame:
        metrics = [F.count_if(where).alias("n"), F.count_if(~where).alias("bad")]
        return frame.observe(obs, *metrics, *([content_checksum(df.columns, where).alias("sum")] if verify == "content" else []))

    obs = Observation(f"written_{name}_{uuid.uuid4().hex[:12]}")
    parquet = isinstance(store, ParquetStore)
    upsert = mode == "upsert" and store.exists(spark, name)
    if parquet and quarantine is None and (arriving is not None if upsert else store.buckets):
        counts = observed(rows, obs, good).where(good).drop(REJECT_COLUMN, REJECT_REASON)
        return _load_rows(counts, store, name, upsert, owner, arriving, observed, obs, verify)
    plain = parquet and not upsert and not store.buckets
    staged = None if plain else staging_path(spark, f"split_{name}")
    folder = store.path(name) + INCOMING if plain else staged
    counts = observed(rows, obs, good)
    if quarantine is not None:
        at, bad = split_write(counts, folder)
    else:
        at, bad = folder, []
        counts.where(good).drop(REJECT_COLUMN, REJECT_REASON).write.mode("overwrite").parquet(at)
    seen = _figures(obs)
    rejected = int(seen["bad"])
    if quarantine is not None:
        _set_aside(spark, rows, folder, bad, quarantine, name + QUARANTINE_SUFFIX)
    if not _folder(spark, at).exists():  # no good rows: the schema alone
        rows.where("false").drop(REJECT_COLUMN, REJECT_REASON).write.mode("overwrite").parquet(at)
    if plain:
        _folder(spark, at).move(_folder(spark, store.path(name)))
        _folder(spark, folder).delete()
        back = store.read(spark, name)
    else:
        clean = spark.read.schema(rows.drop(REJECT_COLUMN, REJECT_REASON).schema).parquet(at)
        back, seen = _write_staged(clean, store, name, upsert, pk, owner, arriving, observed, staged)
    report = _reported(name, back, seen, rejected, df.columns, verify == "content" and store.exact)
    if staged is not None:  # only once the table is written
        _folder(spark, staged).delete()
    return report


def _reported(name: str, back: DataFrame, seen: dict, rejected: int, columns: list[str], content: bool) -> LoadReport:
    """What was observed in the write against what is read back."""
    found = back.agg(F.count(F.lit(1)).alias("n"), *([content_checksum(columns).alias("sum")] if content else [])).first()
    same = None if not content else "ok" if found["sum"] == seen["sum"] else "changed"
    return LoadReport(name, int(seen["n"]), int(found["n"]), rejected, same)


def _load_rows(clean, store, name, upsert, owner, arriving, observed, obs, verify) -> LoadReport:
    """Rows that are read once, with nothing to set aside, go straight into a
    Parquet store: a refresh in buckets beside the stored table, which it then
    replaces; an upsert over the touched buckets."""
    spark = clean.sparkSession
    if upsert:
        merged = Observation(f"merged_{name}_{uuid.uuid4().hex[:12]}")
        back = store.replace_owned(clean, name, owner, arriving, lambda frame: observed(frame, merged, F.lit(True)))
        rejected, seen = int(_figures(obs)["bad"]), _figures(merged)
    else:
        store.write_buckets(clean, name + INCOMING, owner, store.buckets)
        _folder(spark, store.path(name + INCOMING)).move(_folder(spark, store.path(name)))
        back, seen = store.read(spark, name), _figures(obs)
        rejected = int(seen["bad"])
    return _reported(name, back, seen, rejected, clean.columns, verify == "content" and store.exact)


def _write_staged(clean, store, name, upsert, pk, owner, arriving, observed, staged) -> tuple[DataFrame, dict]:
    """The staged good rows into a store that can't take the files themselves;
    what is read back, and the observed figures."""
    spark = clean.sparkSession
    obs = Observation(f"merged_{name}_{uuid.uuid4().hex[:12]}")

    def watch(frame: DataFrame) -> DataFrame:
        return observed(frame, obs, F.lit(True))

    try:
        if upsert:
            if arriving is None:
                arriving = clean.select(owner.alias("_key")).distinct()
            if isinstance(store, ParquetStore):
                back = store.replace_owned(clean, name, owner, arriving, watch)
            else:
                current = store.read(spark, name)
                merged, at = stage_at(_unowned(current, owner, Arriving.of(arriving)).unionByName(clean.select(*current.columns)), f"merge_{name}")
                store.write(watch(merged), name, "overwrite", primary_key=pk)
                unstage(spark, at)
                back = store.read(spark, name)
        elif isinstance(store, ParquetStore):
            store.write_buckets(watch(clean), name, owner, store.buckets)
            back = store.read(spark, name)
        else:
            store.write(watch(clean), name, "overwrite", primary_key=pk)
            back = store.read(spark, name)
    except Exception as ex:
        raise RuntimeError(f"writing {name!r} failed; its rows are kept at {staged}") from ex
    return back, _figures(obs)


def _figures(obs: Observation) -> dict:
    """What was observed; nothing is where the planner saw that there are no
    rows and ran no observation. (If it were wrong, the read-back would differ.)"""
    try:
        return obs.get
    except Py4JJavaError:
        return {"n": 0, "bad": 0, "sum": 0}


def _set_aside(spark: SparkSession, rows: DataFrame, folder: str, bad: list[str], quarantine: Store, name: str) -> None:
    """Move the folders of rejected rows to the quarantine, or copy them where
    it can't take folders. Without any, its table is empty."""
    to = _folder(spark, quarantine.path(name)) if isinstance(quarantine, ParquetStore) else None
    if to is not None:
        to.delete()
        if bad and to.beside(_folder(spark, folder)):
            for path in bad:
                _folder(spark, path).move(_folder(spark, f"{quarantine.path(name)}/{path.rsplit('/', 1)[1]}"))
            return
    columns = [c for c in rows.columns if c not in (REJECT_COLUMN, REJECT_REASON)]
    found = spark.read.option("basePath", folder).schema(rows.schema).parquet(*bad) if bad else rows.where("false")
    quarantine.write(found.select(*columns, REJECT_COLUMN, REJECT_REASON), name, "overwrite")


def reject_reason(key: str, schema: T.StructType) -> Column:
    """Why a row can't be stored: its key is null, or text without anything
    but control characters. Null for a good row."""
    return F.when(F.col(f"`{key}`").isNull(), "null key").when(blank_key(key, schema), "blank key")


def _latest_good(rows: DataFrame, pk: str, order_by: str | Sequence[str] | None) -> DataFrame:
    """The latest row of each key, and every rejected row, in one pass: a
    rejected row is a group of its own."""
    bad = F.col(REJECT_REASON).isNotNull()
    group = F.struct(F.when(bad, F.monotonically_increasing_id()).alias("i"), F.when(~bad, F.col(f"`{pk}`")).alias("k"))
    return latest_per_key(rows.withColumn("_grp", group), "_grp", order_by).drop("_grp")
