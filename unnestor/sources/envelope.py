"""Whole-database envelopes of any size, read by many tasks.

An envelope is one JSON object whose ``rows`` are objects, often on a single
line of many gigabytes. Spark's text reader cuts it at closing braces, which
splits like lines do, and two passes put the rows together:

1. Each split is summed up: does it change whether we are inside a text, by
   how much does it change the depth of brackets, and how low does that fall,
   for either state at its beginning. One small row a split; followed over the
   splits of a file they give the true state at every beginning.
2. Each split emits the rows that lie in it, and the pieces of the rows that
   reach over its ends. Only these pieces are shuffled.

Rows are cut where the depth falls back to that of the ``rows`` array, so
nothing that a document holds (braces in texts, arrays of objects) can end it.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.sizing import fits_broadcast, measure
from ..plans.staging import stage_at, unstage

ROWS_DEPTH = 2  # of the rows array: inside the envelope, inside the array
HEAD = 1 << 20  # characters in which an envelope's rows must begin
CUT_SHORT = "envelope is cut short"
NO_ENVELOPE = "not an envelope"

_ESCAPE = re.compile(r"\\.", re.S)
_TOKEN = re.compile(r'"[^"\\]*(?:\\.[^"\\]*)*"|[{\[\]}]', re.S)
_ROWS = re.compile(r'"rows"\s*:\s*\[\s*$')


def _outside(fragment: str, in_text: bool) -> tuple[str, bool]:
    """What of a fragment lies outside texts, and whether one is open at its
    end. No escape reaches over a closing brace, so fragments stand alone."""
    if "\\" in fragment:
        fragment = _ESCAPE.sub("", fragment)
    parts = fragment.split('"')
    return "".join(parts[1::2] if in_text else parts[::2]), in_text ^ (len(parts) % 2 == 0)


class _Reader:
    """A reader of fragments: inside a text or not, how deep, how deep at least after a brace."""

    def __init__(self, in_text: bool = False, depth: int = 0):
        self.in_text, self.depth, self.least = in_text, depth, None

    def read(self, fragment: str) -> bool:
        """Read a fragment and its closing brace; whether that ended a row."""
        outside, self.in_text = _outside(fragment, self.in_text)
        self.depth += outside.count("{") + outside.count("[") - outside.count("}") - outside.count("]")
        if self.in_text:
            return False
        self.depth -= 1
        if self.least is None or self.depth < self.least:
            self.least = self.depth
        return self.depth == ROWS_DEPTH


def _head_end(text: str) -> int | None:
    """Where the first row begins in what an envelope begins with; -1 if it
    ends without one, None if it isn't an envelope."""
    depth, rows = 0, False
    for m in _TOKEN.finditer(text[: 2 * HEAD]):
        sign = m.group()
        if sign in "{[":
            depth += 1
            if sign == "[" and depth == ROWS_DEPTH:
                rows = _ROWS.search(text[: m.end()]) is not None
            elif sign == "{" and depth == ROWS_DEPTH + 1 and rows:
                return m.start()
        elif sign in "]}":
            depth -= 1
            if rows and depth < ROWS_DEPTH:
                return -1
    return -1 if rows else None


def _fragments(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(file, block, seq, value): the text between closing braces, by split.
    The fragments of a split follow one another in its task."""
    return spark.read.option("lineSep", "}").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("seq"), "value")


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, Iterator[str]]]:
    """(all columns but the last, values of the last) of each run of fragments of one split."""
    for batch in batches:
        *keys, values = (batch.column(i) for i in range(batch.num_columns))
        blocks, a = keys[1].to_pylist(), 0
        while a < len(blocks):
            b, file = a, keys[0][a].as_py()
            while b < len(blocks) and blocks[b] == blocks[a] and keys[0][b].as_py() == file:
                b += 1
            yield tuple(k[a].as_py() for k in keys), (v.as_py() for v in values[a:b])
            a = b


def _sum_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[tuple, list[_Reader]] = {}
    for key, values in _runs(batches):
        readers = held.setdefault(key, [_Reader(False), _Reader(True)])
        for value in values:
            for r in readers:
                r.read(value)
    if held:
        rows = [(*key, *(x for r in readers for x in (r.in_text, r.depth, r.least))) for key, readers in held.items()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _SUMS.values())], names=list(_SUMS))


_SUMS = {"file": pa.string(), "block": pa.int64()} | {
    f"{name}{i}": kind for i in (0, 1) for name, kind in (("text", pa.bool_()), ("depth", pa.int64()), ("least", pa.int64()))}
_STARTS = {"file": pa.string(), "block": pa.int64(), "in_text": pa.bool_(), "depth": pa.int64(), "owner": pa.int64(), "end": pa.int64()}
_DDL = {pa.string(): "string", pa.int64(): "bigint", pa.bool_(): "boolean"}


def _ddl(columns: dict) -> str:
    return ", ".join(f"`{name}` {_DDL[kind]}" for name, kind in columns.items())


def _follow(key: tuple, table: pa.Table) -> pa.Table:
    """The state at the beginning of each split of a file, the split in which
    the row that is open there began, and at the last one the depth at the end."""
    out, in_text, depth, owner = [], False, 0, 0
    for r in sorted(table.to_pylist(), key=lambda r: r["block"]):
        if depth == ROWS_DEPTH and not in_text:
            owner = r["block"]  # between two rows
        out.append({"file": r["file"], "block": r["block"], "in_text": in_text, "depth": depth, "owner": owner, "end": None})
        i = int(in_text)
        if r[f"least{i}"] is not None and depth + r[f"least{i}"] <= ROWS_DEPTH:
            owner = r["block"]  # a row ends here, so the next one that is open began here
        in_text, depth = r[f"text{i}"], depth + r[f"depth{i}"]
    out[-1]["end"] = -9 if in_text else depth
    return pa.Table.from_pylist(out, schema=pa.schema(list(_STARTS.items())))


_PIECES = {"file": pa.string(), "owner": pa.int64(), "block": pa.int64(), "part": pa.int64(), "ends": pa.bool_(), "first": pa.bool_(), "value": pa.string()}


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The pieces of rows in each split. A row that lies in it is one piece,
    with ``owner`` null; ``first``: it begins with the head of the envelope."""
    out: list[tuple] = []
    size = 0
    now, reader, held, whole, first = None, None, [], False, False

    def flush():
        nonlocal size
        rows, size = list(zip(*out)), 0
        out.clear()
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(rows, _PIECES.values())], names=list(_PIECES))

    def leave():
        """What is left of a split belongs to a row that began in it, or runs through it."""
        if now is not None and held:
            file, block, _, _, owner = now
            out.append((file, block if whole else owner, block, 2, False, first, "}".join(held) + "}"))

    for key, values in _runs(batches):
        if key != now:
            leave()
            now, held = key, []
            file, block, in_text, depth, owner = key
            reader = _Reader(in_text, depth)
            first = block == 0
            whole = first or (depth == ROWS_DEPTH and not in_text)
        for value in values:
            ended = reader.read(value)
            held.append(value)
            if ended:
                text = "}".join(held) + "}"
                out.append((now[0], None if whole else now[4], now[1], 1, True, first, text))
                size += len(text)
                held, whole, first = [], True, False
        if size > 1 << 24:
            yield flush()
    leave()
    if out:
        yield flush()


def _rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(file, value, reason): the text of each row, without what stands before
    it; of an envelope's beginning that holds no row, the reason if it is none."""
    for batch in batches:
        out = []
        for file, ends, first, value in zip(*(batch.column(c).to_pylist() for c in ("file", "ends", "first", "value"))):
            at = _head_end(value) if first else len(value) - len(value.lstrip(" \t\r\n,"))
            if at is None:
                out.append((file, None, NO_ENVELOPE))
            elif ends and at >= 0:
                out.append((file, value[at:], None))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*out)], names=["file", "value", "reason"])


def scan_envelopes(spark: SparkSession, path: str | list[str]) -> tuple[DataFrame, DataFrame]:
    """``(rows, rejects)`` of envelope files: ``DataFrame[value]``, the JSON
    text of every row, verbatim, and ``DataFrame[file, reason]``, the files
    that are no envelopes (none of their rows are given) and those that are
    cut short (rows that end before the cut are given).

    Both passes must cut the files alike; if the cluster's settings change
    between them, the job fails with a message."""
    fragments = _fragments(spark, path)
    sums = fragments.select("file", "block", "value").mapInArrow(_sum_up, _ddl(_SUMS))
    starts, starts_at = stage_at(sums.groupBy("file").applyInArrow(_follow, _ddl(_STARTS)), "splits")
    begin = starts.select("file", "block", "in_text", "depth", "owner")
    columns = ["file", "block", "in_text", "depth", "owner", "value"]
    if fits_broadcast(spark, *measure(begin, begin.columns)):
        placed = fragments.join(F.broadcast(begin), ["file", "block"], "left")
    else:  # one row a split: only for millions of splits
        placed = fragments.join(begin.hint("merge"), ["file", "block"], "left").repartition("file", "block").sortWithinPartitions("file", "block", "seq")
    known = F.when(F.col("depth").isNull(), F.raise_error(F.lit("the splits of the envelopes changed between two passes; load again")).cast("bigint")).otherwise(F.col("depth"))
    pieces, pieces_at = stage_at(placed.withColumn("depth", known).select(*columns).mapInArrow(_cut, _ddl(_PIECES)), "envelope-rows")
    whole = pieces.where("owner is null").select("file", "ends", "first", "value")
    # a row over several splits: its pieces in their order, at most one document
    part = F.array_sort(F.collect_list(F.struct("block", "part", "value")))
    joined = pieces.where("owner is not null").groupBy("file", "owner").agg(
        part.alias("p"), F.max("ends").alias("ends"), F.max("first").alias("first"))
    joined = joined.select("file", "ends", "first", F.array_join(F.transform("p", lambda x: x["value"]), "").alias("value"))
    found = whole.unionByName(joined).mapInArrow(_rows_of, "file string, value string, reason string")
    none = found.where("reason is not null").select("file", "reason").distinct()
    cut = starts.where("end not in (0, -1)").select("file", F.lit(CUT_SHORT).alias("reason"))
    rejects, _ = stage_at(none.unionByName(cut.join(none.select("file"), "file", "left_anti")), "envelope-rejects")
    unstage(spark, starts_at)
    refused = rejects.where(F.col("reason") == NO_ENVELOPE).select("file")
    rows = found.where("value is not null")
    if refused.limit(1).count():
        rows = rows.join(refused.hint("merge") if not fits_broadcast(spark, *measure(refused, ["file"])) else F.broadcast(refused), "file", "left_anti")
    return rows.select("value"), rejects
