"""Document sources (S1-S5): dumps of a document database -> ``DataFrame[doc]``.

A document is one JSON object; ``_id`` is its identity. Two dump layouts are
read, both with Spark's own readers so the scan is distributed:

* the whole-database envelope ``{"rows": [{"id": .., "doc": {..}}, ..]}``, one
  JSON value per file, with or without line breaks, and
* the line-per-row form, where each line holds one envelope row or one bare
  document, optionally followed by a comma, with the envelope's opening and
  closing lines around them.

Both are splittable; lines are read in one pass, envelopes in two.

``parse_documents`` applies a declared layout to the ``doc`` column (S3).
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.json_text import Paths, guard
from ..functions.values import as_float, as_timestamp
from ..plans.catalog import TableSpec
from .envelope import scan_envelopes

DOC = "doc"
DOC_HASH = "_doc_hash"
CORRUPT = "_corrupt_record"
REJECT = "_reject_reason"

_ENVELOPE = "rows array<struct<id:string,doc:string>>"
_ROW = "id string, doc string, _id string"
# the lines around an envelope's rows
_FRAME = r'^(\{[^{}]*"rows"\s*:\s*\[|\]\s*\}?)$'


# -- S1 + S2 -----------------------------------------------------------------
def unwrap_envelope(texts: DataFrame, column: str = "value", mode: str = "strict") -> DataFrame:
    """Envelope texts ``{"rows": [{"id": .., "doc": {..}}, ..]}`` ->
    ``DataFrame[id, doc]``; ``doc`` keeps the document's JSON text verbatim.
    Rows whose document is null (deleted documents) are dropped. A text that
    isn't such an envelope fails the job in strict mode; in permissive mode
    it gives no rows and is left to ``rejected_envelopes``."""
    options = {"mode": "FAILFAST" if mode == "strict" else "PERMISSIVE"}
    env = texts.select(F.from_json(F.col(column), _ENVELOPE, options).alias("e"))
    # outer form + filter above it: no inferred size(rows) > 0 filter that
    # would be pushed below the parse and parse every envelope twice
    rows = env.select(F.explode_outer("e.rows").alias("r"))
    return rows.select(F.col("r.id").alias("id"), F.col("r.doc").alias(DOC)).where(
        F.col(DOC).isNotNull()
    )


def rejected_envelopes(texts: DataFrame, column: str = "value") -> DataFrame:
    """``DataFrame[_reject_reason, doc]``: the texts that aren't whole
    envelopes, as they are."""
    options = {"columnNameOfCorruptRecord": CORRUPT}
    # above a generator, so that the parse is evaluated once
    parsed = texts.select(column, F.explode_outer(F.array(F.from_json(column, f"{_ENVELOPE}, {CORRUPT} string", options))).alias("e"))
    bad = F.col("e").isNull() | F.col(f"e.{CORRUPT}").isNotNull() | F.col("e.rows").isNull()
    return parsed.where(bad).select(F.lit("not an envelope").alias(REJECT), F.col(column).alias(DOC))


def read_envelope(spark: SparkSession, path: str | list[str], mode: str = "strict") -> DataFrame:
    """Whole-envelope dump file(s) of any size, each read by many tasks (see
    ``sources.envelope``) -> ``DataFrame[id, doc]``. In strict mode a file that
    is no whole envelope fails the read."""
    return read_envelopes(spark, path, mode)[0]


def read_envelopes(spark: SparkSession, path: str | list[str], mode: str = "strict") -> tuple[DataFrame, DataFrame]:
    """``(documents, rejects)`` of envelope files; rejects are
    ``DataFrame[_reject_reason, doc]``: files that are no envelopes or are cut
    short, by their name, and rows that hold no document, as they are. The
    rows of a file that end before it is cut are read."""
    rows, files = scan_envelopes(spark, path)
    if mode == "strict":
        bad = files.first()
        if bad:
            raise ValueError(f"{bad['file']}: {bad['reason']}")
    bad_rows = rejected_lines(rows)
    return document_lines(rows, mode=mode), files.select(F.col("reason").alias(REJECT), F.col("file").alias(DOC)).unionByName(bad_rows)


def scan_lines(lines: DataFrame, column: str = "value") -> DataFrame:
    """Line-per-row text -> ``DataFrame[id, doc, _reject_reason, line]``, a row
    for every line but blank ones, the envelope's head and tail, and rows with
    a null document (deleted documents).

    A line is a bare document if it has ``_id``, else an envelope row if it
    has ``doc``, else a bare document without a key (``id`` null). Lines that
    are not whole JSON objects, and envelope rows whose ``doc`` isn't an
    object, have no ``doc`` and a ``_reject_reason``. A trailing comma is
    allowed."""
    line = F.regexp_replace(F.trim(F.col(column)), r",\s*$", "")
    frame = F.col("line").rlike(_FRAME) | (F.col("line") == "")
    row = F.from_json("line", f"{_ROW}, {CORRUPT} string", {"columnNameOfCorruptRecord": CORRUPT})
    # above a generator, so that the parse is evaluated once
    parsed = lines.select(line.alias("line")).where(~frame).select("line", F.explode_outer(F.array(row)).alias("r"))
    kind = (
        F.when(F.col("r").isNull() | F.col(f"r.{CORRUPT}").isNotNull() | ~F.col("line").startswith("{"), "unreadable")
        .when(F.col("r._id").isNotNull(), "bare")
        .when(~F.coalesce(F.array_contains(F.json_object_keys("line"), "doc"), F.lit(False)), "bare")
        .when(F.col("r.doc").isNull(), "deleted")
        .when(F.ltrim("r.doc").startswith("{"), "row")
        .otherwise("odd")
    )
    kinds = parsed.select("line", "r", F.explode_outer(F.array(kind)).alias("k")).where(F.col("k") != "deleted")
    return kinds.select(
        F.when(F.col("k") == "row", F.col("r.id")).when(F.col("k") == "bare", F.col("r._id")).alias("id"),
        F.when(F.col("k") == "row", F.col("r.doc")).when(F.col("k") == "bare", F.col("line")).alias(DOC),
        F.when(F.col("k") == "unreadable", "not a JSON object").when(F.col("k") == "odd", "doc is not an object").alias(REJECT),
        "line",
    )


def document_lines(lines: DataFrame, column: str = "value", mode: str = "strict") -> DataFrame:
    """The documents of line-per-row text, ``DataFrame[id, doc]`` (see
    ``scan_lines``). A rejected line fails the job in strict mode and is left
    to ``rejected_lines`` in permissive mode."""
    scanned = scan_lines(lines, column)
    good = F.col(REJECT).isNull()
    if mode == "strict":
        said = F.concat(F.col(REJECT), F.lit(": "), F.substring("line", 1, 200))
        good = F.when(F.col(REJECT).isNotNull(), F.raise_error(said).cast("boolean")).otherwise(True)
    return scanned.where(good).select("id", DOC)


def rejected_lines(lines: DataFrame, column: str = "value") -> DataFrame:
    """``DataFrame[_reject_reason, doc]``: the lines that hold no document, as they are."""
    return scan_lines(lines, column).where(F.col(REJECT).isNotNull()).select(REJECT, F.col("line").alias(DOC))


def read_document_lines(spark: SparkSession, path: str | list[str], mode: str = "strict") -> DataFrame:
    """Line-per-row dump file(s); splittable, so large dumps scan in parallel."""
    return document_lines(spark.read.text(path), mode=mode)


def documents_from(df: DataFrame, column: str | Column = DOC) -> DataFrame:
    """Any column of JSON text (or a struct, encoded to JSON) as documents."""
    c = F.col(column) if isinstance(column, str) else column
    dt = df.select(c).schema.fields[0].dataType
    if not isinstance(dt, T.StringType):
        c = F.to_json(c)
    return df.select(c.alias(DOC)).where(F.col(DOC).isNotNull())


def drop_null_documents(docs: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Drop rows whose ``doc`` is null (deleted documents).

    The test sits above a one-element generator, so the optimizer cannot push
    it below the projection that produces ``doc``: when ``doc`` is computed
    (for instance encoded from other columns) that would evaluate the
    encoding twice."""
    one = docs.select(*[F.col(f"`{k}`") for k in keep], F.explode_outer(F.array(F.col(DOC))).alias(DOC))
    return one.where(F.col(DOC).isNotNull())


def path_column(i: int) -> str:
    return f"_path{i}"


PATH_DOC_ID = "_path_doc_id"


@dataclass(frozen=True)
class PathColumns:
    """The parse behind path tables: for each ``(key path, is_array)`` a column
    ``_path<i>``, and ``_path_doc_id``. Independent of the main layout.

    ``_path<i>`` is an array of texts, each the JSON text of one item; it is
    null where the path is absent, or runs through a null or a non-object, or
    (``is_array``) ends at a non-array. Without ``is_array`` the value is the
    only item. Keys that no path names are skipped unread."""

    paths: tuple[tuple[tuple[str, ...], bool], ...]
    id_key: str | None = None

    def _tree(self) -> Paths:
        leaves = [(steps, T.ArrayType(T.StringType()) if array else T.StringType()) for steps, array in self.paths]
        return Paths(leaves + ([((self.id_key,), T.StringType())] if self.id_key is not None else []))

    def parses(self, doc: Column) -> list[Column]:
        """Columns of the parse (``_tops<i>``), for a projection of their own."""
        return [c.alias(f"_tops{i}") for i, c in enumerate(self._tree().parses(guard(doc)))]

    def values(self) -> list[Column]:
        """The path columns, from those of the parse."""
        tree = self._tree()
        tops = [F.col(f"_tops{i}") for i in range(len(tree.trees))]
        out = []
        for i, (_, array) in enumerate(self.paths):
            v = tree.value(i, tops)
            out.append((v if array else F.when(v.isNotNull(), F.array(v))).alias(path_column(i)))
        if self.id_key is not None:
            out.append(tree.value(len(self.paths), tops).alias(PATH_DOC_ID))
        return out


def unreadable_documents(docs: DataFrame, column: str = DOC) -> DataFrame:
    """``DataFrame[_reject_reason, doc]``: the documents that aren't JSON
    objects from beginning to end, which a permissive parse leaves null."""
    one = docs.select(F.explode_outer(F.array(F.col(column))).alias(DOC)).where(F.col(DOC).isNotNull())
    return one.where(F.json_object_keys(DOC).isNull()).select(F.lit("not a JSON object").alias(REJECT), DOC)


# -- S3 ----------------------------------------------------------------------
@dataclass(frozen=True)
class ParsePlan:
    """How a layout is read from JSON: the schema handed to ``from_json``
    (JSON key names; float and timestamp fields read as text so they can be
    coerced), and the typed output schema (declared names)."""

    json_schema: T.StructType
    text_schema: T.StructType
    coerced: tuple[tuple[str, str], ...]


def parse_plan(spec: TableSpec) -> ParsePlan:
    json_fields, text_fields, coerced = [], [], []
    for f in spec.data_fields():
        dt = f.data_type()
        if f.type in ("float", "timestamp"):
            dt = T.StringType()
            coerced.append((f.name, f.type))
        json_fields.append(T.StructField(f.source, dt, True))
        text_fields.append(T.StructField(f.name, dt, True))
    return ParsePlan(T.StructType(json_fields), T.StructType(text_fields), tuple(coerced))


def parse_documents(
    docs: DataFrame,
    spec: TableSpec,
    mode: str = "strict",
    keep_doc: bool = False,
    keep: Sequence[str] = (),
    paths: Sequence[tuple[Sequence[str], bool]] = (),
    path_id_key: str | None = None,
    doc_hash: bool = False,
) -> DataFrame:
    """S3: typed main-table columns from the ``doc`` column (plus the
    ``keep`` columns of ``docs``, passed through).

    Missing keys give null, keys not declared are ignored, ``source_field``
    renames (``_id`` -> ``relationship_id``). Declared floats accept JSON
    numbers and numeric text; declared timestamps are parsed from text.

    ``paths``: for each ``(key path, is_array)``, a column ``_path<i>`` with the
    JSON texts of the items there (see ``PathColumns``), plus the document id
    (``path_id_key``) as ``_path_doc_id``. Path tables read these instead of
    the raw text, so the raw document need not be kept.

    ``doc_hash``: a ``_doc_hash`` column, ``xxhash64`` of the raw text (a cheap
    deterministic tie-break between versions of a document).

    ``mode="strict"``: any document that does not fit the layout fails the job.
    ``mode="permissive"``: fields that do not fit are null and the row carries a
    ``_reject_reason`` (null for clean rows), so the caller can quarantine it.
    """
    if mode not in ("strict", "permissive"):
        raise ValueError(f"mode must be 'strict' or 'permissive', not {mode!r}")
    plan = parse_plan(spec)
    docs = drop_null_documents(docs, keep)
    strict = mode == "strict"
    if strict:
        parsed = F.from_json(DOC, plan.json_schema, {"mode": "FAILFAST"})
    else:
        schema = T.StructType(plan.json_schema.fields + [T.StructField(CORRUPT, T.StringType())])
        parsed = F.from_json(
            DOC, schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
        )
    extra = [F.col(f"`{k}`") for k in keep]
    if doc_hash:
        extra.append(F.xxhash64(F.col(DOC)).alias(DOC_HASH))
    at_paths = PathColumns(tuple((tuple(p), array) for p, array in paths), path_id_key)
    tops = at_paths.parses(F.col(DOC)) if paths else []
    extra += tops
    extra += [F.col(DOC)] if keep_doc or not strict else []
    staged = docs.select(parsed.alias("_p"), *extra)
    carried = [F.col(f"`{c}`") for c in staged.columns if c != "_p" and not (paths and c.startswith("_tops"))]
    if paths:
        carried += at_paths.values()
    # positional struct cast: JSON key names -> declared names, no by-name
    # lookup (so keys differing only in case cannot clash)
    target = T.StructType(
        plan.text_schema.fields
        + ([] if strict else [T.StructField(CORRUPT, T.StringType())])
    )
    staged = staged.select(F.col("_p").cast(target).alias("_p"), *carried)

    cols: list[Column] = []
    problems: list[Column] = []
    coerced = dict(plan.coerced)
    for f in plan.text_schema.fields:
        raw = F.col("_p").getField(f.name)
        kind = coerced.get(f.name)
        if kind == "float":
            e = as_float(raw, strict)
        elif kind == "timestamp":
            e = as_timestamp(raw, strict)
        else:
            e = raw
        if kind and not strict:
            problems.append(
                F.when(raw.isNotNull() & e.isNull(), F.lit(f"{f.name}: not a {kind}"))
            )
        cols.append(e.alias(f.name))
    if not strict:
        problems.insert(
            0, F.when(F.col("_p").getField(CORRUPT).isNotNull(), F.lit("document does not fit layout"))
        )
        reason = F.nullif(F.concat_ws("; ", *problems), F.lit(""))
        cols.append(reason.alias(REJECT))
    cols += [F.col(f"`{k}`") for k in keep]
    if doc_hash:
        cols.append(F.col(DOC_HASH))
    cols += [F.col(path_column(i)) for i in range(len(paths))]
    if paths and path_id_key is not None:
        cols.append(F.col(PATH_DOC_ID))
    if keep_doc:
        cols.append(F.col(DOC))
    elif not strict:  # the raw text only where it is needed: rejected documents
        cols.append(F.when(reason.isNotNull(), F.col(DOC)).alias(DOC))
    return staged.select(*cols)
