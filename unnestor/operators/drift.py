"""C5 along paths: what documents hold at every path, against the layouts.

Each document is reduced to its shape (names and kinds, without values), shapes
are counted, and only the distinct ones are taken apart into paths. A path is
the keys from the root joined by dots, ``[]`` standing for the elements of an
array; a key that holds a dot or a bracket is in backquotes.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.catalog import PATH, RECORDS, SINGLE, Catalog, FieldSpec

UNREADABLE = "UNREADABLE"  # kind of a document that isn't JSON, or repeats a key
MIXED = "MIXED"  # kind of array elements of which not all are of one kind

_NAME = re.compile(r"(`(?:[^`]|``)*`|[^:`]*): ")
_SCALAR = re.compile(r"[A-Z_]+(?:\([0-9,]*\))?")

# Kinds that a declared type takes without loss; text fields take any scalar.
_SCALARS = ("STRING", "BIGINT", "DECIMAL", "DOUBLE", "FLOAT", "BOOLEAN")
TAKES = {"string": _SCALARS, "integer": ("BIGINT",), "float": ("BIGINT", "DECIMAL", "DOUBLE", "FLOAT", "STRING"),
         "boolean": ("BOOLEAN",), "timestamp": ("STRING",), "struct": ("OBJECT",)}


def _step(key: str) -> str:
    return f"`{key}`" if re.search(r"[.\[\]`]", key) else key


def paths_of(shape: str) -> dict[str, str]:
    """Path -> kind of a shape, as ``schema_of_variant`` writes it."""
    out: dict[str, str] = {}
    at = 0

    def read(path: str) -> None:
        nonlocal at
        kind = _SCALAR.match(shape, at)
        at = kind.end()
        name = kind.group().split("(")[0]
        if path:
            out[path] = MIXED if name == "VARIANT" else name
        if shape[at : at + 1] != "<":
            return
        at += 1
        if name == "ARRAY":
            read(path + "[]")
        while shape[at] != ">":
            if name == "OBJECT":
                key = _NAME.match(shape, at)
                at = key.end()
                plain = key.group(1)[1:-1].replace("``", "`") if key.group(1).startswith("`") else key.group(1)
                read(f"{path}.{_step(plain)}" if path else _step(plain))
            if shape[at] == ",":
                at += 2
        at += 1

    read("")
    return out


def _take_apart(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [(path, kind, n) for shape, n in zip(batch.column("shape").to_pylist(), batch.column("n").to_pylist())
                for path, kind in (paths_of(shape) if shape else {"": UNREADABLE}).items()]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], names=["path", "kind", "n"])


def path_kinds(docs: DataFrame, doc_col: str = "doc") -> DataFrame:
    """``(path, kind, documents)``: the kinds at every path of the documents;
    a document that can't be read counts at the empty path."""
    shapes = docs.where(F.col(doc_col).isNotNull()).groupBy(
        F.schema_of_variant(F.try_parse_json(F.col(doc_col))).alias("shape")).agg(F.count(F.lit(1)).alias("n"))
    apart = shapes.mapInArrow(_take_apart, "path string, kind string, n bigint")
    return apart.groupBy("path", "kind").agg(F.sum("n").alias("documents"))


def declared_paths(catalog: Catalog, root: str) -> dict[str, str]:
    """Path -> declared type, of the root layout and all its children."""
    out: dict[str, str] = {}

    def add(prefix: str, fields: list[FieldSpec]) -> None:
        for f in fields:
            path = prefix + ".".join(_step(s) for s in f.source.split(".")) if prefix.endswith("[].") else prefix + _step(f.source)
            out.setdefault(path, f.type)
            if f.type == "struct":
                add(path + ".", [s for s in f.fields if not s.generated])

    def walk(key: str, prefix: str) -> None:
        spec = catalog[key]
        for link in spec.children:
            target = catalog[link.target]
            kind = target.kind(link)
            if kind == PATH:
                at = ".".join(_step(s) for s in target.path or (link.field,))
                own = [f for f in target.data_fields() if f.name != "parent_id"] + [FieldSpec(name=target.source_id_field)]
                add(at + ("[]." if target.is_array else "."), own)
                continue
            field = spec.field(link.field)
            at = prefix + _step(field.source if field else link.field)
            if kind in (RECORDS, SINGLE):
                add(at + ("[]." if kind == RECORDS else "."), target.data_fields("id", "nested_id", target.foreign_key, link.foreign_key))
            walk(target.key, at + ("[]." if kind == RECORDS else "."))

    add("", catalog[root].data_fields())
    walk(root, "")
    return out


def path_drift(docs: DataFrame, catalog: Catalog, root: str, doc_col: str = "doc") -> DataFrame:
    """``(path, kind, documents, declared, status)`` of every path that occurs
    or is declared: ``ok``; ``type`` (the declared type doesn't take the kind
    without loss); ``extra`` (not declared, nor inside a declared map or array
    of maps); ``missing`` (declared, in no document: kind null)."""
    declared = declared_paths(catalog, root)
    spark = docs.sparkSession
    said = spark.createDataFrame(sorted(declared.items()), "path string, declared string")
    seen = path_kinds(docs, doc_col)
    joined = seen.join(F.broadcast(said), "path", "left")  # the layouts' own fields
    missing = said.join(seen.select("path").distinct(), "path", "left_anti").select(
        "path", F.lit(None).cast("string").alias("kind"), F.lit(0).cast("bigint").alias("documents"), "declared")
    both = joined.select("path", "kind", "documents", "declared").unionByName(missing)
    opened = [p for p, t in declared.items() if t.startswith(("map<", "array<"))]
    parents = {p[: m.start()] for p in declared for m in re.finditer(r"\.|\[\]", p)}
    inside: Column = F.lit(False)
    for p in opened:
        inside = inside | F.startswith("path", F.lit(p + ".")) | F.startswith("path", F.lit(p + "[]"))
    takes: Column = F.lit(False)
    for t, kinds in TAKES.items():
        takes = takes | ((F.col("declared") == t) & F.col("kind").isin(*kinds))
    takes = takes | (F.col("declared").startswith("map<") & (F.col("kind") == "OBJECT")) | (F.col("declared").startswith("array<") & (F.col("kind") == "ARRAY"))
    holds = F.col("path").isin(*parents) & F.col("kind").isin("OBJECT", "ARRAY") if parents else F.lit(False)
    status = (
        F.when(F.col("kind").isNull(), "missing")
        .when((F.col("kind") == "VOID") & (F.col("declared").isNotNull() | inside), "ok")
        .when(F.col("declared").isNull(), F.when(inside | holds, "ok").otherwise("extra"))
        .when(takes | holds, "ok").otherwise("type")
    )
    return both.select("path", "kind", "documents", "declared", status.alias("status"))
