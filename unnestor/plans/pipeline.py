"""Pipelines (R1-R3): per-database transform-and-load, over many databases."""

from __future__ import annotations

import uuid
from dataclasses import dataclass, replace
from typing import Mapping, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions.values import strip_control
from ..operators.upsert import blank_key, latest_per_key, superseded, without_rows
from ..sinks.tables import Arriving, LoadReport, Store, load_table
from ..sources.documents import (
    DOC, DOC_HASH, REJECT, read_document_lines, read_envelopes, rejected_lines, unreadable_documents,
)
from .catalog import Catalog, CatalogError
from .normalize import extract_table, normalize_parsed, owners, parse_tree
from .parallel import run_all
from .staging import stage_at, unstage

# Database name -> root layout key of the four document
# databases the original loader handles.
ENTITIES: dict[str, str] = {
    "user": "channel1_user",
    "company": "channel1_company",
    "order": "channel1_order",
    "orderline-steps": "channel1_orderline-steps",
}
# Fixed value: the path-extracted table that is also loadable on its own.
STANDALONE_PATH_TABLES: dict[str, str] = {"fabric_fabricFootprint": "channel1_order_fabric_Footprint"}


ROW = "_row"


@dataclass(frozen=True)
class DatabaseRun:
    """What a load did; ``error`` says why it failed, where failures are reported."""

    database: str
    tables: tuple[LoadReport, ...]
    rejected_documents: int = 0
    error: str | None = None

    @property
    def status(self) -> str:
        return "failed" if self.error else "ok" if all(t.status == "ok" for t in self.tables) else "mismatch"


def primary_keys(catalog: Catalog, root: str) -> dict[str, str | None]:
    return {catalog[k].table_name: catalog[k].primary_key for k in catalog.tree(root)}


def load_database(
    docs: DataFrame,
    catalog: Catalog,
    root: str,
    store: Store,
    mode: str = "strict",
    load_mode: str = "refresh",
    order_by: str | Sequence[str] | None = None,
    quarantine: Store | None = None,
    dedupe: bool = True,
    parallel: int = 1,
    verify: str = "rows",
) -> DatabaseRun:
    """Parse the documents once (staged to the checkpoint folder, so the
    JSON is not re-parsed for each of the N tables), build the table tree and
    load every table, ``parallel`` of them at once.

    With ``dedupe``, repeated documents (same key) are resolved once: the
    version with the greatest ``order_by`` (a column of the main layout) wins,
    with all its children. Without ``order_by`` it is the one whose text has
    the greatest hash: arbitrary, though the same on every run. Keys are
    compared as they are stored, without control characters. Only keys, order
    and hashes are compared; a document is moved only if very many are
    superseded.

    With ``load_mode="upsert"``, an arriving document replaces its stored row
    and all its stored children, in every table of the tree."""
    catalog.validate(root)  # layout mistakes fail here, all at once, before any job
    spec = catalog[root]
    spark = docs.sparkSession
    resolve = dedupe and spec.primary_key in parse_documents_columns(spec)
    parsed = parse_tree(docs, catalog, root, mode, doc_hash=resolve)
    if resolve:
        if order_by is not None and not _has(parsed, order_by):
            raise CatalogError(f"layout {root!r} has no field {order_by!r} to order by")
        parsed = parsed.withColumn(ROW, F.monotonically_increasing_id())
    parsed, staged_path = stage_at(parsed, f"parsed_{root}", "zstd")
    keys = primary_keys(catalog, root)
    reports, lost_at = [], None
    try:
        # the key as it is stored; documents without one are not merged, they are set aside at the load
        key = None
        if spec.primary_key in parsed.columns:
            key = F.when(~blank_key(spec.primary_key, parsed.schema), strip_control(F.col(f"`{spec.primary_key}`").cast("string")))
        if resolve:
            # the latest version supplies the main row and all its children (keys of child rows derive from
            # the document key), so no table needs a keyed shuffle of its own
            lost, lost_at = superseded(parsed, key, ROW, order_by, DOC_HASH)
            parsed = without_rows(parsed, lost, ROW).drop(ROW, DOC_HASH)
        owner, arriving = owners(catalog, root) if key is not None else {}, None
        if load_mode == "upsert" and key is not None:
            arriving = Arriving(parsed.select(key.alias("_key")).where("_key is not null"))

        def load(name: str, df: DataFrame) -> LoadReport:
            order = order_by if order_by is None or _has(df, order_by) else None
            own = owner.get(name)
            return load_table(df, store, name, keys.get(name), load_mode, order, quarantine, dedupe and not resolve,
                              own, arriving if own is not None else None, verify)

        tables = normalize_parsed(parsed, catalog, root)
        for outcome in run_all(spark, [(name, lambda n=name, d=df: load(n, d)) for name, df in tables], parallel):
            if isinstance(outcome, Exception):
                raise outcome
            reports.append(outcome)
        rejected = 0
        if mode == "permissive":
            # from the staged parse: no second pass over the JSON
            cols = [c for c in (spec.primary_key, REJECT, DOC) if c and c in parsed.columns]
            bad = parsed.where(F.col(REJECT).isNotNull()).select(*cols)
            rejected = _set_aside(bad, f"{spec.table_name}__documents_rejected", quarantine)
    finally:
        for path in filter(None, (staged_path, lost_at)):
            unstage(spark, path)
    return DatabaseRun(spec.table_name, tuple(reports), rejected)


def parse_documents_columns(spec) -> list[str]:
    """Column names of the main layout's parse (the declared data fields)."""
    return [f.name for f in spec.data_fields()]


def _has(df: DataFrame, cols: str | Sequence[str]) -> bool:
    cols = [cols] if isinstance(cols, str) else list(cols)
    return all(c in df.columns for c in cols)


def read_dump(spark: SparkSession, path: str, layout: str = "lines", mode: str = "strict") -> tuple[DataFrame, DataFrame]:
    """``(documents, rejects)`` of a dump; the latter are what holds none."""
    if layout == "lines":
        return read_document_lines(spark, path, mode), rejected_lines(spark.read.text(path))
    if layout == "envelope":
        return read_envelopes(spark, path, mode)
    raise ValueError(f"unknown dump layout {layout!r}")


def _set_aside(bad: DataFrame, name: str, quarantine: Store | None) -> int:
    """Count what can't be read, and keep it."""
    if quarantine is None:
        return bad.count()
    obs = Observation(f"{name}_{uuid.uuid4().hex[:12]}")
    quarantine.write(bad.observe(obs, F.count(F.lit(1)).alias("n")), name)
    return int(obs.get["n"])


def load_path_table(
    docs: DataFrame,
    catalog: Catalog,
    key: str,
    store: Store,
    load_mode: str = "refresh",
    quarantine: Store | None = None,
    dedupe: bool = True,
    mode: str = "strict",
    verify: str = "rows",
) -> DatabaseRun:
    """A path-extracted table loaded on its own, straight from the documents.
    With ``dedupe``, one row per document and position stays (of documents
    that repeat). Documents that aren't JSON objects fail the load in strict
    mode; in permissive mode they are counted, and kept in ``quarantine``."""
    spec = catalog[key]
    items = extract_table(docs, catalog, key)
    if dedupe and "id" in items.columns:
        items, dedupe = latest_per_key(items, "id"), False
    bad, rejected = unreadable_documents(docs), 0
    if mode == "strict":
        first = bad.first()
        if first:
            raise ValueError(f"not a JSON object: {first[DOC][:200]}")
    else:
        rejected = _set_aside(bad, f"{spec.table_name}__documents_rejected", quarantine)
    report = load_table(items, store, spec.table_name, spec.primary_key, load_mode, None, quarantine, dedupe, verify=verify)
    return DatabaseRun(spec.table_name, (report,), rejected)


def run_databases(
    spark: SparkSession,
    dumps: Mapping[str, str],
    catalog: Catalog,
    store: Store,
    bindings: Mapping[str, str] = ENTITIES,
    layout: str = "lines",
    parallel: int = 1,
    on_error: str = "stop",
    **load_options,
) -> list[DatabaseRun]:
    """R2: each named database dump through R1. An unknown database name stops
    the run before it begins. Names in ``STANDALONE_PATH_TABLES`` load that one
    path-extracted table.

    Databases are independent: ``parallel`` of them load at once (and as many
    tables of each), every one in a scheduler pool of its own. One that fails
    raises at the end with ``on_error="stop"`` (and with ``parallel=1`` nothing
    after it is loaded); with ``"report"`` it has a run with its ``error``, and
    the others are loaded."""
    if on_error not in ("stop", "report"):
        raise ValueError(f"on_error must be 'stop' or 'report', not {on_error!r}")
    known = {**bindings, **STANDALONE_PATH_TABLES}
    unknown = [d for d in dumps if d not in known]
    if unknown:
        raise ValueError(f"unknown database(s): {unknown}")
    mode = load_options.get("mode", "strict")

    def load(db: str, path: str) -> DatabaseRun:
        docs, bad = read_dump(spark, path, layout, mode)
        if db in bindings:
            run = load_database(docs, catalog, bindings[db], store, parallel=parallel, **load_options)
        else:
            opts = {k: v for k, v in load_options.items() if k in ("load_mode", "quarantine", "dedupe", "mode", "verify")}
            run = load_path_table(docs, catalog, STANDALONE_PATH_TABLES[db], store, **opts)
        if mode == "permissive":
            name = f"{db.replace('-', '_')}__{'lines' if layout == 'lines' else 'envelopes'}_rejected"
            lost = _set_aside(bad, name, load_options.get("quarantine"))
            run = replace(run, rejected_documents=run.rejected_documents + lost)
        return run

    runs: list[DatabaseRun] = []
    jobs = [(db, lambda db=db, path=path: load(db, path)) for db, path in dumps.items()]
    # one by one, a failure stops what comes after it
    for some in ([jobs] if parallel > 1 or on_error == "report" else [[j] for j in jobs]):
        for (db, _), outcome in zip(some, run_all(spark, some, parallel)):
            if isinstance(outcome, Exception):
                if on_error == "stop":
                    raise outcome
                outcome = DatabaseRun(db, (), error=f"{type(outcome).__name__}: {str(outcome)[:500]}")
            runs.append(outcome)
    return runs
