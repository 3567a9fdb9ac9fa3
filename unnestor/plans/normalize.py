"""Table-tree normalisation (G5, G6, P1): documents -> main table + child tables.

``normalize`` builds lazy DataFrames only; no job runs until the caller writes
or counts a table. Every child is a narrow transformation of its parent (or,
for path extraction, of the documents), so the whole tree is shuffle-free.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.values import fill_defaults
from ..operators.unnest import extract_path_items, flatten_struct, split_path_key, unnest_records, unnest_values
from ..sources.documents import DOC, PATH_DOC_ID, REJECT, PathColumns, parse_documents, path_column
from .catalog import PATH, PRIMITIVE, RECORDS, SINGLE, Catalog, CatalogError, ChildLink, TableSpec

# Fixed value: prefix of the per-item key of path-extracted tables.
ITEM_KEY_PREFIX = "footprint"


def main_columns(spec: TableSpec) -> list[str]:
    """Declared fields in order, minus generated ones and those flagged
    ``nested_table`` (nested columns stay on the main table otherwise)."""
    return [f.name for f in spec.fields if not f.generated and not f.nested_table]


def path_links(catalog: Catalog, root: str) -> list[tuple[str, tuple[str, ...], bool]]:
    """``(target key, key path, is_array)`` of every path-extracted table in
    the tree, in tree order; the i-th one reads column ``_path<i>`` of the parse."""
    out = []
    for key in catalog.tree(root):
        spec = catalog.tables.get(key)
        for link in spec.children if spec else ():
            target = catalog.tables.get(link.target)
            if target is not None and target.kind(link) == PATH:
                out.append((target.key, target.path or (link.field,), target.is_array))
    return out


def parse_tree(
    docs: DataFrame, catalog: Catalog, root: str, mode: str = "strict", doc_hash: bool = False
) -> DataFrame:
    """The typed main-table columns plus, for each path table of the tree,
    the JSON texts of the items at its path (the raw document is not kept)."""
    spec = catalog[root]
    pk = spec.field(spec.primary_key) if spec.primary_key else None
    return parse_documents(
        docs, spec, mode, paths=[(p, array) for _, p, array in path_links(catalog, root)],
        path_id_key=pk.source if pk is not None else "_id", doc_hash=doc_hash,
    )


def child_table(
    parent: DataFrame,
    parent_spec: TableSpec,
    link: ChildLink,
    target: TableSpec,
    docs: DataFrame | None = None,
    doc_id: str | None = None,
    with_document_id: bool = False,
    doc_col: str = DOC,
) -> DataFrame:
    """Dispatch one child on its kind. A path table reads ``doc_col`` of
    ``docs``: the raw document, or (a ``_path<i>`` column) the items already
    taken from its path."""
    kind = target.kind(link)
    pk = parent_spec.primary_key
    if kind != PATH:
        if not pk:
            raise CatalogError(f"layout {parent_spec.key!r} needs a primary_key for its children")
        if link.field not in parent.columns:
            raise CatalogError(f"{target.key!r} reads field {link.field!r}, which {parent_spec.key!r} does not have")
        dt = parent.schema[link.field].dataType
        if kind == SINGLE and isinstance(dt, T.ArrayType):
            # a layout without ``is_array`` over an array field: read it as the
            # array it is (primitive or records, by the usual rule)
            import warnings

            warnings.warn(f"{target.key!r} lacks is_array but {link.field!r} is an array; reading it as one",
                          stacklevel=2)
            fk_names = {"id", "nested_id", target.foreign_key, link.foreign_key}
            data = [f for f in target.fields if not f.generated and f.name not in fk_names]
            kind = PRIMITIVE if len(data) == 1 else RECORDS
        wanted = (T.StructType, T.MapType) if kind == SINGLE else (T.ArrayType,)
        if not isinstance(dt, wanted):
            raise CatalogError(
                f"{target.key!r} is a {kind} child, but {parent_spec.key}.{link.field} is {dt.simpleString()}"
            )
    if kind == PRIMITIVE:
        value = target.data_fields("id", target.foreign_key, link.foreign_key)[0]
        return unnest_values(parent, pk, link.field, link.foreign_key, value.name, value.data_type())
    if kind == RECORDS:
        fields = [(f.name, f.data_type()) for f in target.data_fields("nested_id", link.foreign_key)]
        return unnest_records(parent, pk, link.field, link.foreign_key, fields)
    if kind == SINGLE:
        fields = [(f.name, f.data_type()) for f in target.data_fields("id", link.foreign_key)]
        return flatten_struct(parent, pk, link.field, link.foreign_key, fields)
    if kind == PATH:
        if docs is None or doc_id is None:
            raise CatalogError(f"path table {target.key!r} needs the raw documents")
        at_path = doc_col != DOC
        return extract_path_items(
            docs,
            doc_id,
            () if at_path else (target.path or (link.field,)),
            [(f.name, f.source) for f in target.fields],
            target.table_name,
            source_id_field=target.source_id_field,
            is_array=target.is_array,
            doc_col=doc_col,
            item_key_prefix=ITEM_KEY_PREFIX,
            with_document_id=with_document_id,
        )
    raise CatalogError(f"unknown nested kind {kind!r}")


def normalize_parsed(
    parsed: DataFrame,
    catalog: Catalog,
    root: str,
    with_defaults: bool = False,
    with_document_id: bool = False,
) -> list[tuple[str, DataFrame]]:
    """G6 on already-parsed (or staged) documents: ``parsed`` holds the main
    layout's columns, plus for path tables either their ``_path<i>`` columns
    (see ``parse_tree``) or the raw ``doc``."""
    spec = catalog[root]
    main = parsed.select(*[F.col(f"`{c}`") for c in main_columns(spec)])
    if with_defaults:
        defaults = {f.name: f.default for f in spec.fields if f.default is not None and f.name in main.columns}
        main = fill_defaults(main, defaults)
    columns = {k: path_column(i) for i, (k, _, _) in enumerate(path_links(catalog, root))}
    has_paths = all(c in parsed.columns for c in columns.values())
    docs = parsed if (has_paths or DOC in parsed.columns) else None
    out: list[tuple[str, DataFrame]] = [(spec.table_name, main)]

    def walk(parent_spec: TableSpec, parent_df: DataFrame) -> None:
        for link in parent_spec.children:
            target = catalog[link.target]
            source_df, source_spec = parent_df, parent_spec
            if link.parent_table:
                # read another table of the tree: its rows, and its own key
                source_df = next((d for n, d in out if n == link.parent_table), None)
                source_spec = next(
                    (catalog[k] for k in catalog.tree(root) if catalog[k].table_name == link.parent_table), None
                )
                if source_df is None or source_spec is None:
                    raise CatalogError(f"parent table {link.parent_table!r} not built yet")
            doc_col = columns.get(target.key, DOC) if has_paths else DOC
            doc_id = PATH_DOC_ID if PATH_DOC_ID in parsed.columns else spec.primary_key
            child = child_table(
                source_df, source_spec, link, target, docs, doc_id, with_document_id, doc_col
            )
            out.append((target.table_name, child))
            if target.children:
                walk(target, child)

    walk(spec, main)
    return out


def normalize(
    docs: DataFrame,
    catalog: Catalog,
    root: str,
    mode: str = "strict",
    with_defaults: bool = False,
    with_document_id: bool = False,
) -> list[tuple[str, DataFrame]]:
    """R1 core: ``DataFrame[doc]`` -> ``[(table_name, DataFrame)]``, main table
    first, children depth-first in declared order."""
    return normalize_parsed(parse_tree(docs, catalog, root, mode), catalog, root, with_defaults, with_document_id)


def normalize_staged(
    docs: DataFrame,
    catalog: Catalog,
    root: str,
    mode: str = "strict",
    with_defaults: bool = False,
    with_document_id: bool = False,
) -> list[tuple[str, DataFrame]]:
    """``normalize`` for fan-out: the documents are parsed once and the typed
    result is written to the checkpoint folder; every table of the tree then
    reads that copy (pruned to the columns it needs) instead of re-parsing
    the JSON."""
    from .staging import stage

    parsed = parse_tree(docs, catalog, root, mode)
    return normalize_parsed(stage(parsed, f"parsed_{root}"), catalog, root, with_defaults, with_document_id)


def extract_table(docs: DataFrame, catalog: Catalog, key: str, with_document_id: bool = False) -> DataFrame:
    """A path-extracted table on its own (without its parent tables): the
    layout's ``path`` is walked from the root of every document, whose
    ``_id`` is the document id."""
    spec = catalog[key]
    if not spec.path:
        raise CatalogError(f"layout {key!r} declares no path")
    at_path = PathColumns(((spec.path, spec.is_array),), "_id")
    v = docs.select(*at_path.parses(F.col(DOC))).select(*at_path.values())
    return extract_path_items(
        v, PATH_DOC_ID, (), [(f.name, f.source) for f in spec.fields], spec.table_name,
        source_id_field=spec.source_id_field, is_array=spec.is_array, doc_col=path_column(0),
        item_key_prefix=ITEM_KEY_PREFIX, with_document_id=with_document_id,
    )


def owners(catalog: Catalog, root: str) -> dict[str, Column | None]:
    """Table name -> the document key that a stored row goes with, from the
    row's own keys: every table of the tree can be replaced document by
    document. None where a layout keeps no key of it."""
    spec = catalog[root]
    out: dict[str, Column | None] = {spec.table_name: F.col(f"`{spec.primary_key}`") if spec.primary_key else None}
    # the document key of a table's key, as a function of that key
    document = {spec.table_name: lambda k: k}

    def walk(parent: TableSpec) -> None:
        for link in parent.children:
            target = catalog[link.target]
            of_parent = document[link.parent_table or parent.table_name]
            kind = target.kind(link)
            if kind == PATH:
                out[target.table_name] = _path_owner(target)
                document[target.table_name] = lambda k: k
            else:
                tail = rf"_\Q{link.field}\E$" if kind == SINGLE else "_[0-9]+$"
                out[target.table_name] = of_parent(F.col(f"`{link.foreign_key}`"))
                # (an array under a layout of a single record has positions too)
                tail = f"(?:{tail}|_[0-9]+$)" if kind == SINGLE else tail
                document[target.table_name] = lambda k, tail=tail, up=of_parent: up(F.regexp_replace(k, tail, ""))
            walk(target)

    walk(spec)
    return out


def _path_owner(target: TableSpec) -> Column | None:
    names = [f.name for f in target.fields]
    if "id" in names:
        return F.regexp_replace(F.substring(F.col("id"), len(ITEM_KEY_PREFIX) + 2, 1 << 30), "_[0-9]+$", "")
    return split_path_key(F.col("nested_id"), target.table_name)[1] if "nested_id" in names else None


def rejected_documents(docs: DataFrame, spec: TableSpec) -> DataFrame:
    """Permissive-mode quarantine: documents with a field that did not fit the
    layout, with the reason (see ``parse_documents``)."""
    parsed = parse_documents(docs, spec, "permissive")
    cols = [spec.primary_key] if spec.primary_key in parsed.columns else []
    return parsed.where(F.col(REJECT).isNotNull()).select(*cols, REJECT, DOC)
