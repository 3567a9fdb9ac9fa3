"""Unnesting operators (G1-G4) with their filters (F1-F6) and projections.

All four are narrow transformations (a generator plus a projection): no
shuffle, so each child table is produced partition by partition from its
parent.

The generators are the ``_outer`` forms followed by a ``pos IS NOT NULL``
filter. That is the same result as the plain forms (null and empty arrays
yield nothing), but it stops the optimizer from inferring a
``size(array) > 0`` filter and pushing it below the projection, where it would
evaluate the document parse a second time.

Child keys are built from the parent key and the element's array position,
never from ``monotonically_increasing_id``, so they do not depend on how the
input happens to be partitioned and are the same on every re-run or task
retry.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.json_text import Paths, is_object, truthy, unguard
from ..functions.values import key_of, stringify, typed
from ..sources.documents import PathColumns, path_column

Typed = Sequence[tuple[str, T.DataType]]


def _q(name: str) -> Column:
    return F.col(f"`{name}`")


def _posexplode(parent: DataFrame, key: Column, arr: Column) -> DataFrame:
    """``(_k, _pos, _e)`` for every element of ``arr``; no row for a null or
    empty array."""
    out = parent.select(key.alias("_k"), F.posexplode_outer(arr).alias("_pos", "_e"))
    return out.where(F.col("_pos").isNotNull())


def _element_field(elem: Column, elem_type: T.DataType, name: str) -> Column:
    """Field of an array element: map lookup (missing key -> null) or struct
    field (undeclared field -> null)."""
    if isinstance(elem_type, T.StructType):
        if name not in elem_type.fieldNames():
            return F.lit(None)
        return elem.getField(name)
    return elem.getItem(name)


# -- G1 ----------------------------------------------------------------------
def unnest_values(
    parent: DataFrame,
    parent_key: str,
    field: str,
    foreign_key: str,
    value_name: str,
    value_type: T.DataType | None = None,
    key_name: str = "id",
) -> DataFrame:
    """Primitive array -> ``(id, fk, value)``.

    ``id`` is ``<parent key>_<position>``. Null or empty arrays yield no rows
    (F2); null elements are kept (and counted in positions).
    """
    exploded = _posexplode(parent, _q(parent_key), _q(field)).withColumnRenamed("_e", "_v")
    value = F.col("_v") if value_type is None else typed("_v", value_type)
    return exploded.select(
        key_of(F.col("_k"), "_", F.col("_pos").cast("string")).alias(key_name),
        F.col("_k").alias(foreign_key),
        value.alias(value_name),
    )


# -- G2 ----------------------------------------------------------------------
def unnest_records(
    parent: DataFrame,
    parent_key: str,
    field: str,
    foreign_key: str,
    fields: Typed,
    key_name: str = "nested_id",
) -> DataFrame:
    """Array of maps (or structs) -> ``(nested_id, fk, typed fields...)``.

    Null or empty arrays yield no rows (F2); null elements are dropped after
    the positions are assigned (F1), so the key of an element does not change
    when a neighbour is null. Missing keys give null; values that do not fit
    the declared type give null (P3/V4). Keys not declared are ignored.
    """
    arr_type = parent.schema[field].dataType
    if not isinstance(arr_type, T.ArrayType):
        raise TypeError(f"column {field!r} is {arr_type.simpleString()}, not an array")
    elem_type = arr_type.elementType
    exploded = _posexplode(parent, _q(parent_key), _q(field)).where(F.col("_e").isNotNull())
    e = F.col("_e")
    return exploded.select(
        key_of(F.col("_k"), "_", F.col("_pos").cast("string")).alias(key_name),
        F.col("_k").alias(foreign_key),
        *[typed(_element_field(e, elem_type, n), t).alias(n) for n, t in fields],
    )


# -- G3 ----------------------------------------------------------------------
def flatten_struct(
    parent: DataFrame,
    parent_key: str,
    field: str,
    foreign_key: str,
    fields: Typed,
    key_name: str = "id",
) -> DataFrame:
    """Single struct (or map) -> exactly one child row per parent row, also
    when the struct is null; ``id`` is ``<parent key>_<field>``."""
    s_type = parent.schema[field].dataType
    s = _q(field)
    return parent.select(
        key_of(_q(parent_key), f"_{field}").alias(key_name),
        _q(parent_key).alias(foreign_key),
        *[typed(_element_field(s, s_type, n), t).alias(n) for n, t in fields],
    )


# -- G4 ----------------------------------------------------------------------
# Characters of an id that are written by their code in a key of several ids,
# so that the key can be taken apart again; "%" first, as the codes hold it.
_KEY_CODES = (("%", "%25"), ("_", "%5F"))


def key_part(x: Column) -> Column:
    """An id as a part of a key: without the sign that joins parts."""
    for sign, code in _KEY_CODES:
        x = F.replace(x, F.lit(sign), F.lit(code))
    return x


def split_path_key(key: Column, table_name: str) -> list[Column]:
    """``[item id, document id, position]`` of the key of a path item."""
    parts = F.split(F.substring(key, len(table_name) + 2, 1 << 30), "_")

    def plain(x: Column) -> Column:
        for sign, code in reversed(_KEY_CODES):
            x = F.replace(x, F.lit(code), F.lit(sign))
        return x

    return [plain(parts[0]), plain(parts[1]), parts[2].cast("int")]


def extract_path_items(
    docs: DataFrame,
    doc_id: str,
    path: Sequence[str],
    fields: Sequence[tuple[str, str]],
    table_name: str,
    source_id_field: str = "ID",
    is_array: bool = True,
    doc_col: str = "doc",
    item_key_prefix: str = "footprint",
    key_names: tuple[str, str, str] = ("nested_id", "id", "parent_id"),
    with_document_id: bool = False,
) -> DataFrame:
    """Path extraction: walk ``path`` inside each raw document, unnest what is
    there and emit every declared field as text.

    * documents where the path is absent, or runs through a null or a
      non-object, give no rows (F3);
    * with ``is_array``, a non-array at the path gives no rows (F4); without
      it, the value is taken as a single item;
    * items that are not objects, or whose ``source_id_field`` is missing or
      falsy, are skipped (F5, F6); a text that looks like an object is a text;
    * ``fields`` is ``[(output name, source key)]``; a source key ``a.b.c``
      is a nested path (P10). Values are their JSON text, missing values ``''``
      (V1); a repeated key has its last value; integers are exact and other
      numbers are printed as doubles (``17.0``, ``1e3`` as ``1000.0``).

    Keys: ``nested_id = <table>_<item id>_<doc id>_<position>`` with ``_`` and
    ``%`` of the ids written as ``%5F`` and ``%25``, so that no two items share
    one (``split_path_key`` undoes it), and
    ``id = <item_key_prefix>_<doc id>_<position>``; ``parent_id`` is the
    item's own id. ``doc_col`` holds the JSON document, or with an empty
    ``path`` the items themselves (a ``_path<i>`` column of the parse).
    """
    nested_name, id_name, parent_name = key_names
    if isinstance(docs.schema[doc_col].dataType, T.StringType):
        at_path = PathColumns(((tuple(path), is_array),))
        docs = docs.select(_q(doc_id), *at_path.parses(_q(doc_col))).select(_q(doc_id), *at_path.values())
        doc_col = path_column(0)
    exploded = _posexplode(docs, _q(doc_id), _q(doc_col)).withColumnRenamed("_k", "_doc")
    items = exploded.where(is_object(F.col("_e"))).select("_doc", "_pos", F.explode_outer(F.array(unguard(F.col("_e")))).alias("_e"))
    sources = [source_id_field, *[s for n, s in fields if n not in key_names]]
    read = Paths([(tuple(s.split(".")) if i else (s,), T.StringType()) for i, s in enumerate(sources)])
    # above a generator, so that each parse is evaluated once
    parsed = items.select("_doc", "_pos", "_e", F.explode_outer(F.array(F.struct(
        *[c.alias(f"_p{i}") for i, c in enumerate(read.parses(F.col("_e")))]))).alias("_p"))
    trees = [F.col("_p").getField(f"_p{i}") for i in range(len(read.trees))]
    parsed = parsed.where(truthy(F.col("_e"), source_id_field, read.value(0, trees)))
    item_id = read.value(0, trees)
    pos = F.col("_pos").cast("string")
    generated = {
        nested_name: key_of(f"{table_name}_", key_part(item_id), "_", key_part(F.col("_doc")), "_", pos),
        id_name: key_of(f"{item_key_prefix}_", F.col("_doc"), "_", pos),
        parent_name: item_id,
    }
    cols, i = [], 1
    for name, _ in fields:
        if name in generated:
            cols.append(generated[name].alias(name))
        else:
            cols.append(stringify(read.value(i, trees)).alias(name))
            i += 1
    if with_document_id:
        cols.append(F.col("_doc").alias("document_id"))
    return parsed.select(*cols)
