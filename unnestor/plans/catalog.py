"""Schema catalogue: declarative table layouts compiled to Spark types.

A catalogue maps a config key to a :class:`TableSpec`. The accepted format is a
mapping (typically loaded from YAML) of the form::

    my_main:
      table_name: my_main
      primary_key: relationship_id
      nested_tables:
        - field: items            # column of the parent holding the child data
          target_table: my_items  # config key of the child layout
          foreign_key: main_id    # name under which the parent key is emitted
          use_nested_transformer: false   # true -> path extraction (G4)
      fields:
        - {name: relationship_id, type: string, source_field: _id}
        - {name: items, type: "array<map<string,string>>"}

Everything here is driver-side metadata; nothing touches data.
"""

from __future__ import annotations

import os
from dataclasses import dataclass, field
from typing import Any, Iterable, Mapping

from pyspark.sql import types as T

# The type names a layout may declare and their Spark types.
# Any other name falls back to string.
_TYPE_NAMES: dict[str, T.DataType] = {
    "string": T.StringType(),
    "boolean": T.BooleanType(),
    "integer": T.IntegerType(),
    "float": T.FloatType(),
    "timestamp": T.TimestampType(),
    "map<string,string>": T.MapType(T.StringType(), T.StringType()),
    "array<integer>": T.ArrayType(T.IntegerType()),
    "array<map<string,string>>": T.ArrayType(T.MapType(T.StringType(), T.StringType())),
}

PRIMITIVE = "primitive"
RECORDS = "struct"
SINGLE = "single_struct"
PATH = "path"


class CatalogError(ValueError):
    """Raised for layouts that cannot be compiled."""


def spark_type(type_name: str) -> T.DataType:
    """YAML type name -> Spark type; unknown names map to string."""
    return _TYPE_NAMES.get(str(type_name).replace(" ", ""), T.StringType())


@dataclass(frozen=True)
class FieldSpec:
    name: str
    type: str = "string"
    nullable: bool = True
    generated: bool = False
    source_field: str | None = None
    default: Any = None
    fields: tuple["FieldSpec", ...] = ()
    nested_table: bool = False

    @property
    def source(self) -> str:
        return self.source_field or self.name

    def data_type(self) -> T.DataType:
        if self.type == "struct":
            return struct_of(self.fields)
        return spark_type(self.type)

    @staticmethod
    def parse(raw: Mapping[str, Any]) -> "FieldSpec":
        if "name" not in raw:
            raise CatalogError(f"field without a name: {raw!r}")
        ftype = str(raw.get("type", "string"))
        sub = tuple(FieldSpec.parse(f) for f in raw.get("fields", ()) or ())
        if ftype == "struct" and not sub:
            raise CatalogError(f"struct field {raw['name']!r} declares no fields")
        return FieldSpec(
            name=str(raw["name"]),
            type=ftype,
            nullable=bool(raw.get("nullable", True)),
            generated=bool(raw.get("generated", False)),
            source_field=raw.get("source_field"),
            default=raw.get("default"),
            fields=sub,
            nested_table=bool(raw.get("nested_table", False)),
        )


def struct_of(fields: Iterable[FieldSpec]) -> T.StructType:
    """Declared fields -> StructType, skipping generated ones."""
    return T.StructType(
        [T.StructField(f.name, f.data_type(), f.nullable) for f in fields if not f.generated]
    )


@dataclass(frozen=True)
class ChildLink:
    """One entry of a table's ``nested_tables``."""

    field: str
    target: str
    foreign_key: str
    use_path: bool = False
    parent_table: str | None = None

    @staticmethod
    def parse(raw: Mapping[str, Any]) -> "ChildLink":
        missing = [k for k in ("field", "target_table") if k not in raw]
        if missing:
            raise CatalogError(f"nested table entry lacks {missing}: {raw!r}")
        return ChildLink(
            field=str(raw["field"]),
            target=str(raw["target_table"]),
            foreign_key=str(raw.get("foreign_key") or "parent_id"),
            use_path=bool(raw.get("use_nested_transformer", False)),
            parent_table=raw.get("parent_table"),
        )


@dataclass(frozen=True)
class TableSpec:
    key: str
    table_name: str
    primary_key: str | None
    fields: tuple[FieldSpec, ...]
    children: tuple[ChildLink, ...] = ()
    is_array: bool = False
    foreign_key: str | None = None
    use_path: bool = False
    path: tuple[str, ...] = ()
    source_id_field: str = "ID"

    @staticmethod
    def parse(key: str, raw: Mapping[str, Any]) -> "TableSpec":
        if not isinstance(raw, Mapping):
            raise CatalogError(f"layout {key!r} is not a mapping")
        fields = tuple(FieldSpec.parse(f) for f in raw.get("fields", ()) or ())
        if not fields:
            raise CatalogError(f"layout {key!r} declares no fields")
        names = [f.name for f in fields]
        dup = {n for n in names if names.count(n) > 1}
        if dup:
            raise CatalogError(f"layout {key!r} declares {sorted(dup)} twice")
        path = tuple(
            str(step["field"]) if isinstance(step, Mapping) else str(step)
            for step in raw.get("path", ()) or ()
        )
        return TableSpec(
            key=key,
            table_name=str(raw.get("table_name", key)),
            primary_key=raw.get("primary_key"),
            fields=fields,
            children=tuple(ChildLink.parse(c) for c in raw.get("nested_tables", ()) or ()),
            is_array=bool(raw.get("is_array", False)),
            foreign_key=raw.get("foreign_key"),
            use_path=bool(raw.get("use_nested_transformer", False)),
            path=path,
            source_id_field=str(raw.get("source_id_field", "ID")),
        )

    # -- C1 ---------------------------------------------------------------
    @property
    def schema(self) -> T.StructType:
        return struct_of(self.fields)

    def field(self, name: str) -> FieldSpec | None:
        return next((f for f in self.fields if f.name == name), None)

    # -- C3 ---------------------------------------------------------------
    def type_of(self, name: str) -> T.DataType:
        f = self.field(name)
        return f.data_type() if f is not None else T.StringType()

    def data_fields(self, *exclude: str | None) -> list[FieldSpec]:
        """Declared, non-generated fields minus the given names."""
        skip = {e for e in exclude if e}
        return [f for f in self.fields if not f.generated and f.name not in skip]

    # -- C6 ---------------------------------------------------------------
    def kind(self, link: ChildLink | None = None) -> str:
        """Nested-kind rule: path extraction if flagged; an array with one data
        field is a primitive array, with more it is an array of records;
        anything else is a single struct. The foreign key named on the link
        counts as a key too (so a single-value child without a table-level
        foreign key is still primitive)."""
        if self.use_path or (link is not None and link.use_path):
            return PATH
        if not self.is_array:
            return SINGLE
        fk_names = {"id", self.foreign_key, link.foreign_key if link else None}
        data = [f for f in self.fields if not f.generated and f.name not in fk_names]
        return PRIMITIVE if len(data) == 1 else RECORDS


@dataclass
class Catalog:
    """A set of table layouts, indexed by config key."""

    tables: dict[str, TableSpec] = field(default_factory=dict)

    @staticmethod
    def from_dict(raw: Mapping[str, Mapping[str, Any]]) -> "Catalog":
        cat = Catalog()
        for key, layout in raw.items():
            cat.add(TableSpec.parse(str(key), layout))
        return cat

    @staticmethod
    def from_yaml_text(*texts: str, duplicates: str = "error") -> "Catalog":
        """Layouts from YAML text. A key repeated inside one mapping is an
        error by default (a silently overwritten block changes which table
        is written); ``duplicates="first"`` or ``"last"`` keeps that
        occurrence instead, for migrating existing files."""
        cat = Catalog()
        for text in texts:
            for key, layout in _load_yaml_unique(text, duplicates).items():
                cat.add(TableSpec.parse(str(key), layout))
        return cat

    @staticmethod
    def load_dir(path: str, duplicates: str = "error") -> "Catalog":
        """Read every ``.yml``/``.yaml`` file of a directory (sorted, so the
        result does not depend on directory order). A layout key declared in
        two files, or two layouts writing the same table, are rejected."""
        texts = []
        for name in sorted(os.listdir(path)):
            if name.endswith((".yml", ".yaml")):
                with open(os.path.join(path, name), encoding="utf-8") as fh:
                    texts.append(fh.read())
        return Catalog.from_yaml_text(*texts, duplicates=duplicates)

    def add(self, spec: TableSpec) -> None:
        if spec.key in self.tables:
            raise CatalogError(f"layout {spec.key!r} is declared twice")
        from ..functions.values import sanitize_name

        clash = [
            t.key for t in self.tables.values()
            if sanitize_name(t.table_name) == sanitize_name(spec.table_name)
        ]
        if clash:
            raise CatalogError(
                f"layout {spec.key!r} writes table {spec.table_name!r}, which after "
                f"sanitising collides with layout {clash[0]!r}"
            )
        self.tables[spec.key] = spec

    def __getitem__(self, key: str) -> TableSpec:
        try:
            return self.tables[key]
        except KeyError:
            raise CatalogError(f"unknown layout {key!r}") from None

    def __contains__(self, key: str) -> bool:
        return key in self.tables

    # -- C7 ---------------------------------------------------------------
    def tree(self, root: str) -> list[str]:
        """Config keys of ``root`` and its descendants, depth-first, each once."""
        out: list[str] = []

        def walk(key: str) -> None:
            if key in out:
                return
            out.append(key)
            spec = self.tables.get(key)
            for link in spec.children if spec else ():
                walk(link.target)

        walk(root)
        return out

    def table_names(self, root: str) -> list[str]:
        return [self[k].table_name for k in self.tree(root) if k in self.tables]

    def problems(self, root: str) -> list[str]:
        """Metadata-only checks of a tree: every link's target exists, parents
        of non-path children declare a primary key and the linked field, and
        no two tables of the tree write the same (sanitised) name."""
        from ..functions.values import sanitize_name

        out: list[str] = []
        if root not in self.tables:
            return [f"unknown root layout {root!r}"]
        seen: dict[str, str] = {}
        for key in self.tree(root):
            spec = self.tables.get(key)
            if spec is None:
                continue
            clean = sanitize_name(spec.table_name)
            if clean in seen and seen[clean] != key:
                out.append(f"{key!r} and {seen[clean]!r} both write table {clean!r}")
            seen.setdefault(clean, key)
            for link in spec.children:
                target = self.tables.get(link.target)
                if target is None:
                    out.append(f"{key!r} links to unknown layout {link.target!r}")
                    continue
                if target.kind(link) == PATH:
                    continue
                parent = spec  # the table the child reads: its parent, or the named one
                if link.parent_table:
                    parent = next((t for t in self.tables.values() if t.table_name == link.parent_table), spec)
                if not parent.primary_key:
                    out.append(f"{parent.key!r} has children but no primary_key")
                if parent.field(link.field) is None:
                    out.append(f"{link.target!r} reads {link.field!r}, which {parent.key!r} does not declare")
        return out

    def validate(self, root: str) -> None:
        """Raise ``CatalogError`` listing every problem of the tree."""
        found = self.problems(root)
        if found:
            raise CatalogError("; ".join(found))


def _load_yaml_unique(text: str, duplicates: str = "error") -> dict:
    """YAML load with an explicit rule for repeated mapping keys: reject them
    (default), or keep the first or the last occurrence."""
    import warnings

    import yaml

    if duplicates not in ("error", "first", "last"):
        raise ValueError("duplicates must be 'error', 'first' or 'last'")

    class _Unique(yaml.SafeLoader):
        pass

    def construct(loader, node, deep=False):
        seen: dict = {}
        kept = []
        for key_node, value_node in node.value:
            k = loader.construct_object(key_node, deep=deep)
            if k in seen:
                where = f"duplicate key {k!r} (line {key_node.start_mark.line + 1})"
                if duplicates == "error":
                    raise CatalogError(where)
                warnings.warn(f"{where}: keeping the {duplicates} occurrence", stacklevel=2)
                if duplicates == "first":
                    continue
                kept[seen[k]] = (key_node, value_node)
                continue
            seen[k] = len(kept)
            kept.append((key_node, value_node))
        node.value = kept
        return yaml.SafeLoader.construct_mapping(loader, node, deep)

    _Unique.add_constructor(yaml.resolver.BaseResolver.DEFAULT_MAPPING_TAG, construct)
    data = yaml.load(text, Loader=_Unique) or {}
    if not isinstance(data, dict):
        raise CatalogError("a layout file must hold a mapping at top level")
    return data
