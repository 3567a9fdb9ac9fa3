"""Layouts, the table tree, staging and pipelines."""

from .catalog import Catalog, CatalogError, TableSpec
from .normalize import extract_table, normalize, normalize_parsed, normalize_staged
from .pipeline import ENTITIES, load_database, run_databases

__all__ = ["Catalog", "CatalogError", "TableSpec", "extract_table", "normalize", "normalize_parsed",
           "normalize_staged", "ENTITIES", "load_database", "run_databases"]
