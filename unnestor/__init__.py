"""unnestor: nested JSON documents -> relational tables, on Spark.

Public API::

    from unnestor import Catalog, normalize, read_document_lines, load_database, ParquetStore
    tables = normalize(read_document_lines(spark, path), catalog, "my_root")
"""

from .plans.catalog import Catalog, CatalogError, TableSpec
from .plans.normalize import extract_table, normalize, normalize_parsed, normalize_staged, rejected_documents
from .plans.pipeline import ENTITIES, load_database, run_databases
from .sinks.tables import JdbcStore, LoadReport, ParquetStore, load_table
from .sources.documents import documents_from, parse_documents, read_document_lines, read_envelope

__all__ = [
    "Catalog",
    "CatalogError",
    "TableSpec",
    "extract_table",
    "normalize",
    "normalize_parsed",
    "normalize_staged",
    "rejected_documents",
    "ENTITIES",
    "load_database",
    "run_databases",
    "JdbcStore",
    "LoadReport",
    "ParquetStore",
    "load_table",
    "documents_from",
    "parse_documents",
    "read_document_lines",
    "read_envelope",
]
