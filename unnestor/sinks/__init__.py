"""Table stores and the load step (K1-K3, K5, K6, A3)."""

from .tables import (
    JdbcStore, LoadReport, ParquetStore, Store, choose_primary_key, create_table_sql, load_table,
)

__all__ = ["JdbcStore", "LoadReport", "ParquetStore", "Store", "choose_primary_key",
           "create_table_sql", "load_table"]
