"""Keyed, versioned Parquet tables kept current with Spark."""

from .spec import COW, DELETE, EVENT_TIME, METADATA_COLUMNS, MOR, OVERWRITE_LATEST, TableSpec
from .tables import KeyedTable

__all__ = ["COW", "DELETE", "EVENT_TIME", "KeyedTable", "METADATA_COLUMNS", "MOR", "OVERWRITE_LATEST", "TableSpec"]
