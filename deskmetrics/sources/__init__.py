"""Sources (parquet, JDBC, catalog tables, test fixtures), sinks and the bucketed layout."""

from .layout import CatalogSource, write_layout
from .tables import FixtureSource, JdbcSource, ParquetSource, Source, Tables, load_table

__all__ = [
    "CatalogSource",
    "FixtureSource",
    "JdbcSource",
    "ParquetSource",
    "Source",
    "Tables",
    "load_table",
    "write_layout",
]
