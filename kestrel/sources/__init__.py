"""Source tables (SRC-01..SRC-21)."""

from .catalog import (  # noqa: F401
    PRODUCTION_LAYOUT, SOURCE_NAMES, CatalogSources, DataFrameSources, FixtureSources, JdbcSources, ParquetSources,
    Sources, materialize_sources,
)
from .schemas import SCHEMAS, SourceSchemaError  # noqa: F401
