"""Layouts, locations, and the way from CSV extracts to Parquet."""

from lapsewise.sources.catalog import Catalog, FeatureInputs, LabelInputs
from lapsewise.sources.ingest import (
    IngestCount,
    check_header,
    ingest,
    ingest_month,
    read_csv,
    validate_schema,
)
from lapsewise.sources.schemas import SCHEMAS, schema_for

__all__ = [
    "Catalog",
    "FeatureInputs",
    "IngestCount",
    "LabelInputs",
    "SCHEMAS",
    "check_header",
    "ingest",
    "ingest_month",
    "read_csv",
    "schema_for",
    "validate_schema",
]
