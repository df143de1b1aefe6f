"""DataFrame -> DataFrame operators: cleaning, schema/DQ, joins, aggregation, upsert."""

from .aggregate import aggregate, pivot_sum
from .cleaning import (
    add_ingestion_date,
    apply_steps,
    cast_types,
    drop_duplicates,
    filter_nulls,
    get_transform,
    keep_first_per_key,
    latest_per_key,
    register_transform,
    standardize_strings,
)
from .joins import join_using
from .schema import ColumnSpec, enforce_schema, missing_columns, null_violations
from .upsert import upsert_frames

__all__ = [
    "ColumnSpec",
    "add_ingestion_date",
    "aggregate",
    "apply_steps",
    "cast_types",
    "drop_duplicates",
    "enforce_schema",
    "filter_nulls",
    "get_transform",
    "join_using",
    "keep_first_per_key",
    "latest_per_key",
    "missing_columns",
    "null_violations",
    "pivot_sum",
    "register_transform",
    "standardize_strings",
    "upsert_frames",
]
