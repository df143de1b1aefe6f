"""Silver build: clean -> conform -> enrich -> declared schema.

Cleaning (null filter, deterministic dedup) runs *before* the joins, so bad
and duplicate rows never travel through a join shuffle, and each join input
is reduced to the columns the job selects.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

from ..operators.cleaning import apply_steps, drop_duplicates, filter_nulls, latest_per_key
from ..operators.joins import join_using
from ..operators.schema import SchemaReport, enforce_schema
from .retail_model import SILVER_SCHEMAS


def version_order(df: DataFrame, column: str = "ingestion_date") -> list:
    """Newest ingestion first, when the frame carries one."""
    return [(column, "desc")] if column in df.columns else []


def prepare_side(side: DataFrame, lookup: Mapping, batch: DataFrame | None = None, unique: bool = False) -> DataFrame:
    """The right side of a lookup: selected columns, latest version per key
    when the side is a versioned (bronze) table and not ``unique`` per key already.

    With ``batch`` given, the versioned side is first reduced to the keys the
    batch looks up (left-semi join): an incremental day touches few keys,
    and when they are small enough AQE broadcasts them, so the history is
    filtered inside the scan tasks instead of being shuffled whole for the
    window.  The result of the lookup is unchanged.
    """
    if not lookup.get("latest"):
        return side
    on = lookup["on"]
    keep = [on, *[c for c in lookup.get("select") or side.columns if c != on]]
    if "ingestion_date" in side.columns and "ingestion_date" not in keep:
        keep.append("ingestion_date")
    side = side.select(*keep)
    if batch is not None:
        side = side.join(batch.select(on).filter(batch[on].isNotNull()).distinct(), on, "left_semi")
    return side if unique else latest_per_key(side, [on])


def build_silver(
    job: Mapping,
    bronze: DataFrame,
    sides: Mapping[str, DataFrame],
    on_null_violation: str | None = None,
    schema=None,
) -> tuple[DataFrame, SchemaReport]:
    df = filter_nulls(bronze, job["not_null_columns"])
    df = drop_duplicates(df, job["dedup_key"], order_by=version_order(df))
    df = apply_steps(df, job.get("transformations", []))
    for lookup in job.get("joins", []):
        side = prepare_side(sides[lookup["source"]], lookup)  # a full load: every key is looked up
        df = join_using(df, side, lookup["on"], lookup.get("type", "left"), lookup.get("select"))
    declared = schema if schema is not None else SILVER_SCHEMAS[job["target"]]
    return enforce_schema(df, declared, on_null_violation or job.get("on_null_violation", "warn"))
