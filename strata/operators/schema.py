"""Declared schemas: one projection plus one data-quality aggregate.

A declared schema is a list of ``ColumnSpec(name, type, nullable)``.
``enforce_schema`` keeps the declared columns in declared order, casts each
with ``try_cast`` and checks ``nullable=False`` columns:

* ``warn``: the null counts ride along the next action as an
  ``Observation`` (no extra job); they are logged when read.
* ``fail``: a violation raises ``ValueError`` before anything is published.  By
  default one aggregate job counts first; with ``defer`` the counts are observed
  on the caller's own staging write and ``SchemaReport.check`` raises.
"""

from __future__ import annotations

import json
import logging
from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class ColumnSpec:
    name: str
    datatype: str
    nullable: bool = True


def parse_schema(spec: Iterable) -> list[ColumnSpec]:
    """Accept ColumnSpecs, ``(name, type, nullable)`` tuples or
    ``{column_name, datatype, nullable}`` dicts (the JSON file form)."""
    out: list[ColumnSpec] = []
    for item in spec:
        if isinstance(item, ColumnSpec):
            out.append(item)
        elif isinstance(item, dict):
            out.append(ColumnSpec(item["column_name"], item["datatype"], bool(item.get("nullable", True))))
        else:
            name, dtype, *rest = item
            out.append(ColumnSpec(name, dtype, bool(rest[0]) if rest else True))
    return out


def load_schema_file(path: str) -> list[ColumnSpec]:
    with open(path) as fh:
        return parse_schema(json.load(fh))


def missing_columns(df: DataFrame, schema: Sequence[ColumnSpec]) -> list[str]:
    present = set(df.columns)
    return [c.name for c in schema if c.name not in present]


def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """All null counts in one pass: a single row, one column per name."""
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])


def null_violations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Long form ``(column_name, violations)`` from one aggregate pass."""
    if not columns:
        raise ValueError("null_violations needs at least one column")
    wide = null_counts(df, columns)
    pairs = ", ".join(f"'{c}', `{c}`" for c in columns)
    return wide.selectExpr(f"stack({len(columns)}, {pairs}) as (column_name, violations)")


class SchemaReport:
    """What enforcement found: missing columns and (lazily) null counts."""

    def __init__(self, missing: list[str], checked: list[str], observation: Observation | None, counts: dict | None):
        self.missing = missing
        self.checked = checked
        self._observation = observation
        self._counts = counts

    def null_counts(self) -> dict[str, int]:
        """Counts per non-nullable column; with ``warn`` this is available
        once an action on the enforced DataFrame has finished."""
        if self._counts is None:
            self._counts = dict(self._observation.get) if self._observation is not None else {}
        return {c: int(self._counts.get(c, 0) or 0) for c in self.checked}

    def violations(self) -> dict[str, int]:
        return {c: n for c, n in self.null_counts().items() if n > 0}

    def log(self) -> None:
        for c, n in self.violations().items():
            log.warning("%d row(s) break NOT NULL on %s", n, c)

    def check(self) -> None:
        """Raise if a declared non-nullable column holds nulls."""
        for c, n in self.violations().items():
            raise ValueError(f"DQ: column '{c}' has {n} null(s), declared NOT NULL")


def enforce_schema(
    df: DataFrame,
    schema: Iterable,
    on_null_violation: str = "warn",
    defer: bool = False,
) -> tuple[DataFrame, SchemaReport]:
    """Project to the declared columns (in order), cast, and check nulls."""
    if on_null_violation not in ("warn", "fail"):
        raise ValueError("on_null_violation must be 'warn' or 'fail'")
    spec = parse_schema(schema)
    missing = missing_columns(df, spec)
    required_missing = [c.name for c in spec if c.name in missing and not c.nullable]
    if missing:
        log.warning("declared but absent, left out: %s", ", ".join(missing))
    if required_missing and on_null_violation == "fail":
        raise ValueError(f"DQ: non-nullable column(s) missing: {required_missing}")

    present = [c for c in spec if c.name not in missing]
    projected = df.select(*[F.col(c.name).try_cast(c.datatype).alias(c.name) for c in present])
    checked = [c.name for c in present if not c.nullable]
    if not checked:
        return projected, SchemaReport(missing, [], None, {})

    if on_null_violation == "fail" and not defer:
        report = SchemaReport(missing, checked, None, null_counts(projected, checked).first().asDict())
        report.check()
        return projected, report

    obs = Observation()
    observed = projected.observe(obs, *[F.count_if(F.col(c).isNull()).alias(c) for c in checked])
    return observed, SchemaReport(missing, checked, obs, None)
