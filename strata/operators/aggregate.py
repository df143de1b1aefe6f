"""``group by`` plus metric Columns, and the pivot."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

def aggregate(df: DataFrame, group_by: Sequence[str], metrics: Sequence[Column]) -> DataFrame:
    """``groupBy(*group_by).agg(*metrics)``; null group keys form a group.

    Sums, counts and averages aggregate partially before the shuffle;
    ``count(distinct)`` is expanded by Catalyst into a two-level aggregate
    keyed by (group, value), so a hot group is spread over its values.
    """
    cols = list(metrics)
    if not cols:
        raise ValueError("aggregate needs at least one metric")
    if not group_by:
        return df.agg(*cols)
    return df.groupBy(*group_by).agg(*cols)


def pivot_sum(
    df: DataFrame,
    row: str,
    column: str,
    values: Sequence[str],
    measure: str | Column,
    fill: float = 0.0,
) -> DataFrame:
    """``row x column`` matrix of ``sum(measure)``, missing cells ``fill``.

    ``measure`` is a column name (summed) or an aggregate Column.  The pivot
    values are passed explicitly: no job to discover them and a stable
    output schema.  Null row keys are dropped (a matrix has no null row
    label).
    """
    agg = F.sum(F.col(measure)) if isinstance(measure, str) else measure
    out = (
        df.filter(F.col(row).isNotNull())
        .groupBy(row)
        .pivot(column, list(values))
        .agg(agg)
    )
    return out.na.fill(fill, subset=list(values))
