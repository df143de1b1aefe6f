"""Share-of-total (the percentage a pie chart prints)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, Window
from pyspark.sql import functions as F

from .money import as_amount


def share_of_total(c: str | Column, partition_by: Sequence[str], money: bool = True) -> Column:
    """``c / sum(c) over (partition by …)``; the total is an exact decimal sum
    when ``money``.

    For aggregated relations (one row per category, store type or channel): a
    window gathers each partition's rows in one task.  ``partition_by`` must name
    at least one column, or all rows would meet.
    """
    if not partition_by:
        raise ValueError("share_of_total needs at least one partition column")
    col = F.col(c) if isinstance(c, str) else c
    w = Window.partitionBy(*partition_by)
    total = F.sum(as_amount(col)).over(w).cast("double") if money else F.sum(col).over(w)
    return F.try_divide(col, total)
