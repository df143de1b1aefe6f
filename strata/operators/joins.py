"""Equi-joins with ``USING`` semantics.

No join here carries a broadcast hint: the planner broadcasts a side only
when its size (estimated, or measured at runtime by AQE) is under
``spark.sql.autoBroadcastJoinThreshold``; bigger sides are shuffled and
sort-merge joined, with AQE splitting skewed partitions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

#: Spark's spellings of the join types, without underscores.
JOIN_TYPES = {
    "inner", "left", "leftouter", "right", "rightouter", "full", "fullouter", "outer",
    "leftsemi", "semi", "leftanti", "anti",
}


def join_using(
    left: DataFrame,
    right: DataFrame,
    on: str | Sequence[str],
    how: str = "left",
    select: Sequence[str] | None = None,
) -> DataFrame:
    """Join on named key column(s): the key appears once, then the left
    columns, then the right columns.

    ``select`` restricts the right side (the key is added if absent), which
    also prunes the right scan.  A selected right column that the left side has
    too is an error; without ``select``, such columns stay with the left side.
    """
    how = how.lower()
    if how.replace("_", "") not in JOIN_TYPES:
        raise ValueError(f"Unsupported join type '{how}'")
    keys = [on] if isinstance(on, str) else list(on)
    if select:
        cols = list(select)
        for k in reversed(keys):
            if k not in cols:
                cols.insert(0, k)
        right = right.select(*cols)
    clashes = [c for c in right.columns if c in left.columns and c not in keys]
    if clashes and select:
        raise ValueError(f"selected column(s) {clashes} exist on the left side too")
    if clashes:
        right = right.drop(*clashes)
    return left.join(right, keys, how)
