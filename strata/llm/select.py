"""The k-th largest value of a long column, without sorting it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BINS = 4096


def kth_largest(df: DataFrame, col: str, k: int) -> int | None:
    """Value ``v`` such that fewer than ``k`` rows are larger and at least ``k`` are
    ``>= v`` (the smallest value if there are fewer rows).  Each pass counts
    ``BINS`` bins of the range that still holds it; at most six passes."""
    lo, hi = df.agg(F.min(col), F.max(col)).first()
    if lo is None:
        return None
    left = k
    while lo < hi:
        width = (hi - lo) // BINS + 1
        rows = (
            df.where(F.col(col).between(lo, hi))
            .groupBy(F.expr(f"({col} - {lo}L) div {width}L").alias("bin"))
            .agg(F.count(F.lit(1)).alias("n"))
            .collect()  # at most BINS rows
        )
        for row in sorted(rows, reverse=True):
            if left <= row.n or row is min(rows):
                lo, hi = lo + row.bin * width, min(hi, lo + row.bin * width + width - 1)
                break
            left -= row.n
    return lo
