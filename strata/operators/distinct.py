"""Distinct counts that add up again: dense codes and bitmaps over them.

A count of distinct values can't be added up over groups; the set of values can.  Values
get dense whole-number codes once, and a state holds the codes of each group as bitmaps
(Spark's own ``bitmap_*`` functions), one row per group and bucket of 32,768 codes.  Any
coarser grouping is the union of bitmaps, so its exact distinct count comes from the state
alone.  States of disjoint sets of rows are merged by the same union.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.money import as_amount
from ..session import new_scratch_path

VALUE, CODE, BUCKET, BITMAP = "value", "code", "code_bucket", "codes"


def _staged(df: DataFrame, name: str) -> DataFrame:
    path = new_scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def assign_codes(values: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """``value, code`` for every distinct non-null value: those of ``known`` keep theirs, new
    ones follow without gaps.

    New values are range-partitioned and numbered within their partition; a partition
    begins where the ones before end, which takes one count per partition and no global sort."""
    column = F.col(values.columns[0])
    fresh = values.select(column.alias(VALUE)).where(F.col(VALUE).isNotNull()).distinct()
    begin = 0
    if known is not None:
        begin = known.agg(F.coalesce(F.max(CODE) + 1, F.lit(0).cast("long"))).first()[0]
        fresh = fresh.join(known.select(VALUE), VALUE, "left_anti")
    width = int(values.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = _staged(fresh.repartitionByRange(width, VALUE).withColumn("part", F.spark_partition_id()), "codes")
    starts = []
    for row in placed.groupBy("part").agg(F.count(F.lit(1)).alias("n")).orderBy("part").collect():  # at most ``width`` rows
        starts.append((row.part, begin))
        begin += row.n
    offsets = values.sparkSession.createDataFrame(starts, "part int, start long")
    number = F.row_number().over(Window.partitionBy("part").orderBy(VALUE)) - 1
    coded = placed.withColumn("number", number).join(offsets, "part").select(VALUE, (F.col("start") + F.col("number")).alias(CODE))
    return coded if known is None else known.select(VALUE, CODE).unionByName(coded)


def distinct_state(df: DataFrame, group_by: Sequence[str], code: str, amounts: Sequence[str] = ()) -> DataFrame:
    """One row per group and code bucket: its codes, its rows, and exact sums of ``amounts``.
    Rows without a code are in the bucket null."""
    bucketed = df.withColumn(BUCKET, F.bitmap_bucket_number(F.col(code)))
    parts = [F.bitmap_construct_agg(F.bitmap_bit_position(F.col(code))).alias(BITMAP), F.count(F.lit(1)).alias("rows")]
    for c in amounts:
        parts += [F.sum(as_amount(c)).alias(f"{c}_sum"), F.count(c).alias(f"{c}_n"), F.count(as_amount(c)).alias(f"{c}_fit"), F.sum(c).alias(f"{c}_plain")]
    return bucketed.groupBy(*group_by, BUCKET).agg(*parts)


def merge_states(states: Sequence[DataFrame], group_by: Sequence[str]) -> DataFrame:
    """The state of all rows of several states."""
    union = states[0]
    for s in states[1:]:
        union = union.unionByName(s)
    sums = [F.sum(c).cast(t).alias(c) for c, t in union.dtypes if c not in (*group_by, BUCKET, BITMAP)]
    return union.groupBy(*group_by, BUCKET).agg(F.bitmap_or_agg(F.col(BITMAP)).alias(BITMAP), *sums)


def roll_up(state: DataFrame, by: Sequence[str], metrics: Sequence[Column], distinct: str) -> DataFrame:
    """Group a state again by some of its keys (or none): exact distinct count and ``metrics``
    over the summed parts (columns ``rows``, ``<amount>_sum`` and so on)."""
    merged = merge_states([state], by)
    codes = F.coalesce(F.sum(F.bitmap_count(F.col(BITMAP))), F.lit(0).cast("long")).alias(distinct)
    return merged.groupBy(*by).agg(codes, *metrics) if by else merged.agg(codes, *metrics)


def total(amount: str) -> Column:
    """Sum of an amount over state rows, as ``money_sum`` gives it."""
    exact = F.sum(f"{amount}_sum").cast("double")
    return F.when(F.sum(f"{amount}_n") == F.sum(f"{amount}_fit"), exact).otherwise(F.sum(f"{amount}_plain"))


def mean(amount: str) -> Column:
    return F.try_divide(total(amount), F.sum(f"{amount}_n"))
