"""Driver tables with deterministic, injected defects.

The driver tables are clean (no nulls, padding or duplicates), so the
cleaning and DQ operators are exercised on copies where a fixed expression of
the key injects the defect.  Both Spark and SQL evaluate these expressions
identically, and every row of the table still flows through the operator.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .retail import orders_raw, table

# The key moduli that select defective rows.
NULL_CUSTOMER_MOD = 17
NAN_TOTAL_MOD = 13
MALFORMED_SIZE_MOD = 11
DUPLICATE_MOD = 10
NEW_VERSION_MOD = 10
ORPHAN_MOD = 19

LATER_INGESTION = date(2024, 2, 1)


def orders_with_null_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return o.withColumn(
        "o_custkey", F.when(F.col("o_orderkey") % NULL_CUSTOMER_MOD == 0, F.lit(None)).otherwise(F.col("o_custkey"))
    )


def orders_with_nan_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return o.withColumn(
        "o_totalprice",
        F.when(F.col("o_orderkey") % NAN_TOTAL_MOD == 0, F.lit(float("nan"))).otherwise(F.col("o_totalprice")),
    )


def orders_with_defects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Null customer keys *and* NaN totals *and* a null priority, each on its
    own rows, for the null filter over all columns."""
    o = orders_with_nan_totals(spark, sf_dir)
    return o.withColumns(
        {
            "o_custkey": F.when(F.col("o_orderkey") % NULL_CUSTOMER_MOD == 0, F.lit(None)).otherwise(F.col("o_custkey")),
            "o_orderpriority": F.when(F.col("o_orderkey") % ORPHAN_MOD == 0, F.lit(None)).otherwise(
                F.col("o_orderpriority")
            ),
        }
    )


def parts_as_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Part columns landed as text, with malformed sizes on some rows."""
    p = table(spark, sf_dir, "part")
    return p.select(
        "p_partkey",
        "p_name",
        F.when(F.col("p_partkey") % MALFORMED_SIZE_MOD == 0, F.lit("abc"))
        .otherwise(F.col("p_size").cast("string"))
        .alias("p_size"),
        F.col("p_retailprice").cast("string").alias("p_retailprice"),
        F.when(F.col("p_size") > 25, F.lit("true")).otherwise(F.lit("false")).alias("p_large"),
    )


def parts_padded(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    return p.select(
        "p_partkey",
        F.concat(F.lit("  "), F.upper("p_name"), F.lit(" ")).alias("p_name"),
        F.concat(F.lit(" "), F.col("p_type")).alias("p_type"),
        "p_brand",
    )


def orders_duplicated(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return o.unionByName(o.filter(F.col("o_orderkey") % DUPLICATE_MOD == 0))


def orders_versions(spark: SparkSession, sf_dir: str, run_date: date) -> DataFrame:
    """Bronze orders of ``run_date`` plus a later version (total doubled) of
    some orders: the input of latest-per-key selection and of upserts."""
    base = orders_raw(spark, sf_dir).withColumn("ingestion_date", F.to_date(F.lit(str(run_date))))
    newer = (
        base.filter(F.col("order_id").cast("long") % NEW_VERSION_MOD == 0)
        .withColumn("total_amount", F.col("total_amount") * 2)
        .withColumn("ingestion_date", F.to_date(F.lit(str(LATER_INGESTION))))
    )
    return base.unionByName(newer)


def orders_with_orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return o.withColumn(
        "o_custkey", F.when(F.col("o_orderkey") % ORPHAN_MOD == 0, F.lit(-1)).otherwise(F.col("o_custkey"))
    )
