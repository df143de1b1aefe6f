"""Reports over the gold marts (the dashboard's queries as DataFrames).

Each report takes mart DataFrames and returns a DataFrame; nothing is
collected.  Orderings follow the SQL the dashboard ran (``DESC`` puts nulls
first there), with the group key as the final tie-break so a top-k is
deterministic.  Top-k (``LIMIT 15``) is a feature of the report and plans as
``TakeOrderedAndProject``: every task keeps only k rows.

``kpis``, ``regions`` and ``top_stores`` reproduce the dashboard's own
arithmetic (mean of daily averages, sum of per-group distinct counts);
``kpis_exact`` and ``regions_exact`` compute the same figures correctly from
silver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.money import long_sum, money_avg, money_sum
from ..functions.shares import share_of_total
from ..operators import distinct
from ..operators.aggregate import pivot_sum

TOP_K = 15


def mean_of(c: str):
    """Unweighted mean of per-group averages, from their exact decimal sum: the same
    in every run, whatever the order of the groups."""
    return money_avg(c)


def trend(daily: DataFrame) -> DataFrame:
    return daily.select("order_date", "total_revenue", "order_count", "avg_order_value").orderBy(
        F.col("order_date").asc_nulls_last()
    )


def kpis(daily: DataFrame, regional: DataFrame) -> DataFrame:
    """Headline figures as the dashboard computes them, in one aggregate:
    total revenue and orders over days, the *unweighted* mean of daily
    averages, and the sum of per-(region, segment, channel) distinct
    customers (which counts a customer once per group it appears in)."""
    rows = daily.select(
        "total_revenue", "order_count", "avg_order_value", F.lit(None).cast("long").alias("unique_customers")
    ).unionByName(
        regional.select(
            F.lit(None).cast("double").alias("total_revenue"),
            F.lit(None).cast("long").alias("order_count"),
            F.lit(None).cast("double").alias("avg_order_value"),
            F.col("unique_customers").cast("long"),
        )
    )
    return rows.agg(
        money_sum("total_revenue").alias("total_revenue"),
        long_sum("order_count").alias("total_orders"),
        mean_of("avg_order_value").alias("avg_order_value"),
        long_sum("unique_customers").alias("unique_customers"),
    )


def kpis_exact(orders_enriched: DataFrame) -> DataFrame:
    """The same headline figures from silver: weighted average order value and
    distinct customers counted once."""
    return orders_enriched.agg(
        money_sum("total_amount").alias("total_revenue"),
        F.count("order_id").alias("total_orders"),
        money_avg("total_amount").alias("avg_order_value"),
        F.count_distinct("customer_id").alias("unique_customers"),
    )


def store_totals(by_store: DataFrame) -> DataFrame:
    return by_store.groupBy("store_id", "store_name", "store_type").agg(
        money_sum("total_revenue").alias("total_revenue"),
        long_sum("order_count").alias("order_count"),
        mean_of("avg_order_value").alias("avg_order_value"),
    )


def top_stores(by_store: DataFrame, k: int = TOP_K) -> DataFrame:
    return (
        store_totals(by_store)
        .orderBy(F.col("total_revenue").desc_nulls_first(), F.col("store_id").asc_nulls_first())
        .limit(k)
    )


def store_type_split(by_store: DataFrame, k: int = TOP_K) -> DataFrame:
    """Revenue per store type *among the top-k stores* (what the pie shows)."""
    return top_stores(by_store, k).groupBy("store_type").agg(money_sum("total_revenue").alias("total_revenue"))


def top_customers(by_customer: DataFrame, k: int = TOP_K) -> DataFrame:
    return (
        by_customer.select("customer_id", "segment", "region", "total_spend", "order_count", "avg_order_value")
        .orderBy(F.col("total_spend").desc_nulls_first(), F.col("customer_id").asc_nulls_first())
        .limit(k)
    )


def segments(by_customer: DataFrame) -> DataFrame:
    return (
        by_customer.groupBy("segment")
        .agg(
            F.count(F.lit(1)).alias("customers"),
            money_sum("total_spend").alias("total_revenue"),
            money_avg("total_spend").alias("avg_clv"),
        )
        .orderBy(F.col("total_revenue").desc_nulls_first(), F.col("segment").asc_nulls_first())
    )


def avg_clv(by_customer: DataFrame) -> DataFrame:
    return by_customer.agg(money_avg("total_spend").alias("avg_clv"))


def top_products(by_product: DataFrame, k: int = TOP_K) -> DataFrame:
    return (
        by_product.select("product_id", "total_quantity", "total_revenue", "order_count")
        .orderBy(F.col("total_revenue").desc_nulls_first(), F.col("product_id").asc_nulls_first())
        .limit(k)
    )


def categories(by_category: DataFrame) -> DataFrame:
    return (
        by_category.filter(F.col("category").isNotNull())
        .groupBy("category")
        .agg(
            money_sum("total_revenue").alias("total_revenue"),
            long_sum("total_quantity").alias("total_quantity"),
            long_sum("order_count").alias("order_count"),
            mean_of("avg_discount").alias("avg_discount"),
        )
        .orderBy(F.col("total_revenue").desc_nulls_first(), F.col("category").asc_nulls_first())
    )


def regions(regional: DataFrame) -> DataFrame:
    """Per region; null regions are dropped, as a pandas group-by does."""
    return (
        regional.filter(F.col("region").isNotNull())
        .groupBy("region")
        .agg(
            money_sum("total_revenue").alias("total_revenue"),
            long_sum("order_count").alias("order_count"),
            long_sum("unique_customers").alias("unique_customers"),
        )
        .orderBy(F.col("total_revenue").desc_nulls_last(), F.col("region").asc_nulls_first())
    )


def regions_exact(orders_enriched: DataFrame) -> DataFrame:
    """Per region from silver: each customer counted once per region."""
    return (
        orders_enriched.filter(F.col("region").isNotNull())
        .groupBy("region")
        .agg(
            money_sum("total_amount").alias("total_revenue"),
            F.count("order_id").alias("order_count"),
            F.count_distinct("customer_id").alias("unique_customers"),
        )
        .orderBy(F.col("total_revenue").desc_nulls_last(), F.col("region").asc_nulls_first())
    )


def channels(regional: DataFrame) -> DataFrame:
    return (
        regional.filter(F.col("channel").isNotNull())
        .groupBy("channel")
        .agg(money_sum("total_revenue").alias("total_revenue"), long_sum("order_count").alias("order_count"))
    )


def region_segment_matrix(regional: DataFrame, segment_values: Sequence[str] | None = None) -> DataFrame:
    """Region x segment revenue; missing cells are 0.  The columns are the segments
    that the mart holds (it has a few hundred rows), or ``segment_values``: then no job
    looks for them, and a row of another segment fails the query.  Null regions and
    segments are not labels of the matrix."""
    if segment_values is None:
        found = [r[0] for r in regional.select("segment").where("segment IS NOT NULL").distinct().orderBy("segment").collect()]
    else:
        found, segment = list(segment_values), F.col("segment")
        fault = F.raise_error(F.concat(F.lit("segment outside the given columns: "), segment))
        regional = regional.withColumn("segment", F.when(segment.isNull() | segment.isin(found), segment).otherwise(fault))
    return pivot_sum(regional, "region", "segment", found, money_sum("total_revenue"))


def _leader(dim: str, table: DataFrame, name_col: str) -> DataFrame:
    return table.agg(
        F.lit(dim).alias("dimension"),
        F.count(F.lit(1)).alias("n_values"),
        F.max_by(F.col(name_col), F.struct(F.col("total_revenue"), F.col(name_col))).alias("top_name"),
        F.max("total_revenue").alias("top_revenue"),
    )


def leaders(by_customer: DataFrame, by_category: DataFrame, regional: DataFrame) -> DataFrame:
    """"How many" and "which is first" per dimension, one row each."""
    return (
        _leader("segment", segments(by_customer), "segment")
        .unionByName(_leader("category", categories(by_category), "category"))
        .unionByName(_leader("region", regions(regional), "region"))
    )


def revenue_share(by_store: DataFrame, by_category: DataFrame, regional: DataFrame, k: int = TOP_K) -> DataFrame:
    """Share of revenue by category, by store type (top-k stores) and by
    channel: the percentages the pie charts print."""
    parts = (
        categories(by_category).select(F.lit("category").alias("dimension"), F.col("category").alias("name"), "total_revenue")
        .unionByName(
            store_type_split(by_store, k).select(
                F.lit("store_type").alias("dimension"), F.col("store_type").alias("name"), "total_revenue"
            )
        )
        .unionByName(channels(regional).select(F.lit("channel").alias("dimension"), F.col("channel").alias("name"), "total_revenue"))
    )
    return parts.withColumn("share", share_of_total("total_revenue", ["dimension"]))


def breakdown(mart: DataFrame, dimensions: Sequence[Sequence[str]], count: str = "order_count") -> DataFrame:
    """Revenue and orders by several groupings of one mart in one pass (GROUPING SETS): a row
    per grouping and value, with its share of the grouping's revenue and whether it leads.
    ``()`` is the total.  Columns that a grouping leaves out are null; ``grouping`` names
    those it has."""
    names = list(dict.fromkeys(c for d in dimensions for c in d))
    sets = [[F.col(c) for c in d] for d in dimensions]
    # grouping_id: a bit per column, set where it is left out.
    labels = {sum(1 << (len(names) - 1 - k) for k, c in enumerate(names) if c not in d): ",".join(d) for d in dimensions}
    label = F.element_at(F.create_map(*[F.lit(x) for kv in labels.items() for x in kv]), F.grouping_id().cast("int"))
    rows = mart.groupingSets(sets, *names).agg(
        label.alias("grouping"), money_sum("total_revenue").alias("total_revenue"), long_sum(count).alias(count)
    )
    order = Window.partitionBy("grouping").orderBy(F.col("total_revenue").desc_nulls_last(), *[F.col(c).asc_nulls_first() for c in names])
    return rows.select(
        "grouping", *names, "total_revenue", count,
        share_of_total("total_revenue", ["grouping"]).alias("share"),
        (F.row_number().over(order) == 1).alias("leads"),
    )


def regions_from_state(state: DataFrame) -> DataFrame:
    """``regions_exact`` from the mergeable mart alone."""
    metrics = [distinct.total("total_amount").alias("total_revenue"), F.sum("rows").alias("order_count")]
    named = state.filter(F.col("region").isNotNull())
    return distinct.roll_up(named, ["region"], metrics, "unique_customers").orderBy(
        F.col("total_revenue").desc_nulls_last(), F.col("region").asc_nulls_first()
    )


def kpis_from_state(state: DataFrame) -> DataFrame:
    """``kpis_exact`` from the mergeable mart alone."""
    metrics = [
        distinct.total("total_amount").alias("total_revenue"),
        F.sum("rows").alias("total_orders"),
        distinct.mean("total_amount").alias("avg_order_value"),
    ]
    return distinct.roll_up(state, [], metrics, "unique_customers")


# The column captions of the dashboard's detail tables.
STORE_DETAIL = {"store_name": "Store", "store_type": "Type", "total_revenue": "Revenue", "order_count": "Orders"}
SEGMENT_DETAIL = {"segment": "Segment", "customers": "Customers", "total_revenue": "Total Revenue", "avg_clv": "Avg CLV"}
PRODUCT_DETAIL = {"product_id": "Product", "total_revenue": "Revenue", "total_quantity": "Units Sold", "order_count": "Orders"}
CATEGORY_DETAIL = {
    "category": "Category", "total_revenue": "Revenue", "total_quantity": "Units Sold",
    "order_count": "Orders", "avg_discount": "Avg Discount",
}


def detail(df: DataFrame, captions: dict[str, str]) -> DataFrame:
    """Column subset in caption order, renamed to the captions."""
    return df.select(*[F.col(c).alias(name) for c, name in captions.items()])
