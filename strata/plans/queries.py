"""Registered queries: each ``(spark, sf_dir) -> DataFrame`` over the driver
tables (or data Spark derives from them), whole tables, no row caps."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from ..functions.money import money_avg, money_sum
from ..operators import cleaning as C
from ..operators.joins import join_using
from ..operators.schema import enforce_schema
from ..operators.schema import null_violations as _null_violations
from ..session import new_scratch_path
from ..sources import defects as D
from ..sources.retail import order_items_raw, table
from . import colocated
from . import reports as R
from .marts import build_mart, build_named_mart
from .model import RetailModel, stored_model
from .registry import REGISTRY, register
from .retail_model import DEFAULT_RUN_DATE, SILVER_JOBS, SILVER_SCHEMAS
from .silver import build_silver, prepare_side


def model(spark: SparkSession, sf_dir: str) -> RetailModel:
    return RetailModel(spark, sf_dir)


# ------------------------------------------------------------------ silver


@register()
def silver_customers(spark, sf_dir):
    return model(spark, sf_dir).silver("retail_customers")


@register()
def silver_stores(spark, sf_dir):
    return model(spark, sf_dir).silver("retail_stores")


@register()
def silver_products(spark, sf_dir):
    return model(spark, sf_dir).silver("retail_products")


@register()
def orders_enriched(spark, sf_dir):
    return model(spark, sf_dir).silver("retail_orders")


@register()
def order_items_enriched(spark, sf_dir):
    return model(spark, sf_dir).silver("retail_order_items")


# -------------------------------------------------------------------- gold


@register()
def regional_sales(spark, sf_dir):
    return stored_model(spark, sf_dir).gold("regional_sales")


@register()
def sales_by_store(spark, sf_dir):
    return stored_model(spark, sf_dir).gold("sales_by_store")


@register()
def sales_by_customer(spark, sf_dir):
    return stored_model(spark, sf_dir).gold("sales_by_customer")


@register()
def daily_trend(spark, sf_dir):
    return stored_model(spark, sf_dir).gold("daily_trend")


@register()
def product_performance(spark, sf_dir):
    return stored_model(spark, sf_dir).gold("product_performance", apart=False)


@register()
def category_performance(spark, sf_dir):
    return stored_model(spark, sf_dir).gold("category_performance")


@register()
def category_performance_fine(spark, sf_dir):
    """The mart over discounts of three decimals."""
    items = stored_model(spark, sf_dir).silver("retail_order_items")
    return build_named_mart("gold_category_performance", items.withColumn("discount", F.col("discount") + F.col("quantity") / 1000))


@register()
def sql_text_metrics(spark, sf_dir):
    """A mart whose metrics are SQL text, over a projected expression."""
    spec = {
        "group_by": ["region"],
        "metrics": [
            {"name": "largest", "expr": "max(total_amount)"},
            {"name": "spread", "expr": "max(total_amount) - min(total_amount)"},
            {"name": "customers", "expr": "count(distinct customer_id)"},
            {"name": "urgent", "expr": "count_if(upper(channel) = '1-URGENT')"},
        ],
    }
    return build_mart(spec, stored_model(spark, sf_dir).silver("retail_orders"))


@register()
def money_extremes(spark, sf_dir):
    """Sums and means of amounts that no decimal holds: huge ones, infinities and NaN, by order status."""
    status, price = F.col("o_orderstatus"), F.col("o_totalprice")
    amount = (
        F.when(status == "F", F.lit(2.0**70))
        .when((status == "O") & (F.col("o_orderkey") % 100 == 1), F.lit(float("inf")))
        .when((status == "P") & (F.col("o_orderkey") % 50 == 1), F.lit(float("nan")))
        .otherwise(price)
    )
    half = F.when(F.col("o_orderkey") % 2 == 0, "even").otherwise("odd").alias("half")
    rows = table(spark, sf_dir, "orders").select(status.alias("status"), half, amount.alias("amount"))
    return rows.groupBy("status", "half").agg(money_sum("amount").alias("total"), money_avg("amount").alias("mean"))


@register()
def order_items_colocated(spark, sf_dir):
    """Line items enriched from facts stored bucketed by order: their join shuffles nothing."""
    m, job = model(spark, sf_dir), SILVER_JOBS["retail_order_items"]
    lookup, products = job["joins"]
    items = C.latest_per_key(C.filter_nulls(m.bronze("retail_order_items"), job["not_null_columns"]), job["dedup_key"])
    facts = {"items": items, "orders": prepare_side(m.bronze("retail_orders"), lookup).select(*lookup["select"])}
    stored = colocated.store(facts, lookup["on"], new_scratch_path(spark, "colocated"), colocated.buckets_of(facts["items"]))
    df = join_using(stored["items"], stored["orders"], lookup["on"], lookup["type"], lookup["select"])
    df = join_using(df, m.silver("retail_products"), products["on"], products["type"], products["select"])
    return enforce_schema(df, SILVER_SCHEMAS[job["target"]])[0]


# ----------------------------------------------------------------- reports


@register()
def regions_rollup(spark, sf_dir):
    """Exact unique customers per region from the mergeable mart, without silver."""
    return R.regions_from_state(stored_model(spark, sf_dir).customer_state())


@register()
def kpis_rollup(spark, sf_dir):
    return R.kpis_from_state(stored_model(spark, sf_dir).customer_state())


@register()
def report_regional_breakdown(spark, sf_dir):
    """Total, regions, channels, segments and regions by segment: one scan of the mart."""
    groupings = [(), ("region",), ("channel",), ("segment",), ("region", "segment")]
    return R.breakdown(stored_model(spark, sf_dir).mart("regional_sales"), groupings)


@register()
def report_category_breakdown(spark, sf_dir):
    groupings = [(), ("category",), ("channel",), ("status",), ("category", "status")]
    return R.breakdown(stored_model(spark, sf_dir).mart("category_performance"), groupings)


@register()
def report_trend(spark, sf_dir):
    return R.trend(stored_model(spark, sf_dir).mart("daily_trend"))


@register()
def report_kpis(spark, sf_dir):
    m = stored_model(spark, sf_dir)
    return R.kpis(m.mart("daily_trend"), m.mart("regional_sales"))


@register()
def kpis_exact(spark, sf_dir):
    return R.kpis_exact(stored_model(spark, sf_dir).silver("retail_orders"))


@register()
def report_top_stores(spark, sf_dir):
    return R.top_stores(stored_model(spark, sf_dir).mart("sales_by_store"))


@register()
def report_store_type_split(spark, sf_dir):
    return R.store_type_split(stored_model(spark, sf_dir).mart("sales_by_store"))


@register()
def report_top_customers(spark, sf_dir):
    return R.top_customers(stored_model(spark, sf_dir).mart("sales_by_customer"))


@register()
def report_segments(spark, sf_dir):
    return R.segments(stored_model(spark, sf_dir).mart("sales_by_customer"))


@register()
def report_avg_clv(spark, sf_dir):
    return R.avg_clv(stored_model(spark, sf_dir).mart("sales_by_customer"))


@register()
def report_top_products(spark, sf_dir):
    return R.top_products(stored_model(spark, sf_dir).mart("product_performance"))


@register()
def report_categories(spark, sf_dir):
    return R.categories(stored_model(spark, sf_dir).mart("category_performance"))


@register()
def report_regions(spark, sf_dir):
    return R.regions(stored_model(spark, sf_dir).mart("regional_sales"))


@register()
def regions_exact(spark, sf_dir):
    return R.regions_exact(stored_model(spark, sf_dir).silver("retail_orders"))


@register()
def report_channels(spark, sf_dir):
    return R.channels(stored_model(spark, sf_dir).mart("regional_sales"))


@register()
def report_region_segment_matrix(spark, sf_dir):
    return R.region_segment_matrix(stored_model(spark, sf_dir).mart("regional_sales"))


@register()
def segment_matrix_all(spark, sf_dir):
    """The matrix where the data brings a segment of its own."""
    orders = stored_model(spark, sf_dir).silver("retail_orders")
    own = F.when(F.col("order_id").cast("long") % 7 == 0, F.lit("CONSUMER")).otherwise(F.col("segment"))
    return R.region_segment_matrix(build_named_mart("gold_regional_sales", orders.withColumn("segment", own)))


@register()
def report_leaders(spark, sf_dir):
    m = stored_model(spark, sf_dir)
    return R.leaders(m.mart("sales_by_customer"), m.mart("category_performance"), m.mart("regional_sales"))


@register()
def report_revenue_share(spark, sf_dir):
    m = stored_model(spark, sf_dir)
    return R.revenue_share(m.mart("sales_by_store"), m.mart("category_performance"), m.mart("regional_sales"))



@register()
def report_store_detail(spark, sf_dir):
    return R.detail(R.top_stores(stored_model(spark, sf_dir).mart("sales_by_store")), R.STORE_DETAIL)


@register()
def report_segment_detail(spark, sf_dir):
    return R.detail(R.segments(stored_model(spark, sf_dir).mart("sales_by_customer")), R.SEGMENT_DETAIL)


@register()
def report_product_detail(spark, sf_dir):
    return R.detail(R.top_products(stored_model(spark, sf_dir).mart("product_performance")), R.PRODUCT_DETAIL)


@register()
def report_category_detail(spark, sf_dir):
    return R.detail(R.categories(stored_model(spark, sf_dir).mart("category_performance")), R.CATEGORY_DETAIL)

# --------------------------------------------------------------- operators


@register()
def filter_nulls_subset(spark, sf_dir):
    return C.filter_nulls(D.orders_with_null_customers(spark, sf_dir), ["o_custkey"])


@register()
def filter_nulls_any(spark, sf_dir):
    return C.filter_nulls(D.orders_with_defects(spark, sf_dir))


@register()
def filter_nulls_nan(spark, sf_dir):
    return C.filter_nulls(D.orders_with_nan_totals(spark, sf_dir), ["o_totalprice"])


@register()
def dedup_rows(spark, sf_dir):
    return C.drop_duplicates(D.orders_duplicated(spark, sf_dir))


@register()
def dedup_subset(spark, sf_dir):
    return C.drop_duplicates(D.orders_duplicated(spark, sf_dir), ["o_orderkey"])


@register()
def dedup_key_latest(spark, sf_dir):
    versions = D.orders_versions(spark, sf_dir, DEFAULT_RUN_DATE)
    return C.latest_per_key(versions, ["order_id"])


@register()
def cast_types(spark, sf_dir):
    parts = D.parts_as_text(spark, sf_dir).drop("p_size")
    return C.cast_types(parts, {"p_retailprice": "double", "p_large": "boolean", "p_partkey": "string"})


@register()
def cast_malformed(spark, sf_dir):
    return C.cast_types(D.parts_as_text(spark, sf_dir), {"p_size": "int"})


@register()
def standardize_lower(spark, sf_dir):
    return C.standardize_strings(D.parts_padded(spark, sf_dir), ["p_name", "p_type"], lowercase=True)


@register()
def standardize_trim(spark, sf_dir):
    return C.standardize_strings(D.parts_padded(spark, sf_dir), ["p_name", "p_type"], lowercase=False)


@register()
def ingestion_stamp(spark, sf_dir):
    return C.add_ingestion_date(table(spark, sf_dir, "orders"), "ingestion_date", DEFAULT_RUN_DATE)


# Declared schema for the text-landed parts (p_note is absent: skipped).
PARTS_SCHEMA = [
    ("p_partkey", "string", False),
    ("p_name", "string", True),
    ("p_size", "int", True),
    ("p_retailprice", "double", True),
    ("p_note", "string", True),
    ("p_large", "boolean", True),
]


@register("enforce_schema")
def enforce_schema_query(spark, sf_dir):
    df, _ = enforce_schema(D.parts_as_text(spark, sf_dir), PARTS_SCHEMA, "warn")
    return df


@register()
def null_violations(spark, sf_dir):
    return _null_violations(D.orders_with_defects(spark, sf_dir), ["o_orderkey", "o_custkey", "o_orderpriority", "o_totalprice"])


@register()
def null_policy_warn(spark, sf_dir):
    """``warn`` keeps every row, nulls in non-nullable columns included."""
    declared = [("o_orderkey", "string", False), ("o_custkey", "string", False), ("o_totalprice", "double", False)]
    df, _ = enforce_schema(D.orders_with_null_customers(spark, sf_dir), declared, "warn")
    return df


@register()
def line_total(spark, sf_dir):
    return order_items_raw(spark, sf_dir).select(
        "line_item_id", "order_id", "product_id", "quantity", "unit_price", "discount", "line_total"
    )


def _orders_for_join(spark, sf_dir):
    return D.orders_with_orphans(spark, sf_dir).select(
        F.col("o_orderkey").cast("string").alias("order_id"),
        F.col("o_custkey").cast("string").alias("customer_id"),
        F.col("o_totalprice").alias("total_amount"),
    )


def _join_query(how):
    def run(spark, sf_dir):
        customers = model(spark, sf_dir).silver("retail_customers")
        return join_using(_orders_for_join(spark, sf_dir), customers, "customer_id", how, ["segment", "region"])

    return run


JOIN_QUERIES = {
    "join_inner": "inner",
    "join_left": "left",
    "join_right": "right",
    "join_full": "full",
    "join_semi": "left_semi",
    "join_anti": "left_anti",
}
for _name, _how in JOIN_QUERIES.items():
    REGISTRY[_name] = _join_query(_how)


@register()
def latest_per_key_join(spark, sf_dir):
    """Line items against a versioned order table: the latest version only,
    so no line is duplicated by older versions."""
    m = model(spark, sf_dir)
    job = dict(SILVER_JOBS["retail_order_items"])
    job["joins"] = [
        {"source": "bronze:retail_orders", "on": "order_id", "type": "left", "latest": True,
         "select": ["order_id", "total_amount", "status"]},
    ]
    schema = [("line_item_id", "string", False), ("order_id", "string", False), ("product_id", "string", False),
              ("line_total", "double", True), ("total_amount", "double", True), ("status", "string", True)]
    sides = {"bronze:retail_orders": D.orders_versions(spark, sf_dir, DEFAULT_RUN_DATE)}
    df, _ = build_silver(job, m.bronze("retail_order_items"), sides, schema=schema)
    return df
