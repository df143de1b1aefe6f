"""Raw retail datasets derived from the driver's TPC-H-style tables.

The retail model (customers, stores, products, orders, order line items) is
expressed over ``customer``, ``supplier``, ``part``, ``orders`` and
``lineitem``:

* customers  <- customer (+ nation, region for country / region)
* stores     <- supplier (+ nation); store type alternates by key parity
* products   <- part
* orders     <- orders; the store of an order is its smallest line supplier
* line items <- lineitem (+ part for the list price); ``line_item_id`` is
  ``orderkey-linenumber``, which is *not* unique, so dedup has work to do.

Every function returns a lazy DataFrame; nothing is collected.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.money import line_amount

TABLES = (
    "region nation customer supplier part orders lineitem events "
    "documents embeddings pages benchmark labels conversations"
).split()


# Scan handles of the (read-only) driver tables, per application: a
# DataFrame is an immutable plan, so reusing it only saves the driver-side
# listing and footer read of each repeated ``spark.read``.
_SCANS: dict[tuple[str, int, str], DataFrame] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    # The memo holds each session (through its frames), so id() stays unique.
    key = (spark.sparkContext.applicationId, id(spark), path)
    if key not in _SCANS:
        _SCANS[key] = spark.read.parquet(path)
    return _SCANS[key]


def _str(c: str):
    return F.col(c).cast("string")


def customers_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    r = table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    return (
        c.join(n, c.c_nationkey == n.n_nationkey, "left")
        .join(r, F.col("n_regionkey") == r.r_regionkey, "left")
        .select(
            _str("c_custkey").alias("customer_id"),
            F.split_part("c_name", F.lit("#"), F.lit(1)).alias("first_name"),
            F.split_part("c_name", F.lit("#"), F.lit(2)).alias("last_name"),
            F.col("c_mktsegment").alias("segment"),
            F.col("r_name").alias("region"),
            F.col("n_name").alias("country"),
            F.col("c_nationkey").alias("zip_code"),
        )
    )


def stores_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "supplier")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    return s.join(n, s.s_nationkey == n.n_nationkey, "left").select(
        _str("s_suppkey").alias("store_id"),
        F.col("s_name").alias("store_name"),
        F.col("n_name").alias("country"),
        F.col("s_nationkey").alias("zip_code"),
        F.when(F.col("s_suppkey") % 2 == 0, F.lit("Online")).otherwise(F.lit("Offline")).alias("store_type"),
    )


def products_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        _str("p_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("category"),
        F.col("p_retailprice").alias("unit_price"),
    )


def orders_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with ``store_id`` = smallest supplier among its lines.

    The per-order minimum is a partial (map-side) aggregate, so only one row
    per order and map task crosses the shuffle; orders without lines keep a
    null store (left join).
    """
    o = table(spark, sf_dir, "orders")
    first_supplier = (
        table(spark, sf_dir, "lineitem")
        .groupBy("l_orderkey")
        .agg(F.min("l_suppkey").alias("l_suppkey"))
    )
    return o.join(first_supplier, o.o_orderkey == first_supplier.l_orderkey, "left").select(
        _str("o_orderkey").alias("order_id"),
        _str("o_custkey").alias("customer_id"),
        _str("l_suppkey").alias("store_id"),
        F.col("o_orderdate").cast("date").alias("order_date"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_orderpriority").alias("channel"),
        F.col("o_totalprice").alias("total_amount"),
    )


def order_items_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    p = table(spark, sf_dir, "part").select("p_partkey", "p_retailprice")
    return li.join(p, li.l_partkey == p.p_partkey, "left").select(
        F.concat_ws("-", _str("l_orderkey"), _str("l_linenumber")).alias("line_item_id"),
        _str("l_orderkey").alias("order_id"),
        _str("l_partkey").alias("product_id"),
        F.col("l_quantity").cast("long").alias("quantity"),
        F.col("p_retailprice").alias("unit_price"),
        F.col("l_discount").alias("discount"),
        line_amount("l_quantity", "p_retailprice", "l_discount").alias("line_total"),
        F.col("l_shipdate").cast("date").alias("created_at"),
    )


def events_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event stream rows with the day they landed (``cast(ts as date)``)."""
    return table(spark, sf_dir, "events").withColumn("event_date", F.col("ts").cast("date"))


RAW_DATASETS = {
    "retail_customers": customers_raw,
    "retail_stores": stores_raw,
    "retail_products": products_raw,
    "retail_orders": orders_raw,
    "retail_order_items": order_items_raw,
}


def raw_dataset(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return RAW_DATASETS[name](spark, sf_dir)
