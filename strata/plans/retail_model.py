"""The retail medallion model: declared silver schemas, silver job specs and
gold mart specs.  Plain data; the builders live in ``silver.py``/``marts.py``.
"""

from __future__ import annotations

from datetime import date

# Default run date used by the registered queries (bronze stamps it as
# ``ingestion_date``).
DEFAULT_RUN_DATE = date(2024, 1, 31)

# --------------------------------------------------------------------------
# Declared silver schemas, (column, type, nullable) in order.
# --------------------------------------------------------------------------
SILVER_SCHEMAS: dict[str, list[tuple[str, str, bool]]] = {
    "retail_customers": [
        ("customer_id", "string", False),
        ("first_name", "string", True),
        ("last_name", "string", True),
        ("segment", "string", True),
        ("region", "string", True),
        ("city", "string", True),
        ("state", "string", True),
        ("country", "string", True),
        ("zip_code", "string", True),
        ("created_at", "date", True),
        ("ingestion_date", "date", True),
    ],
    "retail_stores": [
        ("store_id", "string", False),
        ("store_name", "string", True),
        ("city", "string", True),
        ("state", "string", True),
        ("country", "string", True),
        ("zip_code", "string", True),
        ("store_type", "string", True),
        ("ingestion_date", "date", True),
    ],
    "retail_products": [
        ("product_id", "string", False),
        ("product_name", "string", True),
        ("category", "string", True),
        ("unit_price", "double", True),
        ("ingestion_date", "date", True),
    ],
    "retail_orders_enriched": [
        ("order_id", "string", False),
        ("customer_id", "string", False),
        ("store_id", "string", True),
        ("order_date", "date", True),
        ("status", "string", True),
        ("channel", "string", True),
        ("total_amount", "double", True),
        ("segment", "string", True),
        ("region", "string", True),
        ("store_name", "string", True),
        ("store_type", "string", True),
        ("ingestion_date", "date", True),
    ],
    "retail_order_items_enriched": [
        ("line_item_id", "string", False),
        ("order_id", "string", False),
        ("product_id", "string", False),
        ("quantity", "long", True),
        ("unit_price", "double", True),
        ("discount", "double", True),
        ("line_total", "double", True),
        ("created_at", "date", True),
        ("order_date", "date", True),
        ("store_id", "string", True),
        ("customer_id", "string", True),
        ("status", "string", True),
        ("channel", "string", True),
        ("product_name", "string", True),
        ("category", "string", True),
        ("ingestion_date", "date", True),
    ],
}

# --------------------------------------------------------------------------
# Silver jobs.  Source is the bronze table of the same name;
# joins name another layer's table as "<layer>:<dataset>".
# --------------------------------------------------------------------------
SILVER_JOBS: dict[str, dict] = {
    "retail_customers": {
        "target": "retail_customers",
        "primary_key": "customer_id",
        "not_null_columns": ["customer_id"],
        "dedup_key": ["customer_id"],
        "on_null_violation": "warn",
        "transformations": [
            {"name": "standardize_strings", "params": {"columns": ["segment", "region", "country"], "lowercase": False}},
            {"name": "cast_types", "params": {"columns": {"zip_code": "string"}}},
        ],
        "joins": [],
    },
    "retail_stores": {
        "target": "retail_stores",
        "primary_key": "store_id",
        "not_null_columns": ["store_id"],
        "dedup_key": ["store_id"],
        "on_null_violation": "warn",
        "transformations": [
            {"name": "standardize_strings", "params": {"columns": ["store_type", "country"], "lowercase": False}},
            {"name": "cast_types", "params": {"columns": {"zip_code": "string"}}},
        ],
        "joins": [],
    },
    "retail_products": {
        "target": "retail_products",
        "primary_key": "product_id",
        "not_null_columns": ["product_id"],
        "dedup_key": ["product_id"],
        "on_null_violation": "warn",
        "transformations": [
            {"name": "standardize_strings", "params": {"columns": ["category"], "lowercase": False}},
        ],
        "joins": [],
    },
    "retail_orders": {
        "target": "retail_orders_enriched",
        "primary_key": "order_id",
        "not_null_columns": ["order_id", "customer_id"],
        "dedup_key": ["order_id"],
        "on_null_violation": "warn",
        "transformations": [],
        "joins": [
            {"source": "silver:retail_customers", "on": "customer_id", "type": "left",
             "select": ["customer_id", "segment", "region"]},
            {"source": "silver:retail_stores", "on": "store_id", "type": "left",
             "select": ["store_id", "store_name", "store_type"]},
        ],
    },
    "retail_order_items": {
        "target": "retail_order_items_enriched",
        "primary_key": "line_item_id",
        "not_null_columns": ["line_item_id", "order_id", "product_id"],
        "dedup_key": ["line_item_id"],
        "on_null_violation": "warn",
        "transformations": [],
        "joins": [
            # Bronze orders may hold several versions of an order: the latest
            # one per key is taken before joining (no fan-out).
            {"source": "bronze:retail_orders", "on": "order_id", "type": "left", "latest": True,
             "select": ["order_id", "order_date", "store_id", "customer_id", "status", "channel"]},
            {"source": "silver:retail_products", "on": "product_id", "type": "left",
             "select": ["product_id", "product_name", "category"]},
        ],
    },
}

# The jobs in their order (a job's joins only name earlier datasets).
SILVER_ORDER = ["retail_customers", "retail_stores", "retail_products", "retail_orders", "retail_order_items"]

# --------------------------------------------------------------------------
# Gold marts.  Metric functions: sum_money / avg_money (exact
# decimal arithmetic on 2-decimal amounts), sum_long, count, count_distinct.
# --------------------------------------------------------------------------
GOLD_MARTS: dict[str, dict] = {
    "gold_sales_by_store": {
        "source": "retail_orders_enriched",
        "group_by": ["store_id", "store_name", "store_type", "order_date"],
        "metrics": [
            ("total_revenue", "sum_money", "total_amount"),
            ("order_count", "count", "order_id"),
            ("avg_order_value", "avg_money", "total_amount"),
        ],
    },
    "gold_sales_by_customer": {
        "source": "retail_orders_enriched",
        "group_by": ["customer_id", "segment", "region"],
        "metrics": [
            ("total_spend", "sum_money", "total_amount"),
            ("order_count", "count", "order_id"),
            ("avg_order_value", "avg_money", "total_amount"),
        ],
    },
    "gold_daily_trend": {
        "source": "retail_orders_enriched",
        "group_by": ["order_date"],
        "metrics": [
            ("total_revenue", "sum_money", "total_amount"),
            ("order_count", "count", "order_id"),
            ("avg_order_value", "avg_money", "total_amount"),
        ],
    },
    "gold_regional_sales": {
        "source": "retail_orders_enriched",
        "group_by": ["region", "segment", "channel"],
        "metrics": [
            ("total_revenue", "sum_money", "total_amount"),
            ("order_count", "count", "order_id"),
            ("avg_order_value", "avg_money", "total_amount"),
            ("unique_customers", "count_distinct", "customer_id"),
        ],
    },
    "gold_product_performance": {
        "source": "retail_order_items_enriched",
        "group_by": ["product_id"],
        "metrics": [
            ("total_quantity", "sum_long", "quantity"),
            ("total_revenue", "sum_money", "line_total"),
            ("order_count", "count_distinct", "order_id"),
        ],
    },
    "gold_category_performance": {
        "source": "retail_order_items_enriched",
        "group_by": ["category", "channel", "status"],
        "metrics": [
            ("total_revenue", "sum_money", "line_total"),
            ("total_quantity", "sum_long", "quantity"),
            ("order_count", "count_distinct", "order_id"),
            ("avg_discount", "avg_money", "discount"),
            ("avg_unit_price", "avg_money", "unit_price"),
        ],
    },
}
