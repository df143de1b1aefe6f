"""DuckDB oracle SQL for the registered queries.

The retail model built by ``strata.sources.retail`` and ``strata.plans`` is
re-stated here independently as SQL CTEs over the driver's tables, so the
driver can compare each Spark result with a plain SQL answer.
"""

from __future__ import annotations

RUN_DATE_SQL = "DATE '2024-01-31'"


def _dedup(source: str, key: str, order: str, where: str = "TRUE") -> str:
    return (
        f"SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER "
        f"(PARTITION BY {key} ORDER BY {order}) AS rn FROM {source} WHERE {where}) WHERE rn = 1"
    )


def _nf(cols: str) -> str:
    return ", ".join(f"{c.strip()} ASC NULLS FIRST" for c in cols.split(","))


MODEL_CTES = {
    "customers_raw": """
        SELECT cast(c.c_custkey AS VARCHAR) AS customer_id,
               split_part(c.c_name, '#', 1) AS first_name,
               split_part(c.c_name, '#', 2) AS last_name,
               c.c_mktsegment AS segment, r.r_name AS region, n.n_name AS country,
               c.c_nationkey AS zip_code
        FROM customer c
        LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
        LEFT JOIN region r ON n.n_regionkey = r.r_regionkey""",
    "stores_raw": """
        SELECT cast(s.s_suppkey AS VARCHAR) AS store_id, s.s_name AS store_name,
               n.n_name AS country, s.s_nationkey AS zip_code,
               CASE WHEN s.s_suppkey % 2 = 0 THEN 'Online' ELSE 'Offline' END AS store_type
        FROM supplier s LEFT JOIN nation n ON s.s_nationkey = n.n_nationkey""",
    "products_raw": """
        SELECT cast(p_partkey AS VARCHAR) AS product_id, p_name AS product_name,
               p_type AS category, p_retailprice AS unit_price
        FROM part""",
    "orders_raw": """
        SELECT cast(o.o_orderkey AS VARCHAR) AS order_id, cast(o.o_custkey AS VARCHAR) AS customer_id,
               cast(f.l_suppkey AS VARCHAR) AS store_id, cast(o.o_orderdate AS DATE) AS order_date,
               o.o_orderstatus AS status, o.o_orderpriority AS channel, o.o_totalprice AS total_amount
        FROM orders o
        LEFT JOIN (SELECT l_orderkey, min(l_suppkey) AS l_suppkey FROM lineitem GROUP BY l_orderkey) f
               ON o.o_orderkey = f.l_orderkey""",
    "items_raw": """
        SELECT concat_ws('-', cast(l.l_orderkey AS VARCHAR), cast(l.l_linenumber AS VARCHAR)) AS line_item_id,
               cast(l.l_orderkey AS VARCHAR) AS order_id, cast(l.l_partkey AS VARCHAR) AS product_id,
               cast(l.l_quantity AS BIGINT) AS quantity, p.p_retailprice AS unit_price,
               l.l_discount AS discount,
               cast(round(cast(l.l_quantity AS DECIMAL(12,2)) * cast(p.p_retailprice AS DECIMAL(12,2))
                          * (1 - cast(l.l_discount AS DECIMAL(4,2))), 2) AS DOUBLE) AS line_total,
               cast(l.l_shipdate AS DATE) AS created_at
        FROM lineitem l LEFT JOIN part p ON l.l_partkey = p.p_partkey""",
    "customers_bronze": f"SELECT *, {RUN_DATE_SQL} AS ingestion_date FROM customers_raw",
    "stores_bronze": f"SELECT *, {RUN_DATE_SQL} AS ingestion_date FROM stores_raw",
    "products_bronze": f"SELECT *, {RUN_DATE_SQL} AS ingestion_date FROM products_raw",
    "orders_bronze": f"SELECT *, {RUN_DATE_SQL} AS ingestion_date FROM orders_raw",
    "items_bronze": f"SELECT *, {RUN_DATE_SQL} AS ingestion_date FROM items_raw",
    "customers_silver": """
        SELECT customer_id, first_name, last_name, trim(segment, ' ') AS segment,
               trim(region, ' ') AS region, trim(country, ' ') AS country,
               cast(zip_code AS VARCHAR) AS zip_code, ingestion_date
        FROM ({d})""".format(d=_dedup(
        "customers_bronze", "customer_id",
        "ingestion_date DESC NULLS LAST, " + _nf("first_name, last_name, segment, region, country, zip_code"),
        "customer_id IS NOT NULL")),
    "stores_silver": """
        SELECT store_id, store_name, trim(country, ' ') AS country, cast(zip_code AS VARCHAR) AS zip_code,
               trim(store_type, ' ') AS store_type, ingestion_date
        FROM ({d})""".format(d=_dedup(
        "stores_bronze", "store_id",
        "ingestion_date DESC NULLS LAST, " + _nf("store_name, country, zip_code, store_type"),
        "store_id IS NOT NULL")),
    "products_silver": """
        SELECT product_id, product_name, trim(category, ' ') AS category, unit_price, ingestion_date
        FROM ({d})""".format(d=_dedup(
        "products_bronze", "product_id",
        "ingestion_date DESC NULLS LAST, " + _nf("product_name, category, unit_price"),
        "product_id IS NOT NULL")),
    "orders_clean": _dedup(
        "orders_bronze", "order_id",
        "ingestion_date DESC NULLS LAST, " + _nf("customer_id, store_id, order_date, status, channel, total_amount"),
        "order_id IS NOT NULL AND customer_id IS NOT NULL"),
    "orders_enriched": """
        SELECT o.order_id, o.customer_id, o.store_id, o.order_date, o.status, o.channel, o.total_amount,
               c.segment, c.region, s.store_name, s.store_type, o.ingestion_date
        FROM orders_clean o
        LEFT JOIN customers_silver c ON o.customer_id = c.customer_id
        LEFT JOIN stores_silver s ON o.store_id = s.store_id""",
    "orders_latest": _dedup(
        "(SELECT order_id, order_date, store_id, customer_id, status, channel, ingestion_date FROM orders_bronze)",
        "order_id",
        "ingestion_date DESC NULLS LAST, " + _nf("order_date, store_id, customer_id, status, channel")),
    "items_clean": _dedup(
        "items_bronze", "line_item_id",
        "ingestion_date DESC NULLS LAST, "
        + _nf("order_id, product_id, quantity, unit_price, discount, line_total, created_at"),
        "line_item_id IS NOT NULL AND order_id IS NOT NULL AND product_id IS NOT NULL"),
    "items_enriched": """
        SELECT i.line_item_id, i.order_id, i.product_id, i.quantity, i.unit_price, i.discount,
               i.line_total, i.created_at, o.order_date, o.store_id, o.customer_id, o.status,
               o.channel, p.product_name, p.category, i.ingestion_date
        FROM items_clean i
        LEFT JOIN orders_latest o ON i.order_id = o.order_id
        LEFT JOIN products_silver p ON i.product_id = p.product_id""",
}


# Six decimals: DuckDB scales doubles in floating point, which is exact up to 2**53.
def money_sum(c: str) -> str:
    return f"cast(sum(cast({c} AS DECIMAL(28,6))) AS DOUBLE)"


def money_avg(c: str) -> str:
    return f"cast(sum(cast({c} AS DECIMAL(28,6))) AS DOUBLE) / nullif(count({c}), 0)"


def mean(c: str) -> str:
    """Mean of averages, which have endless decimals: added up to eight of them."""
    return f"cast(sum(cast({c} AS DECIMAL(28,8))) AS DOUBLE) / nullif(count({c}), 0)"


MARTS = {
    "gold_sales_by_store": f"""
        SELECT store_id, store_name, store_type, order_date,
               {money_sum('total_amount')} AS total_revenue, count(order_id) AS order_count,
               {money_avg('total_amount')} AS avg_order_value
        FROM orders_enriched GROUP BY store_id, store_name, store_type, order_date""",
    "gold_sales_by_customer": f"""
        SELECT customer_id, segment, region,
               {money_sum('total_amount')} AS total_spend, count(order_id) AS order_count,
               {money_avg('total_amount')} AS avg_order_value
        FROM orders_enriched GROUP BY customer_id, segment, region""",
    "gold_daily_trend": f"""
        SELECT order_date, {money_sum('total_amount')} AS total_revenue, count(order_id) AS order_count,
               {money_avg('total_amount')} AS avg_order_value
        FROM orders_enriched GROUP BY order_date""",
    "gold_regional_sales": f"""
        SELECT region, segment, channel,
               {money_sum('total_amount')} AS total_revenue, count(order_id) AS order_count,
               {money_avg('total_amount')} AS avg_order_value,
               count(DISTINCT customer_id) AS unique_customers
        FROM orders_enriched GROUP BY region, segment, channel""",
    "gold_product_performance": f"""
        SELECT product_id, cast(sum(quantity) AS BIGINT) AS total_quantity,
               {money_sum('line_total')} AS total_revenue, count(DISTINCT order_id) AS order_count
        FROM items_enriched GROUP BY product_id""",
    "gold_category_performance": f"""
        SELECT category, channel, status,
               {money_sum('line_total')} AS total_revenue, cast(sum(quantity) AS BIGINT) AS total_quantity,
               count(DISTINCT order_id) AS order_count,
               {money_avg('discount')} AS avg_discount, {money_avg('unit_price')} AS avg_unit_price
        FROM items_enriched GROUP BY category, channel, status""",
}


def with_model(body: str, extra: dict[str, str] | None = None) -> str:
    """``WITH <model CTEs>, <marts>, <extra> <body>``."""
    ctes = dict(MODEL_CTES)
    ctes.update(MARTS)
    ctes.update(extra or {})
    parts = ",\n".join(f"{name} AS ({sql})" for name, sql in ctes.items())
    return f"WITH {parts}\n{body}"


def _ms(c: str) -> str:
    return money_sum(c)


TOP_STORES = f"""
    SELECT store_id, store_name, store_type, {money_sum('total_revenue')} AS total_revenue,
           cast(sum(order_count) AS BIGINT) AS order_count, {mean('avg_order_value')} AS avg_order_value
    FROM gold_sales_by_store GROUP BY store_id, store_name, store_type
    ORDER BY total_revenue DESC NULLS FIRST, store_id ASC NULLS FIRST LIMIT 15"""
SEGMENTS_SQL = f"""
    SELECT segment, count(*) AS customers, {money_sum('total_spend')} AS total_revenue,
           {money_avg('total_spend')} AS avg_clv
    FROM gold_sales_by_customer GROUP BY segment"""
CATEGORIES_SQL = f"""
    SELECT category, {money_sum('total_revenue')} AS total_revenue,
           cast(sum(total_quantity) AS BIGINT) AS total_quantity,
           cast(sum(order_count) AS BIGINT) AS order_count, {mean('avg_discount')} AS avg_discount
    FROM gold_category_performance WHERE category IS NOT NULL GROUP BY category"""
REGIONS_SQL = f"""
    SELECT region, {money_sum('total_revenue')} AS total_revenue,
           cast(sum(order_count) AS BIGINT) AS order_count,
           cast(sum(unique_customers) AS BIGINT) AS unique_customers
    FROM gold_regional_sales WHERE region IS NOT NULL GROUP BY region"""
CHANNELS_SQL = f"""
    SELECT channel, {money_sum('total_revenue')} AS total_revenue, cast(sum(order_count) AS BIGINT) AS order_count
    FROM gold_regional_sales WHERE channel IS NOT NULL GROUP BY channel"""
STORE_TYPE_SQL = f"""
    SELECT store_type, {money_sum('total_revenue')} AS total_revenue FROM top_stores GROUP BY store_type"""
REPORT_CTES = {
    "top_stores": TOP_STORES, "seg": SEGMENTS_SQL, "cats": CATEGORIES_SQL, "regs": REGIONS_SQL,
    "chans": CHANNELS_SQL, "store_types": STORE_TYPE_SQL,
}
SEGMENT_VALUES = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


def _leader(dim: str, table: str, name: str) -> str:
    return (f"SELECT '{dim}' AS dimension, count(*) AS n_values, "
            f"first({name} ORDER BY total_revenue DESC, {name} DESC) AS top_name, "
            f"max(total_revenue) AS top_revenue FROM {table}")


def _share(dim: str, table: str, name: str) -> str:
    return f"SELECT '{dim}' AS dimension, {name} AS name, total_revenue FROM {table}"


def with_reports(body: str) -> str:
    return with_model(body, REPORT_CTES)


LATER_INGESTION_SQL = "DATE '2024-02-01'"
DEFECT_CTES = {
    "orders_nullcust": """SELECT o_orderkey, CASE WHEN o_orderkey % 17 = 0 THEN NULL ELSE o_custkey END AS o_custkey,
        o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders""",
    "orders_nan": """SELECT o_orderkey, o_custkey, o_orderstatus,
        CASE WHEN o_orderkey % 13 = 0 THEN cast('NaN' AS DOUBLE) ELSE o_totalprice END AS o_totalprice,
        o_orderdate, o_orderpriority FROM orders""",
    "orders_defects": """SELECT o_orderkey, CASE WHEN o_orderkey % 17 = 0 THEN NULL ELSE o_custkey END AS o_custkey,
        o_orderstatus, CASE WHEN o_orderkey % 13 = 0 THEN cast('NaN' AS DOUBLE) ELSE o_totalprice END AS o_totalprice,
        o_orderdate, CASE WHEN o_orderkey % 19 = 0 THEN NULL ELSE o_orderpriority END AS o_orderpriority FROM orders""",
    "parts_text": """SELECT p_partkey, p_name,
        CASE WHEN p_partkey % 11 = 0 THEN 'abc' ELSE cast(p_size AS VARCHAR) END AS p_size,
        cast(p_retailprice AS VARCHAR) AS p_retailprice,
        CASE WHEN p_size > 25 THEN 'true' ELSE 'false' END AS p_large FROM part""",
    "parts_padded": """SELECT p_partkey, concat('  ', upper(p_name), ' ') AS p_name, concat(' ', p_type) AS p_type, p_brand
        FROM part""",
    "orders_dup": "SELECT * FROM orders UNION ALL SELECT * FROM orders WHERE o_orderkey % 10 = 0",
    "orders_versions": f"""SELECT * FROM orders_bronze UNION ALL
        SELECT order_id, customer_id, store_id, order_date, status, channel, total_amount * 2 AS total_amount,
               {LATER_INGESTION_SQL} AS ingestion_date
        FROM orders_bronze WHERE cast(order_id AS BIGINT) % 10 = 0""",
    "join_orders": """SELECT cast(o_orderkey AS VARCHAR) AS order_id,
        cast(CASE WHEN o_orderkey % 19 = 0 THEN -1 ELSE o_custkey END AS VARCHAR) AS customer_id,
        o_totalprice AS total_amount FROM orders""",
}

LATEST_VERSIONS = _dedup("orders_versions", "order_id", "ingestion_date DESC NULLS LAST")

# Two-day run: day 2 lands later versions of the orders with key % 10 = 0.
RUN_CTES = dict(DEFECT_CTES)
RUN_CTES["orders_enriched_v2"] = f"""
    SELECT o.order_id, o.customer_id, o.store_id, o.order_date, o.status, o.channel, o.total_amount,
           c.segment, c.region, s.store_name, s.store_type, o.ingestion_date
    FROM ({LATEST_VERSIONS}) o
    LEFT JOIN customers_silver c ON o.customer_id = c.customer_id
    LEFT JOIN stores_silver s ON o.store_id = s.store_id"""
for _m in ("gold_regional_sales", "gold_daily_trend", "gold_sales_by_store", "gold_sales_by_customer"):
    RUN_CTES[_m + "_v2"] = MARTS[_m].replace("FROM orders_enriched", "FROM orders_enriched_v2")


def _ledger_row(name: str, layer: str, rows: str, status: str = "success") -> str:
    return (f"SELECT '{name}' AS dataset_name, '{layer}' AS layer, {LATER_INGESTION_SQL} AS last_processed_date, "
            f"cast(({rows}) AS BIGINT) AS rows_processed, '{status}' AS status")


LEDGER_SQL = " UNION ALL ".join([
    _ledger_row("bronze_retail_customers", "bronze", "SELECT count(*) FROM customer"),
    _ledger_row("bronze_retail_products", "bronze", "SELECT count(*) FROM part"),
    _ledger_row("bronze_retail_stores", "bronze", "SELECT count(*) FROM supplier"),
    _ledger_row("bronze_retail_orders", "bronze", "SELECT count(*) FROM orders WHERE o_orderkey % 10 = 0"),
    _ledger_row("bronze_retail_order_items", "bronze", "0", "skipped"),
    _ledger_row("silver_retail_customers", "silver", "SELECT count(*) FROM customer"),
    _ledger_row("silver_retail_products", "silver", "SELECT count(*) FROM part"),
    _ledger_row("silver_retail_stores", "silver", "SELECT count(*) FROM supplier"),
    _ledger_row("silver_retail_orders", "silver", "SELECT count(*) FROM orders WHERE o_orderkey % 10 = 0"),
    _ledger_row("silver_retail_order_items", "silver", "0"),
    _ledger_row("gold_category_performance", "gold", "SELECT count(*) FROM gold_category_performance"),
    _ledger_row("gold_daily_trend", "gold", "SELECT count(*) FROM gold_daily_trend_v2"),
    _ledger_row("gold_product_performance", "gold", "SELECT count(*) FROM gold_product_performance"),
    _ledger_row("gold_regional_sales", "gold", "SELECT count(*) FROM gold_regional_sales_v2"),
    _ledger_row("gold_sales_by_customer", "gold", "SELECT count(*) FROM gold_sales_by_customer_v2"),
    _ledger_row("gold_sales_by_store", "gold", "SELECT count(*) FROM gold_sales_by_store_v2"),
])


KPIS_EXACT = f"""
        SELECT {money_sum('total_amount')} AS total_revenue, count(order_id) AS total_orders,
               {money_avg('total_amount')} AS avg_order_value, count(DISTINCT customer_id) AS unique_customers
        FROM orders_enriched"""
REGIONS_EXACT = f"""
        SELECT region, {money_sum('total_amount')} AS total_revenue, count(order_id) AS order_count,
               count(DISTINCT customer_id) AS unique_customers
        FROM orders_enriched WHERE region IS NOT NULL GROUP BY region"""


def _named_versions(stays: str) -> str:
    """The newest version of each order among those that stay after the lookup of names."""
    return f"""
        SELECT * EXCLUDE (rn, found) FROM (
          SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY ingestion_date DESC) AS rn FROM (
            SELECT v.* EXCLUDE (customer) REPLACE (v.customer AS customer_id), n.name, n.customer_id IS NOT NULL AS found
            FROM (SELECT *, CASE WHEN ingestion_date = {LATER_INGESTION_SQL} AND cast(order_id AS BIGINT) % 20 = 0 THEN '-1'
                  ELSE customer_id END AS customer FROM orders_versions) v
            LEFT JOIN (SELECT cast(c_custkey AS VARCHAR) AS customer_id, CASE WHEN c_custkey % 5 <> 0 THEN c_name END AS name
                       FROM customer) n ON v.customer = n.customer_id
          ) WHERE {stays}
        ) WHERE rn = 1"""


def _breakdown(mart: str, names: list[str], groupings: list[list[str]]) -> str:
    """One SELECT per grouping; shares and leaders within each."""
    parts = []
    for g in groupings:
        columns = ", ".join(c if c in g else f"cast(NULL AS VARCHAR) AS {c}" for c in names)
        parts.append(f"""SELECT '{','.join(g)}' AS grouping, {columns}, {money_sum('total_revenue')} AS total_revenue,
            cast(sum(order_count) AS BIGINT) AS order_count FROM {mart}""" + (f" GROUP BY {', '.join(g)}" if g else ""))
    order = "total_revenue DESC NULLS LAST, " + ", ".join(f"{c} ASC NULLS FIRST" for c in names)
    return f"""SELECT *, total_revenue / cast(sum(cast(total_revenue AS DECIMAL(28,6))) OVER (PARTITION BY grouping) AS DOUBLE) AS share,
        row_number() OVER (PARTITION BY grouping ORDER BY {order}) = 1 AS leads FROM ({' UNION ALL '.join(parts)})"""


ORACLES: dict[str, str] = {
    # silver
    "silver_customers": with_model("SELECT * FROM customers_silver"),
    "silver_stores": with_model("SELECT * FROM stores_silver"),
    "silver_products": with_model("SELECT * FROM products_silver"),
    "orders_enriched": with_model("SELECT * FROM orders_enriched"),
    "order_items_enriched": with_model("SELECT * FROM items_enriched"),
    # gold
    "regional_sales": with_model("SELECT * FROM gold_regional_sales"),
    "sales_by_store": with_model("SELECT * FROM gold_sales_by_store"),
    "sales_by_customer": with_model("SELECT * FROM gold_sales_by_customer"),
    "daily_trend": with_model("SELECT * FROM gold_daily_trend"),
    "product_performance": with_model("SELECT * FROM gold_product_performance"),
    "category_performance": with_model("SELECT * FROM gold_category_performance"),
    # reports
    "report_trend": with_model("SELECT order_date, total_revenue, order_count, avg_order_value FROM gold_daily_trend"),
    "report_kpis": with_model(f"""
        SELECT (SELECT {money_sum('total_revenue')} FROM gold_daily_trend) AS total_revenue,
               (SELECT cast(sum(order_count) AS BIGINT) FROM gold_daily_trend) AS total_orders,
               (SELECT {mean('avg_order_value')} FROM gold_daily_trend) AS avg_order_value,
               (SELECT cast(sum(unique_customers) AS BIGINT) FROM gold_regional_sales) AS unique_customers"""),
    "kpis_exact": with_model(KPIS_EXACT),
    "kpis_rollup": with_model(KPIS_EXACT),
    "regions_rollup": with_model(REGIONS_EXACT),
    "report_top_stores": with_reports("SELECT * FROM top_stores"),
    "report_store_type_split": with_reports("SELECT * FROM store_types"),
    "report_top_customers": with_model("""
        SELECT customer_id, segment, region, total_spend, order_count, avg_order_value
        FROM gold_sales_by_customer ORDER BY total_spend DESC NULLS FIRST, customer_id ASC NULLS FIRST LIMIT 15"""),
    "report_segments": with_reports("SELECT * FROM seg"),
    "report_avg_clv": with_model(f"SELECT {money_avg('total_spend')} AS avg_clv FROM gold_sales_by_customer"),
    "report_top_products": with_model("""
        SELECT product_id, total_quantity, total_revenue, order_count FROM gold_product_performance
        ORDER BY total_revenue DESC NULLS FIRST, product_id ASC NULLS FIRST LIMIT 15"""),
    "report_categories": with_reports("SELECT * FROM cats"),
    "report_regions": with_reports("SELECT * FROM regs"),
    "regions_exact": with_model(REGIONS_EXACT),
    "report_channels": with_reports("SELECT * FROM chans"),
    "report_regional_breakdown": with_model(_breakdown(
        "gold_regional_sales", ["region", "channel", "segment"], [[], ["region"], ["channel"], ["segment"], ["region", "segment"]])),
    "report_category_breakdown": with_model(_breakdown(
        "gold_category_performance", ["category", "channel", "status"], [[], ["category"], ["channel"], ["status"], ["category", "status"]])),
    "money_extremes": """
        SELECT status, half, CASE status WHEN 'F' THEN count(*) * pow(2::DOUBLE, 70) WHEN 'O' THEN CASE WHEN bool_or(odd) THEN 'inf'::DOUBLE ELSE exact END
                 WHEN 'P' THEN CASE WHEN bool_or(odd) THEN 'nan'::DOUBLE ELSE exact END END AS total,
               CASE status WHEN 'F' THEN pow(2::DOUBLE, 70) WHEN 'O' THEN CASE WHEN bool_or(odd) THEN 'inf'::DOUBLE ELSE exact / count(*) END
                 WHEN 'P' THEN CASE WHEN bool_or(odd) THEN 'nan'::DOUBLE ELSE exact / count(*) END END AS mean
        FROM (
          SELECT *, cast(sum(cast(price AS DECIMAL(28,6))) OVER (PARTITION BY status, half) AS DOUBLE) AS exact FROM (
            SELECT o_orderstatus AS status, CASE WHEN o_orderkey % 2 = 0 THEN 'even' ELSE 'odd' END AS half, o_totalprice AS price,
                   CASE o_orderstatus WHEN 'O' THEN o_orderkey % 100 = 1 WHEN 'P' THEN o_orderkey % 50 = 1 ELSE FALSE END AS odd
            FROM orders))
        GROUP BY status, half, exact""",
    "order_items_colocated": with_model("SELECT * FROM items_enriched"),
    "report_region_segment_matrix": with_model(
        "SELECT region, "
        + ", ".join(
            f"coalesce(cast(sum(cast(total_revenue AS DECIMAL(28,6))) FILTER (WHERE segment = '{v}') AS DOUBLE), 0) AS \"{v}\""
            for v in SEGMENT_VALUES)
        + " FROM gold_regional_sales WHERE region IS NOT NULL GROUP BY region"),
    "report_leaders": with_reports(
        _leader("segment", "seg", "segment") + " UNION ALL " + _leader("category", "cats", "category")
        + " UNION ALL " + _leader("region", "regs", "region")),
    "report_revenue_share": with_reports(
        "SELECT *, total_revenue / cast(sum(cast(total_revenue AS DECIMAL(28,6))) OVER (PARTITION BY dimension) AS DOUBLE) AS share FROM ("
        + _share("category", "cats", "category") + " UNION ALL " + _share("store_type", "store_types", "store_type")
        + " UNION ALL " + _share("channel", "chans", "channel") + ")"),
    # operators over defect-injected inputs
    **{k: with_model(v, DEFECT_CTES) for k, v in {
        "filter_nulls_subset": "SELECT * FROM orders_nullcust WHERE o_custkey IS NOT NULL",
        "filter_nulls_any": """SELECT * FROM orders_defects WHERE o_orderkey IS NOT NULL AND o_custkey IS NOT NULL
            AND o_orderstatus IS NOT NULL AND o_totalprice IS NOT NULL AND NOT isnan(o_totalprice)
            AND o_orderdate IS NOT NULL AND o_orderpriority IS NOT NULL""",
        "filter_nulls_nan": "SELECT * FROM orders_nan WHERE o_totalprice IS NOT NULL AND NOT isnan(o_totalprice)",
        "dedup_rows": "SELECT DISTINCT * FROM orders_dup",
        "dedup_subset": _dedup("orders_dup", "o_orderkey",
                               _nf("o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority")),
        "dedup_key_latest": _dedup("orders_versions", "order_id", "ingestion_date DESC NULLS LAST, "
                                   + _nf("customer_id, store_id, order_date, status, channel, total_amount")),
        "cast_types": """SELECT cast(p_partkey AS VARCHAR) AS p_partkey, p_name, TRY_CAST(p_retailprice AS DOUBLE) AS p_retailprice,
            TRY_CAST(p_large AS BOOLEAN) AS p_large FROM parts_text""",
        "cast_malformed": """SELECT p_partkey, p_name, TRY_CAST(p_size AS INTEGER) AS p_size, p_retailprice, p_large
            FROM parts_text""",
        "standardize_lower": """SELECT p_partkey, lower(trim(p_name, ' ')) AS p_name, lower(trim(p_type, ' ')) AS p_type, p_brand
            FROM parts_padded""",
        "standardize_trim": """SELECT p_partkey, trim(p_name, ' ') AS p_name, trim(p_type, ' ') AS p_type, p_brand
            FROM parts_padded""",
        "ingestion_stamp": f"SELECT *, {RUN_DATE_SQL} AS ingestion_date FROM orders",
        "enforce_schema": """SELECT cast(p_partkey AS VARCHAR) AS p_partkey, p_name, TRY_CAST(p_size AS INTEGER) AS p_size,
            TRY_CAST(p_retailprice AS DOUBLE) AS p_retailprice, TRY_CAST(p_large AS BOOLEAN) AS p_large FROM parts_text""",
        "null_violations": " UNION ALL ".join(
            f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL) AS violations FROM orders_defects"
            for c in ("o_orderkey", "o_custkey", "o_orderpriority", "o_totalprice")),
        "line_total": "SELECT line_item_id, order_id, product_id, quantity, unit_price, discount, line_total FROM items_raw",
        "join_inner": "SELECT o.customer_id, o.order_id, o.total_amount, c.segment, c.region FROM join_orders o JOIN customers_silver c ON o.customer_id = c.customer_id",
        "join_left": "SELECT o.customer_id, o.order_id, o.total_amount, c.segment, c.region FROM join_orders o LEFT JOIN customers_silver c ON o.customer_id = c.customer_id",
        "join_right": "SELECT c.customer_id, o.order_id, o.total_amount, c.segment, c.region FROM join_orders o RIGHT JOIN customers_silver c ON o.customer_id = c.customer_id",
        "join_full": "SELECT coalesce(o.customer_id, c.customer_id) AS customer_id, o.order_id, o.total_amount, c.segment, c.region FROM join_orders o FULL JOIN customers_silver c ON o.customer_id = c.customer_id",
        "join_semi": "SELECT o.customer_id, o.order_id, o.total_amount FROM join_orders o WHERE EXISTS (SELECT 1 FROM customers_silver c WHERE c.customer_id = o.customer_id)",
        "join_anti": "SELECT o.customer_id, o.order_id, o.total_amount FROM join_orders o WHERE NOT EXISTS (SELECT 1 FROM customers_silver c WHERE c.customer_id = o.customer_id)",
        "latest_per_key_join": """SELECT i.line_item_id, i.order_id, i.product_id, i.line_total, v.total_amount, v.status
            FROM items_clean i LEFT JOIN (""" + _dedup(
                "(SELECT order_id, total_amount, status, ingestion_date FROM orders_versions)", "order_id",
                "ingestion_date DESC NULLS LAST, " + _nf("total_amount, status")) + """) v ON i.order_id = v.order_id""",
    }.items()},
    "category_performance_fine": with_model(f"""
        SELECT category, channel, status, {money_sum('line_total')} AS total_revenue,
               cast(sum(quantity) AS BIGINT) AS total_quantity, count(DISTINCT order_id) AS order_count,
               {money_avg('(discount + quantity / 1000)')} AS avg_discount, {money_avg('unit_price')} AS avg_unit_price
        FROM items_enriched GROUP BY category, channel, status"""),
    "sql_text_metrics": with_model("""
        SELECT region, max(total_amount) AS largest, max(total_amount) - min(total_amount) AS spread,
               count(DISTINCT customer_id) AS customers, count(*) FILTER (WHERE upper(channel) = '1-URGENT') AS urgent
        FROM orders_enriched GROUP BY region"""),
    "segment_matrix_all": with_model(
        "SELECT region, "
        + ", ".join(
            f"coalesce(cast(sum(cast(total_amount AS DECIMAL(28,6))) FILTER (WHERE seg = '{v}') AS DOUBLE), 0) AS \"{v}\""
            for v in [*SEGMENT_VALUES, "CONSUMER"])
        + " FROM (SELECT *, CASE WHEN cast(order_id AS BIGINT) % 7 = 0 THEN 'CONSUMER' ELSE segment END AS seg FROM orders_enriched)"
        + " WHERE region IS NOT NULL GROUP BY region"),
    "null_policy_warn": with_model(
        "SELECT cast(o_orderkey AS VARCHAR) AS o_orderkey, cast(o_custkey AS VARCHAR) AS o_custkey, o_totalprice FROM orders_nullcust",
        DEFECT_CTES),
    # storage round-trips, partitioned overwrite, upserts, date-addressed scans
    "csv_roundtrip": with_model("SELECT * FROM orders_enriched"),
    "json_roundtrip": with_model("SELECT * FROM orders_enriched"),
    "parquet_partitioned_roundtrip": "SELECT *, cast(ts AS DATE) AS event_date FROM events",
    "dynamic_overwrite": """SELECT event_id, ts, user_id, event_type,
        CASE WHEN cast(ts AS DATE) = DATE '2024-01-15' THEN value * 2 ELSE value END AS value,
        props, cast(ts AS DATE) AS event_date FROM events""",
    "incremental_scan": "SELECT *, cast(ts AS DATE) AS ingestion_date FROM events WHERE cast(ts AS DATE) > DATE '2024-01-15'",
    "date_folder_scan": "SELECT * FROM events WHERE cast(ts AS DATE) = DATE '2024-01-15'",
    "date_range_scan": "SELECT * FROM events WHERE cast(ts AS DATE) BETWEEN DATE '2024-01-10' AND DATE '2024-01-12'",
    "drops_filtered_scan": """SELECT *, cast(ts AS DATE) AS drop_date FROM events
        WHERE cast(ts AS DATE) BETWEEN DATE '2024-01-10' AND DATE '2024-01-12'""",
    "drops_stream": "SELECT *, cast(ts AS DATE) AS drop_date FROM events WHERE cast(ts AS DATE) BETWEEN DATE '2024-01-01' AND DATE '2024-01-31'",
    "upsert_first_write": with_model("SELECT * FROM orders_bronze"),
    "upsert": with_model(LATEST_VERSIONS, DEFECT_CTES),
    "upsert_rerun": with_model(LATEST_VERSIONS, DEFECT_CTES),
    "upsert_null_keys": with_model(f"""
        SELECT * FROM ({LATEST_VERSIONS}) WHERE cast(order_id AS BIGINT) % 3 <> 0
        UNION ALL SELECT * REPLACE (NULL AS order_id) FROM orders_versions WHERE cast(order_id AS BIGINT) % 3 = 0""", DEFECT_CTES),
    "keyed_append_overwrite": with_model("SELECT * FROM orders_versions", DEFECT_CTES),
    "pipeline_fanout_lookup": with_model("SELECT *, 1 AS rank FROM orders_bronze"),
    "pipeline_post_join_clean": with_model("""
        SELECT o.*, lower(c.c_name) AS name FROM orders_bronze o JOIN customer c ON o.customer_id = cast(c.c_custkey AS VARCHAR)
        WHERE c.c_custkey % 5 <> 0"""),
    "backfill_older_day": with_model(LATEST_VERSIONS, DEFECT_CTES),
    "bronze_new_column": with_model(f"""SELECT *, CASE WHEN ingestion_date = {LATER_INGESTION_SQL} THEN concat('n', order_id) END AS note
        FROM ({LATEST_VERSIONS})""", DEFECT_CTES),
    "upsert_evolve": with_model(f"""SELECT *, CASE WHEN ingestion_date = {LATER_INGESTION_SQL}
        THEN cast(substring(channel, 1, 1) AS INTEGER) END AS priority_rank FROM ({LATEST_VERSIONS})""", DEFECT_CTES),
    # two-day pipeline run
    "pipeline_bronze_orders": with_model("SELECT * FROM orders_versions", RUN_CTES),
    "pipeline_silver_orders": with_model("SELECT * FROM orders_enriched_v2", RUN_CTES),
    "pipeline_silver_items": with_model("SELECT * FROM items_enriched", RUN_CTES),
    "pipeline_regional_sales": with_model("SELECT * FROM gold_regional_sales_v2", RUN_CTES),
    "pipeline_daily_trend": with_model("SELECT * FROM gold_daily_trend_v2", RUN_CTES),
    "pipeline_category_performance": with_model("SELECT * FROM gold_category_performance", RUN_CTES),
    **{f"refreshed_{m}": with_model(f"SELECT * FROM gold_{m}_v2", RUN_CTES)
       for m in ("regional_sales", "daily_trend", "sales_by_store", "sales_by_customer")},
    **{f"refreshed_{m}": with_model(f"SELECT * FROM gold_{m}", RUN_CTES) for m in ("product_performance", "category_performance")},
    "mart_groups_touched": with_model("""SELECT DISTINCT store_id, store_name, store_type, order_date FROM orders_enriched_v2
        WHERE cast(order_id AS BIGINT) % 10 = 0""", RUN_CTES),
    "pipeline_joined_not_null": with_model(_named_versions("name IS NOT NULL"), DEFECT_CTES),
    "pipeline_inner_lookup": with_model(_named_versions("found"), DEFECT_CTES),
    "ledger_after_runs": with_model(LEDGER_SQL, RUN_CTES),
    "skip_rule": with_model(LEDGER_SQL, RUN_CTES),
    # streaming (availableNow + foreachBatch upsert)
    **dict.fromkeys(("stream_events_upsert", "stream_late_version"), """
        SELECT event_id, ts, user_id, event_type,
               CASE WHEN cast(ts AS DATE) <= DATE '2024-01-15' AND event_id % 10 = 0 THEN value * 2 ELSE value END AS value,
               props,
               CASE WHEN cast(ts AS DATE) <= DATE '2024-01-15' AND event_id % 10 <> 0 THEN DATE '2024-01-16'
                    ELSE DATE '2024-01-31' END AS ingestion_date
        FROM events"""),
    # dashboard detail tables (column subset + captions)
    "report_store_detail": with_reports(
        'SELECT store_name AS "Store", store_type AS "Type", total_revenue AS "Revenue", order_count AS "Orders" FROM top_stores'),
    "report_segment_detail": with_reports(
        'SELECT segment AS "Segment", customers AS "Customers", total_revenue AS "Total Revenue", avg_clv AS "Avg CLV" FROM seg'),
    "report_product_detail": with_model(
        'SELECT product_id AS "Product", total_revenue AS "Revenue", total_quantity AS "Units Sold", order_count AS "Orders" '
        "FROM gold_product_performance ORDER BY total_revenue DESC NULLS FIRST, product_id ASC NULLS FIRST LIMIT 15"),
    "report_category_detail": with_reports(
        'SELECT category AS "Category", total_revenue AS "Revenue", total_quantity AS "Units Sold", '
        'order_count AS "Orders", avg_discount AS "Avg Discount" FROM cats'),
    "incremental_bound": with_model("SELECT * FROM orders_enriched_v2 WHERE ingestion_date = DATE '2024-02-01'", RUN_CTES),
}
