"""Registered queries over the two-day pipeline run (tables read back)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..session import new_scratch_path
from ..sinks.keyed_table import read_keyed_table, read_meta
from ..sources.retail import orders_raw, table
from .lake_runs import DAY_ONE, DAY_TWO, newer_orders, two_day_lake
from .ledger import RunLedger
from .pipeline import LakeLayout, land_raw, run, run_configs
from .registry import register
from .retail_model import GOLD_MARTS


@register()
def pipeline_bronze_orders(spark, sf_dir):
    """Bronze keeps every landed version, one partition per ingestion date."""
    lake = two_day_lake(spark, sf_dir)
    return spark.read.parquet(lake.layout.bronze("retail_orders"))


@register()
def pipeline_silver_orders(spark, sf_dir):
    """Silver after an incremental day: later versions upserted, others kept."""
    lake = two_day_lake(spark, sf_dir)
    return read_keyed_table(spark, lake.layout.silver("retail_orders_enriched"))


@register()
def pipeline_silver_items(spark, sf_dir):
    lake = two_day_lake(spark, sf_dir)
    return read_keyed_table(spark, lake.layout.silver("retail_order_items_enriched"))


@register()
def pipeline_regional_sales(spark, sf_dir):
    lake = two_day_lake(spark, sf_dir)
    return spark.read.parquet(lake.layout.gold("gold_regional_sales"))


@register()
def pipeline_daily_trend(spark, sf_dir):
    lake = two_day_lake(spark, sf_dir)
    return spark.read.parquet(lake.layout.gold("gold_daily_trend"))


@register()
def pipeline_category_performance(spark, sf_dir):
    lake = two_day_lake(spark, sf_dir)
    return spark.read.parquet(lake.layout.gold("gold_category_performance"))


def _refreshed(name):
    """A mart that was built on day 1 and took in the changes of day 2."""
    def query(spark, sf_dir):
        return two_day_lake(spark, sf_dir, "incremental").mart(spark, name).frame()

    query.__name__ = name.replace("gold_", "refreshed_")
    return register()(query)


for _mart in sorted(GOLD_MARTS):
    _refreshed(_mart)


@register()
def mart_groups_touched(spark, sf_dir):
    """Groups of the store mart that day 2 wrote: those of its orders, no others."""
    lake = two_day_lake(spark, sf_dir, "incremental")
    commit = read_meta(spark, lake.layout.silver("retail_orders_enriched")).commit
    return lake.mart(spark, "gold_sales_by_store").touched_by(commit)


def _ledger_rows(spark, layout):
    return RunLedger(spark, layout.ledger).frame().drop("last_run_timestamp")


@register()
def ledger_after_runs(spark, sf_dir):
    lake = two_day_lake(spark, sf_dir)
    return _ledger_rows(spark, lake.layout)


@register()
def skip_rule(spark, sf_dir):
    """Rerunning day 2 skips every dataset that succeeded: the ledger is unchanged (a
    rerun of silver would have read 0 new rows and recorded 0) and no table got a
    new commit."""
    lake = two_day_lake(spark, sf_dir)
    before = read_meta(spark, lake.layout.silver("retail_orders_enriched")).commit
    run(spark, lake.layout, DAY_TWO)
    if read_meta(spark, lake.layout.silver("retail_orders_enriched")).commit != before:
        raise RuntimeError("a skipped dataset was written again")
    return _ledger_rows(spark, lake.layout)


@register()
def incremental_bound(spark, sf_dir):
    """Rows the day-2 silver run wrote: only bronze rows after day 1 were
    read (the ledger's bound), and they replaced their keys' day-1 rows."""
    lake = two_day_lake(spark, sf_dir)
    silver = read_keyed_table(spark, lake.layout.silver("retail_orders_enriched"))
    return silver.filter(F.col("ingestion_date") == F.lit(str(DAY_TWO)).cast("date"))


def _own_lake(spark, sf_dir, name, orders_job, lookups, days):
    """A lake of one job over orders, run for each of ``days``: date, raw frame and, if not all, layers."""
    root = new_scratch_path(spark, name)
    layout = LakeLayout(raw=f"{root}/raw", lake=f"{root}/lake")
    for path, df in lookups.items():
        df.write.parquet(f"{root}/{path}")
    job = {
        "dataset": "retail_orders",
        "bronze": {"source_format": "parquet", "source_path": layout.raw_path("retail_orders"), "target_path": layout.bronze("retail_orders")},
        "silver": {
            "source_path": layout.bronze("retail_orders"), "target_path": layout.silver("orders"), "primary_key": "order_id",
            "not_null_columns": ["order_id"], "dedup_key": ["order_id"], **orders_job(root),
        },
    }
    for day, raw, *layers in days:
        land_raw(layout, day, {"retail_orders": raw})
        if run_configs(spark, [job], [], layout.ledger, day, *layers):
            raise RuntimeError(f"run of {day} failed")
    return read_keyed_table(spark, layout.silver("orders"))


@register()
def pipeline_fanout_lookup(spark, sf_dir):
    """A lookup with two rows for some keys: silver still holds each order once."""
    priorities = table(spark, sf_dir, "orders").select(F.col("o_orderpriority").alias("channel")).distinct()
    twice = priorities.withColumn("rank", F.lit(1)).unionByName(priorities.where("channel < '3'").withColumn("rank", F.lit(2)))
    join = lambda root: {"joins": [{"format": "parquet", "path": f"{root}/ranks", "on": "channel", "type": "left", "select": ["channel", "rank"]}]}
    return _own_lake(spark, sf_dir, "fanout", join, {"ranks": twice}, [(DAY_ONE, orders_raw(spark, sf_dir))])


@register()
def pipeline_post_join_clean(spark, sf_dir):
    """Steps on joined columns: the lookup's padded names are trimmed, rows without one go."""
    names = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("customer_id"),
        F.when(F.col("c_custkey") % 5 != 0, F.concat(F.lit("  "), "c_name", F.lit(" "))).alias("name"),
    )
    job = lambda root: {
        "not_null_columns": ["order_id", "name"],
        "joins": [{"format": "parquet", "path": f"{root}/names", "on": "customer_id", "type": "left", "select": ["customer_id", "name"]}],
        "transformations": [{"name": "standardize_strings", "params": {"columns": ["name"], "lowercase": True}}],
    }
    return _own_lake(spark, sf_dir, "postjoin", job, {"names": names}, [(DAY_ONE, orders_raw(spark, sf_dir))])


def _two_versions(spark, sf_dir, name, job):
    """Silver's first run over two landed days: of every tenth order a newer version, half of those
    for a customer that the lookup doesn't have."""
    names = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("customer_id"), F.when(F.col("c_custkey") % 5 != 0, F.col("c_name")).alias("name")
    )
    unknown = F.when(F.col("order_id").cast("long") % 20 == 0, F.lit("-1")).otherwise(F.col("customer_id"))
    newer = newer_orders(spark, sf_dir).withColumn("customer_id", unknown)
    days = [(DAY_ONE, orders_raw(spark, sf_dir), ("bronze",)), (DAY_TWO, newer, ("bronze", "silver"))]
    return _own_lake(spark, sf_dir, name, job, {"names": names}, days)


@register()
def pipeline_joined_not_null(spark, sf_dir):
    """A null in a joined column drops a version, not its key: the older version stays."""
    job = lambda root: {
        "not_null_columns": ["order_id", "name"],
        "joins": [{"format": "parquet", "path": f"{root}/names", "on": "customer_id", "type": "left", "select": ["customer_id", "name"]}],
    }
    return _two_versions(spark, sf_dir, "joined-null", job)


@register()
def pipeline_inner_lookup(spark, sf_dir):
    """An inner lookup drops a version, not its key."""
    job = lambda root: {
        "joins": [{"format": "parquet", "path": f"{root}/names", "on": "customer_id", "type": "inner", "select": ["customer_id", "name"]}],
    }
    return _two_versions(spark, sf_dir, "inner", job)


@register()
def backfill_older_day(spark, sf_dir):
    """Day 2 runs first, then day 1 is filled in: its new orders reach silver, its older
    versions of day 2's orders don't replace them."""
    days = [(DAY_TWO, newer_orders(spark, sf_dir)), (DAY_ONE, orders_raw(spark, sf_dir))]
    return _own_lake(spark, sf_dir, "backfill", lambda root: {}, {}, days)


@register()
def bronze_new_column(spark, sf_dir):
    """A raw column that appears on day 2 reaches silver; earlier rows have null."""
    later = newer_orders(spark, sf_dir).withColumn("note", F.concat(F.lit("n"), "order_id"))
    return _own_lake(spark, sf_dir, "evolve", lambda root: {}, {}, [(DAY_ONE, orders_raw(spark, sf_dir)), (DAY_TWO, later)])
