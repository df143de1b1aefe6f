"""Registered queries that go through storage: round-trips, partitioned
overwrite, keyed upserts and date-addressed scans.

Each call writes under a fresh folder of the shared scratch root
(``spark.checkpoint.dir``) and returns the DataFrame read back.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import new_scratch_path
from ..sinks.keyed_table import merge_into, read_keyed_table, write_keyed_table
from ..sinks.writers import write_spec
from ..sources import defects as D
from ..sources import drops
from ..sources.paths import incremental, resolve_date_range, resolve_date_template
from ..sources.readers import read
from ..sources.retail import events_raw, orders_raw
from .model import RetailModel
from .registry import register
from .retail_model import DEFAULT_RUN_DATE

# The event days used by the date-addressed scans.
REPLACED_DAY = date(2024, 1, 15)
INCREMENTAL_AFTER = date(2024, 1, 15)
BACKFILL_FROM, BACKFILL_TO = date(2024, 1, 10), date(2024, 1, 12)


def _roundtrip(spark: SparkSession, df: DataFrame, fmt: str, options: dict) -> DataFrame:
    path = new_scratch_path(spark, f"{fmt}-roundtrip")
    write_spec(df, {"format": fmt, "path": path, "mode": "overwrite", "options": options})
    return read(spark, fmt, path, options, schema=df.schema)


@register()
def csv_roundtrip(spark, sf_dir):
    df = RetailModel(spark, sf_dir).silver("retail_orders")
    return _roundtrip(spark, df, "csv", {"header": "true"})


@register()
def json_roundtrip(spark, sf_dir):
    df = RetailModel(spark, sf_dir).silver("retail_orders")
    return _roundtrip(spark, df, "json", {})


def _land_events(spark: SparkSession, sf_dir: str, partition_by: list[str], frame: DataFrame | None = None) -> str:
    path = new_scratch_path(spark, "events")
    df = frame if frame is not None else events_raw(spark, sf_dir)
    write_spec(df, {"format": "parquet", "path": path, "mode": "overwrite", "partition_by": partition_by})
    return path


@register()
def parquet_partitioned_roundtrip(spark, sf_dir):
    events = events_raw(spark, sf_dir)
    path = _land_events(spark, sf_dir, ["event_date"], events)
    return spark.read.schema(events.schema).parquet(path)


@register()
def dynamic_overwrite(spark, sf_dir):
    """Rerun of one day: only that day's partition is replaced."""
    events = events_raw(spark, sf_dir)
    path = _land_events(spark, sf_dir, ["event_date"], events)
    day = F.to_date(F.lit(str(REPLACED_DAY)))
    rerun = events.filter(F.col("event_date") == day).withColumn("value", F.col("value") * 2)
    write_spec(
        rerun,
        {"format": "parquet", "path": path, "mode": "overwrite", "partition_by": ["event_date"], "overwrite_mode": "dynamic"},
    )
    return spark.read.schema(events.schema).parquet(path)


@register()
def incremental_scan(spark, sf_dir):
    """Bronze events by ingestion date; only days after the bound are read
    (the predicate prunes partition directories)."""
    bronze = events_raw(spark, sf_dir).withColumnRenamed("event_date", "ingestion_date")
    path = _land_events(spark, sf_dir, ["ingestion_date"], bronze)
    return incremental(spark.read.schema(bronze.schema).parquet(path), INCREMENTAL_AFTER)


def _date_folders(spark, sf_dir) -> str:
    ev = events_raw(spark, sf_dir).select(
        "*",
        F.date_format("event_date", "yyyy").alias("year"),
        F.date_format("event_date", "MM").alias("month"),
        F.date_format("event_date", "dd").alias("day"),
    ).drop("event_date")
    return _land_events(spark, sf_dir, ["year", "month", "day"], ev)


EVENT_SCHEMA = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"


@register()
def date_folder_scan(spark, sf_dir):
    root = _date_folders(spark, sf_dir)
    path = resolve_date_template(root + "/year={year}/month={month}/day={day}", REPLACED_DAY)
    return spark.read.schema(EVENT_SCHEMA).parquet(path)


@register()
def date_range_scan(spark, sf_dir):
    root = _date_folders(spark, sf_dir)
    paths = resolve_date_range(root + "/year={year}/month={month}/day={day}", BACKFILL_FROM, BACKFILL_TO)
    return spark.read.schema(EVENT_SCHEMA).parquet(*paths)


def _drops(spark, sf_dir):
    """The ``drops`` source over the landed event folders; no file is opened yet."""
    drops.register(spark)
    root = _date_folders(spark, sf_dir)
    return root + "/year={year}/month={month}/day={day}", {"first": "2024-01-01", "last": "2024-01-31"}


@register()
def drops_filtered_scan(spark, sf_dir):
    """A filter on the day chooses the folders."""
    path, days = _drops(spark, sf_dir)
    events = spark.read.format("drops").schema(f"{EVENT_SCHEMA}, drop_date date").options(**days).load(path)
    return events.where(F.col("drop_date").between(F.lit(BACKFILL_FROM), F.lit(BACKFILL_TO)))


@register()
def drops_stream(spark, sf_dir):
    """The folders as a stream: everything landed so far in one run, days as offsets."""
    path, days = _drops(spark, sf_dir)
    root = new_scratch_path(spark, "drops-stream")
    events = spark.readStream.format("drops").schema(f"{EVENT_SCHEMA}, drop_date date").options(**days).load(path)
    query = events.writeStream.format("parquet").option("path", f"{root}/out").option("checkpointLocation", f"{root}/_checkpoint")
    query.trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(events.schema).parquet(f"{root}/out")


# ------------------------------------------------------------------ upserts


def _bronze_orders(spark, sf_dir) -> DataFrame:
    return orders_raw(spark, sf_dir).withColumn("ingestion_date", F.to_date(F.lit(str(DEFAULT_RUN_DATE))))


def _newer_versions(spark, sf_dir) -> DataFrame:
    versions = D.orders_versions(spark, sf_dir, DEFAULT_RUN_DATE)
    return versions.filter(F.col("ingestion_date") == F.to_date(F.lit(str(D.LATER_INGESTION))))


@register()
def upsert_first_write(spark, sf_dir):
    path = new_scratch_path(spark, "orders-keyed")
    merge_into(_bronze_orders(spark, sf_dir), path, "order_id")
    return read_keyed_table(spark, path)


@register()
def upsert(spark, sf_dir):
    path = new_scratch_path(spark, "orders-keyed")
    merge_into(_bronze_orders(spark, sf_dir), path, "order_id")
    merge_into(_newer_versions(spark, sf_dir), path, "order_id")
    return read_keyed_table(spark, path)


@register()
def upsert_rerun(spark, sf_dir):
    """The same batch merged twice gives the table of one merge."""
    path = new_scratch_path(spark, "orders-keyed")
    merge_into(_bronze_orders(spark, sf_dir), path, "order_id")
    merge_into(_newer_versions(spark, sf_dir), path, "order_id")
    merge_into(_newer_versions(spark, sf_dir), path, "order_id")
    return read_keyed_table(spark, path)


@register()
def upsert_evolve(spark, sf_dir):
    """A batch with a new column: matched rows get it, others keep null."""
    path = new_scratch_path(spark, "orders-keyed")
    merge_into(_bronze_orders(spark, sf_dir), path, "order_id")
    newer = _newer_versions(spark, sf_dir).withColumn("priority_rank", F.substring("channel", 1, 1).cast("int"))
    merge_into(newer, path, "order_id")
    return read_keyed_table(spark, path)


@register()
def upsert_null_keys(spark, sf_dir):
    """A third of both sides without a key: those rows never match and are all kept."""
    path = new_scratch_path(spark, "orders-keyed")
    keyless = F.when(F.col("order_id").cast("long") % 3 == 0, F.lit(None)).otherwise(F.col("order_id"))
    merge_into(_bronze_orders(spark, sf_dir).withColumn("order_id", keyless), path, "order_id", buckets=4)
    merge_into(_newer_versions(spark, sf_dir).withColumn("order_id", keyless), path, "order_id")
    return read_keyed_table(spark, path)


@register()
def keyed_append_overwrite(spark, sf_dir):
    """Overwrite replaces the table, append adds rows of equal keys too."""
    path = new_scratch_path(spark, "orders-keyed")
    write_keyed_table(_newer_versions(spark, sf_dir), path, "order_id", buckets=4)
    write_keyed_table(_bronze_orders(spark, sf_dir), path, "order_id", buckets=4)
    write_keyed_table(_newer_versions(spark, sf_dir), path, "order_id", mode="append")
    return read_keyed_table(spark, path)
