"""Physical-plan shape: pushdown, pruning, top-k, pre-shuffle dedup."""

from strata.operators.cleaning import drop_duplicates
from strata.plans import queries as Q
from strata.plans.model import stored_model

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_top_k_is_take_ordered(spark):
    assert "TakeOrderedAndProject" in plan(Q.report_top_products(spark, SF))


def test_dedup_limits_before_shuffle(spark):
    df = spark.read.parquet(f"{SF}/lineitem.parquet")
    p = plan(drop_duplicates(df, ["l_orderkey"]))
    assert "WindowGroupLimit" in p


def _scans(p):
    return [line for line in p.splitlines() if "FileScan" in line]


def test_marts_scan_only_what_they_need(spark):
    stored = stored_model(spark, SF)
    stored.silver("retail_orders"), stored.silver("retail_order_items")
    scans = _scans(plan(Q.daily_trend(spark, SF)))
    assert len(scans) == 1 and "ReadSchema: struct<order_id:string,order_date:date,total_amount:double>" in scans[0]
    scans = _scans(plan(Q.product_performance(spark, SF)))
    assert len(scans) == 1 and "ReadSchema: struct<order_id:string,product_id:string,quantity:bigint,line_total:double>" in scans[0]


def test_reports_read_marts(spark):
    Q.report_kpis(spark, SF)
    scans = _scans(plan(Q.report_kpis(spark, SF)))
    assert len(scans) == 2 and not any("lineitem" in s or "orders.parquet" in s for s in scans)


def test_incremental_prunes_partitions(spark, scratch):
    from datetime import date

    from pyspark.sql import functions as F

    from strata.sources.paths import incremental

    path = scratch("bronze")
    spark.range(10).withColumn("ingestion_date", F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 3).cast("int"))) \
        .write.partitionBy("ingestion_date").parquet(path)
    df = incremental(spark.read.parquet(path), date(2024, 1, 2))
    assert "PartitionFilters: [isnotnull(ingestion_date" in plan(df)
    assert df.count() == 3


def test_merge_reads_and_shuffles_each_side_once(spark, scratch):
    """The real merge, on stored tables with nullable keys: one scan and one
    exchange per side, and the join uses the (bucket, split) partitioning."""
    from pyspark.sql import functions as F

    from strata.operators.upsert import upsert_frames
    from strata.sinks import keyed_table as K

    path, batch = scratch("tbl"), scratch("batch")

    def rows(lo, hi, v):
        return spark.range(lo, hi).select(F.col("id").cast("string").alias("k"), F.lit(v).alias("v"))

    K.merge_into(rows(0, 100, 1.0), path, "k", buckets=4)
    rows(50, 150, 2.0).write.parquet(batch)
    meta = K.read_meta(spark, path)
    target, source = K._read_buckets(spark, path, meta, [0, 1]), spark.read.parquet(batch)
    source = source.withColumn(K.BUCKET, K.bucket_of(source, ["k"], 4))
    sides = [d.withColumn(K.SPLIT, K.split_of(d.drop(K.BUCKET), ["k"], 2)).repartition(8, K.BUCKET, K.SPLIT) for d in (target, source)]
    with K._co_partitioned_join(spark):
        p = plan(upsert_frames(*sides, ["k"], co_keys=[K.BUCKET, K.SPLIT]))
    assert p.count("REPARTITION_BY_NUM") == 2 and "ENSURE_REQUIREMENTS" not in p
    assert len(_scans(p)) == 2
