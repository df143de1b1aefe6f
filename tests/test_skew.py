"""Hot keys: a third of the rows on one key must not change results, and the
plans must cut the hot key down before (or keep it out of) the shuffle."""

from pyspark.sql import functions as F

from strata.operators.cleaning import drop_duplicates
from strata.operators.upsert import upsert_frames
from strata.plans.marts import build_mart

N = 30_000


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _skewed(spark):
    # every third row carries key 0; the rest are spread
    return spark.range(N).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("k"),
        F.col("id").alias("v"),
        (F.col("id") % 7).alias("g"),
    )


def test_dedup_hot_key(spark):
    df = _skewed(spark).repartition(8)
    out = drop_duplicates(df, ["k"])
    assert out.count() == N - N // 3 + 1  # key 0 once, plus every id not divisible by 3
    assert out.filter("k = 0").first().v == 0  # deterministic survivor: smallest v
    p = _plan(drop_duplicates(df, ["k"]))  # not run: the plan as it is before AQE
    # a partial limit runs below the exchange (further down the text), so the hot key ships one row per task
    assert p.count("WindowGroupLimit") == 2
    above, below = p.split("Exchange hashpartitioning", 1)
    assert "WindowGroupLimit" in above and "WindowGroupLimit" in below


def test_hot_group_aggregates_partially(spark):
    df = _skewed(spark)
    mart = build_mart({"group_by": ["k"], "metrics": [("n", "count", "v"), ("s", "sum_long", "v"), ("d", "count_distinct", "g")]}, df)
    row = mart.filter("k = 0").first()
    assert row.n == N // 3 and row.d == 7
    p = _plan(mart)
    # partial aggregates before each exchange; the distinct count first
    # shuffles on (group, value), spreading the hot group over its values
    assert "partial_sum" in p and "partial_count(distinct" in p
    assert "hashpartitioning(k#" in p and ", g#" in p


def test_null_keys_are_spread_by_the_upsert(spark):
    target = _skewed(spark).withColumn("k", F.when(F.col("k") == 0, F.lit(None)).otherwise(F.col("k")))
    source = spark.range(10).select((F.col("id") * 3 + 1).alias("k"), F.lit(-1).cast("long").alias("v"), F.lit(0).cast("long").alias("g"))
    merged = upsert_frames(target, source, "k")
    assert merged.count() == N
    assert merged.filter("k is null").count() == N // 3
    assert merged.filter("v = -1").count() == 10
    p = _plan(upsert_frames(target, source, "k"))
    assert "FullOuter" in p and "Union" not in p and p.count("Exchange hashpartitioning") == 2


def test_null_keys_are_spread_by_the_merge(spark, scratch):
    from strata.sinks import keyed_table as K

    path = scratch("tbl")
    rows = spark.range(10_000).select(F.lit(None).cast("long").alias("k"), F.col("id").alias("v"))
    K.merge_into(rows, path, "k", buckets=16)
    K.merge_into(rows.limit(100).withColumn("v", F.lit(-1).cast("long")).unionByName(rows.where("v < 5")), path, "k")
    meta = K.read_meta(spark, path)
    assert meta.rows == 10_105 and max(n for _, n in meta.places.values()) < 1500
    assert K.read_keyed_table(spark, path).count() == 10_105


def test_hot_join_key_is_split_by_aqe(spark):
    """A left join on a key holding a third of the rows, followed by an
    aggregate that reuses the join's partitioning: AQE still splits the hot
    partition (forceOptimizeSkewedJoin), and the result is exact."""
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
    }
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        left = _skewed(spark).select("k", "v")
        right = spark.range(N).select(F.col("id").alias("k"), (F.col("id") % 5).alias("w"))
        joined = left.join(right, "k", "left")
        out = joined.groupBy("k").agg(F.count_distinct("v").alias("n"), F.sum("w").alias("w"))
        rows = {r.k: (r.n, r.w) for r in out.collect()}
        assert rows[0] == (N // 3, 0)
        assert len(rows) == N - N // 3 + 1
        assert "skew=true" in _plan(out)
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
