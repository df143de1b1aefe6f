"""Declared schemas, DQ checks and keyed upserts."""

import pytest
from pyspark.sql import functions as F

from strata.operators.schema import enforce_schema, null_violations
from strata.operators.upsert import upsert_frames
from strata.sinks.keyed_table import merge_into, read_keyed_table

SCHEMA = [("id", "string", False), ("amount", "double", True), ("gone", "string", True)]


def test_enforce_projects_casts_and_skips_missing(spark):
    df = spark.createDataFrame([(1, "2.5", "x")], "id int, amount string, extra string")
    out, report = enforce_schema(df, SCHEMA)
    assert out.columns == ["id", "amount"]
    assert dict(out.dtypes) == {"id": "string", "amount": "double"}
    assert report.missing == ["gone"]


def test_warn_counts_ride_on_the_action(spark):
    df = spark.createDataFrame([(1, "1"), (None, "2"), (None, "x")], "id int, amount string")
    out, report = enforce_schema(df, SCHEMA, "warn")
    assert out.count() == 3
    assert report.null_counts() == {"id": 2}


def test_fail_raises_before_write(spark):
    df = spark.createDataFrame([(None, "1")], "id int, amount string")
    with pytest.raises(ValueError, match="column 'id' has 1 null"):
        enforce_schema(df, SCHEMA, "fail")


def test_null_violations_long_form(spark):
    df = spark.createDataFrame([(None, None), (1, None)], "a int, b string")
    got = {r.column_name: r.violations for r in null_violations(df, ["a", "b"]).collect()}
    assert got == {"a": 1, "b": 2}


def test_upsert_semantics(spark):
    target = spark.createDataFrame(
        [("1", 10.0, "old"), ("2", 20.0, "keep"), (None, 0.0, "tnull")], "k string, v double, t_only string"
    )
    source = spark.createDataFrame([("1", 11.0, "n1"), ("3", 30.0, "n3"), (None, 5.0, "snull")], "k string, v double, s_only string")
    rows = sorted(
        (tuple(r) for r in upsert_frames(target, source, "k").collect()), key=lambda r: (str(r[0]), str(r[2]))
    )
    assert rows == [
        ("1", 11.0, "old", "n1"),
        ("2", 20.0, "keep", None),
        ("3", 30.0, None, "n3"),
        (None, 5.0, None, "snull"),
        (None, 0.0, "tnull", None),
    ]


def test_merge_into_first_write_update_and_rerun(spark, scratch):
    path = scratch("tbl")
    base = spark.range(100).select(F.col("id").cast("string").alias("k"), F.lit(1.0).alias("v"))
    merge_into(base, path, "k", buckets=8)
    batch = spark.range(90, 110).select(F.col("id").cast("string").alias("k"), F.lit(2.0).alias("v"))
    merge_into(batch, path, "k")
    merge_into(batch, path, "k")
    got = read_keyed_table(spark, path)
    assert got.count() == 110
    assert got.filter("v = 2.0").count() == 20


def test_merge_rejects_duplicate_source_keys(spark, scratch):
    path = scratch("tbl")
    dup = spark.createDataFrame([("1", 1.0), ("1", 2.0)], "k string, v double")
    with pytest.raises(ValueError, match="share a key"):
        merge_into(dup, path, "k")


def test_merge_schema_evolution(spark, scratch):
    path = scratch("tbl")
    merge_into(spark.createDataFrame([("1", 1.0), ("2", 2.0)], "k string, v double"), path, "k", buckets=4)
    merge_into(spark.createDataFrame([("2", 3.0, "x")], "k string, v double, extra string"), path, "k")
    rows = sorted(tuple(r) for r in read_keyed_table(spark, path).collect())
    assert rows == [("1", 1.0, None), ("2", 3.0, "x")]


def test_merge_type_change_rewrites_all_buckets(spark, scratch):
    path = scratch("tbl")
    merge_into(spark.createDataFrame([("1", 1), ("2", 2), ("3", 3)], "k string, v int"), path, "k", buckets=4)
    merge_into(spark.createDataFrame([("2", 20)], "k string, v bigint"), path, "k")
    got = read_keyed_table(spark, path)
    assert dict(got.dtypes)["v"] == "bigint"
    assert sorted(tuple(r) for r in got.collect()) == [("1", 1), ("2", 20), ("3", 3)]


def test_stream_upsert_is_incremental_and_replay_safe(spark, scratch):
    """availableNow picks up only new files; re-merging a batch (a replay)
    leaves the table unchanged."""
    from strata.streaming.incremental import clean_batch, upsert_stream

    root = scratch("stream")
    landing, target, ckpt = f"{root}/landing", f"{root}/t", f"{root}/_ckpt"
    schema = "k string, v double, ingestion_date date"
    first = spark.createDataFrame([("1", 1.0, None), ("2", 2.0, None), (None, 9.0, None)], schema)
    first.write.mode("append").parquet(landing)
    upsert_stream(spark, landing, schema, target, "k", ckpt)
    assert sorted(tuple(r)[:2] for r in read_keyed_table(spark, target).collect()) == [("1", 1.0), ("2", 2.0)]
    # nothing new: a second run is a no-op
    upsert_stream(spark, landing, schema, target, "k", ckpt)
    second = spark.createDataFrame([("2", 20.0, None), ("3", 3.0, None)], schema)
    second.write.mode("append").parquet(landing)
    upsert_stream(spark, landing, schema, target, "k", ckpt)
    # a replayed micro-batch merges to the same table
    merge_into(clean_batch(second, ["k"]), target, "k", check_unique=False)
    got = sorted(tuple(r)[:2] for r in read_keyed_table(spark, target).collect())
    assert got == [("1", 1.0), ("2", 20.0), ("3", 3.0)]


def test_merge_splits_large_buckets(spark, scratch, monkeypatch):
    """A bucket larger than a task's share is merged by several tasks; the
    table's row count follows every merge."""
    from strata.sinks import keyed_table as K

    path = scratch("tbl")
    base = spark.range(1000).select(F.col("id").cast("string").alias("k"), F.lit(1.0).alias("v"))
    merge_into(base, path, "k", buckets=2)
    assert K.read_meta(spark, path).rows == 1000
    monkeypatch.setattr(K, "ROWS_PER_TASK", 100)  # 500 rows per bucket -> 5 splits
    assert K.read_meta(spark, path).splits == 5
    batch = spark.range(900, 1100).select(F.col("id").cast("string").alias("k"), F.lit(2.0).alias("v"))
    merge_into(batch, path, "k")
    got = read_keyed_table(spark, path)
    assert got.count() == 1100 and got.filter("v = 2.0").count() == 200
    assert K.read_meta(spark, path).rows == 1100
    assert len(got.inputFiles()) > 2  # buckets written as several files


def test_keyed_table_write_modes(spark, scratch):
    from strata.sinks import keyed_table as K

    path = scratch("tbl")
    a = spark.createDataFrame([("1", 1.0), ("2", 2.0)], "k string, v double")
    b = spark.createDataFrame([("3", 3.0)], "k string, v double")
    K.write_keyed_table(a, path, "k", buckets=2)
    K.write_keyed_table(b, path, "k", mode="append")
    assert sorted(tuple(r) for r in read_keyed_table(spark, path).collect()) == [("1", 1.0), ("2", 2.0), ("3", 3.0)]
    assert K.read_meta(spark, path).rows == 3 and K.read_meta(spark, path).buckets == 2
    with pytest.raises(ValueError, match="already exists"):
        K.write_keyed_table(a, path, "k", mode="errorifexists")
    K.write_keyed_table(a, path, "k", mode="ignore")
    assert read_keyed_table(spark, path).count() == 3
    K.write_keyed_table(b, path, "k", mode="overwrite")
    assert [tuple(r) for r in read_keyed_table(spark, path).collect()] == [("3", 3.0)]
    assert K.read_meta(spark, path).rows == 1
    # an empty first batch still creates a readable table
    empty = scratch("empty")
    merge_into(a.limit(0), empty, "k")
    assert read_keyed_table(spark, empty).count() == 0


def _keyed(spark, lo, hi, v):
    return spark.range(lo, hi).select(F.col("id").cast("string").alias("k"), F.lit(v).alias("v"))


def test_lost_commits_are_not_a_first_write(spark, scratch):
    from strata.sinks import keyed_table as K

    path = scratch("tbl")
    merge_into(_keyed(spark, 0, 1000, 1.0), path, "k", buckets=4)
    K.delete_folder(spark, f"{path}/{K.COMMITS}")
    with pytest.raises(RuntimeError, match="no commits"):
        merge_into(_keyed(spark, 0, 5, 2.0), path, "k")
    assert spark.read.parquet(f"{path}/{K.DATA}").count() == 1000


def test_a_crash_before_the_commit_changes_nothing(spark, scratch, monkeypatch):
    from strata.sinks import keyed_table as K

    path = scratch("tbl")
    with monkeypatch.context() as m:  # even the first write
        m.setattr(K, "_publish", lambda *a: (_ for _ in ()).throw(OSError("crash")))
        with pytest.raises(OSError):
            merge_into(_keyed(spark, 0, 1000, 1.0), path, "k", buckets=4)
    merge_into(_keyed(spark, 0, 1000, 1.0), path, "k", buckets=4)
    with monkeypatch.context() as m:
        m.setattr(K, "_publish", lambda *a: (_ for _ in ()).throw(OSError("crash")))
        with pytest.raises(OSError):
            merge_into(_keyed(spark, 990, 1010, 2.0), path, "k")
    assert read_keyed_table(spark, path).filter("v = 2.0").count() == 0
    K._fs(spark, path)[0].mkdirs(K._fs(spark, f"{path}/{K.COMMITS}/00000009")[1])  # a commit cut short
    merge_into(_keyed(spark, 990, 1010, 2.0), path, "k")
    got = read_keyed_table(spark, path)
    assert got.count() == 1010 and got.filter("v = 2.0").count() == 20


def test_merges_leave_no_staged_batches_and_few_versions(spark, scratch):
    from strata.session import scratch_root
    from strata.sinks import keyed_table as K

    path = scratch("tbl")
    for k in range(5):
        merge_into(_keyed(spark, 10 * k, 10 * k + 20, float(k)), path, "k")
    assert not [n for n in K._children(spark, scratch_root(spark)) if n.startswith("merge-batch")]
    assert len(K._children(spark, f"{path}/{K.DATA}")) <= 2
    assert read_keyed_table(spark, path).count() == 60


def test_tables_grow_their_buckets(spark, scratch, monkeypatch):
    from strata.sinks import keyed_table as K

    path = scratch("tbl")
    merge_into(_keyed(spark, 0, 50, 1.0), path, "k")
    monkeypatch.setattr(K, "ROWS_PER_BUCKET", 40)
    merge_into(_keyed(spark, 40, 400, 2.0), path, "k")
    assert K.read_meta(spark, path).buckets == 11
    got = read_keyed_table(spark, path)
    assert got.count() == 400 and got.filter("v = 1.0").count() == 40


def test_older_versions_never_replace_newer_rows(spark, scratch):
    path = scratch("tbl")
    schema = "k string, v int, day int"
    merge_into(spark.createDataFrame([("a", 1, 5), ("b", 2, None), ("c", 3, 5)], schema), path, "k", version="day")
    merge_into(spark.createDataFrame([("a", 9, 4), ("b", 9, 1), ("c", 9, 5), ("d", 9, None)], schema), path, "k", version="day")
    merge_into(spark.createDataFrame([("a", 7, None)], schema), path, "k", version="day")
    assert sorted(tuple(r) for r in read_keyed_table(spark, path).collect()) == [("a", 1, 5), ("b", 9, 1), ("c", 9, 5), ("d", 9, None)]


def test_join_spellings_and_clashes(spark):
    from strata.operators.joins import join_using

    a = spark.createDataFrame([(1, "x"), (2, "y")], "k int, v string")
    b = spark.createDataFrame([(2, "z"), (3, "w")], "k int, v string")
    assert join_using(a, b, "k", "leftsemi").count() == 1 and join_using(a, b, "k", "leftAnti").count() == 1
    assert join_using(a, b, "k", "fullouter").count() == 3 and join_using(a, b, "k", "left_outer").count() == 2
    with pytest.raises(ValueError, match="left side"):
        join_using(a, b, "k", "left", ["v"])
    with pytest.raises(ValueError):
        join_using(a, b, "k", "cross")


def test_money_keeps_decimals_and_nan(spark):
    import math

    from strata.functions.money import money_avg, money_sum

    df = spark.createDataFrame([(1, 0.125), (1, 0.125), (1, 0.004), (2, 1.0), (2, 3.0), (2, float("nan")), (3, None)], "g int, v double")
    got = {r.g: (r.s, r.a) for r in df.groupBy("g").agg(money_sum("v").alias("s"), money_avg("v").alias("a")).collect()}
    assert got[1] == (0.254, 0.254 / 3)
    assert math.isnan(got[2][0]) and math.isnan(got[2][1])
    assert got[3] == (None, None)


def test_a_slice_is_a_task_of_its_own(spark, scratch, monkeypatch):
    from pyspark.sql import functions as F

    from strata.sinks import keyed_table as K

    assert K.splits_for(4_000_000, 1) >= 16  # a bucket is never sorted in one task
    monkeypatch.setattr(K, "ROWS_PER_TASK", 100)

    def files(path):
        read = K._read_buckets(spark, path, K.read_meta(spark, path))
        return [r["n"] for r in read.groupBy(F.input_file_name().alias("f")).agg(F.count("*").alias("n")).collect()]

    path = scratch("tbl")
    merge_into(_keyed(spark, 0, 2000, 1.0), path, "k", buckets=4)
    assert max(files(path)) <= 150
    merge_into(_keyed(spark, 0, 2400, 2.0), path, "k")
    assert max(files(path)) <= 150 and sum(files(path)) == 2400
    # rows of some buckets only, and a key that a table holds many times
    merge_into(_keyed(spark, 7, 8, 3.0), path, "k")
    got = read_keyed_table(spark, path)
    assert got.count() == 2400 and got.filter("v = 3.0").count() == 1 and got.filter("v = 2.0").count() == 2399
    same = scratch("same")
    K.write_keyed_table(spark.range(1000).select(F.lit("a").alias("k"), "id"), same, "k")
    assert max(files(same)) <= 150 and sum(files(same)) == 1000
