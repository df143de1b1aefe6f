"""Cleaning transforms (the reference's own unit cases plus values)."""

import math
from datetime import date

import pytest
from pyspark.sql import functions as F

from strata.operators import cleaning as C


def test_cast_one_column(spark):
    df = spark.createDataFrame([(1, "9.99")], "id bigint, amount string")
    out = C.cast_types(df, {"amount": "double"})
    assert dict(out.dtypes)["amount"] == "double"
    assert out.first()["amount"] == 9.99


def test_cast_many_columns(spark):
    df = spark.createDataFrame([("3", "12.50", "1")], "qty string, price string, flag string")
    out = C.cast_types(df, {"qty": "integer", "price": "double", "flag": "boolean"})
    types = dict(out.dtypes)
    assert types["qty"] == "int" and types["price"] == "double" and types["flag"] == "boolean"
    assert tuple(out.first()) == (3, 12.5, True)


def test_cast_requires_columns(spark):
    df = spark.createDataFrame([(1,)], "id int")
    with pytest.raises(ValueError, match="cast_types requires"):
        C.cast_types(df, {})


def test_cast_malformed_becomes_null(spark):
    df = spark.createDataFrame([("7",), ("abc",)], "v string")
    assert [r.v for r in C.cast_types(df, {"v": "int"}).collect()] == [7, None]


def test_dedup_all_columns(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b")], "id int, val string")
    assert C.drop_duplicates(df).count() == 2


def test_dedup_subset_is_deterministic(spark):
    df = spark.createDataFrame([(1, "b"), (1, "a"), (2, "c")], "id int, val string").repartition(3)
    rows = sorted(tuple(r) for r in C.drop_duplicates(df, ["id"]).collect())
    assert rows == [(1, "a"), (2, "c")]


def test_dedup_noop(spark):
    df = spark.createDataFrame([(1,), (2,), (3,)], "id int")
    assert C.drop_duplicates(df).count() == 3


def test_dedup_empty_subset_means_all(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (1, "b")], "id int, val string")
    assert C.apply_steps(df, [{"name": "drop_duplicates", "params": {"subset": []}}]).count() == 2


def test_latest_per_key(spark):
    df = spark.createDataFrame(
        [(1, 10.0, date(2024, 1, 1)), (1, 20.0, date(2024, 1, 2)), (2, 5.0, date(2024, 1, 1))],
        "id int, v double, ingestion_date date",
    )
    rows = sorted((r.id, r.v) for r in C.latest_per_key(df, ["id"]).collect())
    assert rows == [(1, 20.0), (2, 5.0)]


def test_filter_nulls_subset(spark):
    df = spark.createDataFrame([(1, "Alice"), (None, "Bob"), (3, None)], "id int, name string")
    assert C.filter_nulls(df, ["id"]).count() == 2


def test_filter_nulls_any_column(spark):
    df = spark.createDataFrame([(1, "Alice"), (None, "Bob"), (3, None)], "id int, name string")
    assert C.filter_nulls(df).count() == 1


def test_filter_nulls_noop(spark):
    df = spark.createDataFrame([(1, "Alice"), (2, "Bob")], "id int, name string")
    assert C.filter_nulls(df, ["id"]).count() == 2


def test_filter_nulls_drops_nan(spark):
    df = spark.createDataFrame([(1, 1.0), (2, math.nan), (3, None)], "id int, v double")
    assert [r.id for r in C.filter_nulls(df, ["v"]).collect()] == [1]


def test_filter_nulls_pushed_to_scan(spark, scratch):
    path = scratch("nulls")
    spark.createDataFrame([(1, "a"), (None, "b")], "id int, s string").write.parquet(path)
    plan = C.filter_nulls(spark.read.parquet(path), ["id"])._jdf.queryExecution().executedPlan().toString()
    assert "IsNotNull(id)" in plan


def test_standardize_strings(spark):
    df = spark.createDataFrame([("  MiXed \t", " x ")], "a string, b string")
    low = C.standardize_strings(df, ["a", "b"]).first()
    assert low.a == "mixed \t" and low.b == "x"
    keep = C.standardize_strings(df, ["a"], lowercase=False).first()
    assert keep.a == "MiXed \t"


def test_ingestion_date(spark):
    df = spark.createDataFrame([(1,)], "id int")
    assert C.add_ingestion_date(df, run_date=date(2024, 1, 31)).first().ingestion_date == date(2024, 1, 31)
    today = C.add_ingestion_date(df, "landed").select(F.col("landed") == F.current_date()).first()[0]
    assert today


def test_transform_registry(spark):
    for name in ("cast_types", "drop_duplicates", "filter_nulls", "standardize_strings", "add_ingestion_date"):
        assert callable(C.get_transform(name))
    with pytest.raises(ValueError, match="Unknown transformer"):
        C.get_transform("nonexistent")
    C.register_transform("double_id", lambda df: df.withColumn("id", F.col("id") * 2))
    df = spark.createDataFrame([(2,)], "id int")
    assert C.apply_steps(df, [{"name": "double_id"}]).first().id == 4


def test_failing_step_names_transform(spark):
    df = spark.createDataFrame([(1,)], "id int")
    with pytest.raises(RuntimeError, match="Transformer 'cast_types' failed"):
        C.apply_steps(df, [{"name": "cast_types", "params": {"columns": {"nope": "int"}}}])
