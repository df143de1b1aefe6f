"""Reader/writer registries, partitioned writes, missing sources."""

import pytest
from pyspark.errors import AnalysisException

from strata.sinks import writers as W
from strata.sources import readers as R
from strata.sources.paths import check_template, resolve_date_range, resolve_date_template


def test_reader_registry(spark, scratch):
    assert R.get_reader("csv") is R.read_csv
    assert R.get_reader("parquet") is R.read_parquet
    with pytest.raises(ValueError, match="Unsupported reader format"):
        R.get_reader("excel")
    R.register_reader("text_lines", lambda s, p, o, sc: s.read.text(p))
    path = scratch("txt")
    spark.createDataFrame([("a",), ("b",)], "value string").write.text(path)
    assert R.read(spark, "text_lines", path).count() == 2


def test_csv_defaults_no_header(spark, scratch):
    path = scratch("csv")
    spark.createDataFrame([(1, "x")], "id int, s string").coalesce(1).write.option("header", "true").csv(path)
    df = R.read(spark, "csv", path)
    assert df.columns == ["_c0", "_c1"] and df.count() == 2
    assert R.read(spark, "csv", path, {"header": "true"}).columns == ["id", "s"]


def test_missing_path_detected(spark, scratch):
    with pytest.raises(AnalysisException) as info:
        R.read(spark, "parquet", scratch("absent"))
    assert R.is_missing_path(info.value)


def test_writer_registry():
    with pytest.raises(ValueError, match="Unsupported writer format"):
        W.get_writer("excel")
    assert W.get_writer("json") is W.write_json


def test_partitioned_dynamic_overwrite(spark, scratch):
    path = scratch("parts")
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id int, day string")
    W.write_spec(df, {"format": "parquet", "path": path, "partition_by": ["day"]})
    rerun = spark.createDataFrame([(3, "a")], "id int, day string")
    W.write_spec(rerun, {"format": "parquet", "path": path, "partition_by": ["day"], "overwrite_mode": "dynamic"})
    assert sorted((r.id, r.day) for r in spark.read.parquet(path).collect()) == [(2, "b"), (3, "a")]


def test_append_mode_is_honoured(spark, scratch):
    path = scratch("app")
    df = spark.createDataFrame([(1,)], "id int")
    W.write_spec(df, {"format": "parquet", "path": path, "mode": "overwrite"})
    W.write_spec(df, {"format": "parquet", "path": path, "mode": "append"})
    assert spark.read.parquet(path).count() == 2


def test_jdbc_properties(monkeypatch):
    monkeypatch.setenv("JDBC_URL", "jdbc:postgresql://db:5432/gold")
    url, table, props = W.jdbc_properties({"schema": "gold_schema", "table": "daily", "user": "u"})
    assert url.endswith("/gold") and table == "gold_schema.daily" and props["user"] == "u"
    _, table, _ = W.jdbc_properties({"table": "daily"})
    assert table == "daily"
    with pytest.raises(ValueError):
        W.jdbc_properties({"url": "jdbc:x"})
    monkeypatch.delenv("JDBC_URL")
    monkeypatch.setenv("POSTGRES_HOST", "pg")
    monkeypatch.setenv("POSTGRES_DB", "gold")
    monkeypatch.setenv("POSTGRES_USER", "writer")
    url, table, props = W.jdbc_properties({"format": "postgres", "schema": "gold_schema", "table": "t"})
    assert url == "jdbc:postgresql://pg:5432/gold" and props["user"] == "writer"
    assert props["driver"] == "org.postgresql.Driver" and table == "gold_schema.t"


def test_date_templates():
    from datetime import date

    assert resolve_date_template("f/{year}/{month}/{day}/o.parquet", date(2024, 3, 5)) == "f/2024/03/05/o.parquet"
    assert resolve_date_template("dims/c.parquet", date(2024, 3, 5)) == "dims/c.parquet"
    assert len(resolve_date_range("{year}-{month}-{day}", date(2024, 2, 28), date(2024, 3, 1))) == 3
    with pytest.raises(ValueError, match="Unknown placeholder"):
        check_template("f/{yr}/x")
