"""The ``drops`` source: days by filter, files as partitions, days as stream offsets."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from strata.sources import drops


@pytest.fixture()
def landed(spark, scratch):
    drops.register(spark)
    root = scratch("drops")
    for day, n in (("2024/01/01", 3), ("2024/01/03", 5), ("2024/01/04", 2)):
        spark.range(n).select("id", F.lit(day).alias("d")).repartition(2).write.parquet(f"{root}/{day}")
    spark.range(1).select("id", F.lit("x").alias("d"), F.lit(9).alias("more")).write.parquet(f"{root}/2024/02/01")
    return root + "/{year}/{month}/{day}"


def _read(spark, path, **options):
    return spark.read.format("drops").options(first="2024-01-01", last="2024-01-31", **options).load(path)


def _partitions(df):
    return df.rdd.getNumPartitions()


def test_rows_know_their_day(spark, landed):
    df = _read(spark, landed)
    assert df.columns == ["id", "d", "drop_date"]
    got = {(str(r.drop_date), r.n) for r in df.groupBy("drop_date").agg(F.count("*").alias("n")).collect()}
    assert got == {("2024-01-01", 3), ("2024-01-03", 5), ("2024-01-04", 2)}
    assert df.where(F.date_format("drop_date", "yyyy/MM/dd") != F.col("d")).isEmpty()


@pytest.mark.parametrize("condition, days", [
    ("drop_date = '2024-01-03'", 1), ("drop_date > '2024-01-01'", 2), ("drop_date >= '2024-01-01' AND drop_date < '2024-01-04'", 2),
    ("drop_date IN ('2024-01-01', '2024-01-04')", 2), ("drop_date <= '2023-12-31'", 0), ("id = 1", 3),
])
def test_filters_choose_the_folders(spark, landed, condition, days):
    df = _read(spark, landed).where(condition)
    want = spark.createDataFrame(_read(spark, landed).collect(), df.schema).where(condition)
    assert sorted(tuple(r) for r in df.collect()) == sorted(tuple(r) for r in want.collect())
    reader = drops.DropReader(drops.Drops(landed, date(2024, 1, 1), date(2024, 1, 31), "*.parquet"), df.schema)
    files = len(reader.partitions())
    if days:  # unread days are no partitions
        assert _partitions(df) == files * days // 3


def test_a_given_schema_fills_absent_columns(spark, landed):
    df = spark.read.format("drops").schema("more int, id bigint, drop_date date").options(first="2024-01-04", last="2024-02-02").load(landed)
    got = sorted((str(r.drop_date), r.id, r.more) for r in df.collect())
    assert got == [("2024-01-04", 0, None), ("2024-01-04", 1, None), ("2024-02-01", 0, 9)]


def test_a_stream_takes_new_days_only(spark, landed, scratch):
    out, checkpoint = scratch("out"), scratch("checkpoint")

    def run(last):
        events = spark.readStream.format("drops").schema("id bigint, d string, drop_date date").options(first="2024-01-01", last=last).load(landed)
        q = events.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        q.awaitTermination()
        return spark.read.schema("id bigint, d string, drop_date date").parquet(out).count()

    assert run("2024-01-02") == 3
    assert run("2024-01-03") == 8
    assert run("2024-01-31") == 10
    assert run("2024-01-31") == 10


def test_faults_are_told(spark, landed, scratch):
    with pytest.raises(Exception, match="'first'"):
        spark.read.format("drops").load(landed)
    with pytest.raises(Exception, match="nothing landed"):
        _read(spark, scratch("none") + "/{day}")
    with pytest.raises(Exception, match="Unknown placeholder"):
        _read(spark, "/x/{week}")
