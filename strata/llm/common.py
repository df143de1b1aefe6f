"""Small helpers the operators share: reading tables, staging them, ASCII lower case."""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import new_scratch_path

TEXT_UPPER, TEXT_LOWER = string.ascii_uppercase, string.ascii_lowercase


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` under ``spark.checkpoint.dir`` and read it back: cuts the
    lineage and survives lost executors."""
    spark = df.sparkSession
    path = new_scratch_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def ascii_lower(text: Column) -> Column:
    """A-Z to a-z and nothing else.  Pure ASCII text takes ``lower``, which is
    the same there and much cheaper than ``translate``."""
    return F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(
        F.translate(text, TEXT_UPPER, TEXT_LOWER)
    )
