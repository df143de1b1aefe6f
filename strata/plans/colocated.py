"""Facts that are joined day by day, stored bucketed by their join key.

Tables written by ``store`` share a bucketing, so a join on the key reads bucket by bucket
and shuffles neither side; each bucket is sorted by the key already.  The tables are
external: their files are at a path, the catalog holds the bucketing."""

from __future__ import annotations

import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame

from ..sinks.keyed_table import buckets_for


def store(frames: Mapping[str, DataFrame], key: str, path: str, buckets: int) -> dict[str, DataFrame]:
    """Write each frame bucketed by ``key``; the tables, to be joined without a shuffle."""
    out = {}
    for name, df in frames.items():
        spark, table = df.sparkSession, f"{name}_{uuid.uuid4().hex[:12]}"
        # One shuffle now: a bucket is one file, not one per writing task.
        writer = df.repartition(buckets, key).write.format("parquet").option("path", f"{path}/{name}")
        writer.bucketBy(buckets, key).sortBy(key).saveAsTable(table)
        out[name] = spark.table(table)
    return out


def buckets_of(*frames: DataFrame) -> int:
    """For the largest of the frames, which are to be stored tables: counts read no columns."""
    return max(buckets_for(df.count()) for df in frames)
