"""What a merge changed: rows as they were (-1) and as they are now (+1).

For each commit of a followed keyed table a folder ``<table>_changes/<commit>`` holds the
pre- and post-images of the keys of its batch, so what derives from the table can be
brought up to date without reading it whole.  A row that the merge left as it was is there
twice and cancels out.  The feed is written after the commit; where it is missing (a crash,
a first write, a retyped column, another writer) readers are told so and start anew.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from ..operators.upsert import any_null
from ..session import freed_shuffles, table_codec
from ..sinks.keyed_table import BUCKET, TableMeta, _children, _exists, _read_buckets, bucket_passes, delete_folder, retyped

SIGN = "change__"
MARKED = "mapreduce.fileoutputcommitter.marksuccessfuljobs"
KEPT = 30  # commits; what lags further behind is built anew


def feed_path(table: str) -> str:
    return f"{table.rstrip('/')}_changes"


def changed_rows(spark: SparkSession, path: str, keys: Sequence[str], batch: DataFrame, before: TableMeta, after: TableMeta) -> list[DataFrame]:
    """Pre- and post-images of the batch's keys, some buckets to a frame.  Rows with a null
    key match nothing, so they were added."""
    touched = sorted(b for b in after.places if b not in before.places or before.parts(b) != after.parts(b))
    parts = [None] if before.buckets != after.buckets else bucket_passes(touched, after) or [[]]
    keyed = batch.where(~any_null(keys)).select(*keys)
    added = batch.where(any_null(keys)).withColumn(SIGN, F.lit(1))
    columns, out = [*after.schema.names, SIGN], []
    for buckets in parts:
        images = [
            _read_buckets(spark, path, meta, buckets).drop(BUCKET).join(keyed, list(keys), "left_semi").withColumn(SIGN, F.lit(sign))
            for meta, sign in ((after, 1), (before, -1))
        ]
        rows = images[0].unionByName(images[1], allowMissingColumns=True)
        out.append((rows if out else rows.unionByName(added, allowMissingColumns=True)).select(*columns))
    return out


def recorder(path: str, key: str | Sequence[str]) -> Callable:
    """For ``merge_into(after_commit=...)``."""
    keys = [key] if isinstance(key, str) else list(key)

    def record(batch: DataFrame, before: TableMeta | None, after: TableMeta) -> None:
        if before is None or after.commit == before.commit or retyped(before.schema, after.schema):
            return
        spark, feed = batch.sparkSession, feed_path(path)
        frames = changed_rows(spark, path, keys, batch, before, after)
        with freed_shuffles(spark):
            for k, rows in enumerate(frames, 1):
                writer = rows.write.mode("append" if k > 1 else "overwrite").option("compression", table_codec(spark))
                # Only the last makes the feed complete.
                writer.option(MARKED, str(k == len(frames)).lower()).parquet(f"{feed}/{after.commit:08d}")
        for old in _children(spark, feed)[:-KEPT]:
            delete_folder(spark, f"{feed}/{old}")

    return record


def changes_of(spark: SparkSession, path: str, meta: TableMeta, commit: int) -> DataFrame | None:
    """The changes of one commit, with ``SIGN``; None if they were not recorded."""
    folder = f"{feed_path(path)}/{commit:08d}"
    if not _exists(spark, f"{folder}/_SUCCESS"):
        return None
    return spark.read.schema(StructType([*meta.schema.fields, StructField(SIGN, IntegerType())])).parquet(folder)
