"""Keyed (upsertable) Parquet tables.

Layout::

    <path>/data/<version>/key_bucket=<b>/part-*.parquet   rows of bucket b, as of a version
    <path>/_commits/<n>/                                  one JSON row per commit

A commit names the key, the bucket count, the schema, and for every bucket the
version folder that holds it and its rows, and those of rows appended since.  The newest complete commit (its
``_SUCCESS`` is there) *is* the table; nothing it points to is ever changed in
place.  A merge writes new versions of the buckets it touches beside the old
ones and then one commit, so a crash at any point leaves the table as it was,
and a rerun of the batch finds it so.  Versions that no commit but the last two
needs are deleted after a commit; a reader that began before a merge thus still
finds its files until the merge after that.

An upsert touches only the buckets its batch hashes to:

1. the batch is staged once as Parquet under the shared scratch folder
   (``spark.checkpoint.dir``), so lost executors re-read files instead of
   recomputing the upstream joins; it is deleted after the commit;
2. the touched bucket ids -- at most the bucket count -- are collected;
3. those buckets are read, merged by ``upsert_frames`` and written, a large batch in a
   few passes (below).  Both sides are cut into slices of about ``ROWS_PER_TASK`` rows -- a second hash cuts each
   bucket -- and a slice is one partition by its number, so no two meet in a task.
   The join uses that partitioning as is: one scan and one shuffle per side.

Rows with a null key never match; they live in the bucket of their row's hash,
so they are spread over all buckets.  When a table outgrows its buckets fourfold
the next merge rewrites it with as many as it needs now; so each row is moved a
bounded number of times as the table grows, and merge tasks stay bounded.

A table of many rows is written in up to ``PASSES`` passes: a first write takes a part of
the staged files in each, a merge a part of the buckets.  The shuffle files of a pass go
when it ends, so the disk holds a part of the shuffle at a time.  Files hold their rows in
the order of the key, which makes them smaller.

Files are read with the commit's schema, so a column that a merge adds is null in all
buckets that the merge doesn't touch: only a changed type rewrites the others.  An
append adds files to the buckets of its rows.
"""

from __future__ import annotations

import json
import logging
import math
import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from ..operators.upsert import any_null, spread, upsert_frames
from ..session import freed_shuffles, held_setting, new_scratch_path, table_codec

log = logging.getLogger(__name__)

BUCKET = "key_bucket"
SPLIT = "key_split"
COMMITS, DATA = "_commits", "data"
ROWS_PER_BUCKET = 4_000_000
ROWS_PER_TASK = 250_000
ROWS_PER_PASS = 4_000_000
PASSES = 4
MAX_BUCKETS = 16_384
OUTGROWN = 4


@dataclass(frozen=True)
class TableMeta:
    commit: int
    keys: list[str]
    buckets: int
    schema_json: str
    places: dict[int, tuple[str, int]] = field(default_factory=dict)  # bucket -> (version, rows)
    added: dict[int, list[tuple[str, int]]] = field(default_factory=dict)  # and what was appended to it since

    def parts(self, bucket: int) -> list[tuple[str, int]]:
        return [self.places[bucket], *self.added.get(bucket, [])]

    @property
    def rows(self) -> int:
        return sum(n for b in self.places for _, n in self.parts(b))

    @property
    def splits(self) -> int:
        return splits_for(self.rows, self.buckets)

    @property
    def schema(self) -> StructType:
        return StructType.fromJson(json.loads(self.schema_json))


def bucket_of(df: DataFrame, keys: Sequence[str], buckets: int) -> Column:
    key_hash = F.xxhash64(*[F.col(k) for k in keys])
    return F.pmod(F.when(any_null(keys), spread(df, keys)).otherwise(key_hash), F.lit(buckets)).cast("int")


def split_of(df: DataFrame, keys: Sequence[str], splits: int) -> Column:
    # murmur3, independent of the bucket's xxhash64
    key_hash = F.hash(*[F.col(k) for k in keys], spread(df, keys))
    return F.pmod(key_hash, F.lit(splits)).cast("int")


def splits_for(rows: int, buckets: int) -> int:
    return max(1, math.ceil(rows / buckets / ROWS_PER_TASK))


def slice_of(split: Column, splits: int, touched: Sequence[int] | None = None) -> Column:
    """Number of a row's slice, without gaps over the given (or all) buckets; the row has ``BUCKET``."""
    place = F.col(BUCKET)
    if touched is not None:
        order = {b: k for k, b in enumerate(touched)}
        place = F.get(F.array(*[F.lit(order.get(b, 0)) for b in range(max(order) + 1)]), place)
    return (place * F.lit(splits) + split).cast("int")


def buckets_for(rows: int) -> int:
    return int(min(MAX_BUCKETS, max(1, math.ceil(rows / ROWS_PER_BUCKET))))


def passes_for(rows: int) -> int:
    return int(min(PASSES, max(1, math.ceil(rows / ROWS_PER_PASS))))


# ---- folders ------------------------------------------------------------------


def _fs(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def _children(spark: SparkSession, path: str) -> list[str]:
    fs, where = _fs(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(where)) if fs.exists(where) else []


def _exists(spark: SparkSession, path: str) -> bool:
    fs, where = _fs(spark, path)
    return fs.exists(where)


def delete_folder(spark: SparkSession, path: str) -> None:
    fs, where = _fs(spark, path)
    fs.delete(where, True)


def stage(df: DataFrame, path: str) -> None:
    """Write a frame to be read more than once, for a while."""
    df.write.mode("append").option("compression", table_codec(df.sparkSession)).parquet(path)


def staged_parts(spark: SparkSession, path: str, schema: StructType, n: int) -> list[DataFrame]:
    """The rows of a staged frame in up to ``n`` parts of about the same size, by whole files."""
    fs, where = _fs(spark, path)
    files = [(s.getPath().toString(), s.getLen()) for s in fs.listStatus(where) if s.getPath().getName()[0] not in "._"]
    parts, total, before = [[] for _ in range(n)], sum(size for _, size in files), 0
    for name, size in sorted(files):
        parts[min(n - 1, before * n // max(total, 1))].append(name)
        before += size
    return [spark.read.schema(schema).parquet(*names) for names in parts if names] or [spark.read.schema(schema).parquet(path)]


# ---- commits ------------------------------------------------------------------


def read_meta(spark: SparkSession, path: str) -> TableMeta | None:
    """The newest complete commit; None if there is no table.  Data without any
    commit is not a table, and not free to be taken for a new one either."""
    root = path.rstrip("/")
    names = _children(spark, f"{root}/{COMMITS}")
    for name in reversed(names):
        if not _exists(spark, f"{root}/{COMMITS}/{name}/_SUCCESS"):
            continue
        doc = json.loads(spark.read.text(f"{root}/{COMMITS}/{name}").first()[0])
        if doc.get("creating"):
            return None
        places = {int(b): (v, int(n)) for b, (v, n) in doc["places"].items()}
        added = {int(b): [(v, int(n)) for v, n in parts] for b, parts in doc.get("added", {}).items()}
        return TableMeta(int(name), doc["keys"], doc["buckets"], doc["schema"], places, added)
    if not names and _children(spark, f"{root}/{DATA}"):
        raise RuntimeError(f"{root} holds data but no commits; restore {COMMITS} or move the data away")
    return None


def _commit(spark: SparkSession, path: str, number: int, doc: dict) -> None:
    """Publish.  Two writers of one number: the second fails."""
    target = f"{path.rstrip('/')}/{COMMITS}/{number:08d}"
    if not _exists(spark, f"{target}/_SUCCESS"):
        delete_folder(spark, target)  # what a crashed commit left
    spark.createDataFrame([(json.dumps(doc),)], "doc string").coalesce(1).write.mode("errorifexists").text(target)


def _announce(spark: SparkSession, path: str) -> None:
    """Mark a first write, so that a crash before its commit doesn't look like lost commits."""
    if not _children(spark, f"{path.rstrip('/')}/{COMMITS}"):
        _commit(spark, path, 0, {"creating": True})


def _publish(spark: SparkSession, path: str, meta: TableMeta) -> None:
    _commit(
        spark, path, meta.commit,
        {"keys": meta.keys, "buckets": meta.buckets, "schema": meta.schema_json, "places": meta.places, "added": meta.added},
    )


def _sweep(spark: SparkSession, path: str, before: TableMeta | None, now: TableMeta) -> None:
    """Delete versions that neither this commit nor the one before needs."""
    root = path.rstrip("/")
    used = {v for m in (before, now) if m is not None for b in m.places for v, _ in m.parts(b)}
    for version in _children(spark, f"{root}/{DATA}"):
        if version not in used:
            delete_folder(spark, f"{root}/{DATA}/{version}")


def table_exists(spark: SparkSession, path: str) -> bool:
    return read_meta(spark, path) is not None


def _read_buckets(spark: SparkSession, path: str, meta: TableMeta, only: Sequence[int] | None = None) -> DataFrame:
    """Rows of the given (or all) buckets, with ``BUCKET``."""
    root = f"{path.rstrip('/')}/{DATA}"
    wanted = sorted(meta.places if only is None else set(only) & set(meta.places))
    schema = StructType([*meta.schema.fields, StructField(BUCKET, IntegerType()), StructField("version__", StringType())])
    if not wanted:
        return spark.createDataFrame([], schema).drop("version__")
    paths = [f"{root}/{version}/{BUCKET}={b}" for b in wanted for version, _ in meta.parts(b)]
    return spark.read.schema(schema).option("basePath", root).parquet(*paths).drop("version__")


def read_keyed_table(spark: SparkSession, path: str, fallback=None) -> DataFrame:
    """Current rows of a keyed table (raises ``PATH_NOT_FOUND`` if absent).  The
    schema comes from the commit: no footer scan, and an empty table reads as an
    empty frame.  A folder that is no keyed table is read as plain Parquet (with
    the ``fallback`` reader when given)."""
    meta = read_meta(spark, path)
    if meta is None:
        return (fallback or spark.read).parquet(path)  # raises PATH_NOT_FOUND if absent
    return _read_buckets(spark, path, meta).drop(BUCKET)


def _co_partitioned_join(spark: SparkSession):
    """Let a join on (bucket, split, key) use inputs hash-partitioned by
    (bucket, split) as they are.  Spark otherwise re-shuffles on all join
    keys (``requireAllClusterKeysForCoPartition``, a guard against skew from
    low-cardinality partial keys); (bucket, split) slices are balanced by
    construction, so the guard only costs a second shuffle per side."""
    return held_setting(spark, "spark.sql.requireAllClusterKeysForCoPartition", "false")


def _in_buckets(df: DataFrame, keys: Sequence[str], buckets: int, rows: int | None = None) -> DataFrame:
    """With ``BUCKET``, one bucket's rows to a writer.  Where the number of rows is told (of
    a staged frame), a bucket's rows are dealt out in turn to as many writers as it has
    slices, however often a key is repeated; else AQE splits a bucket that is too large."""
    df = df.withColumn(BUCKET, bucket_of(df, keys, buckets))
    if rows is None:
        return df.hint("rebalance", BUCKET)
    splits = splits_for(rows, buckets)
    turn = F.pmod(F.monotonically_increasing_id(), F.lit(splits))
    return df.withColumn(SPLIT, slice_of(turn, splits)).repartitionById(buckets * splits, F.col(SPLIT)).drop(SPLIT)


def _write_version(frames: Sequence[DataFrame], path: str, keys: Sequence[str]) -> dict[int, tuple[str, int]]:
    """Write rows with ``BUCKET``, frame after frame, as a new version; where each bucket is and its rows."""
    spark = frames[0].sparkSession
    version = f"version__={uuid.uuid4().hex}"
    at = f"{path.rstrip('/')}/{DATA}/{version}"
    with freed_shuffles(spark):
        for df in frames:  # the writer sorts by bucket anyway
            rows = df.sortWithinPartitions(BUCKET, *[F.col(k) for k in keys])
            rows.write.mode("append").option("compression", table_codec(spark)).partitionBy(BUCKET).parquet(at)
    schema = StructType([StructField(BUCKET, IntegerType())])
    # Reads file footers only: no column is needed for a count per partition value.
    counts = spark.read.schema(schema).parquet(at).groupBy(BUCKET).agg(F.count(F.lit(1)).alias("n")).collect()
    return {r[BUCKET]: (version, r["n"]) for r in counts}


def _with_columns_of(table: StructType, batch: StructType) -> StructType:
    """The table's columns, then those that only the batch has."""
    known = set(table.names)
    return StructType([*table.fields, *(f for f in batch.fields if f.name not in known)])


def retyped(table: StructType, batch: StructType) -> list[str]:
    return [f.name for f in batch.fields if f.name in table.names and table[f.name].dataType != f.dataType]


def write_keyed_table(
    df: DataFrame,
    path: str,
    key: str | Sequence[str],
    mode: str = "overwrite",
    buckets: int | None = None,
) -> None:
    """Create/replace (``overwrite``) or add rows to (``append``) a keyed
    table; ``errorifexists`` raises and ``ignore`` does nothing when it exists.  A new
    table gets ``buckets`` buckets, or one per ``ROWS_PER_BUCKET`` rows."""
    if mode not in ("overwrite", "append", "errorifexists", "error", "ignore"):
        raise ValueError(f"Unsupported mode '{mode}' for a keyed table")
    spark = df.sparkSession
    keys = [key] if isinstance(key, str) else list(key)
    meta = read_meta(spark, path)
    if meta is not None and mode in ("errorifexists", "error"):
        raise ValueError(f"table already exists at {path}")
    if meta is not None and mode == "ignore":
        return
    if meta is not None and mode == "append":
        changed = retyped(meta.schema, df.schema)
        if changed:
            raise ValueError(f"append changes the type of {changed} in {path}")
        # Files are added to the buckets; what they hold already stays as it is.
        new = _write_version([_in_buckets(df, keys, meta.buckets)], path, keys)
        added = meta.added | {b: [*meta.added.get(b, []), p] for b, p in new.items() if b in meta.places}
        schema = _with_columns_of(meta.schema, df.schema).json()
        after = TableMeta(meta.commit + 1, keys, meta.buckets, schema, new | meta.places, added)
        _publish(spark, path, after)
        _sweep(spark, path, meta, after)
        return
    if buckets is None:  # staged to be counted, not computed twice
        staging = new_scratch_path(spark, "keyed-write")
        try:
            with freed_shuffles(spark):
                stage(df, staging)
                rows = spark.read.schema(df.schema).parquet(staging).count()
                frames = _staged_in_buckets(spark, staging, df.schema, keys, buckets_for(rows), rows)
                return _replace(frames, df.schema, path, keys, meta, buckets_for(rows))
        finally:
            delete_folder(spark, staging)
    _replace([_in_buckets(df, keys, buckets)], df.schema, path, keys, meta, buckets)


def _staged_in_buckets(spark: SparkSession, staging: str, schema: StructType, keys: Sequence[str], buckets: int, rows: int) -> list[DataFrame]:
    """A staged frame with ``BUCKET``, in passes."""
    parts = staged_parts(spark, staging, schema, passes_for(rows))
    return [_in_buckets(part, keys, buckets, math.ceil(rows / len(parts))) for part in parts]


def _replace(frames: Sequence[DataFrame], schema: StructType, path: str, keys: list[str], meta: TableMeta | None, buckets: int) -> None:
    spark = frames[0].sparkSession
    if meta is None:
        _announce(spark, path)
    places = _write_version(frames, path, keys)
    after = TableMeta(meta.commit + 1 if meta else 1, keys, buckets, schema.json(), places)
    _publish(spark, path, after)
    _sweep(spark, path, meta, after)


@dataclass
class MergeResult:
    rows_in_batch: int
    buckets_touched: int
    first_write: bool


def merge_into(
    source: DataFrame,
    path: str,
    key: str | Sequence[str],
    buckets: int | None = None,
    check_unique: bool = True,
    version: str | None = None,
    check=None,
    after_commit=None,
) -> MergeResult:
    """Upsert ``source`` into the keyed table at ``path`` (created if absent; a new
    table gets ``buckets`` buckets, or one per ``ROWS_PER_BUCKET`` rows of this
    batch).  ``version`` names a column by which older rows never replace newer
    ones.  ``check()`` is called when the batch is staged and may raise;
    ``after_commit(batch, before, after)`` gets the staged batch and the table's
    metadata before (None for a new table) and after the commit."""
    spark = source.sparkSession
    keys = [key] if isinstance(key, str) else list(key)
    meta = read_meta(spark, path)
    if meta is not None and meta.keys != keys:
        raise ValueError(f"table at {path} is keyed by {meta.keys}, not {keys}")

    staging = new_scratch_path(spark, "merge-batch")
    try:
        with freed_shuffles(spark):
            stage(source, staging)
            if check is not None:
                check()
            batch = spark.read.schema(source.schema).parquet(staging)
            result = _merge_staged(batch, staging, path, keys, meta, buckets, check_unique, version)
            if after_commit is not None:
                after_commit(batch, meta, read_meta(spark, path))
        return result
    finally:
        delete_folder(spark, staging)


def _batch_profile(batch: DataFrame, keys: Sequence[str], buckets: int, check_unique: bool) -> tuple[int, list[int], bool]:
    """Rows, the buckets they belong to, and whether a key is repeated: one job."""
    in_bucket = batch.select(*keys, bucket_of(batch, keys, buckets).alias(BUCKET))
    if check_unique:
        per_key = in_bucket.groupBy(BUCKET, *keys).agg(F.count(F.lit(1)).alias("n"))
        repeated = F.max((F.col("n") > 1) & ~any_null(keys))
    else:
        per_key = in_bucket.groupBy(BUCKET).agg(F.count(F.lit(1)).alias("n"))
        repeated = F.lit(False)
    found = per_key.groupBy(BUCKET).agg(F.sum("n").alias("n"), repeated.alias("repeated")).collect()
    return sum(r["n"] for r in found), sorted(r[BUCKET] for r in found), any(r["repeated"] for r in found)


def bucket_passes(touched: list[int], meta: TableMeta, rows: int = 0) -> list[list[int]]:
    """The touched buckets, which hold these rows besides the table's, a part of them to a pass."""
    held = sum(n for b in touched if b in meta.places for _, n in meta.parts(b))
    n = min(len(touched), passes_for(held + rows))
    return [touched[k * len(touched) // n : (k + 1) * len(touched) // n] for k in range(n)]


def _merge_staged(batch, staging, path, keys, meta, buckets, check_unique, version) -> MergeResult:
    spark = batch.sparkSession
    rows, touched, repeated = _batch_profile(batch, keys, meta.buckets if meta else 1, check_unique)
    if repeated:
        raise ValueError(f"upsert: several source rows share a key in {keys}; deduplicate the batch first")

    if meta is None:
        n = buckets or buckets_for(rows)
        _announce(spark, path)
        places = _write_version(_staged_in_buckets(spark, staging, batch.schema, keys, n, rows), path, keys)
        after = TableMeta(1, keys, n, batch.schema.json(), places)
        _publish(spark, path, after)
        _sweep(spark, path, None, after)
        return MergeResult(rows, n, True)
    if rows == 0:
        return MergeResult(0, 0, False)

    wanted = buckets_for(meta.rows + rows)
    n = wanted if wanted >= OUTGROWN * meta.buckets else meta.buckets
    changed = retyped(meta.schema, batch.schema)
    staged = batch.withColumn(BUCKET, bucket_of(batch, keys, n))
    if changed or n != meta.buckets:
        # Every file keeps one type per column and one bucket count: rewrite all buckets.
        log.info("upsert retypes %s / %d -> %d buckets: rewriting all", changed, meta.buckets, n)
        touched, passes = None, [None]
    else:
        passes = bucket_passes(touched, meta, rows)

    splits = splits_for(meta.rows + rows, n)
    guard = version if version in meta.schema.names and version in batch.columns else None

    def merged_in(only: list[int] | None) -> DataFrame:
        target = _read_buckets(spark, path, meta, only)
        if only is None:
            target = target.drop(BUCKET)
            target = target.withColumn(BUCKET, bucket_of(target, keys, n))
        own = staged if len(passes) == 1 else staged.where(F.col(BUCKET).isin(only))
        parts = (n if only is None else len(only)) * splits
        sides = [df.withColumn(SPLIT, slice_of(split_of(df.drop(BUCKET), keys, splits), splits, only)) for df in (target, own)]
        sides = [df.repartitionById(parts, F.col(SPLIT)) for df in sides]
        return upsert_frames(*sides, keys, co_keys=[BUCKET, SPLIT], version=guard).drop(SPLIT)

    frames = [merged_in(only) for only in passes]
    with _co_partitioned_join(spark):
        places = _write_version(frames, path, keys)
    schema = frames[0].drop(BUCKET).schema if touched is None else _with_columns_of(meta.schema, batch.schema)
    stay = {} if touched is None else {b: p for b, p in meta.places.items() if b not in places}
    after = TableMeta(meta.commit + 1, keys, n, schema.json(), stay | places, {b: p for b, p in meta.added.items() if b in stay})
    _publish(spark, path, after)
    _sweep(spark, path, meta, after)
    return MergeResult(rows, n if touched is None else len(touched), False)
