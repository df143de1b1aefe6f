"""What the runs leave on disk, and for how long: shuffle files, codecs, writes and joins in passes."""

import re
import time
from datetime import date, timedelta

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from strata.plans import change_feed, lineage, passes
from strata.plans import pipeline as P
from strata.session import freed_shuffles, held_setting, scratch_root
from strata.sinks import keyed_table as K

DAY = date(2024, 1, 1)
FREED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def _shuffles(spark):
    """Numbers of the shuffles that have files on disk."""
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    names = [files.apply(k).getName() for k in range(files.size())]
    return {int(m[1]) for m in (re.match(r"shuffle_(\d+)_.*data", n) for n in names) if m}


def _left(spark, before):
    """Shuffles since then that still have files; they are deleted a moment after their query."""
    for _ in range(50):
        left = {s for s in _shuffles(spark) if s > max(before, default=-1)}
        if not left:
            break
        time.sleep(0.1)
    return left


def _shuffled(spark, n, value=1.0):
    return spark.range(n).repartition(3).groupBy(F.col("id").cast("string").alias("k")).agg(F.lit(value).alias("v"))


def _files(spark, path):
    return sorted(f.removeprefix("file:").replace("///", "/") for f in spark.read.parquet(path).inputFiles())


def test_shuffle_files_go_with_their_query(spark, scratch):
    path, before = scratch("tbl"), _shuffles(spark) | {spark.sparkContext._jsc.sc().newShuffleId()}
    K.merge_into(_shuffled(spark, 1000), path, "k", buckets=4)
    K.merge_into(_shuffled(spark, 1100, 2.0), path, "k")
    K.write_keyed_table(_shuffled(spark, 1000), scratch("written"), "k")
    assert _left(spark, before) == set()
    assert K.read_keyed_table(spark, path).where("v = 2").count() == 1100


def test_a_run_frees_the_shuffles_of_all_its_layers(spark, scratch):
    root, before = scratch("lake"), {spark.sparkContext._jsc.sc().newShuffleId()}
    layout = P.LakeLayout(raw=f"{root}/raw", lake=f"{root}/lake")
    P.land_raw(layout, DAY, {"retail_products": _shuffled(spark, 500).select(F.col("k").alias("product_id"), F.lit("c").alias("category"))})
    jobs = [j for j in P.retail_jobs(layout) if j["dataset"] == "retail_products"]
    gold = {"dataset": "g", "source": {"format": "table", "path": layout.silver("retail_products")}, "aggregation": {"group_by": ["category"], "metrics": [["n", "count_distinct", "product_id"]]},
            "sink": {"format": "parquet", "path": layout.gold("g")}}
    assert P.run_configs(spark, jobs, [gold], layout.ledger, DAY) == 0
    assert _left(spark, before) == set()
    assert [tuple(r) for r in spark.read.parquet(layout.gold("g")).collect()] == [("c", 500)]
    assert spark.conf.get(FREED) == "false"


def test_a_held_setting_is_restored_by_the_last(spark):
    key = "spark.strata.test"
    with held_setting(spark, key, "a"):
        with held_setting(spark, key, "a"), freed_shuffles(spark):
            assert spark.conf.get(key) == "a" and spark.conf.get(FREED) == "true"
        assert spark.conf.get(key) == "a" and spark.conf.get(FREED) == "false"
    assert spark.conf.get(key, None) is None
    spark.conf.set(key, "own")
    with pytest.raises(ZeroDivisionError), held_setting(spark, key, "a"):
        1 / 0
    assert spark.conf.get(key) == "own"
    spark.conf.unset(key)


def test_tables_are_kept_small(spark, scratch):
    """zstd unless the session or the sink says otherwise; rows in the order of the key."""
    def codec(path):
        return {pq.ParquetFile(f).metadata.row_group(0).column(0).compression for f in _files(spark, path)}

    path = scratch("tbl")
    K.merge_into(_shuffled(spark, 1000), path, "k", buckets=2)
    K.merge_into(_shuffled(spark, 900, 2.0), path, "k")
    assert codec(f"{path}/data") == {"ZSTD"}
    for f in _files(spark, f"{path}/data"):
        keys = pq.ParquetFile(f).read(["k"])["k"].to_pylist()
        assert len(keys) > 1 and keys == sorted(keys)
    src, out = scratch("src"), scratch("out")
    _shuffled(spark, 10).write.parquet(src)
    spec = {"dataset": "t", "source": {"format": "parquet", "path": src}, "sink": {"format": "parquet", "path": out}}
    P.run_dataset(spark, spec)
    assert codec(out) == {"ZSTD"}
    P.run_dataset(spark, spec | {"sink": {**spec["sink"], "options": {"compression": "gzip"}}})
    assert codec(out) == {"GZIP"}
    with held_setting(spark, "spark.sql.parquet.compression.codec", "snappy"):
        P.run_dataset(spark, spec)
    assert codec(out) == {"SNAPPY"}


@pytest.fixture()
def passes_of_100(monkeypatch):
    """Small passes; how many frames each version was written from."""
    monkeypatch.setattr(K, "ROWS_PER_PASS", 100)
    monkeypatch.setattr(K, "ROWS_PER_TASK", 30)
    seen = []

    def write(frames, *args, f=K._write_version):
        seen.append(len(frames))
        return f(frames, *args)

    monkeypatch.setattr(K, "_write_version", write)
    return seen


def test_tables_written_in_passes(spark, scratch, passes_of_100):
    """First write, merges by buckets, growth to more buckets and a replaced table: the same rows,
    repeated null keys among them."""
    def rows(lo, hi, v):
        ids = spark.range(lo, hi, numPartitions=5)
        return ids.select(F.when(F.col("id") % 10 != 0, F.col("id").cast("string")).alias("k"), F.lit(v).alias("v"))

    def held():
        table = K.read_keyed_table(spark, path)
        return {(r.k, r.v) for r in table.where("k is not null").collect()}, table.where("k is null").count()

    path = scratch("tbl")
    K.merge_into(rows(0, 350, 1), path, "k", buckets=8)
    K.merge_into(rows(300, 500, 2), path, "k")
    want = {(str(i), 1 if i < 300 else 2) for i in range(500) if i % 10}
    assert held() == (want, 55) and passes_of_100 == [4, 4]
    meta = K.read_meta(spark, path)
    assert meta.rows == 505 and sorted(meta.places) == list(range(8)) and len({v for v, _ in meta.places.values()}) == 1
    K.merge_into(rows(498, 499, 3), path, "k")  # one bucket
    assert held() == (want - {("498", 2)} | {("498", 3)}, 55) and passes_of_100[2:] == [1]
    K.merge_into(rows(0, 20, 4).withColumn("v", F.col("v").cast("long")), path, "k")  # rewritten as a whole
    assert held()[0] == {(k, 4 if int(k) < 20 else v) for k, v in want - {("498", 2)} | {("498", 3)}} and passes_of_100[3:] == [1]
    K.write_keyed_table(rows(0, 250, 5), path, "k")
    assert held() == ({(str(i), 5) for i in range(250) if i % 10}, 25) and passes_of_100[4:] == [3]
    K.write_keyed_table(rows(0, 250, 5).limit(0), path, "k")
    assert held() == (set(), 0) and K.read_meta(spark, path).rows == 0


def test_parts_of_a_staged_frame(spark, scratch):
    path, schema = scratch("staged"), spark.range(1).schema
    K.stage(spark.range(0, 1000, numPartitions=7), path)
    for n in (1, 3, 7, 20):
        parts = K.staged_parts(spark, path, schema, n)
        ids = [[r.id for r in p.collect()] for p in parts]
        assert len(parts) == min(n, 7) and sorted(sum(ids, [])) == list(range(1000)) and all(ids)


LOOKUP = {"format": "parquet", "on": "c"}


@pytest.mark.parametrize("joins, not_null, merge", [
    ([LOOKUP], ["o"], True),
    ([LOOKUP | {"select": ["c", "name"]}, {"format": "parquet", "on": "p", "latest": True, "select": ["p", "price"]}], ["o", "name"], True),
    ([LOOKUP | {"type": "inner"}], ["o"], False),
    ([LOOKUP | {"type": "left_anti"}], ["o"], False),
])
@pytest.mark.parametrize("since", [None, DAY])
def test_joins_in_passes(spark, scratch, monkeypatch, passes_of_100, joins, not_null, merge, since):
    """A large batch joined part by part gives the rows of the joins as a whole, several rows per
    lookup key, rows without a match and several versions of a key included; no staged rows stay."""
    src, names, prices = scratch("src"), scratch("names"), scratch("prices")
    ids = spark.range(0, 800, numPartitions=4)
    landed = F.date_add(F.lit(DAY), (F.col("id") % 3).cast("int")).alias("ingestion_date")
    ids.select((F.col("id") % 600).cast("string").alias("o"), (F.col("id") % 7).alias("c"), (F.col("id") % 50).alias("p"), "id", landed) \
        .write.partitionBy("ingestion_date").parquet(src)
    ids.where("id < 10").select((F.col("id") % 5).alias("c"), F.when(F.col("id") != 3, F.col("id").cast("string")).alias("name")).write.parquet(names)
    ids.where("id < 90").select((F.col("id") % 45).alias("p"), F.col("id").alias("price"), landed).write.partitionBy("ingestion_date").parquet(prices)
    sink = {"format": "table", "path": scratch("out"), "mode": "merge", "merge_key": "o"} if merge else {"format": "parquet", "path": scratch("out")}
    options = {"incremental_from": str(since), "incremental_date": str(since)} if since else {}
    spec = {"dataset": "t", "source": {"format": "parquet", "path": src, "options": options}, "sink": sink, "not_null": not_null, "unique": ["o"],
            "joins": [j | {"path": {"c": names, "p": prices}[j["on"]]} for j in joins]}
    want = sorted(map(str, P.build_frame(spark, spec)[0].collect()))
    parts = []

    def part_of(*args, f=passes.staged_parts):
        parts.extend(f(*args))
        return parts

    monkeypatch.setattr(passes, "staged_parts", part_of)
    monkeypatch.setattr(passes, "BYTES", 1)
    with held_setting(spark, "spark.sql.adaptive.coalescePartitions.enabled", "false"):
        assert P.run_dataset(spark, spec).rows == len(want)
    got = K.read_keyed_table(spark, sink["path"]) if merge else spark.read.parquet(sink["path"])
    assert sorted(map(str, got.collect())) == want and len(parts) > 1
    assert not [n for n in K._children(spark, scratch_root(spark)) if re.match("batch-|joined-|merge-batch-", n)]
    assert spark.conf.get(FREED) == "false"


def test_only_large_batches_of_lookups_are_joined_in_passes(spark, scratch):
    src = scratch("src")
    for k in range(3):
        spark.range(1000 * 4**k).withColumn("ingestion_date", F.lit(DAY + timedelta(k))).write.mode("append").partitionBy("ingestion_date").parquet(src)

    def spec(kind="left", options=None):
        return P.DatasetSpec("t", {"format": "parquet", "path": src, "options": options or {}}, {"format": "parquet", "path": "x"},
                             joins=[{"format": "parquet", "path": "y", "on": "id", "type": kind}])

    day = lambda since, run: passes.landed_bytes(spark, spec(options={"incremental_from": str(since), "incremental_date": str(run)}))
    first, second, third = DAY, DAY + timedelta(1), DAY + timedelta(2)
    whole = passes.landed_bytes(spark, spec())
    assert 0 < day(third, first) < day(second, third) < day(first, second) < whole == day(first, first)
    assert passes.Passes.of(spark, spec()) is None
    for path in (f"{src}/none", "jdbc:postgresql://h/db", "no such:scheme", "public.orders"):
        assert passes.landed_bytes(spark, P.DatasetSpec("t", {"format": "parquet", "path": path}, {})) == 0
    for kind, wanted in (("left", True), ("leftsemi", True), ("full", False), ("right", False)):
        with pytest.MonkeyPatch.context() as m:
            m.setattr(passes, "BYTES", whole)
            assert (passes.Passes.of(spark, spec(kind)) is not None) == wanted


def test_changes_written_in_passes(spark, scratch, passes_of_100, monkeypatch):
    """The feed of a large table's commit has each row as it was and is, and rows with null keys;
    it is complete only when all its passes are there."""
    path = scratch("tbl")
    rows = lambda lo, hi, v: spark.range(lo, hi).select(F.when(F.col("id") >= 0, F.col("id").cast("string")).alias("k"), F.lit(v).alias("v"))
    K.merge_into(rows(0, 400, 1), path, "k", buckets=8)
    K.merge_into(rows(-2, 500, 2), path, "k", after_commit=change_feed.recorder(path, "k"))
    want = [(str(k), 1, -1) for k in range(400)] + [(str(k), 2, 1) for k in range(500)] + [(None, 2, 1)] * 2

    def held(meta):
        return sorted((tuple(r) for r in change_feed.changes_of(spark, path, meta, meta.commit).collect()), key=str)

    meta = K.read_meta(spark, path)
    assert held(meta) == sorted(want, key=str)
    frames = change_feed.changed_rows(spark, path, ["k"], rows(-2, 500, 2), K.read_meta(spark, path), meta)
    assert len(frames) == 1  # nothing differs between a commit and itself

    def cut_short(*args, f=change_feed.changed_rows):
        found = f(*args)
        assert len(found) == 4
        return [*found[:2], found[2].select(F.raise_error(F.lit("cut short")))]

    monkeypatch.setattr(change_feed, "changed_rows", cut_short)
    with pytest.raises(Exception, match="cut short"):
        K.merge_into(rows(0, 500, 3), path, "k", after_commit=change_feed.recorder(path, "k"))
    meta = K.read_meta(spark, path)
    assert meta.commit == 3 and change_feed.changes_of(spark, path, meta, 3) is None


def test_readers_of_a_large_table_take_turns(spark, scratch, monkeypatch):
    """One after another, a failed one too; readers of others and small tables don't wait."""
    spec = lambda src, out, *joins: P.DatasetSpec("t", {"path": src}, {"path": out}, joins=[{"path": j} for j in joins])
    specs = {"a": spec("big", "x1"), "b": spec("big", "x2"), "c": spec("small", "x3"), "d": spec("big/", "x4"), "e": spec("small", "x5"), "f": spec("big", "x6", "x4")}
    waits = lineage.dependencies(specs)
    turns = lineage.taking_turns(waits, specs, lambda s: lineage.LARGE if "big" in s.source["path"] else 0)
    assert turns == {"a": set(), "b": {"a"}, "c": set(), "d": {"b"}, "e": set(), "f": {"d"}}
    src, root, ends = scratch("src"), scratch("gold"), []
    _shuffled(spark, 100).write.parquet(src)
    golds = [{"dataset": f"g{k}", "source": {"format": "parquet", "path": src}, "sink": {"format": "parquet", "path": f"{root}/{k}"},
              "aggregation": {"group_by": ["k" if k != 1 else "none"], "metrics": [["n", "count", "v"]]}} for k in range(3)]
    monkeypatch.setattr(lineage, "LARGE", 1)
    monkeypatch.setattr(P, "run_dataset", lambda s, c, f=P.run_dataset: (ends.append((c.dataset, "begins")), f(s, c), ends.append((c.dataset, "ends")))[1])
    P.run_configs(spark, [], golds, f"{root}/ledger", DAY, ["gold"])
    assert ends == [("g0", "begins"), ("g0", "ends"), ("g1", "begins"), ("g2", "begins"), ("g2", "ends")]
    assert spark.read.parquet(f"{root}/2").count() == 100
