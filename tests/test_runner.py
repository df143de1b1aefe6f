"""Specs, order of the checks, lookups by newest version, concurrent datasets."""

import re
import time
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from strata.operators import cleaning as C
from strata.plans import pipeline as P
from strata.plans import versions as V
from strata.plans.ledger import FAILED, SUCCESS, RunLedger
from strata.plans.lineage import dependencies, run_all
from strata.plans.specs import DatasetSpec, SpecError
from strata.sinks import keyed_table as K

DAY = date(2024, 1, 1)


def test_every_fault_is_named():
    with pytest.raises(SpecError) as info:
        P.validate({
            "dataset": "d",
            "source": {"format": "excel", "path": "x/{week}"},
            "joins": [{"format": "parquet", "path": "p"}],
            "transformations": [{"name": "nonexistent"}, {}],
            "unique": "k",
            "refresh": "sometimes",
            "sink": {"format": "table", "mode": "merge"},
        })
    said = [f.split(":")[0] for f in info.value.faults]
    assert said == ["transformations[0].name", "transformations[1].name", "unique", "source.path", "source.format", "joins[0].on",
                    "sink.merge_key", "refresh"]
    with pytest.raises(ValueError, match=r"missing required key\(s\): source, sink"):
        P.validate({"dataset": "x"})


def test_specs_survive_their_configs():
    layout = P.LakeLayout("raw", "lake")
    for job in P.retail_jobs(layout):
        for spec in (P.bronze_spec(job, DAY), P.silver_spec(job, DAY)):
            assert DatasetSpec.parse(spec.as_config()) == spec


def _write(spark, path, rows, schema):
    spark.createDataFrame(rows, schema).write.parquet(path)
    return path


@pytest.mark.parametrize("join_type, not_null, want", [
    ("left", ["o"], {"o1": 2, "o2": 1}),
    ("left", ["o", "name"], {"o1": 1, "o2": 1}),
    ("inner", ["o"], {"o1": 1, "o2": 1}),
    ("left_semi", ["o"], {"o1": 1, "o2": 1}),
    ("left_anti", ["o"], {"o1": 2}),
])
def test_the_newest_row_is_taken_of_those_that_stay(spark, scratch, join_type, not_null, want):
    """o1 has an older version whose customer is known and a newer one whose is not."""
    rows = [("o1", "c1", 1, DAY), ("o1", "cx", 2, DAY + timedelta(1)), ("o2", "c1", 1, DAY)]
    src = _write(spark, scratch("src"), rows, "o string, c string, v int, ingestion_date date")
    names = _write(spark, scratch("names"), [("c1", "n1")], "c string, name string")
    spec = {"dataset": "t", "source": {"format": "parquet", "path": src}, "sink": {"format": "parquet", "path": scratch("out")},
            "joins": [{"format": "parquet", "path": names, "on": "c", "type": join_type}], "not_null": not_null, "unique": ["o"]}
    df, _ = P.build_frame(spark, spec)
    assert {r.o: r.v for r in df.collect()} == want


def test_steps_after_the_dedup(spark, scratch, monkeypatch):
    """A filter among the steps doesn't bring older rows back; a step that writes the key, or
    may write anything, is followed by another dedup."""
    rows = [("a", 1, DAY), ("a", None, DAY + timedelta(1)), ("A ", 5, DAY - timedelta(1)), ("b", 7, DAY)]
    src = _write(spark, scratch("src"), rows, "k string, v int, ingestion_date date")

    def run(*steps):
        spec = {"dataset": "t", "source": {"format": "parquet", "path": src}, "sink": {"format": "parquet", "path": "x"},
                "not_null": ["k"], "unique": ["k"], "post_join_transformations": list(steps)}
        return sorted((r.k, r.v) for r in P.build_frame(spark, spec)[0].collect())

    assert run({"name": "filter_nulls", "params": {"columns": ["v"]}}) == [("A ", 5), ("b", 7)]
    assert run({"name": "standardize_strings", "params": {"columns": ["k"]}}) == [("a", None), ("b", 7)]
    monkeypatch.setattr(C, "_TRANSFORMS", dict(C._TRANSFORMS))
    monkeypatch.setattr(C, "_WRITES", dict(C._WRITES))
    C.register_transform("all_one", lambda df: df.withColumn("k", F.lit("one")))
    assert len(run({"name": "all_one"})) == 1
    C.register_transform("noted", lambda df: df.withColumn("note", F.lit(1)), writes=lambda p: ["note"])
    assert C.written_columns({"name": "noted"}) == {"note"} and C.written_columns({"name": "all_one"}) is None
    assert len(run({"name": "noted"})) == 3


# ---- newest side


def _land(spark, path, day, rows, schema="o string, a string, b int"):
    df = spark.createDataFrame(rows, schema).withColumn("ingestion_date", F.lit(day).cast("date"))
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("ingestion_date").parquet(path)


def _side(spark, path, select):
    history = spark.read.option("mergeSchema", "true").parquet(path)
    side = V.newest_side(spark, history, path, {"on": "o", "select": select})
    return sorted(tuple(r) for r in side.drop("ingestion_date").collect())


def test_newest_side_follows_the_history(spark, scratch):
    path = scratch("bronze")
    _land(spark, path, DAY, [("1", "x", 1), ("2", "y", 2), (None, "n", 3)])
    assert _side(spark, path, ["a"]) == [("1", "x"), ("2", "y")]
    _land(spark, path, DAY + timedelta(2), [("2", "y2", 3), ("3", "z", 4)])
    assert _side(spark, path, ["a"]) == [("1", "x"), ("2", "y2"), ("3", "z")]
    # an older day filled in later: new keys only
    _land(spark, path, DAY + timedelta(1), [("2", "old", 9), ("4", "w", 9)])
    assert _side(spark, path, ["a"]) == [("1", "x"), ("2", "y2"), ("3", "z"), ("4", "w")]
    # a day landed again without a key: the version before counts again
    _land(spark, path, DAY + timedelta(2), [("3", "zz", 4)])
    assert _side(spark, path, ["a"]) == [("1", "x"), ("2", "old"), ("3", "zz"), ("4", "w")]
    # another lookup's columns, then a column that appears later
    assert _side(spark, path, ["b"]) == [("1", 1), ("2", 9), ("3", 4), ("4", 9)]
    _land(spark, path, DAY + timedelta(3), [("1", "x9", 9, "new")], "o string, a string, b int, c string")
    assert _side(spark, path, ["a", "c"]) == [("1", "x9", "new"), ("2", "old", None), ("3", "zz", None), ("4", "w", None)]


def test_a_days_lookup_scans_only_that_day(spark, scratch, monkeypatch):
    path, plans = scratch("bronze"), []

    def merge(df, *args, f=V.merge_into, **more):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return f(df, *args, **more)

    monkeypatch.setattr(V, "merge_into", merge)
    for k in range(5):
        _land(spark, path, DAY + timedelta(k), [("1", f"v{k}", k), (f"k{k}", "x", k)])
        side = dict(_side(spark, path, ["a"]))
        assert side["1"] == f"v{k}" and len(side) == k + 2
    days = [re.findall(r"PartitionFilters: \[.*?(\d{4}-\d\d-\d\d).*?\]", p) for p in plans]
    assert days == [[str(DAY + timedelta(k))] for k in range(1, 5)]  # one scan, of one day, however many there are
    assert _side(spark, path, ["a"]) and len(plans) == 4  # and none if nothing has landed


# ---- side by side


def test_dependencies_by_path():
    def spec(name, reads, writes, *joins):
        return DatasetSpec(name, {"path": reads}, {"path": writes}, joins=[{"path": j} for j in joins])

    specs = {s.dataset: s for s in (spec("a", "/raw/a", "/s/a"), spec("b", "/raw/b", "/s/b", "file:/s//a/"), spec("c", "/s/b", "/g/c"))}
    assert dependencies(specs) == {"a": set(), "b": {"a"}, "c": {"b"}}


def test_a_dataset_waits_for_what_it_reads_only(spark):
    began, ended = {}, {}

    def task(name):
        began[name] = time.monotonic()
        spark.range(10).count()
        time.sleep(0.4)
        ended[name] = time.monotonic()
        return spark.sparkContext.getLocalProperty("spark.scheduler.pool"), spark.sparkContext.getLocalProperty("mine")

    spark.sparkContext.setLocalProperty("mine", "yes")
    try:
        got = run_all(spark, {"a": set(), "b": set(), "c": {"a"}, "d": {"b", "c"}}, task, 4)
    finally:
        spark.sparkContext.setLocalProperty("mine", None)
    assert began["b"] < ended["a"] and began["c"] >= ended["a"] and began["d"] >= ended["c"]
    assert got == {n: (n, "yes") for n in "abcd"}
    with pytest.raises(ValueError, match="wait for each other"):
        run_all(spark, {"a": {"b"}, "b": {"a"}}, task)


def _job(root, name, joins=()):
    return {
        "dataset": name,
        "bronze": {"source_path": f"{root}/raw/{name}", "target_path": f"{root}/bronze/{name}"},
        "silver": {"target_path": f"{root}/silver/{name}", "primary_key": "k", "not_null_columns": ["k"], "dedup_key": ["k"], "joins": list(joins)},
    }


@pytest.mark.parametrize("workers", [1, 4])
def test_failures_and_ledger_are_those_of_a_run_one_by_one(spark, scratch, workers):
    root = scratch("lake")
    for name in ("a", "b", "d"):
        spark.createDataFrame([("1", name), ("2", name)], f"k string, {name} string").write.parquet(f"{root}/raw/{name}")
    needs_a = [{"format": "table", "path": f"{root}/silver/a", "on": "k", "type": "left", "select": ["a"]}]
    gone = [{"format": "table", "path": f"{root}/silver/nowhere", "on": "k", "type": "left"}]
    jobs = [_job(root, "d", gone), _job(root, "b", needs_a), _job(root, "a"), _job(root, "missing")]
    assert P.run_configs(spark, jobs, [], f"{root}/ledger", DAY, workers=workers) == 1
    state = {n: r["status"] for n, r in RunLedger(spark, f"{root}/ledger").snapshot().items()}
    assert state["silver_d"] == FAILED and state["silver_a"] == state["silver_b"] == SUCCESS
    assert state["bronze_missing"] == state["silver_missing"] == "skipped"
    # b comes before a in the list, reads a's table, and so waited for it
    assert sorted(tuple(r) for r in K.read_keyed_table(spark, f"{root}/silver/b").select("k", "a").collect()) == [("1", "a"), ("2", "a")]


# ---- keyed tables


def _rows(spark, lo, hi, **columns):
    return spark.range(lo, hi).select(F.col("id").cast("string").alias("k"), *[F.lit(v).alias(c) for c, v in columns.items()])


def test_a_new_column_rewrites_only_touched_buckets(spark, scratch):
    path = scratch("tbl")
    K.merge_into(_rows(spark, 0, 400, v=1.0), path, "k", buckets=16)
    before = K.read_meta(spark, path)
    K.merge_into(_rows(spark, 7, 9, v=2.0, extra="x"), path, "k")
    after = K.read_meta(spark, path)
    kept = [b for b in before.places if after.places[b] == before.places[b]]
    assert 16 - len(kept) <= 2 and after.schema.names == ["k", "v", "extra"]
    got = K.read_keyed_table(spark, path)
    assert got.count() == 400 and got.where("extra = 'x' AND v = 2.0").count() == 2 and got.where("extra IS NULL").count() == 398
    # and the next merge, without the column, leaves it where it is
    K.merge_into(_rows(spark, 0, 8, v=3.0), path, "k")
    got = K.read_keyed_table(spark, path)
    assert got.where("extra = 'x'").count() == 2 and got.where("v = 3.0").count() == 8


def test_an_append_adds_files_and_columns(spark, scratch, monkeypatch):
    path = scratch("tbl")
    monkeypatch.setattr(K, "ROWS_PER_BUCKET", 100)
    K.write_keyed_table(_rows(spark, 0, 400, v=1.0), path, "k")
    before = K.read_meta(spark, path)
    assert before.buckets == 4
    K.write_keyed_table(_rows(spark, 0, 3, v=1.0, note="n"), path, "k", mode="append")
    K.write_keyed_table(_rows(spark, 0, 3, v=5.0), path, "k", mode="append")
    after = K.read_meta(spark, path)
    assert after.places == before.places and after.rows == 406
    got = K.read_keyed_table(spark, path)
    assert got.count() == 406 and got.where("note = 'n'").count() == 3
    K.merge_into(_rows(spark, 500, 540, v=7.0), path, "k")  # merged buckets take their added files in
    assert K.read_keyed_table(spark, path).count() == 446 == K.read_meta(spark, path).rows
    with pytest.raises(ValueError, match="type of"):
        K.write_keyed_table(_rows(spark, 0, 3, v="text"), path, "k", mode="append")
