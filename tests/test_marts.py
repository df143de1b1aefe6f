"""Marts kept up by changes, mergeable distinct counts, co-located facts, one-pass reports."""

import math
import random

import pytest
from pyspark.sql import functions as F

from strata.functions.money import money_avg, money_sum
from strata.operators import distinct as D
from strata.plans import change_feed, colocated, mart_refresh
from strata.plans import queries as Q
from strata.plans import reports as R
from strata.plans.marts import build_mart
from strata.plans.model import stored_model
from strata.plans.specs import DatasetSpec
from strata.sinks import keyed_table as K

SF = "/root/testdata/sf0.001"
SCHEMA = "order_id string, customer_id string, region string, amount double, items long"
AGGREGATION = {
    "group_by": ["region"],
    "metrics": [
        ["revenue", "sum_money", "amount"], ["orders", "count", "order_id"], ["mean", "avg_money", "amount"],
        ["customers", "count_distinct", "customer_id"], {"name": "items", "fn": "sum_long", "column": "items"},
    ],
}


def _norm(df):
    return sorted((tuple("nan" if isinstance(v, float) and math.isnan(v) else v for v in r) for r in df.collect()), key=repr)


def _merge(spark, path, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    K.merge_into(df, path, "order_id", buckets=4, after_commit=change_feed.recorder(path, "order_id"))


def _spec(silver, mart):
    return DatasetSpec("m", {"format": "table", "path": silver}, {"format": "table", "path": mart}, aggregation=AGGREGATION, refresh="incremental")


def _check(spark, silver, mart):
    n = mart_refresh.refresh(spark, _spec(silver, mart))
    want = _norm(build_mart(AGGREGATION, K.read_keyed_table(spark, silver)))
    assert _norm(mart_refresh.read_mart(spark, mart, AGGREGATION)) == want
    assert n == len(want)


@pytest.fixture()
def no_whole_silver(monkeypatch):
    """Reading silver as a whole is an error from now on."""
    def block(silver):
        read = mart_refresh.read_keyed_table
        monkeypatch.setattr(mart_refresh, "read_keyed_table", lambda s, p, **kw: pytest.fail("all of silver was read") if p == silver else read(s, p, **kw))
    return block


def test_changes_give_the_mart_of_a_full_build(spark, scratch, no_whole_silver):
    silver, mart = scratch("silver"), scratch("mart")
    rows = [("1", "a", "N", 10.5, 1), ("2", "a", "N", 0.25, None), ("3", "b", "S", None, 3), ("4", None, None, 7.0, 4), ("5", "c", "W", 1.0, 5)]
    _merge(spark, silver, rows)
    _check(spark, silver, mart)
    no_whole_silver(silver)
    want = build_mart(AGGREGATION, spark.createDataFrame([], SCHEMA))  # (schema only)
    # changed amounts, a customer that moves and one that goes, a group that vanishes, new and null groups
    _merge(spark, silver, [("1", "a", "S", 11.5, 1), ("2", "d", "N", 0.25, 2), ("5", "c", "N", 1.0, 5), ("6", "e", "E", 2.0, 6), (None, "z", None, 3.0, 1)])
    mart_refresh.refresh(spark, _spec(silver, mart))
    got = {r.region: r for r in mart_refresh.read_mart(spark, mart, AGGREGATION).collect()}
    assert set(got) == {"N", "S", "E", None} and want.columns == list(got["N"].__fields__)
    assert tuple(got["N"])[1:] == (1.25, 2, 0.625, 2, 7) and tuple(got["S"])[1:] == (11.5, 2, 11.5, 2, 4)
    assert tuple(got["E"])[1:] == (2.0, 1, 2.0, 1, 6) and tuple(got[None])[1:] == (10.0, 1, 5.0, 1, 5)


@pytest.mark.parametrize("seed", [1, 2])
def test_random_days_equal_full_builds(spark, scratch, seed):
    silver, mart, r = scratch("silver"), scratch("mart"), random.Random(seed)

    def batch(n):
        ids = r.sample(range(40), n)
        return [(str(i), r.choice("abcde") if r.random() < 0.9 else None, r.choice(["N", "S", None]),
                 r.choice([None, round(r.uniform(-9, 9), 2)]), r.choice([None, r.randint(0, 5)])) for i in ids]

    for n in (20, 12, 25):
        _merge(spark, silver, batch(n))
        _check(spark, silver, mart)
    _merge(spark, silver, batch(3))
    _merge(spark, silver, batch(9))  # two commits between refreshes
    _check(spark, silver, mart)


def test_only_touched_groups_are_written(spark, scratch):
    silver, path = scratch("silver"), scratch("mart")
    _merge(spark, silver, [(str(k), f"c{k % 7}", f"r{k % 50}", float(k), k) for k in range(400)])
    mart_refresh.refresh(spark, _spec(silver, path))
    _merge(spark, silver, [("3", "c9", "r3", 1.0, 1), ("4", "c1", "r5", 1.0, 1)])
    mart_refresh.refresh(spark, _spec(silver, path))
    mart = mart_refresh.Mart(spark, path, AGGREGATION)
    assert sorted(r.region for r in mart.touched_by(2).collect()) == ["r3", "r4", "r5"]
    commit = K.read_meta(spark, f"{path}/groups").commit
    mart_refresh.refresh(spark, _spec(silver, path))  # nothing new: nothing written
    assert K.read_meta(spark, f"{path}/groups").commit == commit


@pytest.mark.parametrize("step", ["pairs", "groups", "note"])
def test_a_refresh_cut_short_is_run_again(spark, scratch, monkeypatch, step):
    silver, mart = scratch("silver"), scratch("mart")
    _merge(spark, silver, [(str(k), f"c{k % 3}", f"r{k % 4}", float(k), k) for k in range(30)])
    mart_refresh.refresh(spark, _spec(silver, mart))
    _merge(spark, silver, [("3", "c8", "r1", 5.0, 1), ("99", "c1", "r9", 1.0, 1)])
    with monkeypatch.context() as m:
        if step == "note":
            m.setattr(mart_refresh.Mart, "note", lambda *a: (_ for _ in ()).throw(OSError("crash")))
        else:
            merge = mart_refresh.merge_into
            m.setattr(mart_refresh, "merge_into", lambda df, path, *a, **kw: (merge(df, path, *a, **kw), (_ for _ in ()).throw(OSError("crash")) if step in path else None))
        with pytest.raises(OSError):
            mart_refresh.refresh(spark, _spec(silver, mart))
    _merge(spark, silver, [("4", "c7", "r0", 2.0, 2)])  # another commit before the rerun
    _check(spark, silver, mart)


def test_a_gap_in_the_feed_or_odd_amounts_build_anew(spark, scratch):
    silver, mart = scratch("silver"), scratch("mart")
    _merge(spark, silver, [(str(k), "c", f"r{k % 4}", float(k), k) for k in range(12)])
    _check(spark, silver, mart)
    K.merge_into(spark.createDataFrame([("1", "x", "r9", 3.0, 1)], SCHEMA), silver, "order_id")  # no feed
    _check(spark, silver, mart)
    _merge(spark, silver, [("2", "c", "r2", 1e30, 1), ("3", "c", "r3", float("nan"), 1)])
    _check(spark, silver, mart)
    _merge(spark, silver, [("2", "c", "r2", 5.0, 1)])
    _check(spark, silver, mart)
    with pytest.raises(ValueError, match="can't be refreshed"):
        mart_refresh.metrics_of({"metrics": [("largest", "max", "amount")]})


# ---- distinct counts


def test_codes_are_dense_and_stay(spark):
    first = spark.range(1000).select(F.concat(F.lit("c"), (F.col("id") % 300).cast("string")).alias("c"))
    codes = D.assign_codes(first.unionByName(spark.createDataFrame([(None,)], "c string")))
    known = {r.value: r.code for r in codes.collect()}
    assert sorted(known.values()) == list(range(300))
    more = D.assign_codes(spark.createDataFrame([("c5",), ("new1",), ("new2",)], "c string"), codes)
    now = {r.value: r.code for r in more.collect()}
    assert {k: now[k] for k in known} == known and sorted((now["new1"], now["new2"])) == [300, 301]


def test_distinct_counts_add_up(spark):
    r = random.Random(4)
    rows = [(r.choice(["a", "b", None]), r.choice("xy"), r.choice([None, *range(0, 100_000, 997)]), r.choice([None, 1.25, 2.5])) for _ in range(3000)]
    df = spark.createDataFrame(rows, "g string, h string, code long, v double")
    halves = [D.distinct_state(d, ["g", "h"], "code", ["v"]) for d in (df.where("h = 'x'"), df.where("h = 'y'"))]
    state = D.merge_states(halves, ["g", "h"])
    for by in ([], ["g"], ["h"], ["g", "h"]):
        got = D.roll_up(state, by, [D.total("v").alias("s"), D.mean("v").alias("m"), F.sum("rows").alias("n")], "d")
        want = [F.count_distinct("code").alias("d"), money_sum("v").alias("s"), money_avg("v").alias("m"), F.count(F.lit(1)).alias("n")]
        assert _norm(got) == _norm(df.groupBy(*by).agg(*want))


def test_rollups_read_the_state_alone(spark):
    stored_model(spark, SF).customer_state()
    for query in (Q.regions_rollup, Q.kpis_rollup):
        p = query(spark, SF)._jdf.queryExecution().executedPlan().toString()
        scans = [line for line in p.splitlines() if "FileScan" in line]
        assert len(scans) == 1 and "customer-state" in scans[0]


# ---- plans


def test_colocated_facts_join_without_a_shuffle(spark, scratch):
    a = spark.range(2000).select((F.col("id") % 500).cast("string").alias("k"), F.col("id").alias("v"))
    b = spark.range(500).select(F.col("id").cast("string").alias("k"), F.lit("x").alias("w"))
    stored = colocated.store({"a": a, "b": b}, "k", scratch("colocated"), 4)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = stored["a"].join(stored["b"], "k", "left")
        p = joined._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in p and "Exchange" not in p
        assert joined.count() == 2000 and joined.where("w IS NULL").isEmpty()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_breakdowns_scan_their_mart_once(spark):
    stored_model(spark, SF).mart("regional_sales")
    p = Q.report_regional_breakdown(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert len([line for line in p.splitlines() if "FileScan" in line]) == 1 and "Expand" in p


def test_breakdown_agrees_with_the_reports(spark):
    mart = stored_model(spark, SF).mart("regional_sales")
    rows = R.breakdown(mart, [(), ("region",), ("channel",)]).collect()
    regions = {r.region: r for r in rows if r.grouping == "region" and r.region is not None}
    assert {k: (r.total_revenue, r.order_count) for k, r in regions.items()} == {r.region: (r.total_revenue, r.order_count) for r in R.regions(mart).collect()}
    assert [r.share for r in rows if r.grouping == ""] == [1.0]
    assert sum(r.leads for r in rows) == 3


def test_amounts_beyond_the_decimal_range_are_added_up(spark):
    rows = [(1, 1e21), (1, 1.0), (2, float("inf")), (2, 1.0), (3, float("inf")), (3, float("-inf")), (4, 0.1), (4, 0.2), (5, None), (6, 2.0), (6, float("nan"))]
    df = spark.createDataFrame(rows, "g int, v double")
    got = {r.g: (r.s, r.a) for r in df.groupBy("g").agg(money_sum("v").alias("s"), money_avg("v").alias("a")).collect()}
    assert got[1] == (1e21, 5e20) and got[2] == (float("inf"), float("inf")) and got[4] == (0.3, 0.15) and got[5] == (None, None)
    assert all(math.isnan(x) for g in (3, 6) for x in got[g])


def test_a_changed_table_is_not_read_from_the_store(spark, scratch, tmp_path):
    import shutil

    sf = tmp_path / "sf"
    shutil.copytree(SF, sf)
    sf.chmod(0o755)  # the copy takes over the mode of a folder that may be read-only
    first = stored_model(spark, str(sf))
    assert stored_model(spark, str(sf)) is first
    spark.read.parquet(f"{SF}/orders.parquet").limit(10).toPandas().to_parquet(sf / "orders2.parquet")
    (sf / "orders.parquet").unlink()
    (sf / "orders2.parquet").rename(sf / "orders.parquet")
    assert stored_model(spark, str(sf)) is not first


def test_given_segments_take_no_job_and_are_checked(spark):
    mart = stored_model(spark, SF).mart("regional_sales")
    names = [r.segment for r in mart.select("segment").distinct().collect() if r.segment]
    spark.sparkContext.setJobGroup("matrix", "matrix")
    matrix = R.region_segment_matrix(mart, sorted(names))
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup("matrix")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert _norm(matrix) == _norm(R.region_segment_matrix(mart))
    with pytest.raises(Exception, match="outside the given columns"):
        R.region_segment_matrix(mart, names[:1]).collect()


def test_distinct_counts_leave_the_sums_at_home(spark):
    """The shuffle of (group, value) pairs carries nothing else; groups of nulls and values that are null count as before."""
    import re

    from strata.plans.marts import build_mart

    rows = [("a", None, 1, 2.5), ("a", None, 1, 0.5), ("a", None, None, 1.0), (None, "x", 3, 1.0), (None, "x", 4, None), ("b", "y", None, None)]
    df = spark.createDataFrame(rows, "g string, h string, v int, m double")
    metrics = [("n", "count_distinct", "v"), ("total", "sum_money", "m"), {"name": "again", "fn": "count_distinct", "column": "v"}, ("rows", "count", "v"), ("groups", "count_distinct", "g")]
    out = build_mart({"group_by": ["g", "h"], "metrics": metrics}, df)
    assert out.columns == ["g", "h", "n", "total", "again", "rows", "groups"]
    got = {(r.g, r.h): tuple(r)[2:] for r in out.collect()}
    assert got == {("a", None): (1, 4.0, 1, 2, 1), (None, "x"): (2, 1.0, 2, 2, 0), ("b", "y"): (0, None, 0, 0, 1)}
    plan = out._jdf.queryExecution().toString()
    assert not [x for x in re.findall(r"HashAggregate\(keys=\[([^\]]*)\], functions=\[([^\]]*)\]", plan) if "v#" in x[0] and "sum" in x[1]]
