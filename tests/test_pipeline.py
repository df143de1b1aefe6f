"""Runner: validation, skip/incremental rules, missing sources, DQ policy."""

from datetime import date

import pytest

from strata.plans import pipeline as P
from strata.plans.ledger import FAILED, SKIPPED, SUCCESS, RunLedger, incremental_bound, should_skip


def test_validate():
    with pytest.raises(ValueError, match="missing required"):
        P.validate({"dataset": "x"})
    with pytest.raises(ValueError, match="Unsupported reader format"):
        P.validate({"dataset": "x", "source": {"format": "excel", "path": "p"}, "sink": {"format": "parquet"}})
    with pytest.raises(ValueError, match="Unsupported writer format"):
        P.validate({"dataset": "x", "source": {"format": "json", "path": "p"}, "sink": {"format": "excel"}})
    P.validate({"dataset": "x", "source": {"format": "json", "path": "p"}, "sink": {"format": "json"}})
    with pytest.raises(ValueError, match="Unknown transformer"):
        P.validate({"dataset": "x", "source": {"format": "json", "path": "p"}, "sink": {"format": "json"},
                    "transformations": [{"name": "nonexistent"}]})
    with pytest.raises(ValueError, match="merge_key"):
        P.validate({"dataset": "x", "source": {"format": "json", "path": "p"}, "sink": {"format": "table", "mode": "merge"}})


def test_dataset_selection():
    layout = P.LakeLayout("raw", "lake")
    jobs, golds = P.retail_jobs(layout), P.retail_gold(layout)

    def picked(layer, dataset):
        return [c["dataset"] for c in P.select_datasets(layer, jobs, golds, dataset)]

    assert picked("silver", "retail_orders") == ["retail_orders"]
    marts = picked("gold", "retail_orders")
    assert "gold_daily_trend" in marts and "gold_product_performance" not in marts
    assert picked("gold", "gold_daily_trend") == ["gold_daily_trend"]


def test_ledger_rules(spark, scratch):
    ledger = RunLedger(spark, scratch("ledger"))
    d1, d2 = date(2024, 1, 1), date(2024, 1, 2)
    assert ledger.get("a") is None and incremental_bound(ledger.snapshot(), "a") is None
    ledger.record("a", "silver", 5, d1, SUCCESS)
    state = ledger.snapshot()
    assert should_skip(state, "a", d1) and not should_skip(state, "a", d2)
    assert incremental_bound(state, "a") == d1
    ledger.record("a", "silver", 0, d2, FAILED)
    state = ledger.snapshot()
    assert incremental_bound(state, "a") is None and not should_skip(state, "a", d2)
    ledger.record("b", "bronze", 0, d2, SKIPPED)
    assert ledger.frame().count() == 2
    assert ledger.snapshot() == state | {"b": ledger.get("b")}
    # a backfill of an older date doesn't move the bound back
    ledger.record("c", "silver", 1, d2, SUCCESS)
    ledger.record("c", "silver", 1, d1, SUCCESS)
    assert incremental_bound(ledger.snapshot(), "c") == d2


def test_ledger_keeps_its_rows_through_read_errors(spark, scratch, monkeypatch):
    ledger = RunLedger(spark, scratch("ledger"))
    ledger.record("a", "silver", 5, date(2024, 1, 1), SUCCESS)
    with monkeypatch.context() as m:
        m.setattr(RunLedger, "_log", lambda self: (_ for _ in ()).throw(OSError("store down")))
        assert ledger.snapshot() == {}
        ledger.record("b", "silver", 5, date(2024, 1, 1), SUCCESS)
    assert set(ledger.snapshot()) == {"a", "b"}


def _spec(src, sink, **extra):
    return {"dataset": "t", "source": {"format": "parquet", "path": src}, "sink": {"format": "parquet", "path": sink}, **extra}


def test_missing_primary_source_is_skip(spark, scratch):
    with pytest.raises(P.SourceMissing):
        P.run_dataset(spark, _spec(scratch("nope"), scratch("out")))


def test_missing_join_input_is_failure(spark, scratch):
    src = scratch("src")
    spark.createDataFrame([(1,)], "k int").write.parquet(src)
    spec = _spec(src, scratch("out"), joins=[{"format": "parquet", "path": scratch("nope"), "on": "k"}])
    with pytest.raises(Exception) as info:
        P.run_dataset(spark, spec)
    assert not isinstance(info.value, P.SourceMissing)


def test_run_dataset_counts_rows_in_one_pass(spark, scratch):
    src, out = scratch("src"), scratch("out")
    spark.createDataFrame([(1, "a"), (1, "a"), (None, "b")], "k int, v string").write.parquet(src)
    spec = _spec(src, out, transformations=[
        {"name": "filter_nulls", "params": {"columns": ["k"]}},
        {"name": "drop_duplicates", "params": {}},
    ])
    assert P.run_dataset(spark, spec).rows == 1
    assert spark.read.parquet(out).count() == 1


def test_fail_policy_blocks_write(spark, scratch):
    src, out = scratch("src"), scratch("out")
    spark.createDataFrame([(None, "b")], "k int, v string").write.parquet(src)
    spec = _spec(src, out, schema=[["k", "int", False], ["v", "string", True]], on_null_violation="fail")
    with pytest.raises(ValueError, match="DQ: column 'k'"):
        P.run_dataset(spark, spec)
    from strata.sources.readers import read
    from pyspark.errors import AnalysisException

    with pytest.raises(AnalysisException):
        read(spark, "parquet", out).count()


def test_fail_policy_takes_as_many_jobs_as_warn(spark, scratch):
    """A merge checks the staged batch: nothing is computed twice, nothing published."""
    from strata.sinks.keyed_table import table_exists

    src = scratch("src")
    spark.createDataFrame([(1, "b"), (2, None)], "k int, v string").write.parquet(src)
    status = spark.sparkContext.statusTracker()

    def run(policy, nullable, out):
        spec = _spec(src, out, schema=[["k", "int", False], ["v", "string", nullable]], on_null_violation=policy)
        spec["sink"] = {"format": "table", "path": out, "mode": "merge", "merge_key": "k"}
        group = f"{policy}-{nullable}"
        spark.sparkContext.setJobGroup(group, group)
        try:
            P.run_dataset(spark, spec)
        finally:
            spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        return len(status.getJobIdsForGroup(group))

    assert run("warn", True, scratch("w")) == run("fail", True, scratch("f"))
    out = scratch("bad")
    with pytest.raises(ValueError, match="column 'v' has 1 null"):
        run("fail", False, out)
    assert not table_exists(spark, out)


def test_lookup_of_a_bronze_table_is_told_by_place_not_text():
    job = {"dataset": "d", "bronze": {"target_path": "/x/b"}, "silver": {
        "target_path": "/x/s", "primary_key": "k", "dedup_key": ["k"], "not_null_columns": ["k"],
        "joins": [{"format": "table", "path": "/x//orders/", "on": "o"}, {"format": "table", "path": "/x/other", "on": "o"}]}}
    joins = P.silver_config(job, bronze_paths={"file:///x/orders"})["joins"]
    assert [j["latest"] for j in joins] == [True, False]


def _tables(spark, layout):
    from strata.sinks.keyed_table import read_keyed_table

    out = {}
    for target in ("retail_orders_enriched", "retail_order_items_enriched", "retail_customers"):
        out[target] = sorted(tuple(r) for r in read_keyed_table(spark, layout.silver(target)).collect())
    out["gold"] = sorted(tuple(r) for r in spark.read.parquet(layout.gold("gold_regional_sales")).collect())
    return out


def test_json_configs_and_idempotent_rerun(spark, scratch, tmp_path):
    """Configs survive a JSON round-trip; a full-refresh rerun of the same day
    leaves every layer as one run left it."""
    import json

    from strata.sources.retail import RAW_DATASETS

    sf = "/root/testdata/sf0.001"
    root = scratch("lake")
    layout = P.LakeLayout(raw=f"{root}/raw", lake=f"{root}/lake")
    jobs_dir, gold_dir = tmp_path / "jobs", tmp_path / "gold"
    jobs_dir.mkdir()
    gold_dir.mkdir()
    for i, job in enumerate(P.retail_jobs(layout)):
        (jobs_dir / f"job_{i:02d}.json").write_text(json.dumps(job))
    for g in P.retail_gold(layout):
        (gold_dir / f"{g['dataset']}.json").write_text(json.dumps(g))
    jobs, golds = P.load_configs(str(jobs_dir)), P.load_configs(str(gold_dir))
    day = date(2024, 1, 31)
    P.land_raw(layout, day, {n: fn(spark, sf) for n, fn in RAW_DATASETS.items()})
    assert P.run_configs(spark, jobs, golds, layout.ledger, day) == 0
    once = _tables(spark, layout)
    assert P.run_configs(spark, jobs, golds, layout.ledger, day, full_refresh=True) == 0
    assert _tables(spark, layout) == once
    # a normal rerun skips everything
    before = RunLedger(spark, layout.ledger).snapshot()
    assert P.run_configs(spark, jobs, golds, layout.ledger, day) == 0
    assert RunLedger(spark, layout.ledger).snapshot() == before


def test_missing_inputs_skip_and_failures_stop(spark, scratch):
    from strata.sources.retail import orders_raw

    root = scratch("lake")
    layout = P.LakeLayout(raw=f"{root}/raw", lake=f"{root}/lake")
    jobs = {j["dataset"]: j for j in P.retail_jobs(layout)}
    golds = P.retail_gold(layout)
    day = date(2024, 1, 31)
    # no raw drop at all: bronze and silver are skipped, not failed
    assert P.run_configs(spark, [jobs["retail_customers"]], [], layout.ledger, day) == 0
    state = RunLedger(spark, layout.ledger).snapshot()
    assert state["bronze_retail_customers"]["status"] == SKIPPED
    assert state["silver_retail_customers"]["status"] == SKIPPED
    # orders land, but silver orders' lookup tables do not exist: it fails,
    # the run stops with exit code 1 and gold never runs
    P.land_raw(layout, day, {"retail_orders": orders_raw(spark, "/root/testdata/sf0.001")})
    assert P.run_configs(spark, [jobs["retail_orders"]], golds, layout.ledger, day) == 1
    state = RunLedger(spark, layout.ledger).snapshot()
    assert state["bronze_retail_orders"]["status"] == SUCCESS
    assert state["silver_retail_orders"]["status"] == FAILED
    assert not any(k.startswith("gold_") for k in state)


def test_sql_text_metrics(spark, scratch):
    """Gold aggregation with free SQL aggregate expressions."""
    src, out = scratch("src"), scratch("out")
    spark.createDataFrame([("a", 1.0), ("a", 3.0), ("b", 5.0), (None, 7.0)], "g string, v double").write.parquet(src)
    spec = _spec(src, out, aggregation={"group_by": ["g"], "metrics": [
        {"name": "mx", "expr": "max(v)"},
        {"name": "spread", "expr": "max(v) - min(v)"},
        {"name": "n", "expr": "count(*)"},
    ]})
    assert P.run_dataset(spark, spec).rows == 3
    got = {r.g: (r.mx, r.spread, r.n) for r in spark.read.parquet(out).collect()}
    assert got == {"a": (3.0, 2.0, 2), "b": (5.0, 0.0, 1), None: (7.0, 0.0, 1)}


def test_ledger_errors_are_soft(spark, tmp_path):
    """An unreadable ledger means "never ran"; a failed record is logged."""
    blocker = tmp_path / "not_a_dir"
    blocker.write_text("x")
    ledger = RunLedger(spark, str(blocker / "ledger"))
    assert ledger.snapshot() == {}
    assert ledger.record("a", "bronze", 1, date(2024, 1, 1), SUCCESS) is False


def test_reference_shaped_configs(spark, scratch, tmp_path):
    """Job configs as the reference writes them: "delta" formats, schema files
    of {column_name, datatype, nullable}, gold metrics as SQL text."""
    import json

    from strata.plans.retail_model import SILVER_JOBS, SILVER_SCHEMAS
    from strata.sinks.keyed_table import read_keyed_table
    from strata.sources.retail import RAW_DATASETS

    sf = "/root/testdata/sf0.001"
    root = scratch("lake")
    layout = P.LakeLayout(raw=f"{root}/raw", lake=f"{root}/lake")
    jobs = []
    for job in P.retail_jobs(layout):
        sv = dict(job["silver"])
        schema_file = tmp_path / f"{job['dataset']}.json"
        schema_file.write_text(json.dumps([
            {"column_name": n, "datatype": t, "nullable": nl} for n, t, nl in SILVER_SCHEMAS[SILVER_JOBS[job["dataset"]]["target"]]
        ]))
        sv.pop("schema")
        sv["schema_path"] = str(schema_file)
        sv["joins"] = [{k: v for k, v in j.items() if k != "latest"} | {"format": "delta"} for j in sv["joins"]]
        jobs.append({"dataset": job["dataset"], "bronze": job["bronze"], "silver": sv})
    gold = [{
        "dataset": "gold_daily_trend", "layer": "gold",
        "source": {"format": "delta", "path": layout.silver("retail_orders_enriched"), "options": {}},
        "aggregation": {"group_by": ["order_date"], "metrics": [
            {"name": "total_revenue", "expr": "sum(total_amount)"},
            {"name": "order_count", "expr": "count(order_id)"},
        ]},
        "sink": {"format": "parquet", "path": layout.gold("gold_daily_trend"), "mode": "overwrite"},
    }]
    jobs = json.loads(json.dumps(jobs))
    day = date(2024, 1, 31)
    P.land_raw(layout, day, {n: fn(spark, sf) for n, fn in RAW_DATASETS.items()})
    assert P.run_configs(spark, jobs, gold, layout.ledger, day) == 0
    items = read_keyed_table(spark, layout.silver("retail_order_items_enriched"))
    assert items.count() == items.select("line_item_id").distinct().count()  # bronze orders side: no fan-out
    trend = spark.read.parquet(layout.gold("gold_daily_trend"))
    orders = read_keyed_table(spark, layout.silver("retail_orders_enriched"))
    assert trend.agg({"order_count": "sum"}).first()[0] == orders.count()


def test_cli_runs_config_folders(spark, scratch, tmp_path):
    import json

    from strata.sources.retail import products_raw

    root = scratch("lake")
    layout = P.LakeLayout(raw=f"{root}/raw", lake=f"{root}/lake")
    jobs_dir = tmp_path / "jobs"
    jobs_dir.mkdir()
    job = next(j for j in P.retail_jobs(layout) if j["dataset"] == "retail_products")
    (jobs_dir / "job_products.json").write_text(json.dumps(job))
    P.land_raw(layout, date(2024, 1, 31), {"retail_products": products_raw(spark, "/root/testdata/sf0.001")})
    argv = ["--layer", "all", "--date", "2024-01-31", "--jobs-dir", str(jobs_dir), "--ledger", layout.ledger]
    assert P.main(argv) == 0
    state = RunLedger(spark, layout.ledger).snapshot()
    assert state["silver_retail_products"]["rows_processed"] == 200
    with pytest.raises(SystemExit):
        P.main(["--layer", "all", "--jobs-dir", str(jobs_dir)])  # --ledger required


def test_ignore_mode_does_not_wait_for_a_skipped_write(spark, scratch):
    src, out = scratch("src"), scratch("out")
    spark.createDataFrame([(1,)], "k int").write.parquet(src)
    spark.createDataFrame([(9,)], "k int").write.parquet(out)
    spec = _spec(src, out)
    spec["sink"]["mode"] = "ignore"
    assert P.run_dataset(spark, spec).rows == 0
    assert [r.k for r in spark.read.parquet(out).collect()] == [9]
