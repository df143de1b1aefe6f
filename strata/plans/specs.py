"""Dataset specs: what a run of one dataset reads, does and writes.

A spec is written as a JSON-compatible mapping and checked whole before any Spark work
(``DatasetSpec.parse`` names every fault with its key)::

    {"dataset": "silver_retail_orders", "layer": "silver",
     "source": {"format": "parquet", "path": ".../bronze/retail_orders",
                "options": {"incremental_from": "2024-01-31", "incremental_date": "2024-02-01"}},
     "transformations": [{"name": "filter_nulls", "params": {...}}, ...],   # before the joins
     "joins": [{"format": "table", "path": ..., "on": "customer_id",
                "type": "left", "select": [...], "latest": false}],
     "not_null": [...],                                                     # of the joined rows
     "unique": ["order_id"],                                                # newest row per key of those
     "post_join_transformations": [...],
     "schema": [[name, type, nullable], ...], "on_null_violation": "warn",
     "aggregation": {"group_by": [...], "metrics": [...]}, "refresh": "full",
     "sink": {"format": "table", "path": ..., "mode": "merge", "merge_key": "order_id"}}

The parts apply in that order.  ``bronze_spec`` and ``silver_spec`` build specs from a
job; gold configs are specs as they stand.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass, fields
from datetime import date
from typing import Any

from ..operators.cleaning import get_transform, written_columns
from ..operators.schema import load_schema_file
from ..sinks.writers import get_writer
from ..sources.paths import DropFolder
from ..sources.readers import get_reader
from .retail_model import GOLD_MARTS, SILVER_JOBS, SILVER_ORDER, SILVER_SCHEMAS

STEP_LISTS = ("transformations", "post_join_transformations")
#: Join types that keep every row of the batch, and those that keep or drop them one by one.
KEEPING = {"left", "leftouter"}
LOOKUPS = KEEPING | {"inner", "semi", "leftsemi", "anti", "leftanti"}


class SpecError(ValueError):
    """All faults of a spec."""

    def __init__(self, name: str, faults: Sequence[str]):
        super().__init__(f"dataset spec {name!r}: " + "; ".join(faults))
        self.faults = list(faults)


def _said(check, *args) -> Iterator[str]:
    """What a check complains about, if it does."""
    try:
        check(*args)
    except (ValueError, KeyError, TypeError) as exc:
        yield exc.args[0] if exc.args else repr(exc)


def faults(config: Mapping) -> Iterator[str]:
    """Everything wrong with a spec, each fault with the key it is about."""
    absent = [k for k in ("dataset", "source", "sink") if k not in config]
    if absent:
        yield f"missing required key(s): {', '.join(absent)}"
    inputs = {"source": config["source"]} if "source" in config else {}
    for part in (*STEP_LISTS, "joins", "not_null", "unique"):
        if not isinstance(config.get(part) or [], (list, tuple)):
            yield f"{part}: must be a list"
        elif part == "joins":
            inputs |= {f"joins[{k}]": j for k, j in enumerate(config.get(part) or [])}
        elif part in STEP_LISTS:
            for k, step in enumerate(config.get(part) or []):
                if "name" not in step:
                    yield f"{part}[{k}].name: missing"
                else:
                    yield from (f"{part}[{k}].name: {said}" for said in _said(get_transform, step["name"]))
    for key, spec in inputs.items():
        wanted = ["path"] if key == "source" else ["path", "on"]
        yield from (f"{key}.{k}: missing" for k in wanted if not spec.get(k))
        yield from (f"{key}.path: {said}" for said in _said(DropFolder.parse, spec.get("path") or ""))
        yield from (f"{key}.format: {said}" for said in _said(get_reader, spec.get("format", "")))
    if "sink" in config:
        yield from (f"sink.format: {said}" for said in _said(get_writer, config["sink"].get("format", "")))
        if config["sink"].get("mode") == "merge" and not config["sink"].get("merge_key"):
            yield "sink.merge_key: needed to merge"
    if config.get("refresh", "full") not in ("full", "incremental"):
        yield f"refresh: {config['refresh']!r} is neither 'full' nor 'incremental'"
    elif config.get("refresh") == "incremental" and not config.get("aggregation"):
        yield "refresh: only an aggregation can be refreshed incrementally"


@dataclass(frozen=True)
class DatasetSpec:
    dataset: str
    source: Mapping
    sink: Mapping
    layer: str = ""
    transformations: Sequence[Mapping] = ()
    joins: Sequence[Mapping] = ()
    not_null: Sequence[str] = ()
    unique: Sequence[str] = ()
    post_join_transformations: Sequence[Mapping] = ()
    schema: Any = None
    on_null_violation: str = "warn"
    aggregation: Mapping | None = None
    refresh: str = "full"

    @classmethod
    def parse(cls, config: Mapping | DatasetSpec) -> DatasetSpec:
        """A checked spec; a null part counts as absent, keys of no meaning here are left out."""
        config = config.as_config() if isinstance(config, DatasetSpec) else config
        found = list(faults(config))
        if found:
            raise SpecError(config.get("dataset", "?"), found)
        known = {f.name for f in fields(cls)}
        return cls(**{k: v for k, v in config.items() if k in known and v is not None})

    def as_config(self) -> dict:
        return {f.name: getattr(self, f.name) for f in fields(self)}

    @property
    def since(self) -> str | None:
        """Only rows landed after this date are read, and those of ``run_day``."""
        return (self.source.get("options") or {}).get("incremental_from")

    @property
    def run_day(self) -> str | None:
        return (self.source.get("options") or {}).get("incremental_date")

    def joins_are(self, kinds: set[str]) -> bool:
        return all(j.get("type", "left").lower().replace("_", "") in kinds for j in self.joins)

    def filters_early(self, columns: Sequence[str]) -> list[str]:
        """Columns of the batch itself whose nulls may go before the joins already: no join
        makes a row of them that was not there."""
        return [c for c in self.not_null if c in columns] if self.joins_are(LOOKUPS) else []

    def reduces_early(self, columns: Sequence[str]) -> bool:
        """Whether the newest row per key may be taken before the joins.  Not if a join, or a
        null in a joined column, can drop that row afterwards: an older one stays then."""
        own = set(columns)
        return bool(self.unique) and self.joins_are(KEEPING) and own.issuperset(self.unique) and own.issuperset(self.not_null)

    def may_change_key(self) -> bool:
        """Whether a step after the dedup may write a key column."""
        written = [written_columns(s) for s in self.post_join_transformations]
        return any(w is None or not w.isdisjoint(self.unique) for w in written)


def validate(config: Mapping) -> None:
    """Check a spec, and its formats and steps against the registries, before any Spark work."""
    DatasetSpec.parse(config)


# ---- specs of a job
#
# Job configs have the shape
#   {"dataset": "retail_orders",
#    "bronze": {"source_format", "source_path" (may hold {year}/{month}/{day}), "target_path"},
#    "silver": {"source_path", "target_path", "schema_path" | "schema", "primary_key",
#               "not_null_columns", "dedup_key", "on_null_violation", "transformations",
#               "joins": [{"format", "path", "on", "type", "select", "latest"?}]}}
# and gold configs are dataset specs with an "aggregation" (used as given).


def place_of(path: str) -> str:
    """A path as it compares: no trailing or doubled slashes, no ``file:`` scheme."""
    return re.sub(r"(?<!:)/+", "/", re.sub(r"^file:/+", "/", path)).rstrip("/")


# Days of one bronze table may have different columns; a changed type fails the read.
EVOLVING = {"mergeSchema": "true"}


def bronze_spec(job: Mapping, run_date: date) -> DatasetSpec:
    """Land the day's raw drop, stamped with the run date.  The sink replaces that day's
    partition only, so the same day can be run again."""
    bronze = job["bronze"]
    return DatasetSpec(
        dataset=f"bronze_{job['dataset']}",
        layer="bronze",
        source={
            "path": DropFolder.parse(bronze["source_path"]).on(run_date),
            "format": bronze.get("source_format", "parquet"),
            "options": bronze.get("source_options") or {},
        },
        transformations=[{"name": "add_ingestion_date", "params": {"run_date": run_date.isoformat()}}],
        sink={"path": bronze["target_path"], "format": "parquet", "mode": "overwrite", "overwrite_mode": "dynamic",
              "partition_by": ["ingestion_date"]},
    )


def _lookup(join: Mapping, bronze: set[str]) -> dict:
    """A join side; a bronze table (several versions per key) is read as such and
    reduced to its newest versions."""
    if place_of(join["path"]) not in bronze:
        return {"latest": False, **join}
    options = {**EVOLVING, **(join.get("options") or {})}
    return {"latest": True, **join, "format": "parquet", "options": options}


def silver_spec(
    job: Mapping,
    incremental_from: date | None = None,
    bronze_paths: set[str] = frozenset(),
    run_date: date | None = None,
) -> DatasetSpec:
    """Enrich, null filter (joined columns too), newest row per key, conform, declared
    schema, upsert on the primary key."""
    silver = job["silver"]
    options = dict(EVOLVING)
    if incremental_from:
        options |= {"incremental_from": str(incremental_from), "incremental_date": str(run_date or incremental_from)}
    bronze = {place_of(p) for p in bronze_paths}
    return DatasetSpec(
        dataset=f"silver_{job['dataset']}",
        layer="silver",
        source={"format": "parquet", "path": silver.get("source_path") or job["bronze"]["target_path"], "options": options},
        joins=[_lookup(j, bronze) for j in silver.get("joins") or []],
        not_null=list(silver["not_null_columns"]),
        unique=list(silver["dedup_key"]),
        post_join_transformations=[*(silver.get("transformations") or []), *(silver.get("post_join_transformations") or [])],
        schema=silver.get("schema") or (load_schema_file(silver["schema_path"]) if silver.get("schema_path") else None),
        on_null_violation=silver.get("on_null_violation", "warn"),
        sink={"format": "table", "path": silver["target_path"], "mode": "merge", "merge_key": silver["primary_key"],
              "version_column": "ingestion_date"},
    )


def bronze_config(job: Mapping, run_date: date) -> dict:
    return bronze_spec(job, run_date).as_config()


def silver_config(job: Mapping, incremental_from: date | None = None, bronze_paths: set[str] = frozenset(), run_date: date | None = None) -> dict:
    return silver_spec(job, incremental_from, bronze_paths, run_date).as_config()


# ---- the retail model in a lake

# Where the raw drops of each dataset land.
RAW_FILES = {
    "retail_customers": "dims/customers.parquet",
    "retail_stores": "dims/stores.parquet",
    "retail_products": "dims/products.parquet",
    "retail_orders": "facts/{year}/{month}/{day}/orders.parquet",
    "retail_order_items": "facts/{year}/{month}/{day}/order_line_items.parquet",
}


@dataclass(frozen=True)
class LakeLayout:
    raw: str
    lake: str

    def raw_path(self, dataset: str) -> str:
        return f"{self.raw}/{RAW_FILES[dataset]}"

    def bronze(self, dataset: str) -> str:
        return f"{self.lake}/bronze/{dataset}"

    def silver(self, target: str) -> str:
        return f"{self.lake}/silver/{target}"

    def gold(self, mart: str) -> str:
        return f"{self.lake}/gold/{mart}"

    @property
    def ledger(self) -> str:
        return f"{self.lake}/control/ledger"


def retail_jobs(layout: LakeLayout) -> list[dict]:
    """The retail model's job configs for a lake layout (build order)."""
    def side_path(ref: str) -> str:
        layer, name = ref.split(":", 1)
        return layout.bronze(name) if layer == "bronze" else layout.silver(SILVER_JOBS[name]["target"])

    jobs = []
    for name in SILVER_ORDER:
        spec = SILVER_JOBS[name]
        joins = [{"format": "table", "path": side_path(j["source"]), **{k: v for k, v in j.items() if k != "source"}}
                 for j in spec["joins"]]
        jobs.append({
            "dataset": name,
            "bronze": {"source_format": "parquet", "source_path": layout.raw_path(name), "target_path": layout.bronze(name)},
            "silver": {
                "source_path": layout.bronze(name),
                "target_path": layout.silver(spec["target"]),
                "schema": SILVER_SCHEMAS[spec["target"]],
                **{k: spec[k] for k in ("primary_key", "not_null_columns", "dedup_key", "on_null_violation", "transformations")},
                "joins": joins,
            },
        })
    return jobs


def retail_gold(layout: LakeLayout, sink: Mapping | None = None, refresh: str = "full") -> list[dict]:
    """Gold configs of the retail marts; ``refresh="incremental"`` keeps them up with
    silver by its changes (``plans/mart_refresh.py``)."""
    out = []
    for mart in sorted(GOLD_MARTS):
        spec = GOLD_MARTS[mart]
        config = {
            "dataset": mart,
            "layer": "gold",
            "source": {"format": "table", "path": layout.silver(spec["source"])},
            "aggregation": {"group_by": spec["group_by"], "metrics": spec["metrics"]},
            "sink": dict(sink) if sink else {"format": "parquet", "path": layout.gold(mart), "mode": "overwrite"},
        }
        out.append(config if refresh == "full" else config | {"refresh": refresh})
    return out
