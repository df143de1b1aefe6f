"""Bronze/silver/gold frames of the retail model over driver tables.

``RetailModel`` writes nothing: each layer is a DataFrame built on the previous
one.  ``StoredModel`` writes its silver tables and marts once, which is what marts
and reports should read: whatever else went into a silver table is behind them.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession

from ..operators.cleaning import add_ingestion_date
from ..operators.distinct import CODE, VALUE, assign_codes, distinct_state
from ..session import new_scratch_path
from ..sources.readers import file_stamps
from ..sources.retail import TABLES, raw_dataset
from .marts import build_named_mart
from .retail_model import DEFAULT_RUN_DATE, GOLD_MARTS, SILVER_JOBS
from .silver import build_silver

_TARGET_TO_JOB = {job["target"]: name for name, job in SILVER_JOBS.items()}


class RetailModel:
    def __init__(self, spark: SparkSession, sf_dir: str, run_date: date = DEFAULT_RUN_DATE):
        self.spark = spark
        self.sf_dir = sf_dir
        self.run_date = run_date
        self._silver: dict[str, DataFrame] = {}
        self._marts: dict[str, DataFrame] = {}

    def raw(self, dataset: str) -> DataFrame:
        return raw_dataset(self.spark, self.sf_dir, dataset)

    def bronze(self, dataset: str) -> DataFrame:
        return add_ingestion_date(self.raw(dataset), "ingestion_date", self.run_date)

    def _side(self, ref: str) -> DataFrame:
        layer, name = ref.split(":", 1)
        return self.bronze(name) if layer == "bronze" else self.silver(name)

    def silver(self, dataset: str) -> DataFrame:
        """Silver frame by job name (``retail_orders``) or target name
        (``retail_orders_enriched``)."""
        dataset = _TARGET_TO_JOB.get(dataset, dataset)
        if dataset not in self._silver:
            job = SILVER_JOBS[dataset]
            sides = {j["source"]: self._side(j["source"]) for j in job.get("joins", [])}
            df, _report = build_silver(job, self.bronze(dataset), sides)
            self._silver[dataset] = df
        return self._silver[dataset]

    def gold(self, mart: str, apart: bool = True) -> DataFrame:
        name = _mart_name(mart)
        return build_named_mart(name, self.silver(GOLD_MARTS[name]["source"]), apart)


def _mart_name(mart: str) -> str:
    return mart if mart.startswith("gold_") else f"gold_{mart}"


class StoredModel(RetailModel):
    """The model with its silver tables and marts written once under the shared scratch
    folder: a mart scans just the columns it needs of one silver table, a report
    reads marts."""

    def _store(self, name: str, df: DataFrame) -> DataFrame:
        path = new_scratch_path(self.spark, name)
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def silver(self, dataset: str) -> DataFrame:
        dataset = _TARGET_TO_JOB.get(dataset, dataset)
        if dataset not in self._silver:
            self._silver[dataset] = self._store(f"silver-{dataset}", super().silver(dataset))
        return self._silver[dataset]

    def customer_state(self) -> DataFrame:
        """Orders per region, segment and channel with the codes of their customers: a mart whose
        unique customers can be added up (``operators/distinct.py``)."""
        if "customer_state" not in self._marts:
            orders = self.silver("retail_orders")
            codes = assign_codes(orders.select("customer_id")).withColumnRenamed(VALUE, "customer_id")
            coded = orders.select("customer_id", "region", "segment", "channel", "total_amount").join(codes, "customer_id", "left")
            state = distinct_state(coded, ["region", "segment", "channel"], CODE, ["total_amount"])
            self._marts["customer_state"] = self._store("customer-state", state)
        return self._marts["customer_state"]

    def mart(self, mart: str) -> DataFrame:
        name = _mart_name(mart)
        if name not in self._marts:
            self._marts[name] = self._store(name, self.gold(name))
        return self._marts[name]


_STORED: dict[str, tuple[tuple, StoredModel]] = {}


def stored_model(spark: SparkSession, sf_dir: str) -> StoredModel:
    """One stored model per Spark application and input; a new one when a table has changed."""
    now = (spark.sparkContext.applicationId, *file_stamps(spark, [f"{sf_dir}/{t}.parquet" for t in TABLES]))
    if sf_dir not in _STORED or _STORED[sf_dir][0] != now:
        _STORED[sf_dir] = now, StoredModel(spark, sf_dir)
    return _STORED[sf_dir][1]
