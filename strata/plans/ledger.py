"""Run ledger: the last run of every dataset.

Stored as an append-only log of run records (one small Parquet file per
record, a single write job); the ledger's state is the newest record per
dataset, i.e. an upsert on ``dataset_name`` as seen by readers, plus the
history for free.  State is read once per layer (``snapshot``); it has one
row per dataset, the only thing the runner collects to the driver.  The log is
never rewritten: a run adds one small file per layer.
"""

from __future__ import annotations

import logging
import time
from datetime import date, datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.cleaning import keep_first_per_key

log = logging.getLogger(__name__)

# The ledger's columns and the run statuses.
LEDGER_SCHEMA = (
    "dataset_name string, layer string, last_processed_date date, "
    "last_run_timestamp timestamp, rows_processed long, status string"
)
SUCCESS, SKIPPED, FAILED = "success", "skipped", "failed"
_SEQ = "record_seq"
_LOG_SCHEMA = f"{LEDGER_SCHEMA}, {_SEQ} long"


class RunLedger:
    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path

    def _log(self) -> DataFrame | None:
        try:
            return self.spark.read.schema(_LOG_SCHEMA).parquet(self.path)
        except AnalysisException as exc:
            if exc.getCondition() == "PATH_NOT_FOUND":
                return None
            raise

    def frame(self) -> DataFrame:
        """Current state: the newest record of each dataset."""
        records = self._log()
        if records is None:
            return self.spark.createDataFrame([], LEDGER_SCHEMA)
        return keep_first_per_key(records, ["dataset_name"], [(_SEQ, "desc")]).drop(_SEQ)

    def _bounds(self) -> DataFrame:
        """Latest date each dataset was ever processed for with success."""
        records = self._log().where(F.col("status") == SUCCESS)
        return records.groupBy("dataset_name").agg(F.max("last_processed_date").alias("latest_success"))

    def snapshot(self) -> dict[str, dict]:
        """``dataset_name -> last run`` (one row per dataset); an unreadable
        ledger means "nothing ran"."""
        try:
            if self._log() is None:
                return {}
            state = self.frame().join(self._bounds(), "dataset_name", "left")
            return {r["dataset_name"]: r.asDict() for r in state.collect()}
        except Exception as exc:  # noqa: BLE001 - any error means "never ran"
            log.warning("ledger unreadable (%s): treating every dataset as never run", exc)
            return {}

    def get(self, dataset: str) -> dict | None:
        return self.snapshot().get(dataset)

    @staticmethod
    def entry(dataset: str, layer: str, rows: int, run_date: date, status: str) -> tuple:
        """One run record (timestamped now)."""
        if status not in (SUCCESS, SKIPPED, FAILED):
            raise ValueError(f"unknown status {status!r}")
        now = datetime.now(timezone.utc).replace(tzinfo=None)
        return (dataset, layer, run_date, now, int(rows), status, time.time_ns())

    def record_many(self, entries: list[tuple]) -> bool:
        """Append run records in one write.  A failed write is logged, not
        raised (the datasets' own results stand; the next run redoes them)."""
        if not entries:
            return True
        try:
            self.spark.createDataFrame(entries, _LOG_SCHEMA).coalesce(1).write.mode("append").parquet(self.path)
        except Exception as exc:  # noqa: BLE001 - ledger errors never fail a dataset
            log.error("ledger write failed for %s: %s", [e[0] for e in entries], exc)
            return False
        return True

    def record(self, dataset: str, layer: str, rows: int, run_date: date, status: str) -> bool:
        return self.record_many([self.entry(dataset, layer, rows, run_date, status)])


def should_skip(state: dict[str, dict], dataset: str, run_date: date) -> bool:
    """Skip a dataset already processed successfully for this run date."""
    last = state.get(dataset)
    return bool(last) and last["status"] == SUCCESS and str(last["last_processed_date"]) == str(run_date)


def incremental_bound(state: dict[str, dict], dataset: str) -> date | None:
    """Lower bound for an incremental read: the latest date processed with success.
    A backfill of an older date doesn't move it back.  A skipped or failed last run
    clears it (full read)."""
    last = state.get(dataset)
    if last and last["status"] == SUCCESS:
        return max(d for d in (last.get("latest_success"), last["last_processed_date"]) if d is not None)
    return None
