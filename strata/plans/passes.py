"""Joining a large batch in a few passes.

Each join of a batch shuffles it whole, and a query's shuffle files stay until it ends: a
batch with two lookups would be on disk once for every shuffle.  A large batch is staged
before its joins instead, and then joined part by part, each part a query of its own.  The
joins must be lookups (``specs.LOOKUPS``): what becomes of a row depends on no other."""

from __future__ import annotations

import logging
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..session import freed_shuffles, new_scratch_path
from ..sinks.keyed_table import _children, _fs, delete_folder, passes_for, stage, staged_parts
from .specs import LOOKUPS, DatasetSpec

log = logging.getLogger(__name__)

BYTES = 64 << 20  # of files as landed; a batch of less is joined as it comes
DAY = "ingestion_date="


def landed_bytes(spark: SparkSession, spec: DatasetSpec) -> int:
    """Size of the files that the spec reads: of the days that it asks for, where landed by day.
    0 for what is not there or no folder (reading it will tell)."""
    root = spec.source["path"].rstrip("/")
    try:
        names = _children(spark, root)
        days = [n for n in names if n.startswith(DAY)]
        if spec.since:
            days = [d for d in days if d.removeprefix(DAY) > str(spec.since) or d == f"{DAY}{spec.run_day}"]
        wanted = [f"{root}/{d}" for d in days] if any(n.startswith(DAY) for n in names) else [root] if names else []
        return sum(fs.getContentSummary(where).getLength() for fs, where in (_fs(spark, p) for p in wanted))
    except Exception as exc:  # noqa: BLE001 - a size only tells how to go about it
        log.info("size of %s not known: %s", root, exc)
        return 0


class Passes:
    """Staged rows of one run; ``drop`` deletes them."""

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, []

    @classmethod
    def of(cls, spark: SparkSession, spec: DatasetSpec) -> Passes | None:
        """For a spec that is to be joined in passes."""
        lookups = bool(spec.joins) and spec.joins_are(LOOKUPS)
        return cls(spark) if lookups and landed_bytes(spark, spec) >= BYTES else None

    def _new(self, name: str) -> str:
        self.paths.append(new_scratch_path(self.spark, name))
        return self.paths[-1]

    def joined(self, df: DataFrame, join: Callable[[DataFrame], DataFrame]) -> DataFrame:
        """``join(df)``, computed by now."""
        if any("void" in t or "interval" in t for _, t in df.dtypes):  # Parquet has no such columns
            return join(df)
        before, after = self._new("batch"), self._new("joined")
        with freed_shuffles(self.spark):
            stage(df, before)
            rows = self.spark.read.schema(df.schema).parquet(before).count()
            for part in staged_parts(self.spark, before, df.schema, passes_for(rows)):
                out = join(part)
                stage(out, after)
        delete_folder(self.spark, before)
        return self.spark.read.schema(out.schema).parquet(after)

    def drop(self) -> None:
        for path in self.paths:
            delete_folder(self.spark, path)
        self.paths.clear()
