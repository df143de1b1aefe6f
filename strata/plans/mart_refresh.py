"""Gold marts kept up with silver by its changes.

A mart that is refreshed incrementally is a folder of keyed tables.  ``groups`` has a row
per group: how many rows it has, and for each metric what can be added up -- exact decimal
sums, counts, distinct counts.  For each distinct count, ``pairs_<column>`` says how many
rows of a group hold a value.  A refresh takes the changes of each new commit of the silver
table (``change_feed.py``), adds them up with their signs, and merges only the groups and
pairs they touch:

* sums and counts of a group change by the signed sums;
* a distinct count grows by the pairs that came to be and falls by those that went.

So a day's refresh reads the day's changes and the mart, never all of silver.  Without
changes to go by (first run, another metric list, a gap in the feed) the mart is built
from silver as a whole, as it is where an amount can't be added up exactly (beyond the
decimal range, infinite or NaN): no exact sum can be taken back from such a one.

Every row notes the commit it has last taken in, and commits are taken in one by one, so a
refresh that was cut short can be run again: rows that have the commit are left alone.
Groups whose last row went stay as rows of no rows; ``read_mart`` leaves them out.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.money import as_amount
from ..sinks.keyed_table import merge_into, read_keyed_table, read_meta, write_keyed_table
from .change_feed import SIGN, changes_of
from .notes import newest_note, write_note
from .specs import DatasetSpec

GROUP, PAIR, ROWS, AS_OF = "group__", "pair__", "rows__", "as_of__"
SUM = "decimal(37,8)"  # a digit less than the widest, so that two add up without losing a decimal
SUMMED, COUNTED, DISTINCT = {"sum_money", "avg_money"}, {"count"}, {"count_distinct"}
WHOLE = {"sum_long"}


def metrics_of(aggregation: Mapping) -> list[tuple[str, str, str]]:
    """(name, function, column) of each metric; only such that can be added up."""
    found = [(m["name"], m.get("fn"), m.get("column")) if isinstance(m, Mapping) else tuple(m) for m in aggregation["metrics"]]
    for m in found:
        if len(m) != 3 or m[1] not in SUMMED | COUNTED | DISTINCT | WHOLE:
            raise ValueError(f"metric {m[0]!r} can't be refreshed incrementally")
    return found


def _columns(metrics: Sequence[tuple], kinds: set[str]) -> list[str]:
    return list(dict.fromkeys(c for _, fn, c in metrics if fn in kinds))


def _id(columns: Sequence[str]) -> Column:
    """One string per combination of values; nulls are values."""
    return F.to_json(F.struct(*[F.col(c).cast("string").alias(c) for c in columns]), {"ignoreNullFields": "false"})


def added_up(changes: DataFrame, aggregation: Mapping) -> DataFrame:
    """Per group, what its changes add to each part of its row."""
    metrics = metrics_of(aggregation)
    sign = F.col(SIGN).cast("long")
    parts = [F.sum(sign).alias(ROWS)]
    for c in _columns(metrics, SUMMED | WHOLE | COUNTED):
        parts.append(F.sum(F.when(F.col(c).isNotNull(), sign).otherwise(0)).alias(f"n__{c}"))
    for c in _columns(metrics, SUMMED):
        amount = as_amount(c)
        parts.append(F.coalesce(F.sum(F.when(sign > 0, amount).otherwise(-amount)), F.lit(0)).cast(SUM).alias(f"sum__{c}"))
        parts.append(F.sum(F.when(F.col(c).isNotNull() & amount.isNull(), sign).otherwise(0)).alias(f"odd__{c}"))
        parts.append(F.sum(F.when(sign > 0, F.col(c).cast("double"))).alias(f"plain__{c}"))  # of all rows, for odd ones
    for c in _columns(metrics, WHOLE):
        parts.append(F.coalesce(F.sum(sign * F.col(c).cast("long")), F.lit(0).cast("long")).alias(f"whole__{c}"))
    keys = aggregation["group_by"]
    return changes.groupBy(*keys).agg(*parts).withColumn(GROUP, _id(keys))


def _pairs(changes: DataFrame, keys: Sequence[str], column: str) -> DataFrame:
    """How many rows of a group have come to hold a value."""
    value = F.col(column).cast("string").alias("value__")
    held = changes.where(F.col(column).isNotNull()).select(_id(keys).alias(GROUP), value, F.col(SIGN).cast("long").alias("n"))
    counted = held.groupBy(GROUP, "value__").agg(F.sum("n").alias("n"))
    return counted.select(_id([GROUP, "value__"]).alias(PAIR), GROUP, "n")


class Mart:
    """The tables of one mart, under one path."""

    def __init__(self, spark: SparkSession, path: str, aggregation: Mapping):
        self.spark, self.path, self.aggregation = spark, path.rstrip("/"), aggregation
        self.keys, self.metrics = list(aggregation["group_by"]), metrics_of(aggregation)
        self.distinct, self.summed = _columns(self.metrics, DISTINCT), _columns(self.metrics, SUMMED)
        self.notes = f"{self.path}/_taken"
        self.shape = json.dumps([self.keys, self.metrics])

    def groups(self) -> DataFrame:
        return read_keyed_table(self.spark, f"{self.path}/groups")

    def pairs(self, column: str) -> str:
        return f"{self.path}/pairs_{column}"

    # ---- what has been taken in

    def taken(self) -> int | None:
        """The commit of silver the mart is at; None if it is to be built."""
        note = newest_note(self.spark, self.notes) or {}
        return note.get("commit") if note.get("shape") == self.shape else None

    def note(self, commit: int | None) -> None:
        write_note(self.spark, self.notes, {"commit": commit, "shape": self.shape})

    # ---- as a whole

    def build(self, silver: DataFrame, commit: int) -> None:
        self.note(None)  # a build cut short is not to be added to
        rows = silver.withColumn(SIGN, F.lit(1))
        groups = added_up(rows, self.aggregation)
        for c in self.distinct:
            pairs = _pairs(rows, self.keys, c).withColumns({"before": F.lit(0).cast("long"), AS_OF: F.lit(commit)})
            write_keyed_table(pairs, self.pairs(c), PAIR)
            groups = self._with_distinct(groups, c, commit)
        write_keyed_table(groups.withColumn(AS_OF, F.lit(commit)), f"{self.path}/groups", GROUP)
        self.note(commit)

    def _with_distinct(self, groups: DataFrame, column: str, commit: int) -> DataFrame:
        """With the change of the distinct count: pairs that came to be, less those that went."""
        pairs = read_keyed_table(self.spark, self.pairs(column)).where(F.col(AS_OF) == commit)
        step = (F.col("n") > 0).cast("long") - (F.col("before") > 0).cast("long")
        changed = pairs.groupBy(GROUP).agg(F.sum(step).alias("step"))
        out = groups.join(changed, GROUP, "left")
        return out.withColumn(f"distinct__{column}", F.coalesce("step", F.lit(0).cast("long"))).drop("step")

    # ---- by changes

    def take_in(self, changes: DataFrame, commit: int) -> bool:
        """Merge the changes of one commit, into the groups they touch.  False if one of
        those holds amounts that can't be kept up so."""
        delta = added_up(changes, self.aggregation).drop(*[f"plain__{c}" for c in self.summed])
        for c in self.distinct:
            self._take_in_pairs(_pairs(changes, self.keys, c), c, commit)
            delta = self._with_distinct(delta, c, commit)
        old = self.groups()
        parts = [c for c in delta.columns if c not in (*self.keys, GROUP)]
        joined = delta.alias("d").join(old.alias("o"), F.col(f"d.{GROUP}") == F.col(f"o.{GROUP}"), "left")
        rows = joined.where(F.coalesce(F.col(f"o.{AS_OF}") != commit, F.lit(True))).select(
            *[F.col(f"d.`{c}`").alias(c) for c in (*self.keys, GROUP)],
            *[(F.coalesce(F.col(f"o.`{c}`"), F.lit(0)) + F.col(f"d.`{c}`")).cast(old.schema[c].dataType).alias(c) for c in parts],
            *[F.lit(None).cast("double").alias(f"plain__{c}") for c in self.summed],
            F.lit(commit).alias(AS_OF),
        )
        merge_into(rows, f"{self.path}/groups", GROUP, check_unique=False)
        odd = F.greatest(F.lit(0), F.lit(0), *[F.abs(f"odd__{c}") for c in self.summed])
        return self.groups().where((F.col(AS_OF) == commit) & (odd > 0)).isEmpty()

    def _take_in_pairs(self, delta: DataFrame, column: str, commit: int) -> None:
        path = self.pairs(column)
        old = read_keyed_table(self.spark, path).select(PAIR, F.col("n").alias("held"), "before", AS_OF)
        fresh = F.coalesce(F.col(AS_OF) != commit, F.lit(True))
        held = F.coalesce("held", F.lit(0).cast("long"))
        rows = delta.where("n <> 0").join(old, PAIR, "left").where(fresh).select(
            PAIR, GROUP, (held + F.col("n")).alias("n"), held.alias("before"), F.lit(commit).alias(AS_OF)
        )
        merge_into(rows, path, PAIR, check_unique=False)

    # ---- what it says

    def frame(self) -> DataFrame:
        out = []
        for name, fn, c in self.metrics:
            if fn in SUMMED:
                total = F.when(F.col(f"odd__{c}") == 0, F.col(f"sum__{c}").cast("double")).otherwise(F.col(f"plain__{c}"))
                value = F.when(F.col(f"n__{c}") > 0, total) if fn == "sum_money" else F.try_divide(total, F.col(f"n__{c}"))
            elif fn in WHOLE:
                value = F.when(F.col(f"n__{c}") > 0, F.col(f"whole__{c}"))
            else:
                value = F.col(f"n__{c}" if fn in COUNTED else f"distinct__{c}")
            out.append(value.alias(name))
        return self.groups().where(F.col(ROWS) > 0).select(*self.keys, *out)

    def touched_by(self, commit: int) -> DataFrame:
        """The groups that a commit of silver was the last to change."""
        return self.groups().where((F.col(AS_OF) == commit) & (F.col(ROWS) > 0)).select(*self.keys)


def read_mart(spark: SparkSession, path: str, aggregation: Mapping) -> DataFrame:
    """The mart's groups and metrics, as a full build gives them."""
    return Mart(spark, path, aggregation).frame()


def refresh(spark: SparkSession, spec: DatasetSpec) -> int:
    """Bring the mart of a gold spec up to its silver table; how many groups it has."""
    silver = spec.source["path"]
    mart, meta = Mart(spark, spec.sink["path"], spec.aggregation), read_meta(spark, silver)
    if meta is None:
        read_keyed_table(spark, silver)  # raises: not there
        raise ValueError(f"{silver} is not a keyed table: its marts can't be refreshed incrementally")
    at = mart.taken()
    while at is not None and at < meta.commit:
        changes = changes_of(spark, silver, meta, at + 1)
        if changes is None or not mart.take_in(changes, at + 1):
            at = None
        else:
            at += 1
            mart.note(at)
    if at is None:
        mart.build(read_keyed_table(spark, silver), meta.commit)
    return mart.groups().where(F.col(ROWS) > 0).count()
