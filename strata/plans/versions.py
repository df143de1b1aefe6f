"""The newest version of every key of a bronze table, kept beside its history.

A bronze table holds a version of a key for every day it was landed.  Looking keys up in
it would read all days, each run more.  ``newest_side`` keeps a keyed table with one row
per key instead, and brings it up to date before it is read: only the days that are new
since then are scanned and merged (an older day, filled in later, never replaces newer
rows).  A day that was landed again, or a column not kept so far, has it built anew.

What it holds is noted with the names of each day's files, which Spark never uses twice,
so a stale side is never read, whoever wrote the bronze table.  A crash between merge
and note repeats the merge, which changes nothing.
"""

from __future__ import annotations

import hashlib
import threading
from collections import defaultdict
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.cleaning import latest_per_key
from ..sinks.keyed_table import merge_into, read_keyed_table, read_meta, write_keyed_table
from .notes import newest_note, write_note

DAY = "ingestion_date"
_ONE_AT_A_TIME: dict[str, threading.Lock] = defaultdict(threading.Lock)


def side_path(bronze: str, on: str) -> str:
    return f"{bronze.rstrip('/')}_newest_by_{on}"


def landed_days(history: DataFrame) -> dict[str, str]:
    """Each day's folder and a digest of the names of its files."""
    names = defaultdict(list)
    for path in history.inputFiles():
        folder, name = path.rsplit("/", 1)
        names[folder.rsplit(f"{DAY}=", 1)[-1]].append(name)
    return {day: hashlib.md5(",".join(sorted(files)).encode()).hexdigest() for day, files in names.items()}


def rows_of_days(history: DataFrame, days: Sequence[str]) -> DataFrame:
    return history.where(F.col(DAY).isin([F.to_date(F.lit(d)) for d in days]))


def newest_side(spark: SparkSession, history: DataFrame, bronze: str, join: Mapping) -> DataFrame | None:
    """One row per non-null key: its newest version in ``history``, the bronze table as read.
    None if the table is not landed by day."""
    on = join["on"]
    if DAY not in history.columns or not isinstance(on, str):
        return None
    asked = [c for c in join.get("select") or history.columns if c in history.columns]
    keep = list(dict.fromkeys([on, *asked, DAY]))
    path = side_path(bronze, on)
    notes = f"{path}/_landed"
    keyed = history.where(F.col(on).isNotNull())
    with _ONE_AT_A_TIME[path]:
        meta, held = read_meta(spark, path), (newest_note(spark, notes) or {}).get("days", {})
        now = landed_days(history)
        fresh = sorted(set(now) - set(held))
        if meta is None or not set(keep) <= set(meta.schema.names) or any(now.get(d) != files for d, files in held.items()):
            # Columns that other lookups have asked for stay.
            wider = list(dict.fromkeys([*keep, *(c for c in (meta.schema.names if meta else ()) if c in history.columns)]))
            write_keyed_table(latest_per_key(keyed.select(*wider), [on]), path, on)
        elif fresh:
            wider = [c for c in meta.schema.names if c in history.columns]
            batch = rows_of_days(keyed.select(*wider), fresh)
            merge_into(latest_per_key(batch, [on]), path, on, check_unique=False, version=DAY)
        if fresh or now != held:
            write_note(spark, notes, {"days": now})
        return read_keyed_table(spark, path).select(*keep)
