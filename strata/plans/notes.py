"""Small JSON notes beside a table: what a derived table has taken in so far.

Each note is a numbered folder, written once; the newest complete one counts, so a
crash while writing leaves the one before."""

from __future__ import annotations

import json

from pyspark.sql import SparkSession

from ..sinks.keyed_table import _children, _exists, delete_folder

KEPT = 3


def _complete(spark: SparkSession, folder: str) -> list[str]:
    return [n for n in _children(spark, folder) if _exists(spark, f"{folder}/{n}/_SUCCESS")]


def newest_note(spark: SparkSession, folder: str) -> dict | None:
    names = _complete(spark, folder)
    return json.loads(spark.read.text(f"{folder}/{names[-1]}").first()[0]) if names else None


def write_note(spark: SparkSession, folder: str, doc: dict) -> None:
    names = _children(spark, folder)
    number = int(names[-1]) + 1 if names else 0
    row = spark.createDataFrame([(json.dumps(doc),)], "doc string")
    row.coalesce(1).write.mode("errorifexists").text(f"{folder}/{number:08d}")
    for old in _complete(spark, folder)[:-KEPT]:
        delete_folder(spark, f"{folder}/{old}")
