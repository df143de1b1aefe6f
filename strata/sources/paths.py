"""Date-templated drop folders and incremental scans."""

from __future__ import annotations

import string
from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class DropFolder:
    """A path in which ``{year}``, ``{month}`` and ``{day}`` stand for parts of a date.

    It is parsed once, into literal text and the fields between; a field that no date
    has is an error then, not in the middle of a run.  Days that a path doesn't tell
    apart share a folder."""

    parts: tuple[tuple[str, str | None], ...]

    @classmethod
    def parse(cls, path: str) -> DropFolder:
        parts = tuple((text, field) for text, field, _, _ in string.Formatter().parse(path))
        unknown = sorted({f for _, f in parts if f is not None} - {"year", "month", "day"})
        if unknown:
            raise ValueError(f"Unknown placeholder(s) {unknown} in path '{path}'")
        return cls(parts)

    def on(self, day: date) -> str:
        """The folder of one day: four digits of the year, two of month and day."""
        digits = dict(zip(("year", "month", "day"), day.isoformat().split("-"), strict=True))
        return "".join(text + digits.get(field, "") for text, field in self.parts)

    def between(self, first: date, last: date) -> list[str]:
        """The folders of all days from ``first`` to ``last``, each once: one scan for a backfill."""
        if last < first:
            raise ValueError("end date before start date")
        days = (first + timedelta(k) for k in range((last - first).days + 1))
        return list(dict.fromkeys(map(self.on, days)))


def check_template(path: str) -> None:
    DropFolder.parse(path)


def resolve_date_template(path: str, run_date: date) -> str:
    return DropFolder.parse(path).on(run_date)


def resolve_date_range(path: str, start: date, end: date) -> list[str]:
    return DropFolder.parse(path).between(start, end)


def after_date(column: str, lower_exclusive: date | str) -> Column:
    """Predicate ``column > lower`` (strict).  Kept bare on the left so a
    partition column prunes directories (``PartitionFilters``)."""
    return F.col(column) > F.to_date(F.lit(str(lower_exclusive)))


def incremental(
    df: DataFrame,
    lower_exclusive: date | str | None,
    column: str = "ingestion_date",
    run_date: date | str | None = None,
) -> DataFrame:
    """Rows newer than the last processed date, and those of ``run_date`` itself, which
    may be older (a backfill); no lower bound means a full read."""
    if lower_exclusive is None:
        return df
    wanted = after_date(column, lower_exclusive)
    if run_date is not None:
        wanted = wanted | (F.col(column) == F.to_date(F.lit(str(run_date))))
    return df.filter(wanted)
