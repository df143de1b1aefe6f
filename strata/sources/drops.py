"""Dated drop folders as a data source of their own: ``spark.read.format("drops")``.

A drop folder is a path with ``{year}``, ``{month}``, ``{day}`` (``paths.DropFolder``) under
which Parquet files are landed.  As a source, every row has the ``drop_date`` of its folder;
filters on that column choose the folders before any is opened, and a stream takes one
folder after another, with the last day read as its offset::

    register(spark)
    spark.read.format("drops").option("first", "2024-01-01").load("s3://bucket/{year}/{month}/{day}")
    spark.readStream.format("drops").schema(...).option("first", "2024-01-01").load(...)

Options: ``first`` and ``last`` day (``last``: today), ``files`` (default ``*.parquet``; the
path may also name one file).  Each file is a partition, read in record batches of the
wanted columns.  Paths are opened through ``pyarrow.fs``; where that knows no such store,
``resolve_date_range`` with Spark's own reader does the same scan.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from datetime import date, timedelta
from fnmatch import fnmatch

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import SparkSession
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    DataSourceStreamReader,
    EqualTo,
    Filter,
    GreaterThan,
    GreaterThanOrEqual,
    In,
    InputPartition,
    LessThan,
    LessThanOrEqual,
)
from pyspark.sql.pandas.types import from_arrow_schema, to_arrow_schema
from pyspark.sql.types import DateType, StructField, StructType

from .paths import DropFolder

DAY = "drop_date"
BATCH_ROWS = 1 << 16

#: Which days a filter on ``drop_date`` leaves.
KEEPS = {
    EqualTo: lambda f, day: day == f.value,
    In: lambda f, day: day in f.value,
    GreaterThan: lambda f, day: day > f.value,
    GreaterThanOrEqual: lambda f, day: day >= f.value,
    LessThan: lambda f, day: day < f.value,
    LessThanOrEqual: lambda f, day: day <= f.value,
}


def _days(first: date, last: date) -> list[date]:
    return [first + timedelta(k) for k in range((last - first).days + 1)]


def _located(path: str) -> tuple[fs.FileSystem, str]:
    """The store of a path, and the path there; without a scheme it is a local one."""
    uri = re.sub(r"^(file:)?/+", "file:///", path)
    return fs.FileSystem.from_uri(uri)


@dataclass
class DropFile(InputPartition):
    day: date
    path: str


@dataclass
class Drops:
    """What there is to read."""

    template: str
    first: date
    last: date
    files: str

    def __post_init__(self):
        self.folder = DropFolder.parse(self.template)

    def landed(self, day: date) -> list[DropFile]:
        """Files of a day; none if nothing was landed."""
        where = self.folder.on(day)
        store, path = _located(where)
        if store.get_file_info(path).type == fs.FileType.File:
            return [DropFile(day, where)]
        inside = store.get_file_info(fs.FileSelector(path, allow_not_found=True))
        names = sorted(i.base_name for i in inside if i.type == fs.FileType.File and fnmatch(i.base_name, self.files))
        return [DropFile(day, f"{where.rstrip('/')}/{n}") for n in names if not n.startswith(("_", "."))]

    def read(self, part: DropFile, schema: StructType) -> Iterator[pa.RecordBatch]:
        """A file's batches as the schema has them; columns it lacks are null."""
        store, path = _located(part.path)
        target = to_arrow_schema(schema)
        with store.open_input_file(path) as handle:
            file = pq.ParquetFile(handle)
            own = [n for n in target.names if n in file.schema_arrow.names and n != DAY]
            for batch in file.iter_batches(BATCH_ROWS, columns=own):
                columns = []
                for f in target:
                    if f.name == DAY:
                        columns.append(pa.array([part.day], pa.date32()).take(pa.array([0] * batch.num_rows, pa.int32())))
                    else:
                        columns.append(batch.column(f.name).cast(f.type) if f.name in own else pa.nulls(batch.num_rows, f.type))
                yield pa.RecordBatch.from_arrays(columns, schema=target)


class DropReader(DataSourceReader):
    def __init__(self, drops: Drops, schema: StructType):
        self.drops, self.schema = drops, schema
        self.days = _days(drops.first, drops.last)

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        for f in filters:
            if type(f) in KEEPS and tuple(f.attribute) == (DAY,):
                self.days = [d for d in self.days if KEEPS[type(f)](f, d)]
            else:
                yield f

    def partitions(self) -> list[DropFile]:
        return [f for d in self.days for f in self.drops.landed(d)]

    def read(self, partition: DropFile) -> Iterator[pa.RecordBatch]:
        return self.drops.read(partition, self.schema) if partition is not None else iter(())


class DropStream(DataSourceStreamReader):
    """A micro-batch holds the days landed since the last one; the offset is the last of them."""

    def __init__(self, drops: Drops, schema: StructType):
        self.drops, self.schema = drops, schema

    def initialOffset(self) -> dict:
        return {"day": str(self.drops.first - timedelta(1))}

    def latestOffset(self) -> dict:
        landed = (d for d in reversed(_days(self.drops.first, self.drops.last)) if self.drops.landed(d))
        return {"day": str(next(landed, self.drops.first - timedelta(1)))}

    def partitions(self, start: dict, end: dict) -> list[DropFile]:
        after = date.fromisoformat(start["day"]) + timedelta(1)
        return [f for d in _days(after, date.fromisoformat(end["day"])) for f in self.drops.landed(d)]

    def read(self, partition: DropFile) -> Iterator[pa.RecordBatch]:
        return self.drops.read(partition, self.schema)


class DropSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "drops"

    @property
    def drops(self) -> Drops:
        if "path" not in self.options or "first" not in self.options:
            raise ValueError("drops: a path and the option 'first' (a date) are needed")
        first = date.fromisoformat(self.options["first"])
        last = date.fromisoformat(self.options["last"]) if "last" in self.options else date.today()
        return Drops(self.options["path"], first, last, self.options.get("files", "*.parquet"))

    def schema(self) -> StructType:
        """That of the newest file, and the day."""
        drops = self.drops
        for day in reversed(_days(drops.first, drops.last)):
            for file in drops.landed(day)[:1]:
                store, path = _located(file.path)
                with store.open_input_file(path) as handle:
                    found = from_arrow_schema(pq.read_schema(handle))
                return StructType([*found.fields, StructField(DAY, DateType())])
        raise ValueError(f"drops: nothing landed in {drops.template} from {drops.first} to {drops.last}")

    def reader(self, schema: StructType) -> DropReader:
        return DropReader(self.drops, schema)

    def streamReader(self, schema: StructType) -> DropStream:
        return DropStream(self.drops, schema)


def register(spark: SparkSession) -> None:
    """Make the format known, and let filters reach it."""
    spark.dataSource.register(DropSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
