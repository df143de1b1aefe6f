"""Readers: one registry of ``format -> read function``.

Every reader has the signature ``(spark, path, options, schema) -> DataFrame``
and is a direct ``DataFrameReader`` call, so Catalyst sees a plain scan and
pushes filters and column pruning into it.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

ReadFn = Callable[[SparkSession, str, Mapping[str, str], "StructType | str | None"], DataFrame]


def _reader(spark: SparkSession, options: Mapping[str, str], schema):
    r = spark.read.options(**{k: str(v) for k, v in (options or {}).items()})
    return r.schema(schema) if schema is not None else r


def read_csv(spark, path, options=None, schema=None) -> DataFrame:
    # No implicit header/inference: options pass straight through.
    return _reader(spark, options, schema).csv(path)


def read_parquet(spark, path, options=None, schema=None) -> DataFrame:
    return _reader(spark, options, schema).parquet(path)


def read_json(spark, path, options=None, schema=None) -> DataFrame:
    return _reader(spark, options, schema).json(path)


def read_keyed(spark, path, options=None, schema=None) -> DataFrame:
    """A keyed table; a plain (e.g. date-partitioned bronze) Parquet table
    at the same kind of path is read as is."""
    from ..sinks.keyed_table import read_keyed_table

    return read_keyed_table(spark, path, fallback=_reader(spark, options, schema))


def read_jdbc(spark, path, options=None, schema=None) -> DataFrame:
    """``path`` is the table name; ``options`` carry url/driver/credentials."""
    opts = dict(options or {})
    opts.setdefault("dbtable", path)
    return spark.read.format("jdbc").options(**opts).load()


# Formats known to the library.  ``table`` is the keyed (upsertable) table of
# ``sinks.keyed_table``; ``delta`` names the same stand-in because the Delta
# jar is not on the classpath here -- register a real Delta reader to replace it.
_READERS: dict[str, ReadFn] = {
    "csv": read_csv,
    "parquet": read_parquet,
    "json": read_json,
    "table": read_keyed,
    "delta": read_keyed,
    "jdbc": read_jdbc,
    "postgres": read_jdbc,
}


def register_reader(fmt: str, fn: ReadFn) -> None:
    _READERS[fmt] = fn


def reader_formats() -> list[str]:
    return sorted(_READERS)


def get_reader(fmt: str) -> ReadFn:
    if fmt not in _READERS:
        raise ValueError(f"Unsupported reader format '{fmt}'. Registered: {reader_formats()}")
    return _READERS[fmt]


def read(spark: SparkSession, fmt: str, path: str, options=None, schema=None) -> DataFrame:
    return get_reader(fmt)(spark, path, options or {}, schema)


def read_spec(spark: SparkSession, spec: Mapping) -> DataFrame:
    """Read a ``{format, path, options}`` source spec."""
    options = {k: v for k, v in (spec.get("options") or {}).items() if k not in ("incremental_from", "incremental_date")}
    return read(spark, spec["format"], spec["path"], options, spec.get("schema"))


def is_missing_path(exc: BaseException) -> bool:
    """True when Spark refused a read because the input path does not exist."""
    return isinstance(exc, AnalysisException) and exc.getCondition() == "PATH_NOT_FOUND"


def file_stamps(spark: SparkSession, paths: Sequence[str]) -> tuple:
    """Size and time of change of each path, None where there is none: whether inputs are still the same."""
    out = []
    for path in paths:
        where = spark._jvm.org.apache.hadoop.fs.Path(path)
        fs = where.getFileSystem(spark._jsc.hadoopConfiguration())
        status = fs.getFileStatus(where) if fs.exists(where) else None
        out.append(status and (status.getLen(), status.getModificationTime()))
    return tuple(out)
