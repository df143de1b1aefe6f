"""Writers: one registry of ``format -> write function``.

A sink spec is ``{format, path, mode, partition_by?, overwrite_mode?,
merge_key?, options?}``.  Modes are honoured as named (``append`` appends,
``overwrite`` replaces, ``errorifexists``/``ignore`` as Spark defines them);
``merge`` upserts into a keyed table.
"""

from __future__ import annotations

import os
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame

from ..session import table_codec
from .keyed_table import merge_into, write_keyed_table

WriteFn = Callable[[DataFrame, str, str, Mapping], object]

_FILE_MODES = {"overwrite", "append", "errorifexists", "error", "ignore"}


def _file_writer(df: DataFrame, fmt: str, path: str, mode: str, spec: Mapping):
    if mode not in _FILE_MODES:
        raise ValueError(f"Unsupported mode '{mode}' for format '{fmt}'")
    partition_by: Sequence[str] = spec.get("partition_by") or []
    if partition_by and spec.get("rebalance"):
        # Opt-in for inputs whose tasks would each write many partitions:
        # rebalance (AQE) rather than repartition(partition columns), so a day
        # holding most of the batch is split over several writers and small
        # ones are coalesced.  A single-date batch needs no shuffle: each
        # input split writes one file of about its own size.
        df = df.hint("rebalance", *partition_by)
    options = {k: str(v) for k, v in (spec.get("options") or {}).items()}
    if fmt == "parquet" and not any(k.lower() in ("compression", "parquet.compression") for k in options):
        options["compression"] = table_codec(df.sparkSession)
    w = df.write.mode(mode).options(**options)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if spec.get("overwrite_mode") == "dynamic":
        w = w.option("partitionOverwriteMode", "dynamic")
    w.format(fmt).save(path)


def write_parquet(df, path, mode="overwrite", spec=None):
    _file_writer(df, "parquet", path, mode, spec or {})


def write_csv(df, path, mode="overwrite", spec=None):
    _file_writer(df, "csv", path, mode, spec or {})


def write_json(df, path, mode="overwrite", spec=None):
    _file_writer(df, "json", path, mode, spec or {})


def write_table(df, path, mode="overwrite", spec=None):
    """Keyed table: ``merge`` upserts on ``merge_key``; other modes write."""
    spec = spec or {}
    key = spec.get("merge_key") or spec.get("key")
    if mode == "merge":
        if not key:
            raise ValueError("merge mode needs 'merge_key'")
        return merge_into(
            df, path, key, check_unique=spec.get("check_unique", True), version=spec.get("version_column"),
            check=spec.get("check"), after_commit=spec.get("after_commit"),
        )
    if not key:
        raise ValueError("keyed table writes need 'merge_key' (the table key)")
    return write_keyed_table(df, path, key, mode)


def jdbc_properties(spec: Mapping) -> tuple[str, str, dict]:
    """URL, qualified table and connection properties of a JDBC sink.

    Connection settings come from the spec or the environment: ``JDBC_URL``,
    ``JDBC_USER``, ``JDBC_PASSWORD``, ``JDBC_DRIVER``, or for a ``postgres``
    sink ``POSTGRES_HOST``, ``POSTGRES_PORT``, ``POSTGRES_DB``,
    ``POSTGRES_USER``, ``POSTGRES_PASSWORD``.  The schema defaults to
    ``public`` and is then left unqualified.
    """
    env = os.environ
    opts = dict(spec.get("options") or {})
    url = spec.get("url") or opts.pop("url", None) or env.get("JDBC_URL")
    pg = spec.get("format") == "postgres"
    if not url and pg and env.get("POSTGRES_HOST"):
        url = f"jdbc:postgresql://{env['POSTGRES_HOST']}:{env.get('POSTGRES_PORT', '5432')}/{env.get('POSTGRES_DB', '')}"
    if not url:
        raise ValueError("JDBC sink needs a url (spec 'url', JDBC_URL or POSTGRES_HOST)")
    table = spec.get("table")
    if not table:
        raise ValueError("JDBC sink needs 'table'")
    schema = spec.get("schema", "public")
    qualified = table if schema in (None, "", "public") else f"{schema}.{table}"
    props = {
        "user": spec.get("user") or env.get("JDBC_USER") or (env.get("POSTGRES_USER", "") if pg else ""),
        "password": spec.get("password") or env.get("JDBC_PASSWORD") or (env.get("POSTGRES_PASSWORD", "") if pg else ""),
        "batchsize": str(spec.get("batchsize", 10000)),
    }
    driver = spec.get("driver") or env.get("JDBC_DRIVER") or ("org.postgresql.Driver" if pg else None)
    if driver:
        props["driver"] = driver
    props.update({k: str(v) for k, v in opts.items()})
    return url, qualified, props


def write_jdbc(df, path, mode="overwrite", spec=None):
    """Gold marts to a database.  ``overwrite`` truncates and re-inserts
    (keeps the table's DDL and grants) instead of drop + create; the number
    of concurrent connections is bounded by ``num_partitions``."""
    spec = dict(spec or {})
    if path and not spec.get("table"):
        spec["table"] = path
    url, table, props = jdbc_properties(spec)
    if mode == "overwrite":
        props.setdefault("truncate", "true")
    n = int(spec.get("num_partitions", 8))
    props.setdefault("numPartitions", str(n))
    # A shuffle: coalesce would squeeze the mart's own aggregation into n tasks.
    df.repartition(n).write.jdbc(url=url, table=table, mode=mode, properties=props)


_WRITERS: dict[str, WriteFn] = {
    "parquet": write_parquet,
    "csv": write_csv,
    "json": write_json,
    "table": write_table,
    "delta": write_table,
    "jdbc": write_jdbc,
    "postgres": write_jdbc,
}


def register_writer(fmt: str, fn: WriteFn) -> None:
    _WRITERS[fmt] = fn


def writer_formats() -> list[str]:
    return sorted(_WRITERS)


def get_writer(fmt: str) -> WriteFn:
    if fmt not in _WRITERS:
        raise ValueError(f"Unsupported writer format '{fmt}'. Registered: {writer_formats()}")
    return _WRITERS[fmt]


def write_spec(df: DataFrame, spec: Mapping):
    """Write per a sink spec."""
    fmt = spec["format"]
    return get_writer(fmt)(df, spec.get("path", ""), spec.get("mode", "overwrite"), spec)
