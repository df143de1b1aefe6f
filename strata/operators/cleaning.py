"""Cleaning transforms: plain ``DataFrame -> DataFrame`` functions.

Each function builds *one* projection or filter (no per-column
``withColumn`` loops), so a chain of them stays a single codegen stage.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

# How the messages of three faults begin.
CAST_NOTHING, NO_STEP, STEP_FAILED = "cast_types requires", "Unknown transformer", "Transformer '{}' failed"

# ---------------------------------------------------------------- projections


def add_ingestion_date(df: DataFrame, column: str = "ingestion_date", run_date: date | str | None = None) -> DataFrame:
    """Stamp a date column.  Pipelines pass the run date so a backfill of an
    older day lands in that day's partition; the bare default is today."""
    value = F.current_date() if run_date is None else F.to_date(F.lit(str(run_date)))
    return df.withColumn(column, value)


def cast_types(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """Cast columns to Spark SQL type names.  Malformed values become null
    (``try_cast``), so they reach the null checks instead of failing the job."""
    if not columns:
        raise ValueError(f"{CAST_NOTHING}: 'columns' maps names to types and may not be empty")
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"cast_types: unknown column(s) {missing}")
    return df.withColumns({c: F.col(c).try_cast(t) for c, t in columns.items()})


def standardize_strings(df: DataFrame, columns: Sequence[str], lowercase: bool = True) -> DataFrame:
    """Trim spaces (only spaces, like SQL ``trim``) and optionally lowercase."""

    def fix(c: str) -> Column:
        e = F.trim(F.col(c))
        return F.lower(e) if lowercase else e

    return df.withColumns({c: fix(c) for c in columns}) if columns else df


# -------------------------------------------------------------------- filters


def not_null_predicate(df: DataFrame, columns: Sequence[str] | None = None) -> Column | None:
    """``c IS NOT NULL`` for every column, plus ``NOT isnan(c)`` for floats.

    Written as explicit predicates (not ``na.drop``) so the null tests are
    pushed into the Parquet scan as ``IsNotNull`` filters.
    """
    fields = {f.name: f.dataType for f in df.schema.fields}
    cols = list(columns) if columns else list(fields)
    preds: list[Column] = []
    for c in cols:
        if c not in fields:
            raise ValueError(f"filter_nulls: unknown column '{c}'")
        preds.append(F.col(c).isNotNull())
        if isinstance(fields[c], (DoubleType, FloatType)):
            preds.append(~F.isnan(F.col(c)))
    if not preds:
        return None
    out = preds[0]
    for p in preds[1:]:
        out = out & p
    return out


def filter_nulls(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Drop rows with a null (or NaN, for float columns) in any listed column;
    no list means every column."""
    pred = not_null_predicate(df, columns)
    return df if pred is None else df.filter(pred)


# --------------------------------------------------------------------- dedup


def _order_columns(df: DataFrame, key: Sequence[str], order_by: Iterable | None) -> list[Column]:
    """Explicit order first, then every remaining column ascending: a total
    order, so the surviving row never depends on partitioning.

    Items are a column name (ascending), ``(name, "asc" | "desc")`` or a
    Column (whose column, unknown here, may repeat in the tie-break).
    """
    explicit: list[Column] = []
    named: set[str] = set(key)
    for o in order_by or []:
        if isinstance(o, str):
            named.add(o)
            explicit.append(F.col(o).asc_nulls_first())
        elif isinstance(o, tuple):
            name, direction = o
            named.add(name)
            c = F.col(name)
            explicit.append(c.desc_nulls_last() if direction == "desc" else c.asc_nulls_first())
        else:
            explicit.append(o)
    rest = [F.col(c).asc_nulls_first() for c in df.columns if c not in named]
    return explicit + rest


def keep_first_per_key(df: DataFrame, key: Sequence[str], order_by: Iterable | None = None) -> DataFrame:
    """One row per key: the first in ``order_by`` (ties broken by all columns).

    ``row_number() = 1`` plans a ``WindowGroupLimit`` on *both* sides of the
    exchange, so each map task drops all but one row per key before the
    shuffle: a key holding a third of the rows costs one row per task.
    """
    w = Window.partitionBy(*key).orderBy(*_order_columns(df, key, order_by))
    rn = "__strata_rn"
    return df.withColumn(rn, F.row_number().over(w)).filter(F.col(rn) == 1).drop(rn)


def drop_duplicates(
    df: DataFrame,
    subset: Sequence[str] | None = None,
    order_by: Iterable | None = None,
) -> DataFrame:
    """Whole-row distinct without ``subset`` (an empty list means all columns);
    otherwise one deterministic row per ``subset`` key."""
    if not subset:
        return df.dropDuplicates()
    unknown = [c for c in subset if c not in df.columns]
    if unknown:
        raise ValueError(f"drop_duplicates: unknown column(s) {unknown}")
    return keep_first_per_key(df, subset, order_by)


def latest_per_key(df: DataFrame, key: Sequence[str], version_column: str = "ingestion_date") -> DataFrame:
    """The newest version of each key (ties broken deterministically)."""
    return keep_first_per_key(df, key, [(version_column, "desc")] if version_column in df.columns else None)


# ----------------------------------------------------------------- registry

Transform = Callable[..., DataFrame]

_TRANSFORMS: dict[str, Transform] = {
    "add_ingestion_date": add_ingestion_date,
    "cast_types": cast_types,
    "standardize_strings": standardize_strings,
    "filter_nulls": filter_nulls,
    "drop_duplicates": drop_duplicates,
    "latest_per_key": latest_per_key,
}


#: The columns a step writes, from its parameters; a step that is not here may write any.
_WRITES: dict[str, Callable[[Mapping], Iterable[str]]] = {
    "add_ingestion_date": lambda p: [p.get("column", "ingestion_date")],
    "cast_types": lambda p: p["columns"],
    "standardize_strings": lambda p: p["columns"],
    "filter_nulls": lambda p: [],
    "drop_duplicates": lambda p: [],
    "latest_per_key": lambda p: [],
}


def register_transform(name: str, fn: Transform, writes: Callable[[Mapping], Iterable[str]] | None = None) -> None:
    """``writes`` tells the columns that the step may write, from its parameters."""
    _TRANSFORMS[name] = fn
    _WRITES.pop(name, None)
    if writes is not None:
        _WRITES[name] = writes


def written_columns(step: Mapping) -> set[str] | None:
    """Columns a step may change or add; None if that is not known."""
    told = _WRITES.get(step["name"])
    return None if told is None else set(told(step.get("params") or {}))


def transform_names() -> list[str]:
    return sorted(_TRANSFORMS)


def get_transform(name: str) -> Transform:
    if name not in _TRANSFORMS:
        raise ValueError(f"{NO_STEP}: '{name}' (known: {', '.join(transform_names())})")
    return _TRANSFORMS[name]


def apply_steps(df: DataFrame, steps: Sequence[Mapping]) -> DataFrame:
    """Apply ``[{name, params}]`` in order; a step that fails analysis is
    reported with its name."""
    for step in steps or []:
        name, params = step["name"], dict(step.get("params") or {})
        fn = get_transform(name)
        if name == "drop_duplicates" and "subset" in params:
            params["subset"] = params["subset"] or None
        try:
            df = fn(df, **params)
        except Exception as exc:  # noqa: BLE001 - re-raised with context
            raise RuntimeError(f"{STEP_FAILED.format(name)}: {exc}") from exc
    return df
