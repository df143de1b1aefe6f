"""Keyed upsert as a DataFrame expression (MERGE semantics).

``upsert_frames(target, source, key)`` returns the merged relation:

* target row with a matching source row -> the source's values replace the
  target's for every source column (target-only columns keep their values);
* source row without a match -> inserted (target-only columns null);
* target row without a match -> kept (source-only columns null).

With ``version`` a match replaces the target row only if the source's version is
not older, so late files and replays never undo newer rows.

Keys compare with ``=``, so null keys never match and both sides' null-key rows
are kept.  It is one full outer join, each side read and shuffled once; rows
with a null key carry a hash of the row as a second join key, which spreads
them over all tasks (they would otherwise meet in one).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_S, _T, _PRESENT, _SPREAD = "s__", "t__", "s__present", "spread__"


def _keys(key: str | Sequence[str]) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def any_null(keys: Sequence[str]) -> Column:
    cond = F.col(keys[0]).isNull()
    for k in keys[1:]:
        cond = cond | F.col(k).isNull()
    return cond


def spread(df: DataFrame, keys: Sequence[str]) -> Column:
    """0 for keyed rows, a hash of the whole row for rows with a null key."""
    plain = [F.col(c) for c, t in df.dtypes if not t.startswith("map")]
    return F.when(any_null(keys), F.xxhash64(*plain)).otherwise(F.lit(0).cast("long"))


def output_columns(target: DataFrame, source: DataFrame) -> list[str]:
    """Target columns in order, then columns only the source has."""
    return target.columns + [c for c in source.columns if c not in target.columns]


def duplicate_keys(source: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Keys that occur more than once (non-null keys only)."""
    keys = _keys(key)
    return source.filter(~any_null(keys)).groupBy(*keys).count().filter(F.col("count") > 1)


def upsert_frames(
    target: DataFrame,
    source: DataFrame,
    key: str | Sequence[str],
    co_keys: Sequence[str] = (),
    version: str | None = None,
) -> DataFrame:
    """Merge ``source`` into ``target`` on ``key``.

    ``co_keys`` are extra columns that are functions of the row (e.g. a hash
    bucket of the key); joining on them too lets a caller pre-partition both
    sides by them and keep that partitioning through the join.  They must spread
    null-key rows themselves.
    """
    keys = _keys(key)
    needed = keys + list(co_keys) + ([version] if version else [])
    missing = [k for k in needed if k not in target.columns or k not in source.columns]
    if missing:
        raise ValueError(f"upsert: key column(s) {missing} missing on one side")
    out = output_columns(target, source)
    src_cols, tgt_cols = set(source.columns), set(target.columns)

    s = source.select(*[F.col(c).alias(_S + c) for c in source.columns], F.lit(True).alias(_PRESENT), spread(source, keys).alias(_S + _SPREAD))
    t = target.select(*[F.col(c).alias(_T + c) for c in target.columns], spread(target, keys).alias(_T + _SPREAD))
    on = list(co_keys) + keys + ([] if co_keys else [_SPREAD])
    cond = F.lit(True)
    for k in on:
        cond = cond & (F.col(_T + k) == F.col(_S + k))
    joined = t.join(s, cond, "full_outer")

    from_source = F.col(_PRESENT).isNotNull()
    if version:
        older = F.col(_T + version).isNotNull() & F.coalesce(F.col(_S + version) < F.col(_T + version), F.lit(True))
        from_source = from_source & ~older
    cols = []
    for c in out:
        if c in src_cols and c in tgt_cols:
            cols.append(F.when(from_source, F.col(_S + c)).otherwise(F.col(_T + c)).alias(c))
        elif c in src_cols:
            cols.append((F.when(from_source, F.col(_S + c)) if version else F.col(_S + c)).alias(c))
        else:
            cols.append(F.col(_T + c).alias(c))
    return joined.select(*cols)
