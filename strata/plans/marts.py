"""Gold marts: named ``group by`` aggregations over silver tables."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.money import long_sum, money_avg, money_sum
from ..operators.aggregate import aggregate
from .retail_model import GOLD_MARTS

METRIC_FUNCTIONS: dict[str, Callable[[str], Column]] = {
    "sum_money": money_sum,
    "avg_money": money_avg,
    "sum_long": long_sum,
    "sum": lambda c: F.sum(c),
    "avg": lambda c: F.avg(c),
    "min": lambda c: F.min(c),
    "max": lambda c: F.max(c),
    "count": lambda c: F.count(c),
    "count_distinct": lambda c: F.count_distinct(F.col(c)),
    "approx_count_distinct": lambda c: F.approx_count_distinct(c),
}


def metric_columns(metrics: Sequence) -> list[Column]:
    """``(name, function, column)`` triples, ``(name, sql_text)`` pairs or
    ``{name, expr}`` / ``{name, fn, column}`` dicts."""
    out = []
    for m in metrics:
        if isinstance(m, Mapping):
            if "expr" in m:
                out.append(F.expr(m["expr"]).alias(m["name"]))
            else:
                out.append(METRIC_FUNCTIONS[m["fn"]](m["column"]).alias(m["name"]))
        elif len(m) == 3:
            name, fn, col = m
            out.append(METRIC_FUNCTIONS[fn](col).alias(name))
        else:
            name, expr = m
            out.append((F.expr(expr) if isinstance(expr, str) else expr).alias(name))
    return out


def _distinct_column(metric) -> str | None:
    """The column of a metric that counts distinct values."""
    fn, column = (metric.get("fn"), metric.get("column")) if isinstance(metric, Mapping) else metric[1:] if len(metric) == 3 else (None, None)
    return column if fn == "count_distinct" else None


def build_mart(spec: Mapping, silver: DataFrame, apart: bool = True) -> DataFrame:
    """The group by.  Distinct counts are taken ``apart`` from the other metrics: in one aggregate
    the sums so far would travel with every (group, value) pair, which are nearly as many as the rows.
    One aggregate reads silver once instead of twice, which is what a mart of many small groups may want."""
    keys, metrics = list(spec["group_by"]), list(spec["metrics"])
    plain = [m for m in metrics if _distinct_column(m) is None]
    if not apart or not keys or not plain or len(plain) == len(metrics):
        return aggregate(silver, keys, metric_columns(metrics))
    out = aggregate(silver, keys, metric_columns(plain))
    group = [f"group__{k}" for k in range(len(keys))]
    counts = {}
    for c in dict.fromkeys(_distinct_column(m) for m in metrics if _distinct_column(m) is not None):
        n = counts[c] = f"distinct__{len(counts)}"
        side = aggregate(silver.where(F.col(c).isNotNull()), keys, [F.count_distinct(F.col(c)).alias(n)])
        side = side.select(*[F.col(k).alias(g) for k, g in zip(keys, group, strict=True)], n)
        same = [F.col(k).eqNullSafe(F.col(g)) for k, g in zip(keys, group, strict=True)]
        out = out.join(side, same, "left").drop(*group)
    names = [m["name"] if isinstance(m, Mapping) else m[0] for m in metrics]
    held = [F.col(x) if (c := _distinct_column(m)) is None else F.coalesce(counts[c], F.lit(0)).alias(x) for x, m in zip(names, metrics, strict=True)]
    return out.select(*keys, *held)


def build_named_mart(name: str, silver: DataFrame, apart: bool = True) -> DataFrame:
    return build_mart(GOLD_MARTS[name], silver, apart)
