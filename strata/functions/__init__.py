"""Column-expression helpers (all JVM-side built-ins, no UDFs)."""

from .money import as_amount, line_amount, long_sum, money_avg, money_sum
from .shares import share_of_total

__all__ = ["as_amount", "line_amount", "long_sum", "money_avg", "money_sum", "share_of_total"]
