"""Column-expression helpers shared by the operators (no UDFs)."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def fold_cases(cases: Iterable[tuple[Column, object]], default: object = None) -> Column:
    """Fold ordered (predicate, value) pairs into one ``CASE WHEN`` (first match wins)."""
    expr = None
    for pred, value in cases:
        v = value if isinstance(value, Column) else F.lit(value)
        expr = F.when(pred, v) if expr is None else expr.when(pred, v)
    if expr is None:
        return default if isinstance(default, Column) else F.lit(default)
    if default is None:
        return expr
    return expr.otherwise(default if isinstance(default, Column) else F.lit(default))


def flag(cond: Column) -> Column:
    """1 when ``cond`` holds, else 0 (NULL counts as 0), as int."""
    return F.when(cond, 1).otherwise(0)


def pct(num: Column, den: Column) -> Column:
    """``num / den * 100`` as double, NULL when ``den`` is 0 (SAFE_DIVIDE)."""
    return F.try_divide(num.cast("double"), den.cast("double")) * F.lit(100.0)


def safe_div(num: Column, den: Column) -> Column:
    return F.try_divide(num.cast("double"), den.cast("double"))


def contains_ci(col: Column, needle: str) -> Column:
    """Case-insensitive substring test, NULL -> False (pandas ``na=False``)."""
    return F.coalesce(F.lower(col).contains(needle.lower()), F.lit(False))


def contains_cs(col: Column, needle: str) -> Column:
    """Case-sensitive substring test, NULL -> False."""
    return F.coalesce(col.contains(needle), F.lit(False))
