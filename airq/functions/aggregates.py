"""Aggregate helpers for the two ways of treating missing values.

Lenient aggregates skip missing values, which is what Spark does. Strict
aggregates are missing as soon as one input of the group is missing.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import functions as F


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def over(aggregate: Column, window: WindowSpec | None) -> Column:
    """The aggregate itself, or its value for the row's window."""
    return aggregate if window is None else aggregate.over(window)


def n_rows(window: WindowSpec | None = None) -> Column:
    return over(F.count(F.lit(1)), window)


def strict(agg: Callable[[Column], Column], c: str | Column, window: WindowSpec | None = None) -> Column:
    """``agg(c)``, or NULL when any row of the group or window has no ``c``."""
    c = col(c)
    return F.when(over(F.count(c), window) == n_rows(window), over(agg(c), window))


def strict_where(agg: Callable[[Column], Column], c: str | Column, condition: Column, window: WindowSpec | None = None) -> Column:
    """Strict aggregate over the rows of the group or window that meet ``condition``."""
    value = F.when(condition, col(c))
    return F.when(over(F.count(value), window) == over(F.count_if(condition), window), over(agg(value), window))


def n_distinct(c: str | Column) -> Column:
    """Distinct count in which a missing value counts as one more value."""
    c = col(c)
    return F.count_distinct(c) + F.max(c.isNull().cast("int"))


def single_valued(c: str | Column) -> Column:
    """True when ``n_distinct(c) < 2``, from mergeable aggregates only.

    Smallest and largest value agree exactly when there is one value, so no
    distinct set is built and partial aggregation does almost all the work.
    """
    c = col(c)
    all_missing = F.count(c) == 0
    one_value = (F.count(c) == n_rows()) & (F.min(c) == F.max(c))
    return all_missing | F.coalesce(one_value, F.lit(False))


def missing_ratio(c: str | Column) -> Column:
    return F.avg(col(c).isNull().cast("int"))


def any_true(condition: Column, window: WindowSpec | None = None) -> Column:
    """True when one row of the group or window meets the condition; unknown counts as false."""
    return F.coalesce(over(F.bool_or(condition), window), F.lit(False))


def nan_to_null(df: DataFrame, *names: str) -> DataFrame:
    """Replace NaN by NULL, in every floating-point column by default."""
    kinds = dict(df.dtypes)
    names = names or tuple(c for c, t in kinds.items() if t in ("double", "float"))
    found = {c: F.nanvl(F.col(c), F.lit(None).cast(kinds[c])) for c in names if kinds.get(c) in ("double", "float")}
    return df.withColumns(found) if found else df


def same(left: Column, right: Column) -> Column:
    """Equality in which a missing key matches a missing key."""
    return left.eqNullSafe(right)


def not_in(c: str | Column, values: list) -> Column:
    """NOT IN that keeps rows with a missing value."""
    return ~F.coalesce(col(c).isin(*values), F.lit(False))


def is_finite(c: str | Column) -> Column:
    """True for a present number that is neither NaN nor infinite."""
    c = col(c)
    return c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf")))
