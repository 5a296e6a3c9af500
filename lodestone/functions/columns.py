"""Column helpers: guarded rolling statistics, safe division, numeric coercion."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, Window, WindowSpec
from pyspark.sql import functions as F

#: Added to denominators, so that a tiny one does not blow up a feature.
EPS = 1e-12


def by_date(*keys: str, order: str = "date") -> WindowSpec:
    return Window.partitionBy(*keys).orderBy(order)


def rolling(f: Callable[[Column], Column], c: Column | str, n: int, w: WindowSpec) -> Column:
    """``f`` over the last ``n`` rows, null until all of them are there."""
    c = F.col(c) if isinstance(c, str) else c
    frame = w.rowsBetween(1 - n, 0)
    return F.when(F.count(c).over(frame) == n, f(c).over(frame))


def safe_div(a: Column, b: Column) -> Column:
    """a / (b + EPS), null where b is 0."""
    return a / (F.nullif(b, F.lit(0.0)) + EPS)


def ratio(a: Column, b: Column) -> Column:
    """a / b, null where b is 0."""
    return F.try_divide(a, F.nullif(b, F.lit(0.0)))


def numeric(c: Column) -> Column:
    """The value as a finite double, else null."""
    v = c.try_cast("double")
    return F.when(~F.isnan(v) & (F.abs(v) != float("inf")), v)


def fill_forward(c: Column | str, w: WindowSpec) -> Column:
    return F.last(c, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0))


def snake(name: str) -> str:
    import re

    s = re.sub(r"(?<=[a-z0-9])(?=[A-Z])", "_", name.strip())
    return re.sub(r"[^0-9a-z]+", "_", s.lower()).strip("_")
