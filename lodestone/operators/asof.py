"""As-of joins: one shuffle by key, one sort by time, no inequality join. Keys of many rows are cut into slices of time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Slices of a key that holds over one in so many rows; so there are fewer than SLICES such keys.
SLICES = 64


def asof_join(left: DataFrame, right: DataFrame, *, left_on: str, right_on: str, by: tuple[str, ...], direction: str = "backward", tolerance: int | None = None, exact: bool = True, prefix: str = "", order: tuple[str, ...] = (), slices: int = 0) -> DataFrame:
    """Each left row with the whole nearest right row in time (nulls in it stay null), or nulls.

    ``direction``: backward (at or before), forward, nearest (ties go backward). ``tolerance`` in days; without ``exact``
    equal times don't match. Of right rows with equal key and time the last by ``order`` is taken, then by their other values (forward: the same one). Right columns are
    named with ``prefix``; rows of a null time or key match nothing and are not moved.

    ``slices``: keys of more than one in ``slices`` rows are cut into that many slices of time, of about equal rows, each of which starts with the last right row before it; finding
    these keys and bounds reads both sides beforehand. Without keys (``by=()``) it is SLICES at least, as else one task would hold all rows.
    """
    if direction == "nearest":
        same = {"left_on": left_on, "right_on": right_on, "by": by, "tolerance": tolerance, "exact": exact, "order": order, "slices": slices}
        both = asof_join(asof_join(left, right, prefix="__b_", **same), right, direction="forward", prefix="__f_", **same)
        names = [c for c in right.columns if c not in by]
        gap = lambda p: F.abs(F.datediff(F.col(left_on), F.col(f"{p}{right_on}")))
        take_back = F.col(f"__f_{right_on}").isNull() | (gap("__b_") <= gap("__f_"))
        return both.select(*left.columns, *[F.when(take_back, F.col(f"__b_{c}")).otherwise(F.col(f"__f_{c}")).alias(f"{prefix}{c}") for c in names])
    back = direction == "backward"
    names = [c for c in right.columns if c not in by]
    keyed = F.lit(True)
    for k in by:
        keyed = keyed & F.col(k).isNotNull()
    payload = F.struct(*[F.col(c).alias(c) for c in (*order, *[c for c in names if c not in order])])
    side = 0 if exact == back else 1  # right rows sort before left ones where equal times may match backward
    r = right.filter(keyed & F.col(right_on).isNotNull()).select(*by, F.col(right_on).alias("__at"), F.lit(side).alias("__side"), payload.alias("__right"), F.lit(None).alias("__left"))
    if not back:  # of equal times forward, too, the last by order
        r = r.groupBy(*by, "__at", "__side").agg(F.max("__right").alias("__right")).withColumn("__left", F.lit(None))
    matching = keyed & F.col(left_on).isNotNull()
    l_payload = F.struct(*[F.col(c).alias(c) for c in left.columns if c not in by])
    l_rows = left.filter(F.coalesce(matching, F.lit(False))).select(*by, F.col(left_on).alias("__at"), F.lit(1 - side).alias("__side"), F.lit(None).alias("__right"), l_payload.alias("__left"))
    rows = l_rows.unionByName(r).withColumn("__slice", F.lit(0))
    slices = max(slices, 0 if by else SLICES)
    if slices > 1:
        rows = _sliced(rows, by, back, slices)
    w = Window.partitionBy(*by, "__slice").orderBy("__at", "__side", "__right")
    if back:
        found = F.last("__right", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0))
    else:
        found = F.first("__right", ignorenulls=True).over(w.rowsBetween(0, Window.unboundedFollowing))
    rows = rows.withColumn("__found", found).filter("__left is not null")
    if tolerance is not None:
        rows = rows.withColumn("__found", F.when(F.abs(F.datediff("__at", F.col(f"__found.{right_on}"))) <= tolerance, F.col("__found")))
    keep = [F.col(c) if c in by else F.col(f"__left.{c}").alias(c) for c in left.columns]
    out = rows.select(*keep, *[F.col(f"__found.{c}").alias(f"{prefix}{c}") for c in names])
    kinds = dict(zip(right.columns, right.schema.fields, strict=True))
    others = left.filter(~F.coalesce(matching, F.lit(False))).select(*left.columns, *[F.lit(None).cast(kinds[c].dataType).alias(f"{prefix}{c}") for c in names])
    return out.unionAll(others)


def _sliced(rows: DataFrame, by: tuple[str, ...], back: bool, slices: int) -> DataFrame:
    """Rows with the slices of large keys, and, for each such slice, the last right row before it (or the first after it)."""
    key = F.struct(*[F.col(k).alias(k) for k in by]) if by else F.struct(F.lit(0).alias("all"))
    rows = rows.withColumn("__k", key)
    sizes = rows.groupBy("__k").agg(F.count("*").alias("n"))
    total = sizes.agg(F.sum("n")).first()[0] or 0
    large = F.broadcast(sizes.filter(F.col("n") * slices > total).select("__k"))  # fewer than ``slices`` rows
    marks = F.array(*[F.lit(i / slices) for i in range(1, slices)])
    bounds = rows.join(large, "__k").groupBy("__k").agg(F.array_sort(F.array_distinct(F.percentile_approx("__at", marks, F.lit(20 * slices)))).alias("__bounds"))
    rows = rows.join(F.broadcast(bounds), "__k", "left")
    rows = rows.withColumn("__slice", F.coalesce(F.size(F.filter("__bounds", lambda b: b < F.col("__at"))), F.lit(0))).withColumn("__large", F.col("__bounds").isNotNull()).drop("__bounds")
    edge = F.struct("__at", "__right")
    ends = rows.filter("__large").groupBy("__k", *by, "__slice").agg((F.max if back else F.min)(F.when(F.col("__right").isNotNull(), edge)).alias("__edge"))  # a row a slice
    w = Window.partitionBy("__k").orderBy("__slice" if back else F.desc("__slice")).rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.withColumn("__edge", F.last("__edge", ignorenulls=True).over(w)).filter("__edge is not null")
    extra = carried.select(*by, F.col("__edge.__at").alias("__at"), F.lit(0).alias("__side"), F.col("__edge.__right").alias("__right"), F.lit(None).cast(rows.schema["__left"].dataType).alias("__left"), "__slice")
    return rows.drop("__k", "__large").unionByName(extra)


def window_join(trades: DataFrame, quotes: DataFrame, *, start: str, stop: str, on: str, by: tuple[str, ...] = ("symbol",)) -> DataFrame:
    """Each trade with every quote of its key from day ``start`` to day ``stop``, both included; ``on``: the quotes' day.

    Days of a trade's window are few: they are listed, and the range join becomes an equi-join that spreads evenly. A trade that
    stops before it starts, or has a null day or key, has no quotes.
    """
    days = trades.filter(F.col(start) <= F.col(stop)).withColumn(on, F.explode(F.sequence(start, stop)))
    return days.join(quotes, [*by, on])


def lag_reports(sparse: DataFrame, *, date_col: str, days: int = 45, keys: tuple[str, ...] = ("symbol",), order: tuple[str, ...] = ()) -> DataFrame:
    """Reports as they were known: dates shifted by the filing lag, of equal dates the last by ``order``, then by their other values, kept."""
    shifted = sparse.withColumn(date_col, F.date_add(date_col, days))
    others = [*order, *[c for c in shifted.columns if c not in (*keys, *order, date_col)]]
    return shifted.groupBy(*keys, date_col).agg(F.max(F.struct(*others)).alias("s")).select(*keys, date_col, *[F.col(f"s.{c}").alias(c) for c in shifted.columns if c not in (*keys, date_col)])


def align_events(events: DataFrame, grid: DataFrame, *, tolerance: int = 7) -> DataFrame:
    """Each event on the first panel date of its symbol from the event on, within ``tolerance`` days; distinct (symbol, date, event_type)."""
    days = grid.select("symbol", F.col("date").alias("panel_date")).distinct()
    found = asof_join(events.select("symbol", "event_date", "event_type"), days, left_on="event_date", right_on="panel_date", by=("symbol",), direction="forward", tolerance=tolerance)
    return found.filter("panel_date is not null").select("symbol", F.col("panel_date").alias("date"), "event_type").distinct()
