"""Upserts, coverage, gaps and refresh plans over stored tables."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def upsert(existing: DataFrame, incoming: DataFrame, keys: Iterable[str], *, order: Iterable[str] = ()) -> DataFrame:
    """Whole rows of ``incoming`` replace rows of equal key (nulls are equal); columns either lacks are null. Of rows of one key on one side the last by ``order`` wins, then by their other values."""
    keys, order = list(keys), list(order)
    rows = existing.withColumn("__new", F.lit(0)).unionByName(incoming.withColumn("__new", F.lit(1)), allowMissingColumns=True)
    others = [c for c in rows.columns if c not in keys]
    last = rows.groupBy(*keys).agg(F.max(F.struct("__new", *order, *[c for c in others if c != "__new" and c not in order])).alias("r"))
    return last.select(*keys, *[F.col(f"r.{c}").alias(c) for c in others if c != "__new"])


def panel_upsert(existing: DataFrame, incoming: DataFrame, date: str = "date") -> DataFrame:
    """As `upsert`, keyed by the date and every string and date column of either side."""
    kinds = dict(incoming.dtypes) | dict(existing.dtypes)
    return upsert(existing, incoming, [date, *sorted(c for c, t in kinds.items() if t in ("string", "date") and c != date)])


def coverage(df: DataFrame, keys: Iterable[str], date: str = "date") -> DataFrame:
    """Per key: min_date, max_date, row_count, days, and the columns that hold a value."""
    names = [c for c in df.columns if c not in (*keys, date)]
    there = F.array_compact(F.array(*[F.when(F.count(c) > 0, F.lit(c)) for c in names])) if names else F.array()
    return df.groupBy(*keys).agg(F.min(date).alias("min_date"), F.max(date).alias("max_date"), F.count("*").alias("row_count"), F.countDistinct(date).alias("days"), there.alias("columns_present"))


def business_days(bounds: DataFrame, keys: Iterable[str], start: str, end: str) -> DataFrame:
    """Each key with the weekdays from start to end."""
    days = bounds.filter(F.col(start) <= F.col(end)).select(*keys, F.explode(F.sequence(F.col(start), F.col(end), F.expr("interval 1 day"))).alias("date"))
    return days.filter(F.weekday("date") < 5)


def missing_days(df: DataFrame, keys: Iterable[str], date: str = "date") -> DataFrame:
    """Weekdays between each key's first and last date on which it has no row."""
    keys = list(keys)
    bounds = df.groupBy(*keys).agg(F.min(date).alias("__a"), F.max(date).alias("__b"))
    return business_days(bounds, keys, "__a", "__b").join(df.select(*keys, F.col(date).alias("date")).distinct(), [*keys, "date"], "left_anti")


def business_ordinal(date: str) -> Column:
    """Weekdays since 1970-01-05, a Monday, for a weekday."""
    n = F.datediff(F.col(date), F.lit("1970-01-05").cast("date"))
    return F.floor(n / 7) * 5 + F.weekday(date)


def contiguous_ranges(days: DataFrame, keys: Iterable[str], *, most: int | None = None) -> DataFrame:
    """Runs of consecutive weekdays: start, end, days; with ``most`` cut into runs of so many days."""
    keys = list(keys)
    w = Window.partitionBy(*keys).orderBy("date")
    rows = days.withColumn("__run", business_ordinal("date") - F.row_number().over(w))
    if most:
        rows = rows.withColumn("__part", F.floor((F.row_number().over(Window.partitionBy(*keys, "__run").orderBy("date")) - 1) / most))
    else:
        rows = rows.withColumn("__part", F.lit(0))
    return rows.groupBy(*keys, "__run", "__part").agg(F.min("date").alias("start"), F.max("date").alias("end"), F.count("*").alias("days")).drop("__run", "__part")


def date_chunks(bounds: DataFrame, keys: Iterable[str], start: str, end: str, days: int = 365) -> DataFrame:
    """Spans of at most ``days`` days that cover [start, end]."""
    # outer, and filtered afterwards: a filter on long expressions for the bounds would repeat them at the scan
    first = F.explode_outer(F.when(F.col(start) <= F.col(end), F.sequence(F.col(start), F.col(end), F.expr(f"interval {days} days"))))
    rows = bounds.select(*keys, F.col(end).alias("__end"), first.alias("start")).filter("start is not null")
    return rows.select(*keys, "start", F.least(F.date_add("start", days - 1), "__end").alias("end"))


def first_provider(states: DataFrame, target: Column, priority: Iterable[str]) -> DataFrame:
    """Per symbol the first provider, by priority, whose data reaches the target date."""
    order = F.array_position(F.array(*[F.lit(p) for p in priority]), F.col("provider"))
    rows = states.filter((F.col("max_date") >= target) & (order > 0)).withColumn("__o", order)
    return rows.withColumn("__n", F.row_number().over(Window.partitionBy("symbol").orderBy("__o"))).filter("__n = 1").drop("__o", "__n")


def expected_price_date(utc: Column) -> Column:
    """The latest day whose prices should be there: today from 17:00 New York time on weekdays, else the weekday before."""
    local = F.from_utc_timestamp(utc, "America/New_York")
    day = local.cast("date")
    before = F.date_sub(day, F.when(F.weekday(day) == 0, 3).when(F.weekday(day) == 6, 2).otherwise(1))
    return F.when((F.weekday(day) < 5) & (F.hour(local) >= 17), day).otherwise(before)


def eligibility(symbols: DataFrame, required: Iterable[str], counts: DataFrame) -> DataFrame:
    """Per symbol: whether every required section has rows, and the first that has none."""
    names = list(required)
    have = counts.filter(F.col("row_count") > 0).groupBy("symbol").agg(F.collect_set("section").alias("have"))
    missing = F.array_except(F.array(*[F.lit(s) for s in names]), F.coalesce("have", F.array()))
    return symbols.join(have, "symbol", "left").select("symbol", (F.size(missing) == 0).alias("eligible"), F.get(missing, F.lit(0)).alias("first_missing"))


def same_table(a: DataFrame, b: DataFrame, date: str = "date") -> DataFrame:
    """One row: whether row count, columns, first and last date agree."""
    s = lambda d, p: d.agg(F.count("*").alias(f"{p}_rows"), F.min(date).alias(f"{p}_min"), F.max(date).alias(f"{p}_max"))
    both = s(a, "a").crossJoin(s(b, "b"))  # one row each
    return both.select((F.col("a_rows") == F.col("b_rows")).alias("rows"), F.lit(sorted(a.columns) == sorted(b.columns)).alias("columns"), (F.col("a_min").eqNullSafe(F.col("b_min")) & F.col("a_max").eqNullSafe(F.col("b_max"))).alias("dates"))
