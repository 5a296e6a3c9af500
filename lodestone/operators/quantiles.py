"""Exact quantiles of groups of any size: the rank is looked for in slices of the value's range, and no task holds a group."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: A group of more than one in so many rows is cut into slices; so there are fewer than HEAVY such groups.
HEAVY = 1000
#: Slices of a group's range of values.
SLICES = 64


def exact_quantiles(df: DataFrame, value: str, shares: Iterable[float], by: Iterable[str], *, name: str = "quantiles", slices: int = SLICES) -> DataFrame:
    """Per group: an array of the quantiles of its non-null values, interpolated between neighbours as `percentile` does.

    Small groups go through `percentile`. Of large ones, approximate bounds cut the values into slices, counts of slices tell which hold a wanted
    rank, and only their distinct values, with their counts, are put in order; a value that many rows share is one of them. Groups without
    a value are left out; null keys are a group. ``df`` is read four times: hand in a written table.
    """
    shares, by = [float(s) for s in shares], list(by)
    rows = df.filter(F.col(value).isNotNull()).select(*by, F.col(value).cast("double").alias("__v"))
    key = F.struct(*[F.col(c).alias(c) for c in by]) if by else F.lit(0)
    rows = rows.withColumn("__k", key)
    sizes = rows.groupBy("__k").agg(F.count("*").alias("n"))
    total = sizes.agg(F.sum("n")).first()[0] or 0
    large = sizes.filter(F.col("n") * HEAVY > total)  # fewer than HEAVY rows
    cuts = F.broadcast(large.withColumnRenamed("__k", "__lk"))
    small = rows.join(cuts, F.col("__k").eqNullSafe(F.col("__lk")), "left_anti")
    at = F.array(*[F.lit(s) for s in shares])
    few = small.groupBy("__k").agg(F.percentile("__v", at).alias(name))
    marks = F.array(*[F.lit(i / slices) for i in range(1, slices)])
    rows = rows.join(cuts, F.col("__k").eqNullSafe(F.col("__lk"))).drop("__lk")
    bounds = rows.groupBy("__k").agg(F.array_distinct(F.percentile_approx("__v", marks, F.lit(20 * slices))).alias("bounds")).withColumnRenamed("__k", "__bk")
    sliced = rows.join(F.broadcast(bounds), F.col("__k").eqNullSafe(F.col("__bk"))).drop("__bk").withColumn("__s", F.size(F.filter("bounds", lambda b: b < F.col("__v")))).drop("bounds")
    counts = sliced.groupBy("__k", "n", "__s").agg(F.count("*").alias("__here"))  # at most SLICES rows a group
    before = counts.withColumn("__before", F.sum("__here").over(Window.partitionBy("__k").orderBy("__s")) - F.col("__here"))
    ranks = F.array_distinct(F.flatten(F.array(*[F.array(F.floor(F.lit(s) * (F.col("n") - 1)), F.ceil(F.lit(s) * (F.col("n") - 1))) for s in shares])))
    hit = F.exists(ranks, lambda r: (F.col("__before") <= r) & (r < F.col("__before") + F.col("__here")))
    wanted = before.filter(hit).select(F.col("__k").alias("__wk"), F.col("__s").alias("__ws"), "__before")
    inside = sliced.join(F.broadcast(wanted), F.col("__k").eqNullSafe(F.col("__wk")) & (F.col("__s") == F.col("__ws")))
    distinct = inside.groupBy("__k", "n", "__s", "__before", "__v").agg(F.count("*").alias("__here"))
    upto = F.col("__before") + F.sum("__here").over(Window.partitionBy("__k", "__s").orderBy("__v"))
    placed = distinct.withColumn("__upto", upto)
    pick = lambda r: F.max(F.when((F.col("__upto") - F.col("__here") <= r) & (r < F.col("__upto")), F.col("__v")))
    found: list[Column] = []
    for i, s in enumerate(shares):
        at_ = F.lit(s) * (F.col("n") - 1)
        found += [pick(F.floor(at_)).alias(f"__lo{i}"), pick(F.ceil(at_)).alias(f"__hi{i}")]
    ends = placed.groupBy("__k", "n").agg(*found)
    mixed = []
    for i, s in enumerate(shares):
        at_ = F.lit(s) * (F.col("n") - 1)
        mixed.append(F.when(F.floor(at_) == F.ceil(at_), F.col(f"__lo{i}")).otherwise((F.ceil(at_) - at_) * F.col(f"__lo{i}") + (at_ - F.floor(at_)) * F.col(f"__hi{i}")))
    out = few.unionByName(ends.select("__k", F.array(*mixed).alias(name)))
    return out.select(*[F.col(f"__k.{c}").alias(c) for c in by], name)
