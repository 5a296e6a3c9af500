"""Signal tables, regimes, holdings and text context of research notebooks, as DataFrame operators."""

from __future__ import annotations

import functools
from collections.abc import Iterable

import numpy as np
from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from lodestone.functions.columns import by_date, ratio, rolling


def signal_performance(rows: DataFrame, *, signal: str = "signal", ret: str = "r", top: float = 1.0) -> DataFrame:
    """Per symbol: the lagged signal, clipped to [-top, top], times the return: total, yearly, volatility, Sharpe ratio, drawdown, hit rate, exposure, turnover."""
    w = by_date("symbol")
    held = F.coalesce(F.least(F.greatest(F.lag(signal).over(w), F.lit(-top)), F.lit(top)), F.lit(0.0))
    rows = rows.withColumn("__p", held).withColumns({"__x": F.col("__p") * F.coalesce(ret, F.lit(0.0)), "__t": F.abs(F.col("__p") - F.coalesce(F.lag("__p").over(w), F.lit(0.0)))})
    rows = rows.withColumn("__e", F.exp(F.sum(F.log1p(F.greatest("__x", F.lit(-0.999999)))).over(w.rowsBetween(Window.unboundedPreceding, 0))))
    rows = rows.withColumn("__d", F.col("__e") / F.max("__e").over(w.rowsBetween(Window.unboundedPreceding, 0)) - 1)
    out = rows.groupBy("symbol").agg(
        (F.max_by("__e", "date") - 1).alias("total_return"), (F.avg("__x") * 252).alias("annual_return"), (F.stddev_samp("__x") * F.sqrt(F.lit(252.0))).alias("annual_vol"), F.min("__d").alias("max_drawdown"),
        F.avg(F.when(F.col("__p") != 0, (F.col("__x") > 0).cast("double"))).alias("hit_rate"), F.avg(F.abs("__p")).alias("exposure"), F.avg("__t").alias("turnover"),
    )
    return out.withColumn("sharpe", ratio(F.col("annual_return"), F.col("annual_vol")))


def signal_state(prices: DataFrame, *, fast: int = 20, slow: int = 60, target_vol: float = 0.15) -> DataFrame:
    """Distance from two means and from the highest of ``slow`` rows, the weight for a target volatility (1 at most), and a risk bucket."""
    w = by_date("symbol")
    rows = prices.withColumn("r", ratio(F.col("close"), F.lag("close").over(w)) - 1)
    vol = rolling(F.stddev_samp, "r", fast, w) * F.sqrt(F.lit(252.0))
    rows = rows.withColumns({"trend_fast": F.col("close") / rolling(F.avg, "close", fast, w) - 1, "trend_slow": F.col("close") / rolling(F.avg, "close", slow, w) - 1, "breakout": F.col("close") / rolling(F.max, "high", slow, w) - 1, "vol": vol})
    weight = F.least(ratio(F.lit(target_vol), F.col("vol")), F.lit(1.0))
    bucket = F.when(F.col("vol").isNull(), "unknown").when(F.col("vol") < target_vol, "low").when(F.col("vol") < 2 * target_vol, "medium").otherwise("high")
    return rows.withColumns({"vol_target_weight": weight, "risk_bucket": bucket})


def concentration(holdings: DataFrame, *, top: int = 10) -> DataFrame:
    """Per fund at its latest as_of: holdings, weight of the ``top`` largest, the largest one and its weight. Columns fund, as_of, holding, weight."""
    latest = holdings.groupBy("fund").agg(F.max("as_of").alias("as_of"))
    rows = holdings.join(latest, ["fund", "as_of"]).withColumn("k", F.row_number().over(Window.partitionBy("fund").orderBy(F.desc("weight"), "holding")))
    return rows.groupBy("fund", "as_of").agg(F.count("*").alias("holdings"), F.sum(F.when(F.col("k") <= top, F.col("weight"))).alias("top_weight"), F.max_by("holding", -F.col("k")).alias("largest"), F.max("weight").alias("largest_weight"))


def macro_regimes(macro: DataFrame, target: DataFrame) -> DataFrame:
    """Per series and direction (rising or falling against the month before): months, mean, deviation and yearly mean of the next month's target return."""
    w = Window.partitionBy("series_code").orderBy("date")
    rising = F.col("value") > F.lag("value").over(w)
    rows = macro.withColumn("regime", F.when(rising, "rising").when(~rising, "falling")).filter("regime is not null")
    rows = rows.join(target, "date").filter("forward_return is not null")
    return rows.groupBy("series_code", "regime").agg(F.count("*").alias("months"), F.avg("forward_return").alias("mean"), F.stddev_samp("forward_return").alias("std"), (F.avg("forward_return") * 12).alias("annualised"))


def curve_state(wide: DataFrame, long_rate: str, short_rate: str, rows: int = 21) -> DataFrame:
    """The slope of two columns, its change over ``rows`` rows of its key, and whether it is inverted. ``wide``: key, date and the two."""
    w = Window.partitionBy("key").orderBy("date")
    out = wide.withColumn("slope", F.col(long_rate) - F.col(short_rate))
    return out.withColumns({"slope_change": F.col("slope") - F.lag("slope", rows).over(w), "inverted": F.col("slope") < 0})


def matrix_pivot(matrix: DataFrame, families: Iterable[str]) -> DataFrame:
    """Feature family x target family: the largest standardised difference."""
    return matrix.groupBy("target").pivot("family", list(families)).agg(F.max("std_diff"))


def best_by_target(matrix: DataFrame, top: int = 3) -> DataFrame:
    w = Window.partitionBy("target").orderBy(F.desc_nulls_last("std_diff"), "feature")
    return matrix.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= top)


def event_context(events: DataFrame, numeric: Iterable[str], text: Iterable[str]) -> DataFrame:
    """Per (symbol, date): numeric columns summed, distinct texts joined by `` | `` in order."""
    joined = [F.array_join(F.array_sort(F.collect_set(c)), " | ").alias(c) for c in text]  # of one symbol and day
    return events.groupBy("symbol", "date").agg(*[F.sum(c).alias(c) for c in numeric], *joined)


def task_inventory(rows: DataFrame) -> DataFrame:
    """Per task: rows, distinct labels, distinct families."""
    return rows.groupBy("task").agg(F.count("*").alias("rows"), F.countDistinct("label").alias("labels"), F.countDistinct("family").alias("families"))


def smoothing_weights(rows: int, degree: int, at: int) -> list[float]:
    """The weights by which the least-squares polynomial through ``rows`` values gives its value at place ``at`` (0 the first)."""
    powers = np.vander(np.arange(rows) - (rows - 1) / 2, degree + 1)
    return (powers @ np.linalg.pinv(powers))[at].tolist()


def smoothed(value: str, w: WindowSpec, *, rows: int = 21, degree: int = 2, at: int | None = None, lag: int = 1) -> Column:
    """The value's smoothing polynomial over the ``rows`` rows that end ``lag`` rows before; by default at their last row, so that nothing later is known. Null until all are there."""
    weights = smoothing_weights(rows, degree, rows - 1 if at is None else at)
    return functools.reduce(lambda a, b: a + b, (x * F.lag(value, lag + rows - 1 - k).over(w) for k, x in enumerate(weights)))


def statistical_family(prices: DataFrame) -> DataFrame:
    """z-score of returns over 20 rows (population), population skewness and excess kurtosis over 63, the smoothed close (a parabola through 21 rows) as known the day before,
    at the last of these rows and at their middle, and the close's distance from the former."""
    w = by_date("symbol")
    rows = prices.withColumn("r", ratio(F.col("close"), F.lag("close").over(w)) - 1)
    out = {
        "st__z_20": ratio(F.col("r") - rolling(F.avg, "r", 20, w), rolling(F.stddev_pop, "r", 20, w)), "st__skew_63": rolling(F.skewness, "r", 63, w), "st__kurt_63": rolling(F.kurtosis, "r", 63, w),
        "st__trend_21": smoothed("close", w), "st__middle_21": smoothed("close", w, at=10),
    }
    return rows.withColumns(out).withColumn("st__dist_21", ratio(F.col("close"), F.col("st__trend_21")) - 1).drop("r")


def rolling_beta(prices: DataFrame, rows: int = 20) -> DataFrame:
    """beta and correlation of the close with its own full mean over ``rows`` rows; the runs of exponential means are in `indicators`."""
    w = by_date("symbol")
    out = prices.withColumn("__m", rolling(F.avg, "close", rows, w))
    frame = w.rowsBetween(1 - rows, 0)
    full = F.count("__m").over(frame) == rows
    return out.withColumns({"sp__beta": F.when(full, ratio(F.covar_samp("close", "__m").over(frame), F.var_samp("__m").over(frame))), "sp__correl": F.when(full, F.corr("close", "__m").over(frame))}).drop("__m")


def oracle_panel(grid: DataFrame, trades: DataFrame, freqs: Iterable[str] = (), ks: Iterable[int] = ()) -> DataFrame:
    """The grid (symbol, date) with 0/1 columns of entry days: target_oracle_long, _short and _any, and for each of ``freqs`` and ``ks`` the same with __{freq}_{k}."""
    days = trades.select("symbol", F.col("entry_date").alias("date"), "side", "freq", "k")
    hit = lambda c: F.max(c.cast("int"))
    on = {f"target_oracle_{s}": F.col("side") == s for s in ("long", "short")} | {"target_oracle_any": F.lit(True)}
    wanted = dict(on) | {f"{n}__{f.lower()}_{k}": c & (F.col("freq") == f) & (F.col("k") == k) for f in freqs for k in ks for n, c in on.items()}
    flags = days.groupBy("symbol", "date").agg(*[hit(c).alias(n) for n, c in wanted.items()])
    return grid.join(flags, ["symbol", "date"], "left").fillna(0, list(wanted))


def option_label_panel(trades: DataFrame, chain: DataFrame, *, entry: Iterable[str] = ("ask", "mid", "last", "bid"), exit_: Iterable[str] = ("bid", "mid", "last"), equity: bool = False) -> DataFrame:
    """Each trade (trade_id, symbol, entry_date, exit_date; for the worthless rule underlying_exit_px, for equity legs ret) with the contracts quoted at its entry.

    Bought at the first of the ``entry`` quotes above 0, sold at the first of the ``exit_`` quotes that is there (0 without any). A contract is worthless, at a return of -1, if it
    sells for nothing, or has expired by the exit out of the money. Adds realised_return, its pct rank (average, best 1) and order (ties by contract) in
    the trade. With ``equity`` the underlying itself is one more leg, part -1.
    """
    price = lambda names, least: F.coalesce(*[F.when(F.col(c) > least, F.col(c)) for c in names if c in chain.columns], F.lit(None).cast("double"))
    keep = [c for c in ("expiration", "strike", "right") if c in chain.columns]
    a = chain.select(F.col("underlying").alias("symbol"), F.col("snapshot_date").alias("entry_date"), "part", *keep, price(entry, 0).alias("entry_px")).filter("entry_px is not null")
    b = chain.select(F.col("underlying").alias("symbol"), F.col("snapshot_date").alias("exit_date"), "part", F.greatest(price(exit_, -1), F.lit(0.0)).alias("exit_px"))
    rows = trades.join(a, ["symbol", "entry_date"]).join(b, ["symbol", "exit_date", "part"], "left").withColumn("exit_px", F.coalesce("exit_px", F.lit(0.0)))
    dead = F.col("exit_px") <= 0
    if {"expiration", "strike", "right"} <= set(keep) and "underlying_exit_px" in trades.columns:
        out = F.when(F.upper("right") == "CALL", F.col("underlying_exit_px") <= F.col("strike")).otherwise(F.col("underlying_exit_px") >= F.col("strike"))
        dead = dead | ((F.col("expiration") <= F.col("exit_date")) & F.coalesce(out, F.lit(False)))
    rows = rows.withColumn("worthless", dead).withColumn("realised_return", F.when(F.col("worthless"), -1.0).otherwise(ratio(F.col("exit_px") - F.col("entry_px"), F.col("entry_px")))).withColumn("part", F.col("part").cast("bigint"))
    if equity:
        legs = trades.join(rows.select("trade_id").distinct(), "trade_id", "left_semi").withColumns({"part": F.lit(-1).cast("bigint"), "worthless": F.lit(False), "realised_return": F.col("ret").cast("double")})
        rows = rows.unionByName(legs, allowMissingColumns=True)
    from lodestone.operators.options import return_rank

    order = F.row_number().over(Window.partitionBy("trade_id").orderBy(F.desc_nulls_last("realised_return"), "part"))
    return return_rank(rows, "trade_id").withColumns({"is_equity": F.col("part") == -1, "rank_order": order})


def label_statistics(panel: DataFrame) -> DataFrame:
    """One row: trades, legs, legs a trade, mean and median return, share of gains and of worthless legs."""
    return panel.agg(
        F.countDistinct("trade_id").alias("trades"), F.count("*").alias("legs"), (F.count("*") / F.nullif(F.countDistinct("trade_id"), F.lit(0))).alias("legs_a_trade"), F.avg("realised_return").alias("mean_return"),
        F.percentile_approx("realised_return", 0.5, 10_000).alias("median_return"), F.avg((F.col("realised_return") > 0).cast("double")).alias("win_share"), F.avg(F.col("worthless").cast("double")).alias("worthless_share"),
    )


def tag_statistics(rows: DataFrame, *tasks: str) -> DataFrame:
    """Of `tagged` label sets before they are made distinct: rows of each task, distinct ones, and how many repeat."""
    each = rows.groupBy("task").agg(F.count("*").alias("rows"), F.countDistinct("trade_id", "part").alias("distinct_rows"))
    return each.filter(F.col("task").isin(*tasks) if tasks else F.lit(True)).withColumn("repeated", F.col("rows") - F.col("distinct_rows"))


def tagged(*tasks: tuple[str, DataFrame, Column]) -> DataFrame:
    """Several label sets (name, rows, label) as one: task, and the columns trade_id, part, label; one row of each, with the largest of its labels (null counts least)."""
    out = None
    for name, rows, label in tasks:
        some = rows.select(F.lit(name).alias("task"), "trade_id", "part", label.cast("double").alias("label"))
        out = some if out is None else out.unionByName(some)
    return out.groupBy("task", "trade_id", "part").agg(F.max("label").alias("label"))
