"""Labels: forward returns, ranks, optimal trades and what is derived from them."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestone.functions.batches import changes, whole_groups
from lodestone.functions.columns import by_date
from lodestone.operators.quantiles import exact_quantiles
from lodestone.scratch import written


def forward_returns(prices: DataFrame, horizons: Iterable[int] = (1, 5, 20), *, price: str = "close", log: bool = False) -> DataFrame:
    """(symbol, date, horizon, target_name, target_value): the change of the price over the next h rows; null in the tail."""
    w = by_date("symbol")
    change = lambda h: F.ln(F.lead(price, h).over(w) / F.col(price)) if log else F.try_divide(F.lead(price, h).over(w), F.col(price)) - 1
    wide = prices.select("symbol", "date", *[change(h).alias(f"h{h}") for h in horizons])
    cases = ", ".join(f"{h}, 'forward_return_{h}d', h{h}" for h in horizons)
    return wide.select("symbol", "date", F.expr(f"stack({len(tuple(horizons))}, {cases}) as (horizon, target_name, target_value)"))


def average_rank(value: str, *keys: str, descending: bool = True) -> tuple[Column, Column]:
    """Average rank among the non-null values of a partition, and how many there are."""
    missing = F.col(value).isNull()
    w = Window.partitionBy(*keys, missing)
    ties = F.count("*").over(Window.partitionBy(*keys, value))
    rank = F.rank().over(w.orderBy(F.desc(value) if descending else F.asc(value))) + (ties - 1) / 2
    return F.when(~missing, rank), F.count("*").over(w)


def cross_sectional_rank(long: DataFrame) -> DataFrame:
    """Adds rank (average, 1 for the largest) and pct (average rank from the smallest, by the count) within each date and horizon."""
    rank, n = average_rank("target_value", "date", "horizon")
    up, _ = average_rank("target_value", "date", "horizon", descending=False)
    return long.withColumns({"rank": rank, "rank_pct": up / n})


def period_end(date: str, freq: str) -> Column:
    """The last day of the calendar period: W (weeks end on Sunday), ME, QE or YE."""
    d = F.col(date)
    if freq == "W":
        return F.date_add(F.trunc(d, "week"), 6)
    if freq == "ME":
        return F.last_day(d)
    if freq == "QE":
        return F.last_day(F.add_months(F.trunc(d, "quarter"), 2))
    if freq == "YE":
        return F.make_date(F.year(d), F.lit(12), F.lit(31))
    raise ValueError(f"unknown frequency {freq}")


def best_trade_sets(entry: np.ndarray, exit_: np.ndarray, k: int, least: float, short: bool) -> list[list[tuple[np.ndarray, np.ndarray, np.ndarray]]]:
    """For each count up to ``k``: the trades (group, entry row, exit row) of the largest total gain among all sets of so many trades at most.

    ``entry`` and ``exit_`` hold a group's prices in a column, in order, and NaN below its last row. Trades of a set follow each other, the next entry on a
    later row than the exit before; each has a gain of ``least`` or more as a share of its entry price's size. Sets of equal gain (within 1e-12): the one of
    fewer trades, then of earlier exits, then of earlier entries.
    Exact: the gains of every allowed pair of rows are looked at, exit row by exit row for all groups at once, and the best sets of t trades that end by a row
    follow from those of t - 1. Entries are looked for only where a set is traced back.
    """
    n, groups = entry.shape
    size = np.abs(entry)
    entry = np.where(size > 0, entry, np.nan)
    needed = least * size
    columns = np.arange(groups)

    def gains(rows: int, out: np.ndarray, of: np.ndarray | slice = slice(None)) -> np.ndarray:
        """Of entries on the first ``rows`` rows of groups, for their exit prices; -inf where a pair is not allowed."""
        gain = entry[:rows, of] - out if short else out - entry[:rows, of]
        return np.where(gain >= needed[:rows, of], gain, -np.inf)

    # by[t][j]: the best of exactly t trades with exits before row j; at[t][j]: of those whose last exit is on row j
    by = [np.zeros((n + 1, groups)), *[np.full((n + 1, groups), -np.inf) for _ in range(k)]]
    at = [np.full((n, groups), -np.inf) for _ in range(k + 1)]
    for j in range(1, n):
        gain = gains(j, exit_[j])
        for t in range(1, k + 1):
            at[t][j] = (gain if t == 1 else by[t - 1][:j] + gain).max(axis=0)
            np.maximum(by[t][j], at[t][j], out=by[t][j + 1])
    found: list[list[tuple[np.ndarray, np.ndarray, np.ndarray]]] = []
    best, count = np.zeros(groups), np.zeros(groups, np.int64)
    rows = np.arange(n)[:, None]
    for k_ in range(1, k + 1):
        more = by[k_][n] > best + 1e-12
        best, count = np.where(more, by[k_][n], best), np.where(more, k_, count)
        trades, stop = [], np.full(groups, n)
        for t in range(k_, 0, -1):
            of = columns[count >= t]
            if not len(of):
                continue
            end = stop[of]
            exits = ((at[t][:, of] >= by[t][end, of] - 1e-12) & (rows < end)).argmax(axis=0)
            total = by[t - 1][:n, of] + np.where(rows < exits, gains(n, exit_[exits, of], of), -np.inf)
            starts = total.argmax(axis=0)
            trades.append((of, starts, exits))
            stop[of] = starts
        found.append(trades[::-1])
    return found


def best_trades(entry: np.ndarray, exit_: np.ndarray, k: int, least: float, short: bool) -> list[list[tuple[int, int]]]:
    """`best_trade_sets` of one group: for each count up to ``k`` its trades (entry row, exit row)."""
    sets = best_trade_sets(np.asarray(entry, float)[:, None], np.asarray(exit_, float)[:, None], k, least, short)
    return [[(int(i[0]), int(j[0])) for _, i, j in trades] for trades in sets]


#: Slices of a value's range in which global ranks are counted.
SLICES = 200
TRADES = "symbol string, side string, freq string, period date, k int, entry_date date, exit_date date, entry_px double, exit_px double, profit double, ret double"


#: Prices of groups that are solved at once.
CELLS = 40_000


def _side_by_side(starts: np.ndarray, sizes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Groups of about equal size, some CELLS rows at a time: the groups, their rows as columns, and which of these are theirs."""
    order = np.argsort(sizes, kind="stable")[::-1]
    at = 0
    while at < len(order):
        n = int(sizes[order[at]])
        some = order[at : at + max(1, CELLS // n)]
        at += len(some)
        rows = np.arange(n)[:, None]
        there = rows < sizes[some]
        yield some, np.where(there, starts[some] + rows, 0), there


def oracle_trades(prices: DataFrame, *, freq: str | dict[str, Iterable[int]] = "YE", ks: Iterable[int] = (1, 2, 3), least: float = 0.05, sides: Iterable[str] = ("long", "short"), entry: dict[str, str] | None = None, exit_: dict[str, str] | None = None) -> DataFrame:
    """The best at most k trades of each symbol, calendar period, side and k, in hindsight; see `best_trade_sets`.

    Long trades buy at the low and sell at the high by default, short ones the other way round. ``freq``: one frequency, or several with their counts, which
    share one shuffle and sort. One group is a symbol's period: its rows are bounded by the calendar. Groups are solved many at a time.
    """
    entry = entry or {"long": "low", "short": "high"}
    exit_ = exit_ or {"long": "high", "short": "low"}
    columns = sorted({*entry.values(), *exit_.values()})
    counts = {f: tuple(v) for f, v in freq.items()} if isinstance(freq, dict) else {freq: tuple(ks)}
    sides = tuple(sides)
    names = [c.split()[0] for c in TRADES.split(", ")]

    def solve(table: pa.Table, freq: str, period: str, ks: tuple[int, ...], x: dict[str, np.ndarray]) -> Iterator[pa.RecordBatch]:
        starts = np.flatnonzero(changes(table, "symbol", period))
        sizes = np.diff(np.append(starts, table.num_rows))
        for side in sides:
            parts = []
            for some, rows, there in _side_by_side(starts, sizes):
                a, b = (np.where(there, x[c][rows], np.nan) for c in (entry[side], exit_[side]))
                sets = best_trade_sets(a, b, max(ks), least, side == "short")
                parts += [(np.full(len(g), k), starts[some[g]] + i, starts[some[g]] + j) for k in ks for g, i, j in sets[k - 1]]
            if not parts:
                continue
            k, i, j = (np.concatenate(p) for p in zip(*parts, strict=True))
            a, b = x[entry[side]][i], x[exit_[side]][j]
            profit = b - a if side == "long" else a - b
            date, one = table.column("date").combine_chunks(), len(k)
            values = [table.column("symbol").take(i), pa.repeat(side, one), pa.repeat(freq, one), table.column(period).take(i), pa.array(k, pa.int32()), date.take(i), date.take(j), a, b, profit, profit / np.abs(a)]
            yield from pa.table(values, names=names).combine_chunks().to_batches()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, "symbol"):
            x = {c: table.column(c).to_numpy() for c in columns}
            for n, (f, k) in enumerate(counts.items()):
                yield from solve(table, f, f"__p{n}", k, x)

    rows = prices.select("symbol", F.to_date("date").alias("date"), *[F.col(c).cast("double").alias(c) for c in columns]).dropna()
    rows = rows.repartition("symbol").sortWithinPartitions("symbol", "date").withColumns({f"__p{n}": period_end("date", f) for n, f in enumerate(counts)})
    return rows.mapInArrow(run, TRADES)


def completed(trades: DataFrame) -> DataFrame:
    """Adds hold_days and a trade id."""
    return trades.withColumns({"hold_days": F.datediff("exit_date", "entry_date"), "trade_id": F.concat_ws("_", "symbol", "side", "freq", "k", "entry_date", "exit_date")})


def dedupe_trades(trades: DataFrame, mode: str = "exact") -> DataFrame:
    """``exact``: one of each (symbol, side, entry, exit), of the least k, period and frequency; ``entry_date``: the best return of each (symbol, side, entry), on ties the earliest exit."""
    keys, order = (["symbol", "side", "entry_date", "exit_date"], ["k", "period", "freq"]) if mode == "exact" else (["symbol", "side", "entry_date"], [F.desc("ret"), "exit_date", "k", "period", "freq"])
    return trades.withColumn("__n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter("__n = 1").drop("__n")


def label_rows(trades: DataFrame) -> DataFrame:
    """An entry and an exit row for each trade: action, position held after it."""
    long = F.col("side") == "long"
    leg = lambda date, px, action, position: F.struct(F.col(date).alias("date"), F.col(px).alias("px"), action.alias("action"), position.alias("position"))
    legs = F.array(leg("entry_date", "entry_px", F.when(long, "buy").otherwise("short"), F.when(long, 1).otherwise(-1)), leg("exit_date", "exit_px", F.when(long, "sell").otherwise("cover"), F.lit(0)))
    return completed(trades).select("trade_id", "symbol", "side", "freq", "k", "ret", F.explode(legs).alias("leg")).select("trade_id", "symbol", "side", "freq", "k", "ret", "leg.*")


def trade_statistics(trades: DataFrame, *by: str) -> DataFrame:
    """Counts, shares of wins and losses in percent, mean, median, deviation, Sharpe-like ratio and mean holding of trades; the trades are written once."""
    t = written(completed(trades).select(*by, "ret", "hold_days"), "trade-statistics")
    share = lambda c: F.round(100 * F.avg(c.cast("double")), 2)
    medians = exact_quantiles(t, "ret", (0.5,), by, name="__m").withColumnsRenamed({c: f"__{c}" for c in by})
    same = F.lit(True)
    for c in by:
        same = same & F.col(c).eqNullSafe(F.col(f"__{c}"))
    out = t.groupBy(*by).agg(
        F.count("*").alias("trades"), share(F.col("ret") > 0).alias("win_pct"), share(F.col("ret") < 0).alias("loss_pct"), F.avg("ret").alias("mean_ret"),
        F.stddev_samp("ret").alias("std_ret"), F.try_divide(F.avg("ret"), F.nullif(F.stddev_samp("ret"), F.lit(0.0))).alias("sharpe"), F.avg("hold_days").alias("mean_hold"),
    )
    return out.join(medians, same, "left").select(*by, "trades", "win_pct", "loss_pct", "mean_ret", F.get("__m", F.lit(0)).alias("median_ret"), "std_ret", "sharpe", "mean_hold")


def optimal_events(trades: DataFrame, *, fee_bps: float = 1.0, slip_bps: float = 2.0) -> DataFrame:
    """Label rows with the return after both legs' fee and slippage."""
    return label_rows(trades.withColumn("ret", F.col("ret") - 2 * (fee_bps + slip_bps) / 1e4))


def weighted_labels(events: DataFrame, *, alpha: float = 1.0, clip: float = 0.5, cap: float = 3.0) -> DataFrame:
    """target (long entries and short exits are 1) and a weight: 1 + alpha * clipped return / clip, balanced over (side, k) by a capped factor; the events are written once."""
    events = written(events, "label-events")
    target = ((F.col("side") == "long") & (F.col("action") == "buy")) | ((F.col("side") == "short") & (F.col("action") == "cover"))
    rows = events.withColumn("target", target.cast("int")).withColumn("weight", 1 + alpha * F.least(F.greatest("ret", F.lit(0.0)), F.lit(clip)) / clip)
    n = rows.groupBy("side", "k").agg(F.count("*").alias("n"))
    largest = n.agg(F.max("n").alias("most"))
    factor = F.least(F.greatest(F.col("most") / F.col("n"), F.lit(1.0)), F.lit(cap))
    return rows.join(n.crossJoin(largest), ["side", "k"]).withColumn("weight", F.col("weight") * factor).drop("n", "most")


def global_pct_rank(df: DataFrame, value: str, name: str = "rank_pct") -> DataFrame:
    """Average rank over all rows, by their number, without one task that holds them all: ranks are summed up over distinct values, in slices of their range.

    The bounds of the slices are SLICES quantiles at most, found once, so that every part of the plan cuts alike.
    """
    counts = written(df.filter(F.col(value).isNotNull()).groupBy(value).agg(F.count("*").alias("n")), "ranks")
    bounds = sorted(set(counts.select(F.col(value).cast("double").alias("v")).approxQuantile("v", [i / SLICES for i in range(1, SLICES)], 0.002)))
    part = F.size(F.filter(F.array(*[F.lit(b) for b in bounds]), lambda b: b < F.col(value))) if bounds else F.lit(0)
    ranged = counts.withColumn("__part", part)
    totals = ranged.groupBy("__part").agg(F.sum("n").alias("here"))  # a row for each slice
    before = totals.select("__part", (F.sum("here").over(Window.orderBy("__part")) - F.col("here")).alias("before"), F.sum("here").over(Window.partitionBy()).alias("all"))
    w = Window.partitionBy("__part").orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    ranks = ranged.join(before, "__part").withColumn(name, (F.col("before") + F.sum("n").over(w) - (F.col("n") - 1) / 2) / F.col("all"))
    # rows of no value have no rank: they don't meet in the join
    return df.filter(F.col(value).isNotNull()).join(ranks.select(value, name), value).unionByName(df.filter(F.col(value).isNull()).withColumn(name, F.lit(None).cast("double")))


def distribution(df: DataFrame, value: str, *by: str) -> DataFrame:
    """n, mean, population deviation, skewness, excess kurtosis and the p-value of the omnibus test of normality (null under 8 values or without spread)."""
    rows = df.groupBy(*by).agg(F.count(value).alias("n"), F.avg(value).alias("mean"), F.stddev_pop(value).alias("std"), F.skewness(value).alias("skew"), F.kurtosis(value).alias("kurtosis"))
    return rows.withColumn("normal_p", F.when((F.col("n") >= 8) & (F.col("std") > 0), normality(F.col("n"), F.col("skew"), F.col("kurtosis"))))


def normality(n: Column, skew: Column, kurtosis: Column) -> Column:
    """The p-value of the omnibus statistic: population skewness and excess kurtosis, each turned to a standard normal, squared and added; chi-squared with two degrees of freedom.

    The transforms are D'Agostino's of the skewness and Anscombe and Glynn's of the kurtosis; see D'Agostino, Belanger and D'Agostino (1990).
    """
    n = n.cast("double")
    y = skew * F.sqrt((n + 1) * (n + 3) / (6 * (n - 2)))
    beta = 3 * (n * n + 27 * n - 70) * (n + 1) * (n + 3) / ((n - 2) * (n + 5) * (n + 7) * (n + 9))
    w2 = F.sqrt(2 * (beta - 1)) - 1
    scaled = y / F.sqrt(2 / (w2 - 1))
    z_skew = F.asinh(scaled) / F.sqrt(F.ln(w2) / 2)
    spread = F.sqrt(24 * n * (n - 2) * (n - 3) / ((n + 1) * (n + 1) * (n + 3) * (n + 5)))
    x = (kurtosis + 3 - 3 * (n - 1) / (n + 1)) / spread
    root = 6 * (n * n - 5 * n + 2) / ((n + 7) * (n + 9)) * F.sqrt(6 * (n + 3) * (n + 5) / (n * (n - 2) * (n - 3)))
    a = 6 + 8 / root * (2 / root + F.sqrt(1 + 4 / (root * root)))
    denominator = 1 + x * F.sqrt(2 / (a - 4))
    z_kurtosis = (1 - 2 / (9 * a) - F.signum(denominator) * F.cbrt((1 - 2 / a) / F.abs(denominator))) / F.sqrt(2 / (9 * a))
    return F.exp(-(z_skew * z_skew + z_kurtosis * z_kurtosis) / 2)


def action_labels(grid: DataFrame, trades: DataFrame) -> DataFrame:
    """The grid (symbol, date) with the day's action (entries before exits, long before short) and position sign; ``hold`` and 0 where there is none."""
    order = F.array_position(F.array(*[F.lit(a) for a in ("buy", "short", "sell", "cover")]), F.col("action"))
    first = label_rows(trades).groupBy("symbol", "date").agg(F.min_by(F.struct("action", "position"), order).alias("a"))
    return grid.join(first, ["symbol", "date"], "left").select(*grid.columns, F.coalesce("a.action", F.lit("hold")).alias("action"), F.coalesce("a.position", F.lit(0)).alias("position"))


def dedupe_labels(rows: DataFrame) -> DataFrame:
    """Of labels with equal (date, symbol, side, action) the one of the highest return."""
    w = Window.partitionBy("date", "symbol", "side", "action").orderBy(F.desc("ret"), "trade_id")
    return rows.withColumn("__n", F.row_number().over(w)).filter("__n = 1").drop("__n")
