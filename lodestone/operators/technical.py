"""Price features per symbol, ordered by date: one grouped pass of numpy over each symbol's history, however many features are asked for.

A symbol's history is bounded by the calendar. Window expressions would evaluate each sliding frame anew for each row in an
interpreter; the same frames as strided views in numpy take a tenth of the time.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from lodestone.functions.columns import EPS, by_date, fill_forward, rolling

RETURNS = (1, 2, 3, 5, 10, 20, 21, 63, 126, 189, 252)
# The moving-average lengths.
AVERAGES = (5, 10, 15, 20, 25, 30, 35, 40, 45, 50, 60, 70, 80, 90, 100, 120, 140, 150, 160, 180, 200)

Arrays = dict[str, np.ndarray]


def by_symbol() -> WindowSpec:
    return by_date("symbol")


def frames(f: Callable[[np.ndarray], np.ndarray], x: np.ndarray, n: int) -> np.ndarray:
    """``f`` over the last ``n`` values, NaN until all of them are there."""
    out = np.full(len(x), np.nan)
    if len(x) >= n:
        views = np.lib.stride_tricks.sliding_window_view(x, n)
        for lo in range(0, len(views), 4096):
            out[n - 1 + lo : n - 1 + lo + 4096] = f(views[lo : lo + 4096])
    return out


def mean(x: np.ndarray, n: int) -> np.ndarray:
    return frames(lambda v: v.mean(axis=1), x, n)


def deviation(x: np.ndarray, n: int) -> np.ndarray:
    return frames(lambda v: v.std(axis=1, ddof=1), x, n)


def highest(x: np.ndarray, n: int) -> np.ndarray:
    return frames(lambda v: v.max(axis=1), x, n)


def lowest(x: np.ndarray, n: int) -> np.ndarray:
    return frames(lambda v: v.min(axis=1), x, n)


def lagged(x: np.ndarray, n: int = 1) -> np.ndarray:
    return np.concatenate([np.full(min(n, len(x)), np.nan), x[: max(0, len(x) - n)]])


def guarded(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a / (b + EPS), NaN where b is 0."""
    return a / (np.where(b == 0, np.nan, b) + EPS)


def grouped(prices: DataFrame, *makers: Callable[[dict[str, np.ndarray]], Arrays], names: list[str], more: tuple[str, ...] = ()) -> DataFrame:
    """``prices`` with the columns ``names`` that the makers give from a symbol's columns (open, high, low, close, volume and ``more`` as floats, by date); NaN becomes null."""
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in prices.schema)

    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        date = table.column("date")
        if date.null_count or not pc.all(pc.less_equal(date[:-1], date[1:])).as_py():
            table = table.take(pc.array_sort_indices(date.combine_chunks(), null_placement="at_end"))
        number = lambda c: table.column(c).cast(pa.float64(), safe=False).to_numpy()
        x = {c: number(c) for c in dict.fromkeys(("open", "high", "low", "close", "volume", *more)) if c in table.column_names}
        made: Arrays = {}
        with np.errstate(all="ignore"):
            for make in makers:
                made |= make(x)
        values = [np.asarray(made[c], float) for c in names]
        return pa.table([*table.columns, *[pa.array(v, mask=np.isnan(v)) for v in values]], names=[*table.column_names, *names])

    return prices.groupBy("symbol").applyInArrow(run, f"{schema}, {', '.join(f'`{c}` double' for c in names)}")


def _returns(spans: tuple[int, ...], x: Arrays) -> Arrays:
    c = pd.Series(x["close"]).ffill().to_numpy()
    return {f"px__ret_{n}d": c / np.where(lagged(c, n) == 0, np.nan, lagged(c, n)) - 1 for n in spans}


def _moving_averages(spans: tuple[int, ...], x: Arrays) -> Arrays:
    c, out = x["close"], {}
    for n in spans:
        m = mean(c, n)
        out |= {f"px__sma_{n}": m, f"px__dist_sma_{n}": guarded(c - m, m), f"px__sma_slope_{n}": m - lagged(m)}
    return out


def _bands(spans: tuple[int, ...], x: Arrays) -> Arrays:
    c, out = x["close"], {}
    for n in spans:
        m, s = mean(c, n), deviation(c, n)
        low, high = m - 2 * s, m + 2 * s
        out |= {f"px__z_close_{n}": guarded(c - m, s + EPS), f"px__bb_pos_{n}": guarded(c - low, high - low + EPS)}
    return out


def _ranges(x: Arrays) -> Arrays:
    o, h, l, c = (x[k] for k in ("open", "high", "low", "close"))  # noqa: E741
    b = lagged(c)
    true = np.fmax(np.fmax(np.abs(h - l), np.abs(h - b)), np.abs(l - b))
    out = {"px__hl_range": guarded(h - l, c), "px__oc_change": guarded(c - o, o), "px__gap": guarded(o - b, b), "px__true_range": true, "px__clv": guarded((c - l) - (h - c), (h - l) + EPS)}
    return out | {f"px__atr_pct_{n}": guarded(mean(true, n), c) for n in (14, 20)}


def _volatility(spans: tuple[int, ...], history: int, x: Arrays) -> Arrays:
    r = _returns((1,), x)["px__ret_1d"]
    out: Arrays = {}
    for n in spans:
        v = deviation(r, n)
        out |= {f"px__vol_{n}": v, f"px__vol_regime_z_{n}": guarded(v - mean(v, history), deviation(v, history) + EPS)}
    return out


def _channels(spans: tuple[int, ...], x: Arrays) -> Arrays:
    c, out = x["close"], {}
    for n in spans:
        h, l = highest(x["high"], n), lowest(x["low"], n)  # noqa: E741
        out |= {
            f"px__breakout_up_{n}": (c > lagged(h)).astype(float), f"px__breakout_dn_{n}": (c < lagged(l)).astype(float),
            f"px__pos_in_channel_{n}": guarded(c - l, (h - l) + EPS), f"px__dist_hh_{n}": guarded(c - h, h), f"px__dist_ll_{n}": guarded(c - l, l),
        }
    return out


def _volumes(x: Arrays) -> Arrays:
    z = lambda y, n: guarded(y - mean(y, n), deviation(y, n) + EPS)
    money = x["close"] * x["volume"]
    step = np.nan_to_num(np.sign(x["close"] - lagged(x["close"]))) * np.nan_to_num(x["volume"])
    return {f"px__vol_z_{n}": z(x["volume"], n) for n in (5, 20, 63)} | {"px__dollar_vol": money, "px__dollar_vol_z_20": z(money, 20), "px__obv": np.cumsum(step)}


def _exponential(x: Arrays) -> Arrays:
    c = pd.Series(x["close"])
    ema = {n: c.ewm(span=n, adjust=False).mean() for n in (12, 26, 50)}
    macd = ema[12] - ema[26]
    signal = macd.ewm(span=9, adjust=False).mean()
    out = {f"px__dist_ema_{n}": guarded((c - e).to_numpy(), e.to_numpy()) for n, e in ema.items()}
    return out | {"px__macd": macd.to_numpy(), "px__macd_signal": signal.to_numpy(), "px__macd_hist": (macd - signal).to_numpy()}


def _names(*parts: str, spans: tuple[int, ...]) -> list[str]:
    return [f"px__{p}_{n}" for n in spans for p in parts]


EXPONENTIAL = [*_names("dist_ema", spans=(12, 26, 50)), "px__macd", "px__macd_signal", "px__macd_hist"]
RANGES = ["px__hl_range", "px__oc_change", "px__gap", "px__true_range", "px__clv", "px__atr_pct_14", "px__atr_pct_20"]
VOLUMES = [*_names("vol_z", spans=(5, 20, 63)), "px__dollar_vol", "px__dollar_vol_z_20", "px__obv"]


def returns(prices: DataFrame, spans: tuple[int, ...] = RETURNS) -> DataFrame:
    """px__ret_{n}d: change of the close over n rows; a null close counts as the last one before. Window expressions: there is no sliding frame."""
    rows = prices.withColumn("__c", fill_forward("close", by_symbol()))
    return rows.withColumns({f"px__ret_{n}d": F.try_divide("__c", F.lag("__c", n).over(by_symbol())) - 1 for n in spans}).drop("__c")


def moving_averages(prices: DataFrame, spans: tuple[int, ...] = AVERAGES) -> DataFrame:
    """px__sma_{n}, px__dist_sma_{n}, px__sma_slope_{n}."""
    return grouped(prices, partial(_moving_averages, spans), names=_names("sma", "dist_sma", "sma_slope", spans=spans))


def bands(prices: DataFrame, spans: tuple[int, ...] = (10, 20, 63)) -> DataFrame:
    """px__z_close_{n} and px__bb_pos_{n}: the close in deviations from its mean, and its place in the two-deviation band."""
    return grouped(prices, partial(_bands, spans), names=_names("z_close", "bb_pos", spans=spans))


def ranges(prices: DataFrame) -> DataFrame:
    """Daily range, body, gap, true range and its simple mean over the close, close location value."""
    return grouped(prices, _ranges, names=RANGES)


def volatility(prices: DataFrame, spans: tuple[int, ...] = (5, 10, 20, 63), history: int = 252) -> DataFrame:
    """px__vol_{n}: deviation of daily returns; px__vol_regime_z_{n}: against its own last ``history`` values."""
    return grouped(prices, partial(_volatility, spans, history), names=_names("vol", "vol_regime_z", spans=spans))


def channels(prices: DataFrame, spans: tuple[int, ...] = (10, 20, 55)) -> DataFrame:
    """Breakouts over the lagged extremes of n rows (0 where there is none), place in and distance from the channel."""
    return grouped(prices, partial(_channels, spans), names=_names("breakout_up", "breakout_dn", "pos_in_channel", "dist_hh", "dist_ll", spans=spans))


def volumes(prices: DataFrame) -> DataFrame:
    """Volume z-scores, dollar volume and its z-score, on-balance volume."""
    return grouped(prices, _volumes, names=VOLUMES)


def exponential(prices: DataFrame) -> DataFrame:
    """Exponential means and their convergence (recursive: y = a x + (1 - a) y)."""
    return grouped(prices, _exponential, names=EXPONENTIAL)


def all_features(prices: DataFrame) -> DataFrame:
    """The dense daily set, without look-ahead; every column of `returns` to `exponential`, in one pass over each symbol."""
    makers = (partial(_returns, RETURNS), partial(_moving_averages, AVERAGES), partial(_bands, (10, 20, 63)), _ranges, partial(_volatility, (5, 10, 20, 63), 252), partial(_channels, (10, 20, 55)), _volumes, _exponential)
    names = [
        *(f"px__ret_{n}d" for n in RETURNS), *_names("sma", "dist_sma", "sma_slope", spans=AVERAGES), *_names("z_close", "bb_pos", spans=(10, 20, 63)), *RANGES, *_names("vol", "vol_regime_z", spans=(5, 10, 20, 63)),
        *_names("breakout_up", "breakout_dn", "pos_in_channel", "dist_hh", "dist_ll", spans=(10, 20, 55)), *VOLUMES, *EXPONENTIAL,
    ]
    return grouped(prices, *makers, names=names)


def sanitised(features: DataFrame, mode: str = "drop_rows") -> DataFrame:
    """Infinite values to null, then: ``drop_rows`` with a null, ``zero`` them, or ``fill`` from before, after, then 0; one row for a symbol and date."""
    names = [f.name for f in features.schema if f.dataType.simpleString() == "double"]
    rows = features.dropDuplicates(["symbol", "date"]).withColumns({c: F.when(~F.isnan(c) & (F.abs(F.col(c)) != float("inf")), F.col(c)) for c in names})
    if mode == "drop_rows":
        return rows.dropna(subset=names)
    if mode == "fill":
        after = by_symbol().rowsBetween(0, Window.unboundedFollowing)
        rows = rows.withColumns({c: F.coalesce(fill_forward(c, by_symbol()), F.first(c, ignorenulls=True).over(after)) for c in names})
    return rows.fillna(0.0, subset=names)


def research_family(prices: DataFrame, spans: tuple[int, ...] = (20, 60, 120)) -> DataFrame:
    """Return, yearly volatility, Sharpe-like ratio, largest drawdown (from a quarter of the window on, five rows at least), distance from the mean and volume z
    at several lengths; simple-mean RSI, MACD over the price, Bollinger z, ATR over the price, downside deviation and the 5 % quantile of returns over 60 rows.
    """
    names = [f"rs__{p}_{n}" for n in spans for p in ("return", "vol", "sharpe", "max_drawdown", "sma_dist", "volume_z")] + ["rs__rsi_14", "rs__macd_price", "rs__bollinger_z_20", "rs__atr_price_14", "rs__downside_60", "rs__var_60"]

    def make(x: Arrays) -> Arrays:
        c, v, year = x["close"], x["volume"], np.sqrt(252.0)
        r, d = _returns((1,), x)["px__ret_1d"], c - lagged(c)
        up, down = np.where(d > 0, d, 0.0), np.where(d < 0, -d, 0.0)
        out: Arrays = {}
        for n in spans:
            vol, least = deviation(r, n) * year, max(5, n // 4)
            fall = pd.Series(c) / pd.Series(c).rolling(n, min_periods=least).max() - 1
            sd = deviation(v, n)
            out |= {
                f"rs__return_{n}": _returns((n,), x)[f"px__ret_{n}d"], f"rs__vol_{n}": vol, f"rs__sharpe_{n}": mean(r, n) * 252 / np.where(vol == 0, np.nan, vol),
                f"rs__max_drawdown_{n}": fall.rolling(n, min_periods=least).min().to_numpy(), f"rs__sma_dist_{n}": c / mean(c, n) - 1, f"rs__volume_z_{n}": (v - mean(v, n)) / np.where(sd == 0, np.nan, sd),
            }
        loss = mean(down, 14)
        ewm = lambda n: pd.Series(c).ewm(span=n, adjust=False).mean().to_numpy()
        sd20 = deviation(c, 20)
        return out | {
            "rs__rsi_14": 100 - 100 / (1 + mean(up, 14) / np.where(loss == 0, np.nan, loss)), "rs__macd_price": (ewm(12) - ewm(26)) / c, "rs__bollinger_z_20": (c - mean(c, 20)) / np.where(sd20 == 0, np.nan, sd20),
            "rs__atr_price_14": mean(_ranges(x)["px__true_range"], 14) / c, "rs__downside_60": deviation(np.where(np.isnan(r), np.nan, np.minimum(r, 0.0)), 60) * year, "rs__var_60": frames(lambda w: np.quantile(w, 0.05, axis=1), r, 60),
        }

    return grouped(prices, make, names=names)


def drawdowns(prices: DataFrame) -> DataFrame:
    """Equity curve of daily returns and its drawdown from the highest so far."""
    rows = returns(prices, (1,)).withColumn("equity", F.exp(F.sum(F.log1p(F.coalesce("px__ret_1d", F.lit(0.0)))).over(by_symbol().rowsBetween(Window.unboundedPreceding, 0))))
    return rows.withColumn("drawdown", F.col("equity") / F.max("equity").over(by_symbol().rowsBetween(Window.unboundedPreceding, 0)) - 1)
