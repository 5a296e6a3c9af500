"""Queries over daily prices: technical features."""

from __future__ import annotations

from lodestone.operators import technical as t
from lodestone.plans.registry import ORACLE_SQL, query
from lodestone.views import PRICES, prices

KEY = ("symbol", "date")


def _select(df, *columns):
    return df.select(*KEY, *columns)


def _guard(f: str, c: str, n: int) -> str:
    frame = f"OVER (PARTITION BY symbol ORDER BY date ROWS {n - 1} PRECEDING)"
    return f"CASE WHEN count({c}) {frame} = {n} THEN {f}({c}) {frame} END"


def _sd(a: str, b: str) -> str:
    return f"(({a}) / (nullif({b}, 0) + 1e-12))"


RET1 = "rets AS (SELECT *, close / lag(close) OVER (PARTITION BY symbol ORDER BY date) - 1 AS r FROM prices)"


@query("p01_returns", f"WITH {PRICES} SELECT symbol, date, {', '.join(f'close / lag(close, {n}) OVER (PARTITION BY symbol ORDER BY date) - 1 AS px__ret_{n}d' for n in t.RETURNS)} FROM prices", floats=[f"px__ret_{n}d" for n in t.RETURNS])
def p01(spark, sf):
    return _select(t.returns(prices(spark, sf)), *[f"px__ret_{n}d" for n in t.RETURNS])


_sma = ", ".join(f"{_guard('avg', 'close', n)} AS px__sma_{n}" for n in t.AVERAGES)
_sma2 = ", ".join(f"px__sma_{n}, {_sd(f'close - px__sma_{n}', f'px__sma_{n}')} AS px__dist_sma_{n}, px__sma_{n} - lag(px__sma_{n}) OVER (PARTITION BY symbol ORDER BY date) AS px__sma_slope_{n}" for n in t.AVERAGES)
_sma_names = [f"px__{k}_{n}" for n in t.AVERAGES for k in ("sma", "dist_sma", "sma_slope")]


@query("p02_moving_averages", f"WITH {PRICES}, s AS (SELECT *, {_sma} FROM prices) SELECT symbol, date, {_sma2} FROM s", floats=_sma_names)
def p02(spark, sf):
    return _select(t.moving_averages(prices(spark, sf)), *_sma_names)


_ema_names = ["px__dist_ema_12", "px__dist_ema_26", "px__dist_ema_50", "px__macd", "px__macd_signal", "px__macd_hist"]


def _ema(n: int, x: str, before: str) -> str:
    return f"{2 / (n + 1)!r} * {x} + (1 - {2 / (n + 1)!r}) * {before}"


@query("p03_exponential", f"""
WITH RECURSIVE {PRICES}, n AS (SELECT symbol, date, close, row_number() OVER (PARTITION BY symbol ORDER BY date) AS k FROM prices),
e AS (SELECT symbol, date, close, k, close AS a, close AS b, close AS c, 0.0::DOUBLE AS s FROM n WHERE k = 1
  UNION ALL SELECT n.symbol, n.date, n.close, n.k, {_ema(12, 'n.close', 'e.a')}, {_ema(26, 'n.close', 'e.b')}, {_ema(50, 'n.close', 'e.c')},
  {_ema(9, f"(({_ema(12, 'n.close', 'e.a')}) - ({_ema(26, 'n.close', 'e.b')}))", 'e.s')} FROM e JOIN n ON n.symbol = e.symbol AND n.k = e.k + 1)
SELECT symbol, date, {_sd('close - a', 'a')} AS px__dist_ema_12, {_sd('close - b', 'b')} AS px__dist_ema_26, {_sd('close - c', 'c')} AS px__dist_ema_50, a - b AS px__macd, s AS px__macd_signal, a - b - s AS px__macd_hist FROM e
""", floats=_ema_names)  # fmt: skip
def p03(spark, sf):
    return _select(t.exponential(prices(spark, sf)), *_ema_names)


_band = ", ".join(f"{_guard('avg', 'close', n)} AS m{n}, {_guard('stddev_samp', 'close', n)} AS s{n}" for n in (10, 20, 63))
_band2 = ", ".join(f"{_sd(f'close - m{n}', f's{n} + 1e-12')} AS px__z_close_{n}, {_sd(f'close - (m{n} - 2 * s{n})', f'(m{n} + 2 * s{n}) - (m{n} - 2 * s{n}) + 1e-12')} AS px__bb_pos_{n}" for n in (10, 20, 63))


@query("p04_bands", f"WITH {PRICES}, s AS (SELECT *, {_band} FROM prices) SELECT symbol, date, {_band2} FROM s", floats=[f"px__{k}_{n}" for n in (10, 20, 63) for k in ("z_close", "bb_pos")])
def p04(spark, sf):
    return _select(t.bands(prices(spark, sf)), *[f"px__{k}_{n}" for n in (10, 20, 63) for k in ("z_close", "bb_pos")])


_range_names = ["px__hl_range", "px__oc_change", "px__gap", "px__true_range", "px__clv", "px__atr_pct_14", "px__atr_pct_20"]


@query("p05_p06_p11_ranges", f"""WITH {PRICES}, b AS (SELECT *, lag(close) OVER (PARTITION BY symbol ORDER BY date) AS b FROM prices),
s AS (SELECT *, greatest(abs(high - low), abs(high - b), abs(low - b)) AS px__true_range FROM b)
SELECT symbol, date, {_sd('high - low', 'close')} AS px__hl_range, {_sd('close - open', 'open')} AS px__oc_change, {_sd('open - b', 'b')} AS px__gap, px__true_range,
{_sd('(close - low) - (high - close)', 'high - low + 1e-12')} AS px__clv, {_sd(_guard('avg', 'px__true_range', 14), 'close')} AS px__atr_pct_14, {_sd(_guard('avg', 'px__true_range', 20), 'close')} AS px__atr_pct_20 FROM s""", floats=_range_names)  # fmt: skip
def p05(spark, sf):
    return _select(t.ranges(prices(spark, sf)), *_range_names)


_vol_names = [f"px__{k}_{n}" for n in (5, 10, 20, 63) for k in ("vol", "vol_regime_z")]
_vol = ", ".join(f"{_guard('stddev_samp', 'r', n)} AS px__vol_{n}" for n in (5, 10, 20, 63))
_vol2 = ", ".join(f"px__vol_{n}, {_sd(f'px__vol_{n} - ' + _guard('avg', f'px__vol_{n}', 252), _guard('stddev_samp', f'px__vol_{n}', 252) + ' + 1e-12')} AS px__vol_regime_z_{n}" for n in (5, 10, 20, 63))


@query("p07_volatility", f"WITH {PRICES}, {RET1}, s AS (SELECT *, {_vol} FROM rets) SELECT symbol, date, {_vol2} FROM s", floats=_vol_names)
def p07(spark, sf):
    return _select(t.volatility(prices(spark, sf)), *_vol_names)


_ch_names = [f"px__{k}_{n}" for n in (10, 20, 55) for k in ("breakout_up", "breakout_dn", "pos_in_channel", "dist_hh", "dist_ll")]
_ch = ", ".join(f"{_guard('max', 'high', n)} AS h{n}, {_guard('min', 'low', n)} AS l{n}" for n in (10, 20, 55))
_ch2 = ", ".join(
    f"CASE WHEN close > lag(h{n}) OVER w THEN 1.0::DOUBLE ELSE 0.0 END AS px__breakout_up_{n}, CASE WHEN close < lag(l{n}) OVER w THEN 1.0::DOUBLE ELSE 0.0 END AS px__breakout_dn_{n}, {_sd(f'close - l{n}', f'h{n} - l{n} + 1e-12')} AS px__pos_in_channel_{n}, {_sd(f'close - h{n}', f'h{n}')} AS px__dist_hh_{n}, {_sd(f'close - l{n}', f'l{n}')} AS px__dist_ll_{n}"
    for n in (10, 20, 55)
)


@query("p08_channels", f"WITH {PRICES}, s AS (SELECT *, {_ch} FROM prices) SELECT symbol, date, {_ch2} FROM s WINDOW w AS (PARTITION BY symbol ORDER BY date)", floats=_ch_names)
def p08(spark, sf):
    return _select(t.channels(prices(spark, sf)), *_ch_names)


_v_names = ["px__vol_z_5", "px__vol_z_20", "px__vol_z_63", "px__dollar_vol", "px__dollar_vol_z_20", "px__obv"]


def _z(c: str, n: int) -> str:
    return _sd(f"{c} - {_guard('avg', c, n)}", f"{_guard('stddev_samp', c, n)} + 1e-12")


@query("p09_p10_volumes", f"""WITH {PRICES}, s AS (SELECT *, close * volume AS px__dollar_vol, coalesce(sign(close - lag(close) OVER (PARTITION BY symbol ORDER BY date)), 0) * volume AS step FROM prices)
SELECT symbol, date, {', '.join(f'{_z("volume", n)} AS px__vol_z_{n}' for n in (5, 20, 63))}, px__dollar_vol, {_z('px__dollar_vol', 20)} AS px__dollar_vol_z_20, sum(step) OVER (PARTITION BY symbol ORDER BY date ROWS UNBOUNDED PRECEDING) AS px__obv FROM s""", floats=_v_names)  # fmt: skip
def p09(spark, sf):
    return _select(t.volumes(prices(spark, sf)), *_v_names)


_parts = ("p01_returns", "p02_moving_averages", "p03_exponential", "p04_bands", "p05_p06_p11_ranges", "p07_volatility", "p08_channels", "p09_p10_volumes")
_all_names = [f"px__ret_{n}d" for n in t.RETURNS] + _sma_names + _ema_names + [f"px__{k}_{n}" for n in (10, 20, 63) for k in ("z_close", "bb_pos")] + _range_names + _vol_names + _ch_names + _v_names


@query("p12_p13_all_price_features", "SELECT * FROM " + " JOIN ".join(f"({ORACLE_SQL[p]}) AS {p} {'USING (symbol, date)' if i else ''}" for i, p in enumerate(_parts)), floats=_all_names)
def p12(spark, sf):
    """All families in one pass: equal to the families' own SQL, joined."""
    return _select(t.all_features(prices(spark, sf)), *_all_names)


@query("p14_sanitised_zero", f"WITH {PRICES}, {RET1} SELECT symbol, date, coalesce(r, 0) AS px__ret_1d FROM rets", floats=["px__ret_1d"])
def p14(spark, sf):
    return _select(t.sanitised(t.returns(prices(spark, sf), (1,)), "zero"), "px__ret_1d")


_rs_names = [f"rs__{k}_{n}" for n in (20, 60, 120) for k in ("return", "vol", "sharpe", "max_drawdown", "sma_dist", "volume_z")] + ["rs__rsi_14", "rs__bollinger_z_20", "rs__atr_price_14", "rs__downside_60", "rs__var_60"]
_fell = ", ".join(f"CASE WHEN count(close) OVER (PARTITION BY symbol ORDER BY date ROWS {n - 1} PRECEDING) >= {max(5, n // 4)} THEN close / max(close) OVER (PARTITION BY symbol ORDER BY date ROWS {n - 1} PRECEDING) - 1 END AS fell{n}" for n in (20, 60, 120))
_rs = ", ".join(
    f"close / lag(close, {n}) OVER (PARTITION BY symbol ORDER BY date) - 1 AS rs__return_{n}, {_guard('stddev_samp', 'r', n)} * sqrt(252) AS rs__vol_{n}, {_guard('avg', 'r', n)} * 252 / nullif({_guard('stddev_samp', 'r', n)} * sqrt(252), 0) AS rs__sharpe_{n}, close / ({_guard('avg', 'close', n)}) - 1 AS rs__sma_dist_{n}, (volume - {_guard('avg', 'volume', n)}) / nullif({_guard('stddev_samp', 'volume', n)}, 0) AS rs__volume_z_{n}, CASE WHEN count(fell{n}) OVER (PARTITION BY symbol ORDER BY date ROWS {n - 1} PRECEDING) >= {max(5, n // 4)} THEN min(fell{n}) OVER (PARTITION BY symbol ORDER BY date ROWS {n - 1} PRECEDING) END AS rs__max_drawdown_{n}"
    for n in (20, 60, 120)
)


@query("p24_research_family", f"""WITH {PRICES}, rets AS (SELECT *, close / lag(close) OVER (PARTITION BY symbol ORDER BY date) - 1 AS r, close - lag(close) OVER (PARTITION BY symbol ORDER BY date) AS d, lag(close) OVER (PARTITION BY symbol ORDER BY date) AS b, {_fell} FROM prices),
g AS (SELECT *, CASE WHEN d IS NULL THEN 0.0 ELSE greatest(d, 0) END AS g, CASE WHEN d IS NULL THEN 0.0 ELSE greatest(-d, 0) END AS x, least(r, 0) AS low_r, greatest(abs(high - low), abs(high - b), abs(low - b)) AS tr FROM rets),
h AS (SELECT * REPLACE (CASE WHEN r IS NOT NULL THEN low_r END AS low_r) FROM g)
SELECT symbol, date, {_rs}, 100 - 100 / (1 + ({_guard('avg', 'g', 14)}) / nullif({_guard('avg', 'x', 14)}, 0)) AS rs__rsi_14, (close - {_guard('avg', 'close', 20)}) / nullif({_guard('stddev_samp', 'close', 20)}, 0) AS rs__bollinger_z_20,
({_guard('avg', 'tr', 14)}) / close AS rs__atr_price_14, ({_guard('stddev_samp', 'low_r', 60)}) * sqrt(252) AS rs__downside_60, CASE WHEN count(r) OVER (PARTITION BY symbol ORDER BY date ROWS 59 PRECEDING) = 60 THEN quantile_cont(r, 0.05) OVER (PARTITION BY symbol ORDER BY date ROWS 59 PRECEDING) END AS rs__var_60 FROM h""", floats=_rs_names)  # fmt: skip
def p24(spark, sf):
    return _select(t.research_family(prices(spark, sf)), *_rs_names)


@query("p26_drawdown", f"""WITH {PRICES}, {RET1}, e AS (SELECT symbol, date, exp(sum(ln(1 + coalesce(r, 0))) OVER (PARTITION BY symbol ORDER BY date ROWS UNBOUNDED PRECEDING)) AS equity FROM rets)
SELECT symbol, date, equity, equity / max(equity) OVER (PARTITION BY symbol ORDER BY date ROWS UNBOUNDED PRECEDING) - 1 AS drawdown FROM e""", floats=["equity", "drawdown"])  # fmt: skip
def p26(spark, sf):
    return _select(t.drawdowns(prices(spark, sf)), "equity", "drawdown")
