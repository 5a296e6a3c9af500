"""Queries of labels and targets."""

from __future__ import annotations

from pyspark.sql import functions as F

from lodestone.operators import labels as l
from lodestone.operators.specs import LabelSpec
from lodestone.plans.registry import query
from lodestone.scratch import written
from lodestone.views import PRICES, prices

LONG = f"""{PRICES}, wide AS (SELECT symbol, date, {', '.join(f'lead(close, {h}) OVER (PARTITION BY symbol ORDER BY date) / close - 1 AS h{h}' for h in (1, 5, 20))} FROM prices),
long AS ({' UNION ALL '.join(f"SELECT symbol, date, {h} AS horizon, 'forward_return_{h}d' AS target_name, h{h} AS target_value FROM wide" for h in (1, 5, 20))})"""


@query("l01_forward_returns", f"WITH {LONG} SELECT * FROM long", floats=["target_value"])
def l01(spark, sf):
    return l.forward_returns(prices(spark, sf))


@query("l02_cross_sectional_rank", f"""WITH {LONG} SELECT *, CASE WHEN target_value IS NOT NULL THEN rank() OVER (PARTITION BY date, horizon, target_value IS NULL ORDER BY target_value DESC) + (count(*) OVER (PARTITION BY date, horizon, target_value) - 1) / 2.0::DOUBLE END AS rank,
(CASE WHEN target_value IS NOT NULL THEN rank() OVER (PARTITION BY date, horizon, target_value IS NULL ORDER BY target_value) + (count(*) OVER (PARTITION BY date, horizon, target_value) - 1) / 2.0::DOUBLE END) / count(*) OVER (PARTITION BY date, horizon, target_value IS NULL) AS rank_pct FROM long""", floats=["target_value", "rank", "rank_pct"])  # fmt: skip
def l02(spark, sf):
    return l.cross_sectional_rank(l.forward_returns(prices(spark, sf)))


@query("l03_oracle_trades_k1", f"""WITH {PRICES}, p AS (SELECT *, make_date(year(date), 12, 31) AS period, row_number() OVER (PARTITION BY symbol, year(date) ORDER BY date) AS i FROM prices),
b AS (SELECT a.symbol, a.period, a.date AS entry_date, z.date AS exit_date, a.low AS entry_px, z.high AS exit_px, z.high - a.low AS profit, (z.high - a.low) / abs(a.low) AS ret,
  max(z.high - a.low) OVER (PARTITION BY a.symbol, a.period) AS top FROM p a JOIN p z ON a.symbol = z.symbol AND a.period = z.period AND a.i < z.i WHERE (z.high - a.low) / abs(a.low) >= 0.05)
SELECT symbol, cast(period AS VARCHAR) AS period, max(profit) AS profit FROM b WHERE profit = top GROUP BY ALL""", floats=["profit"], dates=["period"])  # fmt: skip
def l03(spark, sf):
    """The total gain of the best single long trade of each year: in SQL the best pair of days."""
    return l.oracle_trades(prices(spark, sf), ks=(1,), sides=("long",)).select("symbol", "period", "profit")


_GAINS = """pairs AS (SELECT a.symbol, a.period, s.side, a.i, z.i AS j, CASE s.side WHEN 'long' THEN z.high - a.low ELSE a.high - z.low END AS gain
  FROM p a JOIN p z ON a.symbol = z.symbol AND a.period = z.period AND a.i < z.i CROSS JOIN (VALUES ('long'), ('short')) s(side)
  WHERE CASE s.side WHEN 'long' THEN z.high - a.low >= 0.05 * a.low ELSE a.high - z.low >= 0.05 * a.high END),
ends AS (SELECT symbol, period, side, j, max(gain) AS gain FROM pairs GROUP BY ALL), upto AS (SELECT symbol, period, side, j, max(gain) OVER (PARTITION BY symbol, period, side ORDER BY j) AS best FROM ends),
two AS (SELECT x.symbol, x.period, x.side, max(x.gain + coalesce(u.best, 0)) AS gain FROM pairs x ASOF LEFT JOIN upto u ON x.symbol = u.symbol AND x.period = u.period AND x.side = u.side AND x.i > u.j GROUP BY ALL)"""


@query("l04_oracle_gains", f"""WITH {PRICES}, p AS (SELECT *, make_date(year(date), 12, 31) AS period, row_number() OVER (PARTITION BY symbol, year(date) ORDER BY date) AS i FROM prices), {_GAINS}
SELECT symbol, period, side, 1::INTEGER AS k, max(gain) AS gain FROM pairs GROUP BY ALL UNION ALL SELECT symbol, period, side, 2::INTEGER, gain FROM two""", floats=["gain"], dates=["period"])  # fmt: skip
def l04_gains(spark, sf):
    """What the best one and the best two trades of each year gain: in SQL by listing pairs of days, and the best pair before each."""
    trades = l.oracle_trades(prices(spark, sf), ks=(1, 2))
    return trades.groupBy("symbol", "period", "side", "k").agg(F.sum("profit").alias("gain"))


@query("l12_global_rank", f"""WITH {PRICES}, r AS (SELECT symbol, date, lead(close, 5) OVER (PARTITION BY symbol ORDER BY date) / close - 1 AS target_value FROM prices)
SELECT *, CASE WHEN target_value IS NOT NULL THEN (rank() OVER (PARTITION BY target_value IS NULL ORDER BY target_value) + (count(*) OVER (PARTITION BY target_value) - 1) / 2.0::DOUBLE) / count(*) OVER (PARTITION BY target_value IS NULL) END AS rank_pct FROM r""", floats=["target_value", "rank_pct"])  # fmt: skip
def l12(spark, sf):
    rows = l.forward_returns(prices(spark, sf), (5,)).select("symbol", "date", "target_value")
    return l.global_pct_rank(rows, "target_value").select("symbol", "date", "target_value", "rank_pct")


@query("l20_distribution", f"""WITH {LONG}, m AS (SELECT target_name, avg(target_value) AS mean FROM long GROUP BY ALL),
d AS (SELECT target_name, count(target_value) AS n, any_value(mean) AS mean, avg((target_value - mean) ** 2) AS m2, avg((target_value - mean) ** 3) AS m3, avg((target_value - mean) ** 4) AS m4 FROM long JOIN m USING (target_name) GROUP BY ALL),
e AS (SELECT target_name, n::DOUBLE AS n, mean, sqrt(m2) AS std, m3 / m2 ** 1.5 AS skew, m4 / m2 ** 2 - 3 AS kurtosis FROM d),
s AS (SELECT *, skew * sqrt((n + 1) * (n + 3) / (6 * (n - 2))) AS y, sqrt(2 * (3 * (n * n + 27 * n - 70) * (n + 1) * (n + 3) / ((n - 2) * (n + 5) * (n + 7) * (n + 9)) - 1)) - 1 AS w,
  (kurtosis + 3 - 3 * (n - 1) / (n + 1)) / sqrt(24 * n * (n - 2) * (n - 3) / ((n + 1) ** 2 * (n + 3) * (n + 5))) AS x, 6 * (n * n - 5 * n + 2) / ((n + 7) * (n + 9)) * sqrt(6 * (n + 3) * (n + 5) / (n * (n - 2) * (n - 3))) AS b FROM e),
z AS (SELECT *, ln(y / sqrt(2 / (w - 1)) + sqrt(y * y / (2 / (w - 1)) + 1)) / sqrt(ln(w) / 2) AS zs, 6 + 8 / b * (2 / b + sqrt(1 + 4 / (b * b))) AS a FROM s),
k AS (SELECT *, (1 - 2 / (9 * a) - sign(1 + x * sqrt(2 / (a - 4))) * ((1 - 2 / a) / abs(1 + x * sqrt(2 / (a - 4)))) ** (1 / 3.0::DOUBLE)) / sqrt(2 / (9 * a)) AS zk FROM z)
SELECT target_name, n::BIGINT AS n, mean, std, skew, kurtosis, CASE WHEN n >= 8 AND std > 0 THEN exp(-(zs * zs + zk * zk) / 2) END AS normal_p FROM k""", floats=["mean", "std", "skew", "kurtosis", "normal_p"], dates=[])  # fmt: skip
def l20(spark, sf):
    return l.distribution(l.forward_returns(prices(spark, sf)), "target_value", "target_name")



@query("period_ends", "SELECT cast(l_shipdate AS DATE) AS date, cast(date_trunc('week', l_shipdate) + INTERVAL 6 DAY AS DATE) AS w, cast(last_day(l_shipdate) AS DATE) AS m, cast(date_trunc('quarter', l_shipdate) + INTERVAL 3 MONTH - INTERVAL 1 DAY AS DATE) AS q, make_date(year(l_shipdate), 12, 31) AS y, count(*) AS n FROM lineitem GROUP BY ALL", dates=["date", "w", "m", "q", "y"])
def periods(spark, sf):
    rows = spark.read.parquet(f"{sf}/lineitem.parquet").select(F.to_date("l_shipdate").alias("date"))
    return rows.select("date", *[l.period_end("date", f).alias(a) for f, a in (("W", "w"), ("ME", "m"), ("QE", "q"), ("YE", "y"))]).groupBy("date", "w", "m", "q", "y").agg(F.count("*").alias("n"))


def _trades(name: str, period: str, freq: str) -> str:
    """The best single trade of each period and side, by listing all pairs of days."""
    return f"""{name}p AS (SELECT *, {period} AS period, row_number() OVER (PARTITION BY symbol, {period} ORDER BY date) AS i FROM prices),
{name}x AS (SELECT a.symbol, s.side, '{freq}' AS freq, a.period, 1::INTEGER AS k, a.date AS entry_date, z.date AS exit_date, CASE s.side WHEN 'long' THEN a.low ELSE a.high END AS entry_px, CASE s.side WHEN 'long' THEN z.high ELSE z.low END AS exit_px, CASE s.side WHEN 'long' THEN z.high - a.low ELSE a.high - z.low END AS profit
  FROM {name}p a JOIN {name}p z ON a.symbol = z.symbol AND a.period = z.period AND a.i < z.i CROSS JOIN (VALUES ('long'), ('short')) s(side)),
{name} AS (SELECT *, profit / abs(entry_px) AS ret FROM {name}x WHERE profit >= 0.05 * abs(entry_px) QUALIFY row_number() OVER (PARTITION BY symbol, period, side ORDER BY profit DESC, exit_date, entry_date) = 1)"""


def trade_sets(name: str, period: str, freq: str, ks: tuple[int, ...]) -> str:
    """The best sets of at most k trades of each period and side, for each k: level by level over the pairs of days, then traced back from the last trade of a set.

    The same rule for sets of equal gain as the operator's: within 1e-12 fewer trades, then the earlier exit; of equal totals the earlier entry.
    """
    g, most = "symbol, period, side", max(ks)
    same = lambda x, y: f"{x}.symbol = {y}.symbol AND {x}.period = {y}.period AND {x}.side = {y}.side"
    out = [
        f"{name}p AS (SELECT *, {period} AS period, row_number() OVER (PARTITION BY symbol, {period} ORDER BY date) AS i FROM prices)",
        f"""{name}g AS (SELECT a.symbol, s.side, a.period, a.i, z.i AS j, CASE s.side WHEN 'long' THEN z.high - a.low ELSE -(z.low - a.high) END AS gain FROM {name}p a JOIN {name}p z ON a.symbol = z.symbol AND a.period = z.period AND a.i < z.i CROSS JOIN (VALUES ('long'), ('short')) s(side)
  WHERE CASE s.side WHEN 'long' THEN z.high - a.low >= 0.05 * abs(a.low) ELSE -(z.low - a.high) >= 0.05 * abs(a.high) END)""",
        f"{name}a1 AS (SELECT {g}, j, i AS s, gain AS v FROM {name}g QUALIFY row_number() OVER (PARTITION BY {g}, j ORDER BY gain DESC, i) = 1)",
    ]
    for t in range(2, most + 1):
        out.append(f"{name}b{t} AS (SELECT {g}, j, max(v) OVER (PARTITION BY {g} ORDER BY j) AS best FROM {name}a{t - 1})")
        out.append(f"{name}a{t} AS (SELECT x.symbol, x.period, x.side, x.j, x.i AS s, b.best + x.gain AS v FROM {name}g x ASOF JOIN {name}b{t} b ON {same('x', 'b')} AND x.i > b.j QUALIFY row_number() OVER (PARTITION BY x.symbol, x.period, x.side, x.j ORDER BY b.best + x.gain DESC, x.i) = 1)")
    tops = ", ".join(f"max(v) FILTER (t = {t}) AS t{t}" for t in range(1, most + 1))
    rows = " UNION ALL ".join(f"SELECT {g}, {t} AS t, v FROM {name}a{t}" for t in range(1, most + 1))
    counts, before, used = [], "0", "0"
    for t in range(1, most + 1):
        more = f"coalesce(t{t}, 0) > ({before}) + 1e-12"
        used, before = f"CASE WHEN {more} THEN {t} ELSE ({used}) END", f"CASE WHEN {more} THEN t{t} ELSE ({before}) END"
        counts.append(f"{used} AS c{t}")
    out.append(f"{name}c AS (SELECT {g}, {', '.join(counts)} FROM (SELECT {g}, {tops} FROM ({rows}) GROUP BY ALL))")
    for c in range(1, most + 1):
        for t in range(c, 0, -1):
            bound = "" if t == c else f" JOIN {name}x{c}_{t + 1} r ON {same('a', 'r')} AND a.j < r.s"
            out.append(
                f"{name}x{c}_{t} AS (SELECT symbol, period, side, j, s FROM (SELECT a.*, max(a.v) OVER (PARTITION BY a.symbol, a.period, a.side) AS top FROM {name}a{t} a{bound}) WHERE v >= top - 1e-12 QUALIFY row_number() OVER (PARTITION BY {g} ORDER BY j) = 1)"
            )
    every = " UNION ALL ".join(f"SELECT {g}, {c} AS c, j, s FROM {name}x{c}_{t}" for c in range(1, most + 1) for t in range(1, c + 1))
    chosen = " UNION ALL ".join(f"SELECT {g}, {k}::INTEGER AS k, c{k} AS c FROM {name}c" for k in ks)
    out.append(f"""{name} AS (SELECT w.symbol, w.side, '{freq}' AS freq, w.period, w.k, a.date AS entry_date, z.date AS exit_date, CASE w.side WHEN 'long' THEN a.low ELSE a.high END AS entry_px, CASE w.side WHEN 'long' THEN z.high ELSE z.low END AS exit_px,
  CASE w.side WHEN 'long' THEN z.high - a.low ELSE a.high - z.low END AS profit, CASE w.side WHEN 'long' THEN z.high - a.low ELSE a.high - z.low END / abs(CASE w.side WHEN 'long' THEN a.low ELSE a.high END) AS ret
  FROM ({chosen}) w JOIN ({every}) e ON {same('w', 'e')} AND w.c = e.c JOIN {name}p a ON a.symbol = e.symbol AND a.period = e.period AND a.i = e.s JOIN {name}p z ON z.symbol = e.symbol AND z.period = e.period AND z.i = e.j)""")  # fmt: skip
    return ",\n".join(out)


YEAR, QUARTER = "make_date(year(date), 12, 31)", "cast(date_trunc('quarter', date) + INTERVAL 3 MONTH - INTERVAL 1 DAY AS DATE)"
ONE = f"{PRICES}, {_trades('ye', YEAR, 'YE')}, {_trades('qe', QUARTER, 'QE')}, t AS (SELECT * FROM ye UNION ALL SELECT * FROM qe)"
THREE = f"{PRICES}, {trade_sets('ye', YEAR, 'YE', (1, 2, 3))}, t AS (SELECT * FROM ye)"
_ID = "concat_ws('_', symbol, side, freq, k, entry_date, exit_date) AS trade_id"


def one_trade(spark, sf):
    return l.oracle_trades(prices(spark, sf), freq={"YE": (1,), "QE": (1,)})


@query("l05_completed_k1", f"WITH {ONE} SELECT symbol, side, freq, period, k, entry_date, exit_date, entry_px, exit_px, profit, ret, (exit_date - entry_date)::INTEGER AS hold_days, {_ID} FROM t", floats=["entry_px", "exit_px", "profit", "ret"], dates=["period", "entry_date", "exit_date"])
def l05_one(spark, sf):
    return l.completed(one_trade(spark, sf))


_DEDUPED = "d AS (SELECT * FROM t QUALIFY row_number() OVER (PARTITION BY symbol, side, entry_date, exit_date ORDER BY k, period, freq) = 1)"


@query("l06_deduped_k1", f"WITH {ONE}, {_DEDUPED}, e AS (SELECT 'exact' AS mode, symbol, side, entry_date, exit_date, ret FROM d UNION ALL SELECT 'entry_date', symbol, side, entry_date, exit_date, ret FROM (SELECT * FROM t QUALIFY row_number() OVER (PARTITION BY symbol, side, entry_date ORDER BY ret DESC, exit_date, k, period, freq) = 1)) SELECT * FROM e", floats=["ret"], dates=["entry_date", "exit_date"])
def l06_one(spark, sf):
    t = written(one_trade(spark, sf), "trades")
    both = [l.dedupe_trades(t, m).select(F.lit(m).alias("mode"), "symbol", "side", "entry_date", "exit_date", "ret") for m in ("exact", "entry_date")]
    return both[0].unionByName(both[1])


_stats = ["win_pct", "loss_pct", "mean_ret", "median_ret", "std_ret", "sharpe", "mean_hold"]


@query("l08_statistics_k1", f"""WITH {ONE} SELECT symbol, side, freq, count(*) AS trades, round(100 * avg((ret > 0)::DOUBLE), 2) AS win_pct, round(100 * avg((ret < 0)::DOUBLE), 2) AS loss_pct, avg(ret) AS mean_ret, median(ret) AS median_ret, stddev_samp(ret) AS std_ret, avg(ret) / nullif(stddev_samp(ret), 0) AS sharpe, avg(exit_date - entry_date) AS mean_hold
FROM t GROUP BY ALL""", floats=_stats, dates=[])  # fmt: skip
def l08_one(spark, sf):
    """By symbol, side and frequency."""
    return l.trade_statistics(one_trade(spark, sf), "symbol", "side", "freq")


_LEGS = f"""{_DEDUPED}, e AS (SELECT *, {_ID} FROM d), legs AS (SELECT trade_id, symbol, side, freq, k, ret, entry_date AS date, entry_px AS px, CASE side WHEN 'long' THEN 'buy' ELSE 'short' END AS action, CASE side WHEN 'long' THEN 1 ELSE -1 END AS position FROM e
  UNION ALL SELECT trade_id, symbol, side, freq, k, ret, exit_date, exit_px, CASE side WHEN 'long' THEN 'sell' ELSE 'cover' END, 0 FROM e)"""


@query("l07_l09_l10_weights_k1", f"""WITH {ONE}, {_LEGS}, n AS (SELECT side, k, count(*) AS n FROM legs GROUP BY ALL), c AS (SELECT *, ret - 2 * 3 / 1e4 AS net FROM legs)
SELECT trade_id, symbol, c.side, freq, c.k, net AS ret, date, px, action, position, (action IN ('buy', 'cover'))::INTEGER AS target, (1 + 1.0 * least(greatest(net, 0.0), 0.5) / 0.5) * least(greatest((SELECT max(n) FROM n) / n.n, 1.0), 3.0) AS weight FROM c JOIN n ON c.side = n.side AND c.k = n.k""", floats=["ret", "px", "weight"])  # fmt: skip
def l10_one(spark, sf):
    return l.weighted_labels(l.optimal_events(l.dedupe_trades(one_trade(spark, sf))))


@query("l11_l13_actions_k1", f"""WITH {ONE}, {_LEGS}, f AS (SELECT symbol, date, action, position FROM legs QUALIFY row_number() OVER (PARTITION BY symbol, date ORDER BY CASE action WHEN 'buy' THEN 1 WHEN 'short' THEN 2 WHEN 'sell' THEN 3 ELSE 4 END) = 1)
SELECT p.symbol, p.date, coalesce(f.action, 'hold') AS action, coalesce(f.position, 0) AS position FROM prices p LEFT JOIN f USING (symbol, date)""")  # fmt: skip
def l11_one(spark, sf):
    return l.action_labels(prices(spark, sf).select("symbol", "date"), l.dedupe_trades(one_trade(spark, sf)))


@query("l13_label_panel_k1", f"WITH {ONE}, {_LEGS}, g AS (SELECT * FROM legs QUALIFY row_number() OVER (PARTITION BY date, symbol, side, action ORDER BY ret DESC, trade_id) = 1) SELECT trade_id, symbol, side, freq, k, ret, date, px, action, position FROM g", floats=["ret", "px"])
def l13_one(spark, sf):
    return l.dedupe_labels(l.label_rows(l.dedupe_trades(one_trade(spark, sf))))


_trade = ["entry_px", "exit_px", "profit", "ret"]
_days = ["period", "entry_date", "exit_date"]


@query("l04_oracle_trades", f"WITH {THREE} SELECT symbol, side, freq, period, k, entry_date, exit_date, entry_px, exit_px, profit, ret FROM t", floats=_trade, dates=_days)
def l04(spark, sf):
    return l.oracle_trades(prices(spark, sf))


@query("l05_l06_completed_deduped", f"""WITH {THREE}, d AS (SELECT * FROM t QUALIFY row_number() OVER (PARTITION BY symbol, side, entry_date ORDER BY ret DESC, exit_date, k, period, freq) = 1)
SELECT symbol, side, freq, period, k, entry_date, exit_date, entry_px, exit_px, profit, ret, (exit_date - entry_date)::INTEGER AS hold_days, {_ID} FROM d""", floats=_trade, dates=_days)  # fmt: skip
def l05(spark, sf):
    return l.completed(l.dedupe_trades(l.oracle_trades(prices(spark, sf)), "entry_date"))


@query("l07_l09_l10_weighted_labels", f"""WITH {THREE}, {_LEGS}, n AS (SELECT side, k, count(*) AS n FROM legs GROUP BY ALL), c AS (SELECT *, ret - 2 * 3 / 1e4 AS net FROM legs)
SELECT trade_id, symbol, c.side, freq, c.k, net AS ret, date, px, action, position, (action IN ('buy', 'cover'))::INTEGER AS target, (1 + 1.0 * least(greatest(net, 0.0), 0.5) / 0.5) * least(greatest((SELECT max(n) FROM n) / n.n, 1.0), 3.0) AS weight FROM c JOIN n ON c.side = n.side AND c.k = n.k""", floats=["ret", "px", "weight"])  # fmt: skip
def l10(spark, sf):
    return l.weighted_labels(l.optimal_events(l.dedupe_trades(l.oracle_trades(prices(spark, sf)))))


@query("l08_trade_statistics", f"""WITH {THREE} SELECT side, freq, k, count(*) AS trades, round(100 * avg((ret > 0)::DOUBLE), 2) AS win_pct, round(100 * avg((ret < 0)::DOUBLE), 2) AS loss_pct, avg(ret) AS mean_ret, median(ret) AS median_ret, stddev_samp(ret) AS std_ret, avg(ret) / nullif(stddev_samp(ret), 0) AS sharpe, avg(exit_date - entry_date) AS mean_hold
FROM t GROUP BY ALL""", floats=_stats, dates=[])  # fmt: skip
def l08(spark, sf):
    return l.trade_statistics(l.oracle_trades(prices(spark, sf)), "side", "freq", "k")


_BUILT = f"{PRICES}, {trade_sets('ye', YEAR, 'YE', (1, 2, 3))}, {trade_sets('qe', QUARTER, 'QE', (1,))}, t AS (SELECT * FROM ye UNION ALL SELECT * FROM qe)"


@query("l14_label_build", f"""WITH {_BUILT}, {_LEGS}, n AS (SELECT side, k, count(*) AS n FROM legs GROUP BY ALL), c AS (SELECT *, ret - 2 * (2 + 1) / 1e4 AS net FROM legs)
SELECT symbol, c.side, freq, c.k, date, action, net AS ret, (1 + 1.0 * least(greatest(net, 0.0), 0.5) / 0.5) * least(greatest((SELECT max(n) FROM n) / n.n, 1.0), 3.0) AS weight FROM c JOIN n ON c.side = n.side AND c.k = n.k""", floats=["ret", "weight"])  # fmt: skip
def l14(spark, sf):
    """All labels of a build specification: yearly trades of three counts and quarterly ones."""
    return LabelSpec().labels(prices(spark, sf)).select("symbol", "side", "freq", "k", "date", "action", "ret", "weight")
