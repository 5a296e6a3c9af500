"""Queries of research aggregates, statistical families and option label panels."""

from __future__ import annotations

from pyspark.sql import functions as F

from lodestone.operators import labels, planning, research as r, upsert
from lodestone.operators.technical import returns
from lodestone.plans.events import TYPED, typed
from lodestone.plans.labels import QUARTER, YEAR, trade_sets
from lodestone.plans.prices import _guard
from lodestone.plans.registry import query
from lodestone.views import CHAIN, MACRO, PRICES, chain, macro, prices

RET = f"{PRICES}, r AS (SELECT *, close / nullif(lag(close) OVER (PARTITION BY symbol ORDER BY date), 0) - 1 AS r FROM prices)"


@query("v16_signal_performance", f"""WITH {RET}, s AS (SELECT *, CASE WHEN r > 0 THEN 1.0 ELSE -0.5 END AS signal FROM r), h AS (SELECT *, coalesce(least(greatest(lag(signal) OVER (PARTITION BY symbol ORDER BY date), -1), 1), 0)::DOUBLE AS p FROM s),
x AS (SELECT *, p * coalesce(r, 0) AS x, abs(p - coalesce(lag(p) OVER (PARTITION BY symbol ORDER BY date), 0)) AS t FROM h), e AS (SELECT *, exp(sum(ln(1 + greatest(x, -0.999999))) OVER (PARTITION BY symbol ORDER BY date ROWS UNBOUNDED PRECEDING)) AS e FROM x),
d AS (SELECT *, e / max(e) OVER (PARTITION BY symbol ORDER BY date ROWS UNBOUNDED PRECEDING) - 1 AS d FROM e)
SELECT symbol, avg(x) * 252 AS annual_return, stddev_samp(x) * sqrt(252) AS annual_vol, min(d) AS max_drawdown, avg((x > 0)::DOUBLE) FILTER (p <> 0) AS hit_rate, avg(abs(p)) AS exposure, avg(t) AS turnover FROM d GROUP BY ALL""", floats=["annual_return", "annual_vol", "max_drawdown", "hit_rate", "exposure", "turnover"], dates=[], digits=5)  # fmt: skip
def v16(spark, sf):
    rows = returns(prices(spark, sf), (1,)).withColumn("signal", F.when(F.col("px__ret_1d") > 0, 1.0).otherwise(-0.5))
    return r.signal_performance(rows, ret="px__ret_1d").select("symbol", "annual_return", "annual_vol", "max_drawdown", "hit_rate", "exposure", "turnover")


@query("v17_signal_state", f"""WITH {RET}, s AS (SELECT symbol, date, close / ({_guard('avg', 'close', 20)}) - 1 AS trend_fast, close / ({_guard('avg', 'close', 60)}) - 1 AS trend_slow, close / ({_guard('max', 'high', 60)}) - 1 AS breakout, {_guard('stddev_samp', 'r', 20)} * sqrt(252) AS vol FROM r)
SELECT symbol, date, trend_fast, trend_slow, breakout, CASE WHEN vol IS NOT NULL THEN least(0.15 / nullif(vol, 0), 1) ELSE 1.0 END AS vol_target_weight, CASE WHEN vol IS NULL THEN 'unknown' WHEN vol < 0.15 THEN 'low' WHEN vol < 0.3 THEN 'medium' ELSE 'high' END AS risk_bucket FROM s""", floats=["trend_fast", "trend_slow", "breakout", "vol_target_weight"])  # fmt: skip
def v17(spark, sf):
    return r.signal_state(prices(spark, sf)).select("symbol", "date", "trend_fast", "trend_slow", "breakout", "vol_target_weight", "risk_bucket")


@query("v18_concentration", """WITH h AS (SELECT concat('S', l_suppkey) AS fund, cast(date_trunc('quarter', l_shipdate) AS DATE) AS as_of, l_partkey AS holding, sum(l_extendedprice) AS weight FROM lineitem GROUP BY ALL),
l AS (SELECT * FROM h QUALIFY as_of = max(as_of) OVER (PARTITION BY fund)), k AS (SELECT *, row_number() OVER (PARTITION BY fund ORDER BY weight DESC, holding) AS k FROM l)
SELECT fund, as_of, count(*) AS holdings, sum(weight) FILTER (k <= 10) AS top_weight, max(holding) FILTER (k = 1) AS largest, max(weight) AS largest_weight FROM k GROUP BY ALL""", floats=["top_weight", "largest_weight"], dates=["as_of"], digits=2)  # fmt: skip
def v18(spark, sf):
    h = spark.read.parquet(f"{sf}/lineitem.parquet").groupBy(F.concat(F.lit("S"), "l_suppkey").alias("fund"), F.date_trunc("quarter", F.col("l_shipdate").cast("timestamp")).cast("date").alias("as_of"), F.col("l_partkey").alias("holding")).agg(F.sum("l_extendedprice").alias("weight"))
    return r.concentration(h)


@query("v20_macro_regimes", f"""WITH {MACRO}, m AS (SELECT *, lag(value) OVER (PARTITION BY series_code ORDER BY date) AS b FROM macro), t AS (SELECT date, lead(value) OVER (ORDER BY date) / value - 1 AS f FROM macro WHERE series_code = 'macro__asia')
SELECT series_code, CASE WHEN value > b THEN 'rising' ELSE 'falling' END AS regime, count(*) AS months, avg(f) AS mean, stddev_samp(f) AS std, avg(f) * 12 AS annualised FROM m JOIN t USING (date) WHERE b IS NOT NULL AND f IS NOT NULL GROUP BY ALL""", floats=["mean", "std", "annualised"], dates=[])  # fmt: skip
def v20(spark, sf):
    from pyspark.sql import Window

    m = macro(spark, sf)
    w = Window.partitionBy("series_code").orderBy("date")
    t = m.filter("series_code = 'macro__asia'").select("date", (F.lead("value").over(w) / F.col("value") - 1).alias("forward_return"))
    return r.macro_regimes(m, t)


@query("v21_curve_state", f"WITH {PRICES}, s AS (SELECT symbol AS key, date, high - 2 * low AS slope FROM prices) SELECT key, date, slope, slope - lag(slope, 21) OVER (PARTITION BY key ORDER BY date) AS slope_change, slope < 0 AS inverted FROM s", floats=["slope", "slope_change"])
def v21(spark, sf):
    wide = prices(spark, sf).select(F.col("symbol").alias("key"), "date", F.col("high").alias("y10"), (2 * F.col("low")).alias("y2"))
    return r.curve_state(wide, "y10", "y2").select("key", "date", "slope", "slope_change", "inverted")


@query("v11_event_context", f"WITH {TYPED} SELECT symbol, event_date AS date, sum(strength) AS strength, string_agg(DISTINCT event_type, ' | ' ORDER BY event_type) AS event_type FROM typed GROUP BY ALL", floats=["strength"], digits=2)
def v11(spark, sf):
    return r.event_context(typed(spark, sf).withColumnRenamed("event_date", "date"), ("strength",), ("event_type",))


@query("v12_task_inventory", f"WITH {TYPED} SELECT event_family AS task, count(*) AS rows, count(DISTINCT event_type) AS labels, count(DISTINCT source) AS families FROM typed GROUP BY ALL", dates=[])
def v12(spark, sf):
    return r.task_inventory(typed(spark, sf).select(F.col("event_family").alias("task"), F.col("event_type").alias("label"), F.col("source").alias("family")))


def _moment(p: int) -> str:
    m = lambda k: f"list_avg(list_transform(l, lambda v: (v - list_avg(l)) ** {k}))"
    return f"CASE WHEN n = 63 THEN {m(p)} / {m(2)} ** {p / 2!r}{' - 3' if p == 4 else ''} END"


# The parabola by its normal equations: sums of the value, and of it times the place and the place's square, from -10 to 10.
_sum = lambda e: f"list_sum(list_transform(range(-10, 11), lambda x: {e}))"
_s0, _s1, _s2 = _sum("p[x + 11]"), _sum("x * p[x + 11]"), _sum("x * x * p[x + 11]")
_fit = lambda x: f"((50666.0::DOUBLE * {_s0} - 770 * {_s2}) / (21 * 50666.0::DOUBLE - 770 * 770) + {x} * {_s1} / 770 + {x} * {x} * (21.0::DOUBLE * {_s2} - 770 * {_s0}) / (21 * 50666.0::DOUBLE - 770 * 770))"


@query("p25_statistical_family", f"""WITH {RET}, s AS (SELECT symbol, date, close, (r - {_guard('avg', 'r', 20)}) / nullif(CASE WHEN count(r) OVER v = 20 THEN stddev_pop(r) OVER v END, 0) AS st__z_20, list(r) OVER w AS l, count(r) OVER w AS n, list(close) OVER (PARTITION BY symbol ORDER BY date ROWS BETWEEN 21 PRECEDING AND 1 PRECEDING) AS p
  FROM r WINDOW w AS (PARTITION BY symbol ORDER BY date ROWS 62 PRECEDING), v AS (PARTITION BY symbol ORDER BY date ROWS 19 PRECEDING)),
t AS (SELECT symbol, date, close, st__z_20, {_moment(3)} AS st__skew_63, {_moment(4)} AS st__kurt_63, CASE WHEN len(p) = 21 THEN {_fit(10)} END AS st__trend_21, CASE WHEN len(p) = 21 THEN {_fit(0)} END AS st__middle_21 FROM s)
SELECT * EXCLUDE (close), close / nullif(st__trend_21, 0) - 1 AS st__dist_21 FROM t""", floats=["st__z_20", "st__skew_63", "st__kurt_63", "st__trend_21", "st__middle_21", "st__dist_21"], digits=5)  # fmt: skip
def p25(spark, sf):
    return r.statistical_family(prices(spark, sf)).select("symbol", "date", "st__z_20", "st__skew_63", "st__kurt_63", "st__trend_21", "st__middle_21", "st__dist_21")


@query("p22_rolling_beta", f"""WITH {PRICES}, m AS (SELECT *, {_guard('avg', 'close', 20)} AS m FROM prices)
SELECT symbol, date, CASE WHEN count(m) OVER w = 20 THEN covar_samp(close, m) OVER w / nullif(var_samp(m) OVER w, 0) END AS sp__beta, CASE WHEN count(m) OVER w = 20 THEN corr(close, m) OVER w END AS sp__correl FROM m WINDOW w AS (PARTITION BY symbol ORDER BY date ROWS 19 PRECEDING)""", floats=["sp__beta", "sp__correl"], digits=4)  # fmt: skip
def p22(spark, sf):
    return r.rolling_beta(prices(spark, sf)).select("symbol", "date", "sp__beta", "sp__correl")


_OF = {"YE": (1,), "QE": (1, 2)}
_hits = ", ".join(
    [f"max((side {op})::INTEGER) AS target_oracle_{n}" for n, op in (("long", "= 'long'"), ("short", "= 'short'"), ("any", "IS NOT NULL"))]
    + [f"max((side {op} AND freq = '{f}' AND k = {k})::INTEGER) AS target_oracle_{n}__{f.lower()}_{k}" for f in ("QE", "YE") for k in (1, 2) for n, op in (("long", "= 'long'"), ("short", "= 'short'"), ("any", "IS NOT NULL"))]
)
_flags = [x.split(" AS ")[1] for x in _hits.split(", ")]


@query("l17_oracle_panel", f"""WITH {PRICES}, {trade_sets('ye', YEAR, 'YE', _OF['YE'])}, {trade_sets('qe', QUARTER, 'QE', _OF['QE'])}, d AS (SELECT symbol, entry_date AS date, {_hits} FROM (SELECT * FROM ye UNION ALL SELECT * FROM qe) GROUP BY ALL)
SELECT p.symbol, p.date, {', '.join(f'coalesce({c}, 0) AS {c}' for c in _flags)} FROM prices p LEFT JOIN d USING (symbol, date)""")  # fmt: skip
def l17(spark, sf):
    p = prices(spark, sf)
    trades = labels.oracle_trades(p, freq="QE", ks=(1, 2)).unionByName(labels.oracle_trades(p, freq="YE", ks=(1,)))
    return r.oracle_panel(p.select("symbol", "date"), trades, ("QE", "YE"), (1, 2))


TRADES = f"""{CHAIN}, td AS (SELECT underlying || '_' || snapshot_date AS trade_id, underlying AS symbol, snapshot_date AS entry_date, lead(snapshot_date) OVER (PARTITION BY underlying ORDER BY snapshot_date) AS exit_date FROM (SELECT DISTINCT underlying, snapshot_date FROM chain)),
lp AS (SELECT t.trade_id, a.part, a.ask AS entry_px, coalesce(b.bid, 0) AS exit_px, coalesce(b.bid, 0) <= 0 AS worthless, CASE WHEN coalesce(b.bid, 0) <= 0 THEN -1.0 ELSE (b.bid - a.ask) / nullif(a.ask, 0) END AS realised_return FROM td t JOIN chain a ON a.underlying = t.symbol AND a.snapshot_date = t.entry_date LEFT JOIN chain b ON b.underlying = t.symbol AND b.snapshot_date = t.exit_date AND b.part = a.part WHERE t.exit_date IS NOT NULL AND a.ask > 0)"""


def daily_trades(spark, sf):
    from pyspark.sql import Window

    days = chain(spark, sf).select(F.col("underlying").alias("symbol"), F.col("snapshot_date").alias("entry_date")).distinct()
    rows = days.withColumn("exit_date", F.lead("entry_date").over(Window.partitionBy("symbol").orderBy("entry_date"))).filter("exit_date is not null")
    return rows.withColumn("trade_id", F.concat_ws("_", "symbol", "entry_date"))


_order = "row_number() OVER (PARTITION BY trade_id ORDER BY realised_return DESC NULLS LAST, part)::INT AS rank_order"
_pct = "(rank() OVER (PARTITION BY trade_id ORDER BY realised_return) + (count(*) OVER (PARTITION BY trade_id, realised_return) - 1) / 2.0::DOUBLE) / count(*) OVER (PARTITION BY trade_id) AS rank_pct"


@query("o11_option_label_panel", f"WITH {TRADES} SELECT trade_id, part, entry_px, exit_px, realised_return, worthless, {_pct}, {_order} FROM lp", floats=["entry_px", "exit_px", "realised_return", "rank_pct"], dates=[])
def o11(spark, sf):
    return r.option_label_panel(daily_trades(spark, sf), chain(spark, sf)).select("trade_id", "part", "entry_px", "exit_px", "realised_return", "worthless", "rank_pct", "rank_order")


@query("o11_o12_equity_legs", f"""WITH {TRADES}, {PRICES}, t2 AS (SELECT td.*, x.close AS px, x.close / p.close - 1 AS ret FROM td JOIN prices p ON p.symbol = td.symbol AND p.date = td.entry_date JOIN prices x ON x.symbol = td.symbol AND x.date = td.exit_date),
o AS (SELECT t.trade_id, a.part, coalesce(b.bid, 0) <= 0 OR (a.expiration <= t.exit_date AND CASE WHEN a."right" = 'CALL' THEN t.px <= a.strike ELSE t.px >= a.strike END) AS worthless, a.ask, b.bid FROM t2 t JOIN chain a ON a.underlying = t.symbol AND a.snapshot_date = t.entry_date AND a.ask > 0 LEFT JOIN chain b ON b.underlying = t.symbol AND b.snapshot_date = t.exit_date AND b.part = a.part),
l AS (SELECT trade_id, part, worthless, CASE WHEN worthless THEN -1.0 ELSE (bid - ask) / ask END AS realised_return FROM o UNION ALL SELECT trade_id, -1, false, ret FROM t2)
SELECT trade_id, part, worthless, realised_return, part = -1 AS is_equity, {_pct}, {_order} FROM l""", floats=["realised_return", "rank_pct"], dates=[])  # fmt: skip
def o12_equity(spark, sf):
    p = prices(spark, sf).select("symbol", "date", "close")
    t = daily_trades(spark, sf).join(p.withColumnsRenamed({"date": "entry_date", "close": "a"}), ["symbol", "entry_date"]).join(p.withColumnsRenamed({"date": "exit_date", "close": "underlying_exit_px"}), ["symbol", "exit_date"])
    t = t.withColumn("ret", F.col("underlying_exit_px") / F.col("a") - 1).drop("a")
    return r.option_label_panel(t, chain(spark, sf), equity=True).select("trade_id", "part", "worthless", "realised_return", "is_equity", "rank_pct", "rank_order")


@query("o11_label_statistics", f"WITH {TRADES} SELECT count(DISTINCT trade_id) AS trades, count(*) AS legs, count(*) / count(DISTINCT trade_id)::DOUBLE AS legs_a_trade, avg(realised_return) AS mean_return, avg((realised_return > 0)::DOUBLE) AS win_share, avg(worthless::DOUBLE) AS worthless_share FROM lp", floats=["legs_a_trade", "mean_return", "win_share", "worthless_share"], dates=[])
def o11_statistics(spark, sf):
    return r.label_statistics(r.option_label_panel(daily_trades(spark, sf), chain(spark, sf))).drop("median_return")


@query("o12_o16_tagged_labels", f"WITH {TRADES} SELECT task, count(*) AS n, sum(label) AS label FROM (SELECT 'return' AS task, realised_return AS label FROM lp UNION ALL SELECT 'worthless', (exit_px <= 0)::INT FROM lp) GROUP BY ALL", floats=["label"], dates=[], digits=3)
def o12(spark, sf):
    p = r.option_label_panel(daily_trades(spark, sf), chain(spark, sf))
    both = r.tagged(("return", p, F.col("realised_return")), ("worthless", p, F.col("worthless").cast("int")))
    return both.groupBy("task").agg(F.count("*").alias("n"), F.sum("label").alias("label"))


@query("o07_ranker_features", f"WITH {CHAIN} SELECT count(ask) > 0 AS ask, count(bid) > 0 AS bid, count(volume) > 0 AS volume, false AS open_interest FROM chain", dates=[])
def o07(spark, sf):
    c = chain(spark, sf).withColumn("open_interest", F.lit(None).cast("double"))
    return c.agg(*[(F.count(x) > 0).alias(x) for x in ("ask", "bid", "volume", "open_interest")])


@query("l11_l13_action_labels", f"""WITH {PRICES}, {trade_sets('ye', YEAR, 'YE', (2,))}, d AS (SELECT * FROM ye QUALIFY row_number() OVER (PARTITION BY symbol, side, entry_date ORDER BY ret DESC, exit_date, k, period, freq) = 1),
legs AS (SELECT symbol, entry_date AS date, CASE side WHEN 'long' THEN 'buy' ELSE 'short' END AS action, CASE side WHEN 'long' THEN 1 ELSE -1 END AS position FROM d UNION ALL SELECT symbol, exit_date, CASE side WHEN 'long' THEN 'sell' ELSE 'cover' END, 0 FROM d),
f AS (SELECT * FROM legs QUALIFY row_number() OVER (PARTITION BY symbol, date ORDER BY CASE action WHEN 'buy' THEN 1 WHEN 'short' THEN 2 WHEN 'sell' THEN 3 ELSE 4 END) = 1)
SELECT p.symbol, p.date, coalesce(f.action, 'hold') AS action, coalesce(f.position, 0) AS position FROM prices p LEFT JOIN f USING (symbol, date)""")  # fmt: skip
def l11(spark, sf):
    p = prices(spark, sf)
    return labels.action_labels(p.select("symbol", "date"), labels.dedupe_trades(labels.oracle_trades(p, ks=(2,)), "entry_date"))


MATRIX = "matrix AS (SELECT l_returnflag AS family, l_linestatus || l_returnflag AS feature, 'supplier_' || (l_suppkey % 3) AS target, avg(l_extendedprice) AS std_diff FROM lineitem GROUP BY ALL)"


def matrix(sf, spark):
    li = spark.read.parquet(f"{sf}/lineitem.parquet")
    return li.groupBy(F.col("l_returnflag").alias("family"), F.concat("l_linestatus", "l_returnflag").alias("feature"), F.concat(F.lit("supplier_"), F.col("l_suppkey") % 3).alias("target")).agg(F.avg("l_extendedprice").alias("std_diff"))


@query("v22_matrix_pivot", f"WITH {MATRIX} SELECT target, max(std_diff) FILTER (family = 'A') AS a, max(std_diff) FILTER (family = 'N') AS n, max(std_diff) FILTER (family = 'R') AS r FROM matrix GROUP BY ALL", floats=["a", "n", "r"], dates=[], digits=3)
def v22(spark, sf):
    return r.matrix_pivot(matrix(sf, spark), ("A", "N", "R")).withColumnsRenamed({"A": "a", "N": "n", "R": "r"})


@query("v22_best_by_target", f"WITH {MATRIX} SELECT target, feature, std_diff, row_number() OVER (PARTITION BY target ORDER BY std_diff DESC, feature)::INT AS rank FROM matrix QUALIFY rank <= 3", floats=["std_diff"], dates=[], digits=3)
def v22b(spark, sf):
    return r.best_by_target(matrix(sf, spark)).select("target", "feature", "std_diff", "rank")


@query("s35_needs_update", f"WITH {PRICES} SELECT symbol, max(date) < DATE '2001-10-20' AS needs_update, CASE WHEN max(date) < DATE '2001-10-20' THEN 'stale_max_date' ELSE 'fresh' END AS update_reason FROM prices GROUP BY ALL", dates=[])
def s35(spark, sf):
    states = upsert.coverage(prices(spark, sf), ["symbol"]).withColumn("last_fetched", F.lit(None).cast("timestamp"))
    return planning.price_needs_update(states, F.lit("2001-10-20").cast("date"), F.current_timestamp()).select("symbol", "needs_update", "update_reason")
