"""Queries of evaluation and research aggregates."""

from __future__ import annotations

from pyspark.sql import functions as F

from lodestone.operators import evaluate as v, labels
from lodestone.operators.compare import TaskSpec
from lodestone.operators.technical import returns
from lodestone.plans.events import PANEL, panel
from lodestone.plans.registry import query
from lodestone.views import MACRO, PRICES, macro, prices

SCORES = f"""{PRICES}, sc AS (SELECT symbol, date, 'fam_a__mom' AS feature, close / lag(close, 5) OVER (PARTITION BY symbol ORDER BY date) - 1 AS score FROM prices UNION ALL SELECT symbol, date, 'fam_b__vol', volume FROM prices),
s0 AS (SELECT * FROM sc WHERE score IS NOT NULL),
t0 AS (SELECT * FROM (SELECT symbol, date, 5 AS horizon, lead(close, 5) OVER (PARTITION BY symbol ORDER BY date) / close - 1 AS target_value FROM prices UNION ALL SELECT symbol, date, 20, lead(close, 20) OVER (PARTITION BY symbol ORDER BY date) / close - 1 FROM prices) WHERE target_value IS NOT NULL)"""
IC = f"""{SCORES}, x AS (SELECT *, row_number() OVER (PARTITION BY date, feature ORDER BY score, symbol) - (count(*) OVER (PARTITION BY date, feature) + 1) / 2.0::DOUBLE AS x FROM s0),
y0 AS (SELECT *, row_number() OVER (PARTITION BY date, horizon ORDER BY target_value, symbol) - (count(*) OVER (PARTITION BY date, horizon) + 1) / 2.0::DOUBLE AS y FROM t0),
y AS (SELECT *, sum(y * y) OVER (PARTITION BY date, horizon) AS norm FROM y0),
ic AS (SELECT feature, horizon, date, count(*) AS pairs, CASE WHEN count(*) >= 3 THEN sum(x * y) / nullif(sqrt(sum(x * x) * any_value(norm)), 0) END AS ic FROM x JOIN y USING (symbol, date) GROUP BY ALL)"""


def scores(spark, sf):
    p = prices(spark, sf)
    f = returns(p, (5,)).select("symbol", "date", F.col("px__ret_5d").alias("fam_a__mom"), F.col("volume").alias("fam_b__vol"))
    return v.long_features(f, ("fam_a__mom", "fam_b__vol"))


def targets(spark, sf):
    return labels.forward_returns(prices(spark, sf), (5, 20))


@query("v01_daily_rank_ic", f"WITH {IC} SELECT feature, horizon, date, pairs, ic FROM ic", floats=["ic"], digits=5)
def v01(spark, sf):
    return v.daily_ic(scores(spark, sf), targets(spark, sf)).select("feature", "horizon", "date", "pairs", "ic")


@query("v02_quintile_spread", f"""WITH {SCORES}, b AS (SELECT * FROM s0 JOIN t0 USING (symbol, date)), q AS (SELECT feature, horizon, date, quantile_cont(score, 0.2) AS lo, quantile_cont(score, 0.8) AS hi FROM b GROUP BY ALL HAVING count(*) >= 5)
SELECT feature, horizon, date, (avg(target_value) FILTER (score >= hi) - avg(target_value) FILTER (score <= lo)) * 10000 AS spread_bps FROM b JOIN q USING (feature, horizon, date) GROUP BY ALL""", floats=["spread_bps"], digits=3)  # fmt: skip
def v02(spark, sf):
    return v.quintile_spread(scores(spark, sf), targets(spark, sf), least=5)


RESULTS = f"{IC}, res AS (SELECT feature, horizon, avg(ic) AS mean_ic, median(ic) AS median_ic, avg(coalesce((ic > 0)::DOUBLE, 0)) AS hit_rate, cast(sum(pairs) AS BIGINT) AS observations, count(*) AS days FROM ic GROUP BY ALL HAVING sum(pairs) >= 120)"


@query("v03_feature_results", f"WITH {RESULTS} SELECT * FROM res", floats=["mean_ic", "median_ic", "hit_rate"], digits=5, dates=[])
def v03(spark, sf):
    return v.feature_results(v.daily_ic(scores(spark, sf), targets(spark, sf)))


@query("v04_family_summary", f"""WITH {RESULTS}, g AS (SELECT horizon, split_part(feature, '__', 1) AS family, count(*) AS features, avg(mean_ic) AS mean_ic, median(mean_ic) AS median_ic, avg((mean_ic > 0)::DOUBLE) AS positive_share FROM res GROUP BY ALL)
SELECT *, row_number() OVER (PARTITION BY horizon ORDER BY abs(mean_ic) DESC, family)::INT AS rank FROM g""", floats=["mean_ic", "median_ic", "positive_share"], digits=5, dates=[])  # fmt: skip
def v04(spark, sf):
    return v.family_summary(v.feature_results(v.daily_ic(scores(spark, sf), targets(spark, sf))), F.split_part("feature", F.lit("__"), F.lit(1)))


@query("v05_top_bottom_spread", f"""WITH {SCORES}, b AS (SELECT *, row_number() OVER (PARTITION BY feature, horizon, date ORDER BY score DESC, symbol) AS up, row_number() OVER (PARTITION BY feature, horizon, date ORDER BY score, symbol) AS down,
CASE WHEN count(*) OVER (PARTITION BY feature, horizon, date) < 4 THEN 1 ELSE 2 END AS n FROM s0 JOIN t0 USING (symbol, date)) SELECT feature, horizon, date, avg(target_value) FILTER (up <= n) - avg(target_value) FILTER (down <= n) AS spread FROM b GROUP BY ALL""", floats=["spread"])  # fmt: skip
def v05(spark, sf):
    return v.top_bottom_spread(scores(spark, sf), targets(spark, sf))


@query("v06_pooled_correlation", f"WITH {SCORES} SELECT feature, horizon, corr(score, target_value) AS pearson, count(*) AS n FROM s0 JOIN t0 USING (symbol, date) GROUP BY ALL", floats=["pearson"], digits=5, dates=[])
def v06(spark, sf):
    both = scores(spark, sf).join(targets(spark, sf).filter("target_value is not null"), ["symbol", "date"])
    return both.groupBy("feature", "horizon").agg(F.corr("score", "target_value").alias("pearson"), F.count("*").alias("n"))


_TASKS = (TaskSpec("insider_side", "target_event_on__insider_buy", "target_event_on__insider_sell"), TaskSpec("insider_buy_or_large", "target_event_on__insider_buy", "large"))
_two = lambda c: f"CASE WHEN round_even({c}, 2) = 0 THEN '0.00' ELSE printf('%.2f', round_even({c}, 2)) END"


@query("v10_text_rows", f"""WITH {PANEL}, r AS (SELECT symbol, date, close / lag(close) OVER (PARTITION BY symbol ORDER BY date) - 1 AS ret, volume, (volume > 45)::INT AS large FROM prices), j AS (SELECT * FROM panel JOIN r USING (symbol, date)),
t AS (SELECT symbol, date, ret, volume, 'insider_side' AS task, target_event_on__insider_buy AS p, target_event_on__insider_sell AS n FROM j UNION ALL SELECT symbol, date, ret, volume, 'insider_buy_or_large', target_event_on__insider_buy, large FROM j),
k AS (SELECT *, (p > 0)::INT AS label FROM t WHERE (p > 0) <> (n > 0))
SELECT symbol, date, task, label, 'px' AS family, concat_ws(' ', 'source=prices', 'feature_family=px', 'ret_1d=' || {_two('ret')}, 'tot_volume=' || {_two('volume')}) AS text FROM k
UNION ALL SELECT symbol, date, task, label, 'own', concat_ws(' ', 'source=prices', 'feature_family=own', 'ret_1d=' || {_two('ret')}) FROM k WHERE ret IS NOT NULL AND task = 'insider_side'""")  # fmt: skip
def v10(spark, sf):
    """Two tasks, of which days with both sides are left out, and two families, of which one needs all its columns and is asked for by one task."""
    f = returns(prices(spark, sf), (1,)).select("symbol", "date", F.col("px__ret_1d").alias("px__ret_1d"), F.col("volume").alias("total_volume"), (F.col("volume") > 45).cast("int").alias("large"))
    rows = panel(spark, sf).join(f, ["symbol", "date"])
    px = v.text_rows(rows, {"px": ["px__ret_1d", "total_volume", "no_such_column"]}, _TASKS, "prices")
    own = v.text_rows(rows.withColumnRenamed("px__ret_1d", "own__ret_1d"), {"own": ["own__ret_1d", "date"]}, _TASKS, "prices", least_coverage=1.0, allowed={"insider_side": {"own"}})
    return px.unionByName(own)


@query("l19_feature_target_matrix", f"""WITH {PANEL}, f AS (SELECT symbol, date, 'volume' AS feature, volume AS x FROM prices UNION ALL SELECT symbol, date, 'mom', close / lag(close, 5) OVER (PARTITION BY symbol ORDER BY date) - 1 FROM prices),
t AS (SELECT symbol, date, 'target_event_on__insider_buy' AS target, target_event_on__insider_buy AS y FROM panel), m AS (SELECT feature, target, count(x) AS rows, count(x) / count(*)::DOUBLE AS coverage, count(x) FILTER (y > 0) AS positives,
avg(x) FILTER (y > 0) AS m1, avg(x) FILTER (y = 0) AS m0, var_samp(x) FILTER (y > 0) AS v1, var_samp(x) FILTER (y = 0) AS v0 FROM f JOIN t USING (symbol, date) GROUP BY ALL)
SELECT feature, target, rows, coverage, positives, abs((m1 - m0) / nullif(sqrt((v1 + v0) / 2), 0)) AS std_diff FROM m""", floats=["coverage", "std_diff"], dates=[])  # fmt: skip
def l19(spark, sf):
    f = returns(prices(spark, sf), (5,)).select("symbol", "date", F.col("px__ret_5d").alias("mom"), "volume")
    return v.feature_target_matrix(f, panel(spark, sf), ("mom", "volume"), ("target_event_on__insider_buy",))


RET = f"{PRICES}, r AS (SELECT symbol, date, close, close / lag(close) OVER (PARTITION BY symbol ORDER BY date) - 1 AS r FROM prices)"


@query("v13_price_summary", f"""WITH {RET}, e AS (SELECT *, exp(sum(ln(1 + coalesce(r, 0))) OVER (PARTITION BY symbol ORDER BY date ROWS UNBOUNDED PRECEDING)) AS q FROM r), d AS (SELECT *, q / max(q) OVER (PARTITION BY symbol ORDER BY date ROWS UNBOUNDED PRECEDING) - 1 AS dd FROM e),
g AS (SELECT symbol, arg_max(close, date) / arg_min(close, date) AS g, count(r) AS n, stddev_samp(r) * sqrt(252) AS annual_vol, min(dd) AS max_drawdown, max(r) AS best_day, min(r) AS worst_day FROM d GROUP BY ALL)
SELECT symbol, g - 1 AS total_return, g ** (252.0::DOUBLE / n) - 1 AS annual_return, annual_vol, max_drawdown, best_day, worst_day, (g ** (252.0::DOUBLE / n) - 1) / nullif(annual_vol, 0) AS sharpe FROM g""", floats=["total_return", "annual_return", "annual_vol", "max_drawdown", "best_day", "worst_day", "sharpe"], dates=[])  # fmt: skip
def v13(spark, sf):
    return v.price_summary(prices(spark, sf))


_q = [(k, p) for k in "qa" for p in (1, 5, 50, 95, 99)]


@query("v14_tail_quantiles", f"WITH {RET} SELECT symbol, {', '.join(f'quantile_cont({"r" if k == "q" else "abs(r)"}, {p / 100}) AS {k}{p}' for k, p in _q)} FROM r GROUP BY ALL", floats=[f"{k}{p}" for k, p in _q], dates=[])
def v14(spark, sf):
    return v.tail_quantiles(returns(prices(spark, sf), (1,)), "px__ret_1d", "symbol")


@query("v15_benchmark_stats", f"""WITH {RET}, m AS (SELECT date, avg(r) AS r_m FROM r GROUP BY ALL), j AS (SELECT *, r - r_m AS active FROM r JOIN m USING (date) WHERE r IS NOT NULL AND r_m IS NOT NULL)
SELECT symbol, covar_samp(r, r_m) / nullif(var_samp(r_m), 0) AS beta, corr(r, r_m) AS correlation, stddev_samp(active) * sqrt(252) AS tracking, avg(active) * 252 AS active_return, avg(active) * 252 / nullif(stddev_samp(active) * sqrt(252), 0) AS information_ratio FROM j GROUP BY ALL""", floats=["beta", "correlation", "tracking", "active_return", "information_ratio"], dates=[], digits=5)  # fmt: skip
def v15(spark, sf):
    r = returns(prices(spark, sf), (1,)).select("symbol", "date", F.col("px__ret_1d").alias("r"))
    return v.benchmark_stats(r, r.groupBy("date").agg(F.avg("r").alias("r_m")))


@query("v19_macro_changes", f"WITH {MACRO} SELECT series_code, date, value, value - lag(value) OVER w AS diff, value / nullif(lag(value) OVER w, 0) - 1 AS pct FROM macro WINDOW w AS (PARTITION BY series_code ORDER BY date)", floats=["value", "diff", "pct"], digits=4)
def v19(spark, sf):
    return v.macro_changes(macro(spark, sf))


@query("v09_coverage_mask", f"WITH {RET} SELECT symbol, date, ((r IS NOT NULL)::INT + (close IS NOT NULL)::INT) / 2.0::DOUBLE >= 0.75 AS covered FROM r")
def v09(spark, sf):
    r = returns(prices(spark, sf), (1,))
    share = (F.col("px__ret_1d").isNotNull().cast("int") + F.col("close").isNotNull().cast("int")) / 2
    return r.select("symbol", "date", (share >= 0.75).alias("covered"))
