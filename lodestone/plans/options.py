"""Queries of option features and labels."""

from __future__ import annotations

from pyspark.sql import functions as F

from lodestone.operators import options as o
from lodestone.plans.registry import query
from lodestone.views import CHAIN, PRICES, chain, prices

SPOT = f"""{CHAIN}, {PRICES}, q AS (SELECT c.*, lower("right") AS option_type, p.close AS spot, (bid + ask) / 2 AS mid, cast(expiration - snapshot_date AS INTEGER) AS dte FROM chain c JOIN prices p ON c.underlying = p.symbol AND c.snapshot_date = p.date)"""


def quotes(spark, sf):
    p = prices(spark, sf).select(F.col("symbol").alias("underlying"), F.col("date").alias("snapshot_date"), F.col("close").alias("spot"))
    rows = chain(spark, sf).join(p, ["underlying", "snapshot_date"]).withColumn("option_type", F.lower("right")).drop("right")
    return rows.withColumns({"mid": (F.col("bid") + F.col("ask")) / 2, "dte": F.datediff("expiration", "snapshot_date")})


KEY = ("underlying", "snapshot_date", "part")


@query("o01_static", f"WITH {SPOT} SELECT underlying, snapshot_date, part, dte, abs(dte - 45) AS dte_gap, strike / nullif(spot, 0) - 1 AS moneyness, abs(strike / nullif(spot, 0) - 1) AS abs_moneyness FROM q", floats=["moneyness", "abs_moneyness"], dates=["snapshot_date"])
def o01(spark, sf):
    return o.static_features(quotes(spark, sf)).select(*KEY, "dte", "dte_gap", "moneyness", "abs_moneyness")


@query("o02_liquidity", f"WITH {SPOT} SELECT underlying, snapshot_date, part, ask - bid AS spread, (ask - bid) / nullif((bid + ask) / 2, 0) AS spread_pct, volume AS liquidity_score FROM q", floats=["spread", "spread_pct"], dates=["snapshot_date"])
def o02(spark, sf):
    return o.liquidity(quotes(spark, sf).withColumn("open_interest", F.lit(None).cast("double"))).select(*KEY, "spread", "spread_pct", "liquidity_score")


@query("o03_o04_o05_implied_greeks", dates=["snapshot_date"])
def o03(spark, sf):
    """At the mid price scaled to a tenth of spot, so that most quotes lie within the no-arbitrage bounds."""
    rows = quotes(spark, sf).withColumns({"strike": F.col("spot") * (0.9 + F.col("part") % 20 / 100), "mid": F.col("spot") * (0.11 + F.col("part") % 7 / 100)})
    return o.greek_ratios(o.with_greeks(rows, 0.01)).select(*KEY, "iv", "iv_source", *o.GREEKS, "theta_to_mid", "vega_to_mid")


@query("o06_surface", f"WITH {SPOT}, v AS (SELECT *, volume / 64 AS iv FROM q) SELECT underlying, snapshot_date, part, (iv - avg(iv) OVER w) / nullif(CASE WHEN count(*) OVER w > 1 THEN stddev_samp(iv) OVER w END, 0) AS iv_z, iv * sqrt(dte / 365.0::DOUBLE) AS iv_term FROM v WINDOW w AS (PARTITION BY snapshot_date, underlying, option_type, expiration)", floats=["iv_z", "iv_term"], dates=["snapshot_date"], digits=4)
def o06(spark, sf):
    rows = quotes(spark, sf).withColumn("iv", F.col("volume") / 64)
    return o.surface(rows).select(*KEY, "iv_z", "iv_term")


CAND = f"""{CHAIN}, cand AS (SELECT underlying, snapshot_date AS date, part, ask AS entry_price, lead(bid) OVER (PARTITION BY underlying ORDER BY snapshot_date, part) AS exit_price FROM chain),
r AS (SELECT *, (exit_price - entry_price) / nullif(entry_price, 0) AS realised_return FROM cand)"""


def candidates(spark, sf):
    from pyspark.sql import Window

    c = chain(spark, sf).select("underlying", F.col("snapshot_date").alias("date"), "part", F.col("ask").alias("entry_price"), F.lead("bid").over(Window.partitionBy("underlying").orderBy("snapshot_date", "part")).alias("exit_price"))
    return o.returns(c)


@query("o08_best_return", f"WITH {CAND}, k AS (SELECT *, row_number() OVER (PARTITION BY underlying, date ORDER BY realised_return DESC NULLS LAST, part) AS k FROM r) SELECT underlying, date, part, realised_return FROM k WHERE k = 1 AND realised_return IS NOT NULL", floats=["realised_return"])
def o08(spark, sf):
    return o.best_return(candidates(spark, sf), "underlying", "date", tie="part").select("underlying", "date", "part", "realised_return")


RANK = f"""{CAND}, rk AS (SELECT *, CASE WHEN realised_return IS NOT NULL THEN rank() OVER (PARTITION BY underlying, date, realised_return IS NULL ORDER BY realised_return DESC) + (count(*) OVER (PARTITION BY underlying, date, realised_return) - 1) / 2.0::DOUBLE END AS rank,
CASE WHEN realised_return IS NOT NULL THEN rank() OVER (PARTITION BY underlying, date, realised_return IS NULL ORDER BY realised_return) + (count(*) OVER (PARTITION BY underlying, date, realised_return) - 1) / 2.0::DOUBLE END / count(*) OVER (PARTITION BY underlying, date, realised_return IS NULL) AS rank_pct FROM r)"""


@query("o09_return_rank", f"WITH {RANK} SELECT underlying, date, part, rank, rank_pct FROM rk", floats=["rank", "rank_pct"])
def o09(spark, sf):
    return o.return_rank(candidates(spark, sf), "underlying", "date").select("underlying", "date", "part", "rank", "rank_pct")


SCORES = f"""{CAND}, s AS (SELECT underlying, date, part, realised_return - 0.1 * (entry_price / 1000) AS score FROM r WHERE realised_return IS NOT NULL),
p0 AS (SELECT *, CASE WHEN max(score) OVER g > 0 THEN greatest(score, 0) ELSE (row_number() OVER (PARTITION BY underlying, date ORDER BY score DESC, part) = 1)::INT::DOUBLE END AS p FROM s WINDOW g AS (PARTITION BY underlying, date)),
p1 AS (SELECT * REPLACE (p / sum(p) OVER (PARTITION BY underlying, date) AS p), count(*) OVER (PARTITION BY underlying, date) AS n, row_number() OVER (PARTITION BY underlying, date ORDER BY score DESC, part)::INT AS score_rank FROM p0)"""


def scored(spark, sf):
    return candidates(spark, sf).filter("realised_return is not null").withColumns({"expected_return": F.col("realised_return"), "risk": F.col("entry_price") / 1000})


@query("o10_score_weights", f"WITH {SCORES} SELECT underlying, date, part, score, score_rank, p AS weight FROM p1", floats=["score", "weight"])
def o10(spark, sf):
    return o.score_weights(scored(spark, sf), "underlying", "date", aversion=0.1, tie="part").select("underlying", "date", "part", "score", "score_rank", "weight")


# SQL tries every count of capped rows of a group and takes the least that leaves the others at the cap or below; groups are a supplier's quarter.
_CAPPED = """{scores}, q AS (SELECT underlying, date_trunc('quarter', date)::DATE AS quarter, date, part, realised_return - 0.1 * (entry_price / 1000) AS score FROM r WHERE realised_return IS NOT NULL),
q1 AS (SELECT *, row_number() OVER w AS i, count(*) OVER g AS n, max(score) OVER g AS top FROM q WINDOW g AS (PARTITION BY underlying, quarter), w AS (PARTITION BY underlying, quarter ORDER BY score DESC, date, part)),
q2 AS (SELECT *, CASE WHEN top > 0 THEN greatest(score, 0) ELSE (i = 1)::INT::DOUBLE END AS raw FROM q1), q3 AS (SELECT *, raw / sum(raw) OVER (PARTITION BY underlying, quarter) AS p, count(*) FILTER (raw > 0) OVER (PARTITION BY underlying, quarter) AS many FROM q2),
k AS (SELECT a.underlying, a.quarter, a.i - 1 AS capped, (1 - (a.i - 1) * {cap}) / sum(b.p) AS scale, max(b.p) AS most FROM q3 a JOIN q3 b ON a.underlying = b.underlying AND a.quarter = b.quarter AND b.i >= a.i AND b.p > 0 GROUP BY a.underlying, a.quarter, a.i),
m AS (SELECT underlying, quarter, arg_min(scale, capped) AS scale FROM k WHERE scale * most <= {cap} * (1 + 1e-12) AND scale > 0 GROUP BY ALL)
SELECT q3.underlying, q3.date, q3.part, CASE WHEN {cap} * n < 1 THEN 1.0 / n WHEN p > 0 AND {cap} * many <= 1 THEN {cap} WHEN {cap} * many < 1 THEN (1 - {cap} * many) / (n - many) WHEN p <= 0 THEN 0 ELSE least({cap}, coalesce(scale, {cap}) * p) END::DOUBLE AS weight FROM q3 LEFT JOIN m USING (underlying, quarter)"""


def capped(spark, sf, cap):
    rows = scored(spark, sf).withColumns({"quarter": F.date_trunc("quarter", "date").cast("date"), "place": F.struct("date", "part")})
    return o.score_weights(rows, "underlying", "quarter", aversion=0.1, cap=cap, tie="place").select("underlying", "date", "part", "weight")


@query("o10_capped_weights", f"WITH {_CAPPED.format(scores=CAND, cap='0.12::DOUBLE')}", floats=["weight"])
def o10_capped(spark, sf):
    return capped(spark, sf, 0.12)


@query("o10_capped_weights_tight", f"WITH {_CAPPED.format(scores=CAND, cap='0.05::DOUBLE')}", floats=["weight"])
def o10_tight(spark, sf):
    return capped(spark, sf, 0.05)


# The distribution in SQL by its series, sixty terms: independent of the operator's rational approximation.
_PHI = "(0.5 + exp(-(({x}) ** 2) / 2) / sqrt(2 * pi()) * ({x}) * list_sum(list_transform(range(0, 60), lambda k: exp(k * ln(greatest(({x}) ** 2, 1e-300)) - coalesce(list_sum(list_transform(range(1, k + 1), lambda j: ln(2.0::DOUBLE * j + 1))), 0)))))"
PRICED = f"""{SPOT}, g AS (SELECT underlying, snapshot_date, part, option_type = 'call' AS is_call, spot * (0.9 + part % 20 / 100.0::DOUBLE) AS strike, spot, (20 + part % 90) / 365.0::DOUBLE AS years, 0.2 + part % 17 / 40.0::DOUBLE AS vol FROM q WHERE spot > 0),
d AS (SELECT *, (ln(spot / strike) + (0.01 + vol ** 2 / 2) * years) / (vol * sqrt(years)) AS d1, (ln(spot / strike) + (0.01 - vol ** 2 / 2) * years) / (vol * sqrt(years)) AS d2, exp(-0.01 * years) AS disc FROM g),
n AS (SELECT *, {_PHI.format(x='d1')} AS n1, {_PHI.format(x='d2')} AS n2, exp(-(d1 ** 2) / 2) / sqrt(2 * pi()) AS phi FROM d)"""


def priced(spark, sf):
    """Quotes of made-up strikes, times and volatilities near the day's price, and the price that follows from them."""
    rows = quotes(spark, sf).filter("spot > 0").withColumns({"strike": F.col("spot") * (0.9 + F.col("part") % 20 / 100), "dte": (20 + F.col("part") % 90).cast("int"), "vol": 0.2 + F.col("part") % 17 / 40})
    return o.add_price(rows, F.col("option_type") == "call", F.col("spot"), F.col("strike"), F.col("dte") / 365, 0.01, F.col("vol"), name="mid")


@query("o03_implied_volatility", f"WITH {PRICED} SELECT underlying, snapshot_date, part, CASE WHEN is_call THEN spot * n1 - strike * disc * n2 ELSE strike * disc * (1 - n2) - spot * (1 - n1) END AS mid, vol AS iv, 'implied' AS iv_source FROM n", floats=["mid", "iv"], dates=["snapshot_date"], digits=5)
def o03_known(spark, sf):
    """The volatility found from a price is the one that the price was made from."""
    return o.with_greeks(priced(spark, sf), 0.01).select(*KEY, "mid", "iv", "iv_source")


@query("o04_o05_greeks", f"""WITH {PRICED} SELECT underlying, snapshot_date, part, CASE WHEN is_call THEN n1 ELSE n1 - 1 END AS delta, phi / (spot * vol * sqrt(years)) AS gamma,
(-spot * phi * vol / (2 * sqrt(years)) - 0.01 * strike * disc * CASE WHEN is_call THEN n2 ELSE n2 - 1 END) / 365 AS theta, spot * phi * sqrt(years) AS vega, strike * years * disc * CASE WHEN is_call THEN n2 ELSE n2 - 1 END AS rho, abs(CASE WHEN is_call THEN n1 ELSE n1 - 1 END) AS abs_delta FROM n""", floats=[*o.GREEKS, "abs_delta"], dates=["snapshot_date"])  # fmt: skip
def o04(spark, sf):
    """Greeks of a given volatility; vega and rho also of those without one stay null."""
    rows = priced(spark, sf).withColumn("iv", F.col("vol"))
    return o.greek_ratios(o.with_greeks(rows, 0.01)).select(*KEY, *o.GREEKS, "abs_delta")


@query("o15_hybrid_mu", f"WITH {RANK} SELECT underlying, date, part, 0.5 * rank_pct + 0.5 * coalesce((realised_return - min(realised_return) OVER w) / nullif(max(realised_return) OVER w - min(realised_return) OVER w, 0), 0) AS hybrid_mu FROM rk WINDOW w AS (PARTITION BY underlying, date)", floats=["hybrid_mu"])
def o15(spark, sf):
    return o.hybrid_mu(o.return_rank(candidates(spark, sf), "underlying", "date"), "underlying", "date").select("underlying", "date", "part", "hybrid_mu")


@query("o13_o14_trade_weights")
def o14(spark, sf):
    """Each supplier's quarter as one trade, over the contracts quoted in it."""
    q = chain(spark, sf).select(F.concat_ws("_", "underlying", F.date_trunc("quarter", "snapshot_date").cast("date")).alias("trade_id"), F.col("part").alias("contract"), F.col("snapshot_date").alias("date"), F.col("bid").alias("price"))
    return o.trade_weights(q)


@query("o17_snapshot_access", f"WITH {CHAIN}, d AS (SELECT DISTINCT snapshot_date FROM chain WHERE underlying = 'S1' AND isodow(snapshot_date) < 6) SELECT underlying, snapshot_date, count(*) AS n FROM chain WHERE snapshot_date IN (SELECT snapshot_date FROM d) GROUP BY ALL", dates=["snapshot_date"])
def o17(spark, sf):
    c = chain(spark, sf)
    days = c.filter("underlying = 'S1'").filter(F.weekday("snapshot_date") < 5).select("snapshot_date").distinct()
    return c.join(days, "snapshot_date", "left_semi").groupBy("underlying", "snapshot_date").agg(F.count("*").alias("n"))
