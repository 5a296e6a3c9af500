"""Queries of event pairs and event targets."""

from __future__ import annotations

from pyspark.sql import functions as F

from lodestone.operators import asof, builders as b, events as e
from lodestone.plans.registry import query
from lodestone.views import EVENTS, PRICES, prices, raw_events

TYPED = f"""{EVENTS}, typed AS (SELECT symbol, event_date, reported_date, cast(reported_date - event_date AS INTEGER) AS disclosure_lag_days, 'insider' AS event_family,
CASE WHEN contains(lower(transaction), 'purchase') THEN 'insider_buy' ELSE 'insider_sell' END AS event_type, CASE WHEN contains(lower(transaction), 'purchase') THEN 'insider_sell' ELSE 'insider_buy' END AS mirror_type,
CASE WHEN contains(lower(transaction), 'purchase') THEN 1 ELSE -1 END AS side, actor, 'orders' AS source, value AS strength FROM raw_events WHERE transaction <> 'M-Exempt')"""


def typed(spark, sf):
    rows = raw_events(spark, sf).withColumns({"event_family": F.lit("insider"), "event_type": e.trade_type(F.col("transaction"), "insider"), "source": F.lit("orders"), "strength": F.col("value")})
    return e.normalize_events(rows)


@query("e01_e02_e09_typed_events", f"WITH {TYPED} SELECT * FROM typed", dates=["event_date", "reported_date"])
def e01(spark, sf):
    return typed(spark, sf)


@query("e03_ratings", "SELECT o_orderkey, CASE WHEN contains(lower(o_orderpriority), 'urgent') THEN 5 WHEN contains(lower(o_orderpriority), 'medium') THEN 4 WHEN contains(lower(o_orderpriority), 'low') THEN 3 END AS score FROM orders", dates=[])
def e03(spark, sf):
    from lodestone.views import table

    text = F.regexp_replace(F.regexp_replace(F.regexp_replace(F.lower("o_orderpriority"), "urgent", "strong buy"), "medium", "hold"), "low", "underweight")
    return table(spark, sf, "orders").select("o_orderkey", e.rating_score(text).alias("score"))


@query("e04_e07_dividend_changes", f"""WITH {EVENTS}, d AS (SELECT symbol, event_date, max(shares) AS amount FROM raw_events GROUP BY ALL), l AS (SELECT *, lag(amount) OVER (PARTITION BY symbol ORDER BY event_date) AS b FROM d)
SELECT symbol, event_date, amount, CASE WHEN amount > b THEN 'dividend_increase' ELSE 'dividend_cut' END AS event_type FROM l WHERE amount <> b""", dates=["event_date"])  # fmt: skip
def e04(spark, sf):
    return e.dividend_changes(raw_events(spark, sf).groupBy("symbol", "event_date").agg(F.max("shares").alias("amount")))


@query("e08_role_buckets", f"""WITH {EVENTS}, r AS (SELECT *, lower(trim(role)) AS t FROM raw_events) SELECT role, CASE WHEN t = '' THEN NULL WHEN regexp_matches(t, 'chief executive|\\bceo\\b') THEN 'ceo' WHEN regexp_matches(t, 'chief financial|\\bcfo\\b') THEN 'cfo' WHEN contains(t, 'director') THEN 'director' WHEN contains(t, 'president') THEN 'president'
WHEN contains(t, 'officer') THEN 'officer' WHEN regexp_matches(t, '10%|ten percent|beneficial owner') THEN 'large_holder' WHEN t IS NOT NULL THEN 'other_insider' END AS bucket, count(*) AS n FROM r GROUP BY ALL""", dates=[])  # fmt: skip
def e08(spark, sf):
    return raw_events(spark, sf).groupBy("role", b.bucket(F.col("role"), b.ROLES).alias("bucket")).agg(F.count("*").alias("n"))


@query("e10_fill_families", f"WITH {TYPED}, c AS (SELECT * FROM typed WHERE symbol <> 'S3'), b AS (SELECT * REPLACE (value AS strength) FROM (SELECT typed.*, strength * 2 AS value FROM typed)) SELECT symbol, event_type, count(*) AS n, sum(strength) AS strength FROM (SELECT symbol, event_type, strength FROM c UNION ALL SELECT symbol, event_type, strength FROM b WHERE symbol NOT IN (SELECT symbol FROM c)) GROUP BY ALL", floats=["strength"], digits=2, dates=[])
def e10(spark, sf):
    t = typed(spark, sf)
    rows = e.fill_missing_families(t.filter("symbol <> 'S3'"), t.withColumn("strength", F.col("strength") * 2))
    return rows.groupBy("symbol", "event_type").agg(F.count("*").alias("n"), F.sum("strength").alias("strength"))


@query("s16_event_upsert", f"WITH {TYPED} SELECT symbol, event_date, event_type, actor, strength, count(*) AS n FROM (SELECT DISTINCT symbol, event_date, event_family, event_type, actor, source, strength FROM typed) GROUP BY ALL", dates=["event_date"])
def s16(spark, sf):
    t = typed(spark, sf)
    return e.merge_events(t, t.filter("side > 0")).groupBy("symbol", "event_date", "event_type", "actor", "strength").agg(F.count("*").alias("n"))


STUDY = f"""{PRICES}, m AS (SELECT date, avg(close) AS level FROM prices GROUP BY ALL), {TYPED.replace(EVENTS + ',', EVENTS + ',')},
p AS (SELECT symbol, date, lead(close, 20) OVER w / close - lead(level, 20) OVER w / level AS a20, lead(close, 60) OVER w / close - lead(level, 60) OVER w / level AS a60 FROM prices JOIN m USING (date) WINDOW w AS (PARTITION BY symbol ORDER BY date)),
j AS (SELECT t.event_type, t.side, t.event_date, p.date, a20, a60 FROM typed t ASOF JOIN p ON t.symbol = p.symbol AND t.event_date <= p.date),
v AS (SELECT event_type, 20 AS horizon, side * a20 AS value FROM j WHERE date - event_date <= 7 UNION ALL SELECT event_type, 60, side * a60 FROM j WHERE date - event_date <= 7),
q AS (SELECT event_type, horizon, quantile_cont(value, 0.01) AS lo, quantile_cont(value, 0.99) AS hi FROM v WHERE value IS NOT NULL GROUP BY ALL)"""


@query("e11_event_study", f"WITH {STUDY} SELECT event_type, horizon, count(*) AS n, avg(least(greatest(value, lo), hi)) AS mean, median(value) AS median, avg((value > 0)::DOUBLE) AS hit_rate FROM v JOIN q USING (event_type, horizon) WHERE value IS NOT NULL GROUP BY ALL", floats=["mean", "median", "hit_rate"], dates=[])
def e11(spark, sf):
    p = prices(spark, sf)
    return e.event_study(typed(spark, sf), p, p.groupBy("date").agg(F.avg("close").alias("level")), horizons=(20, 60))


PANEL = f"""{PRICES}, {TYPED}, al AS (SELECT DISTINCT symbol, date, event_type FROM (SELECT t.symbol, t.event_type, t.event_date, p.date FROM typed t ASOF JOIN prices p ON t.symbol = p.symbol AND t.event_date <= p.date) WHERE date - event_date <= 7),
panel AS (SELECT p.symbol, p.date, count(*) FILTER (al.event_type = 'insider_buy')::INT AS target_event_on__insider_buy, count(*) FILTER (al.event_type = 'insider_sell')::INT AS target_event_on__insider_sell FROM prices p LEFT JOIN al ON al.symbol = p.symbol AND al.date = p.date GROUP BY ALL)"""


def panel(spark, sf):
    p = prices(spark, sf)
    return e.target_panel(p.select("symbol", "date"), asof.align_events(typed(spark, sf), p), ("insider_buy", "insider_sell"))


@query("l15_target_panel", f"WITH {PANEL} SELECT * FROM panel")
def l15(spark, sf):
    return panel(spark, sf)


@query("l16_collapsed_target", f"WITH {PANEL} SELECT symbol, date, target_event_on__insider_buy AS target_bullish, greatest(target_event_on__insider_buy, target_event_on__insider_sell) AS active FROM panel")
def l16(spark, sf):
    return panel(spark, sf).select("symbol", "date", F.col("target_event_on__insider_buy").alias("target_bullish"), F.greatest("target_event_on__insider_buy", "target_event_on__insider_sell").alias("active"))


@query("l18_target_summary", f"""WITH {PANEL}, u AS (SELECT symbol, date, greatest(target_event_on__insider_buy, target_event_on__insider_sell) AS active, 'target_event_on__insider_buy' AS target, target_event_on__insider_buy AS value FROM panel
UNION ALL SELECT symbol, date, greatest(target_event_on__insider_buy, target_event_on__insider_sell), 'target_event_on__insider_sell', target_event_on__insider_sell FROM panel)
SELECT target, count(*) AS rows, cast(sum(active) AS BIGINT) AS active, cast(sum(value) AS BIGINT) AS positives, sum(value) / nullif(sum(active), 0)::DOUBLE AS rate, count(DISTINCT symbol) FILTER (value > 0) AS symbols, min(date) FILTER (value > 0) AS first_date, max(date) FILTER (value > 0) AS last_date FROM u GROUP BY ALL""", floats=["rate"], dates=["first_date", "last_date"])  # fmt: skip
def l18(spark, sf):
    return e.target_summary(panel(spark, sf))
