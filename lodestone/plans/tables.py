"""Queries of calendars, screeners, table maintenance and remaining joins and labels."""

from __future__ import annotations

from pyspark.sql import functions as F

from lodestone.operators import asof, events as e, fundamental as f
from lodestone.plans.fundamentals import DAILY, daily
from lodestone.plans.registry import query
from lodestone.sources import tables as t
from lodestone.views import CHAIN, EVENTS, PRICES, PROFILES, STATEMENTS, chain, prices, profiles, raw_events, statements, table


@query("s06_economic_calendar", "SELECT cast(o_orderdate AS DATE) AS date, o_orderkey, o_totalprice AS actual, NULL::DOUBLE AS forecast FROM orders")
def s06(spark, sf):
    raw = table(spark, sf, "orders").select(F.date_format("o_orderdate", "yyyy-MM-dd").alias("date"), "o_orderkey", F.col("o_totalprice").cast("string").alias("actual"), F.lit("n/a").alias("forecast"))
    return t.normalize_calendar(raw, ("actual", "forecast"))


@query("s07_equity_calendar", "SELECT o_orderkey AS order_key, cast(o_orderdate AS DATE) AS date FROM orders")
def s07(spark, sf):
    return t.normalize_equity_calendar(table(spark, sf, "orders").select(F.col("o_orderkey").alias("orderKey"), F.col("o_orderdate").alias("reportDate")), "earnings")


@query("s10_latest_risk_premium", "SELECT c_nationkey AS country, arg_max(c_acctbal, c_custkey) AS premium FROM customer GROUP BY ALL", dates=[])
def s10(spark, sf):
    return t.latest_by(table(spark, sf, "customer").select(F.col("c_nationkey").alias("country"), F.col("c_acctbal").alias("premium"), "c_custkey"), ("country",), ("c_custkey",)).drop("c_custkey")


@query("s30_screener_rows", f"WITH {PROFILES} SELECT symbol, market_cap FROM profiles WHERE sector <> 'ASIA'", dates=[])
def s30(spark, sf):
    raw = profiles(spark, sf).select(F.when(F.col("sector") == "ASIA", " ").otherwise(F.concat(F.lit(" "), F.lower("symbol"))).alias("symbol"), F.col("market_cap").alias("marketCap"))
    return t.normalize_screener(raw)


@query("s39_split_legacy", "SELECT l_orderkey AS orderkey, l_tax AS tax FROM lineitem", dates=[])
def s39(spark, sf):
    raw = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("orderkey"), F.col("l_tax").alias("vendor__tax"), "l_discount")
    return t.split_columns(raw, ("orderkey", "vendor__tax"), "vendor")


@query("s44_delete_rows", f"WITH {PROFILES} SELECT symbol, sector FROM profiles WHERE exchange <> 'NYSE'", dates=[])
def s44(spark, sf):
    p = profiles(spark, sf)
    return t.without(p, p.filter("exchange = 'NYSE'"), ("symbol",)).select("symbol", "sector")


@query("s17_provider_tables_fallback", f"WITH {PRICES}, a AS (SELECT symbol, date, close FROM prices WHERE symbol IN ('S1', 'S2')), b AS (SELECT symbol, date, close + 1 AS close FROM prices) SELECT * FROM a UNION ALL SELECT * FROM b WHERE symbol NOT IN (SELECT symbol FROM a)", floats=["close"])
def s17b(spark, sf):
    p = prices(spark, sf).select("symbol", "date", "close")
    return t.fallback(p.filter("symbol in ('S1', 'S2')"), p.withColumn("close", F.col("close") + 1))


@query("j09_metrics_with_ratios", f"WITH {STATEMENTS}, a AS (SELECT symbol, period_ending, revenue FROM statements WHERE revenue > 100000), b AS (SELECT symbol, period_ending, net_income FROM statements WHERE net_income > 0) SELECT symbol, period_ending, revenue, net_income FROM a FULL JOIN b USING (symbol, period_ending)", floats=["revenue", "net_income"], dates=["period_ending"], digits=2)
def j09(spark, sf):
    s = statements(spark, sf)
    return s.filter("revenue > 100000").select("symbol", "period_ending", "revenue").join(s.filter("net_income > 0").select("symbol", "period_ending", "net_income"), ["symbol", "period_ending"], "full")


@query("j11_prior_snapshot", f"WITH {CHAIN}, {PRICES}, d AS (SELECT DISTINCT underlying, snapshot_date FROM chain WHERE part % 2 = 0) SELECT p.symbol, p.date, d.snapshot_date FROM prices p ASOF LEFT JOIN d ON p.symbol = d.underlying AND p.date >= d.snapshot_date", dates=["date", "snapshot_date"])
def j11(spark, sf):
    d = chain(spark, sf).filter("part % 2 = 0").select(F.col("underlying").alias("symbol"), "snapshot_date").distinct()
    return asof.asof_join(prices(spark, sf).select("symbol", "date"), d, left_on="date", right_on="snapshot_date", by=("symbol",))


@query("j13_trade_window_quotes", f"WITH {CHAIN}, {EVENTS}, t AS (SELECT DISTINCT symbol, event_date AS a FROM raw_events) SELECT t.symbol, t.a AS entry_date, count(*) AS quotes, count(DISTINCT c.snapshot_date) AS days, min(c.snapshot_date) AS first_day, max(c.part) AS last_part FROM t JOIN chain c ON c.underlying = t.symbol AND c.snapshot_date BETWEEN t.a AND t.a + 5 GROUP BY ALL", dates=["entry_date", "first_day"])
def j13(spark, sf):
    """What the window of each trade holds; ``j13_all_trade_window_quotes`` lists it."""
    rows = trade_window_quotes(raw_events(spark, sf), chain(spark, sf))
    return rows.groupBy("symbol", "entry_date").agg(F.count("*").alias("quotes"), F.countDistinct("snapshot_date").alias("days"), F.min("snapshot_date").alias("first_day"), F.max("part").alias("last_part"))


def trade_window_quotes(events, quotes):
    trades = events.select("symbol", F.col("event_date").alias("entry_date")).distinct().withColumn("exit_date", F.date_add("entry_date", 5))
    found = asof.window_join(trades, quotes.select(F.col("underlying").alias("symbol"), "snapshot_date", "part"), start="entry_date", stop="exit_date", on="snapshot_date")
    return found.select("symbol", "entry_date", "snapshot_date", "part")


@query("j13_all_trade_window_quotes", f"WITH {CHAIN}, {EVENTS}, t AS (SELECT DISTINCT symbol, event_date AS a FROM raw_events) SELECT t.symbol, t.a AS entry_date, c.snapshot_date, c.part FROM t JOIN chain c ON c.underlying = t.symbol AND c.snapshot_date BETWEEN t.a AND t.a + 5", dates=["entry_date", "snapshot_date"])
def j13_all(spark, sf):
    return trade_window_quotes(raw_events(spark, sf), chain(spark, sf))


@query("e05_e06_alias_columns", f"WITH {EVENTS} SELECT symbol, event_date, actor FROM raw_events", dates=["event_date"])
def e05(spark, sf):
    """Row-wise: the first alias that has a value."""
    raw = raw_events(spark, sf).select("symbol", F.lit(None).cast("date").alias("date"), F.col("event_date").alias("transactionDate"), F.lit(" ").alias("name"), "actor")
    from lodestone.sources.normalize import first_filled

    return raw.select("symbol", F.coalesce("date", "transactionDate").alias("event_date"), first_filled("name", "actor").alias("actor"))


@query("f04_f06_prefixed_sections", f"WITH {DAILY} SELECT symbol, date, revenue AS is__revenue, cost AS is__cost FROM daily", floats=["is__revenue", "is__cost"], digits=2)
def f04(spark, sf):
    return daily(spark, sf).select("symbol", "date", F.col("revenue").alias("is__revenue"), F.col("cost").alias("is__cost"))


@query("f10_f11_repriced_multiples", f"WITH {DAILY} SELECT symbol, date, close / nullif(net_income / nullif(shares, 0), 0) AS rt__pe, close / nullif(revenue / nullif(shares, 0), 0) AS rt__ps FROM daily", floats=["rt__pe", "rt__ps"], digits=4)
def f10(spark, sf):
    from lodestone.functions.columns import ratio

    per_share = lambda c: ratio(F.col(c), F.col("shares"))
    return daily(spark, sf).select("symbol", "date", ratio(F.col("close"), per_share("net_income")).alias("rt__pe"), ratio(F.col("close"), per_share("revenue")).alias("rt__ps"))


@query("f13_f14_f15_statement_yields", f"WITH {DAILY} SELECT symbol, date, -cost / nullif(shares * close, 0) AS cost_to_mcap, cash / nullif(shares * close, 0) AS cash_to_mcap, debt / nullif(shares * close, 0) AS debt_to_mcap FROM daily", floats=["cost_to_mcap", "cash_to_mcap", "debt_to_mcap"], digits=4)
def f13(spark, sf):
    return f.price_linked(daily(spark, sf), ("cost", "cash", "debt"), negate=("cost",)).select("symbol", "date", "cost_to_mcap", "cash_to_mcap", "debt_to_mcap")


@query("e04_sign_types", f"WITH {STATEMENTS} SELECT symbol, period_ending, CASE WHEN net_income > 0 THEN 'earnings_beat' WHEN net_income < 0 THEN 'earnings_miss' END AS event_type FROM statements", dates=["period_ending"])
def e04s(spark, sf):
    return statements(spark, sf).select("symbol", "period_ending", e.sign_type(F.col("net_income"), "earnings").alias("event_type"))
