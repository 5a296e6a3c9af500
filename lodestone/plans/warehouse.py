"""Queries of normalisation, upsert, coverage and joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from lodestone.operators import asof, planning, upsert as u
from lodestone.operators.planning import gap_plan
from lodestone.plans.planning import LADDER, NOW, TARGET
from lodestone.plans.registry import query
from lodestone.sources import normalize as n
from lodestone.views import CHAIN, MACRO, PRICES, PROFILES, STATEMENTS, chain, macro, prices, profiles, raw_events, statements, table, EVENTS


@query("s01_normalize_prices", """WITH r AS (SELECT concat('S', l_suppkey) AS symbol, cast(l_shipdate AS DATE) AS date, l_extendedprice AS close, l_quantity AS volume, l_tax AS vendor__tax_rate,
row_number() OVER (PARTITION BY l_suppkey, cast(l_shipdate AS DATE) ORDER BY l_orderkey DESC, l_linenumber DESC, l_partkey DESC, l_extendedprice DESC) AS k FROM lineitem)
SELECT symbol, date, close, volume, vendor__tax_rate FROM r WHERE k = 1 AND date >= DATE '1900-01-01'""")  # fmt: skip
def s01(spark, sf):
    seq = F.struct("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice")
    raw = table(spark, sf, "lineitem").select(F.concat(F.lit("S"), "l_suppkey").alias("symbol"), F.to_date("l_shipdate").alias("date"), F.col("l_extendedprice").cast("string").alias("Close"), F.col("l_quantity").alias("Vol"), F.col("l_tax").alias("TaxRate"), seq.alias("seq"))
    return n.normalize_prices(raw, "vendor")


@query("s02_normalize_series", f"WITH {STATEMENTS} SELECT symbol, period_ending AS date, revenue, cost FROM statements", floats=["revenue", "cost"], digits=2)
def s02(spark, sf):
    raw = statements(spark, sf).select("symbol", F.lit(None).cast("date").alias("fiscalDate"), F.col("period_ending").alias("periodEnding"), F.col("revenue").alias("Revenue"), "cost", F.lit("x").alias("link"), F.lit(1).alias("seq"))
    return n.normalize_frame(raw, ("fiscalDate", "periodEnding"), drop=("link", "fiscalDate"))


@query("s03_normalize_panel", "SELECT concat('S', l_suppkey) AS symbol, cast(l_shipdate AS DATE) AS date, l_returnflag AS return_flag, arg_max(l_quantity, (l_orderkey, l_linenumber, l_partkey, l_quantity)) AS quantity FROM lineitem GROUP BY ALL")
def s03(spark, sf):
    raw = table(spark, sf, "lineitem").select(F.concat(F.lit("S"), "l_suppkey").alias("symbol"), F.to_date("l_shipdate").alias("shipDate"), F.col("l_returnflag").alias("returnFlag"), F.col("l_quantity").alias("quantity"), F.struct("l_orderkey", "l_linenumber", "l_partkey", "l_quantity").alias("seq"))
    return n.normalize_frame(raw, ("date", "shipDate"), dimensions=("returnFlag",))


@query("s04_dated_snapshot", "SELECT c_mktsegment AS segment, c_nationkey AS nation, cast(arg_max(c_acctbal, c_custkey) AS DOUBLE) AS balance, '2024-01-01' AS as_of FROM customer GROUP BY ALL", dates=["as_of"])
def s04(spark, sf):
    raw = table(spark, sf, "customer").select(F.col("c_mktsegment").alias("segment"), F.col("c_nationkey").alias("nation"), F.col("c_acctbal").alias("balance"), F.col("c_custkey").alias("seq"))
    return n.snapshot(raw, F.lit("2024-01-01").cast("date"), ("segment", "nation"))


@query("s05_clip_to_listing", f"WITH {PRICES}, f AS (SELECT concat('S', s_suppkey) AS symbol, cast(DATE '1996-01-01' + INTERVAL 1 DAY * cast(s_suppkey % 700 AS INTEGER) AS DATE) AS listing_date FROM supplier) SELECT symbol, date, close FROM prices JOIN f USING (symbol) WHERE date >= listing_date")
def s05(spark, sf):
    floor = table(spark, sf, "supplier").select(F.concat(F.lit("S"), "s_suppkey").alias("symbol"), F.date_add(F.lit("1996-01-01").cast("date"), (F.col("s_suppkey") % 700).cast("int")).alias("listing_date"))
    return n.clip_to_floor(prices(spark, sf), floor).select("symbol", "date", "close")


@query("s08_curve_wide", "SELECT * FROM (PIVOT (SELECT cast(o_orderdate AS DATE) AS date, o_orderstatus AS maturity, o_totalprice, o_orderkey FROM orders) ON maturity IN ('F', 'O', 'P') USING arg_max(o_totalprice, o_orderkey) GROUP BY date)")
def s08(spark, sf):
    long = table(spark, sf, "orders").select(F.to_date("o_orderdate").alias("date"), F.col("o_orderstatus").alias("maturity"), F.col("o_totalprice").alias("rate"), F.col("o_orderkey").alias("seq"))
    return n.curve_long_to_wide(long, ("F", "O", "P"))


@query("s09_curve_long", "SELECT 'macro__ust_' || lower(o_orderstatus) AS series_code, cast(o_orderdate AS DATE) AS date, max(o_totalprice) AS value FROM orders GROUP BY ALL")
def s09(spark, sf):
    wide = table(spark, sf, "orders").groupBy(F.to_date("o_orderdate").alias("date")).pivot("o_orderstatus", ["F", "O", "P"]).agg(F.max("o_totalprice"))
    return n.curve_wide_to_long(wide.toDF("date", "f", "o", "p"))


@query("s11_s12_option_chain", f"""WITH {CHAIN} SELECT underlying, snapshot_date, expiration, strike, part, ask, bid, volume, lower("right") AS option_type, (bid + ask) / 2 AS mid,
upper(underlying) || '_' || lower("right") || '_' || strftime(expiration, '%Y%m%d') || '_' || regexp_replace(printf('%.4f', strike), '\\.?0+$', '') AS contract_symbol FROM chain WHERE bid > 0 AND ask >= 0.01 AND ask >= bid""", floats=["mid", "bid"], dates=["snapshot_date", "expiration"])  # fmt: skip
def s11(spark, sf):
    return n.normalize_chain(chain(spark, sf))


UPSERT = f"""{PRICES}, e AS (SELECT *, 0 AS k FROM prices WHERE date < DATE '2000-01-01' UNION ALL SELECT symbol, date, open, high, low, close * 2, volume, 1 FROM prices WHERE date >= DATE '1999-06-01')"""


@query("s13_upsert", f"WITH {UPSERT} SELECT symbol, date, arg_max(close, k) AS close, arg_max(volume, k) AS volume FROM e GROUP BY ALL", floats=["close"])
def s13(spark, sf):
    p = prices(spark, sf)
    return u.upsert(p.filter("date < '2000-01-01'"), p.filter("date >= '1999-06-01'").withColumn("close", F.col("close") * 2), ["symbol", "date"]).select("symbol", "date", "close", "volume")


@query("s14_panel_upsert", "SELECT c_mktsegment AS segment, c_name AS name, '2024-01-01' AS date, CASE WHEN c_custkey % 2 = 0 THEN -1.0::DOUBLE ELSE c_acctbal END AS balance FROM customer")
def s14(spark, sf):
    c = table(spark, sf, "customer").select(F.lit("2024-01-01").cast("date").alias("date"), F.col("c_mktsegment").alias("segment"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance"), "c_custkey")
    return u.panel_upsert(c.drop("c_custkey"), c.filter("c_custkey % 2 = 0").drop("c_custkey").withColumn("balance", F.lit(-1.0)))


@query("s15_chain_upsert", f"""WITH {CHAIN} SELECT underlying, part, snapshot_date, CASE WHEN part % 3 = 0 THEN ask + 1 ELSE ask END AS ask FROM chain""", floats=["ask"], dates=["snapshot_date"])
def s15(spark, sf):
    c = chain(spark, sf).select("underlying", "part", "snapshot_date", "ask")
    return u.upsert(c, c.filter("part % 3 = 0").withColumn("ask", F.col("ask") + 1), ["underlying", "part", "snapshot_date"])


@query("s17_read_series", f"WITH {PRICES} SELECT symbol, date, close FROM prices WHERE date BETWEEN DATE '1998-01-01' AND DATE '1998-12-31'")
def s17(spark, sf):
    return prices(spark, sf).filter("date between '1998-01-01' and '1998-12-31'").select("symbol", "date", "close")


@query("s20_latest_snapshot", "SELECT symbol, period_ending AS date, shares FROM (SELECT *, max(period_ending) OVER () AS m FROM (WITH " + STATEMENTS + " SELECT * FROM statements)) WHERE period_ending = m", floats=["shares"])
def s20(spark, sf):
    s = statements(spark, sf).select("symbol", F.col("period_ending").alias("date"), "shares")
    return s.join(s.agg(F.max("date").alias("date")), "date").select("symbol", "date", "shares")


_POOLS = tuple(f"pool_{i}" for i in range(10))


@query("s21_price_panel", f"WITH {PRICES} SELECT date, {', '.join(f'max(close) FILTER (substr(symbol, 2)::INT % 10 = {i}) AS {c}' for i, c in enumerate(_POOLS))} FROM prices GROUP BY ALL")
def s21(spark, sf):
    """All symbols, pooled by their numbers' last digit, as columns; ``s21_price_panel_blocks`` has a column for each symbol."""
    pool = F.concat(F.lit("pool_"), F.substring("symbol", 2, 20).cast("int") % 10)
    return prices(spark, sf).withColumn("pool", pool).groupBy("date").pivot("pool", list(_POOLS)).agg(F.max("close"))


SERIES = ("macro__africa", "macro__america", "macro__asia", "macro__europe", "macro__middle_east")


@query("s22_macro_panel", f"WITH {MACRO} SELECT date, {', '.join(f"max(value) FILTER (series_code = '{c}') AS {c}" for c in SERIES)} FROM macro GROUP BY ALL", floats=SERIES)
def s22(spark, sf):
    return macro(spark, sf).groupBy("date").pivot("series_code", list(SERIES)).agg(F.max("value"))


@query("s21_price_panel_blocks", f"WITH {PRICES}, n AS (SELECT symbol, row_number() OVER (ORDER BY symbol) - 1 AS n FROM (SELECT DISTINCT symbol FROM prices)), r AS (SELECT p.date, p.symbol, p.close, n.n, n.n // 50 AS block FROM prices p JOIN n USING (symbol)), f AS (SELECT n // 50 AS block, min(symbol) AS first_symbol FROM n GROUP BY ALL) SELECT block::INT AS block, date, first_symbol, {', '.join(f'max(close) FILTER (n % 50 = {i}) AS p{i}' for i in range(50))} FROM r JOIN f USING (block) GROUP BY ALL", floats=[f"p{i}" for i in range(50)])
def s21_blocks(spark, sf):
    """A column for each symbol, in blocks."""
    return planning.panel_blocks(prices(spark, sf))


@query("s23_s24_coverage", f"WITH {PRICES} SELECT symbol, min(date) AS min_date, max(date) AS max_date, count(*) AS row_count, count(DISTINCT date) AS days, 'open,high,low,close,volume' AS columns_present FROM prices GROUP BY ALL", dates=["min_date", "max_date"])
def s23(spark, sf):
    return u.coverage(prices(spark, sf), ["symbol"]).withColumn("columns_present", F.array_join("columns_present", ","))


GAPS = f"""{PRICES}, b AS (SELECT symbol, min(date) AS a, max(date) AS z FROM prices GROUP BY ALL), days AS (SELECT symbol, cast(unnest(generate_series(a, z, INTERVAL 1 DAY)) AS DATE) AS date FROM b),
gaps AS (SELECT symbol, date FROM days WHERE isodow(date) < 6 EXCEPT SELECT symbol, date FROM prices)"""


@query("s25_missing_days", f"WITH {GAPS} SELECT * FROM gaps")
def s25(spark, sf):
    return u.missing_days(prices(spark, sf), ["symbol"])


@query("s26_contiguous_ranges", f"""WITH {GAPS}, o AS (SELECT *, floor((date - DATE '1970-01-05') / 7) * 5 + isodow(date) - 1 - row_number() OVER (PARTITION BY symbol ORDER BY date) AS run FROM gaps)
SELECT symbol, min(date) AS first_day, max(date) AS last_day, count(*) AS days FROM o GROUP BY symbol, run""", dates=["first_day", "last_day"])  # fmt: skip
def s26(spark, sf):
    return u.contiguous_ranges(u.missing_days(prices(spark, sf), ["symbol"]), ["symbol"]).withColumnsRenamed({"start": "first_day", "end": "last_day"})


@query("s27_date_chunks", f"""WITH {PRICES}, b AS (SELECT symbol, min(date) AS a, max(date) AS z FROM prices GROUP BY ALL), c AS (SELECT symbol, z, cast(unnest(generate_series(a, z, INTERVAL 365 DAY)) AS DATE) AS start FROM b)
SELECT symbol, start AS first_day, least(cast(start + INTERVAL 364 DAY AS DATE), z) AS last_day FROM c""", dates=["first_day", "last_day"])  # fmt: skip
def s27(spark, sf):
    return u.date_chunks(u.coverage(prices(spark, sf), ["symbol"]), ["symbol"], "min_date", "max_date").withColumnsRenamed({"start": "first_day", "end": "last_day"})


@query("s28_profiles_country", f"WITH {PROFILES} SELECT symbol, CASE country WHEN 'UNITED STATES' THEN 'US' WHEN 'UNITED KINGDOM' THEN 'GB' WHEN 'GERMANY' THEN 'DE' WHEN 'FRANCE' THEN 'FR' WHEN 'CHINA' THEN 'CN' WHEN 'JAPAN' THEN 'JP' WHEN 'CANADA' THEN 'CA' WHEN 'INDIA' THEN 'IN' WHEN 'BRAZIL' THEN 'BR' WHEN 'RUSSIA' THEN 'RU' ELSE country END AS country, sector FROM profiles", dates=[])
def s28(spark, sf):
    p = profiles(spark, sf).withColumn("blank", F.lit(" "))
    return p.select("symbol", n.country_code(n.first_filled("blank", "country")).alias("country"), "sector")


@query("s29_screener", f"WITH {PROFILES} SELECT * FROM (SELECT * FROM profiles WHERE market_cap >= 100 ORDER BY market_cap DESC, symbol LIMIT 60) WHERE exchange IN ('NYSE', 'AMEX') AND NOT is_etf", dates=[])
def s29(spark, sf):
    return n.screen(profiles(spark, sf), least=100, exchanges=("nyse", "AMEX"), limit=60)


@query("s31_vehicles", f"WITH {PROFILES} SELECT symbol, CASE WHEN is_etf THEN 'etf' WHEN regexp_matches(symbol, '^[A-Z]{{4}}X$') THEN 'fund' ELSE 'equity' END AS vehicle FROM profiles", dates=[])
def s31(spark, sf):
    return profiles(spark, sf).select("symbol", n.classify_vehicle("symbol", "is_etf", "sector").alias("vehicle"))


@query("s32_us_symbols", "SELECT p_name AS symbol FROM part WHERE NOT regexp_matches(upper(p_name), '(\\.TO|\\.L|\\.DE|\\.PA|\\.HK|\\.T|\\.AX|\\.SW|\\.MI|\\.AS|\\.NS)$')", dates=[])
def s32(spark, sf):
    return n.us_option_symbols(table(spark, sf, "part").select(F.col("p_name").alias("symbol")))


@query("s33_eligibility", f"WITH {PROFILES}, {PRICES}, c AS (SELECT symbol FROM prices WHERE year(date) = 1995 GROUP BY symbol HAVING count(*) > 70) SELECT symbol, symbol IN (SELECT symbol FROM c) AS eligible, CASE WHEN symbol NOT IN (SELECT symbol FROM c) THEN 'early' END AS first_missing FROM profiles", dates=[])
def s33(spark, sf):
    p = prices(spark, sf)
    counts = p.groupBy("symbol").agg(F.count("*").alias("row_count")).withColumn("section", F.lit("prices"))
    early = p.filter(F.year("date") == 1995).groupBy("symbol").agg(F.count("*").alias("c")).select("symbol", F.when(F.col("c") > 70, F.col("c")).otherwise(0).alias("row_count"), F.lit("early").alias("section"))
    return u.eligibility(profiles(spark, sf).select("symbol"), ("prices", "early"), counts.unionByName(early))


# Prices as states of a section, never fetched by a known time.
PLAN = f"""{PRICES}, st AS (SELECT symbol, 'prices' AS section, min(date) AS min_date, max(date) AS max_date, count(*) AS row_count, cast(DATE '1995-01-01' + INTERVAL 1 DAY * cast((cast(substr(symbol, 2) AS INTEGER) % 20 - 19) * 5 AS INTEGER) AS DATE) AS listing_date,
  cast(NULL AS TIMESTAMP) AS last_fetched, false AS is_etf, cast(NULL AS VARCHAR[]) AS columns_present FROM prices GROUP BY ALL), {LADDER}"""


def price_plan(spark, sf):
    listed = F.date_add(F.lit("1995-01-01").cast("date"), (F.substring("symbol", 2, 20).cast("int") % 20 - 19) * 5)
    states = u.coverage(prices(spark, sf), ["symbol"]).withColumns({"section": F.lit("prices"), "listing_date": listed, "last_fetched": F.lit(None).cast("timestamp")})
    return gap_plan(states, F.lit(TARGET).cast("date"), F.lit(NOW).cast("timestamp"))


@query("s34_refresh_plan", f"WITH {PLAN} SELECT symbol, mode, fetch_start, fetch_end FROM plan", dates=["fetch_start", "fetch_end"])
def s34(spark, sf):
    return price_plan(spark, sf).select("symbol", "mode", "fetch_start", "fetch_end")


@query("s36_expected_date", "SELECT event_id, cast(CASE WHEN isodow(l) < 6 AND hour(l) >= 17 THEN cast(l AS DATE) ELSE cast(l AS DATE) - CASE isodow(l) WHEN 1 THEN 3 WHEN 7 THEN 2 ELSE 1 END END AS DATE) AS date FROM (SELECT event_id, ts - INTERVAL 5 HOUR AS l FROM events)")
def s36(spark, sf):
    return table(spark, sf, "events").select("event_id", u.expected_price_date(F.col("ts").cast("timestamp")).alias("date"))


@query("s37_provider_fallback", f"WITH {PRICES}, st AS (SELECT symbol, max(date) AS max_date, CASE WHEN volume > 30 THEN 'a' ELSE 'b' END AS provider FROM prices GROUP BY ALL) SELECT symbol, arg_min(provider, provider) AS provider FROM st WHERE max_date >= DATE '2001-07-01' GROUP BY symbol", dates=[])
def s37(spark, sf):
    states = prices(spark, sf).groupBy("symbol", F.when(F.col("volume") > 30, "a").otherwise("b").alias("provider")).agg(F.max("date").alias("max_date"))
    return u.first_provider(states, F.lit("2001-07-01").cast("date"), ("a", "b")).select("symbol", "provider")


@query("s38_same_table", "SELECT true AS rows, true AS columns, true AS dates", dates=[])
def s38(spark, sf):
    return u.same_table(prices(spark, sf), prices(spark, sf))


@query("s42_s45_listing_and_summary", f"WITH {PLAN} SELECT mode, count(*) AS n FROM plan GROUP BY ALL", dates=[])
def s45(spark, sf):
    return price_plan(spark, sf).groupBy("mode").agg(F.count("*").alias("n"))


JOINED = "p.symbol = s.symbol AND p.date >= s.period_ending"


@query("j01_j04_asof_backward", f"WITH {PRICES}, {STATEMENTS} SELECT p.symbol, p.date, p.close, s.period_ending, s.revenue, s.shares FROM prices p ASOF LEFT JOIN statements s ON {JOINED}", floats=["revenue"], dates=["date", "period_ending"], digits=2)
def j01(spark, sf):
    s = statements(spark, sf).select("symbol", "period_ending", "revenue", "shares")
    return asof.asof_join(prices(spark, sf).select("symbol", "date", "close"), s, left_on="date", right_on="period_ending", by=("symbol",))


@query("j01_asof_forward_tolerance", f"""WITH {PRICES}, {STATEMENTS} SELECT p.symbol, p.date, CASE WHEN s.period_ending - p.date <= 30 THEN s.period_ending END AS period_ending, CASE WHEN s.period_ending - p.date <= 30 THEN s.shares END AS shares
FROM prices p ASOF LEFT JOIN statements s ON p.symbol = s.symbol AND p.date < s.period_ending""", dates=["date", "period_ending"])  # fmt: skip
def j01f(spark, sf):
    return asof.asof_join(prices(spark, sf).select("symbol", "date"), statements(spark, sf).select("symbol", "period_ending", "shares"), left_on="date", right_on="period_ending", by=("symbol",), direction="forward", tolerance=30, exact=False)


@query("j01_asof_nearest", f"""WITH {PRICES}, {STATEMENTS}, b AS (SELECT p.symbol, p.date, s.period_ending AS x FROM prices p ASOF LEFT JOIN statements s ON p.symbol = s.symbol AND p.date >= s.period_ending),
f AS (SELECT b.*, s.period_ending AS y FROM b ASOF LEFT JOIN statements s ON b.symbol = s.symbol AND b.date <= s.period_ending)
SELECT symbol, date, CASE WHEN y IS NULL OR abs(date - x) <= abs(y - date) THEN x ELSE y END AS period_ending FROM f""", dates=["date", "period_ending"])  # fmt: skip
def j01n(spark, sf):
    return asof.asof_join(prices(spark, sf).select("symbol", "date"), statements(spark, sf).select("symbol", "period_ending"), left_on="date", right_on="period_ending", by=("symbol",), direction="nearest")


@query("j01_asof_without_key", f"""WITH {PRICES}, {MACRO}, r AS (SELECT date AS known, max(value) AS level FROM macro GROUP BY ALL) SELECT p.symbol, p.date, p.close, r.known, r.level FROM prices p ASOF LEFT JOIN r ON p.date > r.known""", floats=["level"], dates=["date", "known"], digits=2)
def j01_keyless(spark, sf):
    """Every price with the last month's level before its day, without a key: the days are cut into slices."""
    levels = macro(spark, sf).groupBy(F.col("date").alias("known")).agg(F.max("value").alias("level"))
    return asof.asof_join(prices(spark, sf).select("symbol", "date", "close"), levels, left_on="date", right_on="known", by=(), exact=False)


_HOT = "CASE WHEN substr(symbol, 2)::INT % 2 = 0 THEN 'all even' ELSE symbol END"


@query("j01_asof_dominant_key", f"""WITH {PRICES}, {STATEMENTS}, l AS (SELECT {_HOT} AS pool, symbol, date FROM prices), r AS (SELECT {_HOT} AS pool, period_ending, max(revenue) AS revenue FROM statements GROUP BY ALL)
SELECT l.pool, l.symbol, l.date, r.period_ending, r.revenue FROM l ASOF LEFT JOIN r ON l.pool = r.pool AND l.date >= r.period_ending""", floats=["revenue"], dates=["date", "period_ending"], digits=2)  # fmt: skip
def j01_hot(spark, sf):
    """Half of all rows share one key, which is cut into slices of time."""
    pool = F.when(F.substring("symbol", 2, 20).cast("int") % 2 == 0, "all even").otherwise(F.col("symbol")).alias("pool")
    right = statements(spark, sf).groupBy(pool, "period_ending").agg(F.max("revenue").alias("revenue"))
    return asof.asof_join(prices(spark, sf).select(pool, "symbol", "date"), right, left_on="date", right_on="period_ending", by=("pool",), slices=64)


@query("j02_j03_lagged_statements", f"WITH {PRICES}, {STATEMENTS}, l AS (SELECT * REPLACE (period_ending + 45 AS period_ending) FROM statements) SELECT p.symbol, p.date, s.period_ending, s.revenue FROM prices p ASOF LEFT JOIN l s ON {JOINED}", floats=["revenue"], dates=["date", "period_ending"], digits=2)
def j03(spark, sf):
    s = asof.lag_reports(statements(spark, sf), date_col="period_ending").select("symbol", "period_ending", "revenue")
    return asof.asof_join(prices(spark, sf).select("symbol", "date"), s, left_on="date", right_on="period_ending", by=("symbol",))


@query("j05_align_events", f"""WITH {PRICES}, {EVENTS}, a AS (SELECT e.symbol, e.event_date, e.transaction AS event_type, p.date FROM raw_events e ASOF JOIN prices p ON e.symbol = p.symbol AND e.event_date <= p.date)
SELECT DISTINCT symbol, date, event_type FROM a WHERE date - event_date <= 7""")  # fmt: skip
def j05(spark, sf):
    return asof.align_events(raw_events(spark, sf).withColumn("event_type", F.col("transaction")), prices(spark, sf))


@query("j06_events_with_prices", f"WITH {PRICES}, {EVENTS} SELECT e.symbol, e.event_date AS date, e.actor, p.close FROM (SELECT DISTINCT symbol, event_date, actor FROM raw_events) e JOIN prices p ON p.symbol = e.symbol AND p.date = e.event_date")
def j06(spark, sf):
    e = raw_events(spark, sf).select("symbol", F.col("event_date").alias("date"), "actor").distinct()
    return e.join(prices(spark, sf).select("symbol", "date", "close"), ["symbol", "date"])


@query("j07_profile_enrich", f"WITH {PRICES}, {PROFILES} SELECT symbol, date, coalesce(CASE WHEN volume > 30 THEN 'own' END, sector) AS sector FROM prices LEFT JOIN profiles USING (symbol)")
def j07(spark, sf):
    p = prices(spark, sf).select("symbol", "date", F.when(F.col("volume") > 30, "own").alias("sector"))
    return p.join(profiles(spark, sf).select("symbol", F.col("sector").alias("sector_profile")), "symbol", "left").select("symbol", "date", F.coalesce("sector", "sector_profile").alias("sector"))


@query("j08_full_outer_targets", f"WITH {PRICES}, a AS (SELECT symbol, date FROM prices WHERE volume > 30), b AS (SELECT symbol, date FROM prices WHERE close > 2000) SELECT coalesce(a.symbol, b.symbol) AS symbol, coalesce(a.date, b.date) AS date, (a.symbol IS NOT NULL)::INT AS target_a, (b.symbol IS NOT NULL)::INT AS target_b FROM a FULL JOIN b ON a.symbol = b.symbol AND a.date = b.date")
def j08(spark, sf):
    p = prices(spark, sf)
    a, b = (p.filter(c).select("symbol", "date", F.lit(1).alias(t)) for c, t in (("volume > 30", "target_a"), ("close > 2000", "target_b")))
    return a.join(b, ["symbol", "date"], "full").fillna(0, ["target_a", "target_b"])


@query("j12_entry_exit_contracts", f"""WITH {CHAIN} SELECT a.underlying, a.part, a.snapshot_date AS entry_date, b.snapshot_date AS exit_date, a.ask AS entry_px, b.bid AS exit_px FROM chain a JOIN chain b ON a.underlying = b.underlying AND a.part = b.part AND a.strike = b.strike AND a.snapshot_date < b.snapshot_date AND b.snapshot_date <= a.expiration""", floats=["entry_px", "exit_px"], dates=["entry_date", "exit_date"])
def j12(spark, sf):
    c = chain(spark, sf)
    a = c.select("underlying", "part", "strike", F.col("snapshot_date").alias("entry_date"), "expiration", F.col("ask").alias("entry_px"))
    b = c.select("underlying", "part", "strike", F.col("snapshot_date").alias("exit_date"), F.col("bid").alias("exit_px"))
    return a.join(b, ["underlying", "part", "strike"]).filter((F.col("entry_date") < F.col("exit_date")) & (F.col("exit_date") <= F.col("expiration"))).select("underlying", "part", "entry_date", "exit_date", "entry_px", "exit_px")


@query("j14_j15_missing_and_semi", f"WITH {PROFILES}, {PRICES} SELECT symbol, sector FROM profiles WHERE symbol NOT IN (SELECT symbol FROM prices WHERE date = DATE '1999-03-15') AND symbol IN (SELECT symbol FROM prices WHERE volume > 60)", dates=[])
def j14(spark, sf):
    p = prices(spark, sf)
    return profiles(spark, sf).join(p.filter("date = '1999-03-15'"), "symbol", "left_anti").join(p.filter("volume > 60"), "symbol", "left_semi").select("symbol", "sector")
