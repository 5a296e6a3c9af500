"""Queries of refresh plans, profiles, listings and small selections."""

from __future__ import annotations

import uuid

import pandas as pd
from pyspark.sql import functions as F

from lodestone.operators import events as e
from lodestone.operators import evaluate as v
from lodestone.operators import options as o
from lodestone.operators import planning as p
from lodestone.operators import plugins, specs
from lodestone.operators.technical import returns
from lodestone.operators.upsert import upsert
from lodestone.plans.events import TYPED, typed
from lodestone.plans.evaluate import RET
from lodestone.plans.registry import query
from lodestone.plans.research import TRADES, daily_trades
from lodestone.scratch import shared_folder
from lodestone.sources import tables
from lodestone.sources.normalize import COUNTRIES, economic_series
from lodestone.views import CHAIN, MACRO, PRICES, PROFILES, chain, macro, prices, profiles, table

NOW, TARGET = "2001-11-05 12:00:00", "2001-11-02"
# Fixed small list: sections of every kind that a plan tells apart.
KINDS = ("prices", "income", "filings", "etf_nport_disclosure", "dividends", "management", "etf_prices")
_LISTED = ", ".join(f"'{k}'" for k in KINDS)
# States of many kinds: a customer's orders as a section, some without rows, a sixth without a last day, an eighth without a listing date.
STATES = f"""st AS (SELECT concat('C', c_custkey) AS symbol, [{_LISTED}][c_custkey % 7 + 1] AS section, concat('p', c_custkey % 3) AS provider, c_custkey % 7 IN (3, 6) AS is_etf,
  CASE WHEN c_custkey % 13 = 0 THEN 0 ELSE count(o_orderkey) END AS row_count, CASE WHEN c_custkey % 11 = 0 THEN DATE '1850-01-01' WHEN c_custkey % 17 <> 0 THEN cast(min(o_orderdate) AS DATE) END AS min_date, CASE WHEN c_custkey % 6 <> 0 THEN CASE WHEN c_custkey % 5 = 0 THEN DATE '2001-11-03' ELSE cast(max(o_orderdate) AS DATE) END END AS max_date,
  CASE WHEN c_custkey % 10 < 3 THEN TIMESTAMP '2001-11-05 06:00:00' WHEN c_custkey % 10 < 9 THEN TIMESTAMP '2001-10-01 00:00:00' END AS last_fetched, CASE WHEN c_custkey % 8 <> 0 THEN DATE '1995-01-01' + (c_custkey % 40)::INT * 3 END AS listing_date, CASE WHEN c_custkey % 9 > 0 THEN ['report_type', 'cusip'] WHEN c_custkey % 2 = 0 THEN ['other'] END AS columns_present
  FROM customer LEFT JOIN orders ON c_custkey = o_custkey GROUP BY c_custkey)"""


def states(spark, sf):
    k = F.col("c_custkey")
    rows = table(spark, sf, "customer").join(table(spark, sf, "orders"), F.col("c_custkey") == F.col("o_custkey"), "left").groupBy("c_custkey").agg(F.count("o_orderkey").alias("n"), F.to_date(F.min("o_orderdate")).alias("a"), F.to_date(F.max("o_orderdate")).alias("z"))
    day = lambda x: F.lit(x).cast("date")
    return rows.select(
        F.concat(F.lit("C"), k).alias("symbol"), F.element_at(F.array(*[F.lit(x) for x in KINDS]), (k % 7 + 1).cast("int")).alias("section"), F.concat(F.lit("p"), k % 3).alias("provider"), (k % 7).isin(3, 6).alias("is_etf"),
        F.when(k % 13 == 0, 0).otherwise(F.col("n")).alias("row_count"), F.when(k % 11 == 0, day("1850-01-01")).when(k % 17 != 0, F.col("a")).alias("min_date"), F.when(k % 6 != 0, F.when(k % 5 == 0, day("2001-11-03")).otherwise(F.col("z"))).alias("max_date"),
        F.when(k % 10 < 3, F.lit("2001-11-05 06:00:00")).when(k % 10 < 9, F.lit("2001-10-01 00:00:00")).cast("timestamp").alias("last_fetched"), F.when(k % 8 != 0, F.date_add(day("1995-01-01"), (k % 40 * 3).cast("int"))).alias("listing_date"),
        F.when(k % 9 > 0, F.array(F.lit("report_type"), F.lit("cusip"))).when(k % 2 == 0, F.array(F.lit("other"))).alias("columns_present"),
    )


def now() -> F.Column:
    return F.lit(NOW).cast("timestamp")


def target() -> F.Column:
    return F.lit(TARGET).cast("date")


_LACKS = "(section = 'filings' AND NOT coalesce(list_contains(columns_present, 'report_type'), false) OR section = 'etf_nport_disclosure' AND NOT coalesce(list_contains(columns_present, 'cusip'), false))"
LADDER = f"""x AS (SELECT *, CASE WHEN is_etf THEN DATE '1900-01-01' ELSE greatest(DATE '1900-01-01', coalesce(listing_date, DATE '1900-01-01')) END AS s, section IN ('prices', 'etf_prices', 'income', 'filings', 'dividends') AS w, section = 'income' AS per, section = 'management' AS snap,
  CASE WHEN section IN ('prices', 'etf_prices') THEN 7 ELSE 90 END AS lim, coalesce(last_fetched > TIMESTAMP '{NOW}' - INTERVAL 24 HOUR, false) AS recent, DATE '2001-11-05' - max_date AS age FROM st),
y AS (SELECT *, coalesce(w AND (is_etf OR listing_date IS NOT NULL) AND min_date - s > 30, false) AS late, CASE WHEN is_etf OR listing_date IS NOT NULL OR min_date < s THEN s ELSE min_date END AS b0, least(CASE WHEN per THEN max_date + 120 ELSE max_date END, DATE '{TARGET}') AS z FROM x),
y2 AS (SELECT *, CASE WHEN per AND min_date > b0 AND min_date - b0 <= 120 THEN min_date ELSE b0 END AS b FROM y),
c AS (SELECT *, CASE WHEN min_date IS NULL OR max_date IS NULL THEN false ELSE (z - greatest(min_date, b) + 1) / greatest(DATE '{TARGET}' - b + 1, 1)::DOUBLE >= 0.75 END AS cov, w AND min_date IS NOT NULL AND max_date IS NOT NULL AS wb, coalesce(max_date < DATE '{TARGET}', false) AS early FROM y2),
r AS (SELECT *, CASE WHEN coalesce(row_count, 0) <= 0 THEN 'full missing' WHEN min_date < DATE '1900-01-01' THEN 'full below_min_historical_date' WHEN {_LACKS} THEN 'full upgrade_panel_schema' WHEN snap AND max_date IS NULL THEN 'full missing_max_date' WHEN snap AND age > lim THEN 'full stale_max_date'
  WHEN snap AND recent THEN 'skip recent_attempt' WHEN snap THEN 'skip fresh' WHEN recent AND max_date >= DATE '{TARGET}' THEN 'skip recent_attempt' WHEN recent AND cov AND NOT late THEN 'skip defer_recent_attempt' WHEN wb AND cov AND early THEN 'tail stale_max_date' WHEN wb AND cov AND late THEN 'head incomplete_early_history'
  WHEN wb AND cov AND recent THEN 'skip recent_attempt' WHEN wb AND cov THEN 'skip fresh' WHEN wb AND late THEN 'head incomplete_early_history' WHEN max_date IS NULL THEN 'full missing_max_date' WHEN early AND w THEN 'tail stale_max_date' WHEN early THEN 'full stale_max_date'
  WHEN late THEN 'head incomplete_early_history' WHEN age > lim THEN 'full stale_max_date' WHEN recent THEN 'skip recent_attempt' ELSE 'skip fresh' END AS m FROM c),
plan AS (SELECT symbol, section, split_part(m, ' ', 1) AS mode, split_part(m, ' ', 2) AS reason, split_part(m, ' ', 2) IN ('missing', 'below_min_historical_date', 'upgrade_panel_schema') AS full_refresh,
  CASE split_part(m, ' ', 1) WHEN 'full' THEN s WHEN 'head' THEN s WHEN 'tail' THEN greatest(s, max_date - 5) END AS fetch_start, CASE split_part(m, ' ', 1) WHEN 'full' THEN DATE '{TARGET}' WHEN 'tail' THEN DATE '{TARGET}' WHEN 'head' THEN min_date - 1 END AS fetch_end FROM r)"""

_PLAN = f"{STATES}, {LADDER}"


def _gap_plan(spark, sf):
    return p.gap_plan(states(spark, sf), target(), now(), snapshots=("management",))


@query("s34_gap_plan", f"WITH {_PLAN} SELECT * FROM plan", dates=["fetch_start", "fetch_end"])
def s34(spark, sf):
    return _gap_plan(spark, sf).select("symbol", "section", "mode", "reason", "full_refresh", "fetch_start", "fetch_end")


@query("s27_s34_fetch_ranges", f"WITH {_PLAN}, d AS (SELECT symbol, mode, fetch_end, unnest(generate_series(fetch_start, fetch_end, INTERVAL 365 DAY))::DATE AS first_day FROM plan WHERE mode <> 'skip' AND fetch_start <= fetch_end) SELECT symbol, mode, first_day, least(first_day + 364, fetch_end) AS last_day FROM d", dates=["first_day", "last_day"])
def s27(spark, sf):
    return p.fetch_ranges(_gap_plan(spark, sf), ("symbol",)).withColumnsRenamed({"start": "first_day", "end": "last_day"})


_missing = "coalesce(row_count, 0) <= 0"
_lately = f"last_fetched > TIMESTAMP '{NOW}' - INTERVAL 24 HOUR"


def _needs(kind: str, *rungs: tuple[str, str], recent: str | None = _lately, rows: str = "st") -> str:
    tests = " ".join(f"WHEN {t} THEN '{w}'" for t, w in rungs)
    lately = f"WHEN {recent} THEN 'recent_attempt' " if recent else ""
    why = f"CASE {tests} {lately}ELSE 'fresh' END"
    return f"SELECT '{kind}' AS predicate, symbol, {why} NOT IN ('recent_attempt', 'fresh') AS needs_update, {why} AS update_reason FROM {rows}"


_old, _nolast, _early = ("min_date < DATE '1900-01-01'", "below_min_historical_date"), ("max_date IS NULL", "missing_max_date"), (f"max_date < DATE '{TARGET}'", "stale_max_date")
_aged = ("DATE '2001-11-05' - max_date > 90", "stale_max_date")


@query("s35_all_predicates", f"""WITH {STATES} {_needs('price', (_missing, 'missing'), _old, _nolast, _early)} UNION ALL {_needs('fundamental', (_missing, 'missing'), _nolast, _aged)}
UNION ALL {_needs('macro', (_missing, 'missing'), ("min_date > DATE '1995-06-01'", 'incomplete_early_history'), _old, _nolast, _early)}
UNION ALL {_needs('profile', ('row_count = 0', 'missing'), ('last_fetched IS NULL', 'missing_fetched_at'), (f"last_fetched <= TIMESTAMP '{NOW}' - INTERVAL 720 HOUR", 'stale_profile'), recent=None)}
UNION ALL {_needs('disclosure', (_missing, 'missing'), _old, (_LACKS, 'upgrade_panel_schema'), ('year(min_date) > 1996', 'incomplete_history'), _nolast, _aged, rows="st WHERE section = 'etf_nport_disclosure'")}""", dates=[])  # fmt: skip
def s35(spark, sf):
    s = states(spark, sf)
    profiles = s.filter("row_count > 0").select("symbol", F.col("last_fetched").alias("fetched_at"))
    each = {
        "price": p.price_needs_update(s, target(), now()), "fundamental": p.fundamental_needs_update(s, now()), "macro": p.macro_needs_update(s, target(), now(), history_start=F.lit("1995-06-01").cast("date")),
        "profile": p.profile_needs_update(s.select("symbol"), profiles, now()), "disclosure": p.disclosure_needs_update(s.filter("section = 'etf_nport_disclosure'"), now(), start_year=1995),
    }
    out = None
    for kind, rows in each.items():
        some = rows.select(F.lit(kind).alias("predicate"), "symbol", "needs_update", "update_reason")
        out = some if out is None else out.unionByName(some)
    return out


@query("s35_macro_and_fresh_symbols", f"""WITH {STATES}, m AS (SELECT ['GDP', 'CPI', 'unemploymentRate'][(substr(symbol, 2)::INT) % 3 + 1] AS series, substr(symbol, 2)::INT // 3 AS g, * FROM st), w(series) AS (VALUES ('GDP'), ('CPI')),
n AS (SELECT coalesce(bool_or(coalesce(row_count, 0) <= 0 OR min_date > DATE '1900-01-01' OR min_date < DATE '1900-01-01' OR max_date IS NULL OR max_date < DATE '{TARGET}'), false) AS b FROM w LEFT JOIN m USING (series))
SELECT symbol, (SELECT b FROM n) AS macro_needed FROM st WHERE section = 'prices' AND provider IN ('p0', 'p1') AND max_date >= DATE '{TARGET}'""", dates=[])
def s35_more(spark, sf):
    s = states(spark, sf)
    n = F.substring("symbol", 2, 20).cast("int")
    macro = s.withColumns({"symbol": F.element_at(F.array(*[F.lit(x) for x in ("GDP", "CPI", "unemploymentRate")]), n % 3 + 1), "section": F.lit("macro_economic")})
    needed = p.macro_backfill_needed(macro, target(), now(), series=("GDP", "CPI"), treasury=False)
    return p.fresh_symbols(s, target(), ("p0", "p1")).crossJoin(needed.withColumnRenamed("needs_backfill", "macro_needed"))  # one row


_code = "CASE upper(country) " + " ".join(f"WHEN '{k}' THEN '{c}'" for k, c in COUNTRIES.items()) + " ELSE upper(country) END"


@query("s28_profile_rows", f"""WITH {PROFILES} SELECT symbol, {_code} AS country, sector AS name, market_cap, CASE WHEN exchange = 'NYSE' THEN DATE '1990-05-01' WHEN exchange = 'NASDAQ' THEN DATE '1991-02-03' END AS listing_date FROM profiles""", dates=["listing_date"], floats=["market_cap"])
def s28(spark, sf):
    payload = F.when(F.col("exchange") == "NYSE", '{"ipoDate": "1990-05-01"}').when(F.col("exchange") == "NASDAQ", '{"ipoDate": "no day", "listingDate": "1991-02-03T00:00"}').otherwise("broken {")
    raw = profiles(spark, sf).select(F.lower("symbol").alias("symbol"), F.lit(" ").alias("countryCode"), F.initcap("country").alias("country_name"), F.col("sector").alias("companyName"), F.col("market_cap").cast("string").alias("mktCap"), payload.alias("payload"))
    return p.profile_rows(raw, COUNTRIES, names={"country": ("countryCode", "country_name"), "name": ("name", "companyName"), "market_cap": ("marketCap", "mktCap")})


@query("s42_listings", f"WITH {STATES}, u AS (SELECT concat('C', substr(symbol, 2)::INT % 50) AS symbol, provider, section, row_count FROM st) SELECT symbol, string_agg(DISTINCT provider, ',' ORDER BY provider) AS providers, string_agg(DISTINCT section, ',' ORDER BY section) AS sections FROM u WHERE row_count > 0 GROUP BY ALL", dates=[])
def s42(spark, sf):
    s = states(spark, sf).withColumn("symbol", F.concat(F.lit("C"), F.substring("symbol", 2, 20).cast("int") % 50))
    return p.listings(s)


@query("v09_coverage_mask_of_columns", f"WITH {RET} SELECT symbol, date, ((r IS NOT NULL)::INT + (close IS NOT NULL)::INT + 0) / 3.0::DOUBLE >= 0.5 AS covered FROM r")
def v09(spark, sf):
    r = returns(prices(spark, sf), (1,)).withColumn("nothing", F.lit(None).cast("double"))
    return r.select("symbol", "date", v.coverage_mask(r, ("px__ret_1d", "close", "nothing", "not_there")).alias("covered"))


@query("l16_collapsed_targets", f"WITH {PRICES}, {TYPED}, d AS (SELECT symbol, event_date AS date, max((event_type IN ('insider_buy', 'congress_buy'))::INT) AS target_bullish FROM typed GROUP BY ALL) SELECT p.symbol, p.date, coalesce(target_bullish, 0) AS target_bullish, (d.symbol IS NOT NULL)::INT AS active FROM prices p LEFT JOIN d USING (symbol, date)")
def l16(spark, sf):
    return e.collapsed_target(prices(spark, sf).select("symbol", "date"), typed(spark, sf).withColumnRenamed("event_date", "date"), ("insider_buy", "congress_buy"), "target_bullish")


@query("o07_ranker_columns", f"WITH {CHAIN} SELECT underlying, snapshot_date, part, volume AS volume, (ask - bid) / nullif((ask + bid) / 2, 0) AS spread_pct FROM chain", dates=["snapshot_date"], floats=["volume", "spread_pct"])
def o07(spark, sf):
    """The contracts with the features a ranker can use: of five there two have values."""
    c = chain(spark, sf).withColumns({"spread_pct": F.try_divide(F.col("ask") - F.col("bid"), F.nullif((F.col("ask") + F.col("bid")) / 2, F.lit(0.0))), "open_interest": F.lit(None).cast("double"), "iv": F.lit("n/a"), "vega": F.lit(None).cast("string")})
    return c.select("underlying", "snapshot_date", "part", *o.ranker_features(c))


@query("o17_window_snapshots", f"WITH {TRADES}, w AS (SELECT DISTINCT unnest(generate_series(entry_date, exit_date, INTERVAL 1 DAY))::DATE AS d FROM td WHERE exit_date IS NOT NULL AND symbol IN (SELECT min(symbol) FROM td)) SELECT underlying, snapshot_date, count(*) AS n FROM chain WHERE snapshot_date IN (SELECT d FROM w WHERE isodow(d) < 6) GROUP BY ALL", dates=["snapshot_date"])
def o17(spark, sf):
    """Quotes of all underlyings on the weekdays of the first underlying's trades."""
    t = daily_trades(spark, sf)
    days = o.window_days(t.join(t.agg(F.min("symbol").alias("symbol")), "symbol")).select(F.col("date").alias("snapshot_date")).distinct()
    return o.at_snapshots(chain(spark, sf), days).groupBy("underlying", "snapshot_date").agg(F.count("*").alias("n"))


@query("s41_states_by_registry", f"""WITH {STATES}, g(section, library, kind, windowed, dimension) AS (VALUES ('prices', 'prices', 'price', true, NULL), ('income', 'fundamental_income', 'period', true, NULL), ('filings', 'fundamental_filings', 'dated', true, 'report_type'), ('etf_nport_disclosure', 'etf_nport_disclosure', 'dated', false, 'cusip'),
  ('dividends', 'fundamental_dividends', 'dated', true, NULL), ('management', 'fundamental_management', 'snapshot', false, NULL), ('etf_prices', 'etf_prices', 'price', true, NULL))
SELECT library, kind, windowed, dimension, count(*) AS states, sum(row_count)::BIGINT AS rows FROM st JOIN g USING (section) GROUP BY ALL""", dates=[])  # fmt: skip
def s41(spark, sf):
    """What is stored, by the sections' entries in the registry."""
    rows = states(spark, sf).join(F.broadcast(specs.registry(spark)), "section")
    return rows.groupBy("library", "kind", "windowed", "dimension").agg(F.count("*").alias("states"), F.sum("row_count").alias("rows"))


@query("s13_upsert_by_order", f"WITH {STATES}, x AS (SELECT section, provider, max(substr(symbol, 2)::INT) AS n FROM st GROUP BY ALL) SELECT section, provider, concat('C', n) AS symbol FROM x", dates=[])
def s13(spark, sf):
    """Of many rows of one key in a batch the last by their number wins, whatever their other values are."""
    s = states(spark, sf).select("section", "provider", "symbol", F.substring("symbol", 2, 20).cast("int").alias("n"))
    return upsert(s.filter("n % 2 = 0"), s, ("section", "provider"), order=("n",)).select("section", "provider", "symbol")


@query("s40_s46_saved_features", f"WITH {RET} SELECT symbol, date, r AS px__ret_1d, 'kept' AS recipe_is FROM r WHERE date BETWEEN DATE '1996-01-01' AND DATE '1999-12-31'", floats=["px__ret_1d"])
def s46(spark, sf):
    """Features of two recipes in one table, of which one is written again; read back by recipe and days, and saved as CSV."""
    path, p = f"{shared_folder(spark)}/features-{uuid.uuid4().hex[:12]}", prices(spark, sf)
    features = returns(p, (1,)).select("symbol", "date", "px__ret_1d")
    kept, other = {"set": "returns", "n": 1}, {"set": "returns", "n": 2}
    for recipe, rows in ((kept, features.withColumn("px__ret_1d", F.lit(7.0))), (other, features.withColumn("px__ret_1d", F.lit(9.0))), (kept, features)):
        tables.write_features(rows, path, recipe)
    found = tables.read_features(spark, path, kept, start="1996-01-01", end="1999-12-31")
    tables.save(found, f"{path}-csv", "csv")
    return spark.read.option("header", True).schema(found.schema).csv(f"{path}-csv").withColumn("recipe_is", F.lit("kept"))


@query("s43_economic_series", f"WITH {MACRO} SELECT series_code, date, value FROM macro WHERE value IS NOT NULL", floats=["value"], digits=2)
def s43(spark, sf):
    """Each series without a column of that name: the first numeric one is its value."""
    m = macro(spark, sf)
    out = None
    for code in (r.series_code for r in m.select("series_code").distinct().collect()):  # a row a series
        rows = economic_series(m.filter(F.col("series_code") == code).select("date", F.col("series_code").alias("name"), F.col("value").alias("level"))).withColumn("series_code", F.lit(code))
        out = rows if out is None else out.unionByName(rows)
    return out.select("series_code", "date", "value")


@plugins.register_feature_builder("range_share", "up__range double, up__mean_3 double")
def _range_share(symbol: str, frame: pd.DataFrame) -> pd.DataFrame:
    share = (frame["high"] - frame["low"]) / frame["close"]
    return pd.DataFrame({"up__range": share, "up__mean_3": share.rolling(3).mean()})


@query("u01_plugin_features", f"WITH {PRICES}, s AS (SELECT symbol, date, (high - low) / close AS x FROM prices) SELECT symbol, date, x AS up__range, CASE WHEN count(x) OVER w = 3 THEN avg(x) OVER w END AS up__mean_3 FROM s WINDOW w AS (PARTITION BY symbol ORDER BY date ROWS 2 PRECEDING)", floats=["up__range", "up__mean_3"])
def u01(spark, sf):
    """A feature builder of the user's own."""
    return plugins.build_features(prices(spark, sf), "range_share")
