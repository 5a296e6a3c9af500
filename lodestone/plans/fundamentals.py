"""Queries of calendar, fundamental and ownership features."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from lodestone.operators import event_features as ev
from lodestone.operators import fundamental as f
from lodestone.plans.events import TYPED, typed
from lodestone.plans.registry import query
from lodestone.views import EVENTS, PRICES, STATEMENTS, prices, raw_events, statements, table

DAILY = f"""{PRICES}, {STATEMENTS}, lagged AS (SELECT * REPLACE (period_ending + 45 AS period_ending) FROM statements),
daily AS (SELECT p.symbol, p.date, p.close, s.revenue, s.cost, s.net_income, s.shares, s.debt, s.cash FROM prices p ASOF LEFT JOIN lagged s ON p.symbol = s.symbol AND p.date >= s.period_ending)"""


def daily(spark, sf):
    return f.daily_statements(prices(spark, sf).select("symbol", "date", "close"), statements(spark, sf)).drop("period_ending")


_time = "year(date)::INT AS time__year, quarter(date)::INT AS time__quarter, month(date)::INT AS time__month, weekofyear(date)::INT AS time__week, day(date)::INT AS time__day, dayofyear(date)::INT AS time__day_of_year, (isodow(date) - 1)::INT AS time__weekday, (day(date) = 1)::INT AS time__is_month_start, (date = last_day(date))::INT AS time__is_month_end, (date = last_day(date) AND month(date) % 3 = 0)::INT AS time__is_quarter_end"


@query("f01_time_features", f"SELECT date, {_time}, {', '.join(f'(isodow(date) = {i + 1})::INT AS time__weekday_{i}' for i in range(7))}, {', '.join(f'(month(date) = {i})::INT AS time__month_{i}' for i in range(1, 13))} FROM (SELECT DISTINCT cast(l_shipdate AS DATE) AS date FROM lineitem)")
def f01(spark, sf):
    return f.time_features(spark.read.parquet(f"{sf}/lineitem.parquet").select(F.to_date("l_shipdate").alias("date")).distinct())


@query("f02_f22_event_distances", f"""WITH {PRICES}, {EVENTS}, e AS (SELECT DISTINCT symbol, event_date FROM raw_events), a AS (SELECT p.symbol, p.date, e.event_date AS x FROM prices p ASOF LEFT JOIN e ON p.symbol = e.symbol AND p.date >= e.event_date),
b AS (SELECT a.*, e.event_date AS y FROM a ASOF LEFT JOIN e ON a.symbol = e.symbol AND a.date <= e.event_date) SELECT symbol, date, cast(date - x AS INTEGER) AS days_since_last, cast(y - date AS INTEGER) AS days_until_next FROM b""")  # fmt: skip
def f02(spark, sf):
    return f.event_distances(prices(spark, sf).select("symbol", "date"), raw_events(spark, sf))


@query("f03_days_after_listing", f"WITH {PRICES} SELECT symbol, date, CASE WHEN date >= DATE '1996-05-05' THEN cast(date - DATE '1996-05-05' AS INTEGER) END AS days_after_ipo FROM prices")
def f03(spark, sf):
    p = prices(spark, sf).select("symbol", "date")
    return f.days_after_listing(p, p.select("symbol").distinct().withColumn("listing_date", F.lit("1996-05-05").cast("date")))


@query("f08_f12_price_linked", f"WITH {DAILY} SELECT symbol, date, shares * close AS market_cap, revenue / nullif(shares * close, 0) AS revenue_to_mcap, net_income / nullif(shares * close, 0) AS net_income_to_mcap, -cost / nullif(shares * close, 0) AS cost_to_mcap FROM daily", floats=["market_cap", "revenue_to_mcap", "net_income_to_mcap", "cost_to_mcap"], digits=4)
def f08(spark, sf):
    return f.price_linked(daily(spark, sf), ("revenue", "net_income", "cost"), negate=("cost",)).select("symbol", "date", "market_cap", "revenue_to_mcap", "net_income_to_mcap", "cost_to_mcap")


@query("f09_growth_adjusted", f"""WITH {PRICES}, g AS (SELECT symbol, date, close / volume AS v, close / lag(close, 20) OVER (PARTITION BY symbol ORDER BY date) - 1 AS g FROM prices), m AS (SELECT symbol, median(abs(g)) AS m FROM g GROUP BY ALL)
SELECT symbol, date, CASE WHEN g > 0 THEN v / (CASE WHEN m <= 2 THEN g * 100 ELSE g END) END AS peg FROM g JOIN m USING (symbol)""", floats=["peg"], digits=4)  # fmt: skip
def f09(spark, sf):
    from lodestone.operators.technical import returns

    rows = returns(prices(spark, sf), (20,)).select("symbol", "date", (F.col("close") / F.col("volume")).alias("v"), F.col("px__ret_20d").alias("g"))
    return f.growth_adjusted(rows, "v", "g", "peg").select("symbol", "date", "peg")


def _asof(columns: str, since: str) -> str:
    """The latest sparse row known on each day and the days since."""
    return f"SELECT p.symbol, p.date, {columns}, (p.date - r.date)::DOUBLE AS {since} FROM prices p ASOF LEFT JOIN r ON p.symbol = r.symbol AND p.date >= r.date"


_earn = ["evt__earn_eps_surprise", "evt__earn_rev_surprise", "evt__earn_beat_flag", "evt__earn_beat_streak_4", "evt__earn_days_since", "earn__epsactual"]


@query("f17_surprises", f"""WITH {PRICES}, {STATEMENTS}, x AS (SELECT symbol, period_ending AS date, CASE WHEN month(period_ending) <> 6 THEN net_income / shares END AS a, lag(net_income / shares) OVER w AS e, revenue AS ra, lag(revenue) OVER w AS re FROM statements WINDOW w AS (PARTITION BY symbol ORDER BY period_ending)),
y AS (SELECT *, coalesce(a >= e, false)::INT::DOUBLE AS f FROM x), r AS (SELECT *, sum(f) OVER (PARTITION BY symbol ORDER BY date ROWS 3 PRECEDING) AS k FROM y)
{_asof("(a - e) / nullif(abs(e), 0) AS evt__earn_eps_surprise, (ra - re) / nullif(abs(re), 0) AS evt__earn_rev_surprise, f AS evt__earn_beat_flag, k AS evt__earn_beat_streak_4, a AS earn__epsactual", "evt__earn_days_since")}""", floats=_earn, digits=4)  # fmt: skip
def f17(spark, sf):
    """Second quarters come without a figure."""
    w = Window.partitionBy("symbol").orderBy("period_ending")
    s = statements(spark, sf).withColumn("eps", F.col("net_income") / F.col("shares"))
    r = s.select("symbol", F.col("period_ending").alias("date"), F.when(F.month("period_ending") != 6, F.col("eps")).cast("string").alias("epsActual"), F.lag("eps").over(w).alias("epsEstimated"), F.col("revenue").alias("revenueActual"), F.lag("revenue").over(w).alias("revenueEstimated"))
    return ev.earnings_features(prices(spark, sf).select("symbol", "date"), r).select("symbol", "date", *_earn)


_ae = ["evt__ae_eps_avg", "evt__ae_revenue_avg", "evt__ae_eps_rev_qoq", "evt__ae_revenue_rev_qoq", "evt__ae_days_since", "ae__forward_eps_to_price_daily", "ae__forward_revenue_to_mcap_daily"]


@query("f18_estimate_changes", f"""WITH {PRICES}, {STATEMENTS}, r AS (SELECT symbol, period_ending AS date, net_income / shares AS e, revenue AS v, (net_income / shares) / nullif(lag(net_income / shares) OVER w, 0) - 1 AS ec, revenue / nullif(lag(revenue) OVER w, 0) - 1 AS vc FROM statements WINDOW w AS (PARTITION BY symbol ORDER BY period_ending))
{_asof("e AS evt__ae_eps_avg, v AS evt__ae_revenue_avg, ec AS evt__ae_eps_rev_qoq, vc AS evt__ae_revenue_rev_qoq, e / nullif(p.close, 0) AS ae__forward_eps_to_price_daily, v / nullif(p.close * p.volume, 0) AS ae__forward_revenue_to_mcap_daily", "evt__ae_days_since")}""", floats=_ae, digits=4)  # fmt: skip
def f18(spark, sf):
    p = prices(spark, sf)
    r = statements(spark, sf).select("symbol", F.col("period_ending").alias("date"), (F.col("net_income") / F.col("shares")).alias("epsAvg"), F.col("revenue").cast("string").alias("revenueAvg"))
    return ev.estimate_features(p.select("symbol", "date"), r, prices=p, market_cap=p.withColumn("market_cap", F.col("close") * F.col("volume"))).select("symbol", "date", *_ae)


_gr = ["evt__grade_bullish_ratio", "evt__grade_bearish_ratio", "evt__grade_net_bullish", "evt__grade_days_since", "evt__rating_score", "evt__rating_score_change", "evt__rating_days_since"]
_counts = ", ".join(f"count(*) FILTER (l_linenumber = {i})::DOUBLE AS n{i}" for i in range(1, 6))


@query("f19_grade_ratios", f"""WITH {PRICES}, r AS (SELECT concat('S', l_suppkey) AS symbol, date_trunc('month', l_shipdate)::DATE AS date, {_counts}, max(l_linenumber)::DOUBLE AS score FROM lineitem GROUP BY ALL), q AS (SELECT *, n1 + n2 + n3 + n4 + n5 AS n, lag(score) OVER (PARTITION BY symbol ORDER BY date) AS was FROM r)
SELECT p.symbol, p.date, (n1 + n2) / nullif(n, 0) AS evt__grade_bullish_ratio, (n4 + n5) / nullif(n, 0) AS evt__grade_bearish_ratio, (n1 + n2 - n4 - n5) / nullif(n, 0) AS evt__grade_net_bullish, (p.date - q.date)::DOUBLE AS evt__grade_days_since, score AS evt__rating_score, score - was AS evt__rating_score_change, (p.date - q.date)::DOUBLE AS evt__rating_days_since
FROM prices p ASOF LEFT JOIN q ON p.symbol = q.symbol AND p.date >= q.date""", floats=_gr)  # fmt: skip
def f19(spark, sf):
    """Grades and ratings of a month, and the bundle of both."""
    rows = table(spark, sf, "lineitem").groupBy(F.concat(F.lit("S"), "l_suppkey").alias("symbol"), F.trunc("l_shipdate", "month").alias("date"))
    counted = rows.agg(*[F.count_if(F.col("l_linenumber") == i).alias(c) for i, c in enumerate(ev.GRADES, 1)], F.max("l_linenumber").alias("overallScore"))
    grid = prices(spark, sf).select("symbol", "date")
    return ev.event_features(grid, ratings=counted.select("symbol", "date", "overallScore"), grades=counted.drop("overallScore")).select("symbol", "date", *_gr)


_ins = ["own__insider_net_buy_value_90d", "own__insider_buy_count_90d", "own__insider_sell_count_90d", "own__insider_buy_sell_ratio_90d", "own__insider_days_since"]


@query("f20_insider_activity", f"""WITH {PRICES}, t AS (SELECT concat('S', l_suppkey) AS symbol, cast(l_shipdate AS DATE) + 1 AS date, CASE l_returnflag WHEN 'A' THEN 1 WHEN 'R' THEN -1 ELSE 0 END AS s, CASE WHEN l_linenumber = 3 THEN 0 ELSE l_extendedprice / 1000 END AS px, l_quantity AS q FROM lineitem WHERE l_suppkey % 10 <> 7),
d AS (SELECT symbol, date, sum(s * px * q) AS v, count(*) FILTER (s > 0)::DOUBLE AS b, count(*) FILTER (s < 0)::DOUBLE AS s FROM t GROUP BY ALL), g AS (SELECT p.symbol, p.date, coalesce(v, 0) AS v, coalesce(b, 0) AS b, coalesce(s, 0) AS s FROM prices p LEFT JOIN d USING (symbol, date)),
w AS (SELECT symbol, date, sum(v) OVER w AS v, sum(b) OVER w AS b, sum(s) OVER w AS s FROM g WINDOW w AS (PARTITION BY symbol ORDER BY date ROWS 89 PRECEDING))
SELECT w.symbol, w.date, w.v AS own__insider_net_buy_value_90d, w.b AS own__insider_buy_count_90d, w.s AS own__insider_sell_count_90d, w.b / nullif(w.s, 0) AS own__insider_buy_sell_ratio_90d, (w.date - d.date)::DOUBLE AS own__insider_days_since FROM w ASOF LEFT JOIN d ON w.symbol = d.symbol AND w.date >= d.date""", floats=_ins, digits=4)  # fmt: skip
def f20(spark, sf):
    """Trades a day after the prices' days: some fall on days that the grid lacks; a tenth of the symbols has none."""
    kind = F.when(F.col("l_returnflag") == "A", "a").when(F.col("l_returnflag") == "R", "D")
    raw = table(spark, sf, "lineitem").filter("l_suppkey % 10 <> 7").select(F.concat(F.lit("S"), "l_suppkey").alias("symbol"), F.date_add("l_shipdate", 1).alias("date"), kind.alias("acquisitionOrDisposition"), F.when(F.col("l_linenumber") != 3, F.col("l_extendedprice") / 1000).alias("price"), F.col("l_quantity").alias("securitiesTransacted"))
    return ev.ownership_features(prices(spark, sf).select("symbol", "date"), insiders=raw).select("symbol", "date", *_ins)


@query("f21_position_changes", f"""WITH {PRICES}, {STATEMENTS}, r AS (SELECT symbol, period_ending AS date, shares AS h, shares - lag(shares) OVER w AS c, shares / nullif(lag(shares) OVER w, 0) - 1 AS pc FROM statements WINDOW w AS (PARTITION BY symbol ORDER BY period_ending))
{_asof("h AS ps__shares_held, c AS ps__shares_held_change, pc AS ps__shares_held_pct_change", "ps__days_since_report")}""", floats=["ps__shares_held", "ps__shares_held_change", "ps__shares_held_pct_change", "ps__days_since_report"])  # fmt: skip
def f21(spark, sf):
    raw = statements(spark, sf).select("symbol", F.col("period_ending").alias("date"), F.col("shares").alias("institutionalShares"))
    return ev.ownership_features(prices(spark, sf).select("symbol", "date"), positions=raw).select("symbol", "date", "ps__shares_held", "ps__shares_held_change", "ps__shares_held_pct_change", "ps__days_since_report")


_val = ", ".join(f"{i} / nullif(cap, 0) AS {i}_yield, cap / nullif({i}, 0) AS {i}_multiple, {i} / nullif(ev, 0) AS {i}_ev_yield" for i in ("revenue", "net_income"))
_val_names = [f"{i}_{k}" for i in ("revenue", "net_income") for k in ("yield", "multiple", "ev_yield")]


@query("f24_f25_f28_valuation_panel", f"WITH {DAILY}, v AS (SELECT *, shares * close AS cap, shares * close + coalesce(debt, 0) - coalesce(cash, 0) AS ev FROM daily) SELECT symbol, date, {_val} FROM v", floats=_val_names, digits=4)
def f24(spark, sf):
    return f.valuation_panel(daily(spark, sf), ("revenue", "net_income")).select("symbol", "date", *_val_names)


_ft = ["ft__gross_margin", "ft__operating_margin", "ft__net_margin", "ft__return_on_equity", "ft__return_on_assets", "ft__fcf_margin", "ft__revenue_growth_qoq"]


@query("f29_statement_ratios", f"""WITH {STATEMENTS} SELECT symbol, period_ending AS date, (revenue - cost) / nullif(revenue, 0) AS ft__gross_margin, (net_income - debt) / nullif(revenue, 0) AS ft__operating_margin, net_income / nullif(revenue, 0) AS ft__net_margin, net_income / nullif(cash, 0) AS ft__return_on_equity,
net_income / nullif(revenue + cost, 0) AS ft__return_on_assets, debt / nullif(revenue, 0) AS ft__fcf_margin, revenue / nullif(lag(revenue) OVER (PARTITION BY symbol ORDER BY period_ending), 0) - 1 AS ft__revenue_growth_qoq FROM statements""", floats=_ft)  # fmt: skip
def f29(spark, sf):
    s = statements(spark, sf).withColumns({"gross_profit": F.col("revenue") - F.col("cost"), "operating_income": F.col("net_income") - F.col("debt"), "total_equity": F.col("cash"), "total_assets": F.col("revenue") + F.col("cost"), "free_cash_flow": F.col("debt")})
    return f.statement_ratios(s).select("symbol", F.col("period_ending").alias("date"), *_ft)


# Items of the vendor's statements from the figures there are; a third of the balances lacks cash, market caps are known on Mondays only.
_SEC = f"""{PRICES}, {STATEMENTS}, sec AS (SELECT symbol, period_ending + 45 AS known, revenue, revenue - cost AS gross_profit, net_income AS ebit, debt AS free_cash_flow, revenue + cost AS equity, CASE WHEN month(period_ending) % 9 <> 0 THEN cash END AS cash, debt AS total_debt, revenue + cost - cost / 2 - debt / 4 AS tangible FROM statements),
mc AS (SELECT symbol, date, close * 1000 AS market_cap FROM prices WHERE isodow(date) = 1), d0 AS (SELECT p.symbol, p.date, s.* EXCLUDE (symbol, known) FROM prices p ASOF LEFT JOIN sec s ON p.symbol = s.symbol AND p.date >= s.known),
d AS (SELECT d0.*, mc.market_cap AS cap, CASE WHEN coalesce(mc.market_cap, total_debt, cash) IS NOT NULL THEN coalesce(mc.market_cap, 0) + coalesce(total_debt, 0) - coalesce(cash, 0) END AS ev FROM d0 ASOF LEFT JOIN mc ON d0.symbol = mc.symbol AND d0.date >= mc.date)"""
_items = {"revenue": ("revenue", True), "gross_profit": ("gross_profit", True), "ebit": ("ebit", True), "free_cash_flow": ("free_cash_flow", True), "book_equity": ("equity", False), "tangible_book": ("tangible", False), "cash": ("cash", False), "total_debt": ("total_debt", False)}
_daily_sql = ", ".join(
    f"{x} / nullif(cap, 0) AS fmp_daily_mcap_yield__{i}_to_mcap, cap / nullif({x}, 0) AS fmp_daily_mcap_multiple__mcap_to_{i}" + (f", {x} / nullif(ev, 0) AS fmp_daily_ev_yield__{i}_to_ev, ev / nullif({x}, 0) AS fmp_daily_ev_multiple__ev_to_{i}" if e else "") for i, (x, e) in _items.items()
)
_daily_names = [c.split(" AS ")[1] for c in _daily_sql.split(", ") if " AS " in c]


@query("f24_daily_valuation", f"WITH {_SEC} SELECT symbol, date, ev AS enterprise_value, {_daily_sql} FROM d", floats=["enterprise_value", *_daily_names], digits=4)
def f24_daily(spark, sf):
    st, p = statements(spark, sf), prices(spark, sf)
    sections = {
        "income": st.select("symbol", "period_ending", "revenue", (F.col("revenue") - F.col("cost")).alias("gross_profit"), F.col("net_income").cast("string").alias("ebit")), "cash": st.select("symbol", "period_ending", F.col("debt").alias("free_cash_flow")),
        "balance": st.select("symbol", "period_ending", (F.col("revenue") + F.col("cost")).alias("total_stockholders_equity"), (F.col("cost") / 2).alias("goodwill"), (F.col("debt") / 4).alias("intangible_assets"), F.when(F.month("period_ending") % 9 != 0, F.col("cash")).alias("cash_and_cash_equivalents"), F.col("debt").alias("total_debt")),
    }
    caps = p.filter(F.weekday("date") == 0).select("symbol", "date", (F.col("close") * 1000).alias("market_cap"))
    return f.daily_valuation(p, caps, sections)[0].select("symbol", "date", "enterprise_value", *_daily_names)


_quality = {"static_pe": "revenue / cost", "static_dividend_yield": "cash / revenue", "static_ev_to_sales": "debt / revenue", "asof_current_ratio": "revenue / nullif(debt, 0)", "asof_return_on_equity": "CASE WHEN month(period_ending) = 3 THEN net_income / revenue END"}


@query("f27_quality_panel", f"""WITH {PRICES}, {STATEMENTS}, r AS (SELECT symbol, period_ending + 45 AS known, {', '.join(f'{x} AS {n}' for n, x in _quality.items())} FROM statements), d AS (SELECT p.symbol, p.date, r.* EXCLUDE (symbol, known) FROM prices p ASOF LEFT JOIN r ON p.symbol = r.symbol AND p.date >= r.known)
SELECT symbol, date, {', '.join(f'CASE WHEN count({n}) OVER (PARTITION BY symbol) >= 120 THEN {n} END AS {n}' for n in _quality)} FROM d""", floats=list(_quality))  # fmt: skip
def f27_quality(spark, sf):
    """A control that is reported once a year has too few values for some symbols."""
    st = statements(spark, sf)
    over = lambda a, c: F.try_divide(F.col(a), F.nullif(F.col(c), F.lit(0.0)))
    ratios = st.select("symbol", "period_ending", over("revenue", "cost").alias("price_to_earnings"), over("cash", "revenue").alias("dividend_yield"), over("revenue", "debt").alias("current_ratio"))
    metrics = st.select("symbol", "period_ending", over("debt", "revenue").alias("ev_to_sales"), F.when(F.month("period_ending") == 3, over("net_income", "revenue")).alias("return_on_equity"))
    return f.quality_panel(prices(spark, sf), {"ratios": ratios, "metrics": metrics})[0].select("symbol", "date", *_quality)


@query("f30_cap_features", f"""WITH {DAILY}, u AS (SELECT date, 'revenue' AS feature, revenue AS v FROM daily UNION ALL SELECT date, 'cost', cost FROM daily UNION ALL SELECT date, 'shares', shares FROM daily UNION ALL SELECT date, 'close', close FROM daily),
d AS (SELECT feature, date, count(v) AS n, count(*) AS a, var_samp(v) AS v FROM u GROUP BY ALL), e AS (SELECT feature, sum(n) / sum(a)::DOUBLE AS coverage, avg(v) AS variance FROM d GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY feature IN ('shares', 'close') ORDER BY coverage DESC, variance DESC NULLS LAST, feature) AS rank FROM e)
SELECT feature, coverage, cast(rank AS INTEGER) AS rank, CASE WHEN feature IN ('shares', 'close') THEN 'market' ELSE 'income' END AS family FROM r WHERE rank <= 1""", floats=["coverage"], dates=[])  # fmt: skip
def f30(spark, sf):
    return f.cap_by_quality(daily(spark, sf), {"revenue": "income", "cost": "income", "shares": "market", "close": "market"}, 1).select("feature", "coverage", "rank", "family")


@query("f31_coverage_report", f"""WITH {DAILY}, g AS (SELECT *, date - lag(date) OVER (PARTITION BY symbol ORDER BY date) AS gap FROM daily), m AS (SELECT symbol, gap, row_number() OVER (PARTITION BY symbol ORDER BY count(*) DESC, gap) AS k FROM g WHERE gap IS NOT NULL GROUP BY symbol, gap)
SELECT symbol, count(revenue) AS n_revenue, count(close) AS n_close, min(date) AS first_date, max(date) AS last_date, median(g.gap)::DOUBLE AS median_gap, cast(any_value(m.gap) AS INTEGER) AS mode_gap FROM g JOIN m USING (symbol) WHERE m.k = 1 GROUP BY ALL""", dates=["first_date", "last_date"])  # fmt: skip
def f31(spark, sf):
    return f.coverage_report(daily(spark, sf), ("revenue", "close"))


@query("j10_f16_merge_features", f"WITH {DAILY} SELECT p.symbol, p.date, d.shares, p.volume * 2 AS volume FROM prices p JOIN daily d USING (symbol, date)", floats=["shares"])
def j10(spark, sf):
    p = prices(spark, sf)
    return f.merge_features(p.select("symbol", "date"), [p.select("symbol", "date", "volume"), daily(spark, sf).select("symbol", "date", "shares"), p.select("symbol", "date", (F.col("volume") * 2).alias("volume"))])
