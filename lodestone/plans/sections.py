"""Queries of sections of fundamental data, event builders and joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from lodestone.operators import builders as b
from lodestone.operators import event_features as ev
from lodestone.operators import events as e
from lodestone.operators import fundamental as f
from lodestone.operators import joins as j
from lodestone.operators import sections as s
from lodestone.operators import specs
from lodestone.plans.registry import query
from lodestone.views import CHAIN, PRICES, PROFILES, STATEMENTS, chain, prices, profiles, statements, table

# A statement section in vendor names: the same figures, and a text column of numbers and one of words.
INCOME = f"{PRICES}, {STATEMENTS}, sec AS (SELECT symbol, period_ending + 45 AS known, revenue AS Revenue, revenue - cost AS grossProfit, net_income AS netIncome, shares AS weightedAverageShsOut, shares * 1.1::DOUBLE AS weightedAverageShsOutDil, net_income / shares AS eps FROM statements)"
DAILY = "daily AS (SELECT p.symbol, p.date, p.close, sec.* EXCLUDE (symbol, known) FROM prices p ASOF LEFT JOIN sec ON p.symbol = sec.symbol AND p.date >= sec.known)"


def income(spark, sf):
    st = statements(spark, sf)
    return st.select("symbol", "period_ending", F.col("revenue").alias("Revenue"), (F.col("revenue") - F.col("cost")).alias("grossProfit"), F.col("net_income").alias("netIncome"), F.col("shares").alias("weightedAverageShsOut"), (F.col("shares") * 1.1).alias("weightedAverageShsOutDil"), (F.col("net_income") / F.col("shares")).alias("eps"))


@query("f04_section_rows", f"WITH {STATEMENTS} SELECT symbol, period_ending + 30 AS date, revenue AS is__revenue, cost AS is__cost, 'USD' AS is__reportedcurrency FROM statements", floats=["is__revenue", "is__cost"], digits=2)
def f04(spark, sf):
    raw = statements(spark, sf).select("symbol", "period_ending", F.col("revenue").cast("string").alias("Revenue"), F.col("cost").alias("COST"), F.lit("USD").alias("reportedCurrency"), F.col("debt").alias("debt"))
    return s.section_rows(raw.unionAll(raw), "is__", keep=("revenue", "cost", "reportedcurrency"), lag=30)


_names = ["is__revenue", "is__grossprofit", "is__netincome", "is__weightedaverageshsout", "is__eps", "is__eps_to_price_daily", "is__revenue_to_mcap_daily", "is__grossprofit_to_mcap_daily", "is__netincome_to_mcap_daily"]
_cap = "nullif(weightedAverageShsOutDil * close, 0)"


@query("f06_f08_f12_income_section", f"""WITH {INCOME}, {DAILY} SELECT symbol, date, Revenue AS is__revenue, grossProfit AS is__grossprofit, netIncome AS is__netincome, weightedAverageShsOut AS is__weightedaverageshsout, eps AS is__eps,
eps / nullif(close, 0) AS is__eps_to_price_daily, Revenue / {_cap} AS is__revenue_to_mcap_daily, grossProfit / {_cap} AS is__grossprofit_to_mcap_daily, netIncome / {_cap} AS is__netincome_to_mcap_daily FROM daily""", floats=_names, digits=3)  # fmt: skip
def f12(spark, sf):
    """The income section on each day with its linked ratios; ratios of items that the section lacks are left out."""
    return s.linked_ratios(prices(spark, sf), s.section_rows(income(spark, sf), "is__"), "is__", s.INCOME, shares=s.INCOME_SHARES).select("symbol", "date", *_names)


_cf = ["cf__operatingcashflow_to_mcap_daily", "cf__freecashflow_to_mcap_daily", "cf__capex_to_mcap_daily"]


# Statements of cash flows and balances hold no shares: the market cap is the income statement's diluted shares times close.
_known = "sec AS (SELECT symbol, period_ending + 45 AS known, cash, debt, cost, revenue, shares * 1.1::DOUBLE AS shares FROM statements)"


def cash_flow(spark, sf):
    return statements(spark, sf).select("symbol", "period_ending", F.col("cash").alias("netCashProvidedByOperatingActivities"), F.col("debt").alias("freeCashFlow"), F.col("cost").alias("capitalExpenditure"))


def balance(spark, sf):
    st = statements(spark, sf)
    return st.select("symbol", "period_ending", F.col("cash").alias("cashAndCashEquivalents"), F.col("debt").alias("totalDebt"), (F.col("debt") - F.col("cash")).alias("netDebt"), F.col("revenue").alias("totalEquity"), (F.col("revenue") + F.col("cost")).alias("totalAssets"))


def _over_cap(spark, sf, raw, prefix, specs, names):
    p = prices(spark, sf)
    cap = ev.market_cap_of(p, s.section_rows(income(spark, sf), "is__"), "is__")
    return s.linked_ratios(p, s.section_rows(raw, prefix), prefix, specs, shares=(), market_cap=cap).select("symbol", "date", *names)


_cash_sql = "cash / nullif(shares * close, 0) AS cf__operatingcashflow_to_mcap_daily, debt / nullif(shares * close, 0) AS cf__freecashflow_to_mcap_daily, -cost / nullif(shares * close, 0) AS cf__capex_to_mcap_daily"
_balance_sql = """cash / nullif(shares * close, 0) AS bs__cash_to_mcap_daily, debt / nullif(shares * close, 0) AS bs__debt_to_mcap_daily, (debt - cash) / nullif(shares * close, 0) AS bs__netdebt_to_mcap_daily,
revenue / nullif(shares * close, 0) AS bs__equity_to_mcap_daily, (revenue + cost) / nullif(shares * close, 0) AS bs__assets_to_mcap_daily"""


@query("f13_cash_section", f"WITH {PRICES}, {STATEMENTS}, {_known}, {DAILY} SELECT symbol, date, {_cash_sql} FROM daily", floats=_cf, digits=4)
def f13(spark, sf):
    return _over_cap(spark, sf, cash_flow(spark, sf), "cf__", s.CASH, _cf)


_bs = ["bs__cash_to_mcap_daily", "bs__debt_to_mcap_daily", "bs__netdebt_to_mcap_daily", "bs__equity_to_mcap_daily", "bs__assets_to_mcap_daily"]


@query("f14_balance_section", f"WITH {PRICES}, {STATEMENTS}, {_known}, {DAILY} SELECT symbol, date, {_balance_sql} FROM daily", floats=_bs, digits=4)
def f14(spark, sf):
    return _over_cap(spark, sf, balance(spark, sf), "bs__", s.BALANCE, _bs)


_quality = ["is__revenue_to_mcap_daily", *_cf, *_bs, "bsg__book_growth_valuation_daily"]


@query("f16_statement_quality", f"""WITH {PRICES}, {STATEMENTS}, g AS (SELECT symbol, period_ending, revenue / nullif(lag(revenue) OVER (PARTITION BY symbol ORDER BY period_ending), 0) - 1 AS rg FROM statements),
sec AS (SELECT symbol, period_ending + 45 AS known, cash, debt, cost, revenue, shares * 1.1::DOUBLE AS shares, rg FROM statements JOIN g USING (symbol, period_ending)), {DAILY}, m AS (SELECT symbol, median(abs(rg)) AS a FROM daily GROUP BY ALL),
q AS (SELECT symbol, date, {_cash_sql}, {_balance_sql}, revenue / nullif(shares * close, 0) AS is__revenue_to_mcap_daily, CASE WHEN a <= 2 THEN rg * 100 ELSE rg END AS x FROM daily JOIN m USING (symbol))
SELECT * EXCLUDE (x), CASE WHEN x > 0 THEN bs__equity_to_mcap_daily / x END AS bsg__book_growth_valuation_daily FROM q""", floats=_quality, digits=4)  # fmt: skip
def f16_quality(spark, sf):
    """The bundle of all three statements and a growth section."""
    from pyspark.sql import Window

    st = statements(spark, sf)
    grow = F.try_divide(F.col("revenue"), F.nullif(F.lag("revenue").over(Window.partitionBy("symbol").orderBy("period_ending")), F.lit(0.0))) - 1
    growth = s.section_rows(st.select("symbol", "period_ending", grow.alias("totalEquityGrowth")), "bsg__")
    rows = ev.statement_quality(prices(spark, sf), income=s.section_rows(income(spark, sf), "is__"), cash=s.section_rows(cash_flow(spark, sf), "cf__"), balance=s.section_rows(balance(spark, sf), "bs__"), growth={"bsg__": growth})
    return rows.select("symbol", "date", *_quality)


_ttm = [c.replace("__", "_ttm__", 1) for c in ("is__revenue_to_mcap_daily", *_cf)]


@query("f12_f13_trailing_statements", f"WITH {PRICES}, {STATEMENTS}, {_known}, {DAILY}, q AS (SELECT symbol, date, revenue / nullif(shares * close, 0) AS is__revenue_to_mcap_daily, {_cash_sql} FROM daily) SELECT symbol, date, {', '.join(f'{c} AS {t}' for c, t in zip(('is__revenue_to_mcap_daily', *_cf), _ttm))} FROM q", floats=_ttm, digits=4)
def f12_ttm(spark, sf):
    rows = ev.trailing_statements(prices(spark, sf), income=s.section_rows(income(spark, sf), "is_ttm__"), cash=s.section_rows(cash_flow(spark, sf), "cf_ttm__"))
    return rows.select("symbol", "date", *_ttm)


@query("f10_key_metrics", f"""WITH {PRICES}, {STATEMENTS}, x AS (SELECT symbol, period_ending + 45 AS known, CASE WHEN month(period_ending) <> 9 THEN shares END AS n, CASE WHEN month(period_ending) <> 3 THEN (shares * 1000) * (cash / revenue) END AS b, debt AS km__roe FROM statements),
sec AS (SELECT symbol, known, km__roe, last_value(n IGNORE NULLS) OVER w AS shares, last_value(b IGNORE NULLS) OVER w AS base FROM x WINDOW w AS (PARTITION BY symbol ORDER BY known ROWS UNBOUNDED PRECEDING)), {DAILY}
SELECT symbol, date, shares * close AS km__marketcap, base / nullif(shares * close, 0) AS km__freecashflowyield, km__roe FROM daily""", floats=["km__marketcap", "km__freecashflowyield", "km__roe"], digits=4)  # fmt: skip
def f10(spark, sf):
    """Some reports come without shares, some without a yield: the last known ones hold."""
    month = F.month("period_ending")
    raw = statements(spark, sf).select("symbol", "period_ending", F.when(month != 9, F.col("shares")).alias("sharesOutstanding"), (F.col("shares") * 1000).alias("marketCap"), F.when(month != 3, F.col("cash") / F.col("revenue")).alias("freeCashFlowYield"), F.col("debt").alias("roe"))
    return ev.fundamental_changes(prices(spark, sf), metrics=s.section_rows(raw, "km__")).select("symbol", "date", "km__marketcap", "km__freecashflowyield", "km__roe")


_mult = {m: i for i, m in enumerate(s.MULTIPLES, 10)}
_rt = [f"rt__{m}" for m in _mult] + ["rt__dividendyield", "rt__dividendyieldpercentage"]
_kept = lambda e: f"last_value({e} IGNORE NULLS) OVER (PARTITION BY symbol ORDER BY known ROWS UNBOUNDED PRECEDING)"


@query("f11_repriced_ratios", f"""WITH {PRICES}, {STATEMENTS}, sec0 AS (SELECT symbol, period_ending + 45 AS known, month(period_ending) AS m, revenue / cost AS q, CASE WHEN month(period_ending) <> 12 THEN cash / shares END AS paid FROM statements),
sec1 AS (SELECT sec0.symbol, sec0.known, sec0.m, sec0.q, sec0.paid, p.close AS then_ FROM sec0 ASOF LEFT JOIN prices p ON sec0.symbol = p.symbol AND sec0.known >= p.date),
sec AS (SELECT symbol, known, {_kept('paid')} AS paid, {', '.join(f"{_kept(f'CASE WHEN (m + {i}) % 4 <> 0 THEN then_ / nullif(q * {i}, 0) END')} AS s{i}" for i in _mult.values())} FROM sec1), {DAILY}
SELECT symbol, date, {', '.join(f'close / nullif(s{i}, 0) AS rt__{m}' for m, i in _mult.items())}, paid / nullif(close, 0) AS rt__dividendyield, paid / nullif(close, 0) * 100 AS rt__dividendyieldpercentage FROM daily""", floats=_rt, digits=4)  # fmt: skip
def f11(spark, sf):
    """Each multiple is missing in some quarters, the dividend in the last."""
    month = F.month("period_ending")
    raw = statements(spark, sf).select("symbol", "period_ending", *[F.when((month + i) % 4 != 0, F.col("revenue") / F.col("cost") * i).alias(m) for m, i in _mult.items()], F.when(month != 12, F.col("cash") / F.col("shares")).alias("dividendPerShare"))
    return ev.fundamental_changes(prices(spark, sf), ratios=s.section_rows(raw, "rt__")).select("symbol", "date", *_rt)


@query("f15_growth_section", f"""WITH {PRICES}, {STATEMENTS}, g AS (SELECT symbol, period_ending + 45 AS known, revenue / nullif(lag(revenue) OVER w, 0) - 1 AS rg, 100 * (net_income / nullif(lag(net_income) OVER w, 0) - 1) AS eg FROM statements WINDOW w AS (PARTITION BY symbol ORDER BY period_ending)),
sec AS (SELECT * FROM g), {DAILY}, m AS (SELECT symbol, median(abs(rg)) AS a, median(abs(eg)) AS b FROM daily GROUP BY ALL), p AS (SELECT symbol, date, close, rg, eg, CASE WHEN a <= 2 THEN rg * 100 ELSE rg END AS x, CASE WHEN b <= 2 THEN eg * 100 ELSE eg END AS y FROM daily JOIN m USING (symbol))
SELECT symbol, date, rg AS isg__revenuegrowth, eg AS isg__epsgrowth, CASE WHEN y > 0 THEN close / y END AS isg__earnings_peg_daily, CASE WHEN x > 0 THEN close * 2 / x END AS isg__sales_growth_valuation_daily FROM p""",
floats=["isg__revenuegrowth", "isg__epsgrowth", "isg__earnings_peg_daily", "isg__sales_growth_valuation_daily"], digits=4)
def f15(spark, sf):
    from pyspark.sql import Window

    w = Window.partitionBy("symbol").orderBy("period_ending")
    grow = lambda c: F.try_divide(F.col(c), F.nullif(F.lag(c).over(w), F.lit(0.0))) - 1
    raw = statements(spark, sf).select("symbol", "period_ending", grow("revenue").alias("revenueGrowth"), (100 * grow("net_income")).alias("epsGrowth"))
    p = prices(spark, sf)
    valuations = p.select("symbol", "date", F.col("close").alias("rt__pricetoearningsratio"), (F.col("close") * 2).alias("rt__pricetosalesratio"))
    return s.growth_section(p, s.section_rows(raw, "isg__"), valuations, "isg__")


@query("f16_bundle", f"WITH {INCOME}, {DAILY} SELECT symbol, date, Revenue AS is__revenue, netIncome AS cf__netincome FROM daily", floats=["is__revenue", "cf__netincome"], digits=2)
def f16(spark, sf):
    p, raw = prices(spark, sf), income(spark, sf)
    a, c = (s.to_daily(p, s.section_rows(raw, x, keep=(k,))) for x, k in (("is__", "revenue"), ("cf__", "netincome")))
    return s.bundle(p, a, c)


CAP = f"{PRICES}, {STATEMENTS}, sec AS (SELECT symbol, period_ending + 45 AS known, revenue, cost, debt, shares FROM statements), {DAILY}"


def with_cap(spark, sf):
    return f.daily_statements(prices(spark, sf).select("symbol", "date", "close"), statements(spark, sf)).withColumn("market_cap", F.col("shares") * F.col("close"))


_f25 = [f"income_mcap__{c}" for c in ("revenue", "cost", "debt")]


@query("f25_statement_over_cap", f"WITH {CAP} SELECT symbol, date, {', '.join(f'{c} / nullif(shares * close, 0) AS income_mcap__{c}' for c in ('revenue', 'cost', 'debt'))}, 'higher_is_better,lower_is_better,lower_is_better' AS directions FROM daily", floats=_f25, digits=4)
def f25(spark, sf):
    rows, features = s.statement_over_market_cap(with_cap(spark, sf), ("revenue", "cost", "debt", "period_ending"))
    return rows.withColumn("directions", F.lit(",".join(x.direction for x in features)))


_f26 = ["ft_ratios_profitability__gross_margin", "ft_ratios_solvency__debt_to_equity", "ft_ratios_valuation__price_to_sales"]


@query("f26_ratio_families", f"WITH {CAP} SELECT symbol, date, (revenue - cost) / nullif(revenue, 0) AS {_f26[0]}, debt / nullif(revenue, 0) AS {_f26[1]}, close * shares / nullif(revenue, 0) AS {_f26[2]}, 'higher_is_better,lower_is_better,lower_is_better' AS directions FROM daily", floats=_f26, digits=4)
def f26(spark, sf):
    part = lambda a, c: F.try_divide(a, F.nullif(F.col(c), F.lit(0.0)))
    d = with_cap(spark, sf).select("symbol", "date", part(F.col("revenue") - F.col("cost"), "revenue").alias("gross_margin"), part(F.col("debt"), "revenue").alias("debt_to_equity"), part(F.col("market_cap"), "revenue").alias("price_to_sales"), F.col("close").alias("no_family"))
    rows, features = s.ratio_families(d, ("gross_margin", "debt_to_equity", "price_to_sales", "no_family"))
    return rows.withColumn("directions", F.lit(",".join(x.direction for x in features)))


@query("f27_f28_gated_panels", f"""WITH {CAP}, q AS (SELECT symbol, date, (revenue - cost) / nullif(revenue, 0) AS gross_margin, shares * close / nullif(revenue, 0) AS revenue_inverse FROM daily)
SELECT symbol, date, CASE WHEN count(gross_margin) OVER (PARTITION BY symbol) >= 300 THEN gross_margin END AS gross_margin, CASE WHEN count(revenue_inverse) OVER (PARTITION BY symbol) >= 500 THEN revenue_inverse END AS revenue_inverse FROM q""", floats=["gross_margin", "revenue_inverse"], digits=4)  # fmt: skip
def f27(spark, sf):
    st = s.section_rows(statements(spark, sf), "")
    ratios = {"gross_margin": F.try_divide(F.col("revenue") - F.col("cost"), F.nullif(F.col("revenue"), F.lit(0.0)))}
    static = s.static_panel(prices(spark, sf), st, ratios, least=300)
    inverse = s.inverse_panel(with_cap(spark, sf), ("revenue",), least=500).select("symbol", "date", "revenue_inverse")
    return static.join(inverse, ["symbol", "date"])


_ps = [f"ps__{k}" for k in ("investor_count", "shares_held", "investor_count_change", "investor_count_pct_change", "shares_held_change", "shares_held_pct_change", "shares_per_investor")]


@query("f21_positions_summary", f"""WITH {STATEMENTS}, r AS (SELECT symbol, period_ending AS date, floor(shares / 7)::DOUBLE AS i, shares AS h FROM statements)
SELECT symbol, date, i AS ps__investor_count, h AS ps__shares_held, i - lag(i) OVER w AS ps__investor_count_change, i / nullif(lag(i) OVER w, 0) - 1 AS ps__investor_count_pct_change, h - lag(h) OVER w AS ps__shares_held_change, h / nullif(lag(h) OVER w, 0) - 1 AS ps__shares_held_pct_change, h / nullif(i, 0) AS ps__shares_per_investor
FROM r WINDOW w AS (PARTITION BY symbol ORDER BY date)""", floats=_ps, digits=4)  # fmt: skip
def f21(spark, sf):
    raw = statements(spark, sf).select("symbol", F.col("period_ending").alias("date"), F.floor(F.col("shares") / 7).cast("string").alias("InvestorsCount"), F.col("shares").alias("totalShares"))
    return s.positions_summary(raw)


EVENT_COLUMNS = ("symbol", "event_date", "event_family", "event_type", "mirror_type", "side", "actor", "actor_role")


def _li(spark, sf):
    return table(spark, sf, "lineitem").withColumn("symbol", F.concat(F.lit("S"), "l_suppkey"))


_grade = lambda c: f"CASE {c} % 3 WHEN 0 THEN 'Strong Buy' WHEN 1 THEN 'Hold' ELSE 'Sell' END"
_score = lambda c: f"(5 - {c} % 3)"


@query("e03_e07_analyst_ratings", f"""WITH r AS (SELECT DISTINCT concat('S', l_suppkey) AS symbol, cast(l_shipdate AS DATE) AS event_date, l_partkey % 50 AS firm, {_grade('l_partkey')} AS strength, CASE WHEN l_orderkey % 7 = 0 THEN 'up' WHEN l_orderkey % 7 = 1 THEN 'down' WHEN {_score('l_partkey')} > {_score('l_linenumber')} THEN 'up' WHEN {_score('l_partkey')} < {_score('l_linenumber')} THEN 'down' END AS t FROM lineitem)
SELECT symbol, event_date, 'analyst_rating' AS event_family, CASE t WHEN 'up' THEN 'analyst_upgrade' ELSE 'analyst_downgrade' END AS event_type, CASE t WHEN 'up' THEN 'analyst_downgrade' ELSE 'analyst_upgrade' END AS mirror_type, CASE t WHEN 'up' THEN 1 ELSE -1 END AS side, 'firm ' || firm AS actor, 'analyst' AS actor_role, cast(event_date AS VARCHAR) AS reported_date,
'firm ' || firm AS actor_firm, 'analyst' AS actor_type, strength, 'warehouse:estimates_price_target' AS source FROM r WHERE t IS NOT NULL""", dates=["event_date"])  # fmt: skip
def e07_ratings(spark, sf):
    grade = lambda c: F.when(F.col(c) % 3 == 0, "Strong Buy").when(F.col(c) % 3 == 1, "Hold").otherwise("Sell")
    raw = _li(spark, sf).select("symbol", F.col("l_shipdate").alias("published_date"), F.when(F.col("l_orderkey") % 7 == 0, "Upgraded").when(F.col("l_orderkey") % 7 == 1, "lowered to hold").alias("action"), grade("l_partkey").alias("newGrade"), grade("l_linenumber").alias("previousGrade"), F.lit(" ").alias("company"), F.concat(F.lit("firm "), F.col("l_partkey") % 50).alias("analystFirm"))
    return b.build(raw, "analyst_rating").select(*EVENT_COLUMNS, F.col("reported_date").cast("string").alias("reported_date"), "actor_firm", "actor_type", "strength", "source")


@query("e07_capital_actions", f"""WITH {STATEMENTS}, c AS (SELECT symbol, period_ending, 'buyback_authorization' AS event_type, -cash AS v FROM statements WHERE cash <> 0 UNION ALL SELECT symbol, period_ending, 'equity_offering', debt - cash FROM statements WHERE debt - cash > 0)
SELECT symbol, period_ending AS event_date, 'capital_action' AS event_family, event_type, CASE event_type WHEN 'equity_offering' THEN 'buyback_authorization' ELSE 'equity_offering' END AS mirror_type, CASE event_type WHEN 'equity_offering' THEN -1 ELSE 1 END AS side, symbol AS actor, 'issuer' AS actor_type, v AS strength FROM c""", dates=["event_date"], floats=["strength"], digits=3)  # fmt: skip
def e07_capital(spark, sf):
    raw = statements(spark, sf).select("symbol", "period_ending", (-F.col("cash")).alias("commonStockRepurchased"), (F.col("debt") - F.col("cash")).alias("stock_issued"))
    return b.build(raw, "capital_action").select(*EVENT_COLUMNS[:-1], "actor_type", F.col("strength").cast("double").alias("strength"))


def _both(up: str, down: str, family: str, actor: str, kind: str, t: str = "t") -> str:
    return f"'{family}' AS event_family, CASE {t} WHEN 'up' THEN '{up}' ELSE '{down}' END AS event_type, CASE {t} WHEN 'up' THEN '{down}' ELSE '{up}' END AS mirror_type, CASE {t} WHEN 'up' THEN 1 ELSE -1 END AS side, {actor} AS actor, {kind} AS actor_type"


# Titles and offices, and the buckets they fall in.
TITLES = (("Chief Executive Officer", "ceo"), ("EVP, CFO", "cfo"), ("Director", "director"), ("Vice President", "president"), ("officer: legal", "officer"), ("10% owner", "large_holder"), ("friend", "other_insider"))
_title = lambda k: "CASE l_linenumber " + " ".join(f"WHEN {i} THEN '{x[k]}'" for i, x in enumerate(TITLES, 1)) + " END"
_office = "CASE l_linenumber % 4 WHEN 0 THEN 'U.S. Senate' WHEN 1 THEN 'House' WHEN 2 THEN 'Representative' ELSE 'congress' END"
_chambers = "CASE l_linenumber % 4 WHEN 0 THEN 'senate' WHEN 1 THEN 'house' WHEN 2 THEN 'house' ELSE 'congress_other' END"


@query("e02_e07_e08_insider_congress", f"""WITH r AS (SELECT *, concat('S', l_suppkey) AS symbol, cast(l_shipdate AS DATE) AS event_date, CASE l_returnflag WHEN 'A' THEN 'up' WHEN 'R' THEN 'down' END AS t FROM lineitem)
SELECT DISTINCT symbol, event_date, {_both('insider_buy', 'insider_sell', 'insider', "'P' || l_partkey", _title(0))}, {_title(1)} AS actor_role, {_title(0)} AS actor_title, cast(NULL AS VARCHAR) AS actor_chamber, l_quantity::DOUBLE AS strength, l_quantity::DOUBLE AS transaction_shares, l_quantity * (1 + l_partkey % 10)::DOUBLE AS transaction_value FROM r WHERE t IS NOT NULL
UNION ALL SELECT DISTINCT symbol, event_date, {_both('congress_buy', 'congress_sell', 'congress', "'Ann ' || l_partkey", _office)}, NULL, NULL, {_chambers}, l_tax::DOUBLE, NULL, NULL FROM r WHERE t IS NOT NULL""", dates=["event_date"], floats=["strength", "transaction_shares", "transaction_value"], digits=3)  # fmt: skip
def e07_trades(spark, sf):
    li = _li(spark, sf)
    titles = F.array(*[F.lit(t) for t, _ in TITLES])
    kind = F.when(F.col("l_returnflag") == "A", "P-Purchase").when(F.col("l_returnflag") == "R", "Sale (partial)").otherwise("M-Exempt")
    insider = li.select("symbol", F.col("l_shipdate").alias("transactionDate"), kind.alias("transactionType"), F.element_at(titles, F.col("l_linenumber")).alias("typeOfOwner"), F.concat(F.lit("P"), "l_partkey").alias("reportingName"), F.col("l_quantity").alias("securitiesTransacted"), (1 + F.col("l_partkey") % 10).alias("transaction_price"))
    where = F.when(F.col("l_linenumber") % 4 == 0, "U.S. Senate").when(F.col("l_linenumber") % 4 == 1, "House").when(F.col("l_linenumber") % 4 == 2, "Representative")
    congress = li.select("symbol", F.col("l_shipdate").alias("transaction_date"), kind.alias("type"), where.alias("office"), F.lit("Ann").alias("firstName"), F.col("l_partkey").alias("lastName"), F.col("l_tax").alias("amount"))
    both = b.build(insider, "insider").unionByName(b.build(congress, "congress"))
    return both.select(*EVENT_COLUMNS, "actor_type", "actor_title", "actor_chamber", F.col("strength").cast("double").alias("strength"), "transaction_shares", "transaction_value")


@query("e04_e07_price_targets", f"""WITH r AS (SELECT concat('S', l_suppkey) AS symbol, l_partkey % 20 AS a, cast(l_shipdate AS DATE) AS event_date, max(l_extendedprice) AS v FROM lineitem GROUP BY ALL), p AS (SELECT *, lag(v) OVER (PARTITION BY symbol, a ORDER BY event_date) AS b FROM r), q AS (SELECT *, CASE WHEN v > b THEN 'up' WHEN v < b THEN 'down' END AS t FROM p)
SELECT symbol, event_date, {_both('price_target_raise', 'price_target_cut', 'price_target', "'A' || a", "'analyst'")}, 'analyst' AS actor_role, 'A' || a AS actor_firm, v AS strength FROM q WHERE t IS NOT NULL""", dates=["event_date"], floats=["strength"], digits=2)  # fmt: skip
def e07_targets(spark, sf):
    raw = _li(spark, sf).groupBy("symbol", F.concat(F.lit("A"), F.col("l_partkey") % 20).alias("analystName"), F.to_date("l_shipdate").alias("publishedDate")).agg(F.max("l_extendedprice").alias("priceTarget"))
    return b.build(raw, "price_target").select(*EVENT_COLUMNS, "actor_type", "actor_firm", F.col("strength").cast("double").alias("strength"))


@query("e04_e07_institutional_dividend_split_earnings", f"""WITH {STATEMENTS}, w AS (SELECT *, lag(shares) OVER (PARTITION BY symbol ORDER BY period_ending) AS s0, lag(cash) OVER (PARTITION BY symbol ORDER BY period_ending) AS c0 FROM statements),
i AS (SELECT symbol, period_ending AS event_date, CASE WHEN shares - s0 > 0 THEN 'up' WHEN shares - s0 < 0 THEN 'down' END AS t FROM w), d AS (SELECT symbol, period_ending AS event_date, CASE WHEN cash > c0 THEN 'up' WHEN cash < c0 THEN 'down' END AS t FROM w WHERE period_ending BETWEEN DATE '1995-01-01' AND DATE '2005-01-01'),
sp AS (SELECT symbol, period_ending AS event_date, CASE WHEN debt / nullif(cash, 0) > 1 THEN 'up' WHEN debt / nullif(cash, 0) > 0 AND debt / nullif(cash, 0) < 1 THEN 'down' END AS t FROM w), e AS (SELECT symbol, period_ending AS event_date, CASE WHEN net_income > 0 THEN 'up' WHEN net_income < 0 THEN 'down' END AS t FROM w)
SELECT symbol, event_date, {_both('institutional_add', 'institutional_reduce', 'institutional', "'aggregate'", "'institution'")} FROM i WHERE t IS NOT NULL UNION ALL SELECT symbol, event_date, {_both('dividend_increase', 'dividend_cut', 'dividend', 'symbol', "'issuer'")} FROM d WHERE t IS NOT NULL
UNION ALL SELECT symbol, event_date, {_both('forward_split', 'reverse_split', 'split', 'symbol', "'issuer'")} FROM sp WHERE t IS NOT NULL UNION ALL SELECT symbol, event_date, {_both('earnings_beat', 'earnings_miss', 'earnings', 'symbol', "'issuer'")} FROM e WHERE t IS NOT NULL""", dates=["event_date"])  # fmt: skip
def e07_others(spark, sf):
    st = statements(spark, sf).withColumnRenamed("period_ending", "date")
    parts = (
        b.build(st.select("symbol", "date", F.col("shares").alias("sharesHeld")), "institutional"), b.build(st.select("symbol", "date", F.col("cash").alias("adjDividend")), "dividend", start="1995-01-01", end="2005-01-01"),
        b.build(st.select("symbol", "date", F.col("debt").alias("numerator"), F.col("cash").alias("denominator")), "split"), b.build(st.select("symbol", F.col("date").alias("fiscalDateEnding"), F.col("net_income").alias("reportedEPS"), F.lit("0").alias("epsConsensus")), "earnings"),
    )
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select(*EVENT_COLUMNS[:-1], "actor_type")


@query("e10_loaded_events", f"""WITH {STATEMENTS}, w AS (SELECT *, lag(cash) OVER (PARTITION BY symbol ORDER BY period_ending) AS c0, substr(symbol, 2)::INT % 2 = 0 AS even FROM statements),
e AS (SELECT symbol, period_ending AS event_date, CASE WHEN net_income > 0 THEN 'earnings_beat' WHEN net_income < 0 THEN 'earnings_miss' END AS event_type, CASE WHEN even THEN 'cache' ELSE 'warehouse:equity_calendar_earnings' END AS source FROM w),
d AS (SELECT symbol, period_ending AS event_date, CASE WHEN cash > c0 THEN 'dividend_increase' WHEN cash < c0 THEN 'dividend_cut' END AS event_type, 'warehouse:dividends' AS source FROM w)
SELECT * FROM (SELECT * FROM e UNION ALL SELECT * FROM d) WHERE event_type IS NOT NULL AND event_date BETWEEN DATE '1996-03-31' AND DATE '2000-06-30'""", dates=["event_date"])  # fmt: skip
def e10_loaded(spark, sf):
    """Earnings of every second symbol are stored, twice; all else is built, and events of a family that nobody asks for are left out."""
    st = statements(spark, sf).withColumnRenamed("period_ending", "date")
    earnings, dividends, splits = (b.build(st.select("symbol", "date", *c), k) for k, c in (
        ("earnings", (F.col("net_income").alias("actualEps"), F.lit(0).alias("estimatedEps"))), ("dividend", (F.col("cash").alias("dividend"),)), ("split", (F.lit(2).alias("ratio"),)),
    ))
    stored = earnings.filter("cast(substring(symbol, 2) as int) % 2 = 0").withColumn("source", F.lit("cache"))
    built = earnings.unionByName(dividends).unionByName(splits)
    return b.load(stored.unionByName(stored), built, families=("earnings", " Dividend "), start="1996-03-31", end="2000-06-30").select("symbol", "event_date", "event_type", "source")


@query("e05_press_releases", "SELECT doc_id, CASE WHEN contains(lower(text), 'buyback') OR contains(lower(text), 'repurchase') OR doc_id % 5 = 0 THEN 'buyback_authorization' END AS event_type FROM documents", dates=[])
def e05(spark, sf):
    """Documents as press releases; every fifth gets a title that tells of a repurchase."""
    d = table(spark, sf, "documents").withColumn("title", F.when(F.col("doc_id") % 5 == 0, "Share RePurchase program"))
    return d.select("doc_id", b.press_release_type(F.col("title"), F.col("text")).alias("event_type"))


@query("e10_sliced_events", f"WITH {STATEMENTS} SELECT symbol, period_ending AS event_date, CASE WHEN net_income > 0 THEN 'earnings_beat' ELSE 'earnings_miss' END AS event_type FROM statements WHERE net_income <> 0 AND period_ending BETWEEN DATE '1997-03-31' AND DATE '1999-12-31'", dates=["event_date"])
def e10(spark, sf):
    st = statements(spark, sf).select("symbol", F.col("period_ending").alias("date"), F.col("net_income").alias("eps"), F.lit(0).alias("epsEstimate"))
    return b.sliced(b.build(st, "earnings"), "1997-03-31", "1999-12-31").select("symbol", "event_date", "event_type")


@query("j06_features_with_targets", f"WITH {PRICES}, t AS (SELECT symbol, date, 1 AS target FROM prices WHERE volume > 40) SELECT p.symbol, p.date, p.close, t.target FROM prices p LEFT JOIN t USING (symbol, date)", floats=["close"])
def j06(spark, sf):
    p = prices(spark, sf)
    t = p.filter("volume > 40").withColumn("target", F.lit(1))
    return j.features_with_targets(p.select("symbol", "date", "close"), t, ("target",))


@query("j09_metrics_ratios_full", f"WITH {STATEMENTS} SELECT coalesce(a.symbol, b.symbol) AS symbol, coalesce(a.period_ending, b.period_ending) AS date, 'Q' AS period, coalesce(a.shares, b.shares + 1) AS shares, a.revenue, b.cost FROM (SELECT * FROM statements WHERE revenue > 100000) a FULL JOIN (SELECT * FROM statements WHERE cost > 90000) b ON a.symbol = b.symbol AND a.period_ending = b.period_ending", floats=["shares", "revenue", "cost"], digits=2)
def j09(spark, sf):
    st = statements(spark, sf).withColumnRenamed("period_ending", "date").withColumn("period", F.lit("Q"))
    return j.metrics_with_ratios(st.filter("revenue > 100000").select("symbol", "date", "period", "shares", "revenue"), st.filter("cost > 90000").select("symbol", "date", "period", (F.col("shares") + 1).alias("shares"), "cost"))


@query("j12_contracts_with_fallback", f"""WITH {CHAIN}, a AS (SELECT underlying AS trade_id, part::VARCHAR AS c, "right" AS r, expiration AS x, strike AS k, ask AS px FROM chain WHERE month(snapshot_date) = 3), b AS (SELECT underlying AS trade_id, CASE WHEN part % 2 = 0 THEN part::VARCHAR ELSE 'new ' || part END AS c, "right" AS r, expiration AS x, strike AS k, bid AS px FROM chain WHERE month(snapshot_date) = 4),
x AS (SELECT a.trade_id, a.c, a.px AS pa, b.px AS pb FROM a JOIN b ON a.trade_id = b.trade_id AND a.c = b.c), y AS (SELECT a.trade_id, a.c, a.px AS pa, b.px AS pb FROM a JOIN b ON a.trade_id = b.trade_id AND a.r = b.r AND a.x = b.x AND a.k = b.k WHERE NOT EXISTS (SELECT 1 FROM b z WHERE z.trade_id = a.trade_id AND z.c = a.c))
SELECT trade_id, c AS contract_symbol, pa AS px_entry, pb AS px_exit FROM x UNION ALL SELECT * FROM y""", floats=["px_entry", "px_exit"], dates=[])  # fmt: skip
def j12(spark, sf):
    q = chain(spark, sf).select(F.col("underlying").alias("trade_id"), "snapshot_date", F.col("part").cast("string").alias("contract_symbol"), F.col("right").alias("option_type"), "expiration", "strike", "ask", "bid", "part")
    a = q.filter(F.month("snapshot_date") == 3).withColumn("px", F.col("ask"))
    z = q.filter(F.month("snapshot_date") == 4).withColumns({"px": F.col("bid"), "contract_symbol": F.when(F.col("part") % 2 == 0, F.col("contract_symbol")).otherwise(F.concat(F.lit("new "), "contract_symbol"))})
    return j.entry_exit_contracts(a, z, ("px",)).select("trade_id", "contract_symbol", "px_entry", "px_exit")


@query("j07_j08_j14_j15_profile_joins", f"""WITH {PROFILES}, {PRICES}, a AS (SELECT symbol, date, 1 AS t1 FROM prices WHERE volume > 45), b AS (SELECT symbol, date, 1 AS t2 FROM prices WHERE close > 2000), c AS (SELECT coalesce(a.symbol, b.symbol) AS symbol, coalesce(a.date, b.date) AS date, coalesce(t1, 0) AS t1, coalesce(t2, 0) AS t2 FROM a FULL JOIN b ON a.symbol = b.symbol AND a.date = b.date)
SELECT c.symbol, c.date, t1, t2, coalesce(CASE WHEN t1 = 1 THEN 'own' END, sector) AS sector FROM c JOIN profiles p USING (symbol) WHERE NOT is_etf AND exchange = 'NYSE'""")  # fmt: skip
def j07(spark, sf):
    p, who = prices(spark, sf), profiles(spark, sf)
    both = j.combine_targets([p.filter("volume > 45").select("symbol", "date", F.lit(1).alias("t1")), p.filter("close > 2000").select("symbol", "date", F.lit(1).alias("t2"))])
    sections = who.filter("is_etf").select("symbol", F.lit("etf").alias("section"))
    rows = j.only(j.lacking(both, sections, "etf"), who.filter("exchange = 'NYSE'"))
    return j.enrich(rows.withColumn("sector", F.when(F.col("t1") == 1, "own")), who, ("sector",))


@query("s18_read_section", f"WITH {STATEMENTS} SELECT symbol, period_ending, revenue FROM statements WHERE period_ending BETWEEN DATE '1996-06-30' AND DATE '1998-03-31'", dates=["period_ending"], floats=["revenue"], digits=2)
def s18(spark, sf):
    return specs.read_section(statements(spark, sf), "income", start="1996-06-30", end="1998-03-31", columns=("revenue",))


@query("s19_read_chain", f"WITH {CHAIN} SELECT underlying, snapshot_date, part, bid FROM chain WHERE snapshot_date BETWEEN DATE '1997-01-01' AND DATE '1998-12-31'", dates=["snapshot_date"], floats=["bid"])
def s19(spark, sf):
    return specs.read_chain(chain(spark, sf), start="1997-01-01", end="1998-12-31", columns=("part", "bid"))


@query("f23_feature_spec", f"WITH {PRICES} SELECT symbol, date, volume, close FROM prices WHERE date >= DATE '1998-01-01'", floats=["volume", "close"])
def f23(spark, sf):
    p = prices(spark, sf)
    off = {n: False for n in specs.FeatureSpec().chosen() if n not in ("technical", "ratios")}
    spec = specs.FeatureSpec(start="1998-01-01", **off)
    return spec.build({"technical": p.select("symbol", "date", "volume"), "ratios": p.select("symbol", "date", "close"), "time": p}, p.select("symbol", "date"))


assert set(b.BUILDERS) == set(e.FAMILIES)
