"""Calendar, fundamental, event and ownership features."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestone.functions.columns import numeric, ratio
from lodestone.operators.asof import asof_join, lag_reports


def time_features(days: DataFrame, date: str = "date") -> DataFrame:
    """Calendar numbers (Monday is 0, ISO weeks), month and quarter edges, weekday and month one-hots."""
    d = F.col(date)
    end = F.last_day(d)
    plain = {
        "time__year": F.year(d), "time__quarter": F.quarter(d), "time__month": F.month(d), "time__week": F.weekofyear(d), "time__day": F.dayofmonth(d), "time__day_of_year": F.dayofyear(d), "time__weekday": F.weekday(d),
        "time__is_month_start": (F.dayofmonth(d) == 1).cast("int"), "time__is_month_end": (d == end).cast("int"), "time__is_quarter_end": ((d == end) & (F.month(d) % 3 == 0)).cast("int"),
    }
    hot = {f"time__weekday_{i}": (F.weekday(d) == i).cast("int") for i in range(7)} | {f"time__month_{i}": (F.month(d) == i).cast("int") for i in range(1, 13)}
    return days.withColumns(plain | hot)


def event_distances(grid: DataFrame, events: DataFrame) -> DataFrame:
    """Days since the last and until the next event (symbol, event_date) of the symbol; 0 on its day."""
    e = events.select("symbol", "event_date").distinct()
    rows = asof_join(grid, e, left_on="date", right_on="event_date", by=("symbol",), prefix="last_")
    rows = asof_join(rows, e, left_on="date", right_on="event_date", by=("symbol",), direction="forward", prefix="next_")
    return rows.withColumns({"days_since_last": F.datediff("date", "last_event_date"), "days_until_next": F.datediff("next_event_date", "date")}).drop("last_event_date", "next_event_date")


def days_after_listing(grid: DataFrame, listings: DataFrame) -> DataFrame:
    """Days since listing; null before it or without one."""
    rows = grid.join(listings, "symbol", "left")
    n = F.datediff("date", "listing_date")
    return rows.withColumn("days_after_ipo", F.when(n >= 0, n)).drop("listing_date")


def daily_statements(prices: DataFrame, statements: DataFrame, *, date: str = "period_ending", lag: int = 45, prefix: str = "") -> DataFrame:
    """Prices with the latest statement known on each day."""
    s = lag_reports(statements, date_col=date, days=lag)
    return asof_join(prices, s, left_on="date", right_on=date, by=("symbol",), prefix=prefix)


def price_linked(daily: DataFrame, items: Iterable[str], *, shares: str = "shares", negate: Iterable[str] = ()) -> DataFrame:
    """{item}_to_mcap: an item over shares times close; negated where it is an outflow."""
    cap = F.col(shares) * F.col("close")
    return daily.withColumn("market_cap", cap).withColumns({f"{i}_to_mcap": ratio(-F.col(i) if i in negate else F.col(i), cap) for i in items})


def valuation_panel(daily: DataFrame, items: Iterable[str]) -> DataFrame:
    """Yields and multiples of any items on market cap and on enterprise value (cap + debt - cash, missing parts 0); `daily_valuation` has the items of the vendor's statements."""
    rows = daily.withColumn("market_cap", F.col("shares") * F.col("close"))
    rows = rows.withColumn("enterprise_value", F.col("market_cap") + F.coalesce("debt", F.lit(0.0)) - F.coalesce("cash", F.lit(0.0)))
    out: dict[str, Column] = {}
    for i in items:
        out |= {f"{i}_yield": ratio(F.col(i), F.col("market_cap")), f"{i}_multiple": ratio(F.col("market_cap"), F.col(i)), f"{i}_ev_yield": ratio(F.col(i), F.col("enterprise_value"))}
    return rows.withColumns(out)


# Items over the daily market cap: name, section, column, and whether higher is better; items over the enterprise value.
CAP_ITEMS = (
    ("revenue", "income", "revenue", True), ("gross_profit", "income", "gross_profit", True), ("operating_income", "income", "operating_income", True), ("ebit", "income", "ebit", True), ("ebitda", "income", "ebitda", True),
    ("net_income", "income", "net_income", True), ("operating_cash_flow", "cash", "operating_cash_flow", True), ("free_cash_flow", "cash", "free_cash_flow", True), ("book_equity", "balance", "book_equity", True),
    ("tangible_book", "balance", "tangible_book", True), ("cash", "balance", "cash_and_cash_equivalents", True), ("cash_and_short_term_investments", "balance", "cash_and_short_term_investments", True),
    ("total_debt", "balance", "total_debt", False), ("net_debt", "balance", "net_debt", False),
)
EV_ITEMS = ("revenue", "gross_profit", "operating_income", "ebit", "ebitda", "operating_cash_flow", "free_cash_flow")
# Vendor ratios taken as reported, and controls of quality: name, section, column, and whether higher is better.
STATIC_RATIOS = (
    ("static_pe", "ratios", "price_to_earnings", False), ("static_ps", "ratios", "price_to_sales", False), ("static_pb", "ratios", "price_to_book", False), ("static_pocf", "ratios", "price_to_operating_cash_flow", False),
    ("static_pfcf", "ratios", "price_to_free_cash_flow", False), ("static_debt_to_market_cap", "ratios", "debt_to_market_cap", False), ("static_dividend_yield", "ratios", "dividend_yield", True),
    ("static_ev_to_sales", "metrics", "ev_to_sales", False), ("static_ev_to_ebitda", "metrics", "ev_to_ebitda", False), ("static_ev_to_ocf", "metrics", "ev_to_operating_cash_flow", False), ("static_ev_to_fcf", "metrics", "ev_to_free_cash_flow", False),
)
CONTROLS = (
    ("gross_profit_margin", "ratios", "gross_profit_margin", True), ("ebitda_margin", "ratios", "ebitda_margin", True), ("operating_profit_margin", "ratios", "operating_profit_margin", True), ("net_profit_margin", "ratios", "net_profit_margin", True),
    ("current_ratio", "ratios", "current_ratio", True), ("quick_ratio", "ratios", "quick_ratio", True), ("debt_to_assets", "ratios", "debt_to_assets", False), ("debt_to_equity", "ratios", "debt_to_equity", False),
    ("return_on_assets", "metrics", "return_on_assets", True), ("return_on_equity", "metrics", "return_on_equity", True), ("return_on_invested_capital", "metrics", "return_on_invested_capital", True), ("income_quality", "metrics", "income_quality", True),
    ("net_debt_to_ebitda", "metrics", "net_debt_to_ebitda", False),
)


def with_book(balance: DataFrame) -> DataFrame:
    """A balance with book_equity and tangible_book: equity less goodwill and intangible assets, given as one column or as two (a column that is not there counts 0)."""
    if "total_stockholders_equity" not in balance.columns:
        return balance
    part = lambda c: F.col(c) if c in balance.columns else F.lit(0.0)
    soft = F.col("goodwill_and_intangible_assets") if "goodwill_and_intangible_assets" in balance.columns else part("goodwill") + part("intangible_assets")
    return balance.withColumns({"book_equity": F.col("total_stockholders_equity"), "tangible_book": F.col("total_stockholders_equity") - soft})


def _known_daily(prices: DataFrame, sections: Mapping[str, DataFrame], lag: int, wanted: Iterable[tuple[str, str]]) -> tuple[DataFrame, set[str]]:
    """Prices' days with the wanted columns of sections (symbol, period_ending, columns) known ``lag`` days after, as {section}.{column} with a double underscore."""
    rows, there = prices.select("symbol", "date"), set()
    for section, df in sections.items():
        columns = [c for s, c in dict.fromkeys(wanted) if s == section and c in df.columns]
        if columns:
            sparse = df.select("symbol", "period_ending", *[numeric(F.col(c)).alias(f"{section}__{c}") for c in columns])
            known = lag_reports(sparse, date_col="period_ending", days=lag)
            rows = asof_join(rows, known, left_on="date", right_on="period_ending", by=("symbol",)).drop("period_ending")
            there |= {f"{section}__{c}" for c in columns}
    return rows, there


def daily_valuation(prices: DataFrame, market_cap: DataFrame, sections: Mapping[str, DataFrame], *, lag: int = 45) -> tuple[DataFrame, dict[str, str]]:
    """Yields and multiples of the statements' items on each day's market cap and enterprise value, and each column's direction (higher_is_better or lower_is_better).

    ``market_cap``: (symbol, date, market_cap), the last one known holds. ``sections``: income, balance and cash reports (symbol, period_ending, columns), known ``lag`` days later. The enterprise value is cap plus debt
    less cash, a missing part counting 0 beside another. Items that no section has are left out.
    """
    sections = {k: with_book(v) if k == "balance" else v for k, v in sections.items()}
    rows, there = _known_daily(prices, sections, lag, [*((s, c) for _, s, c, _ in CAP_ITEMS)])
    rows = asof_join(rows, market_cap.select("symbol", F.col("date").alias("__of"), "market_cap"), left_on="date", right_on="__of", by=("symbol",)).drop("__of")
    part = lambda c: F.col(c) if c in there else F.lit(None).cast("double")
    zero = lambda c: F.coalesce(c, F.lit(0.0))
    cap, debt, cash = F.col("market_cap").cast("double"), part("balance__total_debt"), part("balance__cash_and_cash_equivalents")
    rows = rows.withColumn("enterprise_value", F.when(F.coalesce(cap, debt, cash).isNotNull(), zero(cap) + zero(debt) - zero(cash)))
    out, direction = {}, {}
    name = lambda up: "higher_is_better" if up else "lower_is_better"
    for item, section, column, up in CAP_ITEMS:
        if f"{section}__{column}" in there:
            x = F.col(f"{section}__{column}")
            out[f"fmp_daily_mcap_yield__{item}_to_mcap"], direction[f"fmp_daily_mcap_yield__{item}_to_mcap"] = ratio(x, cap), name(up)
            out[f"fmp_daily_mcap_multiple__mcap_to_{item}"], direction[f"fmp_daily_mcap_multiple__mcap_to_{item}"] = ratio(cap, x), name(not up)
            if item in EV_ITEMS:
                out[f"fmp_daily_ev_yield__{item}_to_ev"], direction[f"fmp_daily_ev_yield__{item}_to_ev"] = ratio(x, F.col("enterprise_value")), name(True)
                out[f"fmp_daily_ev_multiple__ev_to_{item}"], direction[f"fmp_daily_ev_multiple__ev_to_{item}"] = ratio(F.col("enterprise_value"), x), name(False)
    return rows.withColumns(out).drop(*there), direction


def quality_panel(prices: DataFrame, sections: Mapping[str, DataFrame], *, lag: int = 45, least: int = 120) -> tuple[DataFrame, dict[str, str]]:
    """Vendor ratios as reported (static_*) and controls of quality (asof_*) on each day, from sections ratios and metrics, and each column's direction; null for symbols with fewer than ``least`` values of one."""
    wanted = [(name if name.startswith("static_") else f"asof_{name}", f"{section}__{column}", section, column, up) for name, section, column, up in (*STATIC_RATIOS, *CONTROLS)]
    rows, there = _known_daily(prices, sections, lag, [(s, c) for _, _, s, c, _ in wanted])
    n = Window.partitionBy("symbol")
    kept = {name: F.when(F.count(c).over(n) >= least, F.col(c)) for name, c, *_ in wanted if c in there}
    return rows.withColumns(kept).drop(*there), {name: "higher_is_better" if up else "lower_is_better" for name, c, _, _, up in wanted if c in there}


def growth_adjusted(daily: DataFrame, valuation: str, growth: str, name: str) -> DataFrame:
    """Valuation over growth in percent, for positive growth. Growth counts as a share, and is taken times 100, where the symbol's median size is 2 or less."""
    size = daily.groupBy("symbol").agg(F.percentile(F.abs(F.col(growth)), 0.5).alias("__m"))
    rows = daily.join(size, "symbol", "left")
    pct = F.when(F.col("__m") <= 2.0, F.col(growth) * 100).otherwise(F.col(growth))
    return rows.withColumn(name, F.when(pct > 0, ratio(F.col(valuation), pct))).drop("__m")


def statement_ratios(statements: DataFrame, date: str = "period_ending") -> DataFrame:
    """Margins (gross, operating, net, free cash flow), returns on equity and assets, and quarter-on-quarter growth of revenue on the statements themselves."""
    w = Window.partitionBy("symbol").orderBy(date)
    over = lambda a, b: ratio(F.col(a), F.col(b))
    return statements.withColumns({
        "ft__gross_margin": over("gross_profit", "revenue"), "ft__operating_margin": over("operating_income", "revenue"), "ft__net_margin": over("net_income", "revenue"), "ft__return_on_equity": over("net_income", "total_equity"),
        "ft__return_on_assets": over("net_income", "total_assets"), "ft__fcf_margin": over("free_cash_flow", "revenue"), "ft__revenue_growth_qoq": ratio(F.col("revenue"), F.lag("revenue").over(w)) - 1,
    })


def merge_features(grid: DataFrame, sets: Iterable[DataFrame]) -> DataFrame:
    """The grid (symbol, date) with all sets' columns; of columns with one name the last set's wins."""
    sets = list(sets)
    owner = {c: i for i, s in enumerate(sets) for c in s.columns if c not in ("symbol", "date")}
    out = grid
    for i, s in enumerate(sets):
        own = [c for c, k in owner.items() if k == i]
        out = out.join(s.select("symbol", "date", *own), ["symbol", "date"], "left")
    return out


def cap_by_quality(features: DataFrame, family: Mapping[str, str], most: int) -> DataFrame:
    """Per family the ``most`` features of best coverage, then largest mean daily cross-sectional variance, then name: family, feature, coverage, variance, rank."""
    names = list(family)
    long = features.unpivot(["symbol", "date"], [F.col(c).cast("double").alias(c) for c in names], "feature", "value")
    daily = long.groupBy("feature", "date").agg(F.count("value").alias("n"), F.count("*").alias("all"), F.var_samp("value").alias("v"))
    each = daily.groupBy("feature").agg((F.sum("n") / F.sum("all")).alias("coverage"), F.avg("v").alias("variance"))
    of = F.create_map(*[F.lit(x) for kv in family.items() for x in kv])
    w = Window.partitionBy("family").orderBy(F.desc("coverage"), F.desc_nulls_last("variance"), "feature")
    return each.withColumn("family", of[F.col("feature")]).withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= most)


def coverage_report(panel: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Per symbol: values of each column, first and last date, median gap in days."""
    w = Window.partitionBy("symbol").orderBy("date")
    rows = panel.withColumn("__gap", F.datediff("date", F.lag("date").over(w)))
    return rows.groupBy("symbol").agg(*[F.count(c).alias(f"n_{c}") for c in columns], F.min("date").alias("first_date"), F.max("date").alias("last_date"), F.percentile("__gap", 0.5).alias("median_gap"), F.mode("__gap", True).alias("mode_gap"))
