"""Features from sections of fundamental data: sparse rows by report date to daily columns, re-priced each day."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestone.functions.columns import numeric, ratio
from lodestone.operators.asof import asof_join
from lodestone.operators.fundamental import growth_adjusted, merge_features

# Vendor columns, lower-cased, that hold the count of shares; the first a section has counts.
SHARES = ("sharesoutstanding", "weightedaverageshsout", "weightedaverageshsoutdil")
# Those of an income statement, in its order.
INCOME_SHARES = ("weightedaverageshsoutdil", "weightedaverageshsout")
# Multiples of a share's price that are priced anew each day.
MULTIPLES = ("pricetoearningsratio", "pricetobookratio", "pricetosalesratio", "pricetofreecashflowratio", "pricetooperatingcashflowratio")


@dataclass(frozen=True)
class Linked:
    """An item over the day's close or market cap: the first of ``items`` that the section has."""

    items: tuple[str, ...]
    name: str
    per_share: bool = False
    negate: bool = False


# The linked ratios of each kind of statement.
INCOME = (
    Linked(("eps", "epsdiluted"), "eps_to_price_daily", per_share=True), Linked(("revenue",), "revenue_to_mcap_daily"), Linked(("grossprofit",), "grossprofit_to_mcap_daily"),
    Linked(("ebitda",), "ebitda_to_mcap_daily"), Linked(("operatingincome",), "operatingincome_to_mcap_daily"), Linked(("netincome",), "netincome_to_mcap_daily"),
)
CASH = (
    Linked(("operatingcashflow", "netcashprovidedbyoperatingactivities"), "operatingcashflow_to_mcap_daily"), Linked(("freecashflow",), "freecashflow_to_mcap_daily"),
    Linked(("capitalexpenditure", "capitalexpenditures"), "capex_to_mcap_daily", negate=True),
)
BALANCE = (
    Linked(("cashandcashequivalents", "cashandshortterminvestments"), "cash_to_mcap_daily"), Linked(("totaldebt", "shorttermdebt", "longtermdebt"), "debt_to_mcap_daily"), Linked(("netdebt",), "netdebt_to_mcap_daily"),
    Linked(("totalstockholdersequity", "totalequity"), "equity_to_mcap_daily"), Linked(("totalassets",), "assets_to_mcap_daily"),
)


@dataclass(frozen=True)
class OverGrowth:
    """A valuation over growth: the first of each that is there."""

    growth: tuple[str, ...]
    valuation: tuple[str, ...]
    name: str


# Valuations over growth by growth section.
GROWTH = {
    "isg__": (
        OverGrowth(("epsgrowth", "epsdilutedgrowth", "netincomegrowth"), ("rt__pricetoearningsratio",), "earnings_peg_daily"), OverGrowth(("revenuegrowth",), ("rt__pricetosalesratio", "km__evtosales"), "sales_growth_valuation_daily"),
        OverGrowth(("grossprofitgrowth",), ("is__grossprofit_to_mcap_daily",), "grossprofit_growth_valuation_daily"), OverGrowth(("ebitdagrowth",), ("km__evtoebitda", "is__ebitda_to_mcap_daily"), "ebitda_growth_valuation_daily"),
        OverGrowth(("operatingincomegrowth",), ("is__operatingincome_to_mcap_daily",), "operatingincome_growth_valuation_daily"),
    ),
    "cfg__": (
        OverGrowth(("operatingcashflowgrowth", "netcashprovidedbyoperatingactivitiesgrowth"), ("rt__pricetooperatingcashflowratio", "km__evtooperatingcashflow"), "operatingcashflow_growth_valuation_daily"),
        OverGrowth(("freecashflowgrowth",), ("rt__pricetofreecashflowratio", "km__evtofreecashflow"), "freecashflow_growth_valuation_daily"), OverGrowth(("capitalexpendituregrowth", "capitalexpendituresgrowth"), ("cf__capex_to_mcap_daily",), "capex_growth_valuation_daily"),
    ),
    "bsg__": (
        OverGrowth(("totalstockholdersequitygrowth", "totalequitygrowth", "bookvaluepersharegrowth"), ("rt__pricetobookratio", "bs__equity_to_mcap_daily"), "book_growth_valuation_daily"), OverGrowth(("totalassetsgrowth",), ("bs__assets_to_mcap_daily",), "assets_growth_valuation_daily"),
        OverGrowth(("cashandcashequivalentsgrowth", "cashandshortterminvestmentsgrowth"), ("bs__cash_to_mcap_daily",), "cash_growth_valuation_daily"), OverGrowth(("totaldebtgrowth", "netdebtgrowth"), ("bs__debt_to_mcap_daily", "bs__netdebt_to_mcap_daily"), "debt_growth_valuation_daily"),
    ),
    "fg__": (
        OverGrowth(("epsgrowth", "epsdilutedgrowth", "netincomegrowth"), ("rt__pricetoearningsratio",), "earnings_peg_daily"), OverGrowth(("revenuegrowth",), ("rt__pricetosalesratio", "km__evtosales"), "sales_growth_valuation_daily"),
        OverGrowth(("ebitdagrowth",), ("km__evtoebitda", "is__ebitda_to_mcap_daily"), "ebitda_growth_valuation_daily"), OverGrowth(("freecashflowgrowth",), ("rt__pricetofreecashflowratio", "km__evtofreecashflow"), "freecashflow_growth_valuation_daily"),
        OverGrowth(("operatingcashflowgrowth",), ("rt__pricetooperatingcashflowratio", "km__evtooperatingcashflow"), "operatingcashflow_growth_valuation_daily"),
    ),
}


def section_rows(rows: DataFrame, prefix: str, *, keep: Iterable[str] | None = None, lag: int = 45, date: str = "period_ending") -> DataFrame:
    """(symbol, date, {prefix}{column}): lower-case names, the report date moved by ``lag`` days, the last row of each (symbol, date).

    ``keep``: lower-case columns to take. A text column of which any value is a number becomes numeric, one without any stays text; finding out is one aggregation.
    """
    keep = None if keep is None else {k.lower() for k in keep}
    names = [c for c in rows.columns if c not in ("symbol", date) and (keep is None or c.lower() in keep)]
    texts = [c for c in names if rows.schema[c].dataType.simpleString() == "string"]
    found = rows.agg(*[F.count(F.col(c).try_cast("double")).alias(c) for c in texts]).first() if texts else {}
    value = lambda c: F.col(c) if c in texts and not found[c] else numeric(F.col(c)) if c in texts else F.col(c)
    ready = rows.select("symbol", F.date_add(date, lag).alias("date"), F.col(date).alias("__reported"), *[value(c).alias(prefix + c.lower()) for c in names])
    columns = [c for c in ready.columns if c not in ("symbol", "date")]
    last = ready.groupBy("symbol", "date").agg(F.max_by(F.struct(*columns), "__reported").alias("__r"))
    return last.select("symbol", "date", *[F.col(f"__r.{c}").alias(c) for c in columns if c != "__reported"])


def to_daily(grid: DataFrame, sparse: DataFrame) -> DataFrame:
    """The grid (symbol, date) with the columns of the latest sparse row known on the day."""
    return asof_join(grid.select("symbol", "date"), sparse.withColumnRenamed("date", "__known"), left_on="date", right_on="__known", by=("symbol",)).drop("__known")


def _first(df: DataFrame, prefix: str, items: Iterable[str]) -> Column | None:
    return next((F.col(prefix + i) for i in items if prefix + i in df.columns), None)


def _without_empty(df: DataFrame, names: list[str]) -> DataFrame:
    """``df`` without those of the columns that hold no value at all."""
    if not names:
        return df
    found = df.agg(*[F.count(c).alias(c) for c in names]).first()
    return df.drop(*[c for c in names if not found[c]])


def last_known(sparse: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Sparse rows with each column's last known value: a report without it does not hide it."""
    w = Window.partitionBy("symbol").orderBy("date").rowsBetween(Window.unboundedPreceding, 0)
    return sparse.withColumns({c: F.last(c, ignorenulls=True).over(w) for c in columns})


def linked_ratios(prices: DataFrame, sparse: DataFrame, prefix: str, specs: Iterable[Linked], *, shares: Iterable[str] = SHARES, market_cap: DataFrame | None = None) -> DataFrame:
    """A section's columns on each day of ``prices`` and its ``specs``. Ratios without any value are left out.

    The market cap is ``market_cap`` (symbol, date, market_cap) if given, as sections of cash flows and balances hold no shares; else the first of ``shares`` that the section has, times close.
    """
    daily = to_daily(prices, sparse).join(prices.select("symbol", "date", "close"), ["symbol", "date"])
    if market_cap is not None:
        daily = daily.join(market_cap.select("symbol", "date", F.col("market_cap").alias("__cap")), ["symbol", "date"], "left")
    else:
        count = _first(daily, prefix, shares)
        daily = daily.withColumn("__cap", F.lit(None).cast("double") if count is None else count * F.col("close"))
    out: dict[str, Column] = {}
    for s in specs:
        item = _first(daily, prefix, s.items)
        if item is not None:
            out[prefix + s.name] = ratio(-item if s.negate else item, F.col("close") if s.per_share else F.col("__cap"))
    return _without_empty(daily.withColumns(out), list(out)).drop("close", "__cap")


def key_metrics(prices: DataFrame, sparse: DataFrame, prefix: str = "km__") -> DataFrame:
    """Key metrics on each day; the market cap is the last known shares times close, and the free cash flow yield is the last reported one times the reported market cap over it."""
    base = "__base"
    if {f"{prefix}marketcap", f"{prefix}freecashflowyield"} <= set(sparse.columns):
        sparse = sparse.withColumn(base, F.col(f"{prefix}marketcap") * F.col(f"{prefix}freecashflowyield"))
    shares = next((prefix + c for c in SHARES if prefix + c in sparse.columns), None)
    if shares is not None:
        sparse = sparse.withColumn("__shares", F.col(shares))
    sparse = last_known(sparse, [c for c in (base, "__shares") if c in sparse.columns])
    daily = to_daily(prices, sparse).join(prices.select("symbol", "date", "close"), ["symbol", "date"])
    if shares is not None:
        daily = daily.withColumn(f"{prefix}marketcap", F.col("__shares") * F.col("close"))
        if base in daily.columns:
            daily = daily.withColumn(f"{prefix}freecashflowyield", ratio(F.col(base), F.col(f"{prefix}marketcap")))
    return daily.drop("close", base, "__shares")


def repriced_ratios(prices: DataFrame, sparse: DataFrame, prefix: str = "rt__") -> DataFrame:
    """Ratios on each day. A multiple's per-share value is the close known at the report over the reported multiple, and the day's multiple the close over the last known of these;
    the last known dividends per share over the close are the yield, also in percent.
    """
    days = prices.select("symbol", F.col("date").alias("__day"), F.col("close").alias("__then"))
    at_report = asof_join(sparse, days, left_on="date", right_on="__day", by=("symbol",)).drop("__day")
    multiples = [prefix + m for m in MULTIPLES if prefix + m in sparse.columns]
    at_report = at_report.withColumns({f"{m}__share": ratio(F.col("__then"), F.col(m)) for m in multiples}).drop("__then")
    paid = f"{prefix}dividendpershare"
    if paid in sparse.columns:
        at_report = at_report.withColumn("__paid", F.col(paid))
    at_report = last_known(at_report, [*[f"{m}__share" for m in multiples], *(["__paid"] if paid in sparse.columns else [])])
    daily = to_daily(prices, at_report).join(prices.select("symbol", "date", "close"), ["symbol", "date"])
    daily = daily.withColumns({m: ratio(F.col("close"), F.col(f"{m}__share")) for m in multiples})
    if paid in daily.columns:
        part = ratio(F.col("__paid"), F.col("close"))
        daily = daily.withColumns({f"{prefix}dividendyield": part, f"{prefix}dividendyieldpercentage": part * 100})
    return daily.drop("close", "__paid", *[f"{m}__share" for m in multiples])


def growth_section(prices: DataFrame, sparse: DataFrame, valuations: DataFrame, prefix: str, specs: Iterable[OverGrowth] | None = None) -> DataFrame:
    """A growth section on each day and its valuations over growth (see `growth_adjusted`); ``valuations``: (symbol, date, columns)."""
    daily = to_daily(prices, sparse).join(valuations, ["symbol", "date"], "left")
    own = [c for c in daily.columns if c.startswith(prefix)]
    made = []
    for s in GROWTH[prefix] if specs is None else specs:
        growth = next((prefix + g for g in s.growth if prefix + g in daily.columns), None)
        valuation = next((v for v in s.valuation if v in daily.columns), None)
        if growth and valuation:
            daily = growth_adjusted(daily, valuation, growth, prefix + s.name)
            made.append(prefix + s.name)
    return daily.select("symbol", "date", *own, *made)


def bundle(grid: DataFrame, *sets: DataFrame) -> DataFrame:
    """Several feature sets on one grid; of columns with one name the last set's."""
    return merge_features(grid.select("symbol", "date"), sets)


# Words in a column's name that make lower values better.
LOWER = ("debt", "liabilit", "expense", "cost", "tax", "payable", "deficit", "loss", "inventory")
# Families of ratio and metric columns by words in their names, the first that fits.
RATIO_FAMILIES = (
    ("ft_ratios_profitability", ("margin", "return_on", "income_quality", "tax_burden", "interest_burden", "sga_to_revenue")), ("ft_ratios_liquidity", ("current_ratio", "quick_ratio", "cash_ratio", "operating_cash_flow_ratio", "working_capital")),
    ("ft_ratios_solvency", ("debt", "coverage", "equity_multiplier", "liabilities", "solvency")), ("ft_ratios_efficiency", ("turnover", "days_", "cycle", "cash_conversion", "asset_turnover")),
    ("ft_ratios_valuation", ("price_to", "ev_to", "market_cap", "enterprise_value", "yield", "book_value_per_share", "earnings_per_share", "revenue_per_share", "capex_per_share")),
)
METRIC_FAMILIES = (("ft_ratios_valuation", ("ev_to", "market_cap", "enterprise_value", "graham", "invested_capital")), ("ft_ratios_profitability", ("return_on", "income_quality", "roic")), ("ft_ratios_solvency", ("debt", "coverage", "working_capital")))
# Valuation and solvency columns of which higher values are better all the same.
HIGHER = ("yield", "cash", "working_capital", "interest_coverage", "current_ratio", "quick_ratio")


@dataclass(frozen=True)
class Feature:
    name: str
    family: str
    source: str
    column: str
    direction: str


def _fits(name: str, words: Iterable[str]) -> bool:
    return any(w in name.lower() for w in words)


def family_of(column: str, families: Iterable[tuple[str, tuple[str, ...]]]) -> str | None:
    return next((f for f, words in families if _fits(column, words)), None)


def direction_of(family: str, column: str) -> str:
    """higher_is_better or lower_is_better: by the words of the name for valuation, solvency and statement families."""
    if family.endswith("_mcap"):
        return "lower_is_better" if _fits(column, LOWER) else "higher_is_better"
    low = family in ("ft_ratios_valuation", "ft_ratios_solvency") and not _fits(column, HIGHER)
    return "lower_is_better" if low else "higher_is_better"


def statement_over_market_cap(daily: DataFrame, columns: Iterable[str], *, section: str = "income", cap: str = "market_cap") -> tuple[DataFrame, list[Feature]]:
    """Each of a statement's numeric columns over the day's market cap, as {section}_mcap__{column}, and what each is. Columns of no value are left out."""
    family = f"{section}_mcap"
    names = [c for c in columns if daily.schema[c].dataType.simpleString() in ("double", "float", "int", "bigint")]
    made = {f"{family}__{c}": ratio(F.col(c).cast("double"), F.col(cap)) for c in names}
    out = _without_empty(daily.select("symbol", "date", *[v.alias(k) for k, v in made.items()]), list(made))
    return out, [Feature(f"{family}__{c}", family, "statements", f"{section}.{c}", direction_of(family, c)) for c in names if f"{family}__{c}" in out.columns]


def ratio_families(daily: DataFrame, columns: Iterable[str], *, section: str = "ratios") -> tuple[DataFrame, list[Feature]]:
    """Columns of the ratios, metrics or growth sections as {family}__{column}, passed through, and what each is; columns of no family are left out."""
    growth = f"ft_growth_{section.removesuffix('_growth')}" if section.endswith("_growth") else None
    families = RATIO_FAMILIES if section == "ratios" else METRIC_FAMILIES
    of = {c: (growth if c.startswith("growth_") else None) if growth else family_of(c, families) for c in columns}
    kept = {c: f for c, f in of.items() if f}
    out = _without_empty(daily.select("symbol", "date", *[numeric(F.col(c)).alias(f"{f}__{c}") for c, f in kept.items()]), [f"{f}__{c}" for c, f in kept.items()])
    return out, [Feature(f"{f}__{c}", f, "ratios", f"{section}.{c}", direction_of(f, c)) for c, f in kept.items() if f"{f}__{c}" in out.columns]


def static_panel(grid: DataFrame, sparse: DataFrame, columns: Mapping[str, Column], *, least: int = 120) -> DataFrame:
    """Ratios of the reports themselves (name to expression over a report's columns) on each day, for symbols with ``least`` values or more of one; else null."""
    ratios = sparse.select("symbol", "date", *[c.alias(k) for k, c in columns.items()])
    daily = to_daily(grid, ratios)
    n = Window.partitionBy("symbol")
    return daily.withColumns({k: F.when(F.count(k).over(n) >= least, F.col(k)) for k in columns})


def inverse_panel(daily: DataFrame, items: Iterable[str], *, cap: str = "market_cap", least: int = 40) -> DataFrame:
    """Market cap over each statement item, {item}_inverse, for symbols with ``least`` values or more; else null."""
    items = list(items)
    rows = daily.withColumns({f"{i}_inverse": ratio(F.col(cap), F.col(i)) for i in items})
    n = Window.partitionBy("symbol")
    return rows.withColumns({f"{i}_inverse": F.when(F.count(f"{i}_inverse").over(n) >= least, F.col(f"{i}_inverse")) for i in items})


# An owner's report: each figure and the lower-case vendor columns that may hold it.
POSITIONS = {
    "investor_count": ("investor_count", "investorcount", "investorscount", "holdercount", "holderscount", "institutionalholders", "numberofinvestors", "numberofholders"),
    "shares_held": ("shares_held", "sharesheld", "totalshares", "sharecount", "shares", "institutionalshares"),
    "investment_value": ("investment_value", "investmentvalue", "totalinvestmentvalue", "marketvalue", "positionvalue"),
    "ownership_pct": ("ownership_pct", "ownershippct", "ownershippercentage", "ownershippercent"), "shares_change": ("shares_change", "shareschange", "changeinshares", "sharechange"),
    "investment_change": ("investment_change", "investmentchange", "changeininvestment", "valuechange"), "ownership_pct_change": ("ownership_pct_change", "ownershippctchange", "ownershippercentagechange", "changeinownership"),
    "put_call_ratio": ("put_call_ratio", "putcallratio", "putcall"), "call_count": ("call_count", "callcount", "calls", "callscount"), "put_count": ("put_count", "putcount", "puts", "putscount"),
}


def positions_summary(reports: DataFrame) -> DataFrame:
    """Owners' reports (symbol, date, vendor columns) as ps__ figures with difference and relative change from the report before, and three ratios of them."""
    lower = {c.lower(): c for c in reports.columns}
    there = {k: F.col(next(lower[a] for a in names if a in lower)).try_cast("double") for k, names in POSITIONS.items() if any(a in lower for a in names)}
    rows = reports.select("symbol", "date", *[c.alias(f"ps__{k}") for k, c in there.items()])
    w = Window.partitionBy("symbol").orderBy("date")
    before = lambda k: F.lag(f"ps__{k}").over(w)
    out: dict[str, Column] = {}
    for k in ("investor_count", "shares_held", "investment_value", "ownership_pct", "put_call_ratio"):
        if k in there:
            out |= {f"ps__{k}_change": F.col(f"ps__{k}") - before(k), f"ps__{k}_pct_change": ratio(F.col(f"ps__{k}"), before(k)) - 1}
    for name, a, b in (("shares_per_investor", "shares_held", "investor_count"), ("investment_per_investor", "investment_value", "investor_count"), ("shares_ownership_ratio", "shares_held", "ownership_pct")):
        if a in there and b in there:
            out[f"ps__{name}"] = ratio(F.col(f"ps__{a}"), F.col(f"ps__{b}"))
    return rows.withColumns(out)


def with_days_since(grid: DataFrame, sparse: DataFrame, name: str) -> DataFrame:
    """`to_daily` with the days since the row's own date as ``name``."""
    rows = to_daily(grid, sparse.withColumn("__own", F.col("date")))
    return rows.withColumn(name, F.datediff("date", "__own")).drop("__own")
