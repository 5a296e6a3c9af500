"""What to build, as plain objects: sections of the warehouse, feature toggles, label builds, and the readers they serve."""

from __future__ import annotations

from dataclasses import dataclass, field, fields

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The sections of the warehouse, by what they are about.
EQUITY_SECTIONS = (
    "income", "balance", "cash", "metrics", "ratios", "income_growth", "balance_growth", "cash_growth", "dividends", "historical_eps", "historical_splits", "reported_financials", "revenue_per_geography",
    "revenue_per_segment", "trailing_dividend_yield", "employee_count", "historical_market_cap", "esg_score", "management_compensation", "management", "filings", "transcript", "compare_peers", "estimates_historical",
    "estimates_consensus", "estimates_forward_eps", "estimates_forward_ebitda", "estimates_price_target", "ownership_insider_trading", "ownership_government_trades", "ownership_institutional", "ownership_share_statistics",
)
ETF_SECTIONS = ("etf_holdings", "etf_sectors", "etf_countries", "etf_equity_exposure", "etf_nport_disclosure", "etf_price_performance")
MORE_SECTIONS = ("earnings", "financial_growth", "senate_trading")
CALENDAR_SECTIONS = ("equity_calendar_earnings", "equity_calendar_dividend", "equity_calendar_splits", "equity_calendar_ipo")
PRICE_SECTIONS = ("prices", "etf_prices", "fund_prices", "crypto_prices", "currency_prices", "index_prices")
PROFILE_SECTIONS = ("profile", "etf_profile")
MACRO_SECTIONS = ("macro_economic", "macro_treasury", "macro_yield_curve", "macro_calendar", "macro_risk_premium")
# Sections of annual or quarterly periods; rows that are the whole state of a day; sections that can be fetched by a range of dates.
PERIOD_SECTIONS = ("income", "balance", "cash", "metrics", "ratios", "income_growth", "balance_growth", "cash_growth", "reported_financials", "revenue_per_geography", "revenue_per_segment")
SNAPSHOT_SECTIONS = ("etf_holdings", "etf_sectors", "etf_countries", "etf_equity_exposure", "etf_price_performance", "management", "compare_peers", "estimates_consensus", "ownership_institutional", "ownership_share_statistics")
WINDOWED_SECTIONS = (
    *PRICE_SECTIONS, "historical_market_cap", "income", "balance", "cash", "metrics", "ratios", "income_growth", "balance_growth", "cash_growth", "dividends", "historical_eps", "historical_splits", "employee_count",
    "esg_score", "management_compensation", "estimates_historical", "estimates_forward_eps", "estimates_forward_ebitda", "ownership_insider_trading", "ownership_government_trades", "filings", "estimates_price_target",
    "revenue_per_geography", "revenue_per_segment",
)
# Sections of several rows a day, and the column that tells these apart.
PANEL_DIMENSIONS = {
    "revenue_per_segment": "business_line", "revenue_per_geography": "region", "etf_nport_disclosure": "cusip", "ownership_insider_trading": "owner_name", "ownership_government_trades": "representative",
    "estimates_price_target": "analyst_name", "filings": "report_type", "transcript": "quarter", "equity_calendar_earnings": "symbol", "equity_calendar_dividend": "symbol", "equity_calendar_splits": "symbol", "equity_calendar_ipo": "symbol",
}
# What is fetched of the markets and series without a list of symbols; the symbols that stand for whole bundles.
DEFAULT_SYMBOLS = {
    "crypto_prices": ("BTCUSD", "ETHUSD", "SOLUSD", "XRPUSD", "ADAUSD", "DOGEUSD", "BNBUSD", "LTCUSD"), "currency_prices": ("EURUSD", "GBPUSD", "USDJPY", "AUDUSD", "USDCAD", "USDCHF", "NZDUSD"),
    "index_prices": ("^GSPC", "^DJI", "^IXIC", "^VIX", "^RUT"),
    "macro_economic": ("GDP", "CPI", "unemploymentRate", "inflationRate", "federalFunds", "retailSales", "industrialProductionTotalIndex", "totalNonfarmPayroll", "initialClaims", "newPrivatelyOwnedHousingUnitsStartedTotalUnits"),
    "macro_treasury": ("TREASURY_CURVE",), "macro_yield_curve": ("YIELD_CURVE",), "macro_calendar": ("MACRO_CALENDAR",), "macro_risk_premium": ("RISK_PREMIUM",), **dict.fromkeys(CALENDAR_SECTIONS, ("EQUITY_CALENDAR",)),
}
# The column that dates a kind of section's rows, and the names of a period.
DATED_BY = {"period": "period_ending", "snapshot": "as_of"}
PERIODS = {"quarter": "quarter", "quarterly": "quarter", "annual": "annual", "year": "annual", "yearly": "annual"}
ALL_SECTIONS = tuple(dict.fromkeys((*PRICE_SECTIONS, *PROFILE_SECTIONS, *EQUITY_SECTIONS, *ETF_SECTIONS, *MORE_SECTIONS, *CALENDAR_SECTIONS, *MACRO_SECTIONS, "economic_calendar")))


def section_kind(section: str) -> str:
    """period, snapshot, calendar, price, macro, or dated (rows of single days)."""
    if section not in ALL_SECTIONS:
        raise ValueError(f"unknown section {section}")
    kinds = (("period", PERIOD_SECTIONS), ("snapshot", (*SNAPSHOT_SECTIONS, *PROFILE_SECTIONS)), ("calendar", (*CALENDAR_SECTIONS, "economic_calendar")), ("price", PRICE_SECTIONS), ("macro", MACRO_SECTIONS))
    return next((k for k, names in kinds if section in names), "dated")


def period_of(section: str, preferred: str | None = "quarter") -> str | None:
    """The period to ask for, quarterly unless another is preferred; none where the section has no periods."""
    return PERIODS.get((preferred or "quarter").strip().lower(), "quarter") if section in PERIOD_SECTIONS else None


def library_of(section: str) -> str:
    """The name of the table that holds a section: company sections carry a prefix, all others their own name."""
    return f"fundamental_{section}" if section in EQUITY_SECTIONS or section in MORE_SECTIONS else section


def registry(spark: SparkSession) -> DataFrame:
    """The sections as a table: section, library, kind, period, dimension, windowed, default_symbols."""
    rows = [(s, library_of(s), section_kind(s), period_of(s), PANEL_DIMENSIONS.get(s), s in WINDOWED_SECTIONS, list(DEFAULT_SYMBOLS.get(s, ()))) for s in ALL_SECTIONS]
    return spark.createDataFrame(rows, "section string, library string, kind string, period string, dimension string, windowed boolean, default_symbols array<string>")


def read_section(rows: DataFrame, section: str, *, symbols: tuple[str, ...] = (), start: str | None = None, end: str | None = None, columns: tuple[str, ...] = ()) -> DataFrame:
    """Rows of a section table from ``start`` to ``end``, both included, of some symbols and columns (all by default); filters reach the scan."""
    date = DATED_BY.get(section_kind(section), "date")
    rows = rows.filter(F.col("symbol").isin(*symbols)) if symbols else rows
    rows = rows.filter(F.col(date) >= F.lit(start).cast("date")) if start else rows
    rows = rows.filter(F.col(date) <= F.lit(end).cast("date")) if end else rows
    return rows.select(*dict.fromkeys(c for c in ("symbol", date, *columns) if c in rows.columns)) if columns else rows


def read_chain(chain: DataFrame, *, underlyings: tuple[str, ...] = (), start: str | None = None, end: str | None = None, columns: tuple[str, ...] = ()) -> DataFrame:
    """Quotes of snapshots from the start of ``start`` to the end of ``end``, whether snapshot_date is a day or a time; snapshot_date is always read."""
    rows = chain.filter(F.col("underlying").isin(*underlyings)) if underlyings else chain
    rows = rows.filter(F.col("snapshot_date") >= F.lit(start).cast("date")) if start else rows
    rows = rows.filter(F.col("snapshot_date") < F.date_add(F.lit(end).cast("date"), 1)) if end else rows
    return rows.select(*dict.fromkeys(("underlying", "snapshot_date", *columns))) if columns else rows


@dataclass(frozen=True)
class FeatureSpec:
    """Which feature sets to build, and from when to when."""

    technical: bool = True
    time: bool = True
    key_metrics: bool = True
    ratios: bool = True
    income: bool = True
    income_ttm: bool = False
    cash_flow: bool = True
    cash_flow_ttm: bool = False
    balance: bool = True
    balance_ttm: bool = False
    growth: bool = True
    earnings: bool = True
    estimates: bool = True
    insider: bool = True
    positions: bool = True
    start: str | None = None
    end: str | None = None
    filing_lag_days: int = 45

    def chosen(self) -> tuple[str, ...]:
        """The names of the sets that are on."""
        return tuple(f.name for f in fields(self) if f.type == "bool" and getattr(self, f.name))

    def build(self, sets: dict[str, DataFrame], grid: DataFrame) -> DataFrame:
        """The grid within the dates with the chosen ones of ``sets``; a chosen set that isn't given is an error."""
        from lodestone.operators.fundamental import merge_features

        missing = [n for n in self.chosen() if n not in sets]
        if missing:
            raise ValueError(f"no feature set for {', '.join(missing)}")
        grid = grid.filter(F.col("date") >= F.lit(self.start).cast("date")) if self.start else grid
        grid = grid.filter(F.col("date") <= F.lit(self.end).cast("date")) if self.end else grid
        return merge_features(grid, [sets[n] for n in self.chosen()])


@dataclass(frozen=True)
class LabelSpec:
    """Which optimal trades to label: the least profit in percent, counts of trades by frequency, sides, costs in basis points."""

    min_profit_pct: float = 5.0
    ks: dict[str, tuple[int, ...]] = field(default_factory=lambda: {"YE": (1, 2, 3), "QE": (1,)})
    sides: tuple[str, ...] = ("long", "short")
    fee_bps: float = 1.0
    slip_bps: float = 2.0

    def __post_init__(self) -> None:
        if self.min_profit_pct < 0 or not self.ks or any(k < 1 for v in self.ks.values() for k in v) or not set(self.sides) <= {"long", "short"}:
            raise ValueError("profit, counts or sides of the label specification don't make sense")

    @property
    def least(self) -> float:
        return self.min_profit_pct / 100

    def trades(self, prices: DataFrame) -> DataFrame:
        """The optimal trades of every frequency, each once."""
        from lodestone.operators import labels

        return labels.oracle_trades(prices, freq=self.ks, least=self.least, sides=self.sides)

    def labels(self, prices: DataFrame) -> DataFrame:
        """Label rows with weights, net of costs."""
        from lodestone.operators import labels

        return labels.weighted_labels(labels.optimal_events(labels.dedupe_trades(self.trades(prices)), fee_bps=self.fee_bps, slip_bps=self.slip_bps))
