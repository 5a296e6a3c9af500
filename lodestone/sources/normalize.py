"""Vendor frames to canonical tables."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestone.functions.columns import numeric, snake

# Canonical price columns and the vendor names they go by.
PRICE_ALIASES = {
    "open": ("open", "o", "open_price"), "high": ("high", "h", "high_price"), "low": ("low", "l", "low_price"), "close": ("close", "c", "close_price"), "volume": ("volume", "v", "vol"),
    "adj_open": ("adj_open", "adjopen"), "adj_high": ("adj_high", "adjhigh"), "adj_low": ("adj_low", "adjlow"), "adj_close": ("adj_close", "adjclose", "adjusted_close"),
}
# No row is older; foreign listings by suffix; other names of countries and exchanges.
EARLIEST = "1900-01-01"
FOREIGN = (".TO", ".L", ".DE", ".PA", ".HK", ".T", ".AX", ".SW", ".MI", ".AS", ".NS")
COUNTRIES = {"USA": "US", "UNITED STATES": "US", "UNITED KINGDOM": "GB", "UK": "GB", "GERMANY": "DE", "FRANCE": "FR", "CHINA": "CN", "JAPAN": "JP", "CANADA": "CA", "INDIA": "IN", "BRAZIL": "BR", "RUSSIA": "RU"}


def keep_last(df: DataFrame, keys: Iterable[str], order: Iterable[str | Column]) -> DataFrame:
    """Of rows with equal keys (nulls are equal) the last in order."""
    w = Window.partitionBy(*keys).orderBy(*[F.desc_nulls_last(o) if isinstance(o, str) else o for o in order])
    return df.withColumn("__n", F.row_number().over(w)).filter("__n = 1").drop("__n")


def normalize_prices(raw: DataFrame, provider: str, *, seq: str = "seq", keys: tuple[str, ...] = ("symbol",), floor: DataFrame | None = None) -> DataFrame:
    """Canonical columns as finite doubles, others as ``provider__name``; the last row by ``seq`` of a key and date; none before the floor (see `clip_to_floor`)."""
    alias = {a: c for c, names in PRICE_ALIASES.items() for a in names}
    out: dict[str, Column] = {}
    for c in raw.columns:
        if c in (*keys, "date", seq):
            continue
        name = snake(c)
        out.setdefault(alias.get(name, f"{provider}__{name}"), numeric(F.col(c)))
    rows = raw.select(*keys, F.col("date").cast("date").alias("date"), seq, *[v.alias(k) for k, v in out.items()]).filter("date is not null")
    return clip_to_floor(keep_last(rows, (*keys, "date"), (seq,)).drop(seq), floor)


def clip_to_floor(df: DataFrame, floor: DataFrame | None = None, *, date: str = "date") -> DataFrame:
    """Rows from the floor on: EARLIEST, or a symbol's listing date in ``floor`` (symbol, listing_date) if later."""
    rows = df.filter(F.col(date) >= F.lit(EARLIEST).cast("date"))
    if floor is None:
        return rows
    known = floor.groupBy("symbol").agg(F.max("listing_date").alias("__from"))
    return rows.join(known, "symbol", "left").filter(F.col("__from").isNull() | (F.col(date) >= F.col("__from"))).drop("__from")


def pick_populated(df: DataFrame, candidates: Iterable[str]) -> str | None:
    """The first candidate column that holds any value; one aggregate over the table."""
    there = [c for c in candidates if c in df.columns]
    if not there:
        return None
    seen = df.agg(*[F.count(c).alias(c) for c in there]).first()
    return next((c for c in there if seen[c]), None)


def normalize_frame(raw: DataFrame, dates: Iterable[str], *, keys: tuple[str, ...] = ("symbol",), seq: str = "seq", drop: Iterable[str] = (), dimensions: Iterable[str] | None = None) -> DataFrame:
    """A vendor table keyed by its first populated date column: snake-case names, finite doubles, the last row of a key.

    With ``dimensions`` the strings stay and those columns belong to the key (a panel); without, strings become numbers (a series).
    """
    at = pick_populated(raw, dates)
    if at is None:
        raise ValueError("no date column holds a value")
    names = [c for c in raw.columns if c not in (*keys, at, seq, *drop)]
    panel = None if dimensions is None else [snake(c) for c in dimensions]
    cast = lambda c: F.col(c) if panel is not None and dict(raw.dtypes)[c] in ("string", "date") else numeric(F.col(c))
    rows = raw.select(*keys, F.col(at).cast("date").alias("date"), seq, *[cast(c).alias(snake(c)) for c in names]).filter("date is not null")
    return keep_last(rows, (*keys, "date", *(panel or ())), (seq,)).drop(seq)


def snapshot(raw: DataFrame, as_of: Column, identity: Iterable[str], *, seq: str = "seq") -> DataFrame:
    """A cross-section stamped with ``as_of``; one row for a stamp and identity."""
    return keep_last(raw.withColumn("as_of", as_of), ("as_of", *identity), (seq,)).drop(seq)


def first_filled(*names: str) -> Column:
    """The first of some text columns that is not blank, trimmed."""
    return F.coalesce(*[F.nullif(F.trim(F.col(c)), F.lit("")) for c in names])


def country_code(c: Column) -> Column:
    pairs = F.create_map(*[F.lit(x) for kv in COUNTRIES.items() for x in kv])
    return F.coalesce(pairs[F.upper(F.trim(c))], F.upper(F.trim(c)))


def screen(profiles: DataFrame, *, least: float | None = None, most: float | None = None, countries: Iterable[str] | None = None, exchanges: Iterable[str] | None = None, funds: bool = False, limit: int | None = None) -> DataFrame:
    """Profiles by market cap, largest first. The limit comes before the country, exchange and fund filters."""
    rows = profiles
    if least is not None:
        rows = rows.filter(F.col("market_cap") >= least)
    if most is not None:
        rows = rows.filter(F.col("market_cap") <= most)
    if limit is not None:
        rows = rows.orderBy(F.desc_nulls_last("market_cap"), "symbol").limit(limit)
    if countries is not None:
        rows = rows.filter(country_code(F.col("country")).isin([COUNTRIES.get(c.upper(), c.upper()) for c in countries]))
    if exchanges is not None:
        rows = rows.filter(F.upper("exchange").isin([e.upper() for e in exchanges]))
    return rows if funds else rows.filter(~F.coalesce("is_etf", F.lit(False)))


def classify_vehicle(symbol: str, is_etf: str, name: str) -> Column:
    """``etf``, ``fund`` (five letters that end in X, or a fund by name) or ``equity``."""
    fund = F.col(symbol).rlike("^[A-Z]{4}X$") | F.lower(F.coalesce(name, F.lit(""))).rlike(r"\bfund\b")
    return F.when(F.coalesce(is_etf, F.lit(False)), "etf").when(fund, "fund").otherwise("equity")


def us_option_symbols(df: DataFrame, symbol: str = "symbol") -> DataFrame:
    """Rows whose symbol has none of the foreign suffixes."""
    return df.filter(~F.upper(symbol).rlike("(" + "|".join(s.replace(".", r"\.") for s in FOREIGN) + ")$"))


def normalize_chain(raw: DataFrame) -> DataFrame:
    """Quotes that can be traded (bid > 0, ask >= 0.01, ask >= bid) with lower-case type, mid and contract_symbol ``SYM_type_yyyymmdd_strike``."""
    kind = F.lower("right")
    strike = F.regexp_replace(F.format_string("%.4f", F.col("strike").cast("double")), r"\.?0+$", "")
    rows = raw.filter((F.col("bid") > 0) & (F.col("ask") >= 0.01) & (F.col("ask") >= F.col("bid")))
    return rows.withColumns({"option_type": kind, "mid": (F.col("bid") + F.col("ask")) / 2, "contract_symbol": F.concat_ws("_", F.upper("underlying"), kind, F.date_format("expiration", "yyyyMMdd"), strike)}).drop("right")


def curve_long_to_wide(long: DataFrame, maturities: Iterable[str], *, seq: str = "seq") -> DataFrame:
    """date x maturity, the last rate of each."""
    return long.groupBy("date").pivot("maturity", list(maturities)).agg(F.max_by("rate", seq))


def curve_wide_to_long(wide: DataFrame, prefix: str = "macro__ust_") -> DataFrame:
    """One series for each maturity column; nulls left out."""
    names = [c for c in wide.columns if c != "date"]
    long = wide.unpivot(["date"], [F.col(c).cast("double").alias(c) for c in names], "maturity", "value")
    return long.filter("value is not null").select(F.concat(F.lit(prefix), "maturity").alias("series_code"), "date", "value")


def economic_series(raw: DataFrame) -> DataFrame:
    """(date, value): the column ``value``, else the first numeric one; nulls dropped."""
    value = "value" if "value" in raw.columns else next(c for c, t in raw.dtypes if c != "date" and t in ("double", "float", "int", "bigint"))
    return raw.select(F.col("date").cast("date").alias("date"), numeric(F.col(value)).alias("value")).dropna()


def renamed(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Columns by another name, as far as they are there."""
    return df.withColumnsRenamed({k: v for k, v in names.items() if k in df.columns})
