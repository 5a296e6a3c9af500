"""Feature builders of the user's own, run on each symbol's rows."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame

BUILDERS: dict[str, tuple[Callable[[str, pd.DataFrame], pd.DataFrame], str]] = {}


def register_feature_builder(name: str, columns: str) -> Callable:
    """Register ``f(symbol, prices) -> features`` (one row for each of the symbol's rows, in date order); ``columns``: DDL of what it adds."""

    def add(f: Callable[[str, pd.DataFrame], pd.DataFrame]):
        BUILDERS[name] = (f, columns)
        return f

    return add


def build_features(prices: DataFrame, name: str) -> DataFrame:
    """(symbol, date) and the builder's columns."""
    f, columns = BUILDERS[name]
    names = [c.split()[0] for c in columns.split(",")]

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("date", kind="stable").reset_index(drop=True)
        made = f(pdf["symbol"].iat[0], pdf).reset_index(drop=True)
        return pd.concat([pdf[["symbol", "date"]], made[[c.strip() for c in names]]], axis=1)

    kinds = dict(prices.dtypes)
    return prices.groupBy("symbol").applyInPandas(run, f"symbol {kinds['symbol']}, date {kinds['date']}, {columns}")
