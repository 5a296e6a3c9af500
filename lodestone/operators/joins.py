"""Joins of market panels, by (symbol, date) and other keys. Which side is sent where is left to Spark."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KEY = ("symbol", "date")


def events_with_features(events: DataFrame, features: DataFrame, columns: Iterable[str], *, carry: Iterable[str] = ()) -> DataFrame:
    """Distinct events (symbol, date and ``carry``) with the features of their day; events without any are left out."""
    return events.select(*KEY, *carry).distinct().join(features.select(*KEY, *columns), list(KEY))


def features_with_targets(features: DataFrame, targets: DataFrame, columns: Iterable[str]) -> DataFrame:
    """All feature rows, with the targets of their day or nulls."""
    return features.join(targets.select(*KEY, *columns), list(KEY), "left")


def enrich(rows: DataFrame, profiles: DataFrame, columns: Iterable[str]) -> DataFrame:
    """All rows; each column's own value, else the profile's. A column that ``rows`` lacks is the profile's alone."""
    columns = list(columns)
    side = profiles.select("symbol", *[F.col(c).alias(f"{c}_profile") for c in columns])
    joined = rows.join(side, "symbol", "left")
    return joined.withColumns({c: F.coalesce(c, f"{c}_profile") if c in rows.columns else F.col(f"{c}_profile") for c in columns}).drop(*[f"{c}_profile" for c in columns])


def combine_targets(panels: Iterable[DataFrame]) -> DataFrame:
    """All rows of any panel (symbol, date, targets of names of their own); a target is 0 where its panel lacks the row or the value."""
    return reduce(lambda a, b: a.join(b, list(KEY), "full"), panels).transform(lambda d: d.fillna(0, [c for c in d.columns if c not in KEY]))


def metrics_with_ratios(metrics: DataFrame, ratios: DataFrame, keys: Iterable[str] = ("symbol", "date", "period")) -> DataFrame:
    """All reports of either table; of columns that both have, the first table's value, else the second's."""
    keys = list(keys)
    both = [c for c in metrics.columns if c in ratios.columns and c not in keys]
    joined = metrics.join(ratios.withColumnsRenamed({c: f"{c}__right" for c in both}), keys, "full")
    return joined.withColumns({c: F.coalesce(c, f"{c}__right") for c in both}).drop(*[f"{c}__right" for c in both])


def entry_exit_contracts(entry: DataFrame, exit_: DataFrame, columns: Iterable[str], *, by: Iterable[str] = ("trade_id",), fallback: Iterable[str] = ("option_type", "expiration", "strike")) -> DataFrame:
    """Contracts quoted at a trade's entry with their quote at its exit: columns with suffixes _entry and _exit.

    By contract_symbol; an entry that finds none is matched by ``fallback`` instead. An entry without either is left out.
    """
    by, fallback, columns = list(by), list(fallback), list(columns)
    a = entry.select(*by, "contract_symbol", *fallback, *[F.col(c).alias(f"{c}_entry") for c in columns])
    b = exit_.select(*by, "contract_symbol", *fallback, *[F.col(c).alias(f"{c}_exit") for c in columns])
    exact = a.join(b.drop(*fallback), [*by, "contract_symbol"])
    rest = a.join(b.select(*by, "contract_symbol").distinct(), [*by, "contract_symbol"], "left_anti")
    return exact.unionByName(rest.join(b.drop("contract_symbol"), [*by, *fallback]).select(*exact.columns))


def lacking(rows: DataFrame, sections: DataFrame, section: str) -> DataFrame:
    """Rows (symbol, ...) whose symbol has nothing in the section."""
    return rows.join(sections.filter(F.col("section") == section).select("symbol"), "symbol", "left_anti")


def only(rows: DataFrame, keys: DataFrame, on: Iterable[str] = ("symbol",)) -> DataFrame:
    """Rows whose key stands in ``keys``, each once, however often it does."""
    return rows.join(keys.select(*on), list(on), "left_semi")
