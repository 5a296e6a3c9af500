"""Calendars, screeners, macro tables, and stored tables: reading, splitting, deleting, feature tables by recipe."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestone.functions.columns import numeric, snake
from lodestone.sources.normalize import keep_last

# The date column of each equity calendar.
CALENDAR_DATES = {"earnings": "report_date", "dividends": "ex_dividend_date", "splits": "date", "ipo": "ipo_date"}


def normalize_calendar(raw: DataFrame, numbers: Iterable[str]) -> DataFrame:
    """An economic calendar: its date parsed, the number columns finite doubles; rows without a date are left out."""
    return raw.withColumns({"date": F.col("date").cast("date")} | {c: numeric(F.col(c)) for c in numbers}).filter("date is not null")


def normalize_equity_calendar(raw: DataFrame, section: str) -> DataFrame:
    """Snake-case columns and ``date`` from the section's own date column."""
    named = raw.toDF(*[snake(c) for c in raw.columns])
    own = CALENDAR_DATES[section]
    rows = named.withColumn("date", F.col(own).cast("date")).filter("date is not null")
    return rows if own == "date" else rows.drop(own)


def latest_by(raw: DataFrame, keys: Iterable[str], order: Iterable[str]) -> DataFrame:
    """One row of each key, the last in order: country risk premia and the like."""
    return keep_last(raw, keys, order)


def normalize_screener(raw: DataFrame) -> DataFrame:
    """Snake-case columns, upper-case symbols, none blank."""
    rows = raw.toDF(*[snake(c) for c in raw.columns]).withColumn("symbol", F.upper(F.trim("symbol")))
    return rows.filter("symbol is not null and symbol <> ''")


def split_columns(df: DataFrame, columns: Iterable[str], provider: str) -> DataFrame:
    """The listed columns, the ``provider__`` prefix stripped."""
    prefix = f"{provider}__"
    return df.select(*[F.col(c).alias(c.removeprefix(prefix)) for c in columns if c in df.columns])


def without(df: DataFrame, gone: DataFrame, keys: Iterable[str]) -> DataFrame:
    """Rows whose key is not in ``gone``; a null key stays."""
    return df.join(gone.select(*keys).distinct(), list(keys), "left_anti")


def fallback(*tables: DataFrame, key: str = "symbol") -> DataFrame:
    """Each symbol's rows from the first table that has any."""
    rows = None
    for i, t in enumerate(tables):
        some = t.withColumn("__source", F.lit(i))
        rows = some if rows is None else rows.unionByName(some, allowMissingColumns=True)
    first = rows.groupBy(key).agg(F.min("__source").alias("__source"))
    return rows.join(first, [key, "__source"], "left_semi").drop("__source")


def recipe_id(recipe: Mapping) -> str:
    """16 hex digits of the digest of the recipe's sorted JSON."""
    return hashlib.sha256(json.dumps(recipe, sort_keys=True, default=str).encode()).hexdigest()[:16]


def write_features(features: DataFrame, path: str, recipe: Mapping) -> None:
    """Write or replace the features of a recipe in the table at ``path``."""
    rows = features.withColumn("recipe", F.lit(recipe_id(recipe)))
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("recipe").parquet(path)


def read_features(spark: SparkSession, path: str, recipe: Mapping, start: str | None = None, end: str | None = None) -> DataFrame:
    """The features of a recipe, by partition pruning, within [start, end]."""
    rows = spark.read.parquet(path).filter(F.col("recipe") == recipe_id(recipe)).drop("recipe")
    for day, keep in ((start, lambda d: F.col("date") >= d), (end, lambda d: F.col("date") <= d)):
        rows = rows.filter(keep(F.lit(day).cast("date"))) if day else rows
    return rows


def save(df: DataFrame, path: str, kind: str = "parquet") -> None:
    """Parquet, or CSV with a header."""
    df.write.mode("overwrite").parquet(path) if kind == "parquet" else df.write.mode("overwrite").option("header", True).csv(path)
