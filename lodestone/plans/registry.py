"""The registered queries and the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None, *, floats: Iterable[str] = (), dates: Iterable[str] = ("date",), digits: int = 6) -> Callable[[Query], Query]:
    """Register a query. Both sides round ``floats``, as sums of floats depend on their order, and give days as text.

    Prices are short decimals, whose means often lie exactly between two rounded values; a nudge of a fraction of the last digit settles those, and adding 0 makes a negative zero a plain one.
    """
    floats, dates, nudge = tuple(floats), tuple(dates), 0.03 * 10**-digits

    def add(f: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            df = f(spark, sf_dir)
            return df.withColumns({c: F.round(F.col(c) + nudge, digits) + 0.0 for c in floats} | {c: F.col(c).cast("string") for c in dates if c in df.columns})

        QUERIES[name] = run
        if sql:
            changed = [f"round({c} + {nudge!r}, {digits}) + 0.0 AS {c}" for c in floats] + [f"cast({c} AS VARCHAR) AS {c}" for c in dates]
            ORACLE_SQL[name] = f"SELECT * REPLACE ({', '.join(changed)}) FROM (\n{sql}\n)" if changed else sql
        return f

    return add
