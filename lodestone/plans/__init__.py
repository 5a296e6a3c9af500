"""All queries of the market-data operators."""

from lodestone.plans import compare, evaluate, events, fundamentals, indicators, labels, options, planning, prices, research, sections, streams, tables, warehouse  # noqa: F401
from lodestone.plans.registry import ORACLE_SQL, QUERIES

__all__ = ["ORACLE_SQL", "QUERIES"]
