"""Price features of symbols given out of order, with nulls and other number types; shuffles and sorts of prices."""

from datetime import date, timedelta
from decimal import Decimal

import numpy as np
import pytest

from lodestone.operators import technical
from lodestone.views import prices


def test_features_of_unordered_rows_with_nulls(spark):
    days = [date(2024, 1, 1) + timedelta(days=i) for i in range(40)]
    close = {s: [None if (i + n) % 11 == 5 else Decimal(100 + (i * 7 + n) % 13) for i in range(40)] for n, s in enumerate(("A", None))}
    rows = [(s, d, c, i) for s in close for i, (d, c) in enumerate(zip(days, close[s], strict=True))]
    np.random.default_rng(1).shuffle(rows)
    df = spark.createDataFrame([tuple(r) for r in rows], "symbol string, date date, close decimal(10,2), `a row` int")
    made = technical.moving_averages(df, (5,))
    got = {(r.symbol, r.date): r for r in made.collect()}
    assert "FlatMapGroupsInPandas" not in made._jdf.queryExecution().executedPlan().toString()
    assert len(got) == 80 and made.columns == [*df.columns, "px__sma_5", "px__dist_sma_5", "px__sma_slope_5"]
    for s, values in close.items():
        for i, d in enumerate(days):
            window = values[max(0, i - 4) : i + 1]
            r = got[s, d]
            assert r["a row"] == i and r.close == values[i]
            want = None if len(window) < 5 or None in window else sum(window) / 5
            assert r.px__sma_5 == (want if want is None else pytest.approx(float(want)))


def test_prices_are_shuffled_and_sorted_once(spark):
    """Failed before: two shuffles, and the sums in parts of prices that hardly add up."""
    made = technical.moving_averages(prices(spark, "/root/testdata/sf0.001"), (5,))
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and plan.count("- Sort [") == 1
