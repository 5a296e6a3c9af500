"""Optimal trades of many groups at once, and how often the queries compute them."""

from datetime import date, timedelta

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from lodestone.functions.batches import whole_groups
from lodestone.operators import labels

SF = "/root/testdata/sf0.001"


def best(a, b, k, start, sign):
    """The largest gain of at most k trades from a row on, by trying all."""
    top = 0.0
    if k:
        for i in range(start, len(a)):
            for j in range(i + 1, len(a)):
                if sign * (b[j] - a[i]) >= 0.05 * abs(a[i]):
                    top = max(top, sign * (b[j] - a[i]) + best(a, b, k - 1, j + 1, sign))
    return top


@pytest.mark.parametrize("short", [False, True])
def test_groups_side_by_side_equal_exhaustive_search(short):
    rng, sign = np.random.default_rng(7), -1 if short else 1
    sizes = rng.integers(1, 9, 60)
    a = np.full((8, 60), np.nan)
    for g, n in enumerate(sizes):
        a[:n, g] = rng.integers(5, 12, n) if g % 2 else rng.uniform(5, 15, n)
    b = a + 0.5 * sign
    for k, trades in enumerate(labels.best_trade_sets(a, b, 3, 0.05, short), 1):
        for g, n in enumerate(sizes):
            got = [(int(i[of == g][0]), int(j[of == g][0])) for of, i, j in trades if (of == g).any()]
            assert all(i < j < n for i, j in got) and all(x[1] < y[0] for x, y in zip(got, got[1:], strict=False)) and len(got) <= k
            assert sum(sign * (b[j, g] - a[i, g]) for i, j in got) == pytest.approx(best(a[:n, g], b[:n, g], k, 0, sign), abs=1e-9)


def test_tables_hold_whole_groups():
    keys = [None] * 3 + ["a"] * 50 + ["b"] + ["c"] * 7
    batches = [pa.record_batch({"k": pa.array(keys[i : i + 4], pa.string()), "i": list(range(i, min(i + 4, len(keys))))}) for i in range(0, len(keys), 4)]
    tables = list(whole_groups(batches, "k", rows=6))
    assert [i for t in tables for i in t.column("i").to_pylist()] == list(range(len(keys)))
    held = [set(t.column("k").to_pylist()) for t in tables]
    assert len(tables) > 2 and sum(len(h) for h in held) == 4
    assert list(whole_groups([], "k")) == []


def test_several_frequencies_equal_each_alone(spark):
    rng = np.random.default_rng(3)
    rows = pd.DataFrame([(s, date(2023, 11, 20) + timedelta(days=int(d)), *rng.uniform(5, 15, 2)) for s in ("A", "B", None) for d in range(0, 200, 3)], columns=["symbol", "date", "low", "high"])
    p = spark.createDataFrame(rows)
    both = labels.oracle_trades(p, freq={"YE": (1, 2), "QE": (1,)})
    alone = labels.oracle_trades(p, ks=(1, 2)).unionByName(labels.oracle_trades(p, freq="QE", ks=(1,)))
    assert both.count() == alone.count() > 12 and both.exceptAll(alone).count() == 0 and both.filter("symbol is null").count() == 0
    assert labels.oracle_trades(p.filter(F.lit(False))).count() == 0


# queries that failed by time: groups went through pandas one by one, and trades were computed for each frequency and use
@pytest.mark.parametrize("name", [
    "l05_completed_k1", "l06_deduped_k1", "l14_label_build", "l08_statistics_k1", "l11_l13_actions_k1", "l13_label_panel_k1", "l07_l09_l10_weights_k1", "l07_l09_l10_weighted_labels",
])
def test_trades_are_computed_once(spark, name):
    plan = entry.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "FlatMapGroupsInPandas" not in plan and plan.count("MapInArrow") <= 1
