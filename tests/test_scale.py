"""Operators over dominant or absent keys: results against plain ones, and the sizes of what a task holds."""

import math
import random
from datetime import date, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from lodestone.operators import asof, labels, quantiles


def sides(n, seed, keys):
    rng = random.Random(seed)
    day = lambda: None if rng.random() < 0.02 else date(2020, 1, 1) + timedelta(days=rng.randrange(900))
    key = lambda: rng.choice(keys)
    left = [(i, key(), day()) for i in range(n)]
    right = [(key(), day(), rng.randrange(5), None if rng.random() < 0.2 else rng.random()) for _ in range(n // 3)]
    return left, right


def plain(left, right, by, direction, exact, tolerance):
    out = {}
    for i, k, t in left:
        ok = [(x[1], x[2], x[3] is not None, x[3] or 0, x) for x in right if x[1] is not None and t is not None and (not by or x[0] == k and k is not None)]
        before = [x for x in ok if (x[0] < t or exact and x[0] == t)]
        after = [x for x in ok if (x[0] > t or exact and x[0] == t)]
        b = max(before, default=None)
        a = max((x for x in after if x[0] == min(after)[0]), default=None)
        found = b if direction == "backward" else a
        if found and tolerance is not None and abs((found[0] - t).days) > tolerance:
            found = None
        out[i] = found and (found[4][1], found[4][2], found[4][3])
    return out


@pytest.mark.parametrize("direction,exact,tolerance", [("backward", True, None), ("backward", False, 3), ("forward", True, None), ("forward", False, 5)])
@pytest.mark.parametrize("by", [(), ("k",)])
def test_sliced_asof_equals_a_plain_one(spark, by, direction, exact, tolerance):
    left, right = sides(900, 1, ["hot"] * 6 + ["a", "b", None])
    l_df = spark.createDataFrame(left, "i int, k string, t date")
    r_df = spark.createDataFrame([x if by else x[1:] for x in right], ("k string, " if by else "") + "d date, seq int, v double")
    got = asof.asof_join(l_df, r_df, left_on="t", right_on="d", by=by, direction=direction, exact=exact, tolerance=tolerance, order=("seq",), slices=16).collect()
    assert {r.i: None if r.d is None else (r.d, r.seq, r.v) for r in got} == plain(left, right, by, direction, exact, tolerance)
    assert len(got) == len(left)


def test_no_task_holds_a_dominant_key(spark):
    """Half of all rows have one symbol: what a (key, slice) holds stays near the median of that key's slices, and far below the key."""
    rows = spark.range(40_000).select(F.when(F.col("id") % 2 == 0, "hot").otherwise(F.concat(F.lit("s"), F.col("id") % 3000)).alias("k"), (F.col("id") * 7919 % 40_000).alias("__at"), F.lit(1).alias("__side"), F.lit(None).cast("struct<x:int>").alias("__right"), F.struct(F.col("id").alias("i")).alias("__left"))
    for by, most in ((("k",), 20_000), ((), 40_000)):
        rows = rows if by else rows.drop("k")
        sizes = [r["count"] for r in asof._sliced(rows.withColumn("__slice", F.lit(0)), by, True, 64).groupBy(*by, "__slice").count().collect()]
        assert max(sizes) < 2 * most / 64 and sum(sizes) == 40_000


@pytest.mark.parametrize("heavy", [1000, 3])
def test_exact_quantiles(spark, monkeypatch, heavy):
    monkeypatch.setattr(quantiles, "HEAVY", heavy)
    rng = random.Random(heavy)
    rows = [("ties" if i % 3 == 0 else "wide" if i % 3 == 1 else None, 7.0 if i % 3 == 0 and i % 2 else rng.gauss(0, 10 ** rng.randrange(4))) for i in range(6000)]
    rows += [("few", float(x)) for x in (3, 1, 2)] + [("one", 5.0), ("none", None)]
    df = spark.createDataFrame(rows, "k string, v double")
    shares = (0.0, 0.01, 0.25, 0.5, 0.99, 1.0)
    got = {r.k: r.quantiles for r in quantiles.exact_quantiles(df, "v", shares, ("k",), slices=16).collect()}
    for k in ("ties", "wide", None, "few", "one"):
        assert np.allclose(got.pop(k), np.quantile([v for g, v in rows if g == k], shares), rtol=1e-12)
    assert not got
    all_rows = quantiles.exact_quantiles(df, "v", (0.5,), ()).collect()
    assert math.isclose(all_rows[0].quantiles[0], np.quantile([v for _, v in rows if v is not None], 0.5))
    assert quantiles.exact_quantiles(df.limit(0), "v", (0.5,), ("k",)).count() == 0


def test_trade_statistics_and_ranks_of_nulls(spark):
    df = spark.createDataFrame([(i, None if i % 3 == 0 else float(i % 5)) for i in range(60)], "i int, v double")
    got = labels.global_pct_rank(df, "v").collect()
    assert len(got) == 60 and all((r.rank_pct is None) == (r.v is None) for r in got)
    values = sorted(r.v for r in got if r.v is not None)
    for r in got:
        if r.v is not None:
            at = [i + 1 for i, v in enumerate(values) if v == r.v]
            assert math.isclose(r.rank_pct, sum(at) / len(at) / len(values))


def test_normality(spark):
    """The worked example of D'Agostino, Belanger and D'Agostino (1990): 62 values, skewness 1.02, kurtosis 4.58, K squared 14.75."""
    df = spark.createDataFrame([(62.0, 1.02, 1.58)], "n double, s double, k double")
    p = df.select(labels.normality(F.col("n"), F.col("s"), F.col("k"))).first()[0]
    assert math.isclose(-2 * math.log(p), 14.75, rel_tol=0.01)
    df = spark.createDataFrame([("short", 1.0)] * 7 + [("flat", 2.0)] * 20, "k string, v double")
    assert [r.normal_p for r in labels.distribution(df, "v", "k").collect()] == [None, None]
