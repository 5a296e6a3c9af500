"""Option solvers and the normal distribution against what defines them; the streaming upsert against a batch one."""

import math
import random
from datetime import date, datetime, timedelta

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from lodestone.operators import options as o
from lodestone.streaming import jobs


def optimal(mu, cov, w, aversion, cap):
    """How far the most wanted move of weight from one member to another is from wanting nothing."""
    g = mu - aversion * cov @ w
    return g[w < cap - 1e-9].max(initial=-np.inf) - g[w > 1e-9].min(initial=np.inf)


def test_long_only_weights_are_optimal():
    rng = np.random.default_rng(5)
    for trial in range(300):
        n = int(rng.integers(1, 25))
        a = rng.normal(size=(n, int(rng.integers(1, 30))))
        cov = a @ a.T / a.shape[1] + (np.diag(rng.random(n)) if trial % 2 else 0)
        mu, cap, aversion = rng.normal(size=n), max(float(rng.choice([1, 0.4, 0.15])), 1 / n), float(rng.choice([0.1, 1, 5]))
        for w, c in ((o.mean_variance_weights(mu, cov, aversion=aversion, cap=cap), cov), (o.mean_variance_weights(mu, np.diag(cov), aversion=aversion, cap=cap), np.diag(np.diag(cov)))):
            assert math.isclose(w.sum(), 1, abs_tol=1e-9) and w.min() >= 0 and w.max() <= cap + 1e-12
            assert optimal(mu, c, w, aversion, cap) < 1e-9
        slow = o.mean_variance_weights(mu, cov, aversion=aversion, cap=cap, steps=60)
        value = lambda w: mu @ w - aversion * w @ cov @ w / 2  # noqa: E731, B023
        assert value(o.mean_variance_weights(mu, cov, aversion=aversion, cap=cap)) >= value(slow) - 1e-9


def test_weights_of_odd_groups():
    assert o.mean_variance_weights(np.array([1.0]), np.array([[0.0]])).tolist() == [1.0]
    assert np.allclose(o.mean_variance_weights(np.array([1.0, 1.0]), np.zeros(2)), [0.5, 0.5])
    assert np.allclose(o.mean_variance_weights(np.array([2.0, 1.0, 0.0]), np.zeros((3, 3)), cap=0.5), [0.5, 0.5, 0.0])
    assert np.allclose(o.mean_variance_weights(np.array([9.0, 1.0, 0.0]), np.eye(3), eligible=np.array([False, True, True]), aversion=100.0), [0, 0.505, 0.495])
    w = o.mean_variance_weights(np.array([1.0, 0.9, -5.0]), np.eye(3), least=0.05)
    assert w[2] == 0 and math.isclose(w.sum(), 1)


def test_normal_distribution(spark):
    x = [0.0, 1e-9, -1.0, 1.0, 1.96, -3.3, 5.0, 7.05, -7.08, 8.2, -12.0, 36.0, -40.0, 50.0]
    got = [r[0] for r in spark.createDataFrame([(v,) for v in x], "x double").select(o.normal_distribution(F.col("x"))).collect()]
    want = [0.5 * math.erfc(-v / math.sqrt(2)) for v in x]
    assert np.allclose(got, want, rtol=0, atol=1e-15 * 4) and np.allclose(got[:-2], want[:-2], rtol=1e-5, atol=0)


def test_given_greeks_stay_and_odd_quotes_get_none(spark):
    schema = "option_type string, mid double, spot double, strike double, dte int, iv double, delta double"
    rows = [("call", 10.0, 100.0, 100.0, 365, None, None), ("put", 10.0, 100.0, 100.0, 365, 0.25, -0.9), ("call", 200.0, 100.0, 100.0, 30, None, None), ("call", 1.0, 0.0, 100.0, 30, None, None), ("put", 1.0, 100.0, 100.0, 0, None, None), (None, None, None, None, None, None, None)]
    got = o.with_greeks(spark.createDataFrame(rows, schema)).collect()
    assert [r.iv_source for r in got] == ["implied", "vendor", None, None, None, None]
    assert math.isclose(got[0].iv, 0.25133, abs_tol=1e-4) and got[1].delta == -0.9 and got[1].gamma > 0
    assert all(r.delta is None and r.vega is None for r in got[2:])


@pytest.mark.parametrize("cap", [0.5, 0.3, 0.2, 0.1])
def test_capped_weights(spark, cap):
    """Against repeated dealing of what lies above the cap; none above it whenever the cap allows."""
    rng = random.Random(int(cap * 10))
    groups = {"a": [5.0, 1, 1, 1, 1], "b": [9.0, 8, 0.5, 0.25, 0.1, 0, -3], "none": [-1.0, -2], "null": [None, 2.0, None, 1.0], "one": [3.0], "wide": [rng.random() ** 4 for _ in range(30)]}
    rows = [(g, i, None if x is None else float(x), 0.0) for g, xs in groups.items() for i, x in enumerate(xs)]
    got = o.score_weights(spark.createDataFrame(rows, "g string, i int, expected_return double, risk double"), "g", cap=cap, tie="i").collect()
    for g, xs in groups.items():
        raw = np.array([max(x or 0.0, 0.0) for x in xs])
        if raw.sum() == 0:
            raw[int(np.argmax([x or 0.0 for x in xs]))] = 1.0
        p = raw / raw.sum()
        w = np.minimum(p, cap)
        for _ in range(2000):
            left, room = 1 - w.sum(), w < cap - 1e-13
            if left <= 1e-14 or not room.any():
                break
            base = p * room
            w = np.minimum(w + (left * base / base.sum() if base.sum() > 0 else left * room / room.sum()), cap)
        w = w / w.sum()
        mine = np.array([r.weight for r in sorted(got, key=lambda r: r.i) if r.g == g])
        assert np.allclose(mine, w, atol=1e-9), g
        assert cap * len(xs) < 1 or mine.max() <= cap + 1e-12
    both = o.score_weights(spark.createDataFrame(rows, "g string, i int, expected_return double, risk double"), "g", long_only=False, tie="i").filter("g = 'b'").orderBy("i").collect()
    assert math.isclose(sum(r.weight for r in both), 1) and both[-1].weight == 0


def test_late_rows_do_not_replace_newer_ones(spark, tmp_path):
    """Three batches, out of order: the table holds what one upsert by time of all rows holds."""
    rng, start = random.Random(7), datetime(2024, 1, 1)
    rows = [(k, k % 3, start + timedelta(hours=rng.randrange(90)), rng.random()) for k in range(40) for _ in range(5)]
    rng.shuffle(rows)
    rows.append((99, 0, None, 1.0))  # no time: never newer
    schema = "k int, part int, ts timestamp, v double"
    source, table = tmp_path / "in", tmp_path / "table"
    for i in range(3):
        spark.createDataFrame(rows[i * 70 : i * 70 + 70] if i < 2 else rows[140:], schema).coalesce(1).write.mode("append").parquet(str(source))
        stream = spark.readStream.schema(schema).parquet(str(source))
        jobs.start_upsert(stream, str(table), str(tmp_path / "cp"), ["k"], partition="part", late="10 days").awaitTermination()
    want = {}
    for k, _, ts, v in rows:
        if ts is not None and (k not in want or (ts, v) > want[k]):
            want[k] = ts, v
    got = {r.k: (r.ts, r.v) for r in spark.read.parquet(str(table)).collect()}
    assert {k: x[0] for k, x in got.items()} == {k: x[0] for k, x in want.items()}
    ties = {k for k in want if sum(r[0] == k and r[2] == want[k][0] for r in rows) > 1}
    assert all(got[k] == want[k] for k in want if k not in ties)


def test_weights_of_many_trades_in_one_pass(spark):
    """Gaps filled forward then backward, several quotes a day averaged, null prices, a null trade; trades without a moving price get what the solver gives for zeros."""
    rng = np.random.default_rng(5)
    rows = [(None if t == 7 else f"t{t}", c, date(2024, 1, 1) + timedelta(days=int(rng.integers(6))), None if rng.random() < 0.05 else 5.0 + c if t % 3 == 0 else float(rng.uniform(1, 9))) for t in range(40) for c in range(1 + t % 5) for _ in range(4)]
    quotes = spark.createDataFrame(rows, "trade_id string, contract int, date date, price double")
    made = o.trade_weights(quotes, shrink=0.3, aversion=2.0)
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert "FlatMapGroupsInPandas" not in plan and "MapInArrow" in plan  # failed by time: one trade at a time went through pandas
    got = {(r.trade_id, r.contract): r.weight for r in made.collect()}
    frame = pd.DataFrame(rows, columns=["trade_id", "contract", "date", "price"])
    for trade, pdf in frame.groupby("trade_id", dropna=False):
        wide = pdf.groupby(["date", "contract"])["price"].mean().unstack().sort_index().ffill().bfill()
        r, mu = wide.pct_change().iloc[1:].fillna(0.0).to_numpy(), (wide.iloc[-1] / wide.iloc[0] - 1).fillna(0.0).to_numpy()
        c = np.atleast_2d(np.cov(r.T)) if len(r) > 1 else np.zeros((len(mu), len(mu)))
        want = o.mean_variance_weights(mu, 0.7 * c + 0.3 * np.diag(np.diag(c)), aversion=2.0)
        key = None if pd.isna(trade) else trade
        assert [got.pop((key, c)) for c in wide.columns] == pytest.approx(want.tolist(), abs=1e-6)
    assert not got
