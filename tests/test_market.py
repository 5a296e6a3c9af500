"""Small hand-made frames with exact expected values."""

import datetime as dt
import os

import numpy as np
import pandas as pd
import pytest

import __spark_entry__ as entry
from lodestone.operators import asof, evaluate, events, labels, options, plugins, technical, upsert
from lodestone.sources import normalize
from lodestone.streaming import jobs

D = lambda s: dt.date.fromisoformat(s)


def test_asof_backward(spark):
    sparse = spark.createDataFrame([(D("2024-01-01"), 100.0), (D("2024-04-01"), 120.0)], "d date, revenue double")
    grid = spark.createDataFrame([(D(x),) for x in ("2024-01-15", "2024-02-01", "2024-05-01", "2023-12-31")], "date date")
    got = {r.date: r.revenue for r in asof.asof_join(grid, sparse, left_on="date", right_on="d", by=()).collect()}
    assert got == {D("2024-01-15"): 100.0, D("2024-02-01"): 100.0, D("2024-05-01"): 120.0, D("2023-12-31"): None}


def test_asof_keeps_nulls_of_the_matched_row_and_breaks_ties_backward(spark):
    right = spark.createDataFrame([("A", D("2024-01-01"), 1.0, 5.0), ("A", D("2024-01-05"), None, 6.0)], "k string, d date, x double, y double")
    left = spark.createDataFrame([("A", D("2024-01-06")), ("A", D("2024-01-03")), ("B", D("2024-01-03")), (None, D("2024-01-03"))], "k string, date date")
    rows = {(r.k, r.date): (r.x, r.y) for r in asof.asof_join(left, right, left_on="date", right_on="d", by=("k",), direction="nearest").collect()}
    assert rows == {("A", D("2024-01-06")): (None, 6.0), ("A", D("2024-01-03")): (1.0, 5.0), ("B", D("2024-01-03")): (None, None), (None, D("2024-01-03")): (None, None)}


def test_upsert_appends_and_overwrites(spark):
    old = spark.createDataFrame([(D("2024-01-01"), 100.0)], "date date, close double")
    for day, n, close in (("2024-01-02", 2, 101.0), ("2024-01-01", 1, 99.0)):
        got = upsert.upsert(old, spark.createDataFrame([(D(day), close)], "date date, close double"), ["date"]).collect()
        assert len(got) == n and {r.date: r.close for r in got}[D(day)] == close


def test_forward_returns_and_rank(spark):
    p = spark.createDataFrame([("AAPL", D(f"2024-01-0{i}"), c) for i, c in ((1, 100.0), (2, 110.0), (3, 121.0))], "symbol string, date date, close double")
    got = {(r.date.day, r.horizon): r.target_value for r in labels.forward_returns(p, (1, 2)).collect()}
    assert got[1, 1] == pytest.approx(0.10) and got[1, 2] == pytest.approx(0.21) and got[3, 1] is None
    long = spark.createDataFrame([(s, D("2024-01-01"), 5, "t", v) for s, v in (("AAA", 0.01), ("BBB", 0.10), ("CCC", -0.03), ("DDD", None))], "symbol string, date date, horizon int, target_name string, target_value double")
    rank = {r.symbol: (r["rank"], r.rank_pct) for r in labels.cross_sectional_rank(long).collect()}
    assert rank["BBB"] == (1.0, 1.0) and rank["CCC"][0] == 3.0 and rank["DDD"] == (None, None)


PATH = [(10, 11), (8, 9), (12, 13), (7, 8), (15, 16)]


def test_best_trades_on_a_path():
    low, high = (np.array(x, float) for x in zip(*PATH, strict=True))
    assert labels.best_trades(low, low + 1, 2, 0.05, False) == [[(3, 4)], [(1, 2), (3, 4)]]
    assert labels.best_trades(low, high, 1, 0.05, False) == [[(3, 4)]]
    short = [(10, 11), (8, 9), (12, 13), (6, 7)]
    low, high = (np.array(x, float) for x in zip(*short, strict=True))
    assert labels.best_trades(high, low, 1, 0.10, True) == [[(2, 3)]]
    assert labels.best_trades(np.array([5.0]), np.array([5.0]), 3, 0.0, False) == [[], [], []]
    assert labels.best_trades(np.array([]), np.array([]), 1, 0.0, False) == [[]]


def test_best_trades_equal_exhaustive_search():
    rng = np.random.default_rng(4)

    def best(a, b, k, start, sign):
        top = 0.0
        if k:
            for i in range(start, len(a)):
                for j in range(i + 1, len(a)):
                    if sign * (b[j] - a[i]) >= 0.05 * abs(a[i]):
                        top = max(top, sign * (b[j] - a[i]) + best(a, b, k - 1, j + 1, sign))
        return top

    for trial in range(200):
        a = rng.uniform(5, 15, 8) if trial % 2 else rng.integers(5, 12, 8).astype(float)
        sign = 1 if trial % 3 else -1
        b = a + 0.5 * sign
        for k, got in enumerate(labels.best_trades(a, b, 3, 0.05, sign < 0), 1):
            assert all(i < j for i, j in got) and all(x[1] < y[0] for x, y in zip(got, got[1:], strict=False)) and len(got) <= k
            assert all(sign * (b[j] - a[i]) >= 0.05 * abs(a[i]) for i, j in got)
            assert sum(sign * (b[j] - a[i]) for i, j in got) == pytest.approx(best(a, b, k, 0, sign), abs=1e-9)


def test_technical_features_match_the_formulas(spark):
    days = pd.bdate_range("2024-01-01", periods=260)
    c = np.linspace(100, 130, 260)
    pdf = pd.DataFrame({"symbol": "A", "date": days.date, "open": c, "high": c + 1, "low": c - 1, "close": c + 0.25, "volume": 1000.0 + np.arange(260)})
    got = technical.all_features(spark.createDataFrame(pdf)).toPandas().sort_values("date").reset_index(drop=True)
    close = pdf["close"]
    want = {
        "px__ret_20d": close.pct_change(20), "px__sma_50": close.rolling(50).mean(), "px__vol_20": close.pct_change().rolling(20).std(),
        "px__macd": close.ewm(span=12, adjust=False).mean() - close.ewm(span=26, adjust=False).mean(), "px__z_close_20": (close - close.rolling(20).mean()) / (close.rolling(20).std() + 2e-12),
    }
    for name, series in want.items():
        np.testing.assert_allclose(got[name].to_numpy(float), series.to_numpy(), rtol=1e-8, atol=1e-10, err_msg=name)
    assert sum(x.startswith("px__") for x in got.columns) > 110


def test_option_chain_and_greeks(spark):
    raw = spark.createDataFrame([("AAPL", D("2025-01-24"), 230.0, "PUT", 0.66, 0.81), ("AAPL", D("2025-01-24"), 235.5, "PUT", 0.0, 0.85)], "underlying string, expiration date, strike double, right string, bid double, ask double")
    assert [r.contract_symbol for r in normalize.normalize_chain(raw).collect()] == ["AAPL_put_20250124_230"]
    q = spark.createDataFrame([("call", (2.20 + 2.3743012561) / 2, 100.0, 100.0, 30)], "option_type string, mid double, spot double, strike double, dte int")
    r = options.with_greeks(q).first()
    assert (r.iv, r.delta, r.gamma, r.vega) == pytest.approx((0.20, 0.5114, 0.0695, 11.4326), abs=1e-3) and r.iv_source == "implied"


def test_option_labels_and_weights(spark):
    c = spark.createDataFrame([("C100", 1.0, 1.5), ("C110", 2.0, 2.2), ("P90", 4.0, 3.0)], "option_symbol string, entry_price double, exit_price double").selectExpr("'X' as g", "*")
    c = options.returns(c)
    assert options.best_return(c, "g").first().option_symbol == "C100"
    s = spark.createDataFrame([("low", 0.04, 0.02), ("best", 0.12, 0.03), ("risky", 0.20, 0.20)], "option_symbol string, expected_return double, risk double").selectExpr("'X' as g", "*")
    rows = {r.option_symbol: r for r in options.score_weights(s, "g").collect()}
    assert rows["best"].score == pytest.approx(0.09) and rows["best"].selected and sum(r.weight for r in rows.values()) == pytest.approx(1)
    capped = [r.weight for r in options.score_weights(s.unionAll(s.withColumnRenamed("g", "g")), "g", cap=0.3).collect()]
    assert max(capped) <= 0.3 + 1e-9
    w = options.mean_variance_weights(np.array([0.1, 0.2, 0.0]), np.diag([0.1, 0.1, 0.1]), cap=0.6)
    assert w.sum() == pytest.approx(1) and w.max() <= 0.6 + 1e-6 and w[1] == w.max()


def test_events(spark):
    rows = spark.createDataFrame([("P-Purchase",), ("Sale of stock",), ("gift",), ("Exchange A",)], "t string")
    assert [r[0] for r in rows.select(events.trade_type(rows.t, "insider")).collect()] == ["insider_buy", "insider_sell", None, "insider_buy"]
    e = spark.createDataFrame([("A", "2024-01-03 10:00:00", "2024-01-05", "insider", "insider_buy", "x", "s", 1.0)], "symbol string, event_date string, reported_date string, event_family string, event_type string, actor string, source string, strength double")
    r = events.normalize_events(e).first()
    assert (r.event_date, r.disclosure_lag_days, r.mirror_type, r.side) == (D("2024-01-03"), 2, "insider_sell", 1)
    with pytest.raises(Exception, match="unknown event type"):
        events.normalize_events(e.selectExpr("* except (event_type)", "'odd' as event_type")).collect()


def test_ic_is_one_for_a_perfect_score(spark):
    rows = [(f"S{i}", D("2024-01-01"), "f", float(i)) for i in range(6)]
    scores = spark.createDataFrame(rows, "symbol string, date date, feature string, score double")
    targets = scores.selectExpr("symbol", "date", "5 as horizon", "score * 2 as target_value")
    assert evaluate.daily_ic(scores, targets).first().ic == pytest.approx(1)


def test_plug_in(spark):
    @plugins.register_feature_builder("twice", "double_close double")
    def twice(symbol, prices):
        return pd.DataFrame({"double_close": prices["close"] * 2})

    p = spark.createDataFrame([("A", D("2024-01-02"), 2.0), ("A", D("2024-01-01"), 1.0)], "symbol string, date date, close double")
    assert {r.date.day: r.double_close for r in plugins.build_features(p, "twice").collect()} == {1: 2.0, 2: 4.0}


def test_stream_upsert_and_counts_equal_batch(spark, tmp_path):
    source, schema = tmp_path / "in", "ts timestamp, user_id long, event_type string, value double, day string"
    rows = [(dt.datetime(2024, 1, 1 + i % 3, i % 24), i % 7, "ab"[i % 2], float(i), f"2024-01-0{1 + i % 3}") for i in range(60)]
    for k in range(2):
        spark.createDataFrame(rows[30 * k : 30 * (k + 1)], schema).coalesce(1).write.mode("append").parquet(str(source))
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(source))
    spark.sparkContext.setCheckpointDir(str(tmp_path / "cut"))
    jobs.start_upsert(stream, str(tmp_path / "out"), str(tmp_path / "state"), ["user_id", "event_type"], partition="day").awaitTermination()
    want = {}
    for ts, user, kind, value, day in sorted(rows):
        want[user, kind, day] = value
    got = {(r.user_id, r.event_type, str(r.day)): r.value for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert got == want
    counts = jobs.event_counts(stream).writeStream.outputMode("complete").format("memory").queryName("counted").trigger(availableNow=True).start()
    counts.awaitTermination()
    batch = jobs.event_counts(spark.read.parquet(str(source)))
    assert sorted(map(tuple, spark.table("counted").collect())) == sorted(map(tuple, batch.collect()))


@pytest.mark.skipif(not os.path.exists("/root/testdata/sf0.001"), reason="needs the generated tables")
def test_entry_and_registry(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
