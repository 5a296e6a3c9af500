"""Indicators against plain loops, builders, specifications, the weight solver and global ranks."""

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from lodestone.operators import builders, compare, events, indicators, labels, options, sections, specs

RNG = np.random.default_rng(11)


def bars(n=140, start=100.0):
    close = start * np.exp(np.cumsum(RNG.normal(0, 0.02, n)))
    high, low = close * (1 + RNG.uniform(0, 0.02, n)), close * (1 - RNG.uniform(0, 0.02, n))
    return {"open": low + (high - low) * RNG.uniform(0, 1, n), "high": high, "low": low, "close": close, "volume": RNG.integers(100, 1000, n).astype(float)}


def test_recursive_means_against_loops():
    x = bars()
    c = x["close"]

    def loop(rate, y):
        out = [y[0]]
        for v in y[1:]:
            out.append(rate * v + (1 - rate) * out[-1])
        return np.array(out)

    got = indicators.overlap_recursive(x)
    np.testing.assert_allclose(got["ema_12"], loop(2 / 13, c))
    np.testing.assert_allclose(got["rma_20"], loop(1 / 20, c))
    e1 = loop(2 / 21, c)
    e2 = loop(2 / 21, e1)
    np.testing.assert_allclose(got["dema_20"], 2 * e1 - e2)
    np.testing.assert_allclose(got["tema_20"], 3 * e1 - 3 * e2 + loop(2 / 21, e2))
    kama = [c[0]]
    for i in range(1, len(c)):
        steps = sum(abs(c[k] - c[k - 1]) for k in range(max(1, i - 9), i + 1))
        kama.append(kama[-1] + (abs(c[i] - c[max(0, i - 10)]) / steps * (2 / 3 - 2 / 31) + 2 / 31) ** 2 * (c[i] - kama[-1]))
    np.testing.assert_allclose(got["kama_10"], kama)
    m = indicators.momentum_recursive(x)
    d = np.diff(c, prepend=c[:1])
    gain, loss = loop(1 / 14, np.maximum(d, 0)), loop(1 / 14, np.maximum(-d, 0))
    with np.errstate(all="ignore"):
        np.testing.assert_allclose(m["rsi_14"], np.where(loss == 0, np.nan, 100 - 100 / (1 + gain / loss)))
    np.testing.assert_allclose(m["macd_signal"], loop(2 / 10, loop(2 / 13, c) - loop(2 / 27, c)), atol=1e-12)
    np.testing.assert_allclose(m["macdfix"], loop(0.15, c) - loop(0.075, c), atol=1e-12)


def test_bounds_and_sides():
    x = bars(300)
    with np.errstate(all="ignore"):
        m, o = indicators.momentum_recursive(x), indicators.overlap_recursive(x)
        w, v = indicators.momentum(x), indicators.overlap(x)
    for y in (m["stochrsi_k_14"], m["stc"], m["rsi_14"], w["stoch_k_14"], w["uo"], w["mfi_14"]):
        assert np.nanmin(y) >= -1e-9 and np.nanmax(y) <= 100 + 1e-9
    above = o["supertrend_side"] > 0
    assert above.any() and (~above).any()
    assert (o["supertrend"][1:][above[1:]] <= x["close"][1:][above[1:]] + 1e-9).all() and (o["supertrend"][1:][~above[1:]] >= x["close"][1:][~above[1:]] - 1e-9).all()
    long = o["psar_side"][1:] > 0
    assert (o["psar"][1:][long] <= x["high"][1:][long]).all() and (o["psar"][1:][~long] >= x["low"][1:][~long]).all()
    assert ((o["kc_lower_20"] < o["kc_mid_20"]) & (o["kc_mid_20"] < o["kc_upper_20"]))[20:].all()
    linear = {k: np.arange(1.0, 61) for k in x}
    with np.errstate(all="ignore"):
        np.testing.assert_allclose(indicators.overlap(linear)["hma_20"][30:], linear["close"][30:] - 2 / 3, atol=1e-9)  # on a line a mean of n rows lags by (n - 1) / 3: 2 * 3 - 19 / 3 and 1 in all
    assert np.isnan(v["alma_20"][:19]).all() and not np.isnan(v["alma_20"][19:]).any()


def test_short_histories_nulls_and_extra_columns(spark):
    long = pd.DataFrame(bars(60)).assign(symbol="L", date=pd.bdate_range("2024-01-01", periods=60).date, note="x")
    short = pd.DataFrame(bars(12)).assign(symbol="S", date=pd.bdate_range("2024-01-01", periods=12).date, note=None)
    short.loc[3, "close"] = np.nan
    rows = indicators.indicators(spark.createDataFrame(pd.concat([long, short])), "math", "momentum", "special").toPandas()
    s = rows[rows.symbol == "S"]
    assert s[["ta__kst", "ta__stc", "ta__zscore_20", "ta__ichimoku_tenkan", "ta__uo", "ta__long_run"]].isna().all().all() and s["ta__bop"].notna().sum() >= 11
    assert rows[rows.symbol == "L"]["ta__ichimoku_tenkan"].notna().sum() == 52 and set(rows.note.dropna()) == {"x"}
    assert len(indicators.names()) == len(set(indicators.names())) > 130


def test_weights():
    mu, cov = np.array([0.1, 0.2, 0.05, 0.0]), np.diag([0.1, 0.2, 0.05, 0.1]) + 0.01
    free = options.closed_form_weights(mu, cov, aversion=2.0)
    assert free.sum() == pytest.approx(1)
    value = lambda w: mu @ w - w @ cov @ w
    for _ in range(50):
        step = RNG.normal(0, 0.1, 4)
        assert value(free) >= value(free + step - step.mean()) - 1e-12
    w = options.mean_variance_weights(mu, cov, aversion=2.0, steps=3000)
    assert w.min() >= 0 and w.sum() == pytest.approx(1)
    for _ in range(200):
        other = RNG.dirichlet(np.ones(4))
        assert value(w) >= value(other) - 1e-6
    one = options.mean_variance_weights(mu, np.array([0.1, 0.2, 0.05, 0.1]), eligible=np.array([True, False, True, True]), cap=0.6)
    assert one[1] == 0 and one.max() <= 0.6 + 1e-9 and one.sum() == pytest.approx(1)
    big = options.mean_variance_weights(np.array([1.0, 0.9, -1.0]), np.eye(3) * 0.1, long_only=False, gross=1.5)
    assert np.abs(big).sum() <= 1.5 + 1e-6 and big.sum() == pytest.approx(1)
    least = options.mean_variance_weights(mu, cov, least=0.2)
    assert all(x == 0 or x >= 0.2 - 1e-9 for x in least) and least.sum() == pytest.approx(1)
    flat = options.mean_variance_weights(mu, np.full(4, 0.1), shrink=1.0)  # equal returns and variances
    assert flat == pytest.approx(np.full(4, 0.25))


def test_builders(spark):
    day = dt.date(2024, 1, 2)
    raw = spark.createDataFrame([("A", None, day, "Sale", " ", "Jane", "Chief Executive Officer", "12"), ("A", day, day, "P - Purchase", None, "Bob", "10% owner", "x"), ("A", None, None, "Purchase", None, "No date", None, "1"), ("A", day, day, "Gift", None, "Z", None, "1")], "symbol string, transactionDate date, filingDate date, transactionType string, acquisitionOrDisposition string, reportingName string, typeOfOwner string, shares string")
    got = {r.actor: r for r in builders.build(raw, "insider").collect()}
    assert {k: (r.event_type, r.actor_role, r.strength, r.side, r.disclosure_lag_days) for k, r in got.items()} == {"Jane": ("insider_sell", "ceo", "12.0", -1, 0), "Bob": ("insider_buy", "large_holder", None, 1, 0)}
    paid = spark.createDataFrame([("A", dt.date(2024, m, 1), a) for m, a in ((1, 1.0), (2, 1.5), (3, 1.5), (4, 1.0))], "symbol string, date date, amount double")
    assert [(r.event_date.month, r.event_type) for r in builders.build(paid, "dividend").orderBy("event_date").collect()] == [(2, "dividend_increase"), (4, "dividend_cut")]
    assert [r.event_date.month for r in builders.build(paid, "dividend", start="2024-03-01").collect()] == [4]  # compared within the dates only
    split = spark.createDataFrame([("A", day, None, "3", "1"), ("B", day, 0.5, None, None), ("C", day, 1.0, None, None), ("D", day, None, "1", "0")], "symbol string, date date, ratio double, numerator string, denominator string")
    assert {r.symbol: r.event_type for r in builders.build(split, "split").collect()} == {"A": "forward_split", "B": "reverse_split"}
    for family in events.FAMILIES:
        assert builders.build(spark.createDataFrame([], "symbol string, date date"), family).count() == 0


def test_specifications(spark):
    assert sections.family_of("net_debt_to_ebitda", sections.RATIO_FAMILIES) == "ft_ratios_solvency" and sections.family_of("other", sections.RATIO_FAMILIES) is None
    assert sections.direction_of("ft_ratios_valuation", "dividend_yield") == "higher_is_better" and sections.direction_of("cash_mcap", "total_debt") == "lower_is_better"
    with pytest.raises(ValueError, match="doesn't make sense|don't make sense"):
        specs.LabelSpec(ks={"YE": (0,)})
    with pytest.raises(ValueError, match="no feature set for ratios"):
        only = {n: False for n in specs.FeatureSpec().chosen() if n != "ratios"}
        specs.FeatureSpec(**only).build({}, spark.createDataFrame([], "symbol string, date date"))
    with pytest.raises(ValueError, match="unknown section"):
        specs.section_kind("nothing")
    days = pd.bdate_range("2024-01-01", periods=30).date
    p = spark.createDataFrame([("A", d, 10.0 + i % 7, 10.5 + i % 7) for i, d in enumerate(days)], "symbol string, date date, low double, high double")
    spec = specs.LabelSpec(ks={"ME": (1, 2)}, sides=("long",))
    assert spec.least == 0.05 and spec.trades(p).count() == 2 * (1 + 2) and spec.labels(p).filter("weight < 1").count() == 0
    tasks = compare.oracle_side_tasks(["target_oracle_long__qe_1", "target_oracle_short__qe_1", "target_oracle_long__ye_1"])
    assert [t.task_id for t in tasks] == ["oracle_side_qe_1"]


def test_global_rank_with_ties_nulls_and_one_hot_value(spark):
    values = [None] * 5 + [1.0] * 400 + [float(x) for x in RNG.integers(-50, 50, 300)] + [0.5]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id int, v double").repartition(7)
    got = {r.id: r.rank_pct for r in labels.global_pct_rank(df, "v").collect()}
    want = pd.Series(values, dtype=float).rank(pct=True)
    assert all((got[i] is None) if np.isnan(want[i]) else got[i] == pytest.approx(want[i]) for i in range(len(values)))
    assert labels.global_pct_rank(df.limit(0), "v").count() == 0
    assert labels.global_pct_rank(df.filter("v is null"), "v").filter(F.col("rank_pct").isNotNull()).count() == 0
