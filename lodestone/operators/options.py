"""Option features and labels: moneyness, liquidity, implied volatility, greeks, returns, ranks and weights."""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestone.functions.batches import changes, whole_groups
from lodestone.functions.columns import ratio

GREEKS = ("delta", "gamma", "theta", "vega", "rho")


def static_features(chain: DataFrame, target_days: int = 45) -> DataFrame:
    """Days to expiry, their gap from the target, moneyness (strike over spot - 1) and its size."""
    rows = chain.withColumn("dte", F.datediff("expiration", "snapshot_date"))
    return rows.withColumns({"dte_gap": F.abs(F.col("dte") - target_days), "moneyness": ratio(F.col("strike"), F.col("spot")) - 1}).withColumn("abs_moneyness", F.abs("moneyness"))


def liquidity(chain: DataFrame) -> DataFrame:
    """Spread, spread over mid, and volume plus a hundredth of open interest."""
    mid = (F.col("bid") + F.col("ask")) / 2
    rows = chain.withColumns({"mid": mid, "spread": F.col("ask") - F.col("bid")})
    return rows.withColumns({"spread_pct": ratio(F.col("spread"), F.col("mid")), "liquidity_score": F.coalesce("volume", F.lit(0.0)) + F.coalesce("open_interest", F.lit(0.0)) / 100})


_ERF = np.frompyfunc(math.erf, 1, 1)


def normal_cdf(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + _ERF(np.asarray(x, float) / math.sqrt(2)).astype(float))


def black_scholes(call: np.ndarray, spot: np.ndarray, strike: np.ndarray, years: np.ndarray, rate: float, vol: np.ndarray) -> np.ndarray:
    root = vol * np.sqrt(years)
    d1 = (np.log(spot / strike) + (rate + vol**2 / 2) * years) / root
    d2, discount = d1 - root, np.exp(-rate * years)
    return np.where(call, spot * normal_cdf(d1) - strike * discount * normal_cdf(d2), strike * discount * normal_cdf(-d2) - spot * normal_cdf(-d1))


def implied_vol(call: np.ndarray, price: np.ndarray, spot: np.ndarray, strike: np.ndarray, years: np.ndarray, rate: float = 0.0) -> np.ndarray:
    """The volatility in [1e-4, 5] that gives the price, by bisection of whole columns; NaN outside the no-arbitrage bounds or without a bracket."""
    discount = np.exp(-rate * years)
    low_bound = np.where(call, np.maximum(spot - strike * discount, 0), np.maximum(strike * discount - spot, 0))
    high_bound = np.where(call, spot, strike * discount)
    ok = (years > 0) & (spot > 0) & (strike > 0) & (price > low_bound) & (price < high_bound)
    out = np.full(len(price), np.nan)
    if not ok.any():
        return out
    c, p, s, k, t = (x[ok] for x in (call, price, spot, strike, years))
    lo, hi = np.full(len(p), 1e-4), np.full(len(p), 5.0)
    bracket = (black_scholes(c, s, k, t, rate, lo) <= p) & (black_scholes(c, s, k, t, rate, hi) >= p)
    for _ in range(60):
        mid = (lo + hi) / 2
        under = black_scholes(c, s, k, t, rate, mid) < p
        lo, hi = np.where(under, mid, lo), np.where(under, hi, mid)
    out[ok] = np.where(bracket, (lo + hi) / 2, np.nan)
    return out


# Hart's rational approximation of the normal distribution's lower tail (as given by West, 2005), and where its continued fraction takes over.
TAIL_OVER = (0.0352624965998911, 0.700383064443688, 6.37396220353165, 33.912866078383, 112.079291497871, 221.213596169931, 220.206867912376)
TAIL_UNDER = (0.0883883476483184, 1.75566716318264, 16.064177579207, 86.7807322029461, 296.564248779674, 637.333633378831, 793.826512519948, 440.413735824752)
FAR = 7.07106781186547


def normal_distribution(x: Column) -> Column:
    """The normal distribution function, right to 1e-14 or so, as an expression that stays in generated code."""
    size = F.abs(x)
    polynomial = lambda coefficients: functools.reduce(lambda p, c: p * size + c, coefficients[1:], F.lit(coefficients[0]))
    fraction = size + 1 / (size + 2 / (size + 3 / (size + 4 / (size + 0.65))))
    tail = F.exp(-size * size / 2) * F.when(size < FAR, polynomial(TAIL_OVER) / polynomial(TAIL_UNDER)).otherwise(1 / fraction / 2.506628274631)
    return F.when(size > 37, F.when(x > 0, 1.0).otherwise(0.0)).when(x > 0, 1 - tail).otherwise(tail)


def _terms(spot: Column, strike: Column, years: Column, rate: float, vol: Column) -> tuple[Column, Column, Column]:
    """d1, d2 and the discount; null where a logarithm or root has no value."""
    ok = (spot > 0) & (strike > 0) & (years > 0) & (vol > 0)
    root = vol * F.sqrt(years)
    d1 = F.when(ok, (F.ln(spot / strike) + (rate + vol * vol / 2) * years) / root)
    return d1, d1 - root, F.exp(-rate * years)


def _distributions(rows: DataFrame, spot: Column, strike: Column, years: Column, rate: float, vol: Column) -> DataFrame:
    """Adds __d1, __n1 and __n2 (the distribution at d1 and d2) and __disc, one after the other, so that no expression holds another many times."""
    d1, d2, discount = _terms(spot, strike, years, rate, vol)
    return rows.withColumns({"__d1": d1, "__d2": d2, "__disc": discount}).withColumns({"__n1": normal_distribution(F.col("__d1")), "__n2": normal_distribution(F.col("__d2"))}).drop("__d2")


def add_price(rows: DataFrame, call: Column, spot: Column, strike: Column, years: Column, rate: float, vol: Column, *, name: str = "price") -> DataFrame:
    """Adds the Black-Scholes price; null where it has no value."""
    rows = _distributions(rows, spot, strike, years, rate, vol)
    n1, n2, kept = F.col("__n1"), F.col("__n2"), strike * F.col("__disc")
    return rows.withColumn(name, F.when(call, spot * n1 - kept * n2).otherwise(kept * (1 - n2) - spot * (1 - n1))).drop("__d1", "__n1", "__n2", "__disc")


def add_greeks(rows: DataFrame, call: Column, spot: Column, strike: Column, years: Column, rate: float, vol: Column) -> DataFrame:
    """Adds delta, gamma, theta a day, vega and rho (for a change of 1 in volatility and rate), where they are null or not there; null where they have no value."""
    rows = _distributions(rows, spot, strike, years, rate, vol).withColumn("__phi", F.exp(-F.col("__d1") * F.col("__d1") / 2) / math.sqrt(2 * math.pi))
    n1, n2, phi, disc = F.col("__n1"), F.col("__n2"), F.col("__phi"), F.col("__disc")
    decay, carry = -spot * phi * vol / (2 * F.sqrt(years)), rate * strike * disc
    found = {
        "delta": F.when(call, n1).otherwise(n1 - 1), "gamma": phi / (spot * vol * F.sqrt(years)), "theta": F.when(call, decay - carry * n2).otherwise(decay + carry * (1 - n2)) / 365,
        "vega": spot * phi * F.sqrt(years), "rho": F.when(call, strike * years * disc * n2).otherwise(-strike * years * disc * (1 - n2)),
    }
    return rows.withColumns({k: F.coalesce(k, v) if k in rows.columns else v for k, v in found.items()}).drop("__d1", "__disc", "__n1", "__n2", "__phi")


def with_greeks(chain: DataFrame, rate: float = 0.0) -> DataFrame:
    """Fills null iv and greeks from the mid price (columns option_type, mid, spot, strike, dte); iv_source and greeks_source tell which were.

    Greeks are expressions; only the search for the volatility is Python, over batches of the five columns that it needs.
    """
    rows = chain
    for c in ("iv", *GREEKS):
        if c not in chain.columns:
            rows = rows.withColumn(c, F.lit(None).cast("double"))

    @F.pandas_udf("double")
    def search(call: pd.Series, price: pd.Series, spot: pd.Series, strike: pd.Series, years: pd.Series) -> pd.Series:
        found = implied_vol(call.to_numpy(bool), *(x.to_numpy(float) for x in (price, spot, strike, years)), rate)
        return pd.Series(found).astype(object).where(np.isfinite(found), None).astype("Float64")

    call, years = F.lower("option_type") == "call", F.col("dte") / 365.0
    number = lambda c: F.col(c).cast("double")
    implied = search(F.coalesce(call, F.lit(False)), *(F.when(F.col("iv").isNull(), number(c)) for c in ("mid", "spot", "strike")), years)
    rows = rows.withColumns({"__given": F.col("iv").isNotNull(), "__iv": F.nanvl(implied, F.lit(None).cast("double"))})
    given = F.lit(True)
    for c in GREEKS:
        given = given & F.col(c).isNotNull()
    rows = rows.withColumns({"iv": F.coalesce("iv", "__iv"), "greeks_source": F.when(given, "vendor")}).withColumn("iv_source", F.when(F.col("__given"), "vendor").when(F.col("iv").isNotNull(), "implied"))
    rows = add_greeks(rows, F.coalesce(call, F.lit(False)), number("spot"), number("strike"), years, rate, F.col("iv"))
    rows = rows.withColumn("greeks_source", F.coalesce("greeks_source", F.when(F.col("delta").isNotNull(), "implied")))
    return rows.select(*chain.columns, *[c for c in ("iv", *GREEKS) if c not in chain.columns], "iv_source", "greeks_source")


def greek_ratios(chain: DataFrame) -> DataFrame:
    return chain.withColumns({"abs_delta": F.abs("delta"), "abs_theta": F.abs("theta"), "theta_to_mid": ratio(F.col("theta"), F.col("mid")), "vega_to_mid": ratio(F.col("vega"), F.col("mid"))})


def surface(chain: DataFrame, iv: str = "iv") -> DataFrame:
    """iv as z-score within (date, underlying, type, expiry), and scaled by the root of the year's share."""
    w = Window.partitionBy("snapshot_date", "underlying", "option_type", "expiration")
    return chain.withColumns({"iv_z": ratio(F.col(iv) - F.avg(iv).over(w), F.stddev_samp(iv).over(w)), "iv_term": F.col(iv) * F.sqrt(F.greatest(F.col("dte"), F.lit(0)) / 365)})


def returns(candidates: DataFrame) -> DataFrame:
    return candidates.withColumn("realised_return", ratio(F.col("exit_price") - F.col("entry_price"), F.col("entry_price")))


def best_return(candidates: DataFrame, *keys: str, tie: str = "option_symbol") -> DataFrame:
    """The candidate of largest realised return of each group; on ties the first by ``tie``."""
    w = Window.partitionBy(*keys).orderBy(F.desc_nulls_last("realised_return"), tie)
    return candidates.withColumn("__n", F.row_number().over(w)).filter("__n = 1 and realised_return is not null").drop("__n")


def return_rank(candidates: DataFrame, *keys: str) -> DataFrame:
    """Average rank (1 for the best) and pct within each group."""
    from lodestone.operators.labels import average_rank

    down, n = average_rank("realised_return", *keys)
    up, _ = average_rank("realised_return", *keys, descending=False)
    return candidates.withColumns({"rank": down, "rank_pct": up / n})


def score_weights(candidates: DataFrame, *keys: str, aversion: float = 1.0, cap: float | None = None, long_only: bool = True, tie: str = "option_symbol") -> DataFrame:
    """Score (expected return less aversion times risk), its rank (equal scores by ``tie``), selected (rank 1), and weights of a group that sum to 1, none above ``cap``.

    Weights are in proportion to positive scores, null scores counting 0; if none is positive, the best has all. Not ``long_only``: in proportion to the gap from the worst, or equal.
    What lies above the cap goes to the others in their proportion, exactly: in order of size the first rows are at the cap, the rest share what they leave. If even all
    rows of a positive share at the cap leave something, the others get it in equal parts; if the cap times the group's rows is below 1, all weights are equal.
    """
    if cap is not None and cap <= 0:
        raise ValueError("cap must be positive")
    w = Window.partitionBy(*keys)
    rows = candidates.withColumn("score", F.col("expected_return") - aversion * F.col("risk"))
    number = F.coalesce(F.nanvl("score", F.lit(None).cast("double")), F.lit(0.0))
    rows = rows.withColumns({"score_rank": F.row_number().over(w.orderBy(F.desc_nulls_last("score"), tie)), "__p": F.when(F.abs(number) == float("inf"), 0.0).otherwise(number)})
    if long_only:
        best = F.row_number().over(w.orderBy(F.desc("__p"), tie)) == 1
        rows = rows.withColumn("__p", F.when(F.max("__p").over(w) > 0, F.greatest("__p", F.lit(0.0))).otherwise(best.cast("double")))
    else:
        rows = rows.withColumn("__p", F.col("__p") - F.min("__p").over(w)).withColumn("__p", F.when(F.sum("__p").over(w) > 0, F.col("__p")).otherwise(1.0))
    rows = rows.withColumn("__p", F.col("__p") / F.sum("__p").over(w))
    if cap is None or cap >= 1:
        return rows.withColumnRenamed("__p", "weight").withColumn("selected", F.col("score_rank") == 1)
    down = w.orderBy(F.desc("__p"), tie)
    before = F.coalesce(F.sum("__p").over(down.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    rows = rows.withColumns({"__i": F.row_number().over(down) - 1, "__b": before, "__n": F.count("*").over(w), "__some": F.sum((F.col("__p") > 0).cast("long")).over(w)})
    # a row is at the cap if its share of what the larger ones leave is more; these rows come first
    rows = rows.withColumn("__at", (F.col("__p") > 0) & (F.col("__p") * (1 - F.col("__i") * cap) >= cap * (1 - F.col("__b"))))
    capped = F.sum(F.col("__at").cast("long")).over(w)
    taken = F.sum(F.when(F.col("__at"), F.col("__p")).otherwise(0.0)).over(w)
    rows = rows.withColumns({"__c": capped, "__t": taken})
    share = (1 - F.col("__c") * cap) * F.col("__p") / (1 - F.col("__t"))
    weight = (
        F.when(cap * F.col("__n") < 1, 1.0 / F.col("__n")).when((F.col("__p") > 0) & (cap * F.col("__some") <= 1), F.lit(cap)).when(cap * F.col("__some") < 1, (1 - cap * F.col("__some")) / (F.col("__n") - F.col("__some")))
        .when(F.col("__p") <= 0, 0.0).when(F.col("__at"), F.lit(cap)).otherwise(F.least(share, F.lit(cap)))
    )
    return rows.withColumn("weight", weight).drop("__p", "__i", "__b", "__n", "__some", "__at", "__c", "__t").withColumn("selected", F.col("score_rank") == 1)


def hybrid_mu(candidates: DataFrame, *keys: str, weight: float = 0.5) -> DataFrame:
    """weight * rank_pct + (1 - weight) * return scaled to 0..1 within the group."""
    w = Window.partitionBy(*keys)
    lo, hi = F.min("realised_return").over(w), F.max("realised_return").over(w)
    return candidates.withColumn("hybrid_mu", weight * F.col("rank_pct") + (1 - weight) * F.coalesce(ratio(F.col("realised_return") - lo, hi - lo), F.lit(0.0)))


def _projected(v: np.ndarray, cap: float) -> np.ndarray:
    """The nearest weights to ``v`` from 0 to ``cap`` that sum to 1."""
    # the shift at which the clipped weights sum to 1: their sum is piecewise linear between the sorted corners
    corners = np.sort(np.concatenate([v, v - cap]))
    sums = np.clip(v[:, None] - corners, 0, cap).sum(axis=0)
    i = min(max(int(np.searchsorted(-sums, -1.0)), 1), len(corners) - 1)
    gap = sums[i - 1] - sums[i]
    shift = corners[i] if gap <= 0 else corners[i - 1] + (sums[i - 1] - 1) / gap * (corners[i] - corners[i - 1])
    x = np.clip(v - shift, 0, cap)
    return x / x.sum()


def closed_form_weights(mu: np.ndarray, cov: np.ndarray, *, aversion: float = 1.0) -> np.ndarray:
    """Weights of either sign that sum to 1 and maximise mu'w - aversion w'Cw / 2 (by pseudo-inverse)."""
    inverse = np.linalg.pinv(cov)
    ones = np.ones(len(mu))
    a = ones @ inverse @ ones
    if abs(a) < 1e-12:
        return ones / len(mu)
    level = (ones @ inverse @ mu - aversion) / a
    return inverse @ (mu - level) / aversion


def active_set_weights(mu: np.ndarray, cov: np.ndarray, *, aversion: float = 1.0, cap: float = 1.0) -> np.ndarray:
    """The weights from 0 to ``cap`` that sum to 1 and maximise mu'w - aversion w'Cw / 2, to rounding.

    Weights are free, or held at 0 or the cap. With those held, the free ones solve a linear system (optimal but for the bounds); a step towards its solution ends at the first
    bound it meets, which is then held. At the solution a held weight whose gradient wants it back is freed, the most wanted first. A small ridge keeps the system solvable
    where the covariance is not of full rank; it is a 10^-12 part of the mean variance.
    """
    n = len(mu)
    cap = max(cap, 1 / n)
    c = aversion * np.asarray(cov, float)
    c = c + np.eye(n) * max(1e-12 * np.trace(c) / n, 1e-15)
    order = np.argsort(-mu, kind="stable")
    w, left = np.zeros(n), 1.0
    for i in order:  # a start on the bounds: the best returns at the cap
        w[i] = min(cap, left)
        left -= w[i]
    free = (w > 0) & (w < cap)
    near = 1e-12 * max(1.0, np.abs(mu).max())
    for _ in range(50 * n + 50):
        f, held = np.flatnonzero(free), ~free
        if len(f) > 1:  # one alone cannot move
            system = np.zeros((len(f) + 1, len(f) + 1))
            system[:-1, :-1], system[:-1, -1], system[-1, :-1] = c[np.ix_(f, f)], 1, 1
            solved = np.linalg.lstsq(system, np.append(mu[f] - c[np.ix_(f, held)] @ w[held], 1 - w[held].sum()), rcond=None)[0]
            step = solved[:-1] - w[f]
            moving = np.abs(step) > 1e-14
            reach = np.full(len(f), np.inf)
            reach[moving] = np.where(step < 0, -w[f], cap - w[f])[moving] / step[moving]
            first = int(np.argmin(reach))
            if reach[first] < 1:
                w[f] = np.clip(w[f] + max(reach[first], 0.0) * step, 0, cap)
                w[f[first]] = 0.0 if step[first] < 0 else cap
                free[f[first]] = False
                continue
            w[f] = solved[:-1]
        gradient = mu - c @ w
        up, down = np.where(w < cap, gradient, -np.inf), np.where(w > 0, gradient, np.inf)
        if len(f):
            level = gradient[f].mean()
            wants = np.where(free, 0.0, np.maximum(np.where(w < cap, gradient - level, 0.0), np.where(w > 0, level - gradient, 0.0)))
            if wants.max() <= near:
                break
            free[wants.argmax()] = True
        elif up.max() - down.min() <= near:
            break
        else:
            free[[up.argmax(), down.argmin()]] = True
    w = np.clip(w, 0, cap)
    return w / w.sum()


def diagonal_weights(mu: np.ndarray, variances: np.ndarray, *, aversion: float = 1.0, cap: float = 1.0) -> np.ndarray:
    """The same for variances alone, in closed form: each weight is its return over a common level, by aversion times variance, cut to [0, cap].

    The sum of the cut weights is piecewise linear in the level: the piece that sums to 1 is found by its corners. A variance of 0 counts as a 10^-12 part of the largest.
    """
    n = len(mu)
    cap = max(cap, 1 / n)
    v = aversion * np.maximum(variances, max(1e-12 * np.max(variances), 1e-15))
    corners = np.sort(np.concatenate([mu, mu - cap * v]))  # ascending levels: the sum falls
    sums = np.clip((mu[:, None] - corners) / v[:, None], 0, cap).sum(axis=0)
    i = min(max(int(np.searchsorted(-sums, -1.0)), 1), len(corners) - 1)
    gap = sums[i - 1] - sums[i]
    level = corners[i] if gap <= 0 else corners[i - 1] + (sums[i - 1] - 1) / gap * (corners[i] - corners[i - 1])
    w = np.clip((mu - level) / v, 0, cap)
    return w / w.sum()


def mean_variance_weights(mu: np.ndarray, cov: np.ndarray, *, aversion: float = 1.0, cap: float = 1.0, steps: int = 0, long_only: bool = True, gross: float | None = None, least: float = 0.0, eligible: np.ndarray | None = None, shrink: float = 0.0) -> np.ndarray:
    """Weights that sum to 1 and maximise mu'w - aversion w'Cw / 2.

    ``cov``: a covariance matrix, or variances alone. ``eligible``: the others get 0. ``shrink``: the share by which returns move to the mean of the eligible ones.
    Long-only: from 0 to ``cap`` each, exactly (`active_set_weights`, `diagonal_weights`), or by so many ``steps`` of projected gradient, if asked for; weights under ``least`` become 0 and the
    others grow in proportion, up to ``cap``. Else the closed form, cut to ``cap`` in size; with sizes that sum to more than ``gross``, it is mixed with equal weights until they don't.
    """
    on = np.ones(len(mu), bool) if eligible is None else np.asarray(eligible, bool)
    out = np.zeros(len(mu))
    if not on.any():
        return out
    cov = np.asarray(cov, float)
    m, c = np.asarray(mu, float)[on], np.maximum(cov, 0)[on] if cov.ndim == 1 else cov[np.ix_(on, on)]
    m = (1 - shrink) * m + shrink * m.mean()
    n = len(m)
    cap = max(cap, 1 / n)
    if long_only:
        if steps:
            full = np.diag(c) if c.ndim == 1 else c
            w = np.full(n, 1 / n)
            rate = 1 / (aversion * max(np.linalg.eigvalsh(full)[-1], 1e-9) + 1e-9)
            for _ in range(steps):
                w = _projected(w + rate * (m - aversion * full @ w), cap)
        else:
            w = (diagonal_weights if c.ndim == 1 else active_set_weights)(m, c, aversion=aversion, cap=cap)
        if least > 0 and (w >= least).any():
            big = w >= least
            w = np.where(big, w, 0.0)
            w[big] = _projected(w[big] / w[big].sum(), max(cap, 1 / big.sum()))
    else:
        w = np.clip(closed_form_weights(m, np.diag(c) if c.ndim == 1 else c, aversion=aversion), -cap, cap)
        w = w / w.sum() if abs(w.sum()) > 1e-9 else np.full(n, 1 / n)
        size = np.abs(w).sum()
        if gross is not None and size > gross >= 1:
            equal = np.full(n, 1 / n)
            lo, hi = 0.0, 1.0
            for _ in range(50):
                mid = (lo + hi) / 2
                lo, hi = (mid, hi) if np.abs(mid * w + (1 - mid) * equal).sum() <= gross else (lo, mid)
            w = lo * w + (1 - lo) * equal
    out[on] = w
    return out


# Named settings of the solver.
PROFILES = {"conservative": {"aversion": 5.0, "cap": 0.25}, "balanced": {"aversion": 1.0, "cap": 0.5}, "aggressive": {"aversion": 0.2, "cap": 1.0}}


def trade_weights(quotes: DataFrame, *, shrink: float = 0.1, profile: str | None = None, **solver: float) -> DataFrame:
    """(trade_id, contract, weight) by `mean_variance_weights`, with the settings of a profile or one's own, from quotes (trade_id, contract, date, price) in each trade's window.

    Per trade: mean price of a day, gaps filled forward then backward, daily returns, covariance shrunk to its diagonal
    with eigenvalues floored at 0, expected return of the whole window. A trade's contracts and days are a bounded group; many go through Python at once,
    and trades of which no contract's price moves are solved once for each number of contracts.
    """

    settings = PROFILES[profile] | solver if profile else solver

    def weights(p: np.ndarray) -> np.ndarray:
        """Of mean prices, a row a day and a column a contract, NaN where there is none."""
        with np.errstate(all="ignore"):
            r, mu = p[1:] / p[:-1] - 1, p[-1] / p[0] - 1
        r, mu = np.where(np.isfinite(r), r, 0.0), np.where(np.isfinite(mu), mu, 0.0)
        c = np.atleast_2d(np.cov(r.T)) if len(r) > 1 else np.zeros((len(mu), len(mu)))
        c = (1 - shrink) * c + shrink * np.diag(np.diag(c))
        values, vectors = np.linalg.eigh(c)
        c = (vectors * np.maximum(values, 0)) @ vectors.T
        return mean_variance_weights(mu, c, **settings)

    def filled(p: np.ndarray) -> np.ndarray:
        """Gaps with the value above."""
        return np.take_along_axis(p, np.maximum.accumulate(np.where(np.isnan(p), 0, np.arange(len(p))[:, None]), axis=0), axis=0)

    def solve(table: pa.Table, still: dict[int, np.ndarray]) -> Iterator[pa.RecordBatch]:
        # rows are in order of trade and contract: a trade's contracts are runs of rows
        price = table.column("price").to_numpy()
        first_of_trade, first_of_contract = changes(table, "trade_id"), changes(table, "trade_id", "contract")
        runs = np.flatnonzero(first_of_contract)
        least, most = np.fmin.reduceat(price, runs), np.fmax.reduceat(price, runs)
        flat = (least == most) | np.isnan(most)  # such a contract has no returns
        trades = np.flatnonzero(first_of_trade[runs])  # places in runs
        ends = np.append(trades[1:], len(runs))
        found = np.empty(len(runs))
        quiet = np.logical_and.reduceat(flat, trades)
        day = table.column("date").to_numpy()
        for i in range(len(trades)):
            lo, hi = trades[i], ends[i]
            if quiet[i]:
                n = int(hi - lo)
                if n not in still:
                    still[n] = weights(np.ones((2, n)))
                found[lo:hi] = still[n]
                continue
            rows = slice(runs[lo], runs[hi] if hi < len(runs) else len(price))
            days, at = np.unique(day[rows], return_inverse=True)
            cell = at * (hi - lo) + np.cumsum(first_of_contract[rows]) - 1
            here, there = price[rows], ~np.isnan(price[rows])
            size = len(days) * (hi - lo)
            with np.errstate(invalid="ignore"):
                p = (np.bincount(cell[there], here[there], size) / np.bincount(cell[there], minlength=size)).reshape(len(days), hi - lo)
            found[lo:hi] = weights(filled(filled(p)[::-1])[::-1])
        yield from pa.table([table.column("trade_id").take(runs), table.column("contract").take(runs), found], names=["trade_id", "contract", "weight"]).combine_chunks().to_batches()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        still: dict[int, np.ndarray] = {}  # weights of so many contracts whose prices don't move
        for table in whole_groups(batches, "trade_id"):
            yield from solve(table, still)

    kinds = dict(quotes.dtypes)
    rows = quotes.select("trade_id", "contract", "date", F.col("price").cast("double").alias("price")).dropna(subset=["contract", "date"])
    return rows.repartition("trade_id").sortWithinPartitions("trade_id", "contract", "date").mapInArrow(run, f"trade_id {kinds['trade_id']}, contract {kinds['contract']}, weight double")


# Features a contract ranker can use.
RANKER = (
    "dte", "dte_gap", "moneyness", "abs_moneyness", "spread_pct", "volume", "open_interest", "liquidity_score", "delta", "abs_delta", "gamma", "abs_gamma", "theta", "abs_theta", "vega", "abs_vega", "rho", "abs_rho",
    "theta_to_mid", "vega_to_mid", "iv", "iv_expiration_z", "iv_times_sqrt_dte",
)


def ranker_features(chain: DataFrame) -> list[str]:
    """Those of RANKER that the chain has and of which any value is a number; one aggregation."""
    there = [c for c in RANKER if c in chain.columns]
    found = chain.agg(*[F.count(F.col(c).try_cast("double")).alias(c) for c in there]).first() if there else {}
    return [c for c in there if found[c]]


def at_snapshots(chain: DataFrame, days: DataFrame) -> DataFrame:
    """Quotes of the snapshot dates asked for (snapshot_date)."""
    return chain.join(days.select("snapshot_date"), "snapshot_date", "left_semi")


def window_days(trades: DataFrame) -> DataFrame:
    """(trade_id, date): every weekday from a trade's entry to its exit."""
    day = F.explode(F.sequence("entry_date", "exit_date"))
    return trades.filter("entry_date <= exit_date").select("trade_id", day.alias("date")).filter(F.weekday("date") < 5)
