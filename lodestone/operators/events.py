"""Event pairs: mirrored positive and negative events, classified from vendor rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestone.operators.asof import asof_join
from lodestone.operators.quantiles import exact_quantiles
from lodestone.operators.upsert import upsert
from lodestone.scratch import written

# The positive and the negative type of each family.
FAMILIES = {
    "congress": ("congress_buy", "congress_sell"), "insider": ("insider_buy", "insider_sell"), "analyst_rating": ("analyst_upgrade", "analyst_downgrade"),
    "price_target": ("price_target_raise", "price_target_cut"), "institutional": ("institutional_add", "institutional_reduce"), "capital_action": ("buyback_authorization", "equity_offering"),
    "dividend": ("dividend_increase", "dividend_cut"), "split": ("forward_split", "reverse_split"), "earnings": ("earnings_beat", "earnings_miss"),
}
# Words that tell a purchase from a sale, in text padded with blanks; purchases are tested first.
BUY = ("purchase", "buy", "acquisition", "acquired", " p ", " a ")
SELL = ("sale", "sell", "disposition", "disposed", " s ", " d ")
# Rating words and their score.
RATINGS = ((5, ("strong buy", "outperform", "overweight", "buy")), (4, ("market perform", "neutral", "hold", "equal weight")), (3, ("underperform", "underweight", "sell")))
# Words of an action that tell the direction; the former are tested first.
RAISED, LOWERED = ("upgrade", "raised", "initiated"), ("downgrade", "lowered")
# What tells an event from another.
KEYS = ("symbol", "event_date", "event_family", "event_type", "actor_type", "actor", "strength")


def has_any(text: Column, words: tuple[str, ...]) -> Column:
    found = F.lit(False)
    for w in words:
        found = found | F.contains(text, F.lit(w))
    return found


def mirror(family: str = "event_family", kind: str = "event_type") -> tuple[Column, Column]:
    """The opposite type and the side (+1, -1) of a type; null where the family doesn't have it."""
    opposite, side = F.lit(None).cast("string"), F.lit(None).cast("int")
    for name, (up, down) in FAMILIES.items():
        here = F.lower(F.trim(family)) == name
        k = F.lower(F.trim(kind))
        opposite = F.when(here & (k == up), down).when(here & (k == down), up).otherwise(opposite)
        side = F.when(here & (k == up), 1).when(here & (k == down), -1).otherwise(side)
    return opposite, side


def trade_type(text: Column, family: str) -> Column:
    """Buy or sell type of the family (insider or congress) from transaction text."""
    padded = F.lower(F.concat(F.lit(" "), F.coalesce(text, F.lit("")), F.lit(" ")))
    up, down = FAMILIES[family]
    return F.when(has_any(padded, BUY), up).when(has_any(padded, SELL), down)


def rating_score(text: Column) -> Column:
    t, out = F.lower(F.trim(text)), F.lit(None).cast("int")
    for score, words in reversed(RATINGS):
        out = F.when(has_any(t, words), score).otherwise(out)
    return F.when(t != "", out)


def rating_type(action: Column, new: Column, old: Column) -> Column:
    """From the action's words, else from the two ratings' scores."""
    a = F.lower(F.coalesce(action, F.lit("")))
    up, down = FAMILIES["analyst_rating"]
    n, o = rating_score(new), rating_score(old)
    return F.when(has_any(a, RAISED), up).when(has_any(a, LOWERED), down).when(n > o, up).when(n < o, down)


def revision_type(now: Column, before: Column, family: str) -> Column:
    """Up or down against the value before; none where either is missing or both are equal."""
    up, down = FAMILIES[family]
    return F.when(now > before, up).when(now < before, down)


def sign_type(value: Column, family: str) -> Column:
    up, down = FAMILIES[family]
    return F.when(value > 0, up).when(value < 0, down)


def normalize_events(rows: DataFrame) -> DataFrame:
    """Fixed columns with midnight dates, the disclosure lag in days, mirror type and side; rows of no type or date are left out, an unknown type is an error."""
    opposite, side = mirror()
    known = F.when(opposite.isNull(), F.raise_error(F.concat(F.lit("unknown event type "), "event_type"))).otherwise(opposite)
    ready = rows.filter("event_type is not null and event_date is not null").withColumns({"event_date": F.to_date("event_date"), "reported_date": F.to_date("reported_date")})
    return ready.select("symbol", "event_date", "reported_date", F.datediff("reported_date", "event_date").alias("disclosure_lag_days"), "event_family", "event_type", known.alias("mirror_type"), side.alias("side"), "actor", "source", "strength")


def merge_events(existing: DataFrame, incoming: DataFrame) -> DataFrame:
    """Upsert by the identifying columns (those of KEYS that the events have); nulls are equal."""
    return upsert(existing, incoming, [k for k in KEYS if k in existing.columns])


def fill_missing_families(cached: DataFrame, built: DataFrame) -> DataFrame:
    """Cached families win; built events only of families that are not cached for the symbol."""
    have = cached.select("symbol", "event_family").distinct()
    return cached.unionByName(built.join(have, ["symbol", "event_family"], "left_anti"))


def dividend_changes(rows: DataFrame) -> DataFrame:
    """Dividends (symbol, event_date, amount) that were raised or cut against the one before."""
    before = F.lag("amount").over(Window.partitionBy("symbol").orderBy("event_date"))
    return rows.withColumn("event_type", revision_type(F.col("amount"), before, "dividend")).filter("event_type is not null")


def event_study(events: DataFrame, prices: DataFrame, market: DataFrame, *, horizons: tuple[int, ...] = (20, 60, 120), by: tuple[str, ...] = ("event_type",), tail: float = 0.01, tolerance: int = 7, least: int = 1) -> DataFrame:
    """Per group and horizon: n, mean after winsorising at both tails, median and hit rate of the side-adjusted return over the market's.

    Groups of fewer than ``least`` returns are left out (an actor's record is usually asked for 15 of them). Groups are few and large: their quantiles
    are found by `exact_quantiles` in one pass, over returns that are written once.
    """
    w = Window.partitionBy("symbol").orderBy("date")
    p = prices.join(market, "date", "left").select("symbol", F.col("date").alias("start"), *[(F.lead("close", h).over(w) / F.col("close") - F.lead("level", h).over(w) / F.col("level")).alias(f"a{h}") for h in horizons])
    on = asof_join(events.select("symbol", "event_date", "side", *[c for c in by if c != "side"]), p, left_on="event_date", right_on="start", by=("symbol",), direction="forward", tolerance=tolerance)
    long = on.select(*by, F.expr(f"stack({len(horizons)}, {', '.join(f'{h}, side * a{h}' for h in horizons)}) as (horizon, value)")).filter("value is not null")
    long = written(long, "event-study")
    bounds = exact_quantiles(long, "value", (tail, 0.5, 1 - tail), (*by, "horizon"), name="b")
    same = F.lit(True)
    for c in (*by, "horizon"):
        same = same & F.col(c).eqNullSafe(F.col(f"__{c}"))
    both = long.join(bounds.withColumnsRenamed({c: f"__{c}" for c in (*by, "horizon")}), same)
    cut = F.least(F.greatest("value", F.get("b", F.lit(0))), F.get("b", F.lit(2)))
    out = both.groupBy(*by, "horizon").agg(F.count("*").alias("n"), F.avg(cut).alias("mean"), F.max(F.get("b", F.lit(1))).alias("median"), F.avg((F.col("value") > 0).cast("double")).alias("hit_rate"))
    return out.filter(F.col("n") >= least)


def target_panel(grid: DataFrame, aligned: DataFrame, types: tuple[str, ...]) -> DataFrame:
    """The grid (symbol, date) with a 0/1 column target_event_on__{type} for each type."""
    flags = aligned.filter(F.col("event_type").isin(*types)).groupBy("symbol", "date").pivot("event_type", list(types)).agg(F.lit(1))
    names = {t: f"target_event_on__{t}" for t in types}
    return grid.join(flags.withColumnsRenamed(names), ["symbol", "date"], "left").fillna(0, list(names.values()))


def target_summary(panel: DataFrame) -> DataFrame:
    """Per target: rows, active rows (any event that day), positives, their rate over active rows, symbols with one, first and last date of one."""
    names = [c for c in panel.columns if c.startswith("target_")]
    active = F.greatest(*names, F.lit(0)) > 0
    long = panel.withColumn("__active", active.cast("int")).unpivot(["symbol", "date", "__active"], names, "target", "value")
    hit = F.col("value") > 0
    return long.groupBy("target").agg(F.count("*").alias("rows"), F.sum("__active").alias("active"), F.sum(hit.cast("long")).alias("positives"), F.try_divide(F.sum(hit.cast("double")), F.nullif(F.sum("__active"), F.lit(0))).alias("rate"), F.countDistinct(F.when(hit, F.col("symbol"))).alias("symbols"), F.min(F.when(hit, F.col("date"))).alias("first_date"), F.max(F.when(hit, F.col("date"))).alias("last_date"))


def collapsed_target(grid: DataFrame, aligned: DataFrame, types: tuple[str, ...], name: str) -> DataFrame:
    """The grid (symbol, date) with ``name``: 1 on days with an event of ``types``, and ``active``: 1 on days with any event."""
    days = aligned.groupBy("symbol", "date").agg(F.max(F.col("event_type").isin(*types).cast("int")).alias(name), F.lit(1).alias("active"))
    return grid.join(days, ["symbol", "date"], "left").fillna(0, [name, "active"])
