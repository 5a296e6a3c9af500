"""Preference formatting: one prompt for the turns that chosen and rejected conversations share, and two masked completions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def conversations(turns: DataFrame, *, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv_id, turns array<struct<role, text>>) in the order of turns.

    Rows of no conversation id are left out; a null turn comes first; equal turn numbers are ordered by role and text; a null
    role is ``user``, a null text empty. A conversation is one value, as its rendering must be.
    """
    turn = F.struct(F.col(turn_col).alias("turn"), F.coalesce(F.col(role_col), F.lit("user")).alias("role"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = turns.filter(F.col(conv_col).isNotNull()).groupBy(F.col(conv_col).alias("conv_id")).agg(F.array_sort(F.collect_list(turn)).alias("t"))
    return rows.select("conv_id", F.transform("t", lambda x: F.struct(x["role"].alias("role"), x["text"].alias("text"))).alias("turns"))


def _render(turn: Column) -> Column:
    return F.concat(F.lit("<|"), turn["role"], F.lit("|>\n"), turn["text"], F.lit("<|end|>\n"))


def _text(turns: Column) -> Column:
    return F.array_join(F.transform(turns, _render), "")


def _mask(turns: Column, role: str) -> Column:
    """[start, stop) in characters of the rendering: what follows the header of each turn of ``role``, its end mark included."""
    start = F.struct(F.lit(0).alias("at"), F.expr("cast(array() as array<struct<start:int,stop:int>>)").alias("spans"))

    def add(state: Column, turn: Column) -> Column:
        stop = state["at"] + F.length(_render(turn))
        span = F.struct((state["at"] + F.length(turn["role"]) + 5).alias("start"), stop.alias("stop"))
        return F.struct(stop.alias("at"), F.when(turn["role"] == role, F.concat(state["spans"], F.array(span))).otherwise(state["spans"]).alias("spans"))

    return F.aggregate(turns, start, add, lambda state: state["spans"])


def format_preferences(pairs: DataFrame, *, role: str = "assistant") -> DataFrame:
    """Adds to ``pairs`` (chosen, rejected: array<struct<role, text>>, and any others) the formatted columns.

    prompt_turns: turns of the longest common prefix; prompt: its rendering; chosen_text, rejected_text: renderings of what
    follows; chosen_mask, rejected_mask: the spans of those to learn from. A null conversation has no turns. Equal
    conversations have all turns in the prompt and empty completions, and so has a pair made of a conversation without any reply. Native expressions only, no shuffle.
    """
    none = F.expr("cast(array() as array<struct<role:string,text:string>>)")
    rows = pairs.withColumns({c: F.coalesce(F.col(c), none) for c in ("chosen", "rejected")})
    same = F.zip_with("chosen", "rejected", lambda x, y: x.eqNullSafe(y))
    at = F.array_position(same, False)
    rows = rows.withColumn("prompt_turns", F.when(at > 0, at - 1).otherwise(F.size(same)).cast("int"))
    rest = {c: F.slice(c, F.col("prompt_turns") + 1, F.greatest(F.size(c) - F.col("prompt_turns"), F.lit(0))) for c in ("chosen", "rejected")}
    rows = rows.withColumn("prompt", _text(F.slice("chosen", F.lit(1), F.col("prompt_turns")))).withColumns({f"{c}_rest": x for c, x in rest.items()})
    rows = rows.withColumns({f"{c}_text": _text(F.col(f"{c}_rest")) for c in rest} | {f"{c}_mask": _mask(F.col(f"{c}_rest"), role) for c in rest})
    return rows.drop("chosen_rest", "rejected_rest")


def with_last_reply_replaced(talks: DataFrame, *, role: str = "assistant") -> DataFrame:
    """``talks`` (conv_id, turns) as pairs: chosen as it is; rejected with its last reply replaced by its first, or emptied if it has one only."""
    place = F.transform("turns", lambda x, i: F.when(x["role"] == role, i))
    rows = talks.withColumn("first", F.array_min(place)).withColumn("last", F.array_max(place))
    reply = F.when(F.col("first") < F.col("last"), F.get("turns", F.col("first"))["text"]).otherwise(F.lit(""))
    swapped = F.transform("turns", lambda x, i: F.struct(x["role"].alias("role"), F.when(i == F.col("last"), reply).otherwise(x["text"]).alias("text")))
    return rows.select("conv_id", F.col("turns").alias("chosen"), swapped.alias("rejected"))
