"""Proportional stratified interleaving: shards that each hold every source in the mixture's proportion.

Rows are shuffled within their source by a seeded digest, ranked, and given the fractional rank
(rank - 1/2) / rows of the source. Sorted by it, all sources advance evenly; cutting that order into
equal runs gives shards whose sizes differ by one row at most. Ranks are found without holding a
source, or the table, in one task: rows fall into equal slices of the digest's (then the fractional
rank's) range, slice counts are summed up, and only within a slice are rows sorted.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Slices at least, and rows a slice should hold at most; slices double from LEAST until they do.
LEAST, ROWS = 1024, 500_000


def _slices(rows: int) -> int:
    n = LEAST
    while rows / n > ROWS and n < 1 << 24:
        n *= 2
    return n


def interleave(df: DataFrame, shards: int, *, strata: str = "source", id_col: str = "doc_id", text_col: str = "text", seed: int = 7) -> DataFrame:
    """Per row: doc_id, size (UTF-8 bytes + 1), text_crc32, law ``rows``, shard, slot (from 0, gapless in a shard), grown_shard (null).

    Shard row counts are at most one apart. Every cut falls at one fractional rank for all strata, so
    a shard's rows of a stratum differ from its share by less than the number of strata. Of equal texts each row is placed for itself. A null text counts as empty, a null stratum as a stratum of its own; rows with equal id and
    text are interchangeable; an empty table gives no rows; other columns are not looked at.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    # the digest's first 32 bits deal rows into slices, all of it sorts them
    rows = df.select(
        F.col(id_col).alias("doc_id"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.coalesce(F.concat(F.lit("="), F.col(strata).cast("string")), F.lit("null")).alias("stratum"),
        # rows of no id are told apart by their texts, so they don't share one slice
        F.md5(F.concat_ws(":", F.lit(str(seed)), F.coalesce(F.col(id_col).cast("string"), F.concat(F.lit("null"), F.md5(text.cast("binary"))))).cast("binary")).alias("digest"),
    )
    total = df.count()
    n = _slices(total)
    rows = rows.withColumn("slice", F.expr(f"cast(conv(substring(digest, 1, 8), 16, 10) as bigint) * {n} div 4294967296"))

    counts = rows.groupBy("stratum", "slice").agg(F.count("*").alias("here"))
    run = Window.partitionBy("stratum").orderBy("slice")
    starts = counts.select("stratum", "slice", (F.sum("here").over(run) - F.col("here")).alias("before"), F.sum("here").over(Window.partitionBy("stratum")).alias("of"))
    order = Window.partitionBy("stratum", "slice").orderBy("digest", "doc_id", "text_crc32", "size")
    ranked = rows.join(starts, ["stratum", "slice"]).withColumn("rank", F.col("before") + F.row_number().over(order))
    # (2 rank - 1) / (2 of), exactly the same double wherever it is computed
    placed = ranked.withColumn("at", (2 * F.col("rank") - 1).cast("double") / (2 * F.col("of")).cast("double")).select("doc_id", "size", "text_crc32", "stratum", "at", "rank")
    placed = placed.withColumn("slice", F.floor(F.col("at") * n).cast("long"))

    counts = placed.groupBy("slice").agg(F.count("*").alias("here"))
    starts = counts.select("slice", (F.sum("here").over(Window.orderBy("slice")) - F.col("here")).alias("before"))  # one row a slice
    order = Window.partitionBy("slice").orderBy("at", "stratum", "rank")
    position = placed.join(starts, "slice").withColumn("p", F.col("before") + F.row_number().over(order) - 1)
    return position.withColumn("shard", F.expr(f"cast(p * {shards} div {max(total, 1)} as int)")).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard",
        F.expr(f"p - (shard * {max(total, 1)}L + {shards - 1}) div {shards}").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
