"""Structured Streaming jobs: incremental upsert and windowed counts."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from lodestone.operators.upsert import upsert
from lodestone.scratch import written


def event_counts(events: DataFrame, *, window: str = "1 day", late: str = "5 days") -> DataFrame:
    """Events and their summed value per tumbling window and type; of a stream, rows later than the watermark are dropped."""
    rows = events.withColumn("ts", F.col("ts").cast("timestamp"))
    if rows.isStreaming:
        rows = rows.withWatermark("ts", late)
    out = rows.groupBy(F.window("ts", window).alias("w"), "event_type").agg(F.count("*").alias("events"), F.sum("value").alias("value"))
    return out.select(F.col("w.start").alias("start"), "event_type", "events", "value")


def newest_rows(stream: DataFrame, keys: list[str], *, late: str = "5 days") -> DataFrame:
    """Of a stream (ts), the rows that are newer than all rows of their key that came before, over all batches.

    The time of each key's newest row is kept as state, so a row that comes late does not replace a newer one that came first. Of rows of one key in one batch the newest comes out,
    of equal times the largest by value; a later row of an equal time does not replace it. State goes when the watermark has passed it: rows older than that are dropped anyway.
    """
    timed = stream.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", late)
    columns = list(timed.columns)

    def newest(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        frames = [f[f["ts"].notna()] for f in frames]
        frames = [f for f in frames if len(f)]
        seen = state.get[0] if state.exists else None
        if not frames:
            return
        rows = pd.concat(frames)
        best = rows.sort_values(["ts", *[c for c in columns if c not in (*keys, "ts")]], kind="stable", na_position="first").iloc[[-1]]
        at = best["ts"].iat[0].value // 1000
        if seen is None or at > seen:
            state.update((at,))
            state.setTimeoutTimestamp(max(at // 1000, state.getCurrentWatermarkMs()) + 1)
            yield best[columns]
        else:
            state.setTimeoutTimestamp(max(seen // 1000, state.getCurrentWatermarkMs()) + 1)

    return timed.groupBy(*keys).applyInPandasWithState(newest, timed.schema, "at long", "update", GroupStateTimeout.EventTimeTimeout)


def start_upsert(stream: DataFrame, path: str, checkpoint: str, keys: list[str], *, partition: str, late: str = "5 days") -> StreamingQuery:
    """Upsert a stream into the Parquet table at ``path``, the newest row of each key and partition by ``ts``, rewriting only the partitions that a micro-batch touches.

    Rows that are older than what came before of their key are left out (`newest_rows`). A batch that is run again upserts the same rows, so the sink is idempotent. Partitions
    are replaced one after the other, not at once: a reader may see some of a batch, and after a failure between them the
    batch's own rerun completes it, since what it writes was cut off from the table before.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        touched = batch.select(partition).distinct()
        try:
            old = spark.read.parquet(path).join(touched, partition, "left_semi")
            batch = upsert(old, batch, [*keys, partition])
        except Exception as e:  # the table is not there before the first batch
            if "PATH_NOT_FOUND" not in str(e):
                raise
        # the partitions to be replaced are read above: cut off before they are overwritten
        written(batch, "stream-upsert").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(partition).parquet(path)

    return newest_rows(stream, [*keys, partition], late=late).writeStream.foreachBatch(write).outputMode("update").option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
