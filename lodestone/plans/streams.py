"""The streaming jobs' computations over the whole table, as batch."""

from __future__ import annotations

from lodestone.plans.registry import query
from lodestone.streaming.jobs import event_counts
from lodestone.views import table


@query("t02_event_counts", "SELECT cast(date_trunc('day', ts) AS DATE) AS start, event_type, count(*) AS events, sum(value) AS value FROM events GROUP BY ALL", floats=["value"], dates=["start"], digits=3)
def t02(spark, sf):
    rows = event_counts(table(spark, sf, "events"))
    return rows.withColumn("start", rows["start"].cast("date"))
