"""Tool calls joined to their cost as a stream-stream join (I11 on a stream).

Calls and cost events share an event id and arrive on two streams.  Both are
watermarked and a cost belongs to a call only within ``within`` of it, so Spark
drops the state of either side once the other's watermark has passed that
bound.  A call without a cost by then is reported with a null cost (left outer
join); a cost that arrives later than the watermark is dropped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def calls_with_cost(calls: DataFrame, priced: DataFrame, watermark: str = "1 hour", within: str = "1 hour") -> DataFrame:
    """One row per call: ``event_id, timestamp_utc, tool_name, status, cost_dollars`` (null: no cost within the bound)."""
    left = calls.select("event_id", "timestamp_utc", "tool_name", "status").withWatermark("timestamp_utc", watermark)
    right = (priced.select(F.col("event_id").alias("cost_event_id"), F.col("timestamp_utc").alias("cost_at"), "cost_dollars")
                   .withWatermark("cost_at", watermark))
    near = F.expr(f"event_id = cost_event_id AND cost_at >= timestamp_utc - INTERVAL {within} "
                  f"AND cost_at <= timestamp_utc + INTERVAL {within}")
    return left.join(right, near, "left_outer").select("event_id", "timestamp_utc", "tool_name", "status", "cost_dollars")


def behaviour_and_cost(joined: DataFrame) -> DataFrame:
    """Calls, dollars and calls without a cost per tool and status."""
    return joined.groupBy("tool_name", "status").agg(
        F.count("cost_dollars").alias("calls"), F.sum("cost_dollars").alias("cost_dollars"),
        F.count_if(F.col("cost_dollars").isNull()).alias("calls_without_cost"))
