"""Streaming form of the tool-call audit log and its alert rules.

Events arrive as files; each rule is one streaming aggregation over
event-time windows with a watermark, emitted in append mode when the
watermark passes the window end (late rows beyond the watermark are
dropped).  Duplicate deliveries are removed with
``dropDuplicatesWithinWatermark`` on ``event_id``.  Nothing is
collected on the driver: alerts go to a table through ``foreachBatch``,
written per batch id so a retried batch overwrites itself.
"""

from __future__ import annotations

import datetime as dt
import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vaultmart.operators.vault import read_table
from vaultmart.plans import ops as OPS
from vaultmart.session import scratch_path
from vaultmart.streaming.committed import CommittedBatches

TOOL_CALL_SCHEMA = T.StructType([
    T.StructField("event_id", T.StringType()), T.StructField("timestamp_utc", T.StringType()),
    T.StructField("session_id", T.StringType()), T.StructField("caller_identity", T.StringType()),
    T.StructField("user_question", T.StringType()), T.StructField("tool_name", T.StringType()),
    T.StructField("tool_arguments", T.StringType()), T.StructField("resolved_metric", T.StringType()),
    T.StructField("matched_synonym", T.StringType()), T.StructField("status", T.StringType()),
    T.StructField("error_message", T.StringType()), T.StructField("latency_ms", T.IntegerType()),
    T.StructField("row_count_returned", T.IntegerType()),
])


def read_tool_calls(spark: SparkSession, source_dir: str, fmt: str = "json",
                    schema: T.StructType = TOOL_CALL_SCHEMA) -> DataFrame:
    """A streaming DataFrame of tool-call events; the text timestamp is parsed."""
    df = spark.readStream.schema(schema).format(fmt).load(source_dir)
    if isinstance(schema["timestamp_utc"].dataType, T.StringType):
        df = df.withColumn("timestamp_utc", F.to_timestamp("timestamp_utc"))
    return df


def deduplicated(events: DataFrame, watermark: str = "10 minutes") -> DataFrame:
    return events.withWatermark("timestamp_utc", watermark).dropDuplicatesWithinWatermark(["event_id"])


def _wm(events: DataFrame, watermark: str | None) -> DataFrame:
    # ``None``: the stream already carries a watermark (e.g. from ``deduplicated``)
    return events if watermark is None else events.withWatermark("timestamp_utc", watermark)


def error_rate_stream(events: DataFrame, window: str = "1 minute", watermark: str | None = "2 minutes") -> DataFrame:
    """I2 on a stream."""
    return OPS.error_rate_alerts(_wm(events, watermark), window)


def repeated_call_stream(events: DataFrame, window: str = "1 minute",
                         watermark: str | None = "2 minutes") -> DataFrame:
    """I3 on a stream."""
    return OPS.repeated_call_alerts(_wm(events, watermark), window)


def latency_stream(events: DataFrame, window: str = "1 minute", watermark: str | None = "2 minutes") -> DataFrame:
    """I4 on a stream (``percentile_approx`` is a streaming aggregate)."""
    return OPS.latency_alerts(_wm(events, watermark), window)


ALERT_RULES = ("high_error_rate", "repeated_identical_calls", "latency_spike")


def alert_table_stream(events: DataFrame, window: str = "1 minute", watermark: str | None = "2 minutes") -> DataFrame:
    """I5 on a stream: the three rules' aggregates over one source, as one alert table of one query."""
    return OPS.alert_table(_wm(events, watermark), window)


def write_alerts(spark: SparkSession, alerts: DataFrame, root: str, checkpoint: str, available_now: bool = True):
    """I5 sink: one job and one checkpoint for all rules.  Every micro-batch is committed rule by rule, so a batch
    replayed after a crash puts its alerts in the place of those it wrote before (see ``CommittedBatches``)."""
    table = CommittedBatches(spark, root)

    def sink(batch: DataFrame, batch_id: int) -> None:
        batch.persist()                                    # the aggregates run once for the three rules
        try:
            for rule in ALERT_RULES:
                table.write(batch.where(F.col("rule") == rule), batch_id, rule)
        finally:
            batch.unpersist()

    w = alerts.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint).outputMode("append")
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()


def write_batches(stream: DataFrame, out_dir: str, checkpoint: str, available_now: bool = True):
    """I5 sink: each micro-batch is written under ``batch_id=<n>``, overwriting
    on retry, so the table holds every alert exactly once."""
    def sink(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(os.path.join(out_dir, f"batch_id={batch_id}"))

    w = stream.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint).outputMode("append")
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()


def closing(spark: SparkSession, events: DataFrame, time_col: str = "timestamp_utc"):
    """(events, close): a bounded run's way to emit its last windows.

    The stream also reads a folder that is empty until ``close()`` puts one
    event of a far day there; a further run from the same checkpoint then moves
    the watermark past every open window.  That event's own window never closes.
    """
    folder = scratch_path(spark, f"close-{uuid.uuid4().hex}")
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in events.schema])
    spark.createDataFrame([], schema).write.parquet(folder)

    def close(**values) -> None:
        row = [dt.datetime(9999, 1, 1) if f.name == time_col else values.get(f.name) for f in schema]
        spark.createDataFrame([row], schema).write.mode("append").parquet(folder)

    return events.unionByName(spark.readStream.schema(schema).parquet(folder)), close


def run_to_table(spark: SparkSession, stream: DataFrame, name: str, close=None) -> DataFrame:
    """Run a streaming query over all available input and read back its output.

    With ``close`` (see ``closing``) the windows left open at the end of the
    input are emitted by a second run from the same checkpoint.  Output and
    checkpoint live under the shared checkpoint folder.
    """
    root = scratch_path(spark, f"{name}-{uuid.uuid4().hex}")
    for last in ([False, True] if close else [True]):
        write_batches(stream, os.path.join(root, "out"), os.path.join(root, "checkpoint")).awaitTermination()
        if not last:
            close()
    got = read_table(spark, os.path.join(root, "out"))
    # no batch produced output: empty result with the stream's schema
    return spark.createDataFrame([], stream.schema) if got is None else got.drop("batch_id")
