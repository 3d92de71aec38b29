"""Streaming budget admission (I12 on a stream).

Every micro-batch is decided by the batch job's rounds (``operators.ledger``),
starting from what the ledgers had booked before.  That state is a versioned
table: batch n reads the version of the batch before it and writes version n,
and its decisions go to a folder of its own.  A replayed batch reads the same
older version and overwrites its own folders, so nothing is booked twice, and
no ledger is one state key or one task.  A version becomes visible to readers
with its entry in the manifest (see ``committed``), written last.

Within a micro-batch requests are decided in time order, across micro-batches
in arrival order, so the decisions equal the batch job's whenever batches
follow each other in time.  A ledger that got no request for ``keep_days``
days before the newest one leaves the state.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vaultmart.operators.ledger import LEDGER
from vaultmart.plans import ops as OPS
from vaultmart.session import materialize
from vaultmart.streaming.committed import CommittedBatches


def budget_admission_stream(spark: SparkSession, requests: DataFrame, root: str, checkpoint: str, budgets: dict | None = None,
                            rates: dict | None = None, keep_days: int = 2, available_now: bool = True):
    """Start the admission of a stream of requests; decisions and ledgers are tables under ``root``."""
    decisions, ledgers = CommittedBatches(spark, f"{root}/decisions"), CommittedBatches(spark, f"{root}/ledgers")

    def decide(batch: DataFrame, batch_id: int) -> None:
        before = ledgers.batch(ledgers.last_before(batch_id))
        decided = materialize(spark, OPS.budget_admission(spark, batch, budgets, rates, before), "decided")
        booked = decided.groupBy(*LEDGER).agg(F.sum("booked_micro").alias("spent_micro"))
        now = booked if before is None else booked.unionByName(before).groupBy(*LEDGER).agg(F.sum("spent_micro").alias("spent_micro"))
        newest = decided.agg(F.max("usage_date")).first()[0]
        if newest is not None:
            now = now.where(F.col("usage_date").isNull() | (F.col("usage_date") >= F.date_sub(F.lit(newest), keep_days)))
        ledgers.write(now, batch_id)
        decisions.write(decided, batch_id)

    w = requests.writeStream.foreachBatch(decide).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()


def admission_decisions(spark: SparkSession, root: str) -> DataFrame | None:
    """All committed decisions, each request once."""
    return CommittedBatches(spark, f"{root}/decisions").table()
