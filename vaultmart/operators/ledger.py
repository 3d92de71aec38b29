"""A sequential budget rule over ledgers, without one task per ledger.

Requests of a ledger come in order; one whose projected cost does not fit into
what is left of the budget is refused and books nothing, any other books its
actual cost before the next one is looked at.

Requests are cut into chunks of about ``CHUNK_ROWS`` rows by a range partition
over (ledger, order).  Per chunk three numbers say whether it can be admitted
whole from a given state: prefix sums over them give every ledger's state up
to its first chunk with a refusal.  Only that chunk, bounded in rows, is
decided by one ordered pass.  Spending never falls, so of the ledger's later
requests all that exceed what is then left are refused at once; the others are
cut into chunks anew.  A round therefore settles a whole chunk of every open
ledger: rounds are bounded by the chunks that hold a refusal, not by refusals.

Null budget: unlimited; a null feature or day is a ledger like any other; rows
with null costs must be kept away (see ``ops``).  Equal times
are ordered by ``request_seq``, then ``request_id``.  Amounts are whole numbers,
so sums are exact in any order.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vaultmart.session import materialize

CHUNK_ROWS = 100_000
LEDGER = ["feature", "usage_date"]
ORDER = ["timestamp_utc", "request_seq", "request_id"]
_DECIDED = [*LEDGER, *ORDER, "place", "projected_micro", "actual_micro", "admitted"]


def _beside(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Join on keys that may be null (a null feature or day is a ledger of its own)."""
    other = right.select(*[F.col(k).alias(f"_{k}") for k in keys], *[c for c in right.columns if c not in keys])
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
    return left.join(other, same, how).drop(*[f"_{k}" for k in keys])


def _chunked(df: DataFrame, rows: int) -> DataFrame:
    """``chunk`` (ascending along a ledger's order) and ``inside``, the chunk's costs before a row if all are admitted."""
    n = max(1, -(-rows // CHUNK_ROWS))
    if n == 1:
        df = df.withColumn("chunk", F.lit(0))
    else:
        df = df.repartitionByRange(n, *LEDGER, *ORDER).withColumn("chunk", F.spark_partition_id())
    before = Window.partitionBy(*LEDGER, "chunk").orderBy(*ORDER).rowsBetween(Window.unboundedPreceding, -1)
    return df.withColumn("inside", F.coalesce(F.sum("actual_micro").over(before), F.lit(0)))


def _ordered_pass(pdf: pd.DataFrame) -> pd.DataFrame:
    """One chunk of one ledger, request by request."""
    pdf = pdf.sort_values(ORDER, kind="mergesort", na_position="first")
    spent, budget, admitted = int(pdf["start"].iloc[0]), int(pdf["budget_micro"].iloc[0]), []
    for projected, actual in zip(pdf["projected_micro"].tolist(), pdf["actual_micro"].tolist()):
        ok = spent + projected <= budget
        if ok:
            spent += actual
        admitted.append(ok)
    return pdf.assign(admitted=admitted, after=spent)


def _first_refusals(rows: DataFrame) -> DataFrame:
    """Per (ledger, chunk): the state it starts from if all before are admitted, and the ledger's first chunk with a refusal."""
    along = Window.partitionBy(*LEDGER).orderBy("chunk")
    whole = Window.partitionBy(*LEDGER)
    chunks = rows.groupBy(*LEDGER, "chunk").agg(
        F.sum("actual_micro").alias("total"), F.max(F.col("inside") + F.col("projected_micro")).alias("need"),
        F.max("budget_micro").alias("budget"), F.max("spent").alias("spent"))
    start = F.col("spent") + F.coalesce(F.sum("total").over(along.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    refuses = F.col("start") + F.col("need") > F.col("budget")
    return (chunks.withColumn("start", start).withColumn("first", F.min(F.when(refuses, F.col("chunk"))).over(whole))
                  .select(*LEDGER, "chunk", "start", "first"))


def admissions(spark: SparkSession, requests: DataFrame, spent: DataFrame | None = None) -> DataFrame:
    """Every request with ``admitted`` and ``place`` (its chunk in the whole order).

    ``requests`` holds the ledger and order columns, ``budget_micro``,
    ``projected_micro`` and ``actual_micro`` and should be stored (it is counted
    first); ``spent`` what ledgers had booked before (``spent_micro``).
    """
    rows = requests.withColumn("place", F.lit(0))
    if spent is None:
        rows = rows.withColumn("spent", F.lit(0).cast("long"))
    else:
        rows = _beside(rows, spent.select(*LEDGER, F.col("spent_micro").alias("spent")), LEDGER, "left").fillna(0, ["spent"])
    count, decided, first = requests.count(), None, True
    while True:
        several = count > CHUNK_ROWS
        rows = _chunked(rows, count)
        if first:
            rows, first = rows.withColumn("place", F.col("chunk")), False
        if several:
            rows = materialize(spark, rows, "ledger-chunks")          # the chunk numbers are read more than once
        marked = _beside(rows, _first_refusals(rows), [*LEDGER, "chunk"])
        whole = marked.where("first IS NULL OR chunk < first").withColumn("admitted", F.lit(True))
        tried = marked.where("chunk = first")
        schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in tried.schema) + ", admitted boolean, after bigint"
        passed = tried.groupBy(*LEDGER).applyInPandas(_ordered_pass, schema)
        if several:
            passed = materialize(spark, passed, "ledger-pass")
        done = whole.select(*_DECIDED).unionByName(passed.select(*_DECIDED))
        decided = done if decided is None else decided.unionByName(done)
        if not several:                                               # one chunk per ledger: nothing is left
            return decided
        state = passed.groupBy(*LEDGER).agg(F.max("after").alias("left_at"))
        later = materialize(spark, _beside(marked.where("chunk > first"), state, LEDGER).withColumn(
            "admitted", F.when(F.col("left_at") + F.col("projected_micro") > F.col("budget_micro"), F.lit(False))), "ledger-later")
        decided = decided.unionByName(later.where("admitted IS NOT NULL").select(*_DECIDED))
        rows = later.where("admitted IS NULL").withColumn("spent", F.col("left_at")).select(*requests.columns, "place", "spent")
        count = rows.count()
        if count == 0:
            return decided


def booked(decided: DataFrame, spent: DataFrame | None = None) -> DataFrame:
    """Add ``booked_micro`` and ``spent_after_micro``, the ledger's state behind each request: sums per place, then inside it."""
    inside = Window.partitionBy(*LEDGER, "place").orderBy(*ORDER).rowsBetween(Window.unboundedPreceding, 0)
    along = Window.partitionBy(*LEDGER).orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    rows = decided.withColumn("booked_micro", F.when(F.col("admitted"), F.col("actual_micro")).otherwise(F.lit(0).cast("long")))
    base = rows.groupBy(*LEDGER, "place").agg(F.sum("booked_micro").alias("_sum")).select(
        *LEDGER, "place", F.coalesce(F.sum("_sum").over(along), F.lit(0)).alias("_base"))
    if spent is not None:
        base = (_beside(base, spent.select(*LEDGER, "spent_micro"), LEDGER, "left")
                    .withColumn("_base", F.col("_base") + F.coalesce("spent_micro", F.lit(0))).drop("spent_micro"))
    return (_beside(rows.withColumn("_in", F.sum("booked_micro").over(inside)), base, [*LEDGER, "place"])
            .withColumn("spent_after_micro", F.col("_base") + F.col("_in")).drop("_in", "_base"))
