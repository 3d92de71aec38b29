"""Range operators Spark has no single built-in for.

``next_start_within``: for every index interval, the earliest start of
another interval of the same key that begins strictly after the index
interval ends and no later than ``days`` after it (30-day readmission).

The naive form is a self-join per key with the range in a CASE, which
emits every pair of stays of a member.  Here no pairs are emitted:

1. Index rows (time = end) and candidate rows (time = start) are put in
   one frame, partitioned by (key, bucket) where a bucket is ``days``
   wide.  A candidate is also copied into the previous bucket, so the
   partition of an index row holds every candidate that can answer it.
   A hot key is therefore split across time buckets.
2. Inside a partition the rows are sorted by time descending; the
   answer is the last candidate seen before the index row (a running
   ``last(ignorenulls)``, linear in the partition size).
3. An index interval that ends before it starts would find itself; the
   candidate row's own "next" value (same window, second pass over the
   same sort) gives the exact answer then.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def _nearest_next(u: DataFrame, days: int, id_col: str, keep: list[str]) -> DataFrame:
    """Window pass over tagged rows (_k, _b, _t, _kind, _cs, _cid, _iid, keep...):
    ``next_start`` for every index row (_kind = 1)."""
    w = (Window.partitionBy("_k", "_b")
               .orderBy(F.col("_t").desc(), F.col("_kind").desc(), F.col("_cid").desc_nulls_first())
               .rowsBetween(Window.unboundedPreceding, -1))
    cand_struct = F.when(F.col("_kind") == 0, F.struct(F.col("_cs").alias("s"), F.col("_cid").alias("id")))
    u = u.withColumn("_near", F.last(cand_struct, ignorenulls=True).over(w))
    with_next = F.when(F.col("_kind") == 0, F.struct(F.col("_cs").alias("s"), F.col("_cid").alias("id"),
                                                      F.col("_near.s").alias("nxt")))
    u = u.withColumn("_near2", F.last(with_next, ignorenulls=True).over(w))
    res = u.where(F.col("_kind") == 1).select(
        F.col("_iid").alias(id_col), *keep, F.col("_t").alias("_end"),
        F.when(F.col("_near2.id") == F.col("_iid").cast("string"), F.col("_near2.nxt"))
         .otherwise(F.col("_near2.s")).alias("_next"))
    limit = F.col("_end") + F.make_interval(days=F.lit(days))
    return res.select(id_col, *keep, F.when(F.col("_next") <= limit, F.col("_next")).alias("next_start"))


def next_start_within(index: DataFrame, candidates: DataFrame, key: str, id_col: str,
                      start: str, end: str, days: int) -> DataFrame:
    """Return ``(id_col, next_start)`` for every index row with a non-null end."""
    width = days * 86400
    ts = "timestamp"
    idx = (index.where(F.col(end).isNotNull() & F.col(key).isNotNull())
                .select(F.col(key).alias("_k"), F.col(id_col).alias("_iid"), F.col(end).cast(ts).alias("_t"),
                        F.lit(1).alias("_kind"), F.lit(None).cast(ts).alias("_cs"),
                        F.lit(None).cast("string").alias("_cid"),
                        F.floor(F.unix_timestamp(F.col(end).cast(ts)) / width).alias("_b")))
    cand = (candidates.where(F.col(start).isNotNull() & F.col(key).isNotNull())
                      .select(F.col(key).alias("_k"), F.lit(None).cast("string").alias("_iid"),
                              F.col(start).cast(ts).alias("_t"), F.lit(0).alias("_kind"),
                              F.col(start).cast(ts).alias("_cs"), F.col(id_col).cast("string").alias("_cid"),
                              F.explode(F.array(F.floor(F.unix_timestamp(F.col(start).cast(ts)) / width),
                                                F.floor(F.unix_timestamp(F.col(start).cast(ts)) / width) - 1))
                               .alias("_b")))
    return _nearest_next(idx.unionByName(cand), days, id_col, [])


def next_start_within_self(df: DataFrame, key: str, id_col: str, start: str, end: str, days: int,
                           carry: tuple = ()) -> DataFrame:
    """Same answer when the index and candidate intervals are one frame, in
    one pass over it: every row is exploded into its index row (at its
    end) and its two candidate rows (at its start, in its bucket and the
    previous one), so the input is read once and no join back is needed.
    Returns ``(id_col, key, *carry, next_start)`` per row with a non-null end."""
    width = days * 86400
    ts = "timestamp"
    t_end, t_start = F.col(end).cast(ts), F.col(start).cast(ts)
    b_end = F.floor(F.unix_timestamp(t_end) / width)
    b_start = F.floor(F.unix_timestamp(t_start) / width)
    no_ts, no_id = F.lit(None).cast(ts), F.lit(None).cast("string")

    def tag(t, kind, cs, cid, b):
        return F.struct(t.alias("_t"), F.lit(kind).alias("_kind"), cs.alias("_cs"), cid.alias("_cid"),
                        b.alias("_b"))
    rid = F.col(id_col).cast("string")
    tags = F.array(F.when(F.col(end).isNotNull(), tag(t_end, 1, no_ts, no_id, b_end)),
                   F.when(F.col(start).isNotNull(), tag(t_start, 0, t_start, rid, b_start)),
                   F.when(F.col(start).isNotNull(), tag(t_start, 0, t_start, rid, b_start - 1)))
    keep = [key, *carry]
    u = (df.where(F.col(key).isNotNull())
           .select(F.col(key).alias("_k"), F.col(id_col).alias("_iid0"), *keep,
                   F.explode(F.filter(tags, lambda x: x.isNotNull())).alias("_g"))
           .select("_k", *keep, "_g.*", F.when(F.col("_g._kind") == 1, F.col("_iid0")).alias("_iid")))
    return _nearest_next(u, days, id_col, keep)


def interval_join(events: DataFrame, intervals: DataFrame, key: str, at: str,
                  start: str, end: str, how: str = "inner", interval_key: str | None = None) -> DataFrame:
    """Equi-join on the key plus ``start <= at < coalesce(end, +inf)`` (half-open).

    The equality on the key lets Spark hash-partition (or broadcast, when
    AQE measures the interval side as small); the range is a post-join
    filter over the few versions per key, so no pairs beyond a key's
    versions are formed.
    """
    ik = interval_key or key
    cond = ((events[key] == intervals[ik]) & (events[at] >= intervals[start])
            & (intervals[end].isNull() | (events[at] < intervals[end])))
    return events.join(intervals, cond, how)


def binned_interval_join(events: DataFrame, intervals: DataFrame, key: str, at: str, start: str, end: str,
                         bin_seconds: int, interval_key: str | None = None) -> DataFrame:
    """``interval_join`` for keys with very many intervals.

    Time is cut into bins; an interval stands once in every bin that it
    touches, an event in the one bin it falls into, so the equality is on
    (key, bin) and the range is checked among the few intervals of a bin.
    Open and far ends are clipped to the span of the events (two values reach
    the driver), so an interval is copied at most span / ``bin_seconds`` times.
    Choose bins so that a key has few interval starts in each: a busy key is
    then spread over its bins instead of being one key of the join.
    """
    ik = interval_key or key
    span = events.agg(F.min(at).cast("timestamp").alias("lo"), F.max(at).cast("timestamp").alias("hi")).first()
    if span["lo"] is None:
        return interval_join(events, intervals, key, at, start, end, interval_key=interval_key)
    bin_of = lambda c: F.floor(F.unix_timestamp(c.cast("timestamp")) / bin_seconds)
    lo, hi = F.lit(span["lo"]), F.lit(span["hi"])
    first, last = F.greatest(F.col(start), lo), F.least(F.coalesce(F.col(end), hi), hi)
    pieces = (intervals.where((F.col(start) <= hi) & (F.col(end).isNull() | (F.col(end) > lo)) & (F.col(end).isNull() | (F.col(end) > F.col(start))))
              .withColumn("_interval_bin", F.explode(F.sequence(bin_of(first), bin_of(last)))))
    return events.withColumn("_event_bin", bin_of(F.col(at))).join(
        pieces, (F.col(key) == F.col(ik)) & (F.col("_event_bin") == F.col("_interval_bin"))
        & (F.col(at) >= F.col(start)) & (F.col(end).isNull() | (F.col(at) < F.col(end)))).drop("_event_bin", "_interval_bin")
