"""Source mixing by a time-varying curriculum (operator 5).

Every source has a weight schedule over training time 0..1 (piecewise linear
between knots).  Its integral, scaled to the source's target, is the
cumulative token demand D(t); a document's copy whose tokens start at offset
c of its source's shuffled order is trained at position t = D^-1(c).
Documents are range-sorted by position.

Targets share ``ratio`` x all words by source weight; no target exceeds
``repeat`` x its source, and the excess is shared again by weight until none
does (closed form: sources ordered by size / weight fill up in that order).
The digest counts words up to the one at which the target is reached, so a
source's taken words equal its target rounded to a word.  The mixed corpus
holds whole texts only: the copy in which the target falls is taken whole or
not at all, whichever ends nearer the target.  No document is taken more than
``repeat`` times.

Cumulative words are two-level prefix sums: documents fall into hash buckets
of a source (a number that follows the row count), buckets are summed before
the shuffle, and running sums are taken over the buckets of a source and over
the documents of one bucket.  A source that holds a third of all rows is
spread over that many buckets.  Sources (a configuration-sized list: one row
each) are ranked in one task.

Edge cases: null or empty texts have size 0 and take 0 words; a null source is
a source of its own and ranks last; repeated rows and ids each count; sources
without words have target 0; no rows give no rows.  Extra input columns are
kept by ``mix`` and may clash with nothing: internal columns carry a prefix.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

BUCKET_ROWS = 4096             # documents a bucket is expected to hold


def word_sizes(docs: DataFrame, id_col: str, source_col: str, text_col: str) -> DataFrame:
    """``id, source, key, size`` per row: words of the whole text (maximal runs
    outside space and \\x09-\\x0D), counted on the UTF-8 bytes; ``key`` orders a source."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"), F.col(text_col).alias("text"),
                       F.xxhash64(F.col(id_col), F.xxhash64(text_col)).alias("key"))
    schema = T.StructType([rows.schema["id"], rows.schema["source"], rows.schema["key"], T.StructField("size", T.LongType())])

    def count(batches):
        for batch in batches:
            text = batch.column("text").cast(pa.large_string())
            _, where, data = text.buffers()
            at = np.frombuffer(where, np.int64)[text.offset:text.offset + len(text) + 1]
            raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
            sizes, lo = np.zeros(len(text), np.int64), 0
            while lo < len(text):
                hi = max(lo + 1, int(np.searchsorted(at, at[lo] + (4 << 20))))
                hi = min(hi, len(text))
                part, cuts = raw[at[lo]:at[hi]], at[lo:hi + 1] - at[lo]
                inside = (part != 32) & ((part < 9) | (part > 13))
                first = inside.copy()
                first[1:] &= ~inside[:-1]
                opens = cuts[:-1][cuts[:-1] < len(part)]
                first[opens] = inside[opens]                     # a word also starts where its text starts
                sizes[lo:hi] = np.diff(np.searchsorted(np.flatnonzero(first), cuts))
                lo = hi
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("source"), batch.column("key"),
                                              pa.array(sizes)], names=schema.names)

    return rows.mapInArrow(count, schema)


def source_targets(sizes: DataFrame, weights=(5, 2, 1), ratio: float = 1.5, repeat: float = 2.0) -> DataFrame:
    """``source, rank, source_size, weight, target`` per source, from rows (or bucket sums) with ``source, size``."""
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    fill = Window.orderBy(F.col("source_size") / F.col("weight"), F.col("source").asc_nulls_last())
    whole = Window.partitionBy()
    full = repeat * F.col("source_size")
    return (per.withColumn("rank", rank).withColumn("weight", weight)
            # the sources before this one are full; what is left is shared by the weights from here on
            .withColumn("_left", ratio * F.sum("source_size").over(whole) - repeat * F.coalesce(
                F.sum("source_size").over(fill.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
            .withColumn("_weights", F.sum("weight").over(fill.rowsBetween(0, Window.unboundedFollowing)))
            .withColumn("_free", full > F.col("_left") * F.col("weight") / F.col("_weights"))
            .withColumn("_at", F.min(F.when(F.col("_free"), F.struct(F.col("source_size") / F.col("weight"), "_left", "_weights")))
                        .over(whole))
            .withColumn("target", F.when(F.col("_at").isNull(), full).otherwise(
                F.least(full, F.col("_at._left") * F.col("weight") / F.col("_at._weights"))))
            .select("source", "rank", "source_size", "weight", F.coalesce("target", F.lit(0.0)).alias("target")))


def schedule_position(share: Column, rank: Column, schedules) -> Column:
    """Training time at which a share of a source's demand is reached.

    ``schedules`` holds, per source in turn, the weights at equally spaced
    knots of time 0..1.  The integral of each linear piece is a quadratic; its
    inverse is the usual stable root.
    """
    out = None
    for i, knots in enumerate(schedules):
        w = np.asarray(knots, float)
        step = 1.0 / (len(w) - 1)
        area = (w[1:] + w[:-1]) / 2 * step
        w, area = w / area.sum(), area / area.sum()
        done = np.concatenate(([0.0], np.cumsum(area)))
        at = None
        for j in range(len(area)):
            rest = F.greatest(share - float(done[j]), F.lit(0.0))
            slope = float((w[j + 1] - w[j]) / step)
            root = 2 * rest / (float(w[j]) + F.sqrt(F.greatest(float(w[j]) ** 2 + 2 * slope * rest, F.lit(0.0))))
            piece = F.when(rest > 0, F.least(j * step + root, F.lit((j + 1) * step))).otherwise(j * step)
            at = piece if at is None else F.when(share >= float(done[j]), piece).otherwise(at)
        out = at if out is None else F.when(rank % len(schedules) == i, at).otherwise(out)
    return out


DEFAULT_SCHEDULES = ((1.0, 1.0, 1.0), (2.0, 1.0, 0.5), (0.5, 1.0, 2.0))   # constant, falling, rising


def curriculum(sizes: DataFrame, stored, weights=(5, 2, 1), ratio: float = 1.5, repeat: float = 2.0,
               schedules=DEFAULT_SCHEDULES, whole: bool = False) -> DataFrame:
    """Per input row: ``id, key, size, source, source_size, target, taken,
    copies`` (training position and words of each taken copy, ascending).
    The copy in which a source's target falls counts up to the target; with
    ``whole`` it is taken whole or not at all, whichever ends nearer the target
    (whole where both are as near).
    ``sizes`` should be stored: it is read for the row count, the bucket sums and the rows."""
    n = sizes.count()
    buckets = max(1, math.ceil(n / BUCKET_ROWS))
    rows = sizes.withColumn("bucket", F.pmod(F.col("key"), F.lit(buckets)).cast("int"))
    in_bucket = Window.partitionBy("source", "bucket").orderBy("key", "id").rowsBetween(Window.unboundedPreceding, -1)
    before = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = stored(rows.groupBy("source", "bucket").agg(F.sum("size").alias("size")), "bucket-sums")
    targets = stored(source_targets(sums, weights, ratio, repeat), "targets")
    bases = (sums.withColumn("base", F.coalesce(F.sum("size").over(before), F.lit(0))).withColumnRenamed("source", "s")
             .join(targets, F.col("s").eqNullSafe(F.col("source")))
             .select(F.col("s").alias("b_source"), F.col("bucket").alias("b_bucket"), "base", "source_size", "target", "rank"))
    bases = stored(bases, "bases")
    placed = (rows.withColumn("_in", F.coalesce(F.sum("size").over(in_bucket), F.lit(0)))
              .join(bases, F.col("source").eqNullSafe(F.col("b_source")) & (F.col("bucket") == F.col("b_bucket")))
              .withColumn("_from", F.col("base") + F.col("_in")))
    copies = []
    for e in range(math.ceil(repeat)):
        start = F.col("_from") + e * F.col("source_size")
        words = F.least(F.col("size"), F.round("target").cast("long") - start)
        if whole:
            words = F.when(2 * (F.col("target") - start) >= F.col("size"), F.col("size"))
        at = schedule_position(F.least(start / F.col("target"), F.lit(1.0)), F.col("rank"), schedules)
        copies.append(F.when(words > 0, F.struct(at.alias("position"), words.alias("words"))))
    return (placed.withColumn("copies", F.array_compact(F.array(*copies)))
            .withColumn("taken", F.aggregate("copies", F.lit(0).cast("long"), lambda n, c: n + c["words"]))
            .select("id", "key", "size", "source", "source_size", "target", "taken", "copies"))


def mix_digest(sizes: DataFrame, stored, **options) -> DataFrame:
    """One row per document, range-sorted by first training position (rows that are not taken come last)."""
    first = F.try_element_at("copies", F.lit(1))["position"]
    order = F.coalesce("first_position", F.lit(2.0))
    return (curriculum(sizes, stored, **options)
            .select(F.col("id").alias("doc_id"), "size", "source_size", "target", "taken",
                    first.alias("first_position"), F.size("copies").alias("n_copies"))
            .repartitionByRange(order, "doc_id").sortWithinPartitions(order, "doc_id"))


def mix(docs: DataFrame, sizes: DataFrame, stored, id_col: str = "doc_id", text_col: str = "text",
        source_col: str = "source", **options) -> DataFrame:
    """The mixed corpus: every taken copy of every row, whole, with all input
    columns and no others, range-sorted by training position.  A source's words
    miss its target by at most half of one document.  Rows that repeat an id,
    text and source are numbered, and each takes the copies of one of the
    places that they hold in the source's order."""
    place = curriculum(sizes, stored, whole=True, **options).where(F.size("copies") > 0).groupBy(
        F.col("key").alias("_mix_key"), F.struct("id", "source").alias("_mix_owner")).agg(
        F.sort_array(F.collect_list("copies")).alias("_mix_places"))
    key = F.xxhash64(F.col(id_col), F.xxhash64(text_col))
    # a struct's null fields equal each other, so the join and the numbering share one exchange
    at = F.struct(F.col(id_col).alias("id"), F.col(source_col).alias("source"))
    on = (F.col("_mix_row") == F.col("_mix_key")) & (F.col("_mix_at") == F.col("_mix_owner"))
    others = [f.name for f in docs.schema if f.name != text_col and not isinstance(f.dataType, T.MapType)]
    repeat = F.row_number().over(Window.partitionBy("_mix_row", "_mix_at").orderBy(
        F.xxhash64(*[F.col(f"`{c}`") for c in others])))
    return (docs.withColumn("_mix_row", key).withColumn("_mix_at", at).join(place, on)
            .withColumn("_mix_copies", F.get("_mix_places", repeat - 1))
            .withColumn("_mix_copy", F.explode("_mix_copies"))
            .repartitionByRange("_mix_copy.position", "_mix_row").sortWithinPartitions("_mix_copy.position", "_mix_row")
            .select(*docs.columns))
