"""Vault loaders: hubs, links, satellites, transactional links.

Each ``new_*_rows`` function is a pure DataFrame -> DataFrame operator:
given the staged batch and (optionally) the current target table it
returns exactly the rows to append.  ``load_*`` wrap them with an
append to a Parquet folder.  Parquet has no MERGE, so "insert new only"
is an anti-join followed by an append; re-running a batch appends
nothing (idempotent), which is what makes a retried job safe.

Scale notes
-----------
* "Earliest row per key" is a grouped ``min_by`` over a struct, not a
  window: Spark aggregates it map-side first, so a key holding a third
  of all rows is combined before the shuffle instead of landing whole
  in one task.
* The satellite change detection needs "previous row per key".  Rows that
  share a load stamp are combined map-side first, so a key then holds at most
  one row per load stamp, and a ``lag`` per key follows: two shuffles, and
  the history is left grouped by key, so the current rows need no third.
  For keys of very many load stamps ``bucket_seconds`` splits a key into
  (key, time-bucket) partitions; the lag inside a bucket is completed by the
  last hashdiff of the preceding bucket, which the first version of a bucket
  finds among the key's buckets (one more shuffle; no row is joined back).
* Staged rows that were gathered by the home of their key (``hashing.home``)
  are loaded where they are: keys are grouped with their home, of which every
  key has one, and the new rows carry it for joins in place.  Grouped by the
  home first, they stay sorted by it: a table sorts its rows once.
* Readers that need some columns only (``columns``) get the same rows without
  the others.  The least row is found on the columns up to the last one
  wanted: the least prefix is the prefix of the least row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vaultmart.functions.hashing import HOME, JOIN_HOME

LOAD_DTS = "load_dts"
RECORD_SOURCE = "record_source"


def _wanted(columns: Sequence[str] | None, names: Sequence[str]) -> list[str]:
    return [c for c in names if columns is None or c in columns]


def _home(df: DataFrame) -> list[str]:
    return [HOME] if HOME in df.columns else []


def _up_to_last_wanted(order: Sequence[str], columns: Sequence[str] | None) -> list[str]:
    """``order`` without the columns behind the last wanted one (they only break ties among equal prefixes)."""
    return list(order[:max((i for i, c in enumerate(order) if columns is None or c in columns), default=0) + 1])


def _earliest_per_key(df: DataFrame, pk: str, carry: Sequence[str], columns: Sequence[str] | None = None) -> DataFrame:
    """One row per ``pk``: the earliest by (load_dts, record_source, carry...)."""
    order = _up_to_last_wanted([LOAD_DTS, RECORD_SOURCE] + [c for c in carry if c not in (LOAD_DTS, RECORD_SOURCE)], columns)
    order += [c for c in (JOIN_HOME,) if c in df.columns]          # goes with a foreign key: breaks no tie
    # the ordering struct is the row: a plain min carries it once, min_by would shuffle it twice
    picked = df.groupBy(*_home(df), pk).agg(F.min(F.struct(*order)).alias("_r"))
    return picked.select(pk, *_home(df), *[F.col(f"_r.{c}").alias(c) for c in order])


def _not_in_target(new: DataFrame, target: DataFrame | None, pk: str) -> DataFrame:
    if target is None:
        return new
    return new.join(target.select(pk), on=pk, how="left_anti")


def new_hub_rows(staged: DataFrame, pk: str, bk: Sequence[str] | str,
                 target: DataFrame | None = None, columns: Sequence[str] | None = None) -> DataFrame:
    """C4: business keys not yet in the hub."""
    bks = [bk] if isinstance(bk, str) else list(bk)
    src = staged.select(pk, *bks, LOAD_DTS, RECORD_SOURCE, *_home(staged)).where(F.col(pk).isNotNull())
    out = _earliest_per_key(src, pk, bks, columns)
    return _not_in_target(out, target, pk).select(pk, *_wanted(columns, [*bks, LOAD_DTS, RECORD_SOURCE]), *_home(out))


def new_link_rows(staged: DataFrame, pk: str, fks: Sequence[str],
                  target: DataFrame | None = None, columns: Sequence[str] | None = None) -> DataFrame:
    """Relationships not yet in the link; every foreign key must be present."""
    cond = F.col(pk).isNotNull()
    for fk in fks:
        cond = cond & F.col(fk).isNotNull()
    src = staged.select(pk, *fks, LOAD_DTS, RECORD_SOURCE, *_home(staged)).where(cond)
    out = _earliest_per_key(src, pk, fks, columns)
    return _not_in_target(out, target, pk).select(pk, *_wanted(columns, [*fks, LOAD_DTS, RECORD_SOURCE]), *_home(out))


def new_tlink_rows(staged: DataFrame, pk: str, fks: Sequence[str], payload: Sequence[str],
                   effective: str = "effective_from",
                   target: DataFrame | None = None, columns: Sequence[str] | None = None) -> DataFrame:
    """Immutable events, appended once per event key."""
    cond = F.col(pk).isNotNull()
    for fk in fks:
        cond = cond & F.col(fk).isNotNull()
    carry = list(fks) + list(payload) + [effective]
    homes = [c for c in (HOME, JOIN_HOME) if c in staged.columns]
    src = staged.select(pk, *carry, LOAD_DTS, RECORD_SOURCE, *homes).where(cond)
    out = _earliest_per_key(src, pk, carry, columns)
    # events are joined on a foreign key: its home goes on in place of the event's own
    out = _not_in_target(out, target, pk)
    return out.select(pk, *_wanted(columns, [*carry, LOAD_DTS, RECORD_SOURCE]), *[F.col(c).alias(HOME) for c in homes[-1:]])


def current_satellite(sat: DataFrame, pk: str, hashdiff_col: str | None = None) -> DataFrame:
    """The latest version per key (ties on load_dts broken by hashdiff).

    A grouped ``max`` over a struct led by ``load_dts``: partial
    aggregation, no window, skew-safe.
    """
    rest = [c for c in sat.columns if c not in (pk, LOAD_DTS, HOME)]
    if hashdiff_col and hashdiff_col in rest:
        rest = [hashdiff_col] + [c for c in rest if c != hashdiff_col]
    picked = sat.groupBy(*_home(sat), pk).agg(F.max(F.struct(LOAD_DTS, *rest)).alias("_r"))
    return picked.select(pk, *_home(sat), *[F.col(f"_r.{c}").alias(c) for c in [LOAD_DTS] + rest]).select(*sat.columns)


def new_satellite_rows(staged: DataFrame, pk: str, hashdiff_col: str, payload: Sequence[str],
                       target: DataFrame | None = None,
                       bucket_seconds: int | None = None, columns: Sequence[str] | None = None) -> DataFrame:
    """Insert a version only when the attributes changed.

    * rows are ordered per key by ``load_dts``; one row per (key, load_dts)
      survives (smallest hashdiff, so the choice is deterministic);
    * a row equal to its predecessor is dropped; the first row of the
      batch is compared with the target's current row;
    * rows not newer than the target's current row are ignored;
    * A -> B -> A therefore yields three versions.
    """
    at = _home(staged)
    cols = [pk, hashdiff_col, *_wanted(columns, payload), LOAD_DTS, *_wanted(columns, [RECORD_SOURCE]), *at]
    one = (staged.select(pk, hashdiff_col, *payload, LOAD_DTS, RECORD_SOURCE, *at)
                 .where(F.col(pk).isNotNull() & F.col(LOAD_DTS).isNotNull()))
    if target is not None:
        cur = (target.groupBy(pk)
                     .agg(F.max(F.struct(LOAD_DTS, hashdiff_col)).alias("_c"))
                     .select(pk, F.col(f"_c.{LOAD_DTS}").alias("_cur_ts"),
                             F.col(f"_c.{hashdiff_col}").alias("_cur_hd")))
        one = (one.join(cur, on=pk, how="left")
                  .where(F.col("_cur_ts").isNull() | (F.col(LOAD_DTS) > F.col("_cur_ts"))))

    # The least row of every (key, load_dts) in (hashdiff, record_source, payload)
    # order is that instant's version.  Grouped, so rows of one instant (a batch
    # stamp shared by a key's rows) combine map-side.
    split = [] if bucket_seconds is None else ["_b"]
    if split:
        one = one.withColumn("_b", F.floor(F.unix_timestamp(F.col(LOAD_DTS).cast("timestamp")) / bucket_seconds))
    version = F.struct(*_up_to_last_wanted([hashdiff_col, RECORD_SOURCE, *payload], columns))
    current = [] if target is None else [F.first("_cur_hd").alias("_cur_hd")]         # one value per key
    one = (one.groupBy(*at, pk, *split, LOAD_DTS).agg(F.min(version).alias("_v"), *current)
              .select(pk, *at, *split, LOAD_DTS, "_v.*", *(["_cur_hd"] if current else [])))
    current = [F.col("_cur_hd")] if current else []

    def changes(df: DataFrame) -> DataFrame:
        return df.where(F.col("_prev").isNull() | (F.col("_prev") != F.col(hashdiff_col))).select(*cols)
    if not split:
        before = F.lag(hashdiff_col).over(Window.partitionBy(*at, pk).orderBy(LOAD_DTS))
        return changes(one.withColumn("_prev", F.coalesce(before, *current)))

    in_bucket = Window.partitionBy(*at, pk, "_b").orderBy(LOAD_DTS)
    whole_bucket = in_bucket.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    one = one.select("*", F.lag(hashdiff_col).over(in_bucket).alias("_prev"), F.lag(LOAD_DTS).over(in_bucket).isNull().alias("_first"),
                     F.last(hashdiff_col).over(whole_bucket).alias("_last"))

    # A bucket's first version follows the last of the preceding bucket, or the
    # target's row.  Only first versions, one row per (key, bucket), move on to
    # the key's other buckets; the versions inside a bucket are decided in place.
    before = F.lag("_last").over(Window.partitionBy(*at, pk).orderBy("_b"))
    first = one.where("_first").withColumn("_prev", F.coalesce(before, *current))
    inside = one.where(~F.col("_first")).withColumn("_prev", F.coalesce("_prev", "_last", *current))
    return changes(first.unionByName(inside))


# ---------------------------------------------------------------------------
# persistence: append-only Parquet tables
# ---------------------------------------------------------------------------

def read_table(spark: SparkSession, path: str) -> DataFrame | None:
    """The table, or None where no batch has written it yet; any other failure is raised."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def append(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def load_hub(spark: SparkSession, path: str, staged: DataFrame, pk: str, bk) -> DataFrame:
    rows = new_hub_rows(staged, pk, bk, read_table(spark, path))
    append(rows, path)
    return spark.read.parquet(path)


def load_link(spark: SparkSession, path: str, staged: DataFrame, pk: str, fks) -> DataFrame:
    rows = new_link_rows(staged, pk, fks, read_table(spark, path))
    append(rows, path)
    return spark.read.parquet(path)


def load_tlink(spark: SparkSession, path: str, staged: DataFrame, pk: str, fks, payload,
               effective: str = "effective_from") -> DataFrame:
    rows = new_tlink_rows(staged, pk, fks, payload, effective, read_table(spark, path))
    append(rows, path)
    return spark.read.parquet(path)


def load_satellite(spark: SparkSession, path: str, staged: DataFrame, pk: str, hashdiff_col: str,
                   payload) -> DataFrame:
    rows = new_satellite_rows(staged, pk, hashdiff_col, payload, read_table(spark, path))
    append(rows, path)
    return spark.read.parquet(path)
