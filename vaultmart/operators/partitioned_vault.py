"""Vault tables that an incremental load need not read in full.

A table is a folder of loads, partitioned by the first ``prefix_chars``
characters of the hash key.  Keys are hashes, so partitions are even and no
key is hot.  A manifest lists what belongs to the table: one line of JSON per
folder and version, appended as one file that commits the whole load.  A load
that dies before leaves folders that nobody reads; readers of a version see
whole loads only.  One writer at a time.

* Hubs, links and transactional links (C4, C5, C7): the batch's earliest row
  per key is written once; its distinct prefixes (at most 16 ** prefix_chars)
  select the target's partitions, and of those only keys that the batch holds
  are read on (a left semi join, in front of which Spark sets a Bloom filter
  of the batch's keys when the target is large); what is not found is new.
* Satellites (C6): a snapshot holds the current version of every key.  A load
  compares with the snapshot's touched partitions, appends new versions to the
  history, which it does not read, and rewrites the touched partitions of the
  snapshot.  Both become visible in one commit.
* The current satellite row (C8) is the snapshot: no window, no history.

New versions are written into the history at once and read from there for the snapshot; what a load stores besides
is deleted when it is committed, and what its jobs shuffled when they end.

Rows without a key are not loaded, as in the plain loaders.  A batch id that is
already committed is skipped, so a replayed micro-batch does nothing.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vaultmart.functions.hashing import as_text
from vaultmart.operators import vault as V
from vaultmart.session import materialized, shuffles_dropped

PREFIX = "key_prefix"
ENTRY = f"version long, batch_id long, area string, {PREFIX} string, path string"
HISTORY, CURRENT, EMPTY = "history", "current", ""


class PartitionedTable:
    """Storage: history folders, an optional snapshot by partition, and the manifest."""

    def __init__(self, spark: SparkSession, root: str, pk: str, prefix_chars: int = 2):
        self.spark, self.root, self.pk, self.prefix_chars = spark, root.rstrip("/"), pk, prefix_chars

    def manifest(self) -> list:
        """Entries in order of their version; one per load, and one per rewritten partition of the snapshot."""
        try:
            return self.spark.read.schema(ENTRY).json(f"{self.root}/manifest").orderBy("version").collect()
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return []

    def version(self, entries=None) -> int:
        return max((e["version"] for e in (self.manifest() if entries is None else entries)), default=0)

    def has_batch(self, batch_id: int | None) -> bool:
        return batch_id is not None and any(e["batch_id"] == batch_id for e in self.manifest())

    def history(self, prefixes: Sequence[str] | None = None, version: int | None = None) -> DataFrame | None:
        """All committed rows, or those of some partitions (a partition filter: no other file is listed in the scan)."""
        paths = [e["path"] for e in self.manifest() if e["area"] == HISTORY and (version is None or e["version"] <= version)]
        if not paths:
            return None
        rows = self.spark.read.option("basePath", f"{self.root}/{HISTORY}").option("mergeSchema", True).parquet(*paths)
        return (rows if prefixes is None else rows.where(F.col(PREFIX).isin(*prefixes))).drop("load")

    def current(self, prefixes: Sequence[str] | None = None, version: int | None = None) -> DataFrame | None:
        """The current version of every key: the snapshot's partitions as last rewritten."""
        last = {}
        for e in self.manifest():
            if e["area"] == CURRENT and (version is None or e["version"] <= version):
                last[e[PREFIX]] = e["path"]
        paths = sorted(p for k, p in last.items() if prefixes is None or k in set(prefixes))
        return self.spark.read.parquet(*paths) if paths else None

    def prefix(self, rows: DataFrame) -> Column:
        """The first characters of the key as text, whichever form ``rows`` hold it in."""
        return F.substring(as_text(self.pk, rows), 1, self.prefix_chars)

    def prefixes(self, rows: DataFrame) -> list[str]:
        return sorted(r[0] for r in rows.select(self.prefix(rows)).distinct().collect())

    def write(self, rows: DataFrame, area: str) -> str:
        """Rows as a folder of their own, one file per partition and task; part of the table only once committed."""
        path = f"{self.root}/{area}/load={uuid.uuid4().hex}"
        # names such as '00' must stay text, so the folder name carries a letter
        named = rows.withColumn(PREFIX, F.concat(F.lit("k"), self.prefix(rows)))
        with shuffles_dropped(rows.sparkSession):
            named.repartition(PREFIX).write.partitionBy(PREFIX).option("compression", "zstd").parquet(path)
        return path

    def commit(self, entries: list[tuple], batch_id: int | None) -> None:
        """(area, prefix, path) entries as the next version, all in one file."""
        n = self.version() + 1
        rows = [(n, batch_id, *e) for e in entries] or [(n, batch_id, EMPTY, None, None)]
        self.spark.createDataFrame(rows, ENTRY).coalesce(1).write.mode("append").json(f"{self.root}/manifest")


class KeyedTable(PartitionedTable):
    """A hub, link or transactional link."""

    def __init__(self, spark, root, pk, earliest, prefix_chars: int = 2):
        super().__init__(spark, root, pk, prefix_chars)
        self.earliest = earliest                       # staged batch -> earliest row per key (the plain loaders' rule)

    def unseen(self, rows: DataFrame, prefixes: list[str]) -> DataFrame:
        target = self.history([f"k{p}" for p in prefixes])
        if target is None:
            return rows
        own = rows.where(self.prefix(rows).isin(*prefixes)).select(self.pk)
        seen = target.select(self.pk).join(own, self.pk, "left_semi")
        return rows.join(seen, self.pk, "left_anti")

    def load(self, staged: DataFrame, batch_id: int | None = None) -> None:
        if self.has_batch(batch_id):
            return
        with materialized(self.spark, self.earliest(staged), "earliest") as rows:
            prefixes = self.prefixes(rows)
            entries = [(HISTORY, None, self.write(self.unseen(rows, prefixes), HISTORY))] if prefixes else []
        self.commit([e for e in entries if V.read_table(self.spark, e[2]) is not None], batch_id)

    def table(self) -> DataFrame | None:
        rows = self.history()
        return None if rows is None else rows.drop(PREFIX)


class SatelliteTable(PartitionedTable):
    """A satellite with its history and the snapshot of current versions."""

    def __init__(self, spark, root, pk, hashdiff: str, payload: Sequence[str], prefix_chars: int = 2):
        super().__init__(spark, root, pk, prefix_chars)
        self.hashdiff, self.payload = hashdiff, list(payload)

    def load(self, staged: DataFrame, batch_id: int | None = None) -> None:
        if self.has_batch(batch_id):
            return
        with materialized(self.spark, staged.where(F.col(self.pk).isNotNull()), "staged") as rows:
            before = self.current([f"k{p}" for p in self.prefixes(rows)])
            versions = V.new_satellite_rows(rows, self.pk, self.hashdiff, self.payload, before)
            history = self.write(versions, HISTORY)
        new = V.read_table(self.spark, history)
        if new is None:                                  # nothing new: a folder without files belongs to no table
            return self.commit([], batch_id)
        new = new.select(*versions.columns)
        touched = self.prefixes(new)
        old = self.current([f"k{p}" for p in touched])
        now = V.current_satellite(new if old is None else new.unionByName(old.select(*new.columns)), self.pk, self.hashdiff)
        snapshot = self.write(now, CURRENT)
        self.commit([(HISTORY, None, history), *[(CURRENT, f"k{p}", f"{snapshot}/{PREFIX}=k{p}") for p in touched]], batch_id)

    def table(self) -> DataFrame | None:
        rows = self.history()
        return None if rows is None else rows.drop(PREFIX)


def hub_table(spark: SparkSession, root: str, pk: str, bk, prefix_chars: int = 2) -> KeyedTable:
    return KeyedTable(spark, root, pk, lambda staged: V.new_hub_rows(staged, pk, bk), prefix_chars)


def link_table(spark: SparkSession, root: str, pk: str, fks, prefix_chars: int = 2) -> KeyedTable:
    return KeyedTable(spark, root, pk, lambda staged: V.new_link_rows(staged, pk, fks), prefix_chars)


def tlink_table(spark: SparkSession, root: str, pk: str, fks, payload, effective: str = "effective_from", prefix_chars: int = 2) -> KeyedTable:
    return KeyedTable(spark, root, pk, lambda staged: V.new_tlink_rows(staged, pk, fks, payload, effective), prefix_chars)
