"""Exactly-once tables written by ``foreachBatch``.

A table is a folder of batches.  Every attempt to write a batch has a folder
of its own; the manifest entry, one line of JSON per batch and part that is
appended last, names it.  Of several entries for one batch and part the last
counts.  Readers see the attempts named by the manifest and nothing else: a
crash between the rows and the entry leaves the old state, a replayed batch
puts its own attempt in the place of the first one.  A batch may consist of
several named parts (one per alert rule, say), each with an entry of its own.
Paths may be on any shared file system that Spark reads.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vaultmart.operators.vault import read_table

ENTRY = "batch_id long, part string, path string, rows long, written_at timestamp"


class CommittedBatches:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def write(self, df: DataFrame, batch_id: int, part: str = "all") -> None:
        """Write one part of a batch and commit it."""
        path = f"{self.root}/data/batch={batch_id}/{part}-{uuid.uuid4().hex}"
        df.write.parquet(path)
        rows = self.spark.read.schema(df.schema).parquet(path).count()
        entry = self.spark.createDataFrame([(int(batch_id), part, path, rows)], "batch_id long, part string, path string, rows long")
        entry.withColumn("written_at", F.current_timestamp()).coalesce(1).write.mode("append").json(f"{self.root}/manifest")

    def manifest(self) -> DataFrame:
        """The entry that counts for every (batch, part): the last one written."""
        try:
            entries = self.spark.read.schema(ENTRY).json(f"{self.root}/manifest")
        except Exception as e:  # no batch was committed yet
            if getattr(e, "getCondition", lambda: "")() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], ENTRY)
        last = Window.partitionBy("batch_id", "part").orderBy(F.desc("written_at"), F.desc("path"))
        return entries.withColumn("_n", F.row_number().over(last)).where("_n = 1").drop("_n")

    def _read(self, entries: list) -> DataFrame | None:
        frames = [read_table(self.spark, e["path"]) for e in entries if e["rows"]] or [read_table(self.spark, e["path"]) for e in entries[:1]]
        return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames) if frames else None

    def last_before(self, batch_id: int) -> int | None:
        return self.manifest().where(F.col("batch_id") < batch_id).agg(F.max("batch_id")).first()[0]

    def batch(self, batch_id: int | None) -> DataFrame | None:
        """The committed rows of one batch (one entry per part reaches the driver)."""
        return None if batch_id is None else self._read(self.manifest().where(F.col("batch_id") == batch_id).collect())

    def table(self) -> DataFrame | None:
        """All committed rows; None where nothing was committed.  One entry per batch and part reaches the driver."""
        entries = self.manifest().orderBy("batch_id", "part").collect()
        paths = [e["path"] for e in entries if e["rows"]]
        return self.spark.read.option("mergeSchema", True).parquet(*paths) if paths else self._read(entries)
