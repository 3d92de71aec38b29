"""Incremental file landing and vault loading as streams.

``land_stream`` discovers new raw files in a folder (file source with an
explicit schema), stamps lineage and appends them to a bronze table.
``vault_stream`` feeds each micro-batch through the registry-driven vault
loaders; the loaders insert new keys only, so a replayed batch appends
nothing and the job is safe to restart from its checkpoint.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vaultmart.plans.build import load_partitioned, load_vault


def land_stream(spark: SparkSession, source_dir: str, schema: T.StructType, target: str, checkpoint: str,
                source: str, fmt: str = "csv", options: dict | None = None, available_now: bool = True):
    reader = spark.readStream.schema(schema).format(fmt)
    for k, v in (options or {"header": "true"}).items():
        reader = reader.option(k, v)
    df = reader.load(source_dir).withColumns({
        "record_source": F.lit(source), "load_dts": F.current_timestamp(),
        "source_file": F.col("_metadata.file_path")})
    w = df.writeStream.format("parquet").option("path", target).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()


def vault_stream(spark: SparkSession, stream: DataFrame, to_bronze: Callable[[DataFrame], dict[str, DataFrame]],
                 root: str, checkpoint: str, names: list[str] | None = None, available_now: bool = True):
    """Every micro-batch -> bronze dict -> vault loaders (append new rows)."""
    def load(batch: DataFrame, batch_id: int) -> None:
        load_vault(spark, root, to_bronze(batch), names=names)

    w = stream.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()


def partitioned_vault_stream(spark: SparkSession, stream: DataFrame, to_bronze: Callable[[DataFrame], dict[str, DataFrame]],
                             root: str, checkpoint: str, names: list[str], prefix_chars: int = 2, available_now: bool = True, key_bytes: bool = False):
    """C9 into partitioned tables: a micro-batch reads the partitions of its keys; one that is already committed is skipped."""
    def load(batch: DataFrame, batch_id: int) -> None:
        load_partitioned(spark, root, to_bronze(batch), names, batch_id=batch_id, prefix_chars=prefix_chars, key_bytes=key_bytes)

    w = stream.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()
