"""Event logs whose schema grows (I1 with an additive schema).

Producers may add fields at any time.  The fields that a table knows are kept
in a schema log, one line of JSON per field with the version that added it.
Lines are parsed by the log's newest version; whatever it does not cover goes
to the map ``rescued``: fields it does not know, and values that do not fit
their field's type.  A line that is no JSON object is kept in ``unparsed``.
Nothing of a line is lost, and a producer's new field never stops the stream.

``adopt`` adds fields to the log as a new version; files written before keep
their map.  ``read_events`` presents files of all versions as one table of the
newest schema: a field that a file has only in its map is cast from there.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

LOG = "version int, position int, name string, type string"
RESCUED, UNPARSED, VERSION = "rescued", "unparsed", "schema_version"


class SchemaLog:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def fields(self) -> list:
        """(version, position, name, type) of every known field, in order of adoption (one row per field)."""
        try:
            return self.spark.read.schema(LOG).json(self.path).orderBy("version", "position").collect()
        except Exception as e:
            if getattr(e, "getCondition", lambda: "")() != "PATH_NOT_FOUND":
                raise
            return []

    def version(self) -> int:
        return max((f["version"] for f in self.fields()), default=0)

    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(f["name"], T._parse_datatype_string(f["type"])) for f in self.fields()])

    def adopt(self, schema: T.StructType) -> int:
        """Add the fields not yet known as a new version (none: the version stays); a known field keeps its type."""
        known, at = {f["name"] for f in self.fields()}, self.version() + 1
        new = [(at, i, f.name, f.dataType.simpleString()) for i, f in enumerate(schema) if f.name not in known]
        if not new:
            return at - 1
        self.spark.createDataFrame(new, LOG).coalesce(1).write.mode("append").json(self.path)
        return at


def _entries(rescued: Column, keep) -> Column:
    kept = F.map_filter(rescued, keep)
    return F.when(F.size(kept) > 0, kept)


def parse_events(lines: DataFrame, schema: T.StructType, version: int, value: str = "value") -> DataFrame:
    """Lines of JSON as columns of ``schema`` with ``rescued``, ``unparsed`` and ``schema_version``."""
    whole = lines.select(F.col(value).alias("_line"), F.from_json(value, schema).alias("_typed"),
                         F.from_json(value, T.MapType(T.StringType(), T.StringType())).alias("_raw"))
    # a known field is rescued too where its value did not fit the type
    unfit = F.array_compact(F.array(*[F.when(F.col("_typed").getField(f.name).isNull(), F.lit(f.name)) for f in schema]))
    rescued = _entries(F.col("_raw"), lambda k, v: v.isNotNull() & (~k.isin(*schema.names) | F.array_contains(unfit, k)))
    return whole.select(*[F.col("_typed").getField(f.name).alias(f.name) for f in schema], rescued.alias(RESCUED),
                        F.when(F.col("_raw").isNull(), F.col("_line")).alias(UNPARSED), F.lit(version).alias(VERSION))


def land_events(spark: SparkSession, source_dir: str, log: SchemaLog, target: str, checkpoint: str, available_now: bool = True):
    """Stream of new files of JSON lines into the table at ``target``, parsed by the log's version at the start of each batch."""
    from vaultmart.streaming.committed import CommittedBatches

    table = CommittedBatches(spark, target)

    def land(batch: DataFrame, batch_id: int) -> None:
        table.write(parse_events(batch, log.schema(), log.version()), batch_id)

    w = spark.readStream.text(source_dir).writeStream.foreachBatch(land).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()


def unknown_fields(table: DataFrame) -> list[str]:
    """Names found only in the map (a producer's vocabulary: one row per name)."""
    names = table.select(F.explode(F.map_keys(RESCUED)).alias("name")).distinct()
    return sorted(r["name"] for r in names.collect() if r["name"] not in table.columns)


def read_events(table: DataFrame, log: SchemaLog) -> DataFrame:
    """Files of all versions as one table of the log's newest schema."""
    schema = log.schema()
    columns = []
    for f in schema:
        old = F.col(RESCUED)[f.name].try_cast(f.dataType)
        columns.append((F.coalesce(F.col(f"`{f.name}`"), old) if f.name in table.columns else old).alias(f.name))
    # what a column now shows leaves the map; a value that fits no type stays
    shown = [F.when(F.col(RESCUED)[f.name].try_cast(f.dataType).isNotNull(), F.lit(f.name)) for f in schema]
    rest = _entries(F.col(RESCUED), lambda k, v: ~F.array_contains(F.array_compact(F.array(*shown)), k))
    return table.select(*columns, rest.alias(RESCUED), UNPARSED, VERSION)
