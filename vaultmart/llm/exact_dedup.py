"""Exact de-duplication by deterministic block naming (operator 2).

A normalised text (A-Z lower-cased) is cut into blocks of ``block_bytes``
bytes.  Equal blocks at the same place of texts with the same number of blocks
get the same integer name: the largest row number that holds the block.  Then
adjacent pairs of names are named in the same way, level by level, until one
name is left.  Two texts have the same last name (and number of blocks) exactly
when they are equal: block contents and pairs of names are compared, never
hashes, so no collision is possible.

Everything is a DataFrame operation.  Texts move through two shuffles: one for
the names (combined map-side, so a text that holds a third of all rows is one
row per task before it moves) and one for the occurrences.  Only names of
blocks that occur at least twice are joined back; the join key has one more
column than the grouping key, so Spark exchanges both sides anew and adaptive
execution may split a hot block's occurrences.  Every level is written to the
shared folder, which cuts the lineage.

Edge cases: null counts as the empty text, which is one empty block; of rows
with the same id and text each gets a row and the one with the largest row
number is kept; rows with a null id rank below all others; extra columns are
ignored; no rows give no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vaultmart.llm.common import fold_az

BLOCK_BYTES = 4096


def text_blocks(docs: DataFrame, id_col: str, text_col: str, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``row, id, sha, n_blocks, pos, block`` per block of every normalised text."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    ascii_only = F.length(text) == F.octet_length(text)
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"),
        F.when(ascii_only, F.lower(text)).otherwise(fold_az(text)).cast("binary").alias("bytes"))
    rows = rows.withColumn("n_blocks", F.greatest(F.ceil(F.length("bytes") / block_bytes), F.lit(1)).cast("int"))
    cut = F.transform(F.sequence(F.lit(0), F.col("n_blocks") - 1),
                      lambda i: F.substring(F.col("bytes"), i * block_bytes + 1, F.lit(block_bytes)))
    return rows.select("row", "id", F.sha2("bytes", 256).alias("sha"), "n_blocks", F.posexplode(cut).alias("pos", "block"))


def named(occurrences: DataFrame, keys: list[str]) -> DataFrame:
    """Add ``name`` (largest row with equal ``keys``); a key that occurs once is named by its own row."""
    names = (occurrences.groupBy(*keys).agg(F.max("row").alias("name"), F.count("*").alias("uses"))
             .where("uses > 1").withColumn("again", F.hash(*keys)).drop("uses"))
    return (occurrences.withColumn("again", F.hash(*keys)).join(names, [*keys, "again"], "left")
            .withColumn("name", F.coalesce("name", "row")).drop("again"))


def document_names(docs: DataFrame, stored, id_col: str = "doc_id", text_col: str = "text",
                   block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``row, id, sha, n_blocks, name``: one collision-free name per row."""
    keys = ["n_blocks", "pos"]
    level = stored(named(text_blocks(docs, id_col, text_col, block_bytes), [*keys, "block"]).select(
        "row", "id", "sha", "n_blocks", "pos", "name"), "names-0")
    longest = level.agg(F.max("n_blocks")).first()[0] or 1
    done = level.where("n_blocks = 1").drop("pos")
    length, step = longest, 0
    while length > 1:
        length, step = -(-length // 2), step + 1
        pairs = (level.where(f"n_blocks > {2 ** (step - 1)}")
                 .groupBy("row", "n_blocks", F.shiftright("pos", 1).alias("pos"))
                 .agg(F.max("id").alias("id"), F.max("sha").alias("sha"),
                      F.max(F.when(F.col("pos") % 2 == 0, F.col("name"))).alias("left"),
                      F.coalesce(F.max(F.when(F.col("pos") % 2 == 1, F.col("name"))), F.lit(-1)).alias("right")))
        level = stored(named(pairs, [*keys, "left", "right"]).select("row", "id", "sha", "n_blocks", "pos", "name"), f"names-{step}")
        done = done.unionByName(level.where(f"n_blocks > {2 ** (step - 1)} and n_blocks <= {2 ** step}").drop("pos"))
    return done


def exact_dedup(docs: DataFrame, stored, id_col: str = "doc_id", text_col: str = "text",
                block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per input row: ``id, keep_id, group_size, kept, text_sha256``."""
    rows = document_names(docs, stored, id_col, text_col, block_bytes)
    keys = ["n_blocks", "name"]
    best = F.max(F.struct(F.col("id").isNotNull().alias("known"), "id", "row"))
    groups = (rows.groupBy(*keys).agg(best.alias("best"), F.count("*").alias("uses")).where("uses > 1")
              .select(*keys, F.hash(*keys).alias("again"), "uses", F.col("best.id").alias("keep_id"), F.col("best.row").alias("keep_row")))
    got = rows.withColumn("again", F.hash(*keys)).join(groups, [*keys, "again"], "left")
    return got.select(
        F.col("id").alias(id_col),
        F.when(F.col("uses").isNull(), F.col("id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("uses", F.lit(1)).cast("long").alias("group_size"),
        (F.coalesce("keep_row", "row") == F.col("row")).alias("kept"), F.col("sha").alias("text_sha256"))
