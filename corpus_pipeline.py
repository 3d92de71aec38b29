"""Corpus pipeline: five training-data stages over ``documents``.

quality classifier -> near-duplicates -> benchmark decontamination -> mixing
-> token ids.  Each stage is written as Parquet and reread by the next, so a
lost executor never costs more than the running stage.  Stages decide by the
text of their own input rows and keep all columns; rows that they drop are:

* quality: texts scored below 0.3 by a model fitted on the labelled rows of
  the stage's input;
* near_dedup: all but the smallest id of each group of documents linked by
  five-word shingles at a similarity of 0.8 or more;
* decontamination: documents that hold a 10-word window of a benchmark item;
* mixing: documents the mix does not reach (a document taken twice comes twice;
  texts are whole, so a source ends within half a document of its target).

Null texts score as empty texts, have no shingles or windows, size 0, and so
leave at the mixing stage; rows without id are decided by their text like any
other; repeated rows are one near-duplicate group, of which one stays; ties
are broken by the smallest id; a very long text is one row and is read whole;
extra columns are carried and may have any name; empty inputs pass through
empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vaultmart.llm import decontamination, mixing, near_dedup, quality, token_output
from vaultmart.llm.common import new_path, read_table, stored
from vaultmart.llm.queries import id_remainder, tokenizer_path

MIN_SCORE = 0.3
END_ID = 2


def _store(spark: SparkSession):
    return lambda df, name: stored(spark, df, name)


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labels = (read_table(spark, sf_dir, "labels").where("quality is not null")
              .select(F.col("doc_id").alias("label_id"), F.col("quality").alias("label")))
    held_out = F.coalesce(id_remainder(5) == 0, F.lit(False))
    labelled = docs.where(~held_out).select("doc_id", "text").join(labels, F.col("doc_id") == F.col("label_id"))
    stats = quality.document_statistics(labelled, keep={"label": F.col("label")})
    model = quality.fit(stored(spark, stats, "training"))
    return quality.keep_good(docs, model, MIN_SCORE)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dedup.keep_one(docs, _store(spark), n=5, percent=80)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontamination.keep_clean(docs, read_table(spark, sf_dir, "benchmark"), _store(spark))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    sizes = stored(spark, mixing.word_sizes(docs, "doc_id", "source", "text"), "sizes")
    return mixing.mix(docs, sizes, _store(spark), weights=(5, 2, 1), ratio=1.5, repeat=2.0)


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    path = new_path(spark, "pipeline-ids")
    token_output.write_token_ids(docs, path, tokenizer_path("word_bpe_49k.json"), END_ID)
    return token_output.read_digests(spark, path)


STAGES = [
    ("quality", quality_stage),
    ("near_dedup", near_dedup_stage),
    ("decontamination", decontamination_stage),
    ("mixing", mixing_stage),
    ("token_ids", token_stage),
]

ORACLE_SQL = None              # SQL cannot fit the classifier; tests hold each stage against a brute-force version


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(spark, stage(spark, docs, sf_dir), name)
    return docs
