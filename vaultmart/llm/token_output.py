"""Token-id output as Parquet list columns (operator 10).

Documents are range-partitioned and sorted by id, encoded in that order, and
written by Spark's Parquet writer: one row per document with its ids as a
list column.  Ids are dictionary encoded (a vocabulary fits one dictionary
page, so an id costs its bit width); document ids and offsets, which ascend,
are delta encoded (data page v2, no dictionary).  Row groups and pages are
kept small, and the writer adds column and offset indexes, so a reader that
wants some documents, or only lengths, fetches only those pages.

A part file holds offsets relative to itself; a part's base is the sum of the
parts before it, so no task ever sees more than one part.

Edge cases: null and empty texts give the end id alone; rows with a null id
sort first; equal ids sort by text; extra input columns are ignored.  A table
without rows gives a table without rows.
"""

from __future__ import annotations

import functools
import json
import re
import zlib
from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vaultmart.llm.common import BLOCK_CHARS, Remembered, text_blocks

TOKEN_ENTRIES = 400_000        # encoded pre-tokens a Python worker remembers, twice that with the older generation
WORD_ENTRIES = 50_000          # the same for words of texts that do not split into pre-tokens
CACHED_LENGTH = 48             # longer words are encoded again each time

LETTERS = "a-z\u00df-\u00f6\u00f8-\u00ff"              # lower-case Latin letters that normalisation leaves alone
PUNCTUATION = r"!\"#$%&()*+,\-./:;=>?@\[\\\]^_`{|}~"     # ASCII punctuation but for apostrophe and <

# The parts of a tokenizer file for which texts split as described at WordEncoder.
PLAIN = {
    "normalizer": {"type": "Sequence", "normalizers": [
        {"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]},
    "pre_tokenizer": {"type": "Sequence", "pretokenizers": [
        {"type": "Split", "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"},
         "behavior": "Removed", "invert": True},
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]},
}

WRITER_OPTIONS = {
    "compression": "zstd",
    "parquet.writer.version": "PARQUET_2_0",               # delta encodings where no dictionary is used
    "parquet.enable.dictionary": "true",
    "parquet.enable.dictionary#doc_id": "false",
    "parquet.enable.dictionary#start_in_part": "false",
    "parquet.block.size": str(32 << 20),                   # bytes of a row group
    "parquet.page.size": str(256 << 10),                   # bytes of a data page
    "parquet.page.row.count.limit": "2000",                # rows of a page: what the page index can skip by
}


class WordEncoder:
    """Ids of whole texts from the ids of their words.

    Holds for tokenizers whose normaliser and pre-tokenizer treat white space
    as a separator that yields no id, so a text's ids are its words' ids in a
    row; special strings inside a word are found there as in the text.

    For a tokenizer of the lower-casing kind described by ``PLAIN`` most texts
    split further: where a lower-cased text holds only ASCII and Latin-1
    letters, digits and punctuation without apostrophe or ``<``, its
    pre-tokens are the runs of letters, single digits and runs of punctuation,
    and the library's merges run on those directly.  Ids of pre-tokens and
    words are remembered, bounded, across a worker's tasks.
    """

    def __init__(self, tokenizer_file: str):
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(tokenizer_file)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        probe = "one  two\n three"
        if self._encode(probe) != b"".join(map(self._encode, probe.split())):
            raise ValueError("white space yields ids: texts do not split into words")
        with open(tokenizer_file, encoding="utf-8") as f:
            kind = json.load(f)
        self.plain = {k: kind.get(k) for k in PLAIN} == PLAIN
        self.merges = Tokenizer.from_file(tokenizer_file)
        self.merges.normalizer = normalizers.Sequence([])
        self.merges.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.find, self.split = re.compile("[^ \t\n\r]+").findall, re.compile(f"[{LETTERS}]+|[0-9]|[{PUNCTUATION}]+").findall
        self.odd = re.compile(f"[^ \t\n\r0-9{LETTERS}{PUNCTUATION}]").search
        self.tokens = Remembered(lambda t: self._encode(t, self.merges), TOKEN_ENTRIES, CACHED_LENGTH)
        self.words = Remembered(self._encode, WORD_ENTRIES, CACHED_LENGTH)

    def _encode(self, text: str, tokenizer=None) -> bytes:
        return array("i", (tokenizer or self.tokenizer).encode(text, add_special_tokens=False).ids).tobytes()

    def encode(self, text: str | None) -> bytes:
        """32-bit ids of a whole text, in machine order."""
        if not text:
            return b""
        if self.plain and not self.odd(low := text.lower()):
            return b"".join(map(self.tokens.__getitem__, self.split(low)))
        return b"".join(map(self.words.__getitem__, self.find(text)))


@functools.lru_cache(1)
def word_encoder(tokenizer_file: str) -> WordEncoder:
    return WordEncoder(tokenizer_file)


def write_token_ids(docs: DataFrame, path: str, tokenizer_file: str, end_id: int, id_col: str = "doc_id",
                    text_col: str = "text", options: dict | None = None) -> None:
    """Encode and write; columns ``part, doc_id, start_in_part, n_tokens, ids``."""
    rows = (docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
            .repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
            .withColumn("part", F.spark_partition_id()))
    schema = T.StructType([
        T.StructField("part", T.IntegerType()), rows.schema["doc_id"], T.StructField("start_in_part", T.LongType()),
        T.StructField("n_tokens", T.LongType()), T.StructField("ids", T.ArrayType(T.IntegerType(), False))])

    def encode(batches):
        encoder, at = word_encoder(tokenizer_file), 0
        end = array("i", [end_id]).tobytes()
        for batch in batches:
            for lo, hi, texts in text_blocks(batch.column("text"), 4 * BLOCK_CHARS):
                ids = [encoder.encode(t) + end for t in texts]
                size = np.fromiter((len(b) // 4 for b in ids), np.int64, len(ids))
                ends = at + np.cumsum(size)
                offsets = np.concatenate(([0], ends - at)).astype(np.int32)
                column = pa.ListArray.from_arrays(pa.array(offsets), pa.Array.from_buffers(
                    pa.int32(), int(offsets[-1]), [None, pa.py_buffer(b"".join(ids))]))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("part").slice(lo, hi - lo), batch.column("doc_id").slice(lo, hi - lo),
                     pa.array(ends - size), pa.array(size), column], names=schema.names)
                at = int(ends[-1])

    rows.mapInArrow(encode, schema).write.options(**{**WRITER_OPTIONS, **(options or {})}).parquet(path)


def part_bases(spark: SparkSession, path: str) -> DataFrame:
    """Ids before each part: reads two narrow columns, one row per part file."""
    sums = spark.read.parquet(path).groupBy("part").agg(F.sum("n_tokens").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return sums.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))


def with_starts(spark: SparkSession, rows: DataFrame, path: str) -> DataFrame:
    """Turn ``part, start_in_part`` into ``start``, the ids of all documents before."""
    return (rows.join(part_bases(spark, path), "part").withColumn("start", F.col("base") + F.col("start_in_part"))
            .select("doc_id", "start", *[c for c in rows.columns if c not in ("part", "doc_id", "start_in_part")]))


def read_token_ids(spark: SparkSession, path: str) -> DataFrame:
    """The written documents: ``doc_id, start, n_tokens, ids``."""
    return with_starts(spark, spark.read.parquet(path), path)


def read_digests(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of the written documents; ids are digested where they are read, before any join."""
    return with_starts(spark, with_crc(spark.read.parquet(path)), path)


def with_crc(tokens: DataFrame) -> DataFrame:
    """Replace ``ids`` by ``ids_crc32``, the CRC-32 of the ids as little-endian 32-bit integers."""
    schema = T.StructType([f for f in tokens.schema if f.name != "ids"] + [T.StructField("ids_crc32", T.LongType())])

    def digest(batches):
        for batch in batches:
            ids = batch.column("ids")
            values = ids.flatten().to_numpy(zero_copy_only=False).astype("<u4", copy=False).tobytes()
            size = np.diff(ids.offsets.to_numpy()).astype(np.int64) * 4
            at = np.concatenate(([0], np.cumsum(size)))
            view = memoryview(values)
            crc = pa.array([zlib.crc32(view[a:b]) for a, b in zip(at[:-1].tolist(), at[1:].tolist())], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(n) for n in schema.names[:-1]] + [crc], names=schema.names)

    return tokens.mapInArrow(digest, schema)
