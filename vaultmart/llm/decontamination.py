"""Benchmark decontamination by a prefix-filtered set join (operator 3).

Items become windows of ``window`` consecutive words (a shorter item is one
window), windows become sets of word shingles.  Shingles are ordered by
rarity, counted over all documents.  For full containment the necessary prefix
of a window is its single rarest shingle: a document that holds the window
holds that shingle.  Windows with a shingle that no document has are gone at
once.  Document shingles that may be a prefix shingle are joined to the
prefixes; position and length bounds place the window in the document, and the
words of that item-sized place are compared one by one.

The filter in front of the join is a bit set of fixed size (``FILTER_BITS``,
16 MB), whatever the size of the benchmark; what passes it goes through an
ordinary equi-join, so the benchmark is never broadcast.  Candidates carry the
words around them, so texts are never shuffled.  A passage that many documents
share is one window row joined to many candidates, which adaptive execution
can split.

Words: after lower-casing A-Z, runs of digits, letters a-z and characters from
U+0080 on.  Edge cases: null and empty texts have no words; an item without
words has no window; equal windows of several items count for each; repeated
rows and ids each get a row; extra columns are ignored; an empty benchmark
leaves every document clean.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vaultmart.llm.common import blocks, code_points, fold_points, list_array, run_hashes, runs, shingle_hashes

WINDOW = 10
SHINGLE = 3
FILTER_BITS = 27               # log2 of the bits of the filter before the join


def text_words(texts: list):
    """(code points, starts, ends, first word of every text, word hashes) of a block."""
    cp, bounds = code_points(texts)
    cp = fold_points(cp)
    starts, ends = runs((cp >= 0x80) | ((cp >= 0x61) & (cp <= 0x7A)) | ((cp >= 0x30) & (cp <= 0x39)))
    return cp, starts, ends, np.searchsorted(starts, bounds), run_hashes(cp, starts, ends)


def spell(cp: np.ndarray, starts: np.ndarray, ends: np.ndarray, lo: int, hi: int) -> str:
    """Words lo..hi-1 joined by spaces."""
    return " ".join(cp[s:e].tobytes().decode("utf-32-le", "surrogatepass") for s, e in zip(starts[lo:hi], ends[lo:hi]))


def within_texts(words: np.ndarray, first: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, first word) of every n-word shingle that lies in one text."""
    if len(words) < n:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    text = np.repeat(np.arange(len(first) - 1), np.diff(first))
    at = np.flatnonzero(text[:len(words) - n + 1] == text[n - 1:])
    return shingle_hashes(words, n)[at], at


def item_windows(items: DataFrame, id_col: str, text_col: str, window: int = WINDOW, shingle: int = SHINGLE) -> DataFrame:
    """``item_id, words, size, shingles`` per window of every item."""
    rows = items.select(F.col(id_col).alias("item_id"), F.col(text_col).alias("text")).where(F.col("text").isNotNull())
    schema = T.StructType([rows.schema["item_id"], T.StructField("words", T.StringType()), T.StructField("size", T.IntegerType()),
                           T.StructField("shingles", T.ArrayType(T.LongType(), False))])

    def cut(batches):
        for b in batches:
            ids, spelled, sizes, sets = [], [], [], []
            for i, text in enumerate(b.column("text").to_pylist()):
                cp, starts, ends, _, words = text_words([text])
                size = min(window, len(words))
                for lo in range(len(words) - size + 1 if size else 0):
                    n = min(shingle, size)
                    ids.append(i)
                    spelled.append(spell(cp, starts, ends, lo, lo + size))
                    sizes.append(size)
                    sets.append(shingle_hashes(words[lo:lo + size], n).view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [b.column("item_id").take(pa.array(ids, pa.int64())), pa.array(spelled, pa.string()), pa.array(sizes, pa.int32()),
                 list_array(np.concatenate(sets) if sets else np.zeros(0, np.int64), [len(s) for s in sets], pa.int64())],
                names=schema.names)

    return rows.mapInArrow(cut, schema)


def bit_filter(hashes: DataFrame, column: str) -> np.ndarray:
    """Bit set of hashes; at most 2^(FILTER_BITS - 6) words reach the driver."""
    slot = F.col(column).bitwiseAND((1 << FILTER_BITS) - 1)
    words = hashes.groupBy(F.shiftright(slot, 6).alias("word")).agg(
        F.bit_or(F.expr(f"shiftleft(1L, cast({column} & 63 as int))")).alias("mask")).toPandas()
    bits = np.zeros(1 << (FILTER_BITS - 6), np.uint64)
    bits[words["word"].to_numpy(np.int64)] = words["mask"].to_numpy(np.int64).view(np.uint64)
    return bits


def passes(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    word = bits[((hashes & np.uint64((1 << FILTER_BITS) - 1)) >> np.uint64(6)).astype(np.int64)]
    return (word >> (hashes & np.uint64(63))) & np.uint64(1) == 1


def shingle_counts(docs: DataFrame, text_col: str, bits: np.ndarray, sizes: list[int]) -> DataFrame:
    """``shingle, n``: occurrences over all documents of the shingles that pass the filter."""
    shared = docs.sparkSession.sparkContext.broadcast(bits)

    def count(batches):
        held, size = [], 0
        for b in batches:
            texts = b.column("_text").to_pylist()
            for lo, hi in blocks(texts):
                _, _, _, first, words = text_words(texts[lo:hi])
                for n in sizes:
                    got = within_texts(words, first, n)[0]
                    held.append(np.unique(got[passes(shared.value, got)], return_counts=True))
                    size += len(held[-1][0])
            if size > 1 << 20:
                yield summed(held)
                held, size = [], 0
        if held:
            yield summed(held)

    def summed(held):
        shingle, where = np.unique(np.concatenate([h for h, _ in held]), return_inverse=True)
        n = np.bincount(where, np.concatenate([c for _, c in held]), len(shingle)).astype(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(shingle.view(np.int64)), pa.array(n)], names=["shingle", "n"])

    return (docs.select(F.col(text_col).alias("_text")).mapInArrow(count, "shingle long, n long")
            .groupBy("shingle").agg(F.sum("n").alias("n")))


def candidates(docs: DataFrame, id_col: str, text_col: str, bits: np.ndarray, sizes: list[int], window: int = WINDOW) -> DataFrame:
    """``row, id, n_words, places`` per document: the places of possible prefix
    shingles with the words from which a window around them could be read."""
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    place = T.StructType([T.StructField("at", T.IntegerType()), T.StructField("shingle", T.LongType()),
                          T.StructField("lead", T.IntegerType()), T.StructField("context", T.StringType())])
    schema = T.StructType([rows.schema["row"], rows.schema["id"], T.StructField("n_words", T.LongType()),
                           T.StructField("places", T.ArrayType(place, False))])
    kind = pa.struct([("at", pa.int32()), ("shingle", pa.int64()), ("lead", pa.int32()), ("context", pa.string())])
    shared = docs.sparkSession.sparkContext.broadcast(bits)

    def find(batches):
        for b in batches:
            texts = b.column("text").to_pylist()
            for lo, hi in blocks(texts):
                cp, starts, ends, first, words = text_words(texts[lo:hi])
                found: list[list] = [[] for _ in range(hi - lo)]
                for n in sizes:
                    got, at = within_texts(words, first, n)
                    ok = passes(shared.value, got)
                    text = np.searchsorted(first, at[ok], "right") - 1
                    for p, h, t in zip(at[ok].tolist(), got[ok].view(np.int64).tolist(), text.tolist()):
                        left = max(int(first[t]), p - (window - n))
                        found[t].append({"at": p - int(first[t]), "shingle": h, "lead": p - left,
                                         "context": spell(cp, starts, ends, left, min(int(first[t + 1]), p + window))})
                yield pa.RecordBatch.from_arrays(
                    [b.column("row").slice(lo, hi - lo), b.column("id").slice(lo, hi - lo), pa.array(np.diff(first).astype(np.int64)),
                     pa.array(found, pa.list_(kind))], names=schema.names)

    return rows.mapInArrow(find, schema)


def contamination(docs: DataFrame, items: DataFrame, stored, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", window: int = WINDOW, shingle: int = SHINGLE) -> dict[str, DataFrame]:
    """``documents`` (``row, id, n_words, n_hit, items``: one row per input row)
    and ``hits`` (``row, start, size, words``: every verified window)."""
    windows = stored(item_windows(items, item_col, "text", window, shingle), "windows")
    sizes = sorted(min(shingle, r["size"]) for r in windows.select(F.least("size", F.lit(shingle)).alias("size")).distinct().collect())
    parts = (windows.dropDuplicates(["words"])
             .select("words", "size", F.size("shingles").alias("parts"), F.posexplode("shingles").alias("offset", "shingle")))
    counts = stored(shingle_counts(docs, text_col, bit_filter(parts, "shingle"), sizes), "counts")
    prefixes = stored(
        parts.join(counts, "shingle")                          # a shingle that no document has takes its window with it
        .groupBy("words", "size", "parts").agg(F.count("*").alias("known"), F.min(F.struct("n", "shingle", "offset")).alias("rare"))
        .where("known = parts").select("words", "size", "rare.shingle", "rare.offset"), "prefixes")
    base = stored(candidates(docs, id_col, text_col, bit_filter(prefixes, "shingle"), sizes, window), "places")
    places = base.select("row", F.explode("places").alias("p")).select("row", "p.*")
    first = F.col("lead") - F.col("offset")
    seen = F.split("context", " ")
    hits = stored(
        places.join(prefixes, "shingle")
        .where((first >= 0) & (first + F.col("size") <= F.size(seen)))            # position and length bounds
        .where(F.array_join(F.slice(seen, first + 1, F.col("size")), " ") == F.col("words"))
        .select("row", (F.col("at") - F.col("offset")).alias("start"), "size", "words").distinct(), "hits")
    hit_words = (hits.select("row", F.explode(F.sequence("start", F.col("start") + F.col("size") - 1)).alias("word"))
                 .distinct().groupBy("row").agg(F.count("*").alias("n_hit")))
    owners = windows.select("words", F.col("item_id").cast("string").alias("item")).distinct()
    found = (hits.select("row", "words").distinct().join(owners, "words").select("row", "item").distinct()
             .groupBy("row").agg(F.array_sort(F.collect_list("item")).alias("items")))
    documents = (base.select("row", "id", "n_words").join(hit_words, "row", "left").join(found, "row", "left")
                 .select("row", "id", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
                         F.coalesce("items", F.array().cast("array<string>")).alias("items")))
    return {"documents": documents, "hits": hits}


def keep_clean(docs: DataFrame, items: DataFrame, stored, text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` without a benchmark window, all columns as they are.
    A text decides for every row that holds it, so rows need no id."""
    key = F.struct(F.xxhash64(text_col), F.octet_length(text_col), F.crc32(F.col(text_col).cast("binary")))
    keyed = docs.select(key.alias("key"), F.col(text_col).alias("text"))
    found = contamination(keyed, items, stored, "key", "text", **options)["documents"]
    bad = stored(found.where("n_hit > 0").select(F.col("id").alias("_bad")).distinct(), "contaminated")
    return docs.join(bad, key == F.col("_bad"), "left_anti")
