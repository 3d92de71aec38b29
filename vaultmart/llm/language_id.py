"""Language identification by bit-sliced Bloom filters (operator 1).

Training counts word-bounded character trigrams per language over all
training rows and inserts every one of them.  All languages share one filter:
row r holds a bit mask of the slices that set bit r, so the AND of a trigram's
k rows is the mask of all languages that contain it.  Every language has two
slices: one for each trigram seen in it, one for those it uses at a share of
at least ``relative`` of the largest share in any language.

A document's trigrams vote: per slice the set bits are counted, the count is
corrected for the false positives expected from that slice's fill
(p = fill^k, corrected = (c - n p) / (1 - p)), and the largest sum of a
language's two corrected counts decides: a trigram of several languages counts
for each, and once more for those that it is typical of.  ``score`` is the
winner's share against the runner-up.

Bounds: the filter has a power of two of rows, eight per distinct trigram of
the richest language and at most ``MOST_ROWS``, of one 64-bit word per 32
languages (32 MB per word at most; fuller slices only raise p), built by Spark
as an OR per row and broadcast; languages are the distinct values of the label
column.  Memory per task: one Arrow batch and blocks of ``BLOCK_CHARS``
characters; longer texts are read in pieces whose votes add up, cut behind a
word or, in a longer run of letters, with a letter of overlap on either side.

Edge cases: null texts and texts without a letter are ``und`` with score 0;
texts whose trigrams are all unknown get the most frequent language with score
0; ties go to the first language by code point; repeated rows and ids each get
a row; extra columns are ignored; without training rows every text is ``und``.
"""

from __future__ import annotations

import functools

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vaultmart.llm.common import BLOCK_CHARS, blocks, code_points, mix

MOST_ROWS, LEAST_ROWS = 1 << 22, 1 << 14   # rows of the bit-sliced filter
HASHES = 3
FLUSH = 1 << 20                # distinct trigrams a training task holds before it hands them on
GRAM = 3


@functools.cache
def _letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def trigrams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(trigrams, first trigram of every text): three code points packed in 63
    bits, non-letters as one space, only trigrams with a letter in the middle."""
    cp, bounds = code_points([t.lower() for t in texts])
    letter = _letters()[cp]
    keep = letter.copy()
    keep[1:] |= letter[:-1]
    keep[0] = True
    at = np.flatnonzero(keep)
    c = np.where(letter[at], cp[at], 32).astype(np.int64)
    mid = np.flatnonzero(c[1:-1] != 32) + 1
    return (c[mid - 1] << 42) | (c[mid] << 21) | c[mid + 1], np.searchsorted(at[mid], bounds)


def pieces(texts: list, limit: int = BLOCK_CHARS):
    """Yield (indices, texts, lead, tail) blocks.  A long text comes in pieces
    cut behind a word.  A longer run of letters is cut inside: ``lead`` and
    ``tail`` say that the piece's first and last letter are only there as
    neighbours, so that every trigram is seen once (see ``piece_trigrams``)."""
    for lo, hi in blocks(texts, limit):
        if hi - lo > 1 or len(texts[lo] or "") <= 2 * limit:
            yield np.arange(lo, hi), [t or "" for t in texts[lo:hi]], 0, 0
            continue
        text, at, lead = texts[lo].lower(), 0, 0
        while at < len(text):
            to = min(at + limit, len(text))
            while to < len(text) and text[to - 1].isalpha() and to - at < 2 * limit:
                to += 1                                      # a piece ends behind a word
            tail = int(to < len(text) and text[to - 1].isalpha() and text[to].isalpha())
            yield np.array([lo]), [text[at - lead:to + tail]], lead, tail
            at, lead = to, tail


def piece_trigrams(texts: list[str], lead: int, tail: int) -> tuple[np.ndarray, np.ndarray]:
    grams, first = trigrams(texts)
    if lead or tail:                                         # one text
        grams = grams[lead:len(grams) - tail]
        first = np.array([0, len(grams)])
    return grams, first


def _positions(grams: np.ndarray, rows: int) -> list[np.ndarray]:
    h = mix(grams)
    step = (h >> np.uint64(32)) | np.uint64(1)
    with np.errstate(over="ignore"):
        return [((h + np.uint64(i) * step) & np.uint64(rows - 1)).astype(np.int64) for i in range(HASHES)]


def count_trigrams(rows: DataFrame) -> DataFrame:
    """``lang, gram, n`` over (lang, text) rows; counts are summed per task before the shuffle."""

    def count(batches):
        held: dict[str, list] = {}
        size = 0

        def emit():
            for lang, parts in held.items():
                gram, where = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
                n = np.bincount(where, np.concatenate([p[1] for p in parts])).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(gram)), pa.array(gram), pa.array(n)],
                                                 names=["lang", "gram", "n"])

        for batch in batches:
            table = pd.DataFrame({"lang": batch.column("lang").to_pylist(), "text": batch.column("text").to_pylist()})
            for lang, group in table.groupby("lang", sort=True):
                for _, texts, lead, tail in pieces(list(group["text"])):
                    gram, n = np.unique(piece_trigrams(texts, lead, tail)[0], return_counts=True)
                    held.setdefault(lang, []).append((gram, n))
                    size += len(gram)
                    if len(held[lang]) > 16:
                        gram, where = np.unique(np.concatenate([p[0] for p in held[lang]]), return_inverse=True)
                        n = np.bincount(where, np.concatenate([p[1] for p in held[lang]])).astype(np.int64)
                        size += len(gram) - sum(len(p[0]) for p in held[lang])
                        held[lang] = [(gram, n)]
                    if size > FLUSH:
                        yield from emit()
                        held, size = {}, 0
        yield from emit()

    return rows.mapInArrow(count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


class LanguageModel:
    """``langs`` (by code point), the filter's rows, false-positive rate of every slice, index of the most frequent language.
    Slice i holds all trigrams of language i, slice len(langs) + i those typical of it."""

    def __init__(self, langs: list[str], rows: np.ndarray, usual: int):
        self.langs, self.rows, self.usual, self.slices = langs, rows, usual, 2 * len(langs)
        self.false = np.array([float(np.mean((rows[:, i // 64] >> np.uint64(i % 64)) & np.uint64(1))) ** HASHES
                               for i in range(self.slices)])

    def votes(self, texts: list[str], lead: int = 0, tail: int = 0) -> tuple[np.ndarray, np.ndarray]:
        """(trigrams per text, slices x texts of set bits)."""
        grams, first = piece_trigrams(texts, lead, tail)
        out = np.zeros((self.slices, len(texts)))
        where = _positions(grams, len(self.rows))
        for word in range(self.rows.shape[1]):
            mask = functools.reduce(np.bitwise_and, (self.rows[p, word] for p in where))
            for i in range(64 * word, min(64 * word + 64, self.slices)):
                seen = np.concatenate(([0], np.cumsum((mask >> np.uint64(i % 64)) & np.uint64(1), dtype=np.int64)))
                out[i] = seen[first[1:]] - seen[first[:-1]]
        return np.diff(first), out

    def predict(self, texts: list) -> tuple[list[str], np.ndarray]:
        n, votes = np.zeros(len(texts)), np.zeros((self.slices, len(texts)))
        for where, part, lead, tail in pieces(texts):
            a, b = self.votes(part, lead, tail)
            n[where] += a
            votes[:, where] += b
        if not self.langs:
            return ["und"] * len(texts), np.zeros(len(texts))
        false = self.false[:, None]
        fair = np.maximum((votes - n * false) / (1 - np.minimum(false, 0.999)), 0)
        fair = fair[:len(self.langs)] + fair[len(self.langs):]
        best = fair.argmax(0)
        top = np.sort(fair, 0)[::-1]
        pair = top[0] + (top[1] if len(self.langs) > 1 else 0)
        score = np.where(pair > 0, top[0] / np.maximum(pair, 1e-12), 0.0)
        best = np.where(pair > 0, best, self.usual)
        return [self.langs[b] if k else "und" for b, k in zip(best, n)], np.where(n > 0, score, 0.0)


def train(rows: DataFrame, stored, relative: float = 0.25) -> LanguageModel:
    """Learn from (lang, text) rows; ``stored`` writes a small table once and reads it back."""
    counts = stored(count_trigrams(rows.where(F.col("lang").isNotNull() & F.col("text").isNotNull())), "trigrams")
    totals = counts.groupBy("lang").agg(F.sum("n").alias("total"), F.count("*").alias("distinct"))
    sizes = sorted((r["lang"], r["total"], r["distinct"]) for r in totals.collect())       # one row per language
    langs = [lang for lang, *_ in sizes]
    words = max(1, -(-2 * len(langs) // 64))
    most = max((d for *_, d in sizes), default=0)
    height = min(MOST_ROWS, max(LEAST_ROWS, 1 << (8 * most).bit_length()))
    share = counts.join(totals, "lang").select("lang", "gram", (F.col("n") / F.col("total")).alias("share"))
    tops = share.groupBy("gram").agg(F.max("share").alias("top"))
    member = share.join(tops, "gram").select("lang", "gram", (F.col("share") >= relative * F.col("top")).alias("typical"))
    index = {lang: i for i, lang in enumerate(langs)}

    def place(batches):
        for b in batches:
            i = np.array([index[x] for x in b.column("lang").to_pylist()], np.int64)
            typical = b.column("typical").to_numpy(zero_copy_only=False)
            grams = b.column("gram").to_numpy()
            for slices, at in ((i, grams), (i[typical] + len(index), grams[typical])):
                bit = (np.uint64(1) << (slices % 64).astype(np.uint64)).view(np.int64)
                for place in _positions(at, height):
                    yield pa.RecordBatch.from_arrays([pa.array(place), pa.array((slices // 64).astype(np.int32)), pa.array(bit)],
                                                     names=["at", "word", "mask"])

    bits = member.mapInArrow(place, "at long, word int, mask long").groupBy("at", "word").agg(F.bit_or("mask").alias("mask"))
    got = bits.toPandas()                                                    # at most MOST_ROWS x words rows
    table = np.zeros((height, words), np.uint64)
    table[got["at"].to_numpy(), got["word"].to_numpy()] = got["mask"].to_numpy(np.int64).view(np.uint64)
    usual = max(range(len(sizes)), key=lambda i: (sizes[i][1], -i)) if sizes else 0
    return LanguageModel(langs, table, usual)


def identify(docs: DataFrame, model: LanguageModel, id_col: str = "doc_id", text_col: str = "text",
             keep: dict | None = None) -> DataFrame:
    """``id, <keep...>, lang_pred, score`` per row; ``keep`` names further columns to carry (name -> expression)."""
    rows = docs.select(F.col(id_col), F.col(text_col).alias("_text"), *[c.alias(n) for n, c in (keep or {}).items()])
    shared = docs.sparkSession.sparkContext.broadcast((model.langs, model.rows, model.usual))
    kept = [id_col, *(keep or {})]
    schema = T.StructType([rows.schema[n] for n in kept] + [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])

    def predict(batches):
        own = LanguageModel(*shared.value)
        for b in batches:
            lang, score = own.predict(b.column("_text").to_pylist())
            yield pa.RecordBatch.from_arrays([b.column(n) for n in kept] + [pa.array(lang, pa.string()), pa.array(score)],
                                             names=schema.names)

    return rows.mapInArrow(predict, schema)
