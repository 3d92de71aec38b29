"""Shared helpers of the training-data operators.

Python tasks of these operators work on Arrow batches and hand whole blocks
of documents to numpy: the texts of a block are one code-point array, words
are (start, end) offsets into it, and a word's 64-bit hash comes from prefix
sums, so no Python object is made per word.
"""

from __future__ import annotations

import tempfile
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ARROW_ROWS = 256
BLOCK_CHARS = 1 << 20          # characters a numpy block holds (a longer document is a block of its own)


# ---- tables -------------------------------------------------------------------------------------------

def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of texts.  Arrow batches are kept to ``ARROW_ROWS`` rows from here
    on: Spark's default of 10,000 texts would be hundreds of MB per task."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    A scratch folder replaces it only where it is unset on a local master
    (tests); on a cluster a missing setting is an error, because executors do
    not see each other's disks.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if path:
        return path.rstrip("/")
    if not (spark.conf.get("spark.master", "") or "").startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    path = tempfile.mkdtemp(prefix="llm-shared-")
    spark.conf.set("spark.checkpoint.dir", path)
    return path


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/llm/{name}-{uuid.uuid4().hex}"


def stored(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back (cuts the
    lineage; a lost executor costs nothing that is already written)."""
    path = new_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fold_az(col):
    """Lower-case A-Z only (other letters keep their case)."""
    return F.translate(col, UPPER, LOWER)


class Remembered(dict):
    """Bounded memo of ``compute(key)`` for short keys: two generations, so that
    frequent keys survive when the younger one is full.  A lookup costs one dict
    access; an entry that is gone is computed again."""

    def __init__(self, compute, entries: int, longest: int):
        super().__init__()
        self.compute, self.entries, self.longest, self.old = compute, entries, longest, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.compute(key)
        if len(key) <= self.longest:
            if len(self) >= self.entries:
                self.old = dict(self)
                self.clear()
            self[key] = value
        return value


# ---- blocks of texts as code points -------------------------------------------------------------------

def blocks(texts: list, limit: int = BLOCK_CHARS):
    """Yield (first, last) index ranges of ``texts`` holding about ``limit`` characters each."""
    lo = size = 0
    for i, t in enumerate(texts):
        size += len(t) if t else 0
        if size >= limit:
            yield lo, i + 1
            lo, size = i + 1, 0
    if lo < len(texts):
        yield lo, len(texts)


def text_blocks(column: pa.Array, limit: int = BLOCK_CHARS):
    """Yield (first, last, texts) of a string column, about ``limit`` bytes of text at a time."""
    at = column.cast(pa.large_string())
    ends = np.frombuffer(at.buffers()[1], np.int64)[at.offset:at.offset + len(at) + 1]
    lo = 0
    while lo < len(at):
        hi = min(max(lo + 1, int(np.searchsorted(ends, ends[lo] + limit))), len(at))
        yield lo, hi, at.slice(lo, hi - lo).to_pylist()
        lo = hi


def code_points(texts: list) -> tuple[np.ndarray, np.ndarray]:
    """(code points, bounds): every text is preceded and followed by a line
    feed; text i spans bounds[i] + 1 up to bounds[i + 1]."""
    joined = "\n" + "\n".join(t or "" for t in texts) + "\n"
    cp = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    size = np.fromiter((len(t) + 1 if t else 1 for t in texts), np.int64, len(texts))
    bounds = np.zeros(len(texts) + 1, np.int64)
    np.cumsum(size, out=bounds[1:])
    return cp, bounds


def fold_points(cp: np.ndarray) -> np.ndarray:
    return cp + (((cp >= 65) & (cp <= 90)).astype(np.uint32) << 5)


def runs(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(starts, ends) of the runs of True; the first and last element are False."""
    edge = np.flatnonzero(mask[1:] != mask[:-1]) + 1
    return edge[0::2], edge[1::2]


def per_text(starts: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Index of the first run of every text, and the number of runs at the end."""
    return np.searchsorted(starts, bounds)


# ---- hashing ------------------------------------------------------------------------------------------

_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_INV = np.uint64(pow(int(_BASE), -1, 1 << 64))
_powers: dict = {}


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values (a bijection with well mixed output bits)."""
    x = x.astype(np.uint64, copy=True)
    with np.errstate(over="ignore"):
        x ^= x >> np.uint64(30)
        x *= np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(27)
        x *= np.uint64(0x94D049BB133111EB)
        x ^= x >> np.uint64(31)
    return x


def _power(base: np.uint64, n: int) -> np.ndarray:
    got = _powers.get(int(base))
    if got is None or len(got) < n:
        with np.errstate(over="ignore"):
            got = np.full(max(n, 1 << 21), base, np.uint64)
            got[0] = 1
            got = np.multiply.accumulate(got)
        _powers[int(base)] = got
    return got[:n]


def run_hashes(cp: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of every run of code points: a polynomial over spread code
    points from prefix sums, so the cost does not depend on run lengths."""
    with np.errstate(over="ignore"):
        v = mix(cp.astype(np.uint64) + np.uint64(0x632BE59BD9B4E019)) * _power(_BASE, len(cp))
        p = np.zeros(len(cp) + 1, np.uint64)
        np.cumsum(v, out=p[1:])
        return mix((p[ends] - p[starts]) * _power(_INV, len(cp))[starts])


def shingle_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of every n consecutive words (length - n + 1 values)."""
    with np.errstate(over="ignore"):
        h = np.zeros(len(words) - n + 1, np.uint64)
        for i in range(n):
            h = h * _BASE + words[i:len(words) - n + 1 + i] + np.uint64(n)
    return mix(h)


def list_array(values: np.ndarray, counts, kind) -> pa.Array:
    """Arrow list column: ``values`` cut into rows of ``counts`` elements."""
    offsets = np.zeros(len(counts) + 1, np.int32)
    np.cumsum(counts, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, kind))
