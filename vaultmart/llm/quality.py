"""Document quality by random Fourier features (operator 6).

Every text becomes a vector of document statistics (lengths, character
classes, word and line shapes, repetition).  Standardised statistics pass
through random Fourier features, which approximate a Gaussian kernel; a ridge
regression on them is fitted from normal equations that each partition sums
over its labelled rows and Spark sums over partitions, one row of the matrix
per key.  Scores are calibrated by isotonic regression over equal-width score
bins counted by Spark (a bounded number of bins, all training rows).

Only bounded data reaches the driver: one row of means, the normal matrix
(``FEATURES`` + 1 square) and ``BINS`` bins.  The model is a few kilobytes plus
the feature matrix drawn from a fixed seed.

Edge cases: null and empty texts have all-zero statistics and are scored like
any other text; labels that are null are no training rows; repeated rows and
ids each get a row (and each count in training); extra columns are ignored;
without training rows every score is 0.5.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vaultmart.llm.common import blocks, code_points, list_array, run_hashes, runs, shingle_hashes

FEATURES = 256                 # random Fourier features
SEED = 20240229
WIDTH = 0.25                   # inverse length scale on standardised statistics
RIDGE = 1e-3                   # per training row
BINS = 1024
CLIP = 6.0

STATISTICS = (
    "log_chars", "log_words", "word_length", "letters", "digits", "upper", "space", "stops", "symbols", "non_ascii",
    "lines_per_word", "log_line_length", "stops_per_word", "short_words", "long_words", "log_longest_word",
    "bare_words", "distinct_words", "distinct_lines", "distinct_triples", "symbol_ends", "upper_words")


@functools.cache
def _classes() -> dict[str, np.ndarray]:
    chars = [chr(c) for c in range(0x110000)]
    table = {"letter": str.isalpha, "digit": str.isdigit, "upper": str.isupper, "space": str.isspace}
    out = {k: np.fromiter(map(f, chars), bool, len(chars)) for k, f in table.items()}
    out["stop"] = np.zeros(len(chars), bool)
    out["stop"][[ord(c) for c in ".,;:'\"?-()"]] = True
    out["symbol"] = ~(out["letter"] | out["digit"] | out["space"] | out["stop"])
    return out


def _distinct(values: np.ndarray, text: np.ndarray, n: int) -> np.ndarray:
    """Distinct values per text (hashes cut to 40 bits)."""
    key = np.sort((text.astype(np.uint64) << np.uint64(40)) | (values >> np.uint64(24)))
    first = np.ones(len(key), bool)
    first[1:] = key[1:] != key[:-1]
    return np.bincount((key[first] >> np.uint64(40)).astype(np.int64), minlength=n)[:n]


def statistics(texts: list) -> np.ndarray:
    """One row of document statistics per text of a block."""
    n = len(texts)
    cp, bounds = code_points(texts)
    table = _classes()
    size = np.diff(bounds) - 1

    def chars(mask):
        c = np.zeros(len(cp) + 1, np.int64)
        np.cumsum(mask, out=c[1:])
        return c[bounds[1:]] - c[bounds[:-1] + 1]

    space, letter = table["space"][cp], table["letter"][cp]
    upper, symbol, stop = table["upper"][cp], table["symbol"][cp], table["stop"][cp]
    starts, ends = runs(~space)
    at = per = np.searchsorted(starts, bounds)
    words = np.diff(per)
    text_of = np.repeat(np.arange(n), words)
    long = ends - starts

    def over_words(values):
        c = np.zeros(len(starts) + 1)
        np.cumsum(values, out=c[1:])
        return c[at[1:]] - c[at[:-1]]

    letters_before = np.zeros(len(cp) + 1, np.int64)
    np.cumsum(letter, out=letters_before[1:])
    bare = letters_before[ends] == letters_before[starts]
    longest = np.zeros(n)
    np.maximum.at(longest, text_of, long)
    hashes = run_hashes(cp, starts, ends)
    line_starts, line_ends = runs(cp != 10)
    line_at = np.searchsorted(line_starts, bounds)
    lines = np.diff(line_at)
    line_text = np.repeat(np.arange(n), lines)
    triples = np.zeros(n)
    distinct_triples = np.zeros(n)
    if len(hashes) >= 3:
        whole = text_of[:-2] == text_of[2:]
        triples = np.bincount(text_of[:-2][whole], minlength=n)
        distinct_triples = _distinct(shingle_hashes(hashes, 3)[whole], text_of[:-2][whole], n)

    def per_char(x):
        return x / np.maximum(size, 1)

    def per_word(x):
        return x / np.maximum(words, 1)

    letters = chars(letter)
    return np.column_stack([
        np.log1p(size), np.log1p(words), per_word(over_words(long)), per_char(letters), per_char(chars(table["digit"][cp])),
        chars(upper) / np.maximum(letters, 1), per_char(chars(space)), per_char(chars(stop)), per_char(chars(symbol)),
        per_char(chars(cp > 127)), per_word(lines), np.log1p(size / np.maximum(lines, 1)), per_word(chars(stop)),
        per_word(over_words(long <= 3)), per_word(over_words(long >= 12)), np.log1p(longest), per_word(over_words(bare)),
        per_word(_distinct(hashes, text_of, n)), _distinct(run_hashes(cp, line_starts, line_ends), line_text, n) / np.maximum(lines, 1),
        np.where(triples > 0, distinct_triples / np.maximum(triples, 1), 1.0),
        per_word(over_words(symbol[np.maximum(ends - 1, 0)])), per_word(over_words(upper[starts])),
    ]).astype(np.float64) * (size > 0)[:, None]


def _all_statistics(texts: list) -> np.ndarray:
    parts = [statistics(texts[lo:hi]) for lo, hi in blocks(texts)]
    return np.concatenate(parts) if parts else np.zeros((0, len(STATISTICS)))


def document_statistics(docs: DataFrame, text_col: str = "text", keep: dict | None = None) -> DataFrame:
    """``<keep...>, stats`` per row: kept columns (name -> expression) and the statistics as an array."""
    keep = keep or {"doc_id": F.col("doc_id")}
    rows = docs.select(*[c.alias(n) for n, c in keep.items()], F.col(text_col).alias("_text"))
    kept = list(keep)
    schema = T.StructType([rows.schema[n] for n in kept] + [T.StructField("stats", T.ArrayType(T.DoubleType(), False))])

    def measure(batches):
        for b in batches:
            x = _all_statistics(b.column("_text").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [b.column(n) for n in kept] + [list_array(x.ravel(), np.full(len(x), len(STATISTICS)), pa.float64())], names=schema.names)

    return rows.mapInArrow(measure, schema)


class QualityModel:
    """Standardisation, Fourier feature weights and isotonic steps."""

    def __init__(self, mean, scale, weights=None, low=0.0, high=1.0, steps=None):
        self.mean, self.scale, self.weights, self.low, self.high, self.steps = mean, scale, weights, low, high, steps

    def features(self, x: np.ndarray) -> np.ndarray:
        rng = np.random.Generator(np.random.PCG64(SEED))
        w = rng.normal(0, WIDTH, (len(STATISTICS), FEATURES))
        shift = rng.uniform(0, 2 * np.pi, FEATURES)
        z = np.clip((x - self.mean) / self.scale, -CLIP, CLIP)
        return np.column_stack([np.sqrt(2 / FEATURES) * np.cos(z @ w + shift), np.ones(len(x))])

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.features(x) @ self.weights

    def bins(self, raw: np.ndarray) -> np.ndarray:
        return np.clip((raw - self.low) / max(self.high - self.low, 1e-9) * BINS, 0, BINS - 1)

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.weights is None:
            return np.full(len(x), 0.5)
        return np.interp(self.bins(self.raw(x)), np.arange(BINS) + 0.5, self.steps)


def isotonic(total: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Non-decreasing fit to bin means by pooling adjacent violators; empty bins take the value before them."""
    pools: list[list[float]] = []                            # [sum, weight, bins]
    for s, c in zip(total, count):
        pools.append([float(s), float(c), 1])
        while len(pools) > 1 and (pools[-1][1] == 0 or pools[-2][1] == 0
                                  or pools[-2][0] / pools[-2][1] >= pools[-1][0] / pools[-1][1]):
            s2, c2, b2 = pools.pop()
            pools[-1] = [pools[-1][0] + s2, pools[-1][1] + c2, pools[-1][2] + b2]
    return np.concatenate([np.full(b, s / c if c else 0.5) for s, c, b in pools])


def fit(training: DataFrame) -> QualityModel:
    """Fit on ``stats, label`` rows (label 0 or 1).  ``training`` should be
    stored: it is read for the means, the normal equations and the calibration."""
    k = len(STATISTICS)
    got = training.select(*[F.avg(F.col("stats")[i]).alias(f"m{i}") for i in range(k)],
                          *[F.stddev_pop(F.col("stats")[i]).alias(f"s{i}") for i in range(k)], F.count("*").alias("n")).first()
    if not got["n"]:
        return QualityModel(np.zeros(k), np.ones(k))
    model = QualityModel(np.array([got[f"m{i}"] for i in range(k)]), np.array([max(got[f"s{i}"] or 0.0, 1e-6) for i in range(k)]))
    d = FEATURES + 1

    def matrix(b):
        return b.column("stats").flatten().to_numpy(zero_copy_only=False).reshape(-1, k)

    def partition_sums(batches):
        a, n = np.zeros((d, d + 1)), 0
        for b in batches:
            z = model.features(matrix(b))
            a += z.T @ np.column_stack([z, b.column("label").to_numpy(zero_copy_only=False).astype(float)])
            n += len(z)
        if n:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(d)), list_array(a.ravel(), np.full(d, d + 1), pa.float64())], names=["row", "sums"])

    def add(table: pa.Table) -> pa.Table:
        v = table.column("sums").combine_chunks()
        total = v.flatten().to_numpy(zero_copy_only=False).reshape(len(v), d + 1).sum(0)
        return pa.table([table.column("row").slice(0, 1), list_array(total, [d + 1], pa.float64())], names=["row", "sums"])

    schema = "row long, sums array<double>"
    sums = training.mapInArrow(partition_sums, schema).groupBy("row").applyInArrow(add, schema).collect()   # d rows
    normal = np.zeros((d, d + 1))
    for r in sums:
        normal[r["row"]] = r["sums"]
    penalty = np.full(d, RIDGE * got["n"])
    penalty[-1] = 0
    model.weights = np.linalg.solve(normal[:, :-1] + np.diag(penalty), normal[:, -1])
    model.low, model.high = -0.25, 1.25

    def count_bins(batches):
        total, count = np.zeros(BINS), np.zeros(BINS, np.int64)
        for b in batches:
            at = model.bins(model.raw(matrix(b))).astype(int)
            total += np.bincount(at, b.column("label").to_numpy(zero_copy_only=False), BINS)
            count += np.bincount(at, minlength=BINS)
        at = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at]), pa.array(count[at])], names=["bin", "total", "n"])

    bins = training.mapInArrow(count_bins, "bin long, total double, n long").groupBy("bin").agg(
        F.sum("total").alias("total"), F.sum("n").alias("n")).toPandas()                                     # at most BINS rows
    total, count = np.zeros(BINS), np.zeros(BINS)
    total[bins["bin"]], count[bins["bin"]] = bins["total"], bins["n"]
    model.steps = isotonic(total, count)
    return model


def score(stats: DataFrame, model: QualityModel) -> DataFrame:
    """Replace ``stats`` by ``score``."""
    names = [c for c in stats.columns if c != "stats"]
    schema = T.StructType([stats.schema[n] for n in names] + [T.StructField("score", T.DoubleType())])

    def apply(batches):
        for b in batches:
            x = b.column("stats").flatten().to_numpy(zero_copy_only=False).reshape(-1, len(STATISTICS))
            yield pa.RecordBatch.from_arrays([b.column(n) for n in names] + [pa.array(model.score(x))], names=schema.names)

    return stats.mapInArrow(apply, schema)


def keep_good(docs: DataFrame, model: QualityModel, threshold: float, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose text scores ``threshold`` or more, all columns as they are."""

    def good(batches):
        for b in batches:
            keep = model.score(_all_statistics(b.column(text_col).to_pylist())) >= threshold
            yield b.filter(pa.array(keep))

    return docs.mapInArrow(good, docs.schema)
