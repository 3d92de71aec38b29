"""Near-duplicate classes by bottom-k sketches (operator 9).

A text becomes the set of its word shingles; one hash function orders them and
a sketch keeps the ``k`` smallest values.  For two sets with Jaccard
similarity s, the values below the k-th smallest of their union are shared
with probability s each, so sketches of a pair at the threshold t share at
least ``need(k)`` values but for a few pairs in a million.

1. Equal sets (128-bit digest of the whole set) are one class; classes are the
   nodes from here on.  Copies are combined map-side and never expanded.
2. Inverted lists of retained values: values are ordered by the length of
   their list, and a class enters only the lists of its rarest values - as many
   as leave fewer than ``need`` out, so a pair that shares ``need`` values
   meets in at least one list.  Values from passages that many documents share
   have long lists and are left out, unless a class has hardly anything else.
3. Every class is compared with the class that heads most of its lists:
   union-sketch estimate, then exact Jaccard on the whole texts.  Links give
   components; a group of thousands of near copies collapses here in one
   comparison per class.
4. Only pairs of one list in different components are left.  Their classes
   get wider sketches (small sets are whole), and lists are dealt out in blocks
   of ``LIST_BLOCK`` classes.  A task counts the shared values of two blocks
   with a matrix product, estimates similarities on the union sketches (exact
   for whole sets) and hands on what remains, each pair once: in the list of
   its smallest common value; of pairs that surely link only as many as join
   the components at hand.  Whole texts confirm, and components are joined.

No list is capped and no pair is skipped: links inside a component cannot
change it.  Texts that need an exact check are picked by a bit filter of fixed
size and an exact join.

Edge cases: null and empty texts (no words) have the empty set and link with
nothing; texts with fewer words than a shingle have one shingle, the whole
sequence; repeated rows and ids each get a row (all rows equal in id and text
to the kept one are marked kept); rows without id rank behind ids; extra
columns are ignored; no rows give no rows.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vaultmart.llm.common import blocks, code_points, fold_points, list_array, run_hashes, runs, shingle_hashes, text_blocks
from vaultmart.llm.components import connected_components
from vaultmart.llm.decontamination import bit_filter, passes

SKETCH = 32
WIDE_SKETCH = 256              # values compared inside a list; sets of up to this size are compared whole
SIGMAS = 4.9                   # how far below its mean a pair's number of shared values may fall
LIST_BLOCK = 384
COLUMNS = 1024                # values a matrix product takes at once
FEW_PAIRS = 2000               # so many pairs are compared one by one


def shingle_sets(texts: list, n: int) -> list[np.ndarray]:
    """Sorted distinct 63-bit shingle hashes of every text of a block."""
    cp, bounds = code_points(texts)
    cp = fold_points(cp)
    starts, ends = runs((cp != 32) & ((cp < 9) | (cp > 13)))
    words, first = run_hashes(cp, starts, ends), np.searchsorted(starts, bounds)
    every = shingle_hashes(words, n) >> np.uint64(1) if len(words) >= n else words
    out = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
        if b - a >= n:
            out.append(np.unique(every[a:b - n + 1]).view(np.int64))
        elif b > a:
            out.append((shingle_hashes(words[a:b], b - a) >> np.uint64(1)).view(np.int64))
        else:
            out.append(np.zeros(0, np.int64))
    return out


def sketches(docs: DataFrame, id_col: str, text_col: str, n: int, k: int = SKETCH) -> DataFrame:
    """``id, text_key, n_shingles, digest, sketch`` per row."""
    rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("text_key"), F.col(text_col).alias("text"))
    schema = T.StructType([rows.schema["id"], rows.schema["text_key"], T.StructField("n_shingles", T.LongType()),
                           T.StructField("digest", T.BinaryType()), T.StructField("sketch", T.ArrayType(T.LongType(), False))])

    def sketch(batches):
        for b in batches:
            texts = b.column("text").to_pylist()
            for lo, hi in blocks(texts):
                sets = shingle_sets(texts[lo:hi], n)
                low = [s[:k] for s in sets]
                yield pa.RecordBatch.from_arrays(
                    [b.column("id").slice(lo, hi - lo), b.column("text_key").slice(lo, hi - lo), pa.array([len(s) for s in sets], pa.int64()),
                     pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets], pa.binary()),
                     list_array(np.concatenate(low), [len(s) for s in low], pa.int64())], names=schema.names)

    return rows.mapInArrow(sketch, schema)


def needed(m: Column, t: float) -> Column:
    """Shared values that sketches of ``m`` values of a pair at the threshold have at least."""
    return F.greatest(F.floor(m * t - F.sqrt(m * (t * (1 - t) * SIGMAS ** 2))), F.lit(1)).cast("int")


def need(m: int, t: float) -> int:
    return max(1, math.floor(m * t - math.sqrt(m * (t * (1 - t) * SIGMAS ** 2))))


def inverted_lists(classes: DataFrame, t: float) -> DataFrame:
    """``node, id, text_key, n_shingles, sketch, lists`` of the classes that share enough values to have a partner."""
    posts = classes.select("node", F.size("sketch").alias("m"), F.explode("sketch").alias("value"))
    length = posts.groupBy("value").agg(F.count("*").alias("length")).where("length > 1").withColumn("again", F.hash("value"))
    shared = posts.withColumn("again", F.hash("value")).join(length, ["value", "again"])
    own = shared.groupBy("node", "m").agg(F.array_sort(F.collect_list(F.struct("length", "value"))).alias("values"))
    own = own.where(F.size("values") >= needed(F.col("m"), t)).select(
        "node", F.slice("values", F.lit(1), F.size("values") - needed(F.col("m"), t) + 1)["value"].alias("lists"))
    return classes.join(own, "node")


def estimated(pairs: DataFrame, nodes: DataFrame, t: float, k: int) -> DataFrame:
    """The pairs (a, b) whose sizes allow the threshold and whose union sketch does not speak against it."""
    side = lambda x: nodes.select(F.col("node").alias(x), F.col("n_shingles").alias(f"n_{x}"), F.col("sketch").alias(f"s_{x}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b").where(F.least("n_a", "n_b") >= t * F.greatest("n_a", "n_b"))
    both = both.withColumn("low", F.slice(F.array_sort(F.array_union("s_a", "s_b")), 1, k))
    return both.where(F.size(F.array_intersect(F.array_intersect("low", "s_a"), "s_b")) >= needed(F.size("low"), t)).select("a", "b")


def confirmed(pairs: DataFrame, texts: DataFrame, n: int, percent: int) -> DataFrame:
    """The pairs with 100 * intersection >= percent * union on the whole shingle sets."""
    side = lambda x: texts.select(F.col("node").alias(x), F.col("text").alias(f"t_{x}"))

    def check(batches):
        last, of_last = None, None
        for b in batches:
            a, c = b.column("a").to_pylist(), b.column("b").to_pylist()
            keep = []
            for x, t_a, t_b in zip(c, b.column("t_a"), b.column("t_b")):
                if x != last:
                    last, of_last = x, shingle_sets([t_b.as_py()], n)[0]
                mine = shingle_sets([t_a.as_py()], n)[0]
                same = len(np.intersect1d(mine, of_last, assume_unique=True))
                keep.append(100 * same >= percent * (len(mine) + len(of_last) - same))
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(c, pa.int64())], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return pairs.join(side("a"), "a").join(side("b"), "b").mapInArrow(check, "a long, b long")


def wide_sketches(texts: DataFrame, n: int, k: int) -> DataFrame:
    """``node, wide, whole``: the ``k`` smallest values of a class, cut to their
    leading 32 bits (order is kept; two values that become equal can only make a
    pair look more alike, and whole texts confirm), and whether they are its whole set."""

    def sketch(batches):
        for b in batches:
            for lo, hi, part in text_blocks(b.column("text")):
                sets = shingle_sets(part, n)
                yield pa.RecordBatch.from_arrays(
                    [b.column("node").slice(lo, hi - lo),
                     list_array(np.concatenate([(s[:k] >> 31) - (1 << 31) for s in sets]).astype(np.int32), [min(len(s), k) for s in sets], pa.int32()),
                     pa.array([len(s) <= k for s in sets])], names=["node", "wide", "whole"])

    return texts.mapInArrow(sketch, "node long, wide array<int>, whole boolean")


def _shared(values: list, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Number of common values of every left and right row, by matrix products over ``COLUMNS`` values at a time."""
    value, at = np.unique(np.concatenate(values), return_inverse=True)
    row = np.repeat(np.arange(len(values)), [len(v) for v in values])
    used = np.bincount(at, minlength=len(value)) > 1
    row, column = row[used[at]], (np.cumsum(used) - 1)[at[used[at]]]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    out = np.zeros((len(left), len(right)), np.float32)
    for first in range(0, int(used.sum()), COLUMNS):
        lo, hi = np.searchsorted(column, (first, first + COLUMNS))
        held = np.zeros((len(values), COLUMNS), np.float32)
        held[row[lo:hi], column[lo:hi] - first] = 1
        out += held[left] @ held[right].T
    return out


def compare_blocks(rows: list, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of one list that may be linked: of different components, not met in
    a list of a smaller value, and not ruled out by the union of their sketches
    (whole sets decide exactly).  ``rows``: (value, lo, hi, own, node,
    component, n_shingles, whole, wide, lists)."""
    value, lo, hi = rows[0][:3]
    left = np.array([i for i, r in enumerate(rows) if r[3] == lo])
    right = left if lo == hi else np.array([i for i, r in enumerate(rows) if r[3] == hi])
    if not len(left) or not len(right):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    t = percent / 100
    node, part = np.array([r[4] for r in rows], np.int64), np.array([r[5] for r in rows], np.int64)
    size = np.array([r[6] for r in rows], float)
    ok = part[left][:, None] != part[right][None, :]
    ok &= np.minimum(size[left][:, None], size[right][None, :]) >= t * np.maximum(size[left][:, None], size[right][None, :])
    if lo == hi:
        ok &= node[left][:, None] > node[right][None, :]
    if not ok.any():
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    ok &= _shared([r[9][r[9] < value] for r in rows], left, right) == 0
    x, y = np.nonzero(ok)
    i, j = left[x], right[y]
    if len(i) <= FEW_PAIRS:
        shared = np.array([len(np.intersect1d(rows[p][8], rows[q][8])) for p, q in zip(i, j)], np.float32)
    else:
        shared = _shared([r[8] for r in rows], left, right)[x, y]
    count = np.array([len(r[8]) for r in rows])
    least = np.array([need(int(c), t) for c in count])
    some = shared >= np.minimum(least[i], least[j]) - 2
    i, j, shared = i[some], j[some], shared[some]
    whole, last = np.array([r[7] for r in rows]), np.array([r[8][-1] for r in rows])
    union = (count[i] + count[j] - shared).astype(float)
    exact = whole[i] & whole[j]
    for p in np.flatnonzero(~exact):                         # below the smaller of both ends both sketches are complete
        end = min(last[i[p]] if not whole[i[p]] else np.iinfo(np.int32).max, last[j[p]] if not whole[j[p]] else np.iinfo(np.int32).max)
        union[p] = np.searchsorted(rows[i[p]][8], end, "right") + np.searchsorted(rows[j[p]][8], end, "right") - shared[p]
    sure = exact & (100 * (shared - 2) >= percent * (union + 2))
    lost = np.array([len(r[8]) - len(np.unique(r[8])) for r in rows])       # values made equal by the cut count for the pair
    shared, union = shared + lost[i] + lost[j], union - lost[i] - lost[j]
    keep = np.where(exact, 100 * shared >= percent * union, shared >= t * union - SIGMAS * np.sqrt(union * t * (1 - t)))
    i, j, sure = i[keep], j[keep], sure[keep]
    keep = _spanning(part[i], part[j], sure)
    a, b = node[i][keep], node[j][keep]
    return np.maximum(a, b), np.minimum(a, b)


def _spanning(a: np.ndarray, b: np.ndarray, sure: np.ndarray) -> np.ndarray:
    """Which pairs of components are needed: of the sure ones those that join
    two groups, of the others those between groups that the sure ones left apart."""
    parent: dict = {}

    def root(x):
        while (up := parent.get(x, x)) != x:
            parent[x] = x = parent.get(up, up)
        return x

    keep = np.zeros(len(a), bool)
    for p in np.flatnonzero(sure):
        x, y = root(int(a[p])), root(int(b[p]))
        if x != y:
            parent[max(x, y)] = min(x, y)
            keep[p] = True
    for p in np.flatnonzero(~sure):
        keep[p] = root(int(a[p])) != root(int(b[p]))
    return keep


def block_pairs(lists: DataFrame, percent: int) -> DataFrame:
    """Candidate pairs (a, b) from all lists, each pair once.  ``lists``:
    ``value, size, node, component, n_shingles, whole, wide, lists``."""
    n = F.ceil(F.col("size") / LIST_BLOCK).cast("int")
    own = F.pmod(F.xxhash64("node"), n).cast("int")
    dealt = (lists.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), n - 1)))
             .withColumn("lo", F.least("own", "other")).withColumn("hi", F.greatest("own", "other"))
             .select("value", "lo", "hi", "own", "node", "component", "n_shingles", "whole", "wide", "lists"))

    def pairs(batches):
        held, key = [], None
        for b in batches:
            got = []
            cols = [b.column(i).to_pylist() for i in range(8)]
            arrays = [_rows_of(b.column(i)) for i in (8, 9)]
            for i, head in enumerate(zip(*cols)):
                if head[:3] != key and held:
                    got.append(compare_blocks(held, percent))
                    held = []
                key = head[:3]
                held.append((*head, arrays[0](i), arrays[1](i)))
            yield _pair_batch(got)
        if held:
            yield _pair_batch([compare_blocks(held, percent)])

    return dealt.repartition("value", "lo", "hi").sortWithinPartitions("value", "lo", "hi").mapInArrow(pairs, "a long, b long")


def _rows_of(column: pa.Array):
    values = column.flatten().to_numpy(zero_copy_only=False)
    cut = np.concatenate(([0], np.cumsum(column.value_lengths().to_numpy(zero_copy_only=False))))
    return lambda i: values[cut[i]:cut[i + 1]].copy()


def _pair_batch(got: list) -> pa.RecordBatch:
    flat = lambda k: pa.array(np.concatenate([np.zeros(0, np.int64), *[g[k] for g in got]]))
    return pa.RecordBatch.from_arrays([flat(0), flat(1)], names=["a", "b"])


def class_texts(docs: DataFrame, id_col: str, text_col: str, nodes: DataFrame) -> DataFrame:
    """``node, text`` of the classes' representatives.  A bit filter of fixed
    size on the text key keeps other texts out of the shuffle; the join is exact."""
    bits = docs.sparkSession.sparkContext.broadcast(bit_filter(nodes, "text_key"))
    rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("text_key"), F.col(text_col).alias("text"))

    def some(batches):
        for b in batches:
            yield b.filter(pa.array(passes(bits.value, b.column("text_key").to_numpy().view(np.uint64))))

    picked = rows.mapInArrow(some, rows.schema).withColumnRenamed("id", "own")
    wanted = nodes.select("node", F.col("id").alias("rep"), "text_key")
    return (picked.join(wanted, (picked["text_key"] == wanted["text_key"]) & F.col("own").eqNullSafe(F.col("rep")))
            .select("node", "text").dropDuplicates(["node"]))


def near_duplicates(docs: DataFrame, stored, id_col: str = "doc_id", text_col: str = "text", n: int = 5,
                    percent: int = 80, k: int = SKETCH) -> DataFrame:
    """One row per input row: ``id, text_key, n_shingles, component_id, kept``
    (``component_id``: the smallest id that links reach)."""
    t = percent / 100
    rows = stored(sketches(docs, id_col, text_col, n, k), "sketches")
    first = F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "text_key"))
    classes = stored(
        rows.where("n_shingles > 0").groupBy("digest", "n_shingles").agg(first.alias("rep"), F.any_value("sketch").alias("sketch"))
        .select("digest", "n_shingles", "sketch", "rep.id", "rep.text_key", F.monotonically_increasing_id().alias("node")), "classes")
    active = stored(inverted_lists(classes.drop("digest"), t), "lists")
    texts = stored(class_texts(docs, id_col, text_col, active), "texts")
    lists = active.select("node", F.explode("lists").alias("value"))

    heads = lists.groupBy("value").agg(F.min("node").alias("b")).withColumn("again", F.hash("value"))
    votes = (lists.withColumn("again", F.hash("value")).join(heads, ["value", "again"]).where("node <> b")
             .groupBy(F.col("node").alias("a"), "b").agg(F.count("*").alias("votes")))
    chosen = votes.groupBy("a").agg(F.max_by("b", F.struct("votes", -F.col("b"))).alias("b"))
    star = connected_components(confirmed(estimated(chosen, active, t, k), texts, n, percent), stored)

    part = lists.join(star, "node", "left").select("value", "node", F.coalesce("component", "node").alias("component"))
    part = stored(part, "parts")
    mixed = (part.groupBy("value").agg(F.count("*").alias("size"), F.min("component").alias("lo"), F.max("component").alias("hi"))
             .where("lo < hi").select("value", "size", F.hash("value").alias("again")))
    left = part.withColumn("again", F.hash("value")).join(mixed, ["value", "again"]).drop("again")
    left = stored(left, "mixed")
    open_texts = texts.join(left.select("node").distinct(), "node", "left_semi")
    wide = stored(wide_sketches(open_texts, n, WIDE_SKETCH), "wide").join(active.select("node", "n_shingles", "lists"), "node")
    pairs = stored(block_pairs(left.join(wide, "node"), percent), "pairs")
    rest = confirmed(pairs, texts, n, percent)
    whole = connected_components(star.select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(rest), stored)

    of_class = classes.join(whole, "node", "left").select(
        "digest", "n_shingles", "id", "text_key", F.coalesce("component", "node").alias("component"))
    smallest = of_class.groupBy("component").agg(F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "text_key")).alias("rep"))
    result = stored(of_class.drop("id", "text_key").join(smallest, "component").select(
        "digest", "n_shingles", F.col("rep.id").alias("rep_id"), F.col("rep.text_key").alias("rep_key")), "result")
    got = rows.join(result, ["digest", "n_shingles"], "left")
    alone = F.col("n_shingles") == 0
    return got.select(
        F.col("id"), "text_key", "n_shingles", F.when(alone, F.col("id")).otherwise(F.col("rep_id")).alias("component_id"),
        (alone | (F.col("id").eqNullSafe(F.col("rep_id")) & (F.col("text_key") == F.col("rep_key")))).alias("kept"))


def keep_one(docs: DataFrame, stored, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One document of each group, all columns as they are.  Of rows equal in id and text one stays."""
    found = near_duplicates(docs, stored, id_col, text_col, **options)
    kept = stored(found.where("kept").groupBy(F.col("id").alias("_kept_id"), F.col("text_key").alias("_kept_key"))
                  .agg(F.count("*").alias("_kept_rows")), "kept")
    on = F.col(id_col).eqNullSafe(F.col("_kept_id")) & (F.xxhash64(text_col) == F.col("_kept_key"))
    rows = docs.join(kept, on)
    once, again = rows.where("_kept_rows = 1"), rows.where("_kept_rows > 1")
    return once.unionByName(again.dropDuplicates(["_kept_id", "_kept_key"])).select(*docs.columns)
