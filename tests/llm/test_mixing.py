import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.helpers import awkward_rows, docs_frame, store, words_between_spaces
from vaultmart.llm import mixing


def brute_targets(sizes, weights=(5, 2, 1), ratio=1.5, repeat=2.0):
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, free, rest = {}, set(names), ratio * sum(sizes.values())
    while free:
        share = {s: rest * weight[s] / sum(weight[x] for x in free) for s in free}
        over = {s for s in free if share[s] > repeat * sizes[s]}
        if not over:
            return target | share
        for s in over:
            target[s] = repeat * sizes[s]
            rest -= target[s]
        free -= over
    return target


def mixed(spark, rows, **options):
    sizes = store(spark)(mixing.word_sizes(docs_frame(spark, rows), "doc_id", "source", "text"), "sizes")
    return sizes, mixing.mix_digest(sizes, store(spark), **options)


def test_sizes_targets_and_taken(spark):
    rows = awkward_rows()
    sizes, got = mixed(spark, rows)
    got = got.collect()
    want = sorted((str(r[0]), len(words_between_spaces(r[1]))) for r in rows)
    assert sorted((str(r.doc_id), r.size) for r in got) == want
    per = {}
    for r in rows:
        per[r[3]] = per.get(r[3], 0) + len(words_between_spaces(r[1]))
    targets = brute_targets(per)
    of = {(str(r[0]), len(words_between_spaces(r[1]))): r[3] for r in rows}
    taken = dict.fromkeys(per, 0)
    for r in got:
        s = of[(str(r.doc_id), r.size)]
        assert r.source_size == per[s] and r.target == pytest.approx(targets[s])
        assert 0 <= r.taken <= 2 * r.size
        taken[s] += r.taken
    assert all(abs(taken[s] - targets[s]) <= 0.5 for s in per)


@pytest.mark.parametrize("seed", range(2))
def test_targets_on_random_sources(spark, seed):
    rng = random.Random(seed)
    rows = [(i, " ".join(["w"] * rng.randint(0, 30)), "en", rng.choice(["a", "b", "B", "é", "z", None, "hot", "hot", "hot"])) for i in range(200)]
    _, got = mixed(spark, rows, ratio=1.9)
    per = {}
    for r in rows:
        per[r[3]] = per.get(r[3], 0) + len(r[1].split())
    targets = brute_targets(per, ratio=1.9)
    source = {r[0]: r[3] for r in rows}
    assert all(r.target == pytest.approx(targets[source[r.doc_id]]) for r in got.collect())


def test_reruns_agree_and_buckets_do_not_matter(spark, monkeypatch):
    rows = [(i, " ".join(["w"] * (i % 17 + 1)), "en", "hot" if i % 3 else f"s{i % 5}") for i in range(300)]
    one = sorted(map(str, mixed(spark, rows)[1].collect()))
    assert one == sorted(map(str, mixed(spark, list(reversed(rows)))[1].collect()))
    monkeypatch.setattr(mixing, "BUCKET_ROWS", 7)
    sizes, got = mixed(spark, rows)
    taken = got.groupBy("source_size", "target").agg(F.sum("taken").alias("n")).collect()
    assert all(abs(r.n - r.target) <= 1 for r in taken)


def test_positions_invert_the_schedule(spark):
    knots = (0.5, 2.0, 1.0)
    shares = np.linspace(0, 1, 41)
    frame = spark.createDataFrame([(float(s),) for s in shares], "s double")
    at = [r[0] for r in frame.select(mixing.schedule_position(F.col("s"), F.lit(0), (knots,))).collect()]
    grid = np.linspace(0, 1, 200_001)
    rate = np.interp(grid, np.linspace(0, 1, 3), knots)
    done = np.concatenate(([0], np.cumsum((rate[1:] + rate[:-1]) / 2)))
    assert np.allclose(np.interp(at, grid, done / done[-1]), shares, atol=1e-4)


def test_mix_returns_whole_copies(spark):
    """Whole texts with their white space; a source's words within half of its largest document of the target."""
    rng = random.Random(6)
    rows = [(i, "\t" + "  \n".join([f"w{i}"] * rng.randint(1, 40)), "en", "a" if i < 60 else "b" if i < 110 else "c") for i in range(130)]
    rows += [(500, " ".join(["long"] * 900), "en", "c")]
    docs = docs_frame(spark, rows)
    sizes = store(spark)(mixing.word_sizes(docs, "doc_id", "source", "text"), "sizes")
    got = mixing.mix(docs, sizes, store(spark))
    assert got.columns == docs.columns
    text, source = {r[0]: r[1] for r in rows}, {r[0]: r[3] for r in rows}
    size = {i: len(words_between_spaces(t)) for i, t in text.items()}
    words, times = {}, {}
    for r in got.collect():
        assert r.text == text[r.doc_id]
        words[r.source] = words.get(r.source, 0) + size[r.doc_id]
        times[r.doc_id] = times.get(r.doc_id, 0) + 1
    assert max(times.values()) <= 2
    targets = brute_targets({s: sum(n for i, n in size.items() if source[i] == s) for s in "abc"})
    for s in "abc":
        assert abs(words.get(s, 0) - targets[s]) <= max(n for i, n in size.items() if source[i] == s) / 2 + 1e-9


def test_equal_positions_have_one_order(spark):
    """Sources of equal sizes and schedules hold equal positions: reruns agree on rows and on the order of the mix."""
    rows = [(i, "one two three", "en", f"s{i % 4}") for i in range(80)]
    runs = []
    for order in (rows, rows[::-1]):
        docs = docs_frame(spark, order)
        sizes = store(spark)(mixing.word_sizes(docs, "doc_id", "source", "text"), "sizes")
        mixed_rows = mixing.mix(docs, sizes, store(spark), schedules=((1.0, 1.0),)).select("doc_id", "source").collect()
        runs.append([tuple(r) for r in mixed_rows])
    assert runs[0] == runs[1]


def test_mix_of_repeated_rows(spark):
    """Rows that repeat an id and text, also in two sources and without id, take what the digest says in sum."""
    rows = [(1, " ".join(["a"] * 10), "en", "a")] * 30 + [(1, " ".join(["a"] * 10), "en", "b")] * 4
    rows += [(None, "b c d", "en", "b")] * 9 + [(None, "b c d", "en", None)] * 3 + [(i, "x y", "en", "b") for i in range(2, 9)]
    docs = docs_frame(spark, rows)
    sizes = store(spark)(mixing.word_sizes(docs, "doc_id", "source", "text"), "sizes")
    got, want = {}, {}
    for r in mixing.mix(docs, sizes, store(spark)).collect():
        got[r.doc_id, r.source] = got.get((r.doc_id, r.source), 0) + len(r.text.split())
    for r in mixing.curriculum(sizes, store(spark), whole=True).collect():
        want[r.id, r.source] = want.get((r.id, r.source), 0) + r.taken
    assert got == {k: v for k, v in want.items() if v}


def test_empty_tables(spark):
    assert mixed(spark, [])[1].count() == 0
    _, got = mixed(spark, [(1, None, "en", "s"), (2, "", "en", None)])
    assert [(r.size, r.target, r.taken) for r in got.collect()] == [(0, 0.0, 0)] * 2
