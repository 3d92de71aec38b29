import random

import pytest

from tests.llm.helpers import awkward_rows, docs_frame, fold, store, words_between_spaces
from vaultmart.llm import near_dedup
from vaultmart.llm.components import connected_components


def shingles(text, n):
    w = words_between_spaces(fold(text))
    return {tuple(w[i:i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set())


def brute(rows, n, percent):
    sets = [shingles(r[1], n) for r in rows]
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                parent[root(i)] = root(j)
    ids = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            ids[root(i)] = min(ids.get(root(i), r[0]), r[0])
    return sorted(str((r[0], len(sets[i]), ids.get(root(i)))) for i, r in enumerate(rows))


def edited(rng, words, edits, pool):
    w = list(words)
    for _ in range(edits):
        w[rng.randrange(len(w))] = rng.choice(pool)
    return w


def families(seed, passage=True):
    """Base texts with near copies at many distances, chains, and unrelated texts that share a long passage."""
    rng = random.Random(seed)
    pool = [f"w{i}" for i in range(3000)]
    rows, i = [], 1000
    shared = [rng.choice(pool) for _ in range(60)]
    for _ in range(12):
        base = [rng.choice(pool) for _ in range(rng.choice([4, 12, 40, 150, 400]))]
        for edits in [0, 0, 0, 1, 1, 2, 3, 4, 6, 8, 12, 20]:
            rows.append((i, " ".join(edited(rng, base, edits, pool))))
            i += 1
        chain = base
        for _ in range(6):
            chain = edited(rng, chain, max(1, len(chain) // 60), pool)
            rows.append((i, " ".join(chain)))
            i += 1
    for _ in range(60 if passage else 0):
        own = [rng.choice(pool) for _ in range(rng.choice([5, 10, 20, 100]))]
        rows.append((i, " ".join(own[:3] + shared + own[3:])))
        i += 1
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed,n,percent", [(1, 3, 85), (2, 5, 80)])
def test_against_brute_force(spark, seed, n, percent):
    rows = families(seed) + [r for r in awkward_rows() if r[0] != 26]
    got = near_dedup.near_duplicates(docs_frame(spark, rows), store(spark), n=n, percent=percent).collect()
    assert sorted(str((r.id, r.n_shingles, r.component_id)) for r in got) == brute(rows, n, percent)
    assert all(r.id == r.component_id for r in got if r.kept)


def test_blocks_of_long_lists(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "LIST_BLOCK", 5)
    rows = families(4)
    got = near_dedup.near_duplicates(docs_frame(spark, rows), store(spark), n=3, percent=85).collect()
    assert sorted(str((r.id, r.n_shingles, r.component_id)) for r in got) == brute(rows, 3, 85)


def test_large_group_of_near_copies(spark):
    rng = random.Random(5)
    pool = [f"v{i}" for i in range(500)]
    base = [rng.choice(pool) for _ in range(200)]
    rows = [(i, " ".join(edited(rng, base, rng.randint(0, 3), pool))) for i in range(600)]
    got = near_dedup.near_duplicates(docs_frame(spark, rows), store(spark), n=3, percent=85).collect()
    assert sorted(str((r.id, r.n_shingles, r.component_id)) for r in got) == brute(rows, 3, 85)


def test_keep_one_keeps_whole_rows(spark):
    rows = families(6) + awkward_rows()
    docs = docs_frame(spark, rows)
    kept = near_dedup.keep_one(docs, store(spark), n=5, percent=80)
    assert kept.columns == docs.columns
    groups = {}
    for r, key in zip(sorted(rows, key=lambda r: str((r[0], len(shingles(r[1], 5))))), sorted(brute(rows, 5, 80))):
        groups.setdefault(key.rsplit(", ", 1)[1] if shingles(r[1], 5) else object(), []).append(r[0])
    ids = [r.doc_id for r in kept.collect()]
    want = [min((x for x in g if x is not None), default=None) for g in groups.values()]
    assert sorted(map(str, ids)) == sorted(map(str, want))


def test_empty_tables(spark):
    assert near_dedup.near_duplicates(docs_frame(spark, []), store(spark)).count() == 0
    got = near_dedup.near_duplicates(docs_frame(spark, [(1, None), (2, ""), (3, " ")]), store(spark)).collect()
    assert sorted((r.id, r.n_shingles, r.component_id, r.kept) for r in got) == [(i, 0, i, True) for i in (1, 2, 3)]


@pytest.mark.parametrize("seed", range(2))
def test_components(spark, seed):
    rng = random.Random(seed)
    links = [(rng.randrange(60), rng.randrange(60)) for _ in range(45)] + [(100 + i, 101 + i) for i in range(40)] + [(200, 201 + i) for i in range(30)]
    parent = {x: x for e in links for x in e}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        x, y = root(a), root(b)
        parent[max(x, y)] = min(x, y)
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(links, "a long, b long"), store(spark)).collect()}
    assert got == {x: root(x) for x in parent if root(x) != x}
