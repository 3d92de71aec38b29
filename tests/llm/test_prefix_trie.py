import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from tests.llm.helpers import store

from vaultmart.llm import prefix_trie
from vaultmart.llm.prefix_trie import common_turns, conversation_trie

SCHEMA = "conv_id long, turn int, role string, text string, part long, depth int, `key` string, conv string"


def turns_frame(spark, rows):
    return spark.createDataFrame([(*r, 1, 2, "k", "c") for r in rows], SCHEMA)


def digest(role, text):
    return hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()[:32]


def rebuilt(rows, family=None, heads=9):
    own = defaultdict(list)
    for c, turn, role, text, *_ in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", digest(role or "", text or ""), text or ""))
    convs = {c: [(r, t) for _, _, r, _, t in sorted(turns)] for c, turns in own.items()}
    if not family:
        return convs
    out = {}
    for c, turns in convs.items():
        h = zlib.crc32(str(c).encode()) % heads
        out[c] = convs.get(c - int(c - family * int(c / family)), [])[:h] + turns[h:]
    return out


def brute(convs):
    members = defaultdict(list)
    for c in sorted(convs):
        for d in range(len(convs[c]) + 1):
            members[tuple(convs[c][:d])].append(c)
    leaves, saved, kids = defaultdict(int), defaultdict(int), defaultdict(int)
    for node in members:
        if node:
            kids[node[:-1]] += 1
    for node, who in members.items():
        cost = (len(who) - 1) * len(node[-1][1].encode()) if node else 0
        for d in range(len(node) + 1):
            saved[node[:d]] += cost
            leaves[node[:d]] += node not in kids
    ends = lambda n: ",".join(str(c) for c in members[n] if len(convs[c]) == len(n))
    return sorted((who[0], len(n), members[n[:-1]][0] if n else None, len(who), kids[n], leaves[n], saved[n], hashlib.sha256(ends(n).encode()).hexdigest())
                  for n, who in members.items())


def sample(seed, convs=60, words=3, most=9):
    rng = random.Random(seed)
    rows = []
    for c in range(convs):
        for turn in range(rng.randint(1, most)):
            rows.append((c * 2 - 7, turn, rng.choice(["user", "assistant"]), rng.choice(["a", "é", "long text", "b"][:words])))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize("family", [None, 5])
def test_nodes_equal_brute_force(spark, seed, family):
    rows = sample(seed, words=1 + seed % 4)
    got = conversation_trie(turns_frame(spark, rows), store(spark), family=family).collect()
    assert sorted(map(tuple, got), key=str) == sorted(brute(rebuilt(rows, family)), key=str)


def test_odd_rows(spark):
    long = [(900, t, "user", "same") for t in range(700)] + [(901, t, "user", "same") for t in range(650)]
    rows = sample(9) + long + [(None, 1, "user", "no conversation"), (500, None, None, None), (500, None, "user", "first"), (500, 1, "user", "tie"),
                               (500, 1, "user", "tie"), (500, 1, "assistant", "tie"), (501, 0, "user", ""), (502, 0, "", ""), (503, 0, None, None),
                               (504, 0, "user", "x" * 300_000), (505, 0, "user", "x" * 300_000)]
    rows += [(2_000 + i, t, "user", f"copy {t}") for i in range(300) for t in range(3)]
    got = conversation_trie(turns_frame(spark, rows), store(spark)).collect()
    assert sorted(map(tuple, got), key=str) == sorted(brute(rebuilt(rows)), key=str)
    got = conversation_trie(turns_frame(spark, rows), store(spark), family=5).collect()
    assert sorted(map(tuple, got), key=str) == sorted(brute(rebuilt(rows, 5)), key=str)


def test_few_and_many_partitions(spark):
    rows = sample(11, convs=40)
    convs = prefix_trie.in_order(prefix_trie.turn_digests(turns_frame(spark, rows)))
    want = sorted(brute(rebuilt(rows)), key=str)
    for n in (1, 2, 60):
        assert sorted(map(tuple, prefix_trie.prefix_trie(convs, store(spark), n).collect()), key=str) == want


def test_all_share_their_opening(spark):
    rows = [(c, t, "user", f"t{t}" if t < 3 else f"{c % 4}-{t}") for c in range(50) for t in range(5)]
    got = conversation_trie(turns_frame(spark, rows), store(spark)).collect()
    assert sorted(map(tuple, got), key=str) == sorted(brute(rebuilt(rows)), key=str)


def test_empty_table(spark):
    assert conversation_trie(turns_frame(spark, []), store(spark), family=5).count() == 0


def test_no_text_in_a_shuffle(spark):
    frame = prefix_trie.in_order(prefix_trie.turn_digests(turns_frame(spark, sample(1))))
    plan = frame._jdf.queryExecution().optimizedPlan().toString()
    assert "collect_list" in plan and not [line for line in plan.split("\n") if "Aggregate" in line and "text" in line]


def test_common_turns():
    rng = random.Random(2)
    for _ in range(300):
        a, b = (b"".join(bytes([rng.randint(0, 1)]) * 16 for _ in range(rng.randint(0, 9))) for _ in range(2))
        want = next((i for i in range(min(len(a), len(b)) // 16) if a[16 * i:16 * i + 16] != b[16 * i:16 * i + 16]), min(len(a), len(b)) // 16)
        assert common_turns(a, b) == want
    a = b"x" * 16 * 5000
    assert common_turns(a + b"a" * 16, a + b"b" * 16) == 5000
