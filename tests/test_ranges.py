"""Range operators against brute force (every pair) on random stays,
including intervals that end before they start, same-instant stays,
exact 30-day gaps, bucket boundaries and one member holding most rows."""

import datetime as dt
import random

from vaultmart.operators.ranges import next_start_within, next_start_within_self

DAYS = 30


def _stays(seed, n=400):
    rnd = random.Random(seed)
    base = dt.datetime(2024, 1, 1)
    rows = []
    for i in range(n):
        member = "hot" if rnd.random() < 0.4 else f"m{rnd.randrange(12)}"
        start = base + dt.timedelta(days=rnd.randrange(200), hours=rnd.choice([0, 0, 6, 12]))
        kind = rnd.random()
        if kind < 0.05:
            end = None
        elif kind < 0.1:
            end = start - dt.timedelta(days=rnd.randrange(1, 5))          # ends before it starts
        else:
            end = start + dt.timedelta(days=rnd.choice([0, 1, 3, 30]))
        rows.append((f"e{i}", member, start, end))
    # exact boundary: next start exactly 30 days after a discharge
    rows.append(("b1", "edge", base, base + dt.timedelta(days=1)))
    rows.append(("b2", "edge", base + dt.timedelta(days=31), base + dt.timedelta(days=32)))
    return rows


def _brute(rows):
    out = {}
    for eid, m, s, e in rows:
        if e is None:
            continue
        nxt = [s2 for eid2, m2, s2, e2 in rows
               if m2 == m and eid2 != eid and s2 > e and s2 <= e + dt.timedelta(days=DAYS)]
        out[eid] = min(nxt) if nxt else None
    return out


def test_next_start_within_matches_brute_force(spark):
    for seed in (1, 2):
        rows = _stays(seed)
        df = spark.createDataFrame(rows, "encounter_hk string, member_hk string, s timestamp, e timestamp")
        want = _brute(rows)
        got_self = {r["encounter_hk"]: r["next_start"]
                    for r in next_start_within_self(df, "member_hk", "encounter_hk", "s", "e", DAYS).collect()}
        got_two = {r["encounter_hk"]: r["next_start"]
                   for r in next_start_within(df, df, "member_hk", "encounter_hk", "s", "e", DAYS).collect()}
        assert got_self == want
        assert got_two == want


def test_self_variant_carries_columns(spark):
    rows = _stays(3, 50)
    df = spark.createDataFrame(rows, "encounter_hk string, member_hk string, s timestamp, e timestamp")
    out = next_start_within_self(df, "member_hk", "encounter_hk", "s", "e", DAYS, carry=("s", "e"))
    assert out.columns == ["encounter_hk", "member_hk", "s", "e", "next_start"]
    by_id = {r[0]: (r[1], r[2], r[3]) for r in rows}
    for r in out.collect():
        assert (r["member_hk"], r["s"], r["e"]) == by_id[r["encounter_hk"]]
