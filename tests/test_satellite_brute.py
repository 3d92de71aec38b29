"""Satellite loader against brute force on random batches: several rows per
(key, instant), a hot key, narrow time buckets (so versions cross bucket
boundaries) and a target holding earlier versions."""

import datetime as dt
import random

from vaultmart.operators.vault import new_satellite_rows

SCHEMA = "hk string, hd string, p string, load_dts timestamp, record_source string"


def _rows(seed, n=500):
    rnd = random.Random(seed)
    base = dt.datetime(2024, 1, 1)
    out = []
    for _ in range(n):
        hk = "hot" if rnd.random() < 0.4 else f"k{rnd.randrange(15)}"
        hd = rnd.choice("ABC")
        out.append((hk, hd, f"p-{hd}-{rnd.randrange(2)}", base + dt.timedelta(days=rnd.randrange(120)),
                    rnd.choice(["s1", "s2"])))
    out.append((None, "A", "p", base, "s1"))                  # no key: ignored
    return out


def _brute(batch, target):
    cur = {}
    for hk, hd, p, ts, rs in target:
        if hk not in cur or (ts, hd) > cur[hk]:
            cur[hk] = (ts, hd)
    reps = {}
    for hk, hd, p, ts, rs in batch:
        if hk is None or ts is None or (hk in cur and ts <= cur[hk][0]):
            continue
        key = (hk, ts)
        cand = (hd, rs, p)
        if key not in reps or cand < reps[key]:
            reps[key] = cand
    out = set()
    prev = {hk: v[1] for hk, v in cur.items()}
    for (hk, ts), (hd, rs, p) in sorted(reps.items()):
        if prev.get(hk) != hd:
            out.add((hk, hd, p, ts, rs))
        prev[hk] = hd
    return out


def test_satellite_matches_brute_force(spark):
    for seed in (7, 8):
        batch = _rows(seed)
        target = [r for r in _rows(seed + 100, 60) if r[0] is not None]
        for tgt in (None, target):
            got = new_satellite_rows(spark.createDataFrame(batch, SCHEMA), "hk", "hd", ["p"],
                                     spark.createDataFrame(tgt, SCHEMA) if tgt else None,
                                     bucket_seconds=7 * 86400)
            assert {tuple(r) for r in got.select("hk", "hd", "p", "load_dts", "record_source").collect()} \
                == _brute(batch, tgt or [])
