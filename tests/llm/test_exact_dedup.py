import hashlib
import random

import pytest

from tests.llm.helpers import awkward_rows, docs_frame, fold, store
from vaultmart.llm.exact_dedup import exact_dedup


def brute(rows):
    groups = {}
    for r in rows:
        groups.setdefault(fold(r[1]), []).append(r[0])
    out = []
    for i, t, *_ in rows:
        ids = groups[fold(t)]
        known = [x for x in ids if x is not None]
        out.append((i, max(known) if known else None, len(ids), hashlib.sha256(fold(t).encode()).hexdigest()))
    return sorted(map(str, out))


def check(spark, rows, block_bytes):
    got = exact_dedup(docs_frame(spark, rows), store(spark), block_bytes=block_bytes).collect()
    assert sorted(str((r.doc_id, r.keep_id, r.group_size, r.text_sha256)) for r in got) == brute(rows)
    assert all(r.doc_id == r.keep_id for r in got if r.kept)
    assert sum(r.kept for r in got) == len({fold(r[1]) for r in rows})
    return got


@pytest.mark.parametrize("block_bytes", [64, 4096])
def test_awkward_rows(spark, block_bytes):
    rng = random.Random(1)
    base = "".join(rng.choice("abAB é") for _ in range(1000))
    rows = awkward_rows() + [(100 + i, base) for i in range(40)] + [(200, base[:-1]), (201, base + "a"), (202, base[:64]), (203, base[:63]),
                                                                       (204, base[:500] + "!" + base[501:]), (205, base.swapcase()),
                                                                       (206, "É"), (207, "é"), (208, base[:64] * 2), (209, base[:64] * 4)]
    check(spark, rows, block_bytes)


def test_block_orders_differ(spark):
    a, b = "a" * 8, "b" * 8
    check(spark, [(1, a + b), (2, b + a), (3, a + b), (4, a), (5, b), (6, a + b + a), (7, a + b + a), (8, a + a)], 8)


def test_empty_table(spark):
    assert exact_dedup(docs_frame(spark, []), store(spark)).count() == 0


def test_no_python_on_the_main_path(spark):
    plan = exact_dedup(docs_frame(spark, [(1, "a")]), store(spark))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan
