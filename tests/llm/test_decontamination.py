import random
import re

import pytest

from tests.llm.helpers import WORDS, awkward_rows, docs_frame, fold, sentence, store
from vaultmart.llm.decontamination import contamination, keep_clean


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", fold(text))


def brute(rows, items, window=10):
    wins = set()
    for item, text in items:
        w = words(text)
        size = min(window, len(w))
        wins |= {(item, tuple(w[i:i + size])) for i in range(len(w) - size + 1 if size else 0)}
    out = []
    for i, text, *_ in rows:
        w, hit, found = words(text), set(), set()
        for item, win in wins:
            for p in range(len(w) - len(win) + 1):
                if tuple(w[p:p + len(win)]) == win:
                    hit |= set(range(p, p + len(win)))
                    found.add(str(item))
        out.append((i, len(w), len(hit), sorted(found)))
    return sorted(map(str, out))


def items_frame(spark, items):
    return spark.createDataFrame([(i, t, 1, "w") for i, t in items], "item_id long, text string, row int, words string")


@pytest.mark.parametrize("seed", range(2))
def test_against_brute_force(spark, seed):
    rng = random.Random(seed)
    items = [(i, sentence(rng, rng.choice([10, 11, 14, 30]))) for i in range(6)]
    items += [(20, "Alpha beta"), (21, "gamma"), (22, ""), (23, None), (24, "!!"), (25, items[0][1]), (26, "Zürich été alpha"), (27, "never seen words here"),
              (None, "quiet paper light")]
    rows = [r if r[0] not in (26,) else (26, sentence(rng, 400)) for r in awkward_rows(seed)]
    for k in range(12):
        text = items[rng.randrange(6)][1]
        w = text.split()
        cut = w[rng.randint(0, 3):len(w) - rng.randint(0, 3)]
        rows.append((300 + k, sentence(rng, rng.randint(0, 9)) + " " + " ".join(cut).upper().replace(" ", "  ") + "; " + sentence(rng, 5)))
    rows += [(400, items[0][1]), (401, items[0][1] + " " + items[0][1]), (402, " ".join(WORDS) * 2)]
    got = contamination(docs_frame(spark, rows), items_frame(spark, items), store(spark))["documents"].collect()
    want = brute(rows, [(i, t) for i, t in items if i is not None] + [(None, "quiet paper light")])
    own = sorted(str((r.id, r.n_words, r.n_hit, sorted(r["items"]))) for r in got)
    assert own == sorted(x.replace(", 'None'", "").replace("'None', ", "").replace("'None'", "") for x in want)


def test_keep_clean(spark):
    rng = random.Random(8)
    item = sentence(rng, 20)
    rows = awkward_rows() + [(500, "x " + item), (501, item), (None, item), (502, item[:40])]
    docs = docs_frame(spark, rows)
    kept = keep_clean(docs, items_frame(spark, [(1, item)]), store(spark))
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(r[0]) for r in rows if item not in (r[1] or ""))


def test_empty_tables(spark):
    docs = docs_frame(spark, awkward_rows())
    got = contamination(docs, items_frame(spark, []), store(spark))["documents"]
    assert got.count() == docs.count() and got.where("n_hit > 0").count() == 0
    assert contamination(docs_frame(spark, []), items_frame(spark, [(1, "a b c")]), store(spark))["documents"].count() == 0
