import random

import numpy as np
import pytest

from tests.llm.helpers import docs_frame, store
from vaultmart.llm import language_id as li

SOUNDS = {"aa": "ka ta mo ri ne shi".split(), "bb": "sch ung ein ver keit der".split(), "cc": "tion eux elle oir ment que".split()}


def text(rng, lang, n):
    return " ".join("".join(rng.choice(SOUNDS[lang]) for _ in range(rng.randint(1, 3))) for _ in range(n))


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(2)
    return [(i, text(rng, lang, rng.randint(3, 40)), lang, "s") for i, lang in enumerate(rng.choice(sorted(SOUNDS)) for _ in range(300))]


@pytest.fixture(scope="module")
def model(spark, corpus):
    return li.train(docs_frame(spark, corpus[:200]).select("lang", "text"), store(spark))


def test_held_out_accuracy(spark, corpus, model):
    got = {r.doc_id: r for r in li.identify(docs_frame(spark, corpus), model).collect()}
    held = corpus[200:]
    assert sum(got[r[0]].lang_pred == r[2] for r in held) >= 0.99 * len(held)
    assert all(0 <= r.score <= 1 for r in got.values())


def test_filter_gives_all_languages_of_a_gram(spark, corpus, model):
    """Votes of the bit-sliced filter against plain sets of trigrams, corrected for false positives."""
    counts = {}
    for _, t, lang, _ in corpus[:200]:
        for g in li.trigrams([t])[0].tolist():
            counts.setdefault(lang, {}).setdefault(g, 0)
            counts[lang][g] += 1
    share = {lang: {g: n / sum(c.values()) for g, n in c.items()} for lang, c in counts.items()}
    top = {}
    for c in share.values():
        for g, s in c.items():
            top[g] = max(top.get(g, 0), s)
    typical = {lang: {g for g, s in c.items() if s >= 0.25 * top[g]} for lang, c in share.items()}
    n, votes = model.votes([corpus[250][1]])
    grams = li.trigrams([corpus[250][1]])[0].tolist()
    assert n[0] == len(grams) and len(votes) == 2 * len(model.langs)
    for i, lang in enumerate(model.langs):
        for at, member in ((i, set(counts[lang])), (i + len(model.langs), typical[lang])):
            exact = sum(g in member for g in grams)
            assert exact <= votes[at, 0] <= exact + 1 + 0.01 * len(grams)   # no false negatives, few false positives
    every = li.trigrams([" ".join(t for _, t, _, _ in corpus[:200])])[0]
    masks = np.bitwise_and.reduce([model.rows[p, 0] for p in li._positions(every, len(model.rows))])
    for i, lang in enumerate(model.langs):                                  # every trigram seen in a language is inserted
        assert all(m >> i & 1 for g, m in zip(every.tolist(), masks.tolist()) if g in counts[lang])


def test_predictions_equal_brute_force(spark, corpus, model):
    """Plain sets of trigrams instead of the filter: same winner wherever it leads by more than false positives can make."""
    counts = {lang: {} for lang in model.langs}
    for _, t, lang, _ in corpus[:200]:
        for g in li.trigrams([t])[0].tolist():
            counts[lang][g] = counts[lang].get(g, 0) + 1
    share = {lang: {g: n / sum(c.values()) for g, n in c.items()} for lang, c in counts.items()}
    top = {g: max(c.get(g, 0) for c in share.values()) for c in share.values() for g in c}
    got = {r.doc_id: r.lang_pred for r in li.identify(docs_frame(spark, corpus), model).collect()}
    for i, t, *_ in corpus:
        grams = li.trigrams([t])[0].tolist()
        score = {lang: sum((g in c) + (c.get(g, 0) >= 0.25 * top.get(g, 1)) for g in grams) for lang, c in share.items()}
        best, second = sorted(score.values(), reverse=True)[:2]
        assert best - second < 3 or score[got[i]] == best


def test_ties_go_to_the_first_language(spark):
    model = li.train(docs_frame(spark, [(1, "same words", "zz"), (2, "same words", "mm"), (3, "same words", "pp")]).select("lang", "text"), store(spark))
    assert [r.lang_pred for r in li.identify(docs_frame(spark, [(1, "same words")]), model).collect()] == ["mm"]


def test_awkward_texts(spark, model):
    rows = [(1, None), (2, ""), (3, "12 34 -- !!"), (4, "\U0001F600"), (5, "жук"), (6, "x"), (None, "schung keit"), (6, "x"), (7, "SCHUNG KEIT VEREIN")]
    got = sorted((str(r.doc_id), r.lang_pred, r.score) for r in li.identify(docs_frame(spark, rows), model).collect())
    of = dict((i, (lang, s)) for i, lang, s in got)
    assert [of[str(i)] for i in (1, 2, 3, 4)] == [("und", 0.0)] * 4
    assert of["5"] == (model.langs[model.usual], 0.0) and len(got) == len(rows)
    assert of["None"][0] == "bb" and of["7"][0] == "bb"


def test_long_texts_in_pieces(model, monkeypatch):
    t = text(random.Random(4), "cc", 3000)
    whole = model.votes([t])
    parts = [model.votes(p, lead, tail) for _, p, lead, tail in li.pieces([t], 500)]
    assert len(parts) > 5
    assert sum(p[0][0] for p in parts) == whole[0][0] and np.array_equal(sum(p[1] for p in parts), whole[1])


def test_long_runs_of_letters_are_cut_without_loss():
    rng = random.Random(5)
    t = "".join(rng.choice("abcdéж") for _ in range(5000)) + " end " + "ÀB" * 1500 + "x"
    grams = np.concatenate([li.piece_trigrams(p, lead, tail)[0] for _, p, lead, tail in li.pieces([t], 300)])
    assert np.array_equal(grams, li.trigrams([t])[0])


def test_no_training_rows(spark):
    model = li.train(docs_frame(spark, [(1, "abc", None), (2, None, "en")]).select("lang", "text"), store(spark))
    assert [r.lang_pred for r in li.identify(docs_frame(spark, [(1, "abc")]), model).collect()] == ["und"]
    assert li.identify(docs_frame(spark, []), model).count() == 0


def test_many_languages(spark):
    """70 languages have 140 slices: three mask words."""
    rng = random.Random(7)
    rows = [(i, " ".join(chr(0x4E00 + 40 * lang + rng.randint(0, 5)) * 3 for _ in range(20)), f"l{lang:02d}", "s") for i, lang in enumerate(list(range(70)) * 2)]
    model = li.train(docs_frame(spark, rows).select("lang", "text"), store(spark))
    assert model.rows.shape[1] == 3
    assert all(r.lang_pred == f"l{r.doc_id % 70:02d}" for r in li.identify(docs_frame(spark, rows), model).collect())
