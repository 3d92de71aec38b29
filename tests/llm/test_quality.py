import random

import numpy as np
from pyspark.sql import functions as F

from tests.llm.helpers import awkward_rows, docs_frame, sentence, store
from vaultmart.llm import quality


def corpus(n=300):
    rng = random.Random(9)
    rows = []
    for i in range(n):
        t = sentence(rng, rng.randint(5, 80))
        good = rng.random() < 0.7
        rows.append((i, t if good else " ".join(w + rng.choice(["$$$", "###", "!!"]) for w in t.split()), int(good)))
    return rows


def fitted(spark, rows):
    docs = docs_frame(spark, [r[:2] for r in rows])
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows], "label_id long, label int")
    stats = quality.document_statistics(docs.join(labels, F.col("doc_id") == F.col("label_id")), keep={"label": F.col("label")})
    return quality.fit(store(spark)(stats, "training"))


def test_held_out_accuracy_and_calibration(spark):
    rows = corpus()
    model = fitted(spark, rows[:200])
    got = {r.doc_id: r.score for r in quality.score(quality.document_statistics(docs_frame(spark, [r[:2] for r in rows])), model).collect()}
    assert all(0 <= s <= 1 for s in got.values())
    assert sum((got[r[0]] >= 0.3) == bool(r[2]) for r in rows[200:]) >= 98
    raw = np.linspace(-1, 2, 500)
    steps = np.interp(model.bins(raw), np.arange(quality.BINS) + 0.5, model.steps)
    assert (np.diff(steps) >= -1e-12).all()


def test_normal_equations_equal_a_direct_fit(spark):
    rows = corpus(120)
    model = fitted(spark, rows)
    x = np.concatenate([quality.statistics([r[1]]) for r in rows])
    z, y = model.features(x), np.array([r[2] for r in rows], float)
    penalty = np.full(z.shape[1], quality.RIDGE * len(rows))
    penalty[-1] = 0
    assert np.allclose(z @ model.weights, z @ np.linalg.solve(z.T @ z + np.diag(penalty), z.T @ y), atol=1e-6)


def test_features_approximate_the_gaussian_kernel():
    model = quality.QualityModel(np.zeros(len(quality.STATISTICS)), np.ones(len(quality.STATISTICS)))
    x = np.random.Generator(np.random.PCG64(1)).normal(0, 1, (30, len(quality.STATISTICS)))
    z = model.features(x)[:, :-1]
    kernel = np.exp(-quality.WIDTH ** 2 * ((x[:, None] - x[None]) ** 2).sum(-1) / 2)
    assert np.abs(z @ z.T - kernel).max() < 0.3


def test_isotonic_against_pairs():
    rng = np.random.Generator(np.random.PCG64(3))
    count = rng.integers(0, 4, 40)
    total = rng.integers(0, count + 1)
    fit = quality.isotonic(total, count)
    assert (np.diff(fit) >= -1e-12).all()
    # brute force: max over starts of the min over ends of block means
    seen = np.flatnonzero(count)
    for i in seen:
        best = max(min(total[a:b + 1].sum() / count[a:b + 1].sum() for b in seen if b >= i) for a in seen if a <= i)
        assert abs(fit[i] - best) < 1e-9


def test_statistics_by_hand():
    s = dict(zip(quality.STATISTICS, quality.statistics(["One two!!\nTWO one one\nOne two!!"])[0]))
    assert np.isclose(s["log_words"], np.log1p(7)) and np.isclose(s["distinct_words"], 4 / 7) and np.isclose(s["distinct_lines"], 2 / 3)
    assert np.isclose(s["symbol_ends"], 2 / 7) and np.isclose(s["short_words"], 5 / 7) and np.isclose(s["upper_words"], 3 / 7)


def test_blocks_do_not_matter():
    texts = [r[1] for r in awkward_rows()]
    whole = quality.statistics(texts)
    assert np.allclose(whole, np.concatenate([quality.statistics([t]) for t in texts]))


def test_awkward_rows_and_filter(spark):
    model = fitted(spark, corpus(120))
    docs = docs_frame(spark, awkward_rows())
    scored = quality.score(quality.document_statistics(docs), model).collect()
    assert len(scored) == docs.count() and all(0 <= r.score <= 1 for r in scored)
    kept = quality.keep_good(docs, model, 0.3)
    assert kept.columns == docs.columns and kept.count() == sum(r.score >= 0.3 for r in scored)


def test_no_labels(spark):
    model = fitted(spark, [])
    assert [r.score for r in quality.score(quality.document_statistics(docs_frame(spark, [(1, "a")])), model).collect()] == [0.5]
    assert quality.keep_good(docs_frame(spark, []), model, 0.3).count() == 0
