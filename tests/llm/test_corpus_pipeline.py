"""Every stage of the pipeline against a brute-force version of its decision, on the smallest driver tables."""

import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

import corpus_pipeline as cp
from tests.llm.helpers import docs_frame, store, words_between_spaces
from tests.llm.test_decontamination import brute as brute_hits
from tests.llm.test_mixing import brute_targets
from tests.llm.test_near_dedup import brute as brute_classes
from vaultmart.llm import quality
from vaultmart.llm.common import read_table
from vaultmart.llm.queries import tokenizer_path

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    """Stage name -> (rows in, rows out)."""
    docs, out = read_table(spark, SF, "documents"), {}
    for name, stage in cp.STAGES:
        after = store(spark)(stage(spark, docs, SF), name)
        out[name] = (docs, after)
        docs = after
    return out


def pairs(frame):
    return [(r.doc_id, r.text) for r in frame.select("doc_id", "text").collect()]


def test_columns_and_names(stages):
    assert [n for n, _ in cp.STAGES] == ["quality", "near_dedup", "decontamination", "mixing", "token_ids"]
    for name in list(stages)[:-1]:
        assert stages[name][1].columns == stages[name][0].columns
    assert all(a.count() > 0 for _, a in stages.values())


def test_quality(spark, stages):
    before, after = stages["quality"]
    kept = {r.doc_id for r in after.select("doc_id").collect()}
    label = {r.doc_id: r.quality for r in read_table(spark, SF, "labels").collect()}
    bad = [i for i, q in label.items() if q == 0]
    good = [i for i, q in label.items() if q == 1]
    assert sum(i in kept for i in good) >= 0.95 * len(good) and sum(i in kept for i in bad) <= 0.3 * len(bad)
    train = [(t, label[i]) for i, t in pairs(before) if i in label and zlib.crc32(str(i).encode()) % 5]
    x, y = np.concatenate([quality.statistics([t]) for t, _ in train]), np.array([q for _, q in train], float)
    model = quality.QualityModel(x.mean(0), np.maximum(x.std(0), 1e-6))
    z = model.features(x)
    penalty = np.full(z.shape[1], quality.RIDGE * len(y))
    penalty[-1] = 0
    model.weights, model.low, model.high = np.linalg.solve(z.T @ z + np.diag(penalty), z.T @ y), -0.25, 1.25
    at = model.bins(model.raw(x)).astype(int)
    model.steps = quality.isotonic(np.bincount(at, y, quality.BINS), np.bincount(at, minlength=quality.BINS))
    assert kept == {i for i, t in pairs(before) if model.score(quality.statistics([t]))[0] >= cp.MIN_SCORE}


def test_near_dedup(stages):
    before, after = stages["near_dedup"]
    want = {eval(x)[2] for x in brute_classes(pairs(before), 5, 80)}  # noqa: S307  (tuples printed by the brute-force version)
    assert sorted(i for i, _ in pairs(after)) == sorted(want)


def test_decontamination(spark, stages):
    before, after = stages["decontamination"]
    items = [(r.item_id, r.text) for r in read_table(spark, SF, "benchmark").collect()]
    hit = {eval(x)[0] for x in brute_hits(pairs(before), items) if eval(x)[2]}  # noqa: S307
    assert sorted(i for i, _ in pairs(after)) == sorted(i for i, _ in pairs(before) if i not in hit)


def test_mixing(stages):
    """Whole rows only; the words of a source end within half of its largest document of the target."""
    before, after = stages["mixing"]
    size, taken, whole, largest = {}, {}, {}, {}
    for r in before.collect():
        n = len(words_between_spaces(r.text))
        size[r.source] = size.get(r.source, 0) + n
        largest[r.source] = max(largest.get(r.source, 0), n)
        whole[r.doc_id] = r
    times = {}
    for r in after.collect():
        taken[r.source] = taken.get(r.source, 0) + len(words_between_spaces(r.text))
        times[r.doc_id] = times.get(r.doc_id, 0) + 1
        assert r == whole[r.doc_id]
    assert max(times.values()) <= 2
    targets = brute_targets(size)
    assert all(abs(taken.get(s, 0) - targets[s]) <= largest[s] / 2 + 1e-9 for s in size)


def test_token_ids(stages):
    before, after = stages["token_ids"]
    own, start, want = Tokenizer.from_file(tokenizer_path("word_bpe_49k.json")), 0, []
    for i, t in sorted(pairs(before)):
        ids = own.encode(t, add_special_tokens=False).ids + [cp.END_ID]
        want.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert sorted((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in after.collect()) == sorted(want)


def test_run_is_the_stages(spark, stages):
    assert sorted(map(tuple, cp.run(spark, SF).collect())) == sorted(map(tuple, stages["token_ids"][1].collect()))


def test_stages_on_awkward_rows(spark):
    """Null, empty, repeated and very long rows, rows without id and clashing columns pass through every stage without harm."""
    from pyspark.sql import functions as F

    from tests.llm.helpers import awkward_rows

    clashing = {c: F.lit("x") for c in ("label", "label_id", "quality", "score", "id", "size", "copies", "position")}
    docs = docs_frame(spark, awkward_rows()).withColumns(clashing)
    for name, stage in cp.STAGES:
        after = store(spark)(stage(spark, docs, SF), "stage")
        assert name == "token_ids" or after.columns == docs.columns
        docs = after
    assert docs.count() > 0
    empty = docs_frame(spark, []).withColumns(clashing)
    for _, stage in cp.STAGES:
        empty = store(spark)(stage(spark, empty, SF), "stage")
    assert empty.count() == 0
