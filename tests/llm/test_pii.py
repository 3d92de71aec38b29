import random
import re

import pytest

from tests.llm.helpers import awkward_rows, docs_frame, sentence, store
from vaultmart.llm.pii import KINDS, base_spans, loose_spans, luhn, personal_data
from vaultmart.llm.queries import op4_pii

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def brute(text):
    out = []
    for k, kind in enumerate(KINDS):
        for m in re.finditer(PLAIN[kind], text):
            digits = re.sub("[^0-9]", "", m[0])
            ok = {"email": True, "ip": all(int(p) <= 255 for p in m[0].split(".")) if kind == "ip" else True,
                  "card": 13 <= len(digits) <= 19 and luhn(digits), "phone": 9 <= len(digits) <= 15}[kind]
            if ok:
                out.append((k, *m.span()))
    return out


@pytest.mark.parametrize("seed", range(4))
def test_base_spans_equal_the_plain_patterns(seed):
    rng = random.Random(seed)
    bits = ["a", "B9", ".", "..", "@", "@@", "x.y", "com", "-", " ", "+", "+1", "(", ")", "255", "256", "1.2.3.4", "007", "4111111111111111", "é", "_", "%",
            "4111 1111-1111 1111", "5", "12", "1234567", "\n", "a@b.c"]
    for _ in range(3000):
        text = "".join(rng.choice(bits) for _ in range(rng.randint(1, 14)))
        assert base_spans(text) == brute(text), text


def test_long_runs_take_linear_time():
    for text in ("a" * 300_000, "1" * 300_000, "a@" * 50_000, "1." * 50_000, "+1" * 50_000, "@" * 100_000, "1 " * 100_000):
        base_spans(text)


def test_known_spans_and_awkward_rows(spark):
    rows = awkward_rows() + [(600, "é mail bob.1@mail2.example.com now, +1 (456) 555-2186; 4111 1111 1111 1111 at 10.0.0.255 not 10.0.0.256")]
    got = {str(r.id) + str(i): r for i, r in enumerate(personal_data(docs_frame(spark, rows), store(spark)).collect())}
    assert len(got) == len(rows)
    want = brute(rows[-1][1])
    mine = next(r for r in got.values() if r.id == 600)
    assert [tuple(s) for s in mine.base] == sorted(want) and len(want) == 4
    assert all(r.base == [] and r.spans == [] for r in got.values() if r.id != 600)


def test_trusted_words_find_unseen_identifiers(spark):
    """Seeds behind 'reach me at' make the words a pattern; the odd formats behind them are found, the same formats elsewhere are not."""
    rng = random.Random(6)
    rows = [(i, f"{sentence(rng, 6)} hotline number: +1 ({200 + i}) 555-{1000 + i} {sentence(rng, 4)}") for i in range(12)]
    rows += [(50, "river hotline number: (212) 555-0188 stone"), (51, "river stone (212) 555-0188 stone"),
             (52, "the hotline number is unknown"), (53, "license 2.0.1 of 1234567 paper")]
    got = {r.id: r for r in personal_data(docs_frame(spark, rows), store(spark)).collect()}
    start = rows[12][1].index("(212)")
    assert [tuple(s) for s in got[50].spans] == [(3, start, start + len("(212) 555-0188"))]
    assert not got[51].spans and not got[52].spans and not got[53].spans
    assert all(len(got[i].base) == 1 and got[i].spans == got[i].base for i in range(12))


def test_words_that_mostly_stand_elsewhere_are_not_trusted(spark):
    rng = random.Random(6)
    rows = [(i, f"stone river +1 ({200 + i}) 555-{1000 + i}") for i in range(6)]
    rows += [(20 + i, f"stone river {sentence(rng, 3)}") for i in range(40)] + [(99, "stone river (212) 555-0188")]
    got = {r.id: r for r in personal_data(docs_frame(spark, rows), store(spark)).collect()}
    assert not got[99].spans


def brute_spans(texts, support=5, trust=0.8):
    """The whole operator with plain words and loops: contexts, counts, scores by rounds, added spans."""
    words = [[(m.start(), m.end(), m[0].lower()) for m in re.finditer(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", t or "")] for t in texts]
    count = {}
    for w in words:
        for n in (1, 2):
            for i in range(len(w) - n + 1):
                key = tuple(x[2] for x in w[i:i + n])
                count[key] = count.get(key, 0) + 1
    spans = []
    for d, t in enumerate(texts):
        base = base_spans(t) if t else []
        for s, seed in [(s, True) for s in base] + [(s, False) for s in (loose_spans(t, base) if t else [])]:
            before, behind = [x[2] for x in words[d] if x[1] <= s[1]], [x[2] for x in words[d] if x[0] >= s[2]]
            own = [(0, tuple(before[-1:]))] * (len(before) > 0) + [(1, tuple(before[-2:]))] * (len(before) > 1)
            own += [(2, tuple(behind[:1]))] * (len(behind) > 0) + [(3, tuple(behind[:2]))] * (len(behind) > 1)
            spans.append((d, s, seed, t[s[1]:s[2]].lower(), [(s[0], *c) for c in own]))
    edges, uses, seeds = {}, {}, set()
    for _, s, seed, text, contexts in spans:
        if seed:
            seeds.add((s[0], text))
        for c in contexts:
            edges.setdefault(c, set()).add((s[0], text))
            uses[c] = uses.get(c, 0) + 1
    weight = {c: len(i) + max(count.get(c[2], 0), uses[c]) - uses[c] for c, i in edges.items() if len(i) >= support}
    # a text that is a seed in one place and a candidate in another is a seed wherever one of its edges is
    score, trusted, rounds = {}, {}, 0
    while True:
        for i in {i for c in weight for i in edges[c]}:
            doubt = 1.0
            for c in trusted:
                if i in edges[c]:
                    doubt *= 1 - min(trusted[c], 0.999999)
            score[i] = 1.0 if i in seeds else 1 - doubt
        now = {c: sum(score[i] for i in edges[c]) / w for c, w in weight.items()}
        now = {c: v for c, v in now.items() if v >= trust and sum(score[i] >= trust for i in edges[c]) >= support}
        if len(now) == len(trusted):
            break
        trusted, rounds = now, rounds + 1
    out = [set() for _ in texts]
    for d, s, seed, _, contexts in spans:
        if seed or any(c in trusted for c in contexts):
            out[d].add(s)
    return [sorted(x) for x in out], rounds


def chained_texts():
    """Seeds make 'hotline' a pattern; what it finds stands before 'evenings', which finds what stands before it elsewhere."""
    rng = random.Random(9)
    rows = [f"{sentence(rng, 5)} hotline +1 ({200 + i}) 555-{1000 + i} today" for i in range(100)]
    rows += [f"{sentence(rng, 5)} hotline ({300 + i}) 555-{2000 + i} evenings only {sentence(rng, 3)}" for i in range(10)]
    rows += [f"{sentence(rng, 5)} dial ({400 + i}) 555-{3000 + i} evenings only" for i in range(1)]
    rows += [f"{sentence(rng, 5)} dial ({500 + i}) 555-{4000 + i} {sentence(rng, 3)}" for i in range(6)]
    rows += [f"licence ({600 + i}) 555-{5000 + i} {sentence(rng, 2)}" for i in range(9)] + [None, ""]
    return rows


def test_identifiers_found_induce_patterns_of_their_own(spark):
    texts = chained_texts()
    want, rounds = brute_spans(texts)
    got = {r.id: [tuple(s) for s in r.spans] for r in personal_data(docs_frame(spark, list(enumerate(texts))), store(spark)).collect()}
    assert [got[i] for i in range(len(texts))] == want
    assert rounds >= 2 and all(want[:111]) and not any(want[111:])    # behind 'evenings only', never behind 'licence'


@pytest.mark.parametrize("seed", range(2))
def test_the_graph_equals_brute_force(spark, seed):
    rng = random.Random(seed)
    cue, shapes = ["call", "fax", "mail", "ref", "from host", "card no"], [
        lambda: f"+1 ({rng.randint(200, 215)}) 555-{rng.randint(1000, 1009)}", lambda: f"({rng.randint(200, 230)}) 555-{rng.randint(1000, 1099)}",
        lambda: f"u{rng.randint(1, 30)}@mail.example.com", lambda: f"u{rng.randint(1, 30)} at mail dot example dot com",
        lambda: f"10.0.0.{rng.randint(1, 40)}", lambda: f"10,0,0,{rng.randint(1, 40)}", lambda: "stone"]
    texts = [" ".join(f"{cue[k]} {shapes[min(6, max(0, k + rng.choice([0, 0, 0, 1])))]()} {rng.choice(['', 'today', 'now or never'])}"
                      for k in (rng.randrange(6) for _ in range(3))) for _ in range(90)]
    want, _ = brute_spans(texts)
    got = {r.id: [tuple(s) for s in r.spans] for r in personal_data(docs_frame(spark, list(enumerate(texts))), store(spark)).collect()}
    assert [got[i] for i in range(len(texts))] == want


def test_empty_table(spark):
    assert personal_data(docs_frame(spark, []), store(spark)).count() == 0


def test_query_counts_every_kind_wherever_it_stands(spark, tmp):
    """The counts of the query are those of the kinds, not of the places in the list of spans."""
    rows = [(1, "call +49 170 1234567 now"), (2, "card 4111 1111 1111 1111"), (3, "10.0.0.1 and 10.0.0.2"), (4, "a@b.c d@e.f 10.0.0.1 +49 170 1234567"),
            (5, None), (6, "")]
    docs_frame(spark, rows).write.parquet(f"{tmp}/documents.parquet")
    got = {r.doc_id: (r.n_email, r.n_ip, r.n_card, r.n_phone) for r in op4_pii(spark, tmp).collect()}
    assert got == {1: (0, 0, 0, 1), 2: (0, 0, 1, 0), 3: (0, 2, 0, 0), 4: (2, 1, 0, 1), 5: (0, 0, 0, 0), 6: (0, 0, 0, 0)}
