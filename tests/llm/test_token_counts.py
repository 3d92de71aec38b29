import random

import pytest

from tests.llm.helpers import awkward_rows, docs_frame
from vaultmart.llm.queries import tokenizer_path
from vaultmart.llm.token_counts import PieceCounter, token_counts


@pytest.fixture(scope="module")
def counter():
    return PieceCounter(tokenizer_path("piece_bpe_32k.model"))


def test_counts_equal_the_library(spark, counter):
    rows = awkward_rows()
    got = token_counts(docs_frame(spark, rows), tokenizer_path("piece_bpe_32k.model"), limit=100).collect()
    want = sorted((str(i), len((t or "").encode()), len(counter.model.encode(t or ""))) for i, t, *_ in rows)
    assert sorted((str(r.doc_id), r.n_bytes, r.n_tokens) for r in got) == want
    assert all(r.over_limit == (r.n_tokens > 100) for r in got)


def test_random_strings(counter):
    rng = random.Random(5)
    letters = " \n\t\r▁ab.<>s/é日本\0'\"{})x01　\xa0\U0001F600"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 40))) for _ in range(3000)]
    texts += ["", "\n", " ", "  ", "▁", "\n\n ", " \n", "<s>", "</s> <unk>"]
    assert counter.count(texts) == [len(x) for x in counter.model.encode(texts)]


def test_long_texts_are_split_at_pre_tokens(counter, monkeypatch):
    monkeypatch.setattr("vaultmart.llm.token_counts.BLOCK_CHARS", 50)
    text = "one  two\nthree four" * 40 + "y" * 300
    assert counter.count([text]) == [len(counter.model.encode(text))]


def test_empty_table(spark):
    assert token_counts(docs_frame(spark, []), tokenizer_path("piece_bpe_32k.model")).count() == 0
