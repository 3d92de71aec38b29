import hashlib
import random

import numpy as np
import pytest
import sentencepiece
from tests.llm.helpers import awkward_rows, docs_frame

from vaultmart.llm import piece_codec
from vaultmart.llm.piece_codec import PieceCodec, codec_digests, decode_pieces, encode_pieces
from vaultmart.llm.queries import tokenizer_path

MODEL = tokenizer_path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


@pytest.fixture(scope="module")
def codec():
    return PieceCodec(MODEL)


def ids_of(codec, texts):
    return [np.frombuffer(x, "<u4").tolist() for x in codec.encode(texts)]


def odd_texts(seed=1, n=3000):
    rng = random.Random(seed)
    letters = " \n\t\r▁ab.<>s/é日本\0'\"{})x01　\xa0\U0001F600\x1f\x7fthe"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 40))) for _ in range(n)]
    texts += ["".join(rng.choice(["the ", "un", "believ", "able", " ", "ing", "  ", "ab", "aba", "er"]) for _ in range(20)) for _ in range(n)]
    texts += ["".join(chr(rng.choice([rng.randint(32, 0x2ff), rng.randint(0x370, 0xd7ff), rng.randint(0xe000, 0x1ffff)])) for _ in range(12)) for _ in range(n)]
    texts += ["", "\n", " ", "  ", "▁", "\n\n ", " \n", "<s>", "</s> <unk>", "<0x41>", "aaaaaaa" * 9, "abababab" * 9, "=" * 100, "-" * 333, "x" * 999]
    texts += [" " * k for k in range(80)] + [" " * k + "the" for k in range(80)] + ["a" + " " * k + "\n" for k in range(40)]
    return texts


def test_ids_equal_the_library(codec, library):
    texts = odd_texts()
    assert ids_of(codec, texts) == library.encode(texts)


def test_decoding_equals_the_library(codec, library):
    rng = random.Random(4)
    own = [[1, *x, 2] for x in library.encode(odd_texts(2, 500))]
    wild = [[rng.choice([rng.randint(0, 300), rng.randint(0, 31999)]) for _ in range(rng.randint(0, 12))] for _ in range(3000)]
    for ids in own + wild:
        assert codec.decode(np.asarray(ids, np.int64)).decode() == library.decode(ids), ids


def test_long_texts_are_cut_into_words(codec, library, monkeypatch):
    monkeypatch.setattr(piece_codec, "BLOCK_CHARS", 60)
    texts = ["one  two\nthree four " * 60 + "y" * 500, " " * 700 + "z", "w" * 300, "a b"]
    assert ids_of(codec, texts) == library.encode(texts)


def test_a_very_long_word(codec, library):
    rng = random.Random(8)
    texts = ["".join(rng.choice("abcdefghinorst") for _ in range(20_000)), "日本" * 10_000, "é" * 30_001, " " * 50_000]
    assert ids_of(codec, texts) == library.encode(texts)


def test_rows_and_round_trip(spark, library):
    rows = awkward_rows()
    docs = docs_frame(spark, rows)
    got = codec_digests(docs, MODEL).collect()
    sha = lambda x: hashlib.sha256(x).hexdigest()
    want = []
    for i, text, *_ in rows:
        ids = [1, *library.encode(text or ""), 2]
        want.append((str(i), len(ids), sha(np.asarray(ids, "<u4").tobytes()), sha(library.decode(ids).encode())))
    assert sorted((str(r.doc_id), *r[1:]) for r in got) == sorted(want)
    encoded = encode_pieces(docs, MODEL, begin=False, end=False)
    back = decode_pieces(encoded, MODEL)
    assert sorted((str(r.doc_id), r.text) for r in back.collect()) == sorted((str(i), t or "") for i, t, *_ in rows)


def test_empty_table(spark):
    assert codec_digests(docs_frame(spark, []), MODEL).count() == 0
