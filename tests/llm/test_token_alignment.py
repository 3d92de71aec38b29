import bisect
import hashlib
import random
from collections import Counter, defaultdict

import pytest
import sentencepiece
from tests.llm.helpers import awkward_rows, docs_frame, store
from tokenizers import Tokenizer

from vaultmart.llm import token_alignment
from vaultmart.llm.queries import tokenizer_path
from vaultmart.llm.token_alignment import Aligner, token_alignment as align_documents

BYTE, PIECE = tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def libraries():
    a = Tokenizer.from_file(BYTE)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=PIECE)


def letters():
    """Bytes of the byte-level alphabet by asking for its printable part and numbering the rest."""
    taken = [*range(33, 127), *range(161, 173), *range(174, 256)]
    table, n = {chr(b): b for b in taken}, 256
    for b in range(256):
        if b not in taken:
            table[chr(n)] = b
            n += 1
    return table


def brute_groups(libraries, text):
    a, b = libraries
    if not text:
        return []
    table = letters()
    ids_a, ids_b = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
    bytes_a = [bytes(table[c] for c in a.id_to_token(i)) for i in ids_a]
    bytes_b = [bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode() for i in ids_b for p in [b.id_to_piece(i)]]
    if not b"".join(bytes_a) == b"".join(bytes_b) == (" " + text).encode():
        return []
    def ends(parts):
        at, out = 0, []
        for p in parts:
            at += len(p)
            out.append(at)
        return out
    ends_a, ends_b = ends(bytes_a), ends(bytes_b)
    common = sorted(set(ends_a) & set(ends_b))
    groups = [([], []) for _ in common]
    for side, (ids, at) in enumerate(((ids_a, ends_a), (ids_b, ends_b))):
        for i, e in zip(ids, at):
            groups[bisect.bisect_left(common, e)][side].append(i)
    return groups


def brute(libraries, rows):
    groups = [brute_groups(libraries, t) for _, t, *_ in rows]
    links = [Counter((x, y) for left, right in g for x in left for y in right) for g in groups]
    counts = Counter(p for n in links for p in n)
    best = defaultdict(int)
    for (x, _), n in counts.items():
        best[x] = max(best[x], n)
    spelled = [";".join(f"{','.join(map(str, x))}|{','.join(map(str, y))}" for x, y in g) for g in groups]
    return sorted((str(r[0]), sum(len(x) for x, _ in g), sum(len(y) for _, y in g), len(g), sum(n.values()),
                   sum(k for p, k in n.items() if counts[p] == best[p[0]]), sum(k * counts[p] for p, k in n.items()),
                   hashlib.sha256(s.encode()).hexdigest() if g else "") for r, g, n, s in zip(rows, groups, links, spelled))


def odd_rows(seed=2, n=250):
    rng = random.Random(seed)
    pool = [" ", "  ", "\n", "\t", "\r\n", "\xa0", "　", "'s", "'ll", "the", "The", "word", "é", "日本", "\U0001F600", "123", "4", "!?", "<|endoftext|>",
            "<s>", "\0", "\x1c", "\x1f", "\x85", " ", "naïve", "ab", "=====", "xxxxxxx", "don't", "\x7f", "́"]
    rows = [(1000 + i, "".join(rng.choice(pool) for _ in range(rng.randint(1, 25)))) for i in range(n)]
    rows += [(5000, "a ▁ mark"), (5001, "▁"), (5002, " "), (5003, "\n"), (5004, "   \n  "), (5005, "日本語のテキスト" * 20), (5006, "x" * 5000)]
    return rows


@pytest.mark.parametrize("hot_share", [10_000, 50, 1])
def test_documents_equal_brute_force(spark, libraries, monkeypatch, hot_share):
    monkeypatch.setattr(token_alignment, "HOT_SHARE", hot_share)
    rows = awkward_rows() + odd_rows()
    got = align_documents(docs_frame(spark, rows), BYTE, PIECE, store(spark)).collect()
    assert sorted((str(r[0]), *r[1:]) for r in got) == brute(libraries, rows)


def test_counts_are_passed_on_in_parts(libraries, monkeypatch):
    counts = token_alignment.PairCounts(4)
    rng = random.Random(1)
    want = Counter()
    import numpy as np
    for _ in range(50):
        pairs = np.unique(np.array([rng.randint(0, 9) for _ in range(5)], np.int64))
        counts.add(np.array([1]), pairs)
        want.update(pairs.tolist())
        if rng.random() < 0.3:
            counts.squeeze()
    keys, sums = counts.squeeze()
    assert dict(zip(keys.tolist(), sums.tolist())) == want and counts.vector.tolist() == [0, 50, 0, 0]


def test_long_texts_are_cut_at_chunks(libraries, monkeypatch):
    monkeypatch.setattr(token_alignment, "BLOCK_CHARS", 70)
    tool = Aligner(BYTE, PIECE)
    texts = ["one  two\nthree four, don't " * 50 + "y" * 400, "\xa0tab\tand\r\nlines \n \n" * 30, "日本" * 300]
    for text in texts:
        n_a, n_b, n_groups, n_links, spelled, keys, times = tool.documents([text])[0]
        want = brute_groups(libraries, text)
        text_of = ";".join(f"{','.join(map(str, x))}|{','.join(map(str, y))}" for x, y in want)
        assert (n_groups, spelled) == (len(want), hashlib.sha256(text_of.encode()).hexdigest())
        assert n_links == sum(len(x) * len(y) for x, y in want) == times.sum()


def test_identity_map(libraries):
    tool = Aligner(BYTE, PIECE)
    a, b = libraries
    assert sum(tool.identity >= 0) > 10_000
    i = a.token_to_id("Ġthe")
    assert b.id_to_piece(int(tool.identity[i])) == "▁the"


def test_ids_by_rank_equal_the_library(libraries):
    """Every Latin character in several places; texts beyond Latin go to the library."""
    tool, rng = Aligner(BYTE, PIECE), random.Random(3)
    latin = [chr(c) for c in range(0x250)]
    texts = [f" {c}{c}a {c} 1{c}\n{c}'s{c}" for c in latin] + ["".join(rng.choice(latin) for _ in range(60)) for _ in range(2000)]
    assert tool.fast and [tool.byte_ids(t) for t in texts] == [libraries[0].encode(t, add_special_tokens=False).ids for t in texts]
    assert tool.byte_ids("日本 <|endoftext|>") == libraries[0].encode("日本 <|endoftext|>", add_special_tokens=False).ids


def test_empty_and_textless_tables(spark):
    assert align_documents(docs_frame(spark, []), BYTE, PIECE, store(spark)).count() == 0
    got = align_documents(docs_frame(spark, [(1, None), (1, ""), (None, "▁")]), BYTE, PIECE, store(spark)).collect()
    assert [tuple(r)[1:] for r in got] == [(0, 0, 0, 0, 0, 0, "")] * 3
