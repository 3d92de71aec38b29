import random
import zlib

import numpy as np
import pyarrow.parquet as pq
from tokenizers import Tokenizer

from tests.llm.helpers import awkward_rows, docs_frame
from vaultmart.llm.common import new_path
from vaultmart.llm.queries import tokenizer_path
from vaultmart.llm.token_output import read_digests, WordEncoder, read_digests, read_token_ids, write_token_ids

FILE = "word_bpe_49k.json"


def brute(rows):
    own = Tokenizer.from_file(tokenizer_path(FILE))
    out, start = [], 0
    for i, t in sorted(((r[0], r[1]) for r in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or "")):
        ids = own.encode(t or "", add_special_tokens=False).ids + [2]
        out.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_files_hold_the_ids_of_the_library(spark):
    rows = awkward_rows() + [(40, "a<|endoftext|>b <|startoftext|>"), (41, "don't WE'LL 12345 é \x1c x")]
    path = new_path(spark, "ids")
    write_token_ids(docs_frame(spark, rows), path, tokenizer_path(FILE), 2)
    got = [(r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in read_digests(spark, path).collect()]
    assert sorted(map(str, got)) == sorted(map(str, brute(rows)))
    assert all(len(r.ids) == r.n_tokens and r.ids[-1] == 2 for r in read_token_ids(spark, path).collect())


def test_encodings_and_page_indexes(spark, tmp_path):
    write_token_ids(docs_frame(spark, [(i, "some words here") for i in range(500)]), str(tmp_path / "t"), tokenizer_path(FILE), 2,
                    options={"parquet.block.size": "4096"})
    files = sorted((tmp_path / "t").glob("*.parquet"))
    ids = []
    for f in files:
        meta = pq.ParquetFile(f).metadata
        for g in range(meta.num_row_groups):
            of = {meta.row_group(g).column(c).path_in_schema: meta.row_group(g).column(c) for c in range(meta.num_columns)}
            assert "DELTA_BINARY_PACKED" in of["doc_id"].encodings and of["doc_id"].has_offset_index and of["doc_id"].has_column_index
            assert any("DICTIONARY" in e for e in next(c for n, c in of.items() if n.startswith("ids")).encodings)
        ids += pq.read_table(f, columns=["doc_id"])["doc_id"].to_pylist()
    assert ids == list(range(500))                     # selective read of one column, ascending over the files


def test_empty_table(spark):
    path = new_path(spark, "ids")
    write_token_ids(docs_frame(spark, []), path, tokenizer_path(FILE), 2)
    assert read_digests(spark, path).count() == 0


def test_words_with_punctuation_and_special_strings():
    rng = random.Random(11)
    encoder, own = WordEncoder(tokenizer_path(FILE)), Tokenizer.from_file(tokenizer_path(FILE))
    bits = ["The", "ÉTÉ", "größe", "'s", "'", ".", "$$$", "|", "<|endoftext|>", "<", "|>", "_", "5", "²", "é", "e\u0301", " ", "\n", "\u3000", "İ", "Σ", "\x1c", "¿", "ª"]
    for _ in range(3000):
        text = "".join(rng.choice(bits) for _ in range(rng.randint(1, 8)))
        assert np.frombuffer(encoder.encode(text), "<i4").tolist() == own.encode(text, add_special_tokens=False).ids, text
