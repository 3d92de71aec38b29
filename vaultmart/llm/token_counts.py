"""Token counts without token ids (operator 8).

A SentencePiece BPE model never merges across the boundary between a
character and a following space mark, because no piece holds such a pair, nor
around a control character that no multi-character piece holds.  A text is
therefore the concatenation of independent pre-tokens.  Each block of
documents is reduced to per-document pre-token frequencies; the pieces of
every distinct pre-token are counted once, joined to the frequencies and
summed.  Nothing is shuffled and no document's ids are ever built.

Edge cases: null and empty texts have 0 tokens; repeated rows and repeated
ids each get a row; extra input columns are ignored.  Memory per task: one
Arrow batch, the frequencies of ``BLOCK_CHARS`` characters and a bounded
cache of pre-token counts (a cache only: a missing entry is counted again).
"""

from __future__ import annotations

import functools
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vaultmart.llm.common import BLOCK_CHARS, text_blocks

CACHE_ENTRIES = 600_000        # pre-tokens remembered by a Python worker
CACHED_LENGTH = 48             # longer pre-tokens are counted again each time


class PieceCounter:
    """Counts pieces of pre-tokens with a SentencePiece BPE model."""

    def __init__(self, model_file: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=model_file)
        pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        if any(re.search("[^▁]▁", p) for p in pieces):
            raise ValueError("a piece crosses a space: texts do not split into pre-tokens")
        held = set("".join(p for p in pieces if len(p) > 1 and not re.fullmatch("<0x..>", p)))
        alone = "".join(c for c in map(chr, range(1, 32)) if c not in held)
        if "\n" not in alone:
            raise ValueError("a piece holds a line feed: texts do not split into pre-tokens")
        cut = re.escape(alone)
        self.pattern = re.compile(f"[{cut}]|[ ▁]*[^ ▁{cut}]+|[ ▁]+")
        self.edge = re.compile(f"(?<=[^ ▁{cut}])[ ▁{cut}]")
        self.mark = len(self.model.encode("\n")) - 1        # pieces of a lone space mark
        self.cache: dict[str, int] = {}

    def split(self, text: str):
        """Lists of pre-tokens of a text, a bounded piece at a time."""
        text = " " + text                                    # the model's own leading space mark
        at = 0
        while at < len(text):
            cut = self.edge.search(text, at + BLOCK_CHARS)
            to = cut.start() if cut else len(text)
            yield self.pattern.findall(text, at, to)
            at = to

    def frequencies(self, text: str) -> Counter:
        got: Counter = Counter()
        for part in self.split(text):
            got.update(part)
        return got

    def pieces_of(self, tokens: list[str]) -> list[int]:
        """Pieces of each pre-token.  Behind a line feed (two pieces with the
        leading mark) a token stands as it does inside a text."""
        spaced = [t[1:] if t[0] in " ▁" else "\n" + t for t in tokens]
        less = [0 if t[0] in " ▁" else self.mark + 1 for t in tokens]
        return [len(ids) - n if s else self.mark for ids, n, s in zip(self.model.encode(spaced), less, spaced)]

    def count(self, texts: list[str]) -> list[int]:
        """Tokens of every text of a block: frequencies, distinct pre-tokens, join, sum."""
        freqs = [self.frequencies(t) if t else Counter() for t in texts]
        if len(self.cache) > CACHE_ENTRIES:
            self.cache.clear()
        missing = list(set().union(*freqs).difference(self.cache))
        known, long = self.cache, {}
        for t, n in zip(missing, self.pieces_of(missing) if missing else []):
            (known if len(t) <= CACHED_LENGTH else long)[t] = n
        return [sum(n * (known[t] if t in known else long[t]) for t, n in f.items()) for f in freqs]


@functools.lru_cache(1)
def piece_counter(model_file: str) -> PieceCounter:
    return PieceCounter(model_file)                          # kept, with its cache, across a worker's tasks


def token_counts(docs: DataFrame, model_file: str, id_col: str = "doc_id", text_col: str = "text",
                 limit: int = 4096) -> DataFrame:
    """One row per input row: id, ``n_bytes``, ``n_tokens``, ``over_limit``."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"),
                       F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long").alias("n_bytes"))
    schema = T.StructType([rows.schema["id"], T.StructField("n_bytes", T.LongType()), T.StructField("n_tokens", T.LongType())])

    def count(batches):
        counter = piece_counter(model_file)
        for batch in batches:
            n = []
            for _, _, texts in text_blocks(batch.column("text")):
                n += counter.count(texts)
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("n_bytes"), pa.array(n, pa.int64())],
                                             names=["id", "n_bytes", "n_tokens"])

    return rows.mapInArrow(count, schema).select(
        F.col("id").alias(id_col), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
