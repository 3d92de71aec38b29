"""SentencePiece BPE encoding and decoding by vectorised merge rounds (operator 12).

The symbols of all words of a block are one flat numpy array.  A round looks
up the rank of every pair of neighbours, takes the minimum per word, merges
the leftmost non-overlapping pairs of that rank in every word at once, and
compacts the array; words without a pair leave it.  Rounds end when no pair
remains.  The model file supplies pieces and scores only: its own encoder and
decoder are not called.

A round may merge all pairs of its minimum rank, because merging one of them
makes no pair of the same or a better rank.  Where the vocabulary holds such a
pair (checked once for every piece), only the leftmost one of the word merges.

Words are runs that no piece crosses: cut before a space that follows another
character, around control characters that stand in no longer piece, and inside
a run of spaces so that no word has more of them than the longest piece of
spaces.  That is checked on the vocabulary when a model is loaded.  Ids of
words are remembered, bounded, across a worker's tasks.

Edge cases: null and empty texts give the begin and end id alone and decode to
the empty string; repeated rows and repeated or null ids each get a row; extra
columns are ignored; a very long text is cut into words a bounded number of
characters at a time, and a very long word is one segment of its block.  A
mark U+2581 of the text is a space after decoding, as in the library.  Memory
per task: one Arrow batch, the symbols of ``BLOCK_CHARS`` characters (a longer
word: its own), the ids of one text and the bounded memory of words.
"""

from __future__ import annotations

import functools
import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vaultmart.llm.common import BLOCK_CHARS, text_blocks

MARK = "▁"
WORDS_REMEMBERED = 400_000     # words whose ids a Python worker remembers
REMEMBERED_LENGTH = 48         # longer words are merged again each time
NO_RANK = np.int64(1) << 40


class PieceCodec:
    """Pieces, ranks and pair tables of a SentencePiece BPE model with byte fallback."""

    def __init__(self, model_file: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=model_file)
        size = model.get_piece_size()
        self.begin, self.end, self.unknown = model.bos_id(), model.eos_id(), model.unk_id()
        self.pieces = [model.id_to_piece(i) for i in range(size)]
        special = {i for i in range(size) if model.is_control(i) or model.is_unknown(i) or model.is_unused(i)}
        self.bytes = {int(self.pieces[i][3:5], 16): i for i in range(size) if model.is_byte(i)}
        if len(self.bytes) != 256:
            raise ValueError("the model has no byte fallback")
        normal = [i for i in range(size) if i not in special and not model.is_byte(i)]
        self._words(model, normal)
        self._pairs(model, normal)
        block = self.merge([MARK * self.run])[0]
        if any(self.merge([MARK * n])[0][:len(block)] != block for n in range(self.run, 4 * self.run)):
            raise ValueError("a run of spaces does not begin with the longest piece of spaces")
        self._decoding(special)
        self.known: dict[str, bytes] = {}

    def _words(self, model, normal) -> None:
        long = [self.pieces[i] for i in normal if len(self.pieces[i]) > 1]
        runs = [p for p in long if not p.strip(MARK)]
        if any(p.strip(MARK) and MARK in p[1:] for p in long):
            raise ValueError("a piece holds a space behind another character: texts do not split into words")
        self.run = max(map(len, runs), default=1)
        scores = {model.get_score(i) for i in normal if self.pieces[i] in set(runs)}
        others = min((model.get_score(i) for i in normal if len(self.pieces[i]) > 1 and self.pieces[i].strip(MARK)), default=0.0)
        if len(scores) > 1 or (scores and max(scores) >= others):
            raise ValueError("pieces of spaces do not come last in rank")
        held = set("".join(long))
        alone = re.escape("".join(c for c in map(chr, range(1, 32)) if c not in held))
        letters = f"[^{MARK}{alone}]" if alone else f"[^{MARK}]"
        # a full run of spaces with more behind it; else spaces and what follows; else one character that merges with nothing
        self.find = re.compile(f"{MARK}{{{self.run}}}(?={MARK})|{MARK}{{0,{self.run}}}{letters}+|{MARK}{{1,{self.run}}}|(?s:.)").findall
        self.edge = re.compile(f"(?<=[^{MARK}])(?={MARK})").search

    def _pairs(self, model, normal) -> None:
        """Symbols are numbered: pieces by id, then single characters outside the vocabulary."""
        at = {self.pieces[i]: i for i in normal}
        ranks = {s: r for r, s in enumerate(sorted({model.get_score(i) for i in normal if len(self.pieces[i]) > 1}, reverse=True))}
        chars = sorted({c for p in at for c in p if c not in at})
        self.symbols = at | {c: len(self.pieces) + i for i, c in enumerate(chars)}
        self.other = len(self.pieces) + len(chars)                     # any other character
        self.width = np.int64(self.other + 1)
        keys, into, rank = [], [], []
        for piece, i in at.items():
            for cut in range(1, len(piece)):
                left, right = self.symbols.get(piece[:cut]), self.symbols.get(piece[cut:])
                if left is not None and right is not None:
                    keys.append(left * int(self.width) + right)
                    into.append(i)
                    rank.append(ranks[model.get_score(i)])
        order = np.argsort(np.asarray(keys, np.int64), kind="stable")
        self.keys = np.append(np.asarray(keys, np.int64)[order], np.iinfo(np.int64).max)
        self.into = np.append(np.asarray(into, np.int64)[order], 0)
        self.rank = np.append(np.asarray(rank, np.int64)[order], NO_RANK)
        # pieces that form a pair of their own or a better rank: only their leftmost occurrence merges in a round
        own = np.full(int(self.width), NO_RANK)
        own[self.into[:-1]] = self.rank[:-1]
        left, right = self.keys[:-1] // self.width, self.keys[:-1] % self.width
        one_by_one = np.zeros(int(self.width), bool)
        one_by_one[left[self.rank[:-1] <= own[left]]] = True
        one_by_one[right[self.rank[:-1] <= own[right]]] = True
        self.one_by_one = one_by_one
        top = max(map(ord, (c for p in self.symbols for c in p))) + 1
        self.of_char = np.full(top + 1, self.other, np.int64)
        for c, i in self.symbols.items():
            if len(c) == 1:
                self.of_char[ord(c)] = i
        self.in_vocabulary = np.zeros(int(self.width), bool)
        self.in_vocabulary[list(at.values())] = True

    def _decoding(self, special) -> None:
        spelled = []
        for i, p in enumerate(self.pieces):
            byte = re.fullmatch("<0x(..)>", p) if i in self.bytes.values() else None
            spelled.append(bytes([int(byte[1], 16)]) if byte else " ⁇ ".encode() if i == self.unknown else
                           b"" if i in special else p.replace(MARK, " ").encode())
        self.spelled = spelled
        self.lengths = np.fromiter(map(len, spelled), np.int64, len(spelled))
        self.starts = np.concatenate([[0], np.cumsum(self.lengths)])[:-1]
        self.letters = np.frombuffer(b"".join(spelled), np.uint8)
        self.silent = np.zeros(len(spelled), bool)
        self.silent[[i for i in special if i != self.unknown]] = True
        self.is_byte = np.zeros(len(spelled), bool)
        self.is_byte[list(self.bytes.values())] = True

    # ---- encoding ----

    def split(self, text: str):
        """Lists of words of a text that is not empty, about ``BLOCK_CHARS`` characters at a time."""
        text = MARK + text.replace(" ", MARK)                          # the model's own leading space
        at = 0
        while at < len(text):
            cut = self.edge(text, at + BLOCK_CHARS) if len(text) - at > BLOCK_CHARS else None
            to = cut.start() if cut else len(text)
            yield self.find(text[at:to] if at or cut else text)
            at = to

    def merge(self, words: list[str]) -> list[bytes]:
        """Ids (little-endian, 32 bits) of every word: the vectorised rounds."""
        cp = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32)
        sym = self.of_char[np.minimum(cp, len(self.of_char) - 1)]
        word = np.repeat(np.arange(len(words)), np.fromiter(map(len, words), np.int64, len(words)))
        place = np.arange(len(cp))                                     # where a symbol begins
        done_sym, done_place = [], []
        while len(sym):
            key = np.where(word[1:] == word[:-1], sym[:-1] * self.width + sym[1:], -1)
            found = np.searchsorted(self.keys, key)
            rank = np.where(self.keys[found] == key, self.rank[found], NO_RANK)
            first = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
            least = np.minimum.reduceat(np.append(rank, NO_RANK), first)   # the pair behind a word's last symbol has no rank
            size = np.diff(np.append(first, len(sym)))
            over = least == NO_RANK
            if over.any():                                             # words without a pair leave
                gone = np.repeat(over, size)
                done_sym.append(sym[gone])
                done_place.append(place[gone])
                stay = ~gone
                rank, found = np.append(rank, NO_RANK)[stay], np.append(found, 0)[stay]
                sym, word, place = sym[stay], word[stay], place[stay]
                least, size = least[~over], size[~over]
                if not len(sym):
                    break
            else:
                rank, found = np.append(rank, NO_RANK), np.append(found, 0)
            hits = np.flatnonzero(rank == np.repeat(least, size))      # ascending, each the left side of a pair
            made = self.into[found[hits]]
            new_word = np.concatenate([[True], word[hits[1:]] != word[hits[:-1]]])
            # in a chain of overlapping pairs every second one merges, from the left
            chain = np.concatenate([[True], (hits[1:] != hits[:-1] + 1) | new_word[1:]])
            index = np.arange(len(hits))
            begin = np.maximum.accumulate(np.where(chain, index, 0))
            keep = (index - begin) % 2 == 0
            slow = self.one_by_one[made]
            if slow.any():                                             # such a word merges its leftmost pair only
                careful = np.zeros(len(words), bool)
                careful[word[hits[slow]]] = True
                keep &= new_word | ~careful[word[hits]]
            hits, made = hits[keep], made[keep]
            sym = sym.copy()
            sym[hits] = made
            stay = np.ones(len(sym), bool)
            stay[hits + 1] = False
            sym, word, place = sym[stay], word[stay], place[stay]
        return self._ids(cp, len(words), words, done_sym, done_place)

    def _ids(self, cp, n, words, done_sym, done_place) -> list[bytes]:
        sym, place = np.concatenate(done_sym), np.concatenate(done_place)
        order = np.argsort(place, kind="stable")
        sym, place = sym[order], place[order]
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, n))
        odd = np.flatnonzero(~self.in_vocabulary[sym])                 # single characters outside the vocabulary: their bytes
        if len(odd):
            spelled = [[self.bytes[b] for b in chr(c).encode("utf-8", "replace")] for c in cp[place[odd]]]
            times = np.ones(len(sym), np.int64)
            times[odd] = [len(s) for s in spelled]
            at = np.cumsum(times) - times
            sym, place = np.repeat(sym, times), np.repeat(place, times)
            flat = np.concatenate([np.asarray(s, np.int64) for s in spelled])
            where = np.repeat(at[odd], times[odd]) + np.arange(len(flat)) - np.repeat(np.cumsum(times[odd]) - times[odd], times[odd])
            sym[where] = flat
        cut = np.searchsorted(place, ends)                             # ids of word i end here
        ids = sym.astype("<u4").tobytes()
        edges = [0, *(4 * cut).tolist()]
        return [ids[a:b] for a, b in zip(edges, edges[1:])]

    def words_to_ids(self, missing: list[str]) -> dict[str, bytes]:
        got, at = {}, 0
        while at < len(missing):
            to, size = at, 0
            while to < len(missing) and (size == 0 or size + len(missing[to]) <= BLOCK_CHARS):
                size += len(missing[to])
                to += 1
            got.update(zip(missing[at:to], self.merge(missing[at:to])))
            at = to
        return got

    def encode(self, texts: list) -> list[bytes]:
        """Ids of whole texts without begin and end, as little-endian 32-bit integers."""
        if len(self.known) > WORDS_REMEMBERED:
            self.known.clear()
        out = [[] for _ in texts]
        waiting, size = [], 0

        def flush():
            new = set().union(*(w for _, w in waiting)).difference(self.known) if waiting else ()
            got = self.words_to_ids(sorted(new))
            long = {w: ids for w, ids in got.items() if len(w) > REMEMBERED_LENGTH}
            self.known.update((w, ids) for w, ids in got.items() if len(w) <= REMEMBERED_LENGTH)
            known = self.known
            for i, words in waiting:
                if long:
                    out[i] += [long[w] if w in long else known[w] for w in words]
                else:
                    out[i] += map(known.__getitem__, words)
                out[i] = [b"".join(out[i])]
            waiting.clear()

        for i, text in enumerate(texts):
            for words in self.split(text) if text else ():
                waiting.append((i, words))
                size += len(words)
                if size > BLOCK_CHARS // 4:
                    flush()
                    size = 0
        flush()
        return [b"".join(parts) for parts in out]

    # ---- decoding ----

    def decode(self, ids: np.ndarray) -> bytes:
        """UTF-8 of the text of a sequence of ids: pieces spelled out by one gather, the leading space dropped, runs of
        byte pieces that are no UTF-8 replaced byte by byte by U+FFFD."""
        place = np.flatnonzero(~self.silent[ids])
        ids = ids[place].astype(np.int64)
        if not len(ids):
            return b""
        size = self.lengths[ids]
        ends = np.cumsum(size)
        begin = ends - size
        raw = self.letters[np.arange(ends[-1]) + np.repeat(self.starts[ids] - begin, size)].tobytes()
        from_byte = self.is_byte[ids]
        lead = 1 if raw[:1] == b" " and not from_byte[0] and ids[0] != self.unknown else 0
        if from_byte.any():
            apart = from_byte & ~(np.concatenate([[False], from_byte[:-1]]) & (np.diff(place, prepend=-1) == 1))
            first = np.flatnonzero(apart)                              # runs of byte pieces; a control id ends one
            count = np.add.reduceat(from_byte.astype(np.int64), first)
            parts, at = [], 0
            for a, b in zip(begin[first].tolist(), ends[first + count - 1].tolist()):
                parts += [raw[at:a], _repaired(raw[a:b])]
                at = b
            raw = b"".join([*parts, raw[at:]])
        return raw[lead:]


def _repaired(raw: bytes) -> bytes:
    try:
        raw.decode()
        return raw
    except UnicodeDecodeError:
        pass
    out, at = [], 0
    while at < len(raw):
        for size in (1, 2, 3, 4):
            try:
                raw[at:at + size].decode()
            except UnicodeDecodeError:
                continue
            out.append(raw[at:at + size])
            break
        else:
            out.append("�".encode())
            size = 1
        at += size
    return b"".join(out)


@functools.lru_cache(1)
def piece_codec(model_file: str) -> PieceCodec:
    return PieceCodec(model_file)                                      # kept, with its words, across a worker's tasks


# ---- the operators ------------------------------------------------------------------------------------

def encode_pieces(docs: DataFrame, model_file: str, id_col: str = "doc_id", text_col: str = "text", begin: bool = True,
                  end: bool = True) -> DataFrame:
    """``id_col, ids``: the ids of every whole text as a list."""
    rows = docs.select(F.col(id_col), F.col(text_col).cast("string").alias("_text"))
    schema = T.StructType([rows.schema[id_col], T.StructField("ids", T.ArrayType(T.IntegerType(), False))])

    def encode(batches):
        codec = piece_codec(model_file)
        for batch in batches:
            column = batch.column("_text")
            for lo, hi, texts in text_blocks(column):
                ids = [_framed(codec, x, begin, end) for x in codec.encode(texts)]
                flat = np.frombuffer(b"".join(ids), "<u4").astype(np.int32)
                offsets = np.concatenate([[0], np.cumsum([len(x) // 4 for x in ids])]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))], names=[id_col, "ids"])

    return rows.mapInArrow(encode, schema)


def _framed(codec: PieceCodec, ids: bytes, begin: bool, end: bool) -> bytes:
    one = lambda i: int(i).to_bytes(4, "little")
    return (one(codec.begin) if begin else b"") + ids + (one(codec.end) if end else b"")


def decode_pieces(rows: DataFrame, model_file: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """``id_col, text``: the text of every list of ids (null list: null)."""
    rows = rows.select(F.col(id_col), F.col(ids_col).cast("array<int>").alias("_ids"))
    schema = T.StructType([rows.schema[id_col], T.StructField("text", T.StringType())])

    def decode(batches):
        codec = piece_codec(model_file)
        for batch in batches:
            texts = [None if not x.is_valid else codec.decode(x.values.to_numpy(zero_copy_only=False)).decode() for x in batch.column("_ids")]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=[id_col, "text"])

    return rows.mapInArrow(decode, schema)


def codec_digests(docs: DataFrame, model_file: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: ``n_tokens`` and ``ids_sha256`` of the ids with begin and end, ``decoded_sha256`` of what they decode to.
    Encoding and decoding run in one pass, so no id leaves its task."""
    rows = docs.select(F.col(id_col), F.col(text_col).cast("string").alias("_text"))
    schema = T.StructType([rows.schema[id_col], T.StructField("n_tokens", T.LongType()),
                           T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType())])

    def digest(batches):
        codec = piece_codec(model_file)
        for batch in batches:
            n, ids_hash, text_hash = [], [], []
            for _, _, texts in text_blocks(batch.column("_text")):
                for ids in codec.encode(texts):
                    ids = _framed(codec, ids, True, True)
                    n.append(len(ids) // 4)
                    ids_hash.append(hashlib.sha256(ids).hexdigest())
                    text_hash.append(hashlib.sha256(codec.decode(np.frombuffer(ids, "<u4"))).hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(ids_hash, pa.string()),
                                              pa.array(text_hash, pa.string())], names=schema.names)

    return rows.mapInArrow(digest, schema)
