"""Cross-tokenizer alignment of a byte-level BPE (A) and a SentencePiece BPE (B) (operator 13).

Both tokenizers spell out the same bytes, a space and the text.  Offsets where
a token of A and a token of B both end cut them into groups; the occurrence
pairs inside a group are links; a pair of ids counts the documents that hold
it linked.

Identity-map fast path: an array holds for every A id the B id of the same
bytes.  A group of one A and one B token with those ids needs no pair: its
documents are counted in a vector of the length of A's vocabulary.  Only the
other pairs are shuffled, summed per task first.  Documents are encoded once;
their distinct pairs are written, and a second pass looks their counts up:
identity pairs and pairs so frequent that they exceed 1 / ``HOT_SHARE`` of all
pair rows (so at most ``HOT_SHARE`` of them exist) from arrays, the rest by a
join on the pair, none of whose keys can be hot.

Texts are cut into chunks at whose edges both tokenizers must cut (white space
behind another character, where B's words also end); a chunk's ids, groups and
pairs are worked out once and remembered, bounded, across a worker's tasks.

Edge cases: null and empty texts, and texts whose tokens of A or B do not
spell out a space and the text (a mark U+2581 in the text is one), have no
tokens: zeros, an empty ``groups_sha256``, no counts.  Strings of special tokens are
plain text.  Repeated rows, repeated ids and null ids are documents of their
own; extra columns are ignored; a very long text is worked through about
``BLOCK_CHARS`` characters at a time.  Memory per task: one Arrow batch, a
block, the distinct pairs of one text, the vector and ``PAIRS_HELD`` pair
counts.  The driver receives two vectors of A's vocabulary and the frequent
pairs.
"""

from __future__ import annotations

import functools
import hashlib
import json
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vaultmart.llm.common import BLOCK_CHARS, list_array, text_blocks
from vaultmart.llm.piece_codec import MARK, PieceCodec

CHUNKS_REMEMBERED = 150_000    # chunks whose alignment a Python worker remembers, twice that with the older generation
RUN_CHUNKS = 10_000            # distinct chunks that are encoded as one text
FLUSH_CHUNKS = 80_000          # chunks of texts that are gathered at once
WIDE_GROUP = 256               # links of a group beyond which its distinct ids are summed first
REMEMBERED_LENGTH = 32         # longer chunks are aligned again each time
PAIRS_HELD = 500_000           # pair counts a task holds before it passes them on
HOT_SHARE = 10_000             # a pair is frequent beyond 1 / HOT_SHARE of all pair rows
# Fixed value: the published pattern of byte-level pre-tokens.
PRE_TOKENS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
ID_BITS = 32                   # a pair of ids is one number: A's id, then B's

LONGS, LONG = T.ArrayType(T.LongType(), False), T.LongType()


def byte_letters() -> dict[str, int]:
    """The byte-level alphabet: the byte that each of its 256 letters stands for.  Printable bytes of Latin-1 stand for
    themselves, the others are numbered from 256 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    other = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


class Aligner:
    """Aligned groups of chunks of text under both tokenizers."""

    def __init__(self, byte_file: str, piece_file: str):
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(byte_file)
        self.a.encode_special_tokens = True
        self.a.no_truncation()
        self.a.no_padding()
        with open(byte_file, encoding="utf-8") as f:
            kind = json.load(f)
        split = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}
        if kind.get("normalizer") or not split.items() <= (kind.get("pre_tokenizer") or {}).items():
            raise ValueError("the byte-level tokenizer does not cut texts before white space")
        self.fast = self._by_ranks(kind)
        self.beyond_latin = re.compile("[^\0-\u024f]").search
        self.b = PieceCodec(piece_file)
        letter = byte_letters()
        special = {t["id"]: t["content"].encode() for t in kind["added_tokens"]}
        vocabulary = self.a.get_vocab(with_added_tokens=True)
        self.size = max(vocabulary.values()) + 1
        self.bytes_a = [b""] * self.size
        for token, i in vocabulary.items():
            self.bytes_a[i] = special[i] if i in special else bytes(letter[c] for c in token)
        self.bytes_b = self.b.spelled
        by_bytes = {}
        for i in np.argsort(~self.b.is_byte, kind="stable").tolist():    # a piece is preferred to a byte piece
            if not self.b.silent[i] and i != self.b.unknown:
                by_bytes[self.bytes_b[i]] = i
        self.identity = np.fromiter((by_bytes.get(x, -1) for x in self.bytes_a), np.int64, self.size)
        white = r"[^\S\x1c-\x1f]"                                        # what A's pattern takes for white space
        other = r"[\S\x1c-\x1f]"
        breaks = " " + "".join(c for c in "\n\t\r\x0b\x0c" if len(self.b.find("a" + c + "a")) == 3)
        kept = rf"(?![{breaks}]){white}"                                 # white space that a piece may reach across
        self.find = re.compile(f"{white}*(?:{other}+(?:{kept}{white}*)?)+|{white}+").findall
        self.edge = re.compile(f"(?<={other})(?=[{breaks}])").search
        self.white = frozenset(c for c in map(chr, range(0x110000)) if c.isspace() and re.match(white, c))
        self.size_a = np.fromiter(map(len, self.bytes_a), np.int64, self.size)
        self.names = [str(i) for i in range(max(self.size, len(self.bytes_b)))]
        self.same_names = np.array([f"{i}|{j}" for i, j in enumerate(self.identity.tolist())], object)
        self.known: dict[str, tuple] = {}
        self.old: dict[str, tuple] = {}

    @staticmethod
    def _by_ranks(kind: dict):
        """The same merges by rank (tiktoken, several times faster), where the file's ids follow its merges; else None."""
        import tiktoken

        letter, vocabulary = byte_letters(), kind["model"]["vocab"]
        merges = [m if isinstance(m, list) else m.split(" ") for m in kind["model"]["merges"]]
        if sorted(vocabulary.values()) != list(range(256 + len(merges))) or any(vocabulary["".join(m)] != 256 + i for i, m in enumerate(merges)):
            return None
        ranks = {bytes(letter[c] for c in token): i for token, i in vocabulary.items()}
        return tiktoken.Encoding("own", pat_str=PRE_TOKENS, mergeable_ranks=ranks, special_tokens={})

    def byte_ids(self, text: str) -> list[int]:
        """A's ids.  Letters beyond Latin are left to the library, whose tables of letters and numbers decide there."""
        if self.fast and not self.beyond_latin(text):
            return self.fast.encode_ordinary(text)
        return self.a.encode(text, add_special_tokens=False).ids

    def split(self, text: str):
        """Lists of chunks of a space and the text, about ``BLOCK_CHARS`` characters at a time."""
        text = " " + text
        at = 0
        while at < len(text):
            cut = self.edge(text, at + BLOCK_CHARS) if len(text) - at > BLOCK_CHARS else None
            to = cut.start() if cut else len(text)
            yield self.find(text[at:to] if at or cut else text)
            at = to

    def align(self, chunks: list[str]) -> dict[str, tuple]:
        """chunk -> (groups spelled out, A tokens, B tokens, groups, links, pairs), or None where the bytes differ.
        ``pairs`` are (pair, occurrences) as packed 64-bit integers.

        Distinct chunks are laid end to end and encoded as one text: both tokenizers cut at the edges of chunks.  A chunk
        that ends with white space stands at the end of its text and goes alone."""
        got, runs, latin, other = {}, [], [], []
        for c in chunks:
            if MARK in c:
                got[c] = None
            elif c[-1] in self.white:
                runs.append([c])
            elif c.isascii() or not self.beyond_latin(c):
                latin.append(c)
            else:
                other.append(c)
        runs += [part[i:i + RUN_CHUNKS] for part in (latin, other) for i in range(0, len(part), RUN_CHUNKS)]
        for run in runs:
            found = self._aligned_run(run)
            if found is None:                                            # bytes differ somewhere: find out where
                for c in run:
                    found = self._aligned_run([c])
                    got[c] = found[0] if found else None
            else:
                got.update(zip(run, found))
        return got

    def _aligned_run(self, chunks: list[str]) -> list[tuple] | None:
        text = "".join(chunks)
        raw = text.encode()
        words = self.b.find(text.replace(" ", MARK))
        ids_of = self.b.words_to_ids(list(dict.fromkeys(words)))
        a = np.array(self.byte_ids(text), np.int64)
        b = np.frombuffer(b"".join([ids_of[w] for w in words]), "<u4").astype(np.int64)
        a_list, b_list = a.tolist(), b.tolist()
        if (b"".join(map(self.bytes_a.__getitem__, a_list)) != raw or b"".join(map(self.bytes_b.__getitem__, b_list)) != raw):
            return None
        ends_a, ends_b = np.cumsum(self.size_a[a]), np.cumsum(self.b.lengths[b])
        edges = np.cumsum(np.fromiter((len(c.encode()) for c in chunks), np.int64, len(chunks)))
        common = np.intersect1d(ends_a, ends_b, assume_unique=True)
        if not np.isin(edges, common, assume_unique=True).all():
            raise ValueError("a token reaches across the edge of a chunk")
        n_a = np.bincount(np.searchsorted(common, ends_a), minlength=len(common))
        n_b = np.bincount(np.searchsorted(common, ends_b), minlength=len(common))
        at_a, at_b = np.cumsum(n_a) - n_a, np.cumsum(n_b) - n_b
        chunk_of = np.searchsorted(edges, common)
        first = np.searchsorted(chunk_of, np.arange(len(chunks) + 1))    # groups of a chunk
        of, keys, times = self._pairs(a, b, n_a, n_b, at_a, at_b, chunk_of)
        packed = np.stack([keys, times], 1).tobytes()
        cut = 16 * np.searchsorted(of, np.arange(len(chunks) + 1))
        spelled, names = np.empty(len(common), object), self.names
        same = (n_a == 1) & (n_b == 1)
        same[same] = self.identity[a[at_a[same]]] == b[at_b[same]]
        spelled[same] = self.same_names[a[at_a[same]]]
        odd = np.flatnonzero(~same)
        for g, i, n, j, m in zip(odd.tolist(), at_a[odd].tolist(), n_a[odd].tolist(), at_b[odd].tolist(), n_b[odd].tolist()):
            spelled[g] = ",".join(map(names.__getitem__, a_list[i:i + n])) + "|" + ",".join(map(names.__getitem__, b_list[j:j + m]))
        spelled = spelled.tolist()
        begin = first[:-1]
        numbers = [np.add.reduceat(x, begin).tolist() for x in (n_a, n_b, n_a * n_b)]
        bounds, cuts = first.tolist(), cut.tolist()
        return [(";".join(spelled[lo:hi]), na, nb, hi - lo, links, packed[x:y])
                for lo, hi, na, nb, links, x, y in zip(bounds, bounds[1:], *numbers, cuts, cuts[1:])]

    @staticmethod
    def _pairs(a, b, n_a, n_b, at_a, at_b, chunk_of) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(chunk, pair, occurrences) of all groups, by chunk; large groups are summed over their distinct ids first."""
        count = n_a * n_b
        small = np.flatnonzero(count <= WIDE_GROUP)
        reps = count[small]
        r = np.arange(reps.sum()) - np.repeat(np.cumsum(reps) - reps, reps)
        group = np.repeat(small, reps)
        left, right = a[at_a[group] + r // n_b[group]], b[at_b[group] + r % n_b[group]]
        of, keys, times = [chunk_of[group]], [left << ID_BITS | right], [np.ones(len(group), np.int64)]
        for g in np.flatnonzero(count > WIDE_GROUP).tolist():
            x, n = np.unique(a[at_a[g]:at_a[g] + n_a[g]], return_counts=True)
            y, m = np.unique(b[at_b[g]:at_b[g] + n_b[g]], return_counts=True)
            keys.append((np.repeat(x, len(y)) << ID_BITS) | np.tile(y, len(x)))
            times.append(np.repeat(n, len(y)) * np.tile(m, len(x)))
            of.append(np.full(len(keys[-1]), chunk_of[g]))
        of, keys, times = np.concatenate(of), np.concatenate(keys), np.concatenate(times)
        order = np.argsort(of, kind="stable")
        return of[order], keys[order], times[order]

    def _infos(self, chunks) -> list:
        """Alignments of distinct chunks (None: the bytes differ), worked out or remembered in two generations."""
        infos = list(map(self.known.get, chunks))
        holes = [(j, c) for (j, c), x in zip(enumerate(chunks), infos) if x is None]
        again = {c: self.old[c] for _, c in holes if c in self.old}
        found = self.align([c for _, c in holes if c not in again])
        for j, c in holes:
            infos[j] = again[c] if c in again else found[c]
        self.known.update(again)
        self.known.update((c, x) for c, x in found.items() if len(c) <= REMEMBERED_LENGTH and x is not None)
        if len(self.known) > CHUNKS_REMEMBERED:
            self.old, self.known = self.known, {}
        return infos

    def documents(self, texts: list):
        """Per text: (A tokens, B tokens, groups, links, hash of the groups, distinct pairs, occurrences), None without tokens."""
        held, done = {}, {}
        units, size, at = [], 0, 0
        for i, text in enumerate(texts):
            for chunks in self.split(text) if text else ():
                units.append((i, chunks))
                size += len(chunks)
                if size > FLUSH_CHUNKS:
                    self._gather(units, held)
                    units, size = [], 0
            if not units:
                done.update((k, _document(held.pop(k, None))) for k in range(at, i + 1))
                at = i + 1
        if units:
            self._gather(units, held)
        done.update((k, _document(held.pop(k, None))) for k in range(at, len(texts)))
        return [done[i] for i in range(len(texts))]

    def _gather(self, units: list, held: dict) -> None:
        """Add the groups and pairs of units (text, chunks) to what is held of their texts."""
        every = [c for _, chunks in units for c in chunks]
        distinct = list(dict.fromkeys(every))
        index = dict(zip(distinct, range(len(distinct))))
        infos = self._infos(distinct)
        bad = np.fromiter((x is None for x in infos), bool, len(infos))
        if bad.any():
            infos = [x or ("", 0, 0, 0, 0, b"") for x in infos]
        spelled, *numbers, packed = zip(*infos)
        numbers = np.array(numbers, np.int64).T
        pairs = np.frombuffer(b"".join(packed), np.int64).reshape(-1, 2)
        width = np.fromiter(map(len, packed), np.int64, len(packed)) // 16
        start = np.cumsum(width) - width
        sizes = np.fromiter((len(c) for _, c in units), np.int64, len(units))
        which = np.fromiter(map(index.__getitem__, every), np.int64, len(every))
        unit = np.repeat(np.arange(len(units)), sizes)
        # chunks of a unit once, with their number; then its pairs once, with their occurrences
        once, n = np.unique(unit * len(infos) + which, return_counts=True)
        u, c = once // len(infos), once % len(infos)
        row = np.repeat(np.arange(len(once)), width[c])
        pick = np.arange(len(row)) - np.repeat(np.cumsum(width[c]) - width[c], width[c]) + start[c][row]
        owner, keys, times = u[row], pairs[pick, 0], pairs[pick, 1] * n[row]
        order = np.lexsort((keys, owner))
        owner, keys, times = owner[order], keys[order], times[order]
        new = np.flatnonzero(np.concatenate([[True], (owner[1:] != owner[:-1]) | (keys[1:] != keys[:-1])])) if len(keys) else np.zeros(0, np.int64)
        times = np.add.reduceat(times, new) if len(new) else times
        owner, keys = owner[new], keys[new]
        cut = np.searchsorted(owner, np.arange(len(units) + 1)).tolist()
        first = np.concatenate([[0], np.cumsum(sizes)]).tolist()
        totals = np.add.reduceat(numbers[which], first[:-1])
        wrong = np.add.reduceat(bad[which].astype(np.int64), first[:-1]) > 0
        listed = which.tolist()
        for k, (i, _) in enumerate(units):
            text = held.setdefault(i, _Held())
            if wrong[k]:
                text.fits = False
            text.add(totals[k], map(spelled.__getitem__, listed[first[k]:first[k + 1]]), keys[cut[k]:cut[k + 1]], times[cut[k]:cut[k + 1]])


class _Held:
    """What is known so far of a text that is worked through in pieces."""

    def __init__(self):
        self.total, self.hash, self.keys, self.times, self.fits, self.some = np.zeros(4, np.int64), hashlib.sha256(), [], [], True, False

    def add(self, total, spelled, keys, times) -> None:
        self.total += total
        self.hash.update(((";" if self.some else "") + ";".join(spelled)).encode())
        self.some = True
        self.keys.append(keys)
        self.times.append(times)


def _document(held: _Held | None):
    if held is None or not held.fits:
        return None
    keys, times = held.keys[0], held.times[0]
    if len(held.keys) > 1:
        keys, at = np.unique(np.concatenate(held.keys), return_inverse=True)
        times = np.zeros(len(keys), np.int64)
        np.add.at(times, at, np.concatenate(held.times))
    return (*held.total.tolist(), held.hash.hexdigest(), keys, times)


@functools.lru_cache(1)
def aligner(byte_file: str, piece_file: str) -> Aligner:
    return Aligner(byte_file, piece_file)                              # kept, with its chunks, across a worker's tasks


class PairCounts:
    """Documents per pair of one task: a vector for identity pairs, sums of the others passed on now and then."""

    def __init__(self, size: int):
        self.vector, self.held, self.keys, self.sums = np.zeros(size, np.int64), 0, [], []

    def add(self, ids: np.ndarray, pairs: np.ndarray) -> None:
        self.vector[ids] += 1                                          # the ids of one document are distinct
        self.keys.append(pairs)
        self.held += len(pairs)

    def squeeze(self) -> tuple[np.ndarray, np.ndarray]:
        keys = np.concatenate([*self.keys, np.zeros(0, np.int64)])
        sums = np.concatenate([*self.sums, np.ones(len(keys) - sum(map(len, self.sums)), np.int64)])
        keys, at = np.unique(keys, return_inverse=True)
        total = np.zeros(len(keys), np.int64)
        np.add.at(total, at, sums)
        self.keys, self.sums, self.held = [keys], [total], len(keys)
        return keys, total


ALIGNED = T.StructType(
    [T.StructField("row", LONG), T.StructField("n_a", LONG), T.StructField("n_b", LONG), T.StructField("n_groups", LONG),
     T.StructField("n_links", LONG), T.StructField("groups_sha256", T.StringType()),
     T.StructField("same", LONGS), T.StructField("same_times", LONGS), T.StructField("pairs", LONGS), T.StructField("pair_times", LONGS),
     T.StructField("counted_ids", LONGS), T.StructField("counted_pairs", LONGS), T.StructField("counts", LONGS)])


def aligned(rows: DataFrame, byte_file: str, piece_file: str) -> DataFrame:
    """``id, row, text`` to rows of ``id`` and ``ALIGNED``: one per document with its distinct pairs, and (``row`` null) the task's counts of
    documents, per A id with the B id of the same bytes (``counted_ids``) or per other pair (``counted_pairs``)."""
    schema = T.StructType([T.StructField("id", rows.schema["id"].dataType), *ALIGNED])

    def lists(arrays):
        return list_array(np.concatenate([*arrays, np.zeros(0, np.int64)]), [len(x) for x in arrays], pa.int64())

    def counts_batch(kind, ids, pairs, counts):
        got = {"id": pa.nulls(1, kind), "counted_ids": lists([ids]), "counted_pairs": lists([pairs]), "counts": lists([counts])}
        kinds = {"groups_sha256": pa.string()} | {f.name: pa.list_(pa.int64()) for f in ALIGNED if f.dataType == LONGS}
        return pa.RecordBatch.from_arrays([got.get(n, pa.nulls(1, kinds.get(n, pa.int64()))) for n in schema.names], names=schema.names)

    def align(batches):
        tool = aligner(byte_file, piece_file)
        counted = PairCounts(tool.size)
        kind, nothing = pa.null(), np.zeros(0, np.int64)
        for batch in batches:
            kind = batch.column("id").type
            for lo, hi, texts in text_blocks(batch.column("text")):
                numbers, hashes, out = [], [], [[], [], [], []]
                for got in tool.documents(texts):
                    *n, spelled, keys, times = got or (0, 0, 0, 0, "", nothing, nothing)
                    a, b = keys >> ID_BITS, keys & ((1 << ID_BITS) - 1)
                    same = tool.identity[a] == b
                    counted.add(a[same], keys[~same])
                    numbers.append(n)
                    hashes.append(spelled)
                    for column, x in zip(out, (a[same], times[same], keys[~same], times[~same])):
                        column.append(x)
                columns = np.array(numbers, np.int64).T
                empty = lists([nothing] * (hi - lo))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id").slice(lo, hi - lo), batch.column("row").slice(lo, hi - lo), *[pa.array(c) for c in columns], pa.array(hashes, pa.string()),
                     *[lists(c) for c in out], empty, empty, empty], names=schema.names)
                if counted.held > PAIRS_HELD:
                    keys, sums = counted.squeeze()
                    if len(keys) > PAIRS_HELD // 2:
                        yield counts_batch(kind, nothing, keys, sums)
                        counted.keys, counted.sums, counted.held = [], [], 0
        ids = np.flatnonzero(counted.vector)
        if len(ids):
            yield counts_batch(kind, ids, nothing, counted.vector[ids])
        keys, sums = counted.squeeze()
        if len(keys):
            yield counts_batch(kind, nothing, keys, sums)

    return rows.select("id", "row", "text").mapInArrow(align, schema)


def _summed(found: DataFrame, column: str, name: str) -> DataFrame:
    """Documents per key from the tasks' rows."""
    entries = found.where("row is null").select(F.explode(F.arrays_zip(F.col(column).alias("k"), F.col("counts").alias("n"))).alias("e"))
    return entries.where("e.k is not null").groupBy(F.col("e.k").alias(name)).agg(F.sum("e.n").alias("docs"))


def pair_counts(found: DataFrame, identity: np.ndarray, stored) -> tuple[DataFrame, np.ndarray, np.ndarray]:
    """(``pair, docs, best`` of the pairs outside the identity map, documents per identity pair, highest count of every A id).
    Both vectors have one entry per id of A's vocabulary."""
    size = len(identity)
    pairs = stored(_summed(found, "counted_pairs", "pair"), "pair-counts")
    same, best = np.zeros(size, np.int64), np.zeros(size, np.int64)
    ids = _summed(found, "counted_ids", "id")
    high = pairs.groupBy(F.shiftright("pair", ID_BITS).alias("id")).agg(F.max("docs").alias("docs"))
    for got, vector in ((ids, same), (high, best)):                    # at most one row per id of the vocabulary
        table = got.select("id", "docs").toArrow()
        vector[table.column("id").to_numpy()] = table.column("docs").to_numpy()
    np.maximum(best, same, out=best)
    spark = found.sparkSession
    highest = spark.createDataFrame(pa.table({"id": np.arange(size), "best": best}))
    return pairs.join(F.broadcast(highest), F.shiftright("pair", ID_BITS) == F.col("id")).select("pair", "docs", "best"), same, best


LOOKED_UP = T.StructType([T.StructField("row", LONG), T.StructField("n_best", LONG), T.StructField("count_sum", LONG),
                          T.StructField("rest", LONGS), T.StructField("rest_times", LONGS)])


def looked_up(documents: DataFrame, same: np.ndarray, best: np.ndarray, hot: np.ndarray, hot_docs: np.ndarray) -> DataFrame:
    """Sums over identity pairs and the frequent pairs ``hot`` (ascending); the pairs left over are kept as ``rest``."""
    def look(batches):
        ends = np.append(hot, np.iinfo(np.int64).max)
        for batch in batches:
            def flat(name):
                column = batch.column(name)
                return column.flatten().to_numpy(zero_copy_only=False), np.diff(column.offsets.to_numpy())

            (ids, size), (times, _), (pairs, pair_size), (pair_times, _) = map(flat, ("same", "same_times", "pairs", "pair_times"))
            rows = batch.num_rows
            of, pair_of = np.repeat(np.arange(rows), size), np.repeat(np.arange(rows), pair_size)
            at = np.searchsorted(ends, pairs)
            found = ends[at] == pairs
            docs = np.append(hot_docs, 0)[at]
            top = found & (docs == best[pairs >> ID_BITS])
            n_best, count_sum = np.zeros(rows, np.int64), np.zeros(rows, np.int64)
            np.add.at(n_best, of, times * (same[ids] == best[ids]))
            np.add.at(n_best, pair_of, pair_times * top)
            np.add.at(count_sum, of, times * same[ids])
            np.add.at(count_sum, pair_of, pair_times * np.where(found, docs, 0))
            left = np.bincount(pair_of[~found], minlength=rows)
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), pa.array(n_best), pa.array(count_sum), list_array(pairs[~found], left, pa.int64()),
                 list_array(pair_times[~found], left, pa.int64())], names=LOOKED_UP.names)

    return documents.select("row", "same", "same_times", "pairs", "pair_times").mapInArrow(look, LOOKED_UP)


def token_alignment(docs: DataFrame, byte_file: str, piece_file: str, stored, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: ``n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256``."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"), F.monotonically_increasing_id().alias("row"))
    found = stored(aligned(rows, byte_file, piece_file), "aligned")
    documents = found.where("row is not null")
    identity = aligner(byte_file, piece_file).identity
    pairs, same, best = pair_counts(found, identity, stored)
    total = pairs.agg(F.sum("docs")).first()[0] or 0
    frequent = pairs.where(F.col("docs") * HOT_SHARE > total).select("pair", "docs").toArrow().sort_by("pair")   # fewer than HOT_SHARE rows
    hot, hot_docs = frequent.column("pair").to_numpy(), frequent.column("docs").to_numpy()
    part = stored(looked_up(documents, same, best, hot, hot_docs), "looked-up")
    rest = (part.select("row", F.explode(F.arrays_zip("rest", "rest_times")).alias("e")).select("row", "e.rest", "e.rest_times")
            .join(pairs.where(F.col("docs") * HOT_SHARE <= total), F.col("rest") == F.col("pair"))
            .groupBy("row").agg(F.sum(F.col("rest_times") * F.col("docs")).alias("more_sum"),
                                F.sum(F.when(F.col("docs") == F.col("best"), F.col("rest_times")).otherwise(0)).alias("more_best")))
    sums = (part.select("row", "n_best", "count_sum").join(rest, "row", "left")
            .select("row", (F.col("n_best") + F.coalesce("more_best", F.lit(0))).alias("n_best"),
                    (F.col("count_sum") + F.coalesce("more_sum", F.lit(0))).alias("count_sum")))
    return documents.select("row", "id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256").join(sums, "row").select(
        F.col("id").alias(id_col), "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
