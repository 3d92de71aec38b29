"""Personal data by bootstrapped contextual extraction (operator 4).

Fixed patterns find the base spans: email, ip, card, phone.  They are the
seeds.  A looser shape per kind (numbers in other formats, spelled-out
addresses) yields candidate instances.  The one and two words before an
instance and the one and two words behind it are its lexical contexts, four
patterns of its kind.  Spark scores the graph of patterns and instances in
rounds, until a round adds no pattern:

* an instance's score is 1 for a seed, else 1 - prod(1 - score) over the
  trusted patterns that it stands in; it is known from ``trust`` on;
* a pattern's score is the summed score of its distinct instances over those
  instances plus all further occurrences of its words;
* a pattern with at least ``support`` distinct known instances and a score of
  at least ``trust`` is trusted from then on.

So identifiers that one pattern has made known induce patterns of their own,
and those make further ones known.  Scores never fall, so the rounds end.
Candidates in a trusted pattern become further spans, unless they overlap a
base span.

Texts are read twice (spans and contexts; occurrences of the contexts).  The
graph holds only contexts that can still qualify: ``support`` distinct
instances, and enough of them against the occurrences of their words.
Contexts pass a bit filter of fixed size before counting; nothing that grows
with the corpus reaches the driver.

Edge cases: null and empty texts have no spans (the digest is that of the
empty string); repeated rows and ids each get a row; extra columns are
ignored; scans are linear in the text length, also for very long words or
digit runs.  Offsets are code points, ends exclusive.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vaultmart.llm.common import blocks, shingle_hashes
from vaultmart.llm.decontamination import bit_filter, shingle_counts, text_words

KINDS = ("email", "ip", "card", "phone")

# The base patterns (possessive where a retry could not match).
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++)(?:\.[0-9]++)(?:\.[0-9]++)")
CARD = re.compile(r"[0-9](?:[\x20-]?+[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

# Looser shapes of the same kinds, only used behind trusted words.
LOOSE_DOMAIN = re.compile(r"(?:@| ?[(\[]at[)\]] ?| at )[A-Za-z0-9-]++(?:(?:\.| ?[(\[]dot[)\]] ?| dot )[A-Za-z0-9-]++)*+")
LOOSE = {
    "ip": re.compile(r"(?<![0-9A-Za-z:.])(?:[0-9]++(?:[.,][0-9]++){3}|[0-9A-Fa-f]{1,4}(?::{1,2}[0-9A-Fa-f]{1,4}){3,7})(?![0-9A-Za-z:])"),
    "card": re.compile(r"(?<![0-9])[0-9](?:[\x20._/-]?[0-9]){11,18}(?![0-9])"),
    "phone": re.compile(r"(?<![0-9])(?:\(|[0-9])[0-9() ./-]{5,24}[0-9](?![0-9])"),
}


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def _local_start(text: str, at: int, lowest: int) -> int:
    while at > lowest and text[at - 1] in LOCAL:
        at -= 1
    return at


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of the base patterns, leftmost and non-overlapping per kind."""
    out, end = [], 0
    at = text.find("@")
    while at >= 0:
        m = DOMAIN.match(text, at)
        start = _local_start(text, at, end) if m else at
        if start < at:
            end = m.end()
            out.append((0, start, end))
        at = text.find("@", max(at + 1, end))
    for m in IP.finditer(text):
        if all(len(p.lstrip("0")) < 4 and int(p.lstrip("0") or "0") <= 255 for p in m[0].split(".")):
            out.append((1, *m.span()))
    for m in CARD.finditer(text):
        if 13 <= m.end() - m.start() <= 37:
            digits = m[0].replace(" ", "").replace("-", "")
            if 13 <= len(digits) <= 19 and luhn(digits):
                out.append((2, *m.span()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 9 <= sum(c.isdigit() for c in m[0]) <= 15:
                out.append((3, *m.span()))
    return out


def loose_spans(text: str, taken: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Candidate spans of the looser shapes that overlap no base span."""
    out, end = [], 0
    if "@" in text or "at" in text:
        for m in LOOSE_DOMAIN.finditer(text):
            start = _local_start(text, m.start(), end)
            if start < m.start() and ("@" in m[0] or "." in m[0] or "dot" in m[0]):
                end = m.end()
                out.append((0, start, end))
    for kind in (1, 2, 3):
        for m in LOOSE[KINDS[kind]].finditer(text):
            if kind != 3 or 7 <= sum(c.isdigit() for c in m[0]) <= 15:
                out.append((kind, *m.span()))
    busy = sorted((s, e) for _, s, e in taken)
    starts = [s for s, _ in busy]
    ends = np.maximum.accumulate([e for _, e in busy]) if busy else np.zeros(0)
    keep = []
    for span in out:
        before = int(np.searchsorted(starts, span[2])) - 1    # the last base span that starts before this one ends
        if before < 0 or ends[before] <= span[1]:
            keep.append(span)
    return keep


CONTEXTS = ("near", "far", "next", "beyond")                 # one and two words before, one and two words behind
SPAN = pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("end", pa.int32()), ("seed", pa.bool_()),
                  ("instance", pa.int64()), *[(c, pa.int64()) for c in CONTEXTS]])


def scan(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``row, id, spans`` per row: base spans and candidates with an instance
    hash and the hashes of the words of its ``CONTEXTS``."""
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    span = T.StructType([T.StructField("kind", T.IntegerType()), T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()),
                         T.StructField("seed", T.BooleanType()), T.StructField("instance", T.LongType()),
                         *[T.StructField(c, T.LongType()) for c in CONTEXTS]])
    schema = T.StructType([rows.schema["row"], rows.schema["id"], T.StructField("spans", T.ArrayType(span, False))])

    def find(batches):
        for b in batches:
            texts = b.column("text").to_pylist()
            for lo, hi in blocks(texts):
                part = texts[lo:hi]
                got = []
                for t in part:
                    base = base_spans(t) if t else []
                    loose = loose_spans(t, base) if t else []
                    got.append([(*s, True) for s in base] + [(*s, False) for s in loose])
                yield pa.RecordBatch.from_arrays([b.column("row").slice(lo, hi - lo), b.column("id").slice(lo, hi - lo),
                                                  pa.array(with_contexts(part, got), pa.list_(SPAN))], names=schema.names)

    return rows.mapInArrow(find, schema)


def with_contexts(texts: list, spans: list[list]) -> list[list[dict]]:
    some = [i for i, s in enumerate(spans) if s]
    out: list[list[dict]] = [[] for _ in texts]
    if not some:
        return out
    _, starts, ends, first, words = text_words([texts[i] for i in some])
    one = shingle_hashes(words, 1).view(np.int64) if len(words) else words.view(np.int64)
    two = shingle_hashes(words, 2).view(np.int64) if len(words) > 1 else words[:0].view(np.int64)
    at = 0
    for j, i in enumerate(some):
        for kind, start, end, seed in spans[i]:
            w = int(np.searchsorted(ends, at + 1 + start, "right")) - 1   # last word that ends before the span
            v = int(np.searchsorted(starts, at + 1 + end))                # first word that begins behind it
            inside, left = w - int(first[j]), int(first[j + 1]) - v
            out[i].append({"kind": kind, "start": start, "end": end, "seed": seed,
                           "instance": np.uint64(xxhash.xxh64_intdigest(texts[i][start:end].lower())).astype(np.int64).item(),
                           "near": int(one[w]) if inside >= 0 else None, "far": int(two[w - 1]) if inside >= 1 else None,
                           "next": int(one[v]) if left >= 1 else None, "beyond": int(two[v]) if left >= 2 else None})
        at += len(texts[i]) + 1
    return out


def in_contexts(spans: DataFrame, *columns: str) -> DataFrame:
    """One row per span and context: ``columns``, ``side`` (place in ``CONTEXTS``) and ``context``."""
    return spans.select(*columns, F.posexplode(F.array(*CONTEXTS)).alias("side", "context")).where("context is not null")


def trusted_patterns(found: DataFrame, docs: DataFrame, text_col: str, stored, support: int, trust: float) -> DataFrame:
    """``kind, side, context, score`` of the patterns that may add spans."""
    pattern = ["kind", "side", "context"]
    spans = found.select(F.explode("spans").alias("s")).select("s.*")
    edges = in_contexts(spans, "kind", "instance", "seed").groupBy(*pattern, "instance").agg(
        F.max("seed").alias("seed"), F.count("*").alias("uses"))
    edges = stored(edges, "edges")
    possible = stored(edges.groupBy(*pattern).agg(F.count("*").alias("instances"), F.sum("uses").alias("uses"))
                      .where(F.col("instances") >= support), "possible")
    counts = shingle_counts(docs, text_col, bit_filter(possible, "context"), [1, 2]).withColumnRenamed("shingle", "context")
    elsewhere = F.greatest(F.coalesce("n", F.lit(0)), F.col("uses")) - F.col("uses")
    patterns = (possible.join(counts, "context", "left").select(*pattern, "instances", (F.col("instances") + elsewhere).alias("weight"))
                .where(F.col("instances") >= trust * F.col("weight")))
    graph = stored(edges.join(stored(patterns, "patterns"), pattern), "graph")
    trusted, size = None, 0
    while True:
        if trusted is None:
            held = graph.withColumn("held", F.lit(None).cast("double"))
        else:
            held = graph.join(trusted.select(*pattern, F.col("score").alias("held")), pattern, "left")
        doubt = F.exp(F.sum(F.log1p(-F.least(F.coalesce("held", F.lit(0.0)), F.lit(0.999999)))))
        instances = held.groupBy("kind", "instance").agg(F.when(F.max("seed"), 1.0).otherwise(1 - doubt).alias("score"))
        now = (graph.join(instances, ["kind", "instance"]).groupBy(*pattern)
               .agg((F.sum("score") / F.max("weight")).alias("score"), F.count_if(F.col("score") >= trust).alias("known"))
               .where((F.col("score") >= trust) & (F.col("known") >= support)))
        trusted = stored(now.select(*pattern, "score"), "trusted")
        if trusted.count() == size:
            return trusted
        size = trusted.count()


def personal_data(docs: DataFrame, stored, id_col: str = "doc_id", text_col: str = "text", support: int = 5,
                  trust: float = 0.8) -> DataFrame:
    """``row, id, base, spans`` per row: arrays of (kind, start, end), sorted;
    ``spans`` holds the base spans and those that trusted patterns add."""
    found = stored(scan(docs, id_col, text_col), "spans")
    patterns = trusted_patterns(found, docs, text_col, stored, support, trust).select("kind", "side", "context")
    loose = found.select("row", F.explode(F.filter("spans", lambda s: ~s["seed"])).alias("s")).select("row", "s.*")
    added = (in_contexts(loose, "row", "kind", "start", "end")
             .join(patterns, ["kind", "side", "context"]).groupBy("row").agg(F.collect_set(F.struct("kind", "start", "end")).alias("more")))
    base = F.transform(F.filter("spans", lambda s: s["seed"]), lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")))
    return (found.select("row", "id", F.array_sort(base).alias("base")).join(added, "row", "left")
            .select("row", "id", "base", F.array_sort(F.concat("base", F.coalesce("more", F.array().cast("array<struct<kind:int,start:int,end:int>>")))).alias("spans")))


def of_kind(spans: str, kind: int):
    """Number of spans of one kind.  (The lambda has one parameter: Spark passes the place in the array as a second one.)"""
    return F.size(F.filter(spans, lambda s: s["kind"] == kind))


def spelled(spans: str):
    """``kind:start:end`` of a span array, comma-joined."""
    kinds = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(kinds, s["kind"] + 1), s["start"], s["end"])), ",")
