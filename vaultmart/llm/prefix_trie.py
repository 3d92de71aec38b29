"""Conversation prefix trie (operator 11).

Conversations are rows of turn digests in sorted order, so every trie node is
a run of neighbours.  Each range partition builds its own forest: the depths
of the common prefixes of neighbours are edges, a union-find takes them in
descending depth, and every merge of components makes a branching node.  A
node that holds neither the first nor the last conversation of its partition
is complete; the others (the two spines) are contracted to their sums over
complete children.  The spines of all partitions, a few rows per partition
whatever the partition holds, are merged across the boundaries by the same
union-find, and the nodes waiting for the identity of a spine parent are
joined to it.  Nodes between two branchings are spelled out at the end.

Texts never move: a turn travels as 16 bytes of SHA-256 and its byte count.
Equal conversations are one row before the sort; their ids travel as joined
strings of at most ``ID_CHUNK`` ids, hashed in a stream, so a group of copies
that holds a third of all conversations is neither a row nor a list.

Defined results: turns are ordered by turn (null first), then role, then
digest, so ties and repeated rows have one order; null role or text is the
empty string; a turn's bytes are those of its text in UTF-8; rows without
conv_id belong to no conversation; a conversation left without turns is a
member of the root only; an empty table has no root; extra columns are
ignored.  Memory per task: the digests of one range partition (24 bytes a
turn).  The digests of one conversation are one value of a row; very long
texts cost nothing beyond their scan.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

DIGEST = 16                    # bytes of a turn's digest
ID_CHUNK = 256                 # ids a joined string holds at most (a power of two)
EMPTY = hashlib.sha256(b"").hexdigest()

NODE = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
KINDS = {"ends_sha256": T.StringType(), "cums": T.ArrayType(T.LongType()), "first_key": T.BinaryType(), "last_key": T.BinaryType()}
FOREST = T.StructType([T.StructField(c, KINDS.get(c, T.LongType())) for c in
                       [*NODE, "part", "open_id", "open_parent", "saved_below", "cums", "first_key", "last_key"]])


# ---- conversations as digests -------------------------------------------------------------------------

def turn_digests(turns: DataFrame) -> DataFrame:
    """``conv, turn, role, digest, size`` for every turn: what the trie needs of a text."""
    role, text = F.coalesce(F.col("role").cast("string"), F.lit("")), F.coalesce(F.col("text").cast("string"), F.lit(""))
    spelled = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    return turns.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv"), "turn", role.alias("role"),
        F.substring(F.sha2(spelled, 256), 1, 2 * DIGEST).alias("digest"), F.octet_length(text).cast("long").alias("size"))


def in_order(digests: DataFrame) -> DataFrame:
    """One row per conversation: ``conv, key`` (digests in turn order) and ``sizes``."""
    turns = digests.groupBy("conv").agg(F.sort_array(F.collect_list(F.struct("turn", "role", "digest", "size"))).alias("t"))
    return turns.select("conv", F.unhex(F.array_join("t.digest", "")).alias("key"), F.col("t.size").alias("sizes"))


def with_shared_heads(convs: DataFrame, family: int, heads: int) -> DataFrame:
    """Every conversation c opens with the first h turns of c - c % ``family`` (h = crc32(c) % ``heads``), then has its own beyond h."""
    most = heads - 1
    base = convs.select(F.col("conv").alias("base"), F.substring("key", 1, most * DIGEST).alias("head"),
                        F.slice("sizes", 1, most).alias("head_sizes"))
    h = (F.crc32(F.col("conv").cast("string").cast("binary")) % heads).cast("int")
    own = convs.withColumn("base", F.col("conv") - F.col("conv") % family).withColumn("h", h)
    joined = own.join(base.where(F.col("base") % family == 0), "base", "left")
    return joined.select(
        "conv",
        F.concat(F.coalesce(F.expr(f"substring(head, 1, h * {DIGEST})"), F.lit(b"")),
                 F.expr(f"substring(key, h * {DIGEST} + 1)")).alias("key"),
        F.concat(F.coalesce(F.expr("slice(head_sizes, 1, h)"), F.expr("cast(array() as array<bigint>)")),
                 F.expr("slice(sizes, h + 1, greatest(size(sizes) - h, 0))")).alias("sizes"))


# ---- the union-find -----------------------------------------------------------------------------------

class Node:
    """A (possibly still growing) node: sums over its children, and bytes up to each depth of its path."""

    __slots__ = ("depth", "conv", "n", "kids", "leaves", "below", "ends", "cums", "floor", "open", "parent", "waits")

    def __init__(self, depth, cums, floor=0, conv=None, n=0, kids=0, leaves=0, below=0, ends=None, open=False):
        self.depth, self.cums, self.floor = depth, cums, floor         # cums[i]: bytes of the first floor + i turns
        self.conv, self.n, self.kids, self.leaves, self.below = conv, n, kids, leaves, below
        self.ends, self.open, self.parent, self.waits = ends, open, None, None

    def bytes_to(self, depth: int) -> int:
        return int(self.cums[depth - self.floor])

    def add(self, conv, n, kids, leaves, below):
        self.conv = conv if self.conv is None else self.conv if conv is None else min(self.conv, conv)
        self.n += n
        self.kids += kids
        self.leaves += leaves
        self.below += below

    def adopt(self, child: Node) -> None:
        child.parent = self
        if child.open:
            self.open = True                                           # its sums are not known yet
        else:
            saved = child.below + (child.n - 1) * (child.bytes_to(child.depth) - child.bytes_to(self.depth))
            self.add(child.conv, child.n, 1, child.leaves or 1, saved)

    def absorb(self, same: Node) -> None:
        """Two names of one node become this one."""
        self.add(same.conv, same.n, same.kids, same.leaves, same.below)
        self.ends = self.ends if self.ends is not None else same.ends
        self.open |= same.open
        same.parent, same.depth = self, -1                             # an alias


def grow(nodes: list[Node], edges) -> tuple[list[Node], list[Node]]:
    """Union-find over ``edges`` (depth, i, j) in descending depth: (all nodes but aliases, nodes without parent)."""
    root, tops = list(range(len(nodes))), {i: [v] for i, v in enumerate(nodes)}

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    made = []
    order = sorted(edges, key=lambda e: -e[0])
    at = 0
    while at < len(order):
        depth, touched = order[at][0], set()
        while at < len(order) and order[at][0] == depth:
            a, b = find(order[at][1]), find(order[at][2])
            at += 1
            if a == b:
                continue
            if len(tops[a]) < len(tops[b]):
                a, b = b, a
            root[b] = a
            tops[a] += tops.pop(b)
            touched.discard(b)
            touched.add(a)
        for a in touched:
            here = [v for v in tops[a] if v.depth == depth]
            under = [v for v in tops[a] if v.depth > depth]
            if here:
                node = here[0]
            else:
                node = Node(depth, under[0].cums, under[0].floor)
                made.append(node)
            for v in here[1:]:
                node.absorb(v)
            for v in under:
                node.adopt(v)
            tops[a] = [node]
    return [v for v in nodes if v.depth >= 0] + made, [t[0] for t in tops.values()]


def settled(node: Node) -> Node:
    while node.depth < 0:
        node = node.parent
    return node


def chains(nodes: list[Node], part: int, ids: dict) -> pa.RecordBatch:
    """Rows of finished nodes, and of the nodes between each and its parent (kept as ``open_parent`` where that is open)."""
    k = len(nodes)
    got = lambda f, kind=np.int64: np.fromiter(map(f, nodes), kind, k)
    depth = got(lambda v: v.depth)
    top = got(lambda v: settled(v.parent).depth if v.parent else -1)
    conv, n, kids, leaves = got(lambda v: v.conv), got(lambda v: v.n), got(lambda v: v.kids), got(lambda v: v.leaves or 1)
    below, full = got(lambda v: v.below), got(lambda v: v.bytes_to(v.depth))
    parents = [settled(v.parent) if v.parent else None for v in nodes]
    above = np.fromiter((-1 if p is None or p.open else p.conv for p in parents), np.int64, k)
    waits = np.fromiter((ids[id(p)] if p is not None and p.open else -1 for p in parents), np.int64, k)
    rows = depth - top
    last = np.cumsum(rows) - 1
    of = np.repeat(np.arange(k), rows)
    d = np.arange(len(of)) - np.repeat(last - rows + 1, rows) + top[of] + 1
    before = [np.asarray(v.cums[t - v.floor:v.depth - v.floor], np.int64) if t >= 0 else
              np.concatenate([[0], np.asarray(v.cums[0:v.depth], np.int64)]) for v, t in zip(nodes, top)]
    before = np.concatenate(before) if before else np.zeros(0, np.int64)
    first, end = d == top[of] + 1, np.zeros(len(of), bool)
    end[last] = True
    waiting = first & (waits[of] >= 0)
    hashes = np.full(len(of), EMPTY, object)
    hashes[last] = [EMPTY if v.ends is None else v.ends for v in nodes]
    no_parent = waiting | (d == 0)
    ints = lambda x, null=None: pa.array(x, pa.int64(), mask=null)
    nothing = lambda kind: pa.nulls(len(of), kind)
    return pa.RecordBatch.from_arrays(
        [ints(conv[of]), ints(d), ints(np.where(first, above[of], conv[of]), no_parent), ints(n[of]), ints(np.where(end, kids[of], 1)),
         ints(leaves[of]), ints(below[of] + (n[of] - 1) * (full[of] - before)), pa.array(hashes, pa.string()),
         ints(np.full(len(of), part)), nothing(pa.int64()), ints(waits[of], ~waiting), nothing(pa.int64()),
         nothing(pa.list_(pa.int64())), nothing(pa.binary()), nothing(pa.binary())], names=FOREST.names)


def spine(nodes: list[Node], part: int, ids: dict, first: Node, last: Node, keys) -> pa.RecordBatch:
    """Rows of the open nodes of a partition, contracted to the sums over their complete children."""
    column = {name: [] for name in FOREST.names}
    for v in nodes:
        parent = settled(v.parent) if v.parent else None
        floor = parent.depth if parent else 0
        row = dict(conv_id=v.conv, depth=v.depth, parent_conv_id=None, n_convs=v.n, n_children=v.kids, n_leaves=v.leaves, saved_tokens=None,
                   ends_sha256=v.ends, part=part, open_id=ids[id(v)], open_parent=None if parent is None else ids[id(parent)],
                   saved_below=v.below, cums=[int(x) for x in v.cums[floor - v.floor:v.depth + 1 - v.floor]],
                   first_key=keys[0] if v is first else None, last_key=keys[1] if v is last else None)
        for name, values in column.items():
            values.append(row[name])
    kinds = [pa.string() if n == "ends_sha256" else pa.list_(pa.int64()) if n == "cums" else pa.binary() if n.endswith("key") else pa.int64()
             for n in FOREST.names]
    return pa.RecordBatch.from_arrays([pa.array(column[n], k) for n, k in zip(FOREST.names, kinds)], names=FOREST.names)


def common_turns(a: bytes, b: bytes) -> int:
    """Number of leading turns that two keys share."""
    lo, hi = 0, min(len(a), len(b)) // DIGEST
    step = 1
    while lo < hi:
        to = min(lo + step, hi)
        if a[lo * DIGEST:to * DIGEST] == b[lo * DIGEST:to * DIGEST]:
            lo, step = to, 2 * step
        elif step == 1 or to == lo + 1:
            return lo
        else:
            hi, step = to, max(1, (to - lo) // 2)
    return lo


def distinct_conversations(batches):
    """(key, cums, smallest id, members, hash of the ids) per distinct conversation of a sorted partition."""
    key = None
    for batch in batches:
        for k, sizes, n, low, text in zip(*(batch.column(c).to_pylist() for c in ("key", "sizes", "n", "low", "ids"))):
            if k != key:
                if key is not None:
                    yield key, cums, conv, count, ids.hexdigest()
                key, conv, count, ids = k, low, n, hashlib.sha256(text.encode())
                cums = np.concatenate([[0], np.cumsum(np.asarray(sizes, np.int64))])
            else:
                count += n
                ids.update(b"," + text.encode())
    if key is not None:
        yield key, cums, conv, count, ids.hexdigest()


def partition_forest(batches):
    """Forest of one sorted range partition: complete nodes, then the two spines."""
    from pyspark import TaskContext

    part = TaskContext.get().partitionId()
    nodes, edges, key, first_key = [], [], None, None
    for k, cums, conv, n, ids in distinct_conversations(batches):
        if key is None:
            first_key = k
        else:
            edges.append((common_turns(key, k), len(nodes) - 1, len(nodes)))
        nodes.append(Node(len(k) // DIGEST, cums, 0, conv, n, ends=ids))
        key = k
    if not nodes:
        return
    first, last = nodes[0], nodes[-1]
    first.open = last.open = True
    everything, _ = grow(nodes, edges)
    spines = [v for v in everything if v.open]
    ids = {id(v): i for i, v in enumerate(spines)}
    done = [v for v in everything if not v.open]
    for at in range(0, len(done), 4096):
        yield chains(done[at:at + 4096], part, ids)
    yield spine(spines, part, ids, first, last, (first_key, key))


def merged_spines(batches):
    """Merge the spines of all partitions, in order: their nodes, and what became of each open node (``open_id`` set)."""
    nodes, edges, names, at, last = [], [], [], {}, None
    for batch in batches:
        for r in batch.to_pylist():
            here = (r["part"], r["open_id"])
            at[here] = len(nodes)
            names.append((here, r["open_parent"], r["first_key"], r["last_key"]))
            nodes.append(Node(r["depth"], r["cums"], r["depth"] + 1 - len(r["cums"]), r["conv_id"], r["n_convs"], r["n_children"], r["n_leaves"],
                              r["saved_below"], r["ends_sha256"]))
    if not nodes:
        return
    firsts = {here[0]: (at[here], first) for here, _, first, _ in names if first is not None}
    lasts = {here[0]: (at[here], key) for here, _, _, key in names if key is not None}
    for (part, own), parent, _, _ in names:
        if parent is not None:
            edges.append((nodes[at[part, parent]].depth, at[part, own], at[part, parent]))
    for part in sorted(firsts):
        if last is not None:
            edges.append((common_turns(last[1], firsts[part][1]), last[0], firsts[part][0]))
        last = lasts[part]
    everything, (top,) = grow(nodes, edges)
    if top.depth > 0:
        root = Node(0, top.cums, top.floor)
        root.adopt(top)
        everything.append(root)
    yield chains(everything, -1, {})
    became = [(*here, settled(nodes[i]).conv) for here, i in at.items()]
    none = pa.nulls(len(became), pa.int64())
    given = {"conv_id": pa.array([c for _, _, c in became], pa.int64()), "part": pa.array([p for p, _, _ in became], pa.int64()),
             "open_id": pa.array([o for _, o, _ in became], pa.int64()), "ends_sha256": pa.nulls(len(became), pa.string()),
             "cums": pa.nulls(len(became), pa.list_(pa.int64())), "first_key": pa.nulls(len(became), pa.binary()),
             "last_key": pa.nulls(len(became), pa.binary())}
    yield pa.RecordBatch.from_arrays([given.get(n, none) for n in FOREST.names], names=FOREST.names)


# ---- the operator -------------------------------------------------------------------------------------

def prefix_trie(convs: DataFrame, stored, partitions: int | None = None) -> DataFrame:
    """Trie nodes of conversations given as ``conv, key, sizes`` (see ``in_order``): columns ``NODE``."""
    n = partitions or int(convs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    chunks = (convs.groupBy("key", "sizes", F.shiftright("conv", ID_CHUNK.bit_length() - 1).alias("chunk"))
              .agg(F.sort_array(F.collect_list("conv")).alias("c"))
              .select("key", "sizes", "chunk", F.size("c").cast("long").alias("n"), F.element_at("c", 1).alias("low"),
                      F.array_join(F.col("c").cast("array<string>"), ",").alias("ids")))
    chunks = stored(chunks, "conversations")                           # the range partitioning samples its input first
    ordered = chunks.repartitionByRange(n, "key").sortWithinPartitions("key", "chunk")
    forest = stored(ordered.mapInArrow(partition_forest, FOREST), "forest")
    spines = forest.where("open_id is not null")
    merged = stored(spines.repartition(1).sortWithinPartitions("part", "open_id").mapInArrow(merged_spines, FOREST), "spines")
    became = merged.where("open_id is not null").select("part", F.col("open_id").alias("open_parent"), F.col("conv_id").alias("found"))
    closed = forest.where("open_id is null")
    waiting = (closed.where("open_parent is not null").join(became, ["part", "open_parent"])
               .withColumn("parent_conv_id", F.col("found")))
    return (closed.where("open_parent is null").select(*NODE).unionByName(waiting.select(*NODE))
            .unionByName(merged.where("open_id is null").select(*NODE)))


def conversation_trie(turns: DataFrame, stored, family: int | None = None, heads: int = 9) -> DataFrame:
    """Trie of a table of turns (``conv_id, turn, role, text``); with ``family``, conversations share opening turns first."""
    convs = in_order(turn_digests(turns))
    if family:
        convs = with_shared_heads(stored(convs, "turns"), family, heads)
    return prefix_trie(convs, stored)
