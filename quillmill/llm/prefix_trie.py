"""Operator 11: the prefix trie of conversations, built compressed (Patricia) and then expanded.

A conversation is the sequence of its turns (role, text); a node is a distinct sequence of first turns. A turn travels as
KEY bytes, the MD5 of role and text and the text's length in code points, so that texts are read once and never shuffled
and a conversation is one binary value that sorts like its sequence.

1. Equal sequences become one row. Their conversations' ids are gathered in chunks of CHUNK consecutive ids, and the digest
   of a sequence's ids is taken chunk by chunk while they stream by in order, so that no list of ids is ever held whole.
2. The sequences are range-partitioned and sorted. Each range makes the points of its part of the trie only where a path
   branches or a conversation ends, out of the lengths that neighbours share, and adds up figures from the leaves to the root.
3. The nodes inside an edge differ from its lower end in nothing but saved tokens, which are suffix sums along the edge.

A path may lie in several ranges. Its nodes there are those that two neighbouring ranges share; every figure is a sum (or
least value) over ranges if each node belongs to the first range that it occurs in, so these rows alone are added up after.
Their number is at most the depth that neighbours share, for each border between ranges.

Edge cases: a null role or text is empty. Turns go in order of their number, nulls first, and equal numbers in order of the
MD5 of their role and text; a repeated row is a turn of its own. Rows without a conversation's id belong to none and are
left out. Further columns are ignored. An empty table has no conversations and so no nodes, not even a root. Texts may be of
any length; of one conversation the keys, 20 bytes a turn, are held at once, its texts are not.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillmill.llm.components import join_hubs
from quillmill.llm.store import delete, tidy, written

#: Bytes of a turn: its MD5, then its code points.
KEY = 20
#: Conversations are rebuilt on those whose id ends a group of SHARE, with under HEADS turns of it.
SHARE, HEADS = 100, 6
#: Ids that meet in one value are those that agree but for so many bits, and bytes of sequences in a range at most.
CHUNK_BITS, RANGE_BYTES = 12, 32 << 20
#: Fixed value: the digest of no ids.
NO_IDS = hashlib.sha256(b"").hexdigest()


def sequences(conversations: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """conv_id and seq, KEY bytes for each turn in order."""
    role, text = (F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in (role_col, text_col))
    name = F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text))
    code = F.concat(name, F.lpad(F.hex(F.char_length(text).cast("long")), 2 * (KEY - 16), "0"))
    turn = F.col(f"`{turn_col}`")
    rows = conversations.select(F.col(f"`{id_col}`").cast("long").alias("conv_id"), F.struct(turn.isNotNull().alias("known"), turn.alias("turn"), code.alias("code")).alias("t")).where("conv_id is not null")
    return rows.groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("t")).select("conv_id", F.unhex(F.array_join("t.code", "")).alias("seq"))


def rebuilt(own: DataFrame, share: int = SHARE, heads: int = HEADS) -> DataFrame:
    """own (conv_id, seq) with the first h turns those of conversation conv_id - conv_id % share; h = crc32(conv_id) % heads.

    own is read twice. A group's first conversation meets under share others, so no key is hot.
    """
    empty = F.unhex(F.lit(""))
    first = own.where(F.col("conv_id") % share == 0).select(F.col("conv_id").alias("base"), F.substring("seq", 1, KEY * (heads - 1)).alias("head"))
    rows = own.withColumns({"base": F.col("conv_id") - F.col("conv_id") % share, "h": (F.crc32(F.col("conv_id").cast("string")) % heads).cast("int") * KEY})
    seq = F.concat(F.substr(F.coalesce("head", empty), F.lit(1), F.col("h")), F.substr("seq", F.col("h") + 1, F.octet_length("seq")))
    return rows.join(first, "base", "left").select("conv_id", seq.alias("seq"))


def _distinct(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Chunks of ids in order of (seq, chunk) to one row for each sequence; edge marks the first and the last of the range."""
    part = TaskContext.get().partitionId()
    seq, digest, n, least, edge, out = None, None, 0, 0, True, []

    def batch() -> pa.RecordBatch:
        columns = zip(*out, strict=True)
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int32(), pa.binary(), pa.int64(), pa.int64(), pa.string(), pa.bool_()), strict=True)], ["part", "seq", "n", "least", "ends", "edge"])

    for rows in batches:
        for s, ids, m, first in zip(*(rows.column(c).to_pylist() for c in ("seq", "ids", "n", "least")), strict=True):
            if s != seq:
                if seq is not None:
                    out.append((part, seq, n, least, digest.hexdigest(), edge))
                    edge = False
                seq, digest, n, least = s, hashlib.sha256(ids.encode()), m, first
            else:
                digest.update(b"," + ids.encode())
                n, least = n + m, min(least, first)
        if len(out) >= 4096:
            yield batch()
            out = []
    if seq is not None:
        out.append((part, seq, n, least, digest.hexdigest(), True))
        yield batch()


def shared_turns(a: bytes, b: bytes) -> int:
    """Turns that two sequences have in common at the front."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n // KEY
    return int((np.frombuffer(a, np.uint8, n) != np.frombuffer(b, np.uint8, n)).argmax()) // KEY


class Patricia:
    """Points of the trie of sorted distinct sequences, and what they add up to.

    left and right are the turns that the first and the last sequence share with their neighbours outside, -1 without one.
    Nodes that the neighbour to the left holds too belong to it: their tokens, and being someone's child, count there.
    """

    def __init__(self, seqs: list[bytes], counts: list[int], least: list[int], left: int, right: int):
        self.seqs, self.left, self.right = seqs, left, right
        self.size = [len(s) // KEY for s in seqs]
        tokens = [np.frombuffer(s, np.dtype([("name", "V16"), ("n", ">u4")]))["n"] for s in seqs]
        self.first_sum = np.cumsum([0, *(n + 1 for n in self.size)])  # where a sequence's prefix sums start
        self.sums = np.concatenate([np.concatenate([[0], np.cumsum(t, dtype=np.int64)]) for t in tokens])
        self.depth, self.rep, self.parent, self.end, self.lo, self.hi = [0], [0], [-1], [-1], [0], [len(seqs) - 1]
        self.n, self.least, self.leaves, self.children, self.spent, self.held = [0], [least[0]], [0], [0], [0], [0]
        self.stack = [0]
        last = len(seqs) - 1
        if left > 0:
            self._push(left, 0)
        for j, s in enumerate(seqs):
            if j:
                self._close(shared_turns(seqs[j - 1], s))
            at = self.stack[-1] if self.depth[self.stack[-1]] == self.size[j] else self._push(self.size[j], j)
            after = right if j == last else shared_turns(s, seqs[j + 1])
            self.end[at], self.hi[at] = j, max(self.hi[at], j)
            self.n[at] += counts[j]
            self.least[at] = min(self.least[at], least[j])
            self.leaves[at] += after < self.size[j]
        self._close(max(right, 0))
        self._close(0)

    def _push(self, depth: int, j: int, least: int | None = None) -> int:
        for column, value in ((self.depth, depth), (self.rep, j), (self.parent, -1), (self.end, -1), (self.lo, j), (self.hi, j), (self.n, 0), (self.least, 2**63 - 1), (self.leaves, 0), (self.children, 0), (self.spent, 0), (self.held, 0)):
            column.append(value)
        self.stack.append(len(self.depth) - 1)
        return self.stack[-1]

    def owned(self, v: int) -> bool:
        return not (self.lo[v] == 0 and self.depth[v] <= self.left)

    def shared(self, v: int) -> bool:
        return not self.owned(v) or (self.hi[v] == len(self.seqs) - 1 and self.depth[v] <= self.right)

    def _close(self, depth: int) -> None:
        """Points deeper than depth are done; what they add up to goes to the point above, made at depth if there is none."""
        while self.depth[self.stack[-1]] > depth:
            v = self.stack.pop()
            if self.depth[self.stack[-1]] < depth:
                self._push(depth, self.rep[v])
                self.lo[-1] = self.lo[v]
            u = self.parent[v] = self.stack[-1]
            base = self.first_sum[self.rep[v]]
            tokens, own = int(self.sums[base + self.depth[v]] - self.sums[base + self.depth[u]]), self.owned(v)
            self.n[u] += self.n[v]
            self.least[u] = min(self.least[u], self.least[v])
            self.leaves[u] += self.leaves[v]
            self.children[u] += own
            self.spent[u] += self.spent[v] + self.n[v] * tokens
            self.held[u] += self.held[v] + own * tokens
            self.lo[u], self.hi[u] = min(self.lo[u], self.lo[v]), max(self.hi[u], self.hi[v])

    def nodes(self) -> dict[str, np.ndarray]:
        """Every node: point, depth, and the figures; saved is a suffix sum along the point's edge."""
        depth, parent = np.array(self.depth), np.array(self.parent)
        above = np.where(parent >= 0, depth[parent], -1)  # the root is an edge of its own
        length = depth - above
        point = np.repeat(np.arange(len(depth)), length)
        at = depth[point] - (np.arange(len(point)) - np.repeat(np.cumsum(length) - length, length))
        base = self.first_sum[np.array(self.rep)][point]
        along = self.sums[base + depth[point]] - self.sums[base + np.maximum(at - 1, 0)]
        own, n = np.array([self.owned(v) for v in range(len(depth))]), np.array(self.n, np.int64)
        lower, top = at == depth[point], at == above[point] + 1
        saved = (np.array(self.spent, np.int64) - np.array(self.held, np.int64))[point] + (n[point] - own[point]) * along
        return {
            "point": point, "depth": at, "top": top, "n_convs": n[point], "conv_id": np.array(self.least, np.int64)[point], "n_leaves": np.array(self.leaves, np.int64)[point],
            "n_children": np.where(lower, np.array(self.children, np.int64)[point], own[point]), "saved": saved, "end": np.where(lower, np.array(self.end)[point], -1),
            "shared": np.array([self.shared(v) for v in range(len(depth))])[point],
        }


_NODES = "shared boolean, key binary, parent_key binary, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"


def _build(borders: dict[int, tuple[int, int]]) -> Callable[[pa.Table], pa.Table]:
    def build(table: pa.Table) -> pa.Table:
        left, right = borders[table["part"][0].as_py()]
        table = table.sort_by("seq")
        seqs, ends = table["seq"].to_pylist(), [*table["ends"].to_pylist(), None]  # the last for nodes where none ends
        trie = Patricia(seqs, table["n"].to_pylist(), table["least"].to_pylist(), left, right)
        x = trie.nodes()
        parent = np.array(trie.parent)[x["point"]]
        root = x["depth"] == 0
        parent_shared = np.where(x["top"], np.array([trie.shared(v) for v in range(len(trie.depth))])[parent], x["shared"]) & ~root
        over = np.where(x["top"], np.array(trie.least, np.int64)[parent], x["conv_id"])
        rep, key, parent_key = np.array(trie.rep)[x["point"]], [None] * len(parent), [None] * len(parent)
        for i in np.flatnonzero(x["shared"] | parent_shared).tolist():
            path, d = seqs[rep[i]], int(x["depth"][i])
            key[i] = hashlib.md5(path[: KEY * d], usedforsecurity=False).digest()
            if d:
                parent_key[i] = hashlib.md5(path[: KEY * (d - 1)], usedforsecurity=False).digest()
        columns = {
            "shared": x["shared"], "key": pa.array(key, pa.binary()), "parent_key": pa.array(parent_key, pa.binary()), "conv_id": x["conv_id"], "depth": x["depth"],
            "parent_conv_id": pa.array(over, pa.int64(), mask=root | parent_shared), "n_convs": x["n_convs"], "n_children": x["n_children"], "n_leaves": x["n_leaves"], "saved_tokens": x["saved"],
            "ends_sha256": pa.array([ends[j] for j in x["end"].tolist()], pa.string()),
        }
        return pa.table({k: v if isinstance(v, pa.Array) else pa.array(v) for k, v in columns.items()})

    return build


def trie(seqs: DataFrame) -> DataFrame:
    """The nodes of seqs (conv_id, seq): conv_id (least member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    spark = seqs.sparkSession
    ids = F.sort_array(F.collect_list("conv_id"))
    chunks = seqs.groupBy("seq", F.shiftright("conv_id", CHUNK_BITS).alias("chunk")).agg(ids.alias("ids"))
    chunks = written(chunks.select("seq", "chunk", F.array_join(F.col("ids").cast("array<string>"), ",").alias("ids"), F.size("ids").cast("long").alias("n"), F.get("ids", F.lit(0)).alias("least")), "members")
    with tidy(spark):
        size = chunks.agg(F.sum(F.octet_length("seq") + F.octet_length("ids")).alias("s")).first().s or 0
    ranges = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // RANGE_BYTES))
    # equal sequences share a range, and stream by in order of their ids
    runs = chunks.repartitionByRange(ranges, "seq").sortWithinPartitions("seq", "chunk").mapInArrow(_distinct, "part int, seq binary, n long, least long, ends string, edge boolean")
    runs = written(runs, "sequences", chunks)
    with tidy(spark):
        edges: dict[int, list[bytes]] = {}
        for r in runs.where("edge").select("part", "seq").collect():  # two rows for each range at most
            edges.setdefault(r.part, []).append(bytes(r.seq))
    parts = sorted(edges)
    between = [-1, *(shared_turns(max(edges[a]), min(edges[b])) for a, b in zip(parts, parts[1:], strict=False)), -1]
    borders = {p: (between[i], between[i + 1]) for i, p in enumerate(parts)}
    nodes = written(runs.drop("edge").groupBy("part").applyInArrow(_build(borders), _NODES), "nodes", runs)
    figures = ["n_convs", "n_children", "n_leaves", "saved_tokens"]
    shared = nodes.where("shared").groupBy("key", "parent_key", "depth").agg(F.min("conv_id").alias("conv_id"), *(F.sum(c).alias(c) for c in figures), F.max("ends_sha256").alias("ends_sha256"))
    shared = written(shared, "shared_nodes")
    columns = ["conv_id", "depth", "parent_conv_id", *figures, "ends_sha256"]
    own = nodes.where("not shared and parent_key is null").select(*columns)
    top = shared.where("parent_key is null").withColumn("parent_conv_id", F.lit(None).cast("long")).select(*columns)
    below = nodes.where("not shared and parent_key is not null").drop("shared", "key", "parent_conv_id").unionByName(shared.drop("key").where("parent_key is not null"))
    counts = below.groupBy("parent_key").agg(F.count("*").alias("n"))
    with tidy(spark):
        total = below.count()
    parents = shared.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("parent_conv_id")).join(counts, "parent_key")
    joined = join_hubs(below, parents, "parent_key", total).select(*columns)
    out = own.unionByName(top).unionByName(joined).withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(NO_IDS)))
    return written(out, "trie", nodes, shared)


def conversation_trie(conversations: DataFrame, share: int = SHARE, heads: int = HEADS) -> DataFrame:
    """The trie of the conversations, each rebuilt on the first turns of its group's first one."""
    own = written(sequences(conversations), "conversations")
    whole = written(rebuilt(own, share, heads), "rebuilt", own)
    out = trie(whole)
    delete(whole)
    return out
