"""Operator 10: n-gram Jaccard join by T-occurrence search.

Two documents link when 100 * |x & y| >= 75 * |x | y| over their sets of five-word shingles (A-Z in lower case; a text
of fewer words is one shingle). No link is lost, and no group is expanded into all its pairs:

1. Equal sets are one node. Linked sets of n shingles share at least ceil(3n/4), so among the first
   n - ceil(3n/4) + l of each in a common order (by hash; l = 30 in 100 of n) they share l. Sets that do not share
   so many of these with any others are out; passages that many documents share do not keep a set in.
2. For the rest, these shingles are put in order of frequency, rarest first, and only as many kept as linked sets
   must share one of: the rare shingles. Sets that share one fall in one block (connected components).
3. A block is searched in cells of about CELL sets. A cell's inverted index is searched for T-occurrence: with
   DivideSkip the short lists are heap-merged and the few long ones probed by binary search, so that the sets that
   reach the overlap are found with their exact overlap. Sets found linked leave the index: copies by the thousand
   cost one search.
4. Blocks of many cells have a few leaders in each cell; what these join is one group. Two sets of different groups and
   cells can only link through a rare shingle that both hold, so a set is searched against the cells that hold one of
   its rare shingles in another group, and of the groups that hold a shingle the largest does not search. How many sets
   that ships follows from how often rare shingles occur, not from the size of a block.

Where documents of a cell share nearly all of their shingles' number and still do not link, by the thousand, the last
step ships each of them to each such cell: rows grow with the square of their number over CELL.

Hashes have 64 bits; those by which the exchange counts shingles have KEPT_BITS beside their bucket, where two that meet
only make candidates. Edge cases: null and empty texts have no shingles and link with nothing; equal texts always link;
rows that repeat an id are further documents with that id; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from itertools import groupby
from math import log2

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from quillmill.llm import blocks as B
from quillmill.llm import text as T
from quillmill.llm.components import components, join_hubs
from quillmill.llm.store import delete, tidy, written

CELL, LEADERS = 256, 8
#: Most queries that a cell takes in one group.
QUERIES = 4096
#: Sets that ask for the cells of one shingle in one task.
ASKERS = 512
#: DivideSkip's weight of the logarithm of the longest list.
MU = 0.0085
LOW = T.U64((1 << B.KEPT_BITS) - 1)


def least_overlap(n: np.ndarray | int) -> np.ndarray | int:
    """Shingles that a set of n shares with any set it links with."""
    return (3 * n + 3) // 4


def _lowered(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Texts to find words in; taking the white space out would cost as much as all their shingles."""
    return T.lower_ascii(buf), off


class NodeSets:
    """Distinct shingle sets of a chunk, and which set each text has."""

    def __init__(self, buf: np.ndarray, off: np.ndarray, k: int):
        values, first = T.shingle_sets(buf, off, k)
        self.of_text, self.n_of_text = T.set_ids(values, first), np.diff(first)
        self.ids, lead = np.unique(self.of_text, return_index=True)
        self.ids, lead = self.ids[self.ids != 0], lead[self.ids != 0]
        self.values, self.start, self.n = values, first[lead], self.n_of_text[lead]

    def set(self, i: int) -> np.ndarray:
        return self.values[self.start[i] : self.start[i] + self.n[i]]

    def prefixes(self, buckets: int) -> tuple[np.ndarray, np.ndarray]:
        """Bucket keys of the first shingles, by hash, of all sets in turn, and where each set's start."""
        size = self.n - least_overlap(self.n) + np.maximum(1, 30 * self.n // 100)
        first = np.concatenate([[0], np.cumsum(size)])
        at = np.arange(first[-1]) + np.repeat(self.start - first[:-1], size)
        return B.bucket_keys(self.values[at], buckets), first


def _chunks(batch_or_table: pa.RecordBatch | pa.Table, k: int) -> Iterator[tuple[int, pa.Array, NodeSets]]:
    for block, ids, texts in zip(batch_or_table["block"].to_pylist(), batch_or_table["ids"], batch_or_table["texts"], strict=True):
        off, buf = B.expand(texts.as_py(), np.int64, np.uint8)
        own = B.ids_of(ids.as_py())
        for i, part, first in B.pieces(off, buf):
            yield block, own.slice(i, len(first) - 1), NodeSets(part, first, k)


def _frequencies(table: DataFrame, k: int, n: int) -> DataFrame:
    """(block, blob of the keys of the shared prefix shingles of its sets and their numbers of sets)."""

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = B.RunGatherer(n)

        def rows(parts: Iterator[tuple[int, bytes]]) -> Iterator[pa.RecordBatch]:
            for row in parts:
                yield B.binary_batch(["bucket", "data"], [row])

        for batch in batches:
            for block, _, nodes in _chunks(batch, k):
                if len(nodes.ids):
                    yield from rows(out.add(nodes.prefixes(n)[0], block))
        yield from rows(out.flush())

    def count(group: pa.Table) -> pa.Table:
        key, block, size = (np.concatenate(c) for c in zip(*(B.runs(x.as_py()) for x in group["data"]), strict=True))
        blocks, place = np.unique(block, return_inverse=True)
        block = np.repeat(place.astype(np.uint16 if len(blocks) <= 1 << 16 else np.int64), size)
        order = np.argsort(key)
        key, block = key[order], block[order]
        size = np.diff(np.append(np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])), len(key)))
        total = np.repeat(size, size)
        shared = total > 1
        key, block, total = key[shared], block[shared], total[shared]
        order = np.argsort(block, kind="stable")  # a radix sort, and keys stay ascending
        key, block, total = key[order], block[order], total[order]
        fresh = np.ones(len(key), bool)
        fresh[1:] = (key[1:] != key[:-1]) | (block[1:] != block[:-1])
        key, block, total = key[fresh], block[fresh], np.minimum(total[fresh], 2**31 - 1).astype(np.int32)
        edges = np.flatnonzero(np.concatenate([[True], block[1:] != block[:-1], [True]])) if len(block) else np.zeros(1, int)
        bucket = np.full(1, group["bucket"][0].as_py(), T.U64)
        rows = [(int(blocks[block[i]]), B.squeeze(bucket, B.pack_sorted(key[i:j]), total[i:j])) for i, j in zip(edges[:-1], edges[1:], strict=True)]
        return pa.Table.from_batches([B.binary_batch(["block", "data"], rows)])

    gathered = table.select("block", "ids", "texts").mapInArrow(gather, "bucket long, data binary")
    return gathered.groupBy("bucket").applyInArrow(count, "block long, data binary")


def _candidates(k: int, n: int, id_type: pa.DataType):
    """Cogroup of a block's chunks and shared shingles: rows of three kinds.

    0: (bucket, blob of rare shingles and sets), 1: (set, its shingles), 2: (set of a document, document, size).
    """

    def candidates(left: pa.Table, right: pa.Table) -> pa.Table:
        parts = [B.expand(x.as_py(), T.U64, np.uint8, np.int32) for x in right["data"]]
        shared = np.concatenate([B.unpack_sorted(p[1]) | (p[0] << T.U64(B.KEPT_BITS)) for p in parts]) if parts else np.zeros(0, T.U64)
        number = np.concatenate([p[2] for p in parts]) if parts else np.zeros(0, np.int32)
        order = np.argsort(shared)
        shared, number = shared[order], number[order]
        some_bits = np.zeros(1 << 22, bool)  # rules most shingles out before a binary search
        some_bits[shared & T.U64(len(some_bits) - 1)] = True
        kind, key, docs, size, data, seen = [], [], [], [], [], set()
        out = B.Gatherer(n, 1 << 62)
        for _, ids, nodes in _chunks(left, k):
            kind += [2] * len(ids)
            key += nodes.of_text.tolist()
            docs += ids.to_pylist()
            size += nodes.n_of_text.tolist()
            data += [None] * len(ids)
            if not len(shared) or not len(nodes.ids):
                continue
            prefix, first = nodes.prefixes(n)
            at, hit = np.zeros(len(prefix), np.int64), some_bits[prefix & T.U64(len(some_bits) - 1)]
            at[hit] = np.minimum(np.searchsorted(shared, prefix[hit]), len(shared) - 1)
            hit[hit] = shared[at[hit]] == prefix[hit]
            need = np.maximum(1, 2250 * nodes.n // 10000)
            some = np.add.reduceat(hit, first[:-1], dtype=np.int64) >= need
            for i in np.flatnonzero(some).tolist():
                node = int(nodes.ids[i])
                if node in seen:
                    continue
                seen.add(node)
                own, own_hit = prefix[first[i] : first[i + 1]], hit[first[i] : first[i + 1]]
                often = np.where(own_hit, number[at[first[i] : first[i + 1]]], 1)
                rare = np.lexsort((own, often))[: len(own) - need[i] + 1]
                rare = rare[own_hit[rare]]
                if len(rare):
                    kind.append(1)
                    key.append(node)
                    docs.append(None)
                    size.append(int(nodes.n[i]))
                    data.append(nodes.set(i).tobytes())
                    list(out.add(own[rare], np.full(len(rare), node)))
        for bucket, (token, node) in out.flush():
            kind.append(0)
            key.append(bucket)
            docs.append(None)
            size.append(0)
            data.append(B.squeeze(B.pack_sorted(token & LOW), node))
        return pa.table([pa.array(kind, pa.int32()), pa.array(key, pa.int64()), pa.array(docs, id_type), pa.array(size, pa.int64()), pa.array(data, pa.binary())], ["kind", "key", "doc_id", "n", "data"])

    return candidates


def _holders(value: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Rare shingles and the sets that hold them, from a row of kind 0."""
    token, node = B.expand(value, np.uint8, np.int64)
    return B.unpack_sorted(token), node


def _join_sets(group: pa.Table) -> pa.Table:
    """Edges (a, b) that join the sets of a bucket that share a rare shingle, one for each set at most."""
    token, node = (np.concatenate(c) for c in zip(*(_holders(x.as_py()) for x in group["data"]), strict=True))
    order = np.lexsort((node, token))
    token, node = token[order], node[order]
    same = np.flatnonzero(token[1:] == token[:-1])
    root: dict[int, int] = {}

    def find(x: int) -> int:
        top = x
        while (up := root.get(top, top)) != top:
            top = up
        while x != top:
            root[x], x = top, root.get(x, top)
        return top

    for x, y in zip(node[same].tolist(), node[same + 1].tolist(), strict=True):
        a, b = find(x), find(y)
        if a != b:
            root[max(a, b)] = min(a, b)
    pairs = [(x, find(x)) for x in list(root)]
    return _edges(pairs)


def _edges(pairs: list[tuple[int, int]]) -> pa.Table:
    return pa.table([pa.array([p[0] for p in pairs], pa.int64()), pa.array([p[1] for p in pairs], pa.int64())], ["a", "b"])


class InvertedIndex:
    """Inverted lists of the shingles of the given sets, ascending and one behind the other."""

    def __init__(self, sets: list[np.ndarray], members: list[int]):
        self.sizes, self.n = np.array([len(s) for s in sets]), max(1, len(sets))
        token = np.concatenate([sets[i] for i in members]) if members else np.zeros(0, T.U64)
        owner = np.repeat(np.array(members, np.int64), [len(sets[i]) for i in members])
        order = np.argsort(token)
        token = token[order]
        new = np.ones(len(token), bool)
        new[1:] = token[1:] != token[:-1]
        self.tokens, self.first = token[new], np.append(np.flatnonzero(new), len(token))
        self.placed = np.sort((np.cumsum(new) - 1) * self.n + owner[order])  # (list, owner) as one number
        self.owner = (self.placed % self.n).tolist()

    def search(self, query: np.ndarray) -> list[int]:
        """Sets that link with query: T-occurrence by DivideSkip, then the exact condition on sizes."""
        least = int(least_overlap(len(query)))
        if len(self.tokens) < least:
            return []
        at = np.minimum(np.searchsorted(self.tokens, query), len(self.tokens) - 1)
        at = at[self.tokens[at] == query]
        if len(at) < least:
            return []
        size = self.first[at + 1] - self.first[at]
        order = np.argsort(size, kind="stable")
        at, longest = at[order], int(size[order[-1]])
        n_long = min(int(least / (MU * log2(max(2, longest)) + 1)), least - 1)
        short, long = at[: len(at) - n_long], at[len(at) - n_long :]
        lists = [self.owner[a:b] for a, b in zip(self.first[short].tolist(), self.first[short + 1].tolist(), strict=True)]
        found = [(one, count) for one, same in groupby(heapq.merge(*lists)) if (count := sum(1 for _ in same)) >= least - n_long]
        if not found:
            return []
        own, overlap = np.array([f[0] for f in found]), np.array([f[1] for f in found])
        if len(long):  # a binary search of each found set in each long list
            wanted = long[:, None] * self.n + own
            near = np.minimum(np.searchsorted(self.placed, wanted), len(self.placed) - 1)
            overlap = overlap + (self.placed[near] == wanted).sum(0)
        return own[100 * overlap >= 75 * (len(query) + self.sizes[own] - overlap)].tolist()


def _read_sets(group: pa.Table) -> tuple[list[int], list[np.ndarray]]:
    return group["node"].to_pylist(), [np.frombuffer(x.as_py(), T.U64) for x in group["data"]]


def _search_cell(group: pa.Table) -> pa.Table:
    """Edges (a, b) that hold the linked sets of a cell together."""
    ids, sets = _read_sets(group)
    free = dict.fromkeys(sorted(range(len(ids)), key=lambda i: (len(sets[i]), ids[i])))
    index, indexed, edges = InvertedIndex(sets, sorted(free)), len(free), []
    while free:
        seed = next(iter(free))
        del free[seed]
        edge = [seed]
        while edge and free:
            if 2 * len(free) < indexed:
                index, indexed = InvertedIndex(sets, sorted(free)), len(free)
            for other in index.search(sets[edge.pop()]):
                if other in free:
                    del free[other]
                    edge.append(other)
                    edges.append((ids[other], ids[seed]))
    return _edges(edges)


def _search_rest(group: pa.Table) -> pa.Table:
    """Edges between the groups of sets from elsewhere (query) and those of a cell's own sets."""
    ids, sets = _read_sets(group)
    query, root = group["query"].to_pylist(), group["root"].to_pylist()
    index, edges = InvertedIndex(sets, [i for i in range(len(ids)) if not query[i]]), set()
    for i in range(len(ids)):
        if query[i]:
            edges.update((root[i], root[j]) for j in index.search(sets[i]) if root[j] != root[i])
    return _edges(sorted(edges))


def _explode_holders(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for bucket, value in zip(batch["bucket"].to_pylist(), batch["data"], strict=True):
            token, node = _holders(value.as_py())
            token = token | (T.U64(bucket) << T.U64(B.KEPT_BITS))
            yield pa.RecordBatch.from_arrays([pa.array(token.view(np.int64)), pa.array(node)], ["token", "node"])


def searches(known: DataFrame, holders: DataFrame) -> DataFrame:
    """(node, root, block, cell): which cells each set must be searched against, besides its own.

    known: (node, block, cell, root) of the sets of large blocks; holders: (token, node). Of the groups (roots) that
    hold a rare shingle, all but the largest search the cells in which another group holds it.
    """
    held = written(holders.join(known, "node").distinct(), "held")
    groups = held.groupBy("token", "root").agg(F.count("*").alias("n")).groupBy("token").agg(F.max_by("root", F.struct("n", "root")).alias("main"), F.count("*").alias("groups"), F.sum("n").alias("n"))
    groups = written(groups.where("groups > 1").select("token", "main", "n", F.col("n").alias("holders")), "mixed_tokens")
    with tidy(known.sparkSession):
        total = groups.agg(F.sum("n").alias("s")).first().s or 0
    mixed = written(join_hubs(held, groups, "token", total), "mixed", held, groups)
    # a row for each shingle, with its cells as an array: no row for each pair of a set and a cell that shares a shingle;
    # the sets that ask for a common shingle are dealt out over copies of its row
    copies = F.ceil(F.col("holders") / ASKERS).cast("int")
    targets = mixed.groupBy("token").agg(F.sort_array(F.collect_set("cell")).alias("cells"), F.first("holders").alias("holders"))
    targets = targets.select("token", "cells", F.explode(F.sequence(F.lit(0), copies - 1)).alias("copy"))
    asking = mixed.where("root != main").select("token", "node", "root", "block", "cell", F.pmod(F.xxhash64("node"), copies).cast("int").alias("copy"))
    reach = asking.join(targets, ["token", "copy"]).groupBy("node", "root", "block", "cell").agg(F.collect_set("cells").alias("cells"))
    out = reach.select("node", "root", "block", F.explode(F.array_remove(F.array_distinct(F.flatten("cells")), F.col("cell"))).alias("cell"))
    return written(out, "searches", mixed)


def _links(sets: DataFrame, parts: DataFrame, holders: DataFrame, n: int) -> DataFrame:
    """Edges (a, b) that join all linked sets. sets: (node, data); parts: (node, root), the blocks; holders: (token, node)."""
    heads = parts.select(F.col("root").alias("node"), "root").distinct()
    members = parts.unionByName(heads)
    sizes = members.groupBy("root").agg(F.count("*").alias("n"))
    with tidy(parts.sparkSession):
        total = sizes.agg(F.sum("n").alias("s")).first().s or 0
    cells = F.greatest(F.lit(1), F.ceil(F.col("size") / CELL)).cast("int")
    placed = join_hubs(members, sizes.withColumn("size", F.col("n")), "root", total).select("node", F.col("root").alias("block"), "size", cells.alias("cells"))
    placed = written(placed.withColumn("cell", F.pmod(F.xxhash64("node"), F.col("cells")).cast("int")), "placed", parts)
    chance = F.pmod(F.xxhash64("node", F.lit(99)), F.lit(1 << 20)) / F.lit(float(1 << 20))
    leads = (F.col("cells") > 1) & (chance < LEADERS / F.col("size"))
    spread = placed.withColumn("cell", F.explode(F.when(leads, F.sequence(F.lit(0), F.col("cells") - 1)).otherwise(F.array("cell"))))
    small = F.col("cells") == 1  # blocks of one cell share a group, which costs less than a group each
    keyed = spread.join(sets, "node").select("node", "data", F.when(small, F.pmod(F.xxhash64("block"), F.lit(n))).otherwise(F.col("block")).alias("g"), F.when(small, -1).otherwise(F.col("cell")).alias("c"))
    found = written(keyed.groupBy("g", "c").applyInArrow(_search_cell, "a long, b long"), "links")
    large = placed.where("cells > 1").select("node", "block", "cell")
    with tidy(parts.sparkSession):
        none = large.isEmpty()
    if none:
        delete(placed)
        return found
    roots = components(found)
    known = written(large.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node")), "known", placed, roots)
    asked = searches(known, holders)
    load = asked.groupBy("block", "cell").agg(F.ceil(F.count("*") / QUERIES).cast("int").alias("parts"))
    own = known.join(load, ["block", "cell"]).select("block", "cell", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), "node", "root", F.lit(False).alias("query"))
    queries = asked.join(load, ["block", "cell"]).select("block", "cell", F.pmod(F.xxhash64("node", F.lit(5)), F.col("parts")).cast("int").alias("part"), "node", "root", F.lit(True).alias("query"))
    rest = own.unionByName(queries).join(sets, "node").groupBy("block", "cell", "part").applyInArrow(_search_rest, "a long, b long")
    return written(found.unionByName(rest), "all_links", found, known, asked)


def jaccard_components(docs: DataFrame, k: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles and component_id (least id that links reach) of each row."""
    spark, kind = docs.sparkSession, docs.schema[id_col].dataType
    table = B.packed(docs, id_col, text_col, _lowered)
    n = B.buckets(table)
    shared = _frequencies(table, k, n)
    found = table.groupBy("block").cogroup(shared.groupBy("block")).applyInArrow(_candidates(k, n, to_arrow_type(kind)), f"kind int, key long, doc_id {kind.simpleString()}, n long, data binary")
    found = written(found, "candidates", table)
    held = found.where("kind = 0").select(F.col("key").alias("bucket"), "data")
    blocks = components(held.groupBy("bucket").applyInArrow(_join_sets, "a long, b long"))
    sets = found.where("kind = 1").groupBy(F.col("key").alias("node")).agg(F.first("data").alias("data"))
    links = _links(sets, blocks, held.mapInArrow(_explode_holders, "token long, node long"), n)
    roots = components(links, links)
    rows = found.where("kind = 2").select(F.col("key").alias("node"), "doc_id", F.col("n").alias("n_shingles"))
    some = rows.where("n_shingles > 0")
    nodes = some.groupBy("node").agg(F.min("doc_id").alias("least"), F.count("*").alias("n")).join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    nodes = written(nodes, "nodes", roots)
    with tidy(spark):
        total = nodes.agg(F.sum("n").alias("s")).first().s or 0
    groups = nodes.groupBy("root").agg(F.min("least").alias("component_id"), F.count("*").alias("n"))
    named = written(join_hubs(nodes.select("node", "root", F.col("n").alias("copies")), groups, "root", total).select("node", "component_id", F.col("copies").alias("n")), "named", nodes)
    joined = join_hubs(some, named, "node", total).select("doc_id", "n_shingles", "component_id")
    return written(joined.unionByName(rows.where("n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))), "components", found, named)


def drop_near_duplicates(docs: DataFrame, k: int = 5) -> DataFrame:
    """docs with one row of each component, whole: that with the least id.

    Ids are taken to tell rows apart. Of equal rows with one id one stays; different texts under one id stay, and so do
    rows with a null id.
    """
    found = jaccard_components(docs, k)
    kept = written(found.where("doc_id = component_id").groupBy("doc_id").agg(F.count("*").alias("rows")), "kept", found)
    # ids grow with the data and are never broadcast; hashing them, not sorting texts, settles a partition
    once = docs.join(kept.where("rows = 1").hint("shuffle_hash"), "doc_id", "left_semi").unionByName(docs.where("doc_id is null"))
    several = kept.where("rows > 1")
    return once if several.isEmpty() else once.unionByName(docs.join(several, "doc_id", "left_semi").distinct())
