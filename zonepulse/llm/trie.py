"""Prefix trie of conversations, as balanced parentheses per shard.

A conversation is the path of its turns' digests.  Paths are sorted, cut into shards by range
(equal paths by conv_id, so a large group of copies is cut too), and every shard of about
``SHARD_TURNS`` turns writes the trie of its paths as balanced parentheses: a node is an opening
one, its subtree ends at the matching closing one.  ``findclose`` searches the excess (openings
less closings so far) through blocks and a range min tree over them; the leaves of a subtree are
the pairs ``()`` inside it, counted by rank, and conversations, members and savings are differences
of cumulative arrays in preorder.

A node that another shard may share lies on the path of its shard's first or last conversation.
Each shard hands on these two spines with what it holds at and beside their nodes; the spines are
paths with values and are sorted, sharded and solved in the same way, level by level, until one
shard holds all.  Every level has 1/32 or less of the paths of the one before.

Defined cases: rows without conv_id belong to no conversation; null role and text are empty; turns
are ordered by turn (null first), then role, then a digest of role and text, and repeated rows are
turns of their own; very long texts are read once, by their digest; an empty table has no node, not
even the root; other columns are not read.  Turns are told apart by md5.  One conversation is not
cut: its digests, 16 bytes a turn, are a value of one row.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import durable_once

SHARD_TURNS = 1 << 14
SHARD_PATHS = 64  # paths of a shard at least, however long they are
BLOCK = 32  # parentheses in a block of the range min tree
NO_ONE = (1 << 63) - 1
NO_ENDS = hashlib.sha256(b"").hexdigest()

NODE, SPINE, ENDS, CODE = range(4)
VALUES = ("e", "m", "ch", "lv", "sv")  # conversations, smallest id, children, leaves, savings
SCHEMA = pa.schema(
    [("kind", pa.int32()), ("shard", pa.int64()), ("side", pa.int32()), ("depth", pa.int64())]
    + [(c, pa.int64()) for c in ("conv_id", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens")]
    + [("ends_sha256", pa.string()), ("node", pa.binary()), ("path", pa.binary()), ("sizes", pa.list_(pa.int32())), ("start", pa.int32())]
    + [(c, pa.list_(pa.int64())) for c in VALUES]
    + [("nodes", pa.list_(pa.binary())), ("first", pa.int64()), ("ids", pa.string())]
)
DDL = (
    "kind int, shard long, side int, depth long, conv_id long, parent_conv_id long, n_convs long, n_children long, n_leaves long, "
    "saved_tokens long, ends_sha256 string, node binary, path binary, sizes array<int>, start int, e array<long>, m array<long>, "
    "ch array<long>, lv array<long>, sv array<long>, nodes array<binary>, first long, ids string"
)


class Parentheses:
    """A balanced sequence of +1 and -1 with a range min tree over the excess of its blocks."""

    def __init__(self, signs: np.ndarray):
        self.signs = signs
        self.excess = np.cumsum(signs, dtype=np.int64)
        n = -(-len(signs) // BLOCK)
        self.leaves = 1 << max(0, n - 1).bit_length()
        padded = np.full(self.leaves * BLOCK, np.iinfo(np.int64).max)
        padded[: len(signs)] = self.excess
        self.padded = padded
        self.tree = np.empty(2 * self.leaves, dtype=np.int64)
        self.tree[self.leaves :] = padded.reshape(-1, BLOCK).min(axis=1)
        width = self.leaves
        while width > 1:
            self.tree[width // 2 : width] = np.minimum(self.tree[width : 2 * width : 2], self.tree[width + 1 : 2 * width : 2])
            width //= 2

    def _in_block(self, at: np.ndarray, excess: np.ndarray) -> np.ndarray:
        """First place from ``at`` to the end of its block below ``excess``, or -1."""
        out = np.full(len(at), -1, dtype=np.int64)
        left = np.arange(len(at))
        at = at.copy()
        while len(left):
            hit = self.padded[at[left]] < excess[left]
            out[left[hit]] = at[left[hit]]
            left = left[~hit]
            at[left] += 1
            left = left[at[left] % BLOCK != 0]
        return out

    def findclose(self, opens: np.ndarray) -> np.ndarray:
        """The closing parenthesis of each opening one: the first later place of less excess."""
        excess = self.excess[opens]
        out = self._in_block(opens, excess)
        far = np.flatnonzero(out < 0)
        node = self.leaves + opens[far] // BLOCK + 1
        moving = np.arange(len(far))
        while len(moving):  # up and to the right, to a subtree that goes below
            moving = moving[self.tree[node[moving]] >= excess[far[moving]]]
            node[moving] = np.where(node[moving] & 1, (node[moving] + 1) >> 1, node[moving] + 1)
        moving = np.flatnonzero(node < self.leaves)
        while len(moving):  # down to its first block that does
            node[moving] *= 2
            node[moving] += self.tree[node[moving]] >= excess[far[moving]]
            moving = moving[node[moving] < self.leaves]
        out[far] = self._in_block((node - self.leaves) * BLOCK, excess[far])
        return out


def _shared(a: bytes, b: bytes) -> int:
    """Digests at the beginning that two paths have in common."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n // 16
    x, y = np.frombuffer(a, np.uint8, n), np.frombuffer(b, np.uint8, n)
    return int(np.argmax(x != y)) // 16


def _range_min(values: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Minimum of ``values[lo:hi]`` for each pair, by a sparse table."""
    width = hi - lo
    power = np.frexp(width)[1] - 1  # floor of the binary logarithm
    out = np.empty(len(lo), dtype=values.dtype)
    row, k = values, 0
    while True:
        here = power == k
        out[here] = np.minimum(row[lo[here]], row[hi[here] - (1 << k)])
        k += 1
        if not (power >= k).any():
            return out
        row = np.minimum(row[: -(1 << (k - 1))], row[1 << (k - 1) :])


def _node_ids(path: bytes, start: int) -> list[bytes]:
    """Digest of each prefix of the path, from ``start`` turns on."""
    h, out = hashlib.md5(path[: 16 * start]), []
    for d in range(start, len(path) // 16 + 1):
        out.append(h.copy().digest())
        h.update(path[16 * d : 16 * d + 16])
    return out


@dataclass
class Paths:
    """Sorted paths of a shard; values are attached to their nodes from depth ``start`` on."""

    path: list[bytes]
    sizes: list[np.ndarray]
    start: list[int]
    values: list[np.ndarray]  # five rows of VALUES, a column a depth
    conv: list[int] | None  # of conversations, at the lowest level


def _batch(rows: dict[str, list], n: int) -> pa.RecordBatch:
    columns = [pa.array(rows[f.name], f.type) if f.name in rows else pa.nulls(n, f.type) for f in SCHEMA]
    return pa.RecordBatch.from_arrays(columns, schema=SCHEMA)


def solve(shard: int, paths: Paths, last: bool) -> Iterator[pa.RecordBatch]:
    """Nodes of a shard's trie that no other shard shares, and its spines; all nodes if it is the last."""
    depths = np.array([len(p) // 16 for p in paths.path])
    common = np.array([0] + [_shared(a, b) for a, b in zip(paths.path, paths.path[1:])])
    opened = depths - common
    runs = np.zeros((len(depths) + 1, 2), dtype=np.int64)  # openings and the closings before the next path
    runs[0, 0], runs[1:, 0] = 1, opened
    runs[1:-1, 1], runs[-1, 1] = (depths[:-1] - common[1:]), depths[-1] + 1
    bp = Parentheses(np.repeat(np.tile(np.array([1, -1], np.int8), len(runs)), runs.ravel()))

    opens = np.flatnonzero(bp.signs == 1)
    closes = bp.findclose(opens)
    n = len(opens)
    here = np.arange(n)
    after = here + (closes - opens + 1) // 2  # first node beyond the subtree
    depth = bp.excess[opens] - 1
    childless = bp.signs[opens + 1] == -1

    ends = np.cumsum(opened)  # the node at the end of each path
    parent = here - 1
    size = np.zeros(n, dtype=np.int64)
    own = {v: np.zeros(n, dtype=np.int64) for v in VALUES}
    own["m"][:] = NO_ONE
    stack = np.zeros(int(depths.max()) + 1, dtype=np.int64)
    for i, (d, c, end) in enumerate(zip(depths, common, ends)):
        if d > c:
            stack[c + 1 : d + 1] = np.arange(end - (d - c) + 1, end + 1)
            parent[stack[c + 1]] = stack[c]
            size[stack[c + 1 : d + 1]] = paths.sizes[i][c:d]
        if paths.conv is None:
            at = stack[paths.start[i] : d + 1]
            for v, x in zip(VALUES, paths.values[i]):
                own[v][at] = np.minimum(own[v][at], x) if v == "m" else own[v][at] + x
    right = stack[: depths[-1] + 1].copy()
    if paths.conv is not None:
        conv = np.array(paths.conv, dtype=np.int64)
        np.add.at(own["e"], ends, 1)
        np.minimum.at(own["m"], ends, conv)

    def within(values: np.ndarray) -> np.ndarray:
        total = np.zeros(n + 1, dtype=np.int64)
        np.cumsum(values, out=total[1:])
        return total[after] - total[here]

    n_convs = within(own["e"])
    smallest = _range_min(own["m"], here, after)
    children = np.bincount(parent[1:], minlength=n) + own["ch"]
    leaves = within(own["lv"] + (childless & (own["ch"] == 0)))
    spine = np.zeros(n, dtype=bool)
    if not last:
        spine[: depths[0] + 1] = spine[right] = True
    saved = within(own["sv"] + np.where(spine, 0, (n_convs - 1) * size))

    side = np.full(n, -1)
    spines = [] if last else [(0, np.arange(depths[0] + 1), paths.path[0], paths.sizes[0], 0)]
    if not last:
        shared = _shared(paths.path[0], paths.path[-1])
        if depths[-1] > shared:
            spines.append((1, right[shared + 1 :], paths.path[-1], paths.sizes[-1], shared + 1))
        for s, at, *_ in spines:
            side[at] = s
        beside = here[(~spine) & (here > 0)]
        beside = beside[spine[parent[beside]]]
        above = parent[beside]
        held = {v: own[v].copy() for v in VALUES}
        for v, x in (("e", n_convs), ("ch", np.ones(n, np.int64)), ("lv", leaves), ("sv", saved)):
            np.add.at(held[v], above, x[beside])
        np.minimum.at(held["m"], above, smallest[beside])

    digests: dict[int, str] = {}
    late: list[tuple] = []
    if paths.conv is not None:
        cuts = np.flatnonzero(np.diff(ends, prepend=-1))
        for lo, hi in zip(cuts, [*cuts[1:], len(ends)]):
            node, ids = int(ends[lo]), ",".join(map(str, paths.conv[lo:hi]))
            if spine[node]:
                late.append((hashlib.md5(paths.path[lo]).digest(), paths.conv[lo], ids))
            else:
                digests[node] = hashlib.sha256(ids.encode()).hexdigest()

    free = np.flatnonzero(~spine)
    waits = spine[parent[free]] & (free > 0)
    known = (free > 0) & ~waits
    nodes = {
        "kind": np.full(len(free), NODE), "shard": np.full(len(free), shard), "depth": depth[free], "conv_id": smallest[free],
        "side": pa.array(side[parent[free]], pa.int32(), mask=~waits),
        "parent_conv_id": pa.array(smallest[parent[free]], mask=~known),
        "n_convs": n_convs[free], "n_children": children[free], "n_leaves": leaves[free], "saved_tokens": saved[free],
    }
    if paths.conv is not None:
        nodes["ends_sha256"] = [digests.get(v, NO_ENDS) for v in free.tolist()]
    else:
        ids: list = [None] * n
        for p, d, c, end in zip(paths.path, depths.tolist(), common.tolist(), ends.tolist()):
            if d > c:
                ids[end - (d - c) + 1 : end + 1] = _node_ids(p, c + 1)
        ids[0] = hashlib.md5(b"").digest()
        nodes["node"] = [ids[v] for v in free.tolist()]
    if len(free):
        yield _batch(nodes, len(free))
    for s, at, path, sizes, start in spines:
        row = {"kind": SPINE, "shard": shard, "side": s, "path": path, "sizes": sizes, "start": start, "nodes": _node_ids(path, start)}
        yield _batch({k: [x] for k, x in {**row, **{v: held[v][at] for v in VALUES}}.items()}, 1)
    if late:
        node, first, text = zip(*late)
        yield _batch({"kind": [ENDS] * len(late), "node": node, "first": first, "ids": text}, len(late))
    code = np.packbits(bp.signs > 0).tobytes()
    yield _batch({"kind": [CODE], "shard": [shard], "depth": [len(bp.signs)], "path": [code]}, 1)


def _level(rows: DataFrame, last: bool, conversations: bool) -> DataFrame:
    """``solve`` for every shard of the sorted rows of each partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        shard = TaskContext.get().partitionId() << 32
        paths, turns = Paths([], [], [], [], [] if conversations else None), 0
        for batch in batches:
            columns = [batch.column(c) for c in range(batch.num_columns)]
            for i in range(batch.num_rows):
                paths.path.append(columns[0][i].as_py())
                paths.sizes.append(columns[1][i].values.to_numpy(zero_copy_only=False))
                if conversations:
                    paths.conv.append(columns[2][i].as_py())
                else:
                    paths.start.append(columns[2][i].as_py())
                    paths.values.append(np.array([columns[3 + j][i].values.to_numpy(zero_copy_only=False) for j in range(len(VALUES))]))
                turns += len(paths.sizes[-1]) + 1
                if not last and turns >= SHARD_TURNS and len(paths.path) >= SHARD_PATHS:
                    yield from solve(shard, paths, False)
                    shard, paths, turns = shard + 1, Paths([], [], [], [], [] if conversations else None), 0
        if paths.path:
            yield from solve(shard, paths, last)

    columns = ["path", "sizes", "conv_id"] if conversations else ["path", "sizes", "start", *VALUES]
    return durable_once(rows.select(*columns).mapInArrow(run, DDL))


def rebuilt(conversations: DataFrame) -> DataFrame:
    """(conv_id, path, sizes): each conversation after its first h turns, behind those of the
    first one of its hundred; h is the remainder by 6 of the crc32 of its decimal conv_id."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    turns = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), role.alias("role"),
        F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text)).alias("digest"), F.length(text).alias("size"),
    ).where("conv_id is not null")
    whole = (
        turns.withColumn("base", F.expr("conv_id - conv_id % 100")).repartition("base")
        .groupBy("base", "conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "role", "digest", "size"))).alias("turns"))
        .withColumn("h", (F.crc32(F.col("conv_id").cast("string")) % 6).cast("int"))
    )
    first = whole.where("base = conv_id").select("base", F.slice("turns", 1, 5).alias("opening"))
    opening = F.slice(F.coalesce("opening", F.array().cast("array<struct<turn:bigint,role:string,digest:string,size:int>>")), 1, F.col("h"))
    joined = whole.join(first, "base", "left").select(
        "conv_id", F.concat(opening, F.slice("turns", F.col("h") + 1, F.size("turns"))).alias("turns")
    )
    return joined.select("conv_id", F.unhex(F.array_join("turns.digest", "")).alias("path"), F.col("turns.size").alias("sizes"))


@dataclass
class Trie:
    nodes: DataFrame  # a row a node
    shards: DataFrame  # (level, shard, length, code): the parentheses of every shard, as packed bits


def prefix_trie(paths: DataFrame) -> Trie:
    """The trie of (conv_id, path, sizes) rows, conv_id being distinct."""
    rows, levels = durable_once(paths), []
    while True:
        turns, count = [x or 0 for x in rows.agg(F.sum(F.size("sizes") + 1), F.count("*")).first()]
        last = turns <= SHARD_TURNS or count <= SHARD_PATHS
        n = min(turns // SHARD_TURNS, count // SHARD_PATHS) + 1
        order = ["path", "conv_id"] if not levels else ["path", "shard", "side"]
        dealt = rows.repartition(1) if last else rows.repartitionByRange(n, *order)
        levels.append(_level(dealt.sortWithinPartitions(*order), last, not levels))
        if last:
            break
        rows = levels[-1].where(F.col("kind") == SPINE)

    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    nodes = [level.where(F.col("kind") == NODE) for level in levels]
    ended = _digests(levels[0].where(F.col("kind") == ENDS))
    out = None
    for k, found in enumerate(nodes):
        if k:
            found = found.drop("ends_sha256").join(ended, "node", "left").fillna(NO_ENDS, "ends_sha256")
        if k + 1 < len(levels):  # parents on a spine got their smallest member in a later level
            later = [x.select("node", F.col("conv_id").alias("above")) for x in nodes[k + 1 :]]
            solved = later[0]
            for x in later[1:]:
                solved = solved.union(x)
            spines = levels[k].where(F.col("kind") == SPINE).select("shard", "side", "start", F.posexplode("nodes").alias("i", "node"))
            above = spines.join(solved, "node").select("shard", "side", (F.col("start") + F.col("i") + 1).cast("long").alias("depth"), "above")
            found = found.join(above, ["shard", "side", "depth"], "left").withColumn("parent_conv_id", F.coalesce("parent_conv_id", "above"))
        found = found.select(*columns)
        out = found if out is None else out.union(found)
    codes = None
    for k, level in enumerate(levels):
        code = level.where(F.col("kind") == CODE).select(F.lit(k).alias("level"), "shard", F.col("depth").alias("length"), F.col("path").alias("code"))
        codes = code if codes is None else codes.union(code)
    return Trie(out, codes)


def _digests(parts: DataFrame) -> DataFrame:
    """(node, ends_sha256) from lists of ids in parts, read in order and never joined in memory."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, h = None, None
        for batch in batches:
            for key, ids in zip(batch.column(0), batch.column(1)):
                key = key.as_py()
                if key != node:
                    if node is not None:
                        yield pa.RecordBatch.from_arrays([pa.array([node], pa.binary()), pa.array([h.hexdigest()])], names=["node", "ends_sha256"])
                    node, h = key, hashlib.sha256()
                else:
                    h.update(b",")
                h.update(ids.as_py().encode())
        if node is not None:
            yield pa.RecordBatch.from_arrays([pa.array([node], pa.binary()), pa.array([h.hexdigest()])], names=["node", "ends_sha256"])

    ordered = parts.select("node", "first", "ids").repartition("node").sortWithinPartitions("node", "first")
    return ordered.select("node", "ids").mapInArrow(run, "node binary, ends_sha256 string")


def conversation_trie(conversations: DataFrame) -> DataFrame:
    """(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256) of
    every node of the rebuilt conversations' trie."""
    return prefix_trie(rebuilt(conversations)).nodes
