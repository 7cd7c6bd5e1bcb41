"""The prefix trie of conversations from sorted sequences and their LCPs.

Every distinct sequence of first turns is a node. In the sorted order of the
distinct sequences the members of a node are an interval; its ends are where the
longest common prefix (LCP) of neighbours falls below the node's depth.

How it runs
1. A turn becomes a key: the first 16 bytes of SHA-256 over role and text (with
   the role's length, so no two turns share an input). Texts go no further.
2. Conversations with the same keys are counted together (partial sums before the
   shuffle), so a conversation repeated any number of times is one sequence.
3. Sequences are sorted by range into shards of bounded size and written once to
   the shared folder. A common first turn spans many shards.
4. In a shard a sparse table holds minima of the LCPs over spans of 2^k. A
   candidate is a sequence and a depth at which it is the shard's first; each
   candidate searches its left and right end on its own, by halving steps through
   the table. No stack, no pass from row to row. Counts are differences of running
   sums over the interval, the least id a range minimum.
5. Nodes that go on in a neighbouring shard (prefixes of its last or first sequence)
   are parts: they are summed over the shards, and go back to the shards for the
   ids of their children's parents. All others are final in their shard.

The digest of the conversations that end at a node needs their ids in one order:
ids are joined per block of ``ID_BLOCK`` ids, then the blocks stream through SHA-256
in a task, one after the other; only one block is held in memory.

A conversation's keys are one row (24 bytes a turn); no other group is built.

Defined results: turns in order of their number (null first; equal numbers by the
turn's key); null role or text counts as empty; repeated rows are turns of their own;
rows without conversation id take no part; an empty table has no node, not even a
root; a conversation without turns is a member of the root only. Other columns,
whatever their names, are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from settlekit.llm import blocks as B

KEY = 16                            # bytes of a turn's key
SHARD_TURNS = 400_000               # turns of a shard, about
ID_BLOCK = 1 << 16
_END_OF_NONE = hashlib.sha256(b"").hexdigest()

_NODES = ("conv_id bigint, depth bigint, parent_conv_id bigint, n_convs bigint, n_children bigint, n_leaves bigint, "
          "saved_tokens bigint, ends_sha256 string")
_PARTS = ("shard int, depth bigint, node binary, parent binary, conv_id bigint, n_convs bigint, n_children bigint, "
          "n_leaves bigint, spent bigint, once bigint, size bigint, ends string")


# ---------------------------------------------------------------- sequences

def keyed_turns(turns: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                text_col: str = "text") -> DataFrame:
    """``(conv_id, pos, key, size)``: turns numbered from 1, as key and UTF-8 bytes of the text."""
    role = F.coalesce(F.col(role_col).cast("string"), F.lit(""))
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    key = F.substring(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256), 1, 2 * KEY)
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "key")
    return turns.where(F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("bigint").alias("conv_id"), F.col(turn_col).alias("turn"), key.alias("key"),
        F.octet_length(text).cast("bigint").alias("size")).select(
        "conv_id", F.row_number().over(order).cast("bigint").alias("pos"), "key", "size")


def sequences(keyed: DataFrame) -> DataFrame:
    """``(conv_id, keys string, sizes array)`` of ``(conv_id, part, pos, key, size)``; rows
    with a null key stand for conversations without turns."""
    turns = F.sort_array(F.collect_list(F.when(F.col("key").isNotNull(), F.struct("part", "pos", "key", "size"))))
    return keyed.groupBy("conv_id").agg(turns.alias("t")).select(
        "conv_id", F.array_join(F.col("t.key"), "").alias("keys"), F.col("t.size").alias("sizes"))


def rebuilt_turns(keyed: DataFrame, group: int = 5, shared: int = 9) -> DataFrame:
    """Conversations rebuilt to share prefixes: conversation c takes the first h turns
    of conversation c - c % ``group`` and its own turns after its first h, with
    h = crc32(c) % ``shared``."""
    head = F.crc32(F.col("conv_id").cast("string").cast("binary")) % shared
    ids = keyed.select("conv_id").distinct().select("conv_id", (F.col("conv_id") - F.col("conv_id") % group).alias("base"), head.alias("h"))
    first = keyed.where(F.col("pos") < shared).select(F.col("conv_id").alias("base"), "pos", "key", "size")
    # an id without base turns keeps one row with a null key, so that it stays a conversation
    taken = ids.join(first, "base", "left").select(
        "conv_id", F.lit(0).alias("part"), "pos", *[F.when(F.col("pos") <= F.col("h"), F.col(c)).alias(c) for c in ("key", "size")])
    own = keyed.where(F.col("pos") > head).select("conv_id", F.lit(1).alias("part"), "pos", "key", "size")
    return taken.unionByName(own)


def distinct_sequences(convs: DataFrame) -> DataFrame:
    """``(keys binary, sizes, n, least, ends)`` of each distinct sequence of ``sequences``."""
    # per sequence and block of ids first, so that copies shrink before they meet
    chunks = convs.groupBy(F.sha2("keys", 256).alias("keys_id"), F.floor(F.col("conv_id") / ID_BLOCK).alias("block")).agg(
        F.unhex(F.any_value("keys")).alias("keys"), F.any_value("sizes").alias("sizes"), F.count(F.lit(1)).alias("n"),
        F.min("conv_id").alias("least"), F.sort_array(F.collect_list("conv_id")).alias("ids")).select(
        "keys_id", "block", "keys", "sizes", "n", "least", F.concat_ws(",", F.transform("ids", lambda i: i.cast("string"))).alias("chunk"))
    return chunks.repartition("keys_id").sortWithinPartitions("keys_id", "block").mapInArrow(
        _merged, "keys binary, sizes array<bigint>, n bigint, least bigint, ends string")


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per sequence from its chunks in order; their text streams through SHA-256."""
    names = ("keys", "sizes", "n", "least")
    kinds = (pa.binary(), pa.list_(pa.int64()), pa.int64(), pa.int64(), pa.string())
    at, row, state = None, None, None
    done: list[list] = []

    def flush():
        columns = zip(*done) if done else [[]] * len(kinds)
        return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds)], names=[*names, "ends"])

    for batch in batches:
        columns = batch.to_pydict()
        for i, key in enumerate(columns["keys_id"]):
            chunk = columns["chunk"][i].encode()
            if key == at:
                row[2] += columns["n"][i]
                row[3] = min(row[3], columns["least"][i])
                state.update(b"," + chunk)
                continue
            if row is not None:
                done.append([*row, state.hexdigest()])
            at, row, state = key, [columns[c][i] for c in names], hashlib.sha256(chunk)
        if len(done) >= 10_000:
            yield flush()
            done.clear()
    if row is not None:
        done.append([*row, state.hexdigest()])
    yield flush()


# ---------------------------------------------------------------- one shard

class SparseTable:
    """Minima of an array over all spans of 2^k elements."""

    def __init__(self, values: np.ndarray):
        self.levels = [values]
        while 2 << (len(self.levels) - 1) <= len(values):
            last, half = self.levels[-1], 1 << (len(self.levels) - 1)
            self.levels.append(np.minimum(last[:-half], last[half:]))

    def least(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """Minimum over lo .. hi - 1 (not empty)."""
        k = np.frexp((hi - lo).astype(np.float64))[1] - 1
        out = np.empty(len(lo), self.levels[0].dtype)
        for level in np.unique(k):
            at = k == level
            row = self.levels[level]
            out[at] = np.minimum(row[lo[at]], row[hi[at] - (1 << int(level))])
        return out

    def right(self, at: np.ndarray, floor: np.ndarray) -> np.ndarray:
        """The last r with all of values[at + 1 .. r] >= floor, by halving steps."""
        r = at.copy()
        for k in range(len(self.levels) - 1, -1, -1):
            row = self.levels[k]
            fits = r + 1 + (1 << k) <= len(self.levels[0])
            fits[fits] = row[r[fits] + 1] >= floor[fits]
            r[fits] += 1 << k
        return r

    def left(self, at: np.ndarray, floor: np.ndarray) -> np.ndarray:
        """The first l with all of values[l + 1 .. at] >= floor, by halving steps."""
        l = at.copy()
        for k in range(len(self.levels) - 1, -1, -1):
            row = self.levels[k]
            fits = l - (1 << k) >= 0
            fits[fits] = row[l[fits] + 1 - (1 << k)] >= floor[fits]
            l[fits] -= 1 << k
        return l


def _as_words(keys: bytes) -> np.ndarray:
    """Keys as rows of two words."""
    return np.frombuffer(keys, np.uint64).reshape(-1, KEY // 8)


def _common(a: bytes | None, b: bytes | None) -> int:
    """Turns that two sequences share at their start; -1 if one is missing."""
    if a is None or b is None:
        return -1
    n = min(len(a), len(b))
    differ = np.flatnonzero((_as_words(a[:n]) != _as_words(b[:n])).any(axis=1))
    return int(differ[0]) if len(differ) else n // KEY


class Shard:
    """The nodes of one run of sorted distinct sequences.

    ``before`` and ``after`` are the neighbouring shards' nearest sequences (None at
    the ends of the order). Candidates are listed by row, then depth: a row's first
    candidate is the first prefix it does not share with the row above."""

    def __init__(self, table: pa.Table, before: bytes | None, after: bytes | None):
        table = table.sort_by("keys")
        self.shard = table["shard"][0].as_py()
        self.n, self.least, self.ends = table["n"].to_numpy(), table["least"].to_numpy(), table["ends"]
        self.keys = table["keys"].to_pylist()                       # one bytes object a row
        self.depth = np.array([len(k) // KEY for k in self.keys], np.int64)
        self.size_of = table["sizes"].combine_chunks().flatten().to_numpy(zero_copy_only=False)
        self.size_at = np.concatenate(([0], np.cumsum(self.depth)))
        m = len(self.depth)
        self.lcp = np.zeros(m, np.int64)
        if m > 1:
            flat = _as_words(b"".join(self.keys))
            short = np.minimum(self.depth[1:], self.depth[:-1])
            a, b = B.ranges(self.size_at[:-2], short), B.ranges(self.size_at[1:-1], short)
            differ = np.flatnonzero((flat[a] != flat[b]).any(axis=1))
            ends = np.cumsum(short)
            hit = np.append(differ, ends[-1])[np.searchsorted(differ, ends - short)]
            self.lcp[1:] = np.minimum(hit, ends) - (ends - short)
        self.from_before = _common(before, self.keys[0])
        self.to_after = _common(self.keys[-1], after)
        self.table = SparseTable(self.lcp)

        start = self.lcp + 1
        start[0] = 0                                                # the root
        counts = self.depth - start + 1
        self.offset = np.concatenate(([0], np.cumsum(counts)))
        self.row = np.repeat(np.arange(m), counts)
        self.d = B.ranges(start, counts)
        self.l, self.r = self.table.left(self.row, self.d), self.table.right(self.row, self.d)
        inner = self.d > 0
        top = self.table.left(self.row[inner], self.d[inner] - 1)    # the parent's first row
        self.parent = np.full(len(self.d), -1, np.int64)
        self.parent[inner] = self.offset[top] + self.d[inner] - 1 - start[top]

        # known to be the first of the whole order here: not shared with the sequence before the shard
        new = (self.row > 0) | (self.d > self.from_before)
        size = np.zeros(len(self.d), np.int64)
        size[inner] = self.size_of[self.size_at[self.row[inner]] + self.d[inner] - 1]
        self.size = size
        run = np.concatenate(([0], np.cumsum(self.n)))
        self.n_convs = run[self.r + 1] - run[self.l]
        self.conv_id = SparseTable(self.least).least(self.l, self.r + 1)
        self.n_children = np.bincount(self.parent[inner & new], minlength=len(self.d))
        goes_on = np.append(self.lcp[1:], self.to_after) >= self.depth
        leaf = np.concatenate(([0], np.cumsum(~goes_on)))
        self.n_leaves = leaf[self.r + 1] - leaf[self.l]
        self.spent = self._below(self.n_convs * size)
        self.once = self._below(np.where(new, size, 0))
        # a conversation ends at the deepest candidate of its row, and only there
        self.ending = self.d == self.depth[self.row]
        self.open = ((self.l == 0) & (self.d <= self.from_before)) | ((self.r == m - 1) & (self.d <= self.to_after))

    def _below(self, value: np.ndarray) -> np.ndarray:
        """Sum over the subtree: the candidates from this one on, up to the end of its last row."""
        run = np.concatenate(([0], np.cumsum(value)))
        here = np.arange(len(value))
        return run[self.offset[self.r + 1]] - run[here]

    def _node(self, i: int) -> bytes:
        return hashlib.sha256(self.keys[self.row[i]][:int(self.d[i]) * KEY]).digest()

    def _ends(self, some: np.ndarray) -> list[str]:
        found = self.ends.take(pa.array(self.row[some])).to_pylist()
        return [e if here else _END_OF_NONE for e, here in zip(found, self.ending[some])]

    def parts(self) -> pa.Table:
        """What this shard holds of the nodes that go on in a neighbour."""
        some = np.flatnonzero(self.open)
        nodes = [self._node(i) for i in some]
        parents = [self._node(self.parent[i]) if self.d[i] else None for i in some]
        ends = [e if here else None for e, here in zip(self._ends(some), self.ending[some])]
        number = lambda x: pa.array(x[some].astype(np.int64))
        return pa.table([pa.array(np.full(len(some), self.shard, np.int32)), number(self.d), pa.array(nodes, pa.binary()),
                         pa.array(parents, pa.binary()), *map(number, (self.conv_id, self.n_convs, self.n_children, self.n_leaves,
                                                                         self.spent, self.once, self.size)),
                         pa.array(ends, pa.string())], names=[c.split()[0] for c in _PARTS.split(", ")])

    def nodes(self, known: pa.Table) -> pa.Table:
        """The nodes that lie wholly in this shard; ``known`` gives the ids of the others."""
        ids = dict(zip(known["node"].to_pylist(), known["conv_id"].to_pylist()))     # the shard's own edge row has no node
        conv_id = self.conv_id.copy()
        for i in np.flatnonzero(self.open):
            conv_id[i] = ids[self._node(i)]
        some = np.flatnonzero(~self.open)
        parent = self.parent[some]
        number = lambda x: pa.array(x[some].astype(np.int64))
        return pa.table([number(self.conv_id), number(self.d),
                         pa.array(conv_id[np.maximum(parent, 0)].astype(np.int64), mask=parent < 0),
                         *map(number, (self.n_convs, self.n_children, self.n_leaves, self.spent - self.once)),
                         pa.array(self._ends(some), pa.string())], names=[c.split()[0] for c in _NODES.split(", ")])


def _edges(rows: pa.Table) -> tuple[bytes | None, bytes | None]:
    """The sequences before and after a shard, from its row of edges."""
    return tuple(next((v for v in rows[c].to_pylist() if v is not None), None) for c in ("before", "after"))


# ---------------------------------------------------------------- the trie

def prefix_trie(convs: DataFrame, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """One row per node of the trie over ``sequences``: ``conv_id, depth, parent_conv_id,
    n_convs, n_children, n_leaves, saved_tokens, ends_sha256``."""
    spark = convs.sparkSession
    unique = B.shared_table(spark, distinct_sequences(convs), "trie-sequences")
    rows, turns = unique.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.size("sizes")), F.lit(0))).first()
    shards = max(int(spark.conf.get("spark.sql.shuffle.partitions")) if rows else 1, int(rows + turns) // shard_turns + 1)
    placed = B.shared_table(spark, unique.repartitionByRange(shards, "keys").withColumn("shard", F.spark_partition_id()), "trie-shards")
    # one row a shard: the neighbours of its first and last sequence
    edge = placed.groupBy("shard").agg(F.min("keys").alias("lo"), F.max("keys").alias("hi"))
    order = Window.orderBy("shard")
    edge = B.shared_table(spark, edge.select("shard", F.lag("hi").over(order).alias("before"), F.lead("lo").over(order).alias("after")),
                          "trie-edges")
    of_shard = placed.groupBy("shard")
    parts = B.shared_table(spark, of_shard.cogroup(edge.groupBy("shard")).applyInArrow(
        lambda t, e: Shard(t, *_edges(e)).parts(), _PARTS), "trie-parts")
    total = parts.groupBy("depth", "node").agg(
        F.min("parent").alias("parent"), F.min("conv_id").alias("conv_id"),
        *[F.sum(c).cast("bigint").alias(c) for c in ("n_convs", "n_children", "n_leaves", "spent", "once")],
        F.coalesce(F.max("ends"), F.lit(_END_OF_NONE)).alias("ends_sha256"))
    known = parts.select("shard", "depth", "node").join(total.select("depth", "node", "conv_id"), ["depth", "node"]).select(
        "shard", "node", "conv_id")
    context = edge.unionByName(known, allowMissingColumns=True)
    inside = of_shard.cogroup(context.groupBy("shard")).applyInArrow(lambda t, e: Shard(t, *_edges(e)).nodes(e), _NODES)
    above = total.select((F.col("depth") + 1).alias("depth"), F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    across = total.join(above, ["depth", "parent"], "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", (F.col("spent") - F.col("once")).alias("saved_tokens"),
        "ends_sha256")
    return inside.unionByName(across)
