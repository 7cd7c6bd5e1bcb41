"""Approximate nearest neighbours by inner product: NN-descent and greedy graph search.

How it runs
1. Usable vectors (one per id, of the most frequent length, finite and not zero)
   with equal values form a class; one of each, the point, enters the graph. So
   a vector with many copies costs one point.
2. Every point starts with its best neighbours among groups of near points:
   ``GROUPINGS`` independent groupings into cells on the same sides of random planes, a
   cell halved along random directions until a group has at most ``GROUP`` points,
   whatever the size of the table.
3. NN-descent: each round brings together a point, its neighbours and its reverse
   neighbours with their vectors and compares those pairs of which one side is a fresh
   edge (new in the last round). A point offers each of them its ``OFFERS`` best others
   that its list does not hold and would take; the rest comes up again through
   nearer points. Each point keeps its best. Rounds go on until at most
   ``SETTLED`` of the edges are new.
4. Search: every query keeps a beam of the best points found, at first itself and the
   best of the ``PROBES`` groups of each grouping whose means score best; a round expands
   the best unexpanded ones through the graph, until all of the beam is expanded.
5. The whole beam is scored again on the original vectors in double precision;
   the best classes are expanded to their least ids.

Points are dealt by a hash of their id to blocks of about ``BLOCK``. A block is one
row of whole arrays, and blocks exchange messages, rows of arrays too: Spark moves a
few large rows, numpy does what is done for each point. A round of NN-descent has three
exchanges: a block sends its points to the blocks that hold them in a list or that they
hold (once to each, however many points there ask for it), compares, and sends the
offers to their owners. A round of the search has three as well: to the blocks of the
points to expand, to those of the points found there, and back with what is better
than the beam's last. A task holds a block and the messages to it; the driver and the
tasks that route queries hold the means of the groups.

Points travel as one-byte components, each vector scaled by its own largest, which
goes with them as a float (relative to the table's largest); they only steer the
search. A score leaves out the owner's scale, which all its candidates share. The graph holds every point; reverse neighbours are
sampled by a hash, as NN-descent does (the graph is approximate by nature,
recall is measured in the tests).

Defined results: vectors that are null, empty, zero, of another length than most,
or hold null or non-finite components take no part, neither do null ids; of rows
with one id the least vector counts; an empty table gives an empty result; fewer
than k candidates are all returned if found. Ties go to the smaller id.
"""

from __future__ import annotations

import itertools
from collections import defaultdict
from collections.abc import Callable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from settlekit.intermediates import Intermediates
from settlekit.llm import blocks as B

DEGREE, REVERSE = 32, 24        # neighbours kept; reverse neighbours compared per round
GROUPINGS, GROUP, PROBES = 4, 4096, 16      # independent groupings, points of a group, groups of each that a query starts from
OFFERS = 3                      # new edges that one comparison of a point's neighbours gives each of them
SETTLED, BEAM, WIDTH = 0.001, 160, 40
BLOCK, LEAST_BLOCKS = 20_000, 12        # points of a block, about; blocks of a smaller table, if of 512 points at least
_FLUSH = 1 << 20                # offers a task gathers before it sends them


def usable(rows: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """``(id, v)`` of the rows that take part, v an array of floats if the column is one, else of doubles."""
    v = F.col("v")
    kind = rows.schema[vec_col].dataType
    number = "float" if isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.FloatType) else "double"
    fine = (F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
            & F.exists(v, lambda x: x != 0))
    rows = rows.select(F.col(id_col).cast("bigint").alias("id"), F.col(vec_col).cast(f"array<{number}>").alias("v")).where(
        F.col("id").isNotNull() & v.isNotNull() & (F.size(v) > 0)).where(fine)
    length = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").limit(1).collect()
    return rows.where(F.size("v") == (length[0][0] if length else 0)).groupBy("id").agg(F.min("v").alias("v"))


# ---------------------------------------------------------------- blocks and messages

#: ``dest`` is the block that a message goes to, ``n`` and ``fresh`` count what the driver has to know.
_ROWS = "dest int, kind string, n bigint, fresh bigint, data array<binary>"
#: Types of a kind's arrays; the first gives the rows of those with several columns.
_KINDS = {
    "points": ("i8", "i1"),                         # id, scale and components
    "exact": ("i8", "f8"), "exact4": ("i8", "f4"),  # id, original vector
    "group": ("i8", "i1", "i8"),                    # id, scale and components, cell or group
    "centre": ("i8", "f4"),                         # group, mean of its points
    "lists": ("i8", "i8", "f4", "i1"),              # id, neighbours, scores (-inf: no neighbour), fresh
    "back": ("i8", "i8", "i1"),                     # point, one that holds it, fresh
    "near": ("i8", "i1"),                           # points to compare, fresh (-1: none)
    "record": ("i8", "i1", "f4", "u2"),             # id, scale and components, least score taken, hashes of the list
    "offers": ("i8", "i8", "f4"),                   # owner, other, score
    "links": ("i8", "i8"),                          # id, points linked with it (its own id: none)
    "queries": ("i8",),
    "beam": ("i8", "i8", "f4", "i1"),               # query, points, scores (-inf: none), open
    "probe": ("i8", "i1", "i4", "i8"),              # query, its components; place of a pair's query, group
    "expand": ("i8", "i1", "f4", "i4", "i8"),       # query, its components, least score taken; place of a pair's query, point
    "weigh": ("i8", "i1", "f4", "i4", "i8"),
    "found": ("i8", "i8", "f4"),                    # query, point, score
    "pairs": ("i8", "i8"),                          # query, point
    "scores": ("i8", "i8", "f8"),                   # query, point, exact score
    "score": ("i8", "f8", "i4", "i8"), "score4": ("i8", "f4", "i4", "i8"),    # query, its vector; place of a pair's query, point
}


def _message(dest: int, kind: str, *arrays: np.ndarray, n: int = 0, fresh: int = 0) -> pa.RecordBatch:
    data = [np.ascontiguousarray(x, kind_).tobytes() for x, kind_ in zip(arrays, _KINDS[kind], strict=True)]
    return pa.RecordBatch.from_arrays(
        [pa.array([dest], pa.int32()), pa.array([kind]), pa.array([n], pa.int64()), pa.array([fresh], pa.int64()),
         pa.array([data], pa.list_(pa.binary()))], names=["dest", "kind", "n", "fresh", "data"])


def _runs(sorted_keys: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(key, first, end) of the runs of equal keys."""
    heads = B.group_starts(sorted_keys)
    return zip(sorted_keys[heads].tolist(), heads.tolist(), [*heads[1:].tolist(), len(sorted_keys)])


def _dealt(dest: np.ndarray, kind: str, *arrays: np.ndarray) -> Iterator[pa.RecordBatch]:
    """One message to each block in ``dest`` with its rows of the arrays."""
    order = np.argsort(dest, kind="stable")
    for block, lo, hi in _runs(dest[order]):
        yield _message(block, kind, *(x[order[lo:hi]] for x in arrays))


def _block_of(ids: np.ndarray, blocks: int) -> np.ndarray:
    return (B.mix(ids.astype(np.uint64)) % np.uint64(blocks)).astype(np.int32)


def _step(rows: DataFrame, blocks: int, work: Callable) -> DataFrame:
    """Delivers the messages; ``work(block, given)`` turns what a block gets into new ones.
    ``given[kind]`` lists the arrays of each message."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        given, block = defaultdict(list), None
        for batch in batches:
            dest, kinds, data = batch.column(0), batch.column(1).to_pylist(), batch.column(4)
            ends, values = data.offsets.to_pylist(), data.values
            for i, kind in enumerate(kinds):
                block = dest[i].as_py()
                raw = [values[j].as_buffer() for j in range(ends[i], ends[i + 1])]
                given[kind].append([np.frombuffer(x, t) if x.size else np.zeros(0, t) for x, t in zip(raw, _KINDS[kind], strict=True)])
        if block is not None:
            yield from work(block, given)

    return rows.repartitionById(blocks, "dest").mapInArrow(B.tidy(run), _ROWS)


def _joined(given: dict[str, list], kind: str) -> list[np.ndarray]:
    """The arrays of all messages of a kind, one after the other."""
    found = given.pop(kind, None) or [[np.zeros(0, t) for t in _KINDS[kind]]]
    return [np.concatenate(x) if len(found) > 1 else x[0] for x in zip(*found)]


def _table(given: dict[str, list], kind: str) -> list[np.ndarray]:
    """The same for a kind whose arrays have one row an id, in the order of ids."""
    ids, *rest = _joined(given, kind)
    order = np.argsort(ids, kind="stable")
    return [ids[order], *(x.reshape(len(ids), -1)[order] if len(ids) else x.reshape(0, 1) for x in rest)]


def _parts(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(components as floats, scale) of points."""
    return raw[:, 4:].astype(np.float32), np.ascontiguousarray(raw[:, :4]).view(np.float32)[:, 0] if len(raw) else np.zeros(0, np.float32)


def _placed(rows: DataFrame, blocks: int, kind: str, encode: Callable[[np.ndarray], np.ndarray]) -> DataFrame:
    """``rows(id, v)`` as one row of arrays for each block, in the order of ids."""
    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                ids = batch.column(0).to_numpy(zero_copy_only=False)
                x = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(len(ids), -1)
                yield from _dealt(_block_of(ids, blocks), kind, ids, encode(x))

    def whole(block: int, given: dict) -> Iterator[pa.RecordBatch]:
        yield _message(block, kind, *_table(given, kind))

    return _step(rows.mapInArrow(deal, _ROWS), blocks, whole)


def _shrunk(x: np.ndarray, scale: float) -> np.ndarray:
    """Scale (four bytes) and one-byte components of each vector."""
    x = x.astype(np.float64)
    own = np.abs(x).max(axis=1, keepdims=True)
    return np.hstack([(own / scale).astype(np.float32).view(np.int8), np.rint(x / own * 127).astype(np.int8)])


def _falling(score: np.ndarray) -> np.ndarray:
    """32 bits that rise as the score falls."""
    bits = (score + np.float32(0)).view(np.uint32)
    return ~np.where(bits >> 31 == 1, ~bits, bits | np.uint32(1 << 31))


def _ranks(heads: np.ndarray, n: int) -> np.ndarray:
    """Place of each of n elements in its run."""
    return np.arange(n) - np.repeat(heads, np.diff(np.append(heads, n)))


def _best(row: np.ndarray, other: np.ndarray, score: np.ndarray, flag: np.ndarray, n: int, k: int, none: np.ndarray):
    """(others, scores, flags), n rows of the k best distinct others, best first; of copies the
    least flag counts. Free places hold ``none``, -inf and 0."""
    out = np.repeat(none[:, None], k, axis=1), np.full((n, k), -np.inf, np.float32), np.zeros((n, k), np.int8)
    if not len(row):
        return out
    mixed = B.mix(other.astype(np.uint64))
    place = row.astype(np.uint64) << np.uint64(44)          # a block has fewer than 2^20 points
    order = np.argsort(place | mixed >> np.uint64(20))
    heads = B.group_starts(row[order], other[order])
    flag, score = np.minimum.reduceat(flag[order], heads), np.maximum.reduceat(score[order], heads)
    order = order[heads]
    row, other = row[order], other[order]
    order = np.argsort(place[order] | _falling(score).astype(np.uint64) << np.uint64(12) | mixed[order] >> np.uint64(52))
    rank = _ranks(B.group_starts(row[order]), len(order))
    order, rank = order[rank < k], rank[rank < k]
    for to, x in zip(out, (other, score, flag)):
        to[row[order], rank] = x[order]
    return out


# ---------------------------------------------------------------- start: groups of near points

def _codes(given: dict, bits: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(id, scale and components, cell) of a block's points for each grouping."""
    ids, raw = _table(given, "points")
    x, _ = _parts(raw)
    for g in range(GROUPINGS):
        planes = np.random.default_rng(100 + g).normal(size=(x.shape[1], bits)).astype(np.float32)
        yield ids, raw, (g << bits) + (x @ planes > 0) @ (1 << np.arange(bits, dtype=np.int64))


def _cell_sizes(block: int, given: dict, bits: int) -> Iterator[pa.RecordBatch]:
    for _, _, cell in _codes(given, bits):
        for c, n in zip(*np.unique(cell, return_counts=True)):
            yield _message(int(c), "queries", np.zeros(0, np.int64), n=int(n))


def _scattered(block: int, given: dict, bits: int, first: np.ndarray, parts: np.ndarray, blocks: int) -> Iterator[pa.RecordBatch]:
    """Points to the task of their cell; large cells are dealt by a hash into parts."""
    for ids, raw, cell in _codes(given, bits):
        part = B.mix(ids.astype(np.uint64) ^ B.mix(cell.astype(np.uint64) + np.uint64(1))) % parts[cell].astype(np.uint64)
        group = first[cell] + part.astype(np.int64)
        yield from _dealt((group % blocks).astype(np.int32), "group", ids, raw, group)


def _halves(x: np.ndarray, seed: int, most: int) -> tuple[np.ndarray, np.ndarray]:
    """(order, bounds) of groups of at most ``most`` points, halved along random directions."""
    rng, order, bounds = np.random.default_rng(seed), np.arange(len(x)), np.array([0, len(x)])
    while (size := np.diff(bounds)).max(initial=0) > most:
        along = (x @ rng.normal(size=x.shape[1]).astype(np.float32))[order]
        order = order[np.lexsort((order, along, np.repeat(np.arange(len(size)), size)))]
        bounds = np.unique(np.concatenate((bounds, bounds[:-1] + size // 2)))
    return order, bounds


def _grouped(block: int, given: dict, group: int) -> Iterator[pa.RecordBatch]:
    """The groups of a task's cells, and the mean of each."""
    ids, raw, cell = _joined(given, "group")
    raw = raw.reshape(len(ids), -1)
    order = np.lexsort((ids, cell))
    for c, lo, hi in _runs(cell[order]):
        own = order[lo:hi]
        x, scale = _parts(raw[own])
        inside, bounds = _halves(x, c, group)
        key = (c << 20) + np.arange(len(bounds) - 1)
        yield _message(block, "group", ids[own][inside], raw[own][inside], np.repeat(key, np.diff(bounds)))
        yield _message(block, "centre", key, np.add.reduceat((x * scale[:, None])[inside], bounds[:-1]) / np.diff(bounds)[:, None])


def _largest(s: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of the k largest of each row; of equal ones, or as few others, some more."""
    n, wide = s.shape[1], 16
    if n <= k:
        return np.nonzero(s > -np.inf)
    if n >= 4 * k * wide:       # k peaks of stretches are at least as large as the least of the k largest
        peaks = s[:, :n - n % wide].reshape(len(s), -1, wide).max(axis=2)
        found = np.nonzero(s >= np.partition(peaks, -k, axis=1)[:, -k][:, None])
        if len(found[0]) <= 2 * k * len(s):
            return found
    top = np.argpartition(s, n - k, axis=1)[:, n - k:]
    return np.repeat(np.arange(len(s)), k), top.ravel()


def _groups(given: dict) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(group, ids, components, scale)"""
    for ids, raw, key in given.pop("group", []):
        raw = raw.reshape(len(ids), -1)
        for k, lo, hi in _runs(key):
            yield k, ids[lo:hi], *_parts(raw[lo:hi])


def _group_offers(block: int, given: dict, blocks: int) -> Iterator[pa.RecordBatch]:
    """Each point's best others in its group."""
    for _, ids, x, scale in _groups(given):
        found = []
        for lo in range(0, len(ids), 512):
            s = (x[lo:lo + 512] @ x.T) * scale
            s[np.arange(len(s)), lo + np.arange(len(s))] = -np.inf
            a, b = _largest(s, min(DEGREE, len(ids) - 1)) if len(ids) > 1 else ([], [])
            if len(a):
                found.append((ids[lo + a], ids[b], s[a, b]))
        yield from _offers(found, blocks)


def _start(fixed: DataFrame, count: int, blocks: int, made: Intermediates) -> tuple[DataFrame, list[tuple[np.ndarray, ...]]]:
    """(groups, for each grouping its groups' numbers, blocks and means): cells by planes, which
    hold about ``BLOCK`` points, and groups in them."""
    bits = max(0, (count // BLOCK).bit_length(), (blocks - 1).bit_length())
    sizes = np.zeros(GROUPINGS << bits, np.int64)
    for cell, n in _step(fixed, blocks, partial(_cell_sizes, bits=bits)).groupBy("dest").agg(F.sum("n")).collect():
        sizes[cell] = n
    parts = np.maximum(1, -(-sizes // (2 * BLOCK)))
    first = np.cumsum(parts) - parts
    spread = _step(fixed, blocks, partial(_scattered, bits=bits, first=first, parts=parts, blocks=blocks))
    groups = made.table(_step(spread, blocks, partial(_grouped, group=GROUP)))
    rows = groups.where("kind = 'centre'").select("dest", "data").collect()
    key, dest, means = np.zeros(0, np.int64), np.zeros(0, np.int32), np.zeros((0, 1), np.float32)
    if rows:
        each = [np.frombuffer(r.data[0], np.int64) for r in rows]
        key, dest = np.concatenate(each), np.repeat(np.array([r.dest for r in rows], np.int32), [len(x) for x in each])
        means = np.frombuffer(b"".join(r.data[1] for r in rows), np.float32).reshape(len(key), -1)
        order = np.argsort(key)
        key, dest, means = key[order], dest[order], means[order]
    grouping = np.searchsorted(first[np.arange(GROUPINGS) << bits], key >> 20, side="right") - 1
    return groups.where("kind = 'group'"), [(key[at], dest[at], means[at]) for at in (grouping == g for g in range(GROUPINGS))]


# ---------------------------------------------------------------- NN-descent

def _merged(block: int, given: dict, blocks: int) -> Iterator[pa.RecordBatch]:
    """The lists with the offers; then tells every neighbour's block who holds it."""
    if given["lists"]:
        ids, near, score, _ = _table(given, "lists")
    else:
        ids = _table(given, "points")[0]
        near, score = np.zeros((len(ids), 0), np.int64), np.zeros((len(ids), 0), np.float32)
    owner, other, offered = _joined(given, "offers")
    held = score > -np.inf
    row = np.concatenate((np.nonzero(held)[0], np.searchsorted(ids, owner)))
    fresh = np.ones(len(row), np.int8)
    fresh[:int(held.sum())] = 0
    near, score, fresh = _best(row, np.concatenate((near[held], other)), np.concatenate((score[held], offered)), fresh, len(ids), DEGREE, ids)
    held = score > -np.inf
    yield _message(block, "lists", ids, near, score, fresh, n=int(held.sum()), fresh=int(fresh.sum()))
    a, b, f = np.repeat(ids, DEGREE)[held.ravel()], near[held], fresh[held]
    # at most as many as a point's block can use
    order = np.lexsort((B.mix(a.astype(np.uint64)), -f, b))
    order = order[_ranks(B.group_starts(b[order]), len(b)) < DEGREE]
    yield from _dealt(_block_of(b[order], blocks), "back", b[order], a[order], f[order])


def _both_ways(given: dict, turn: int, most: int) -> tuple[np.ndarray, ...]:
    """(ids, components, scores, near, fresh): near lists a point, its neighbours and at most
    ``most`` of its reverse neighbours, fresh ones first, chosen by a hash; fresh is -1 where there is none."""
    ids, raw = _table(given, "points")
    _, own, score, fresh = _table(given, "lists")
    b, a, f = _joined(given, "back")
    row = np.searchsorted(ids, b)
    salt = B.mix(np.array([turn + 2], np.uint64))
    order = np.argsort(row.astype(np.uint64) << np.uint64(44) | (f == 0).astype(np.uint64) << np.uint64(43)
                       | B.mix(a.astype(np.uint64) ^ salt) >> np.uint64(21))
    rank = _ranks(B.group_starts(row[order]), len(order))
    order, rank = order[rank < most], rank[rank < most]
    near = np.repeat(ids[:, None], 1 + DEGREE + most, axis=1)
    flag = np.full(near.shape, -1, np.int8)
    near[:, 1:1 + DEGREE], flag[:, 0] = own, 0
    flag[:, 1:1 + DEGREE] = np.where(score > -np.inf, fresh, -1)
    near[row[order], 1 + DEGREE + rank], flag[row[order], 1 + DEGREE + rank] = a[order], f[order]
    for lo in range(0, len(ids), 1024):     # a reverse neighbour that is a neighbour too counts once
        n, g = near[lo:lo + 1024], flag[lo:lo + 1024]
        front, back = g[:, 1:1 + DEGREE], g[:, 1 + DEGREE:]
        same = (n[:, 1:1 + DEGREE, None] == n[:, None, 1 + DEGREE:]) & (front >= 0)[:, :, None] & (back >= 0)[:, None, :]
        front[(same & (back == 1)[:, None, :]).any(axis=2)] = 1
        back[same.any(axis=1)] = -1
    return ids, raw, score, near, flag


def _short(ids: np.ndarray, turn: int) -> np.ndarray:
    """16 bits of each id's hash, others each round: enough to leave a known edge out of an offer."""
    return (B.mix(ids.astype(np.uint64) ^ B.mix(np.array([turn + 1], np.uint64))) >> np.uint64(48)).astype(np.uint16)


def _shared(block: int, given: dict, turn: int, blocks: int) -> Iterator[pa.RecordBatch]:
    """What a point's neighbourhood compares, and the block's points to all blocks that compare them."""
    back = [x[:2] for x in given["back"]]
    ids, raw, score, near, flag = _both_ways(given, turn, REVERSE)
    active = (flag == 1).any(axis=1)
    yield _message(block, "near", near[active], flag[active])
    asked = np.zeros((len(ids), blocks), bool)
    asked[:, block] = True
    held = flag[:, 1:1 + DEGREE] >= 0
    asked[np.nonzero(held)[0], _block_of(near[:, 1:1 + DEGREE][held], blocks)] = True
    for b, a in back:
        asked[np.searchsorted(ids, b), _block_of(a, blocks)] = True
    worst = score.min(axis=1, initial=np.inf)       # -inf while the list has a free place
    short = np.where(held, _short(near[:, 1:1 + DEGREE], turn), _short(ids, turn)[:, None])
    for dest in np.flatnonzero(asked.any(axis=0)).tolist():
        at = asked[:, dest]
        yield _message(dest, "record", ids[at], raw[at], worst[at], short[at])


def _compared(block: int, given: dict, turn: int, blocks: int) -> Iterator[pa.RecordBatch]:
    """Neighbours of one point against one another: the best edges that their lists lack."""
    ids, raw, worst, held = _joined(given, "record")
    raw, held, order = raw.reshape(len(ids), -1), held.reshape(len(ids), -1), np.argsort(ids)
    sorted_ids = ids[order]
    near, flag = (x.reshape(-1, 1 + DEGREE + REVERSE) for x in _joined(given, "near"))
    x8, scale, short = raw[:, 4:], np.append(_parts(raw[:, :4])[1], np.float32(np.nan)), _short(ids, turn)
    worst = np.append(worst, np.float32(np.inf))
    found, gathered = [], 0
    for lo in range(0, len(near), 128):
        fresh = flag[lo:lo + 128]
        there = fresh >= 0
        at = np.full(fresh.shape, len(ids), np.int64)      # a free place: no score, takes nothing
        at[there] = order[np.searchsorted(sorted_ids, near[lo:lo + 128][there])]
        x = x8[np.where(there, at, 0)].astype(np.float32)
        s = np.matmul(x, x.transpose(0, 2, 1))
        s *= scale[at][:, None, :]
        new = fresh == 1
        take = s > worst[at][:, :, None]
        take &= new[:, :, None] | new[:, None, :]
        take[:, np.arange(s.shape[1]), np.arange(s.shape[1])] = False
        g, i, j = np.nonzero(take)
        unknown = ~(held[at[g, i]] == short[at[g, j]][:, None]).any(axis=1)
        g, i, j = g[unknown], i[unknown], j[unknown]
        best = np.full(s.shape, -np.inf, np.float32)
        best[g, i, j] = s[g, i, j]
        for _ in range(OFFERS):
            j = best.argmax(axis=2)[:, :, None]
            score = np.take_along_axis(best, j, 2)[:, :, 0]
            g, i = np.nonzero(score > -np.inf)
            found.append((ids[at[g, i]], ids[at[g, j[g, i, 0]]], score[g, i]))
            gathered += len(g)
            np.put_along_axis(best, j, -np.inf, 2)
        if gathered >= _FLUSH:
            yield from _offers(found, blocks)
            found, gathered = [], 0
    yield from _offers(found, blocks)


def _offers(found: list[tuple[np.ndarray, ...]], blocks: int) -> Iterator[pa.RecordBatch]:
    if found:
        a, b, score = map(np.concatenate, zip(*found))
        yield from _dealt(_block_of(a, blocks), "offers", a, b, score)


def _released(spark: SparkSession, made: Intermediates) -> Intermediates:
    """Removes a round's table; the shuffle files of its plan go when the driver collects its garbage."""
    made.close()
    spark.sparkContext._jvm.System.gc()
    return Intermediates(spark)


def neighbour_graph(fixed: DataFrame, groups: DataFrame, blocks: int, made: Intermediates) -> DataFrame:
    """What the search follows in the NN-descent graph over the points of ``fixed``, in a table of ``made``."""
    spark = fixed.sparkSession
    own = Intermediates(spark)
    start = _step(groups, blocks, partial(_group_offers, blocks=blocks))
    lists = own.table(_step(start.unionByName(fixed), blocks, partial(_merged, blocks=blocks)))
    for turn in itertools.count():
        shared = _step(fixed.unionByName(lists), blocks, partial(_shared, turn=turn, blocks=blocks))
        offers = _step(shared, blocks, partial(_compared, turn=turn, blocks=blocks))
        done, own = own, Intermediates(spark)
        better = own.table(_step(offers.unionByName(lists.where("kind = 'lists'")), blocks, partial(_merged, blocks=blocks)))
        lists, shared, offers = better, None, None
        _released(spark, done)
        held, fresh = lists.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("fresh"), F.lit(0))).first()
        if fresh <= SETTLED * held:     # lists only get better, so this comes
            links = made.table(_step(fixed.unionByName(lists), blocks, _linked))
            _released(spark, own)
            return links


def _linked(block: int, given: dict) -> Iterator[pa.RecordBatch]:
    """What the search follows: neighbours and reverse neighbours."""
    ids, _, _, near, flag = _both_ways(given, -1, DEGREE)
    yield _message(block, "links", ids, np.where(flag[:, 1:] >= 0, near[:, 1:], ids[:, None]))


# ---------------------------------------------------------------- search

def _asked(rows: Iterator[pa.RecordBatch], blocks: int) -> Iterator[pa.RecordBatch]:
    for batch in rows:
        ids = batch.column(0).to_numpy(zero_copy_only=False)
        yield from _dealt(_block_of(ids, blocks), "queries", ids)


def _routed(block: int, given: dict, means: list[tuple[np.ndarray, ...]], probes: int) -> Iterator[pa.RecordBatch]:
    """Queries to the groups of each grouping whose means score best."""
    ids, raw = _table(given, "points")
    q = np.unique(_joined(given, "queries")[0])
    raw = raw[np.searchsorted(ids, q)]
    x, _ = _parts(raw)
    for key, dest, mean in means:
        if len(q) and len(key):
            row, at = _largest(x @ mean.T, probes)
            yield from _to_points("probe", dest[at], q, raw, None, row, key[at])


def _seeded(block: int, given: dict, blocks: int) -> Iterator[pa.RecordBatch]:
    """The best points of the groups that queries start from."""
    q, raw, _, row, group = _pairs(given, "probe")
    order = np.lexsort((row, group))
    row, group = row[order], group[order]
    if not len(row):
        return
    q_x, _ = _parts(raw)
    for key, ids, x, scale in _groups(given):
        here = row[np.searchsorted(group, key):np.searchsorted(group, key, side="right")]
        for lo in range(0, len(here), 512):
            s = (q_x[here[lo:lo + 512]] @ x.T) * scale
            i, j = _largest(s, DEGREE)
            yield from _dealt(_block_of(q[here[lo + i]], blocks), "found", q[here[lo + i]], ids[j], s[i, j])


def _advanced(block: int, given: dict, blocks: int, width: int) -> Iterator[pa.RecordBatch]:
    """The beams with what was found; the points that they expand next."""
    ids, raw = _table(given, "points")
    if given["beam"]:
        q, near, score, open_ = _table(given, "beam")
    else:
        q = np.unique(_joined(given, "queries")[0])
        near, score, open_ = q[:, None], np.full((len(q), 1), np.inf, np.float32), np.ones((len(q), 1), np.int8)
    found_q, found, found_score = _joined(given, "found")
    held = score > -np.inf
    row = np.concatenate((np.nonzero(held)[0], np.searchsorted(q, found_q)))
    flag = np.concatenate((open_[held], np.ones(len(found), np.int8)))
    near, score, open_ = _best(row, np.concatenate((near[held], found)), np.concatenate((score[held], found_score)), flag, len(q), BEAM, q)
    now = (open_ == 1) & (np.cumsum(open_, axis=1) <= width)
    yield _message(block, "beam", q, near, score, np.where(now, 0, open_), n=int(now.sum()), fresh=int(open_.sum()))
    row, point = np.nonzero(now)[0], near[now]
    yield from _to_points("expand", _block_of(point, blocks), q, raw[np.searchsorted(ids, q)], score[:, -1], row, point)


def _to_points(kind: str, dest: np.ndarray, q: np.ndarray, vector: np.ndarray, worst: np.ndarray | None, row: np.ndarray,
               point: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Pairs of a query (by place) and a point to the points' blocks, each with its queries' vectors once."""
    order = np.lexsort((row, dest))
    row, point = row[order], point[order]
    for block, lo, hi in _runs(dest[order]):
        heads = B.group_starts(row[lo:hi])
        at = row[lo:hi][heads]
        place = np.repeat(np.arange(len(at)), np.diff(np.append(heads, hi - lo)))
        yield _message(block, kind, q[at], vector[at], *([] if worst is None else [worst[at]]), place, point[lo:hi])


def _pairs(given: dict, kind: str) -> tuple[np.ndarray, ...]:
    """(queries, vectors, least scores, place of each pair's query, points) of all messages, each query once."""
    found = given.pop(kind, [])
    if not found:
        return (np.zeros(0, np.int64),) * 5
    q = np.concatenate([x[0] for x in found])
    vector = np.concatenate([x[1].reshape(len(x[0]), -1) for x in found])
    shift = np.cumsum([0] + [len(x[0]) for x in found])
    place = np.concatenate([x[-2] + at for x, at in zip(found, shift)])
    q, first, same = np.unique(q, return_index=True, return_inverse=True)
    worst = np.concatenate([x[2] for x in found])[first] if len(found[0]) == 5 else None
    return q, vector[first], worst, same[place], np.concatenate([x[-1] for x in found])


def _expanded(block: int, given: dict, blocks: int) -> Iterator[pa.RecordBatch]:
    """The points linked with those to expand, to their blocks."""
    ids, links = _table(given, "links")
    q, raw, worst, row, point = _pairs(given, "expand")
    for lo in range(0, len(row), _FLUSH >> 4):
        at = np.searchsorted(ids, point[lo:lo + (_FLUSH >> 4)])
        there = links[at] != ids[at][:, None]
        found = links[at][there]
        yield from _to_points("weigh", _block_of(found, blocks), q, raw, worst, np.repeat(row[lo:lo + len(at)], there.sum(axis=1)), found)


def _weighed(block: int, given: dict, blocks: int) -> Iterator[pa.RecordBatch]:
    """The scores of the points found that a beam would take."""
    ids, raw = _table(given, "points")
    x, scale = _parts(raw)
    q, q_raw, worst, row, point = _pairs(given, "weigh")
    if not len(row):
        return
    q_x, _ = _parts(q_raw)
    pair = np.sort(row.astype(np.int64) << 20 | np.searchsorted(ids, point))
    pair = pair[B.group_starts(pair)]
    row, at = pair >> 20, pair & ((1 << 20) - 1)
    score = np.empty(len(pair), np.float32)
    for lo in range(0, len(pair), 1 << 14):
        hi = lo + (1 << 14)
        score[lo:hi] = np.einsum("ij,ij->i", x[at[lo:hi]], q_x[row[lo:hi]]) * scale[at[lo:hi]]
    fits = score >= worst[row]
    yield from _dealt(_block_of(q[row[fits]], blocks), "found", q[row[fits]], ids[at[fits]], score[fits])


def _beam_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``(q, b, score, done)`` of the beams."""
    for batch in batches:
        for data in batch.column(0):
            q, near, score, open_ = (np.frombuffer(x.as_buffer(), t) if x.as_buffer().size else np.zeros(0, t)
                                     for x, t in zip(data.values, _KINDS["beam"], strict=True))
            held = score > -np.inf
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(q, BEAM)[held]), pa.array(near[held]), pa.array(score[held]),
                                              pa.array(open_[held] == 0)], names=["q", "b", "score", "done"])


def _search(queries: DataFrame, fixed: DataFrame, groups: DataFrame, means: list[tuple[np.ndarray, ...]], links: DataFrame, blocks: int,
            made: Intermediates) -> DataFrame:
    """``(q, b, score, done)``: the beam of every query point ``(q)`` after greedy search from itself and
    the best of the groups next to it, in a table of ``made``."""
    spark = fixed.sparkSession
    advance = partial(_advanced, blocks=blocks, width=WIDTH)
    own = Intermediates(spark)
    asked = queries.mapInArrow(partial(_asked, blocks=blocks), _ROWS).unionByName(fixed)
    probes = _step(asked, blocks, partial(_routed, means=means, probes=PROBES))
    seeds = _step(probes.unionByName(groups), blocks, partial(_seeded, blocks=blocks))
    beam = own.table(_step(seeds.unionByName(asked), blocks, advance))
    while beam.agg(F.sum("n")).first()[0]:     # a beam only gets better and no entry of it is expanded twice, so this ends
        near = _step(links.unionByName(beam.where("kind = 'expand'")), blocks, partial(_expanded, blocks=blocks))
        found = _step(near.unionByName(fixed), blocks, partial(_weighed, blocks=blocks))
        done, own = own, Intermediates(spark)
        better = own.table(_step(found.unionByName(fixed).unionByName(beam.where("kind = 'beam'")), blocks, advance))
        beam, near, found = better, None, None
        _released(spark, done)
    rows = made.table(beam.where("kind = 'beam'").select("data").mapInArrow(_beam_rows, "q bigint, b bigint, score float, done boolean"))
    _released(spark, own)
    return rows


# ---------------------------------------------------------------- exact scores

def _paired(batches: Iterator[pa.RecordBatch], blocks: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        q, b = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
        yield from _dealt(_block_of(q, blocks), "pairs", q, b)


def _with_vectors(block: int, given: dict, blocks: int, mark: str) -> Iterator[pa.RecordBatch]:
    ids, v = _table(given, f"exact{mark}")
    q, b = _joined(given, "pairs")
    q, row = np.unique(q, return_inverse=True)
    yield from _to_points(f"score{mark}", _block_of(b, blocks), q, v[np.searchsorted(ids, q)], None, row, b)


def _scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``(q, b, score)`` of the pairs: inner products in double precision, component by component."""
    for batch in batches:
        for data in batch.column(0):
            q, b, score = (np.frombuffer(x.as_buffer(), t) for x, t in zip(data.values, _KINDS["scores"], strict=True))
            yield pa.RecordBatch.from_arrays([pa.array(q), pa.array(b), pa.array(score)], names=["q", "b", "score"])


def _exact_scores(block: int, given: dict, mark: str) -> Iterator[pa.RecordBatch]:
    ids, v = _table(given, f"exact{mark}")
    q, q_v, _, row, b = _pairs(given, f"score{mark}")
    if not len(row):
        return
    at = np.searchsorted(ids, b)
    for lo in range(0, len(row), 1 << 16):
        i, j = row[lo:lo + (1 << 16)], at[lo:lo + (1 << 16)]
        score = np.zeros(len(i))
        for x, y in zip(q_v.T, v.T):
            score += x[i].astype(np.float64) * y[j]
        yield _message(block, "scores", q[i], ids[j], score)


def _rescored(beam: DataFrame, vectors: DataFrame, blocks: int, mark: str) -> DataFrame:
    """``(q, b, score)`` of the beam on the original vectors."""
    pairs = beam.select("q", "b").mapInArrow(partial(_paired, blocks=blocks), _ROWS)
    sent = _step(pairs.unionByName(vectors), blocks, partial(_with_vectors, blocks=blocks, mark=mark))
    return _step(sent.unionByName(vectors), blocks, partial(_exact_scores, mark=mark)).select("data").mapInArrow(
        _scored, "q bigint, b bigint, score double")


def nearest(rows: DataFrame, queries: DataFrame, k: int = 20, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """``(query_id, rank, vec_id, score)`` for the ids in ``queries(id)``, all of them rows of ``rows``."""
    spark = rows.sparkSession
    with Intermediates(spark) as made:
        good = made.table(usable(rows, id_col, vec_col))
        scale = good.agg(F.max(F.array_max(F.transform("v", F.abs)))).first()[0] or 1.0
        # by a hash first, so that rows are sorted by numbers; vectors are compared where it is equal (0 and -0 are)
        hashed = good.withColumn("hash", F.xxhash64(F.transform("v", lambda x: x + F.lit(0))))
        classes = made.table(hashed.groupBy("hash", "v").agg(F.min("id").alias("point")))
        members = B.shared_table(spark, hashed.join(classes, ["hash", "v"]).select("point", "id"), "members")
        count = classes.count()
        blocks = max(1, min(LEAST_BLOCKS, count // 512), -(-count // BLOCK))
        points = classes.select(F.col("point").alias("id"), "v")
        fixed = made.table(_placed(points, blocks, "points", partial(_shrunk, scale=scale)))
        asked = members.join(queries.select(F.col("id").cast("bigint").alias("id")).distinct(), "id").select(
            F.col("id").alias("query_id"), F.col("point").alias("q"))
        asked = B.shared_table(spark, asked, "queries")
        groups, means = _start(fixed, count, blocks, made)
        links = neighbour_graph(fixed, groups, blocks, made)
        beam = _search(asked.select("q").distinct(), fixed, groups, means, links, blocks, made)
        mark = "4" if good.schema["v"].dataType.elementType == T.FloatType() else ""
        vectors = made.table(_placed(points, blocks, f"exact{mark}", np.asarray))
        score = B.shared_table(spark, _rescored(beam, vectors, blocks, mark), "scores")
    # score of whole classes first: k + 1 ids, one perhaps the query's own, hold the k best; classes that these cannot
    # come from go before their members are listed
    copies = members.groupBy(F.col("point").alias("b")).agg(F.count(F.lit(1)).alias("copies"))
    near = Window.partitionBy("q").orderBy(F.desc("score"), "b")
    wanted = score.withColumn("rank", F.row_number().over(near)).where(F.col("rank") <= k + 1).join(copies, "b")
    better = Window.partitionBy("q").orderBy(F.desc("score")).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    wanted = wanted.withColumn("before", F.sum("copies").over(better) - F.sum("copies").over(Window.partitionBy("q", "score"))).where(
        F.col("before") <= k)
    least = Window.partitionBy("point").orderBy("id")
    firsts = members.withColumn("rank", F.row_number().over(least)).where(F.col("rank") <= k + 1).select(
        F.col("point").alias("b"), F.col("id").alias("vec_id"))
    order = Window.partitionBy("q").orderBy(F.desc("score"), "vec_id")
    found = wanted.select("q", "b", "score").join(firsts, "b").withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k + 1)
    found = found.groupBy("q").agg(F.sort_array(F.collect_list(F.struct("rank", "vec_id", "score"))).alias("x"))
    others = F.slice(F.filter("x", lambda x: x["vec_id"] != F.col("query_id")), 1, k)
    return asked.join(found, "q").select("query_id", F.posexplode(others).alias("rank", "x")).select(
        "query_id", (F.col("rank") + 1).cast("int").alias("rank"), F.col("x.vec_id").alias("vec_id"), F.col("x.score").alias("score"))
