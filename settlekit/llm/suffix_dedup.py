"""Exact substring dedup: remove bytes covered by an n-byte string (n = 50) that
also starts in a document with a smaller id.

How it runs
1. Every window of ``length`` bytes is represented by its least-hash
   ``seed``-gram (a minimizer). Consecutive windows with one minimizer form a
   run, so each window lies in exactly one run, and equal windows always meet
   under one minimizer hash. A task packs its runs (minimizer, hash of the run's
   bytes, document, offset) into one blob per minimizer bucket. Runs that a
   smaller document of the same block already holds are settled there, so a hot
   passage sends one entry per block and not one per document.
2. Per bucket: a run whose bytes also occur in a smaller document is covered.
   Runs under a minimizer with several different runs are *contested*: they may
   share some windows only.
3. The bytes of contested runs go to suffix shards. Each shard's suffix array is
   built by induced sorting (``suffix_array``), common prefixes are computed in
   text order against the preceding suffix (permuted), and windows whose common
   prefix reaches ``length`` form one class; its members in documents above the
   class's least id are covered.
4. Spans return to their documents, are united, and cut out.

Defined results: null text counts as empty; a text shorter than ``length`` keeps
all bytes; rows with a null id neither remove nor lose anything; rows with equal
ids do not remove from each other (they are no "smaller" document); an empty
table gives an empty result. Input columns named like an output column are
replaced by it.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from settlekit.llm import blocks as B

LENGTH = 50
SEED = 20
BLOCK_BYTES = 6 << 20      # text per locally settled block
BUCKET_BYTES = 5 << 20      # text per minimizer bucket (about 4 MB packed)
SLOT_BYTES = 16 << 20       # text per document slot
OUTPUTS = ("n_bytes", "n_removed", "n_spans", "kept_sha256")


# ------------------------------------------------------------ suffix arrays

def _position(n: int) -> type:
    """The integer type of positions in ``n`` bytes: half the memory wherever that is enough."""
    return np.int32 if n < 1 << 31 else np.int64


def suffix_array(text: np.ndarray, sigma: int) -> np.ndarray:
    """Suffix array of ``text`` (values 1..sigma-1 with one final 0) by induced sorting.

    Suffixes are classified S or L, leftmost-S substrings are sorted by one
    induction and named, the string of names is sorted recursively, and a second
    induction yields the array. Each bucket is scanned in whole blocks, so an
    induction is a few numpy calls per symbol. Name strings with a large alphabet
    are ranked by doubling, as their buckets would be too small for that.
    """
    n = len(text)
    position = _position(n)
    if n == 1:
        return np.zeros(1, dtype=position)
    step = np.zeros(n, dtype=np.int8)
    step[:-1] = (text[1:] > text[:-1]).view(np.int8) - (text[1:] < text[:-1]).view(np.int8)
    step[-1] = 1
    nxt = np.where(step != 0, np.arange(n, dtype=position), position(n - 1))
    np.minimum.accumulate(nxt[::-1], out=nxt[::-1])
    is_s = step[nxt] > 0
    del step, nxt
    lms = np.flatnonzero(is_s[1:] & ~is_s[:-1]) + 1
    sizes = np.bincount(text, minlength=sigma)
    tails = np.cumsum(sizes)
    heads = tails - sizes

    def ranks(sorted_chars, counts):
        first = np.cumsum(counts) - counts
        return np.arange(len(sorted_chars)) - first[sorted_chars]

    def induce(lms_order):
        sa = np.full(n, -1, dtype=position)
        chars = text[lms_order]
        by = np.argsort(chars, kind="stable")
        counts = np.bincount(chars, minlength=sigma)
        sorted_chars = chars[by]
        lms_from = tails - counts
        sa[lms_from[sorted_chars] + ranks(sorted_chars, counts)] = lms_order[by]
        fill = heads.copy()

        def put_l(block):
            j = block - 1
            j = j[(j >= 0) & ~is_s[j]]
            if len(j):
                c = text[j]
                by = np.argsort(c, kind="stable")
                counts = np.bincount(c, minlength=sigma)
                c = c[by]
                sa[fill[c] + ranks(c, counts)] = j[by]
                np.add(fill, counts, out=fill)

        for c in np.flatnonzero(sizes):
            done = heads[c]
            while done < fill[c]:
                upto = fill[c]
                put_l(sa[done:upto])
                done = upto
            if lms_from[c] < tails[c]:
                put_l(sa[lms_from[c]:tails[c]])
        l_end = fill
        floor = tails.copy()

        def put_s(block):
            j = block - 1
            j = j[(j >= 0) & is_s[j]]
            if len(j):
                c = text[j]
                by = np.argsort(c, kind="stable")
                counts = np.bincount(c, minlength=sigma)
                c = c[by]
                sa[floor[c] - 1 - ranks(c, counts)] = j[by]
                np.subtract(floor, counts, out=floor)

        for c in np.flatnonzero(sizes)[::-1]:
            done = tails[c]
            if c == 0:
                sa[0], floor[0] = n - 1, 0
            while done > floor[c]:
                upto = floor[c]
                put_s(sa[upto:done][::-1])
                done = upto
            if heads[c] < l_end[c]:
                put_s(sa[heads[c]:l_end[c]][::-1])
        return sa

    if len(lms) <= 1:
        return induce(lms)
    sa = induce(lms)
    at = np.full(n, -1, dtype=position)
    at[lms] = np.arange(len(lms))
    order = at[sa[at[sa] >= 0]]
    del sa, at
    length = np.append(np.diff(lms) + 1, 1)
    same = np.zeros(len(order), dtype=bool)
    left, right = order[:-1], order[1:]
    pairs = np.flatnonzero(length[left] == length[right])
    offset, open_pairs = 0, pairs
    while len(open_pairs):
        a, b = left[open_pairs], right[open_pairs]
        ended = length[a] == offset
        same[1 + open_pairs[ended]] = True
        open_pairs, a, b = open_pairs[~ended], a[~ended], b[~ended]
        open_pairs = open_pairs[text[lms[a] + offset] == text[lms[b] + offset]]
        offset += 1
    names = np.empty(len(order), dtype=np.int64)
    names[order] = np.cumsum(~same) - 1
    n_names = int(names.max()) + 1
    if n_names == len(lms):
        reduced = order
    elif n_names <= 1024:
        reduced = suffix_array(names, n_names)
    else:
        reduced = _by_doubling(names)
    return induce(lms[reduced])


def _by_doubling(rank: np.ndarray) -> np.ndarray:
    """Suffix order of a string of names whose last name is the least and unique."""
    n, h = len(rank), 1
    while True:
        key = (rank.astype(np.uint64) + np.uint64(1)) << np.uint64(32)
        key[:n - h] |= (rank[h:] + 1).astype(np.uint64)
        order = np.argsort(key, kind="stable")
        key = key[order]
        rank = np.empty(n, dtype=np.int64)
        rank[order] = np.cumsum(np.append([0], key[1:] != key[:-1]))
        if rank[order[-1]] == n - 1 or h >= n:
            return order
        h = min(2 * h, n)


def permuted_reach(data: np.ndarray, sa: np.ndarray, starts: np.ndarray, length: int) -> np.ndarray:
    """For each text position in ``starts``: does its common prefix with the
    suffix before it in ``sa`` reach ``length``? (Permuted order; both suffixes
    must have ``length`` bytes left.)"""
    before = np.full(len(sa), -1, dtype=sa.dtype)
    before[sa[1:]] = sa[:-1]
    prev = before[starts]
    del before
    ok = (prev >= 0) & (prev + length <= len(data))
    words = np.ndarray((max(0, len(data) - 7),), dtype="<u8", buffer=np.ascontiguousarray(data), strides=(1,)) \
        if len(data) >= 8 else np.zeros(0, np.uint64)
    full = length - length % 8
    for d in (*range(0, full, 8), *([length - 8] if length % 8 and length >= 8 else [])):
        at = np.flatnonzero(ok)
        ok[at] = words[starts[at] + d] == words[prev[at] + d]
    for d in range(length) if length < 8 else ():
        at = np.flatnonzero(ok)
        ok[at] = data[starts[at] + d] == data[prev[at] + d]
    return ok


def covered_windows(data: np.ndarray, run_start: np.ndarray, run_len: np.ndarray, doc: np.ndarray,
                    length: int) -> tuple[np.ndarray, np.ndarray]:
    """(run, offset) of the windows whose bytes also start in a run of a smaller document.

    ``data`` holds the runs, each followed by one separator byte.
    """
    text = np.zeros(len(data) + 1, dtype=np.uint16)
    np.add(data, 2, out=text[:-1], dtype=np.uint16)
    text[run_start + run_len] = 1
    sa = suffix_array(text, 258)[1:]
    del text
    n_windows = np.maximum(run_len - length + 1, 0)
    starts = B.ranges(run_start, n_windows)
    run_of = np.full(len(data), -1, dtype=sa.dtype)
    run_of[starts] = np.repeat(np.arange(len(run_len), dtype=sa.dtype), n_windows)
    joined = np.zeros(len(data), dtype=bool)
    joined[starts] = permuted_reach(data, sa, starts, length)
    windows = sa[run_of[sa] >= 0]
    if not len(windows):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    heads = np.flatnonzero(~joined[windows])
    docs = doc[run_of[windows]]
    least = np.minimum.reduceat(docs, heads)
    hit = windows[docs > np.repeat(least, np.diff(np.append(heads, len(windows))))]
    hit.sort()
    return run_of[hit], hit - run_start[run_of[hit]]


# ------------------------------------------------------------ packed rows

def _pack(**arrays: np.ndarray) -> bytes:
    raw = b"".join(struct.pack("<cI", a.dtype.char.encode(), a.nbytes) + a.tobytes() for a in arrays.values())
    return zstandard.ZstdCompressor(level=1).compress(raw)


def _unpack(blob: bytes) -> list[np.ndarray]:
    raw, at, out = zstandard.ZstdDecompressor().decompress(blob), 0, []
    while at < len(raw):
        kind, size = struct.unpack_from("<cI", raw, at)
        out.append(np.frombuffer(raw, dtype=kind.decode(), count=size // np.dtype(kind.decode()).itemsize, offset=at + 5))
        at += 5 + size
    return out


def _unpack_all(blobs: list[bytes], columns: int) -> list[np.ndarray]:
    parts = [_unpack(b) for b in blobs if b is not None]
    return [np.concatenate([p[i] for p in parts]) if parts else np.zeros(0, np.int64) for i in range(columns)]


def _slot_of(doc: np.ndarray, slots: int) -> np.ndarray:
    return (B.mix(doc.astype(np.uint64)) % np.uint64(slots)).astype(np.int64)


def _split(part: np.ndarray, n: int) -> Iterator[tuple[int, np.ndarray]]:
    """(part, positions) of each part that has rows, positions in input order."""
    order = np.argsort(part, kind="stable")
    cuts = np.concatenate(([0], np.cumsum(np.bincount(part, minlength=n))))
    for p in np.flatnonzero(np.diff(cuts)):
        yield int(p), order[cuts[p]:cuts[p + 1]]


def runs(data: np.ndarray, offsets: np.ndarray, length: int, seed: int):
    """(row, start, end, minimizer hash, run hash) of a piece's runs."""
    n, width = len(data) - length + 1, length - seed + 1
    empty = np.zeros(0, np.int64)
    if n <= 0:
        return empty, empty, empty, empty.astype(np.uint64), empty.astype(np.uint64)
    spans = B.SpanHash(data)
    grams = spans.fixed(seed)
    low = np.uint64(4095)
    least, have = (grams & ~low) | (np.arange(len(grams), dtype=np.uint64) & low), 1
    while have < width:
        step = min(have, width - have)
        least = np.minimum(least[:len(least) - step], least[step:])
        have += step
    start = np.arange(n)
    at = start + ((least[:n].astype(np.int64) - start) & 4095)
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))[:n]
    inside = start + length <= offsets[row + 1]
    start, at, row = start[inside], at[inside], row[inside]
    if not len(start):
        return empty, empty, empty, empty.astype(np.uint64), empty.astype(np.uint64)
    first = B.group_starts(at, row)
    s = start[first]
    e = start[np.append(first[1:], len(start)) - 1] + length
    row = row[first]
    return row, s - offsets[row], e - offsets[row], grams[at[first]], spans.of(s, e)


def _fingerprints(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    return (B.SpanHash(data).of(offsets[:-1], offsets[1:]) >> np.uint64(32)).astype(np.uint32)


@B.tidy
def _pack_runs(batches: Iterator[pa.RecordBatch], length: int, seed: int, buckets: int) -> Iterator[pa.RecordBatch]:
    B.hold("suffix_dedup")
    out_schema = pa.schema([("bucket", pa.int32()), ("blob", pa.binary())])

    def flush(got):
        doc, fp, s, e, h, ctx = (np.concatenate(x) for x in zip(*got, strict=True))
        order = np.lexsort((doc, ctx, h))
        g = B.group_starts(h[order], ctx[order])
        least = np.repeat(doc[order[g]], np.diff(np.append(g, len(order)))) if len(g) else doc[:0]
        settled = np.zeros(len(doc), dtype=bool)
        settled[order] = doc[order] > least
        rows = []
        for p, at in _split((h & np.uint64(buckets - 1)).astype(np.int64), buckets):
            o, x = at[~settled[at]], at[settled[at]]
            rows.append((p, _pack(
                doc=np.diff(doc[o], prepend=0), fp=fp[o], s=s[o].astype(np.uint32), n=(e[o] - s[o]).astype(np.uint16),
                key=(h[o] >> np.uint64(32)).astype(np.uint32), ctx=(ctx[o] >> np.uint64(32)).astype(np.uint32),
                ctx2=(ctx[o] & np.uint64(0xFFFF)).astype(np.uint16),
                doc0=np.diff(doc[x], prepend=0), fp0=fp[x], s0=s[x].astype(np.uint32),
                n0=(e[x] - s[x]).astype(np.uint16))))
        return pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.binary())], schema=out_schema)

    for batch in batches:
        got, held = [], 0
        ids = batch.column(0).cast(pa.int64())
        known = ids.is_valid().to_numpy(zero_copy_only=False)
        ids = ids.fill_null(0).to_numpy(zero_copy_only=False)
        for lo, _hi, data, offsets in B.pieces(batch.column(1)):
            row, s, e, h, ctx = runs(data, offsets, length, seed)
            fp = _fingerprints(data, offsets)
            keep = known[lo + row]
            row, s, e, h, ctx = row[keep], s[keep], e[keep], h[keep], ctx[keep]
            if len(row):
                got.append((ids[lo + row], fp[row], s, e, h, ctx))
            held += len(data)
            if held >= BLOCK_BYTES and got:
                yield flush(got)
                got, held = [], 0
        if got:
            yield flush(got)


@B.tidy_group
def _judge_bucket(table: pa.Table, slots: int) -> pa.Table:
    """Settles equal runs of one bucket; returns packed spans (kind 0) and contested runs (kind 1) by slot."""
    bucket = table["bucket"][0].as_py()
    parts = [_unpack(b) for b in table["blob"].to_pylist()]
    cat = lambda i: np.concatenate([p[i] for p in parts])
    doc = np.concatenate([np.cumsum(p[0]) for p in parts])
    fp, s, n, key = cat(1), cat(2), cat(3), cat(4)
    ctx = (cat(5).astype(np.uint64) << np.uint64(16)) | cat(6)
    order = np.lexsort((doc, ctx, key))
    doc, fp, s, n, key, ctx = doc[order], fp[order], s[order], n[order], key[order], ctx[order]
    rows: list[tuple[int, int, bytes]] = []
    spans = [(np.concatenate([np.cumsum(p[7]) for p in parts]), cat(8), cat(9), cat(10))]
    if len(doc):
        g, gc = B.group_starts(key), B.group_starts(key, ctx)
        per, per_ctx = np.diff(np.append(g, len(doc))), np.diff(np.append(gc, len(doc)))
        head = np.zeros(len(doc), dtype=bool)
        head[gc] = True
        covered = doc > np.repeat(doc[gc], per_ctx)
        mixed = (np.minimum.reduceat(doc, g) != np.maximum.reduceat(doc, g)) & (np.add.reduceat(head, g, dtype=np.int64) > 1)
        contested = np.repeat(mixed, per) & ~covered
        spans.append((doc[covered], fp[covered], s[covered], n[covered]))
        at = np.flatnonzero(contested)
        for slot, x in _split(_slot_of(doc[at], slots), slots):
            x = at[x]
            rows.append((1, slot, _pack(doc=doc[x], fp=fp[x], s=s[x], n=n[x],
                                        shard=np.full(len(x), bucket, np.int32))))
    doc, fp, s, n = (np.concatenate(x) for x in zip(*spans, strict=True))
    for slot, x in _split(_slot_of(doc, slots), slots):
        rows.append((0, slot, _pack(doc=doc[x], fp=fp[x], s=s[x], n=n[x])))
    return _rows_table(rows, _SPAN_ARROW)


_SPAN_ARROW = pa.schema([("kind", pa.int32()), ("slot", pa.int32()), ("blob", pa.binary())])
_SPAN_SCHEMA = "kind int, slot int, blob binary"


def _rows_table(rows: list[tuple], schema: pa.Schema) -> pa.Table:
    columns = list(zip(*rows, strict=True)) if rows else [()] * len(schema)
    return pa.table([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


@B.tidy
def _pack_texts(batches: Iterator[pa.RecordBatch], slots: int) -> Iterator[pa.RecordBatch]:
    """Each row with its slot, text fingerprint and compressed text."""
    B.hold("suffix_dedup")
    zip_text = zstandard.ZstdCompressor(level=1).compress
    for batch in batches:
        ids = batch.column(0).cast(pa.int64()).fill_null(0).to_numpy(zero_copy_only=False)
        blobs, prints = [], []
        for _lo, _hi, data, offsets in B.pieces(batch.column(1)):
            raw = data.tobytes()
            blobs += [zip_text(raw[a:b]) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
            prints.append(_fingerprints(data, offsets))
        fp = np.concatenate(prints).astype(np.int64) if prints else np.zeros(0, np.int64)
        yield pa.RecordBatch.from_arrays(
            [pa.array(_slot_of(ids, slots), pa.int32()), pa.array(fp), pa.array(blobs, pa.binary()), *batch.columns[2:],
             batch.column(0)], names=["__slot", "__fp", "__text", *batch.schema.names[2:], "__id"])


def _slot_spans(blobs: pa.Table, columns: int) -> dict[tuple[int, int], tuple[np.ndarray, ...]]:
    """Spans by (document, fingerprint)."""
    got = _unpack_all(blobs["blob"].to_pylist(), columns)
    if not len(got[0]):
        return {}
    order = np.lexsort((got[2], got[1], got[0]))
    got = [g[order].astype(np.int64) for g in got]
    first = B.group_starts(got[0], got[1])
    ends = np.append(first[1:], len(order))
    return {(int(got[0][a]), int(got[1][a])): tuple(g[a:b] for g in got[2:])
            for a, b in zip(first.tolist(), ends.tolist(), strict=True)}


@B.tidy_group
def _extract(texts: pa.Table, wanted: pa.Table) -> pa.Table:
    """The bytes of contested runs, packed by suffix shard."""
    schema = pa.schema([("shard", pa.int32()), ("blob", pa.binary())])
    want = _slot_spans(wanted, 5)
    if not want:
        return _rows_table([], schema)
    unzip = zstandard.ZstdDecompressor()
    got, done = [], set()
    for doc, fp, blob in zip(texts["__id"].to_pylist(), texts["__fp"].to_pylist(), texts["__text"].to_pylist(), strict=True):
        span = want.get((doc, fp)) if (doc, fp) not in done else None
        if span is not None:
            done.add((doc, fp))
            data = np.frombuffer(unzip.decompress(blob), np.uint8)
            got.append((doc, fp, *span, data[B.ranges(span[0], span[1])]))
    if not got:
        return _rows_table([], schema)
    count = [len(g[2]) for g in got]
    doc = np.repeat(np.array([g[0] for g in got]), count)
    fp = np.repeat(np.array([g[1] for g in got]), count).astype(np.uint32)
    s, n, shard = (np.concatenate([g[i] for g in got]) for i in (2, 3, 4))
    data = np.concatenate([g[5] for g in got])
    at = np.cumsum(n) - n
    rows = [(int(p), _pack(doc=doc[x], fp=fp[x], s=s[x].astype(np.uint32), n=n[x].astype(np.uint16),
                           data=data[B.ranges(at[x], n[x])])) for p, x in _split(shard, int(shard.max()) + 1)]
    return _rows_table(rows, schema)


@B.tidy_group
def _judge_shard(table: pa.Table, length: int, slots: int) -> pa.Table:
    doc, fp, s, n, data = _unpack_all(table["blob"].to_pylist(), 5)
    n = n.astype(np.int64)
    at = np.cumsum(n) - n
    spaced = np.zeros(len(data) + len(n), dtype=np.uint8)
    begin = at + np.arange(len(n))
    spaced[B.ranges(begin, n)] = data
    run, offset = covered_windows(spaced, begin, n, doc, length)
    if not len(run):
        return _rows_table([], _SPAN_ARROW)
    fresh = np.flatnonzero(np.append(True, (run[1:] != run[:-1]) | (offset[1:] != offset[:-1] + 1)))
    last = np.append(fresh[1:], len(run)) - 1
    run, size = run[fresh], offset[last] - offset[fresh] + length
    d, f, start = doc[run], fp[run], s[run].astype(np.int64) + offset[fresh]
    rows = [(0, slot, _pack(doc=d[x], fp=f[x], s=start[x].astype(np.uint32), n=size[x].astype(np.uint16)))
            for slot, x in _split(_slot_of(d, slots), slots)]
    return _rows_table(rows, _SPAN_ARROW)


def kept_bytes(data: bytes, start: np.ndarray, size: np.ndarray) -> tuple[bytes, int, int]:
    """(remaining bytes, removed bytes, maximal removed runs) for spans sorted by start."""
    end = np.maximum.accumulate(start + size)
    fresh = np.flatnonzero(np.append(True, start[1:] > end[:-1]))
    lo, hi = start[fresh], end[np.append(fresh[1:], len(start)) - 1]
    parts, at = [], 0
    for a, b in zip(lo.tolist(), hi.tolist(), strict=True):
        parts.append(data[at:a])
        at = b
    parts.append(data[at:])
    return b"".join(parts), int((hi - lo).sum()), len(lo)


@B.tidy_group
def _finish(texts: pa.Table, spans: pa.Table, others: list[str], text_out: bool) -> pa.Table:
    cut = _slot_spans(spans, 4)
    unzip = zstandard.ZstdDecompressor()
    size, removed, n_spans, digest, left = [], [], [], [], []
    for doc, fp, blob in zip(texts["__id"].to_pylist(), texts["__fp"].to_pylist(), texts["__text"].to_pylist(), strict=True):
        data = unzip.decompress(blob)
        gone = cut.get((doc, fp))
        kept, n, k = kept_bytes(data, *gone) if gone is not None else (data, 0, 0)
        size.append(len(data)), removed.append(n), n_spans.append(k), digest.append(hashlib.sha256(kept).hexdigest())
        if text_out:
            left.append(kept.decode("utf-8", "ignore").encode())
    made = {"n_bytes": pa.array(size, pa.int64()), "n_removed": pa.array(removed, pa.int64()),
            "n_spans": pa.array(n_spans, pa.int64()), "kept_sha256": pa.array(digest, pa.string())}
    if text_out:
        made["kept_text"] = pa.array(left, pa.binary()).cast(pa.string())
    return pa.table([texts["__id"], *[texts[c] for c in others], *made.values()], names=["__id", *others, *made])


def suffix_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH,
                 seed: int = SEED, with_text: bool = True) -> DataFrame:
    """Every input row with ``n_bytes, n_removed, n_spans, kept_sha256`` and,
    with ``with_text``, ``kept_text`` (the remaining bytes; a character cut in
    two is dropped). ``text_col`` itself is not returned."""
    spark = docs.sparkSession
    made = [*OUTPUTS, *(["kept_text"] if with_text else [])]
    others = [c for c in docs.columns if c not in (id_col, text_col, *made) and not c.startswith("__")]
    pair = docs.select(F.col(id_col).cast("bigint").alias("__id"), F.col(text_col).cast("string").alias("__text"))
    _, volume = B.text_volume(pair, "__text")
    buckets = 1 << max(3, (volume // BUCKET_BYTES).bit_length())
    slots = max(8, volume // SLOT_BYTES)
    packed = pair.mapInArrow(lambda it: _pack_runs(it, length, seed, buckets), "bucket int, blob binary")
    judged = B.shared_table(spark, packed.groupBy("bucket").applyInArrow(
        lambda t: _judge_bucket(t, slots), _SPAN_SCHEMA), "runs")

    kept = docs.select(F.col(id_col).cast("bigint").alias("__id"), F.col(text_col).cast("string").alias("__text"),
                       *others)
    text_schema = T.StructType([T.StructField("__slot", T.IntegerType()), T.StructField("__fp", T.LongType()),
                                T.StructField("__text", T.BinaryType()), *kept.schema.fields[2:],
                                T.StructField("__id", T.LongType())])
    texts = kept.mapInArrow(lambda it: _pack_texts(it, slots), text_schema)
    found = texts.groupBy("__slot").cogroup(judged.where("kind = 1").groupBy("slot")).applyInArrow(
        lambda a, b: _extract(a, b), "shard int, blob binary")
    more = found.groupBy("shard").applyInArrow(lambda t: _judge_shard(t, length, slots), _SPAN_SCHEMA)
    spans = judged.where("kind = 0").unionByName(more)
    kinds = {"kept_sha256": T.StringType(), "kept_text": T.StringType()}
    out_schema = T.StructType([T.StructField("__id", T.LongType()), *kept.schema.fields[2:],
                               *[T.StructField(c, kinds.get(c, T.LongType())) for c in made]])
    return texts.groupBy("__slot").cogroup(spans.groupBy("slot")).applyInArrow(
        lambda a, b: _finish(a, b, others, with_text), out_schema).withColumnRenamed("__id", id_col)
