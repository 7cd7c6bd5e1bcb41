"""The prefix trie against a dictionary of prefixes, over one and many shards."""

import hashlib
import random
import zlib

import numpy as np
import pytest

from settlekit.llm.prefix_trie import SparseTable, keyed_turns, prefix_trie, rebuilt_turns, sequences

SCHEMA = "conv_id bigint, turn int, role string, text string, key string, pos int, shard int, n int"


def turns_of(rows):
    """conv_id -> [(role, text)] in order; the tie rule is the turn's key."""
    def key(r, x):
        r, x = (r or "").encode(), (x or "").encode()
        return hashlib.sha256(str(len(r)).encode() + b":" + r + x).hexdigest()[:32]
    out = {}
    for c, t, r, x, *_ in rows:
        if c is not None:
            out.setdefault(c, []).append((t is not None, t or 0, key(r, x), r or "", x or ""))
    return {c: [(r, x) for *_, r, x in sorted(v)] for c, v in out.items()}


def rebuild(convs):
    made = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = c - (abs(c) % 5) * (1 if c >= 0 else -1)
        made[c] = convs.get(base, [])[:h] + own[h:]
    return made


def brute(convs):
    members, kids = {}, {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    for p in members:
        if p:
            kids.setdefault(p[:-1], []).append(p)
    leaves, saved = {}, {}
    for p in sorted(members, key=len, reverse=True):
        below = kids.get(p, [])
        leaves[p] = sum(leaves[k] for k in below) if below else 1
        own = (len(members[p]) - 1) * len(p[-1][1].encode()) if p else 0
        saved[p] = own + sum(saved[k] for k in below)
    rows = []
    for p, ids in members.items():
        ends = ",".join(map(str, sorted(c for c in ids if len(convs[c]) == len(p))))
        rows.append((min(ids), len(p), min(members[p[:-1]]) if p else None, len(ids), len(kids.get(p, [])), leaves[p], saved[p],
                     hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(rows, key=str)


def random_rows(seed, n=120):
    rng = random.Random(seed)
    rows = []
    for c in range(-10, n):
        hot = rng.random() < 0.4
        for t in range(rng.choice([1, 1, 2, 3, 5, 12])):
            text = "same" if hot else rng.choice(["a", "b", "", None, "é" * 40])
            rows.append((c, rng.choice([t, t, t, None]), rng.choice(["user", None, ""]) if not hot else "user", text, "k", 1, 2, 3))
    rows += [(None, 0, "user", "x", "k", 1, 2, 3)] * 3 + [rows[5]] * 2
    return rows


@pytest.mark.parametrize("seed,shard_turns", [(1, 10 ** 6), (2, 5), (3, 1)])
def test_matches_brute_force(sc, seed, shard_turns):
    rows = random_rows(seed)
    keyed = keyed_turns(sc.createDataFrame(rows, SCHEMA))
    got = prefix_trie(sequences(rebuilt_turns(keyed)), shard_turns=shard_turns)
    assert sorted(map(tuple, got.collect()), key=str) == brute(rebuild(turns_of(rows)))


def test_copies_long_conversations_and_one_key(sc):
    """A third of all conversations equal, ids over several blocks, one very long conversation."""
    rows = [(i * 40_000, t, "user", f"t{t}", "", 0, 0, 0) for i in range(40) for t in range(3)]
    rows += [(10 ** 7 + 1, t, "user", f"t{t % 7}", "", 0, 0, 0) for t in range(3000)]
    rows += [(10 ** 7 + i, 0, "user", f"t{i % 3}", "", 0, 0, 0) for i in range(2, 30)]
    from pyspark.sql import functions as F
    convs = sequences(keyed_turns(sc.createDataFrame(rows, SCHEMA)).withColumn("part", F.lit(1)))
    got = sorted(map(tuple, prefix_trie(convs, shard_turns=200).collect()), key=str)
    assert got == brute(turns_of(rows))


def test_empty_and_turnless(sc):
    empty = sc.createDataFrame([], SCHEMA)
    assert prefix_trie(sequences(rebuilt_turns(keyed_turns(empty)))).count() == 0
    # ids whose base is absent and whose own turns all fall away: the root alone
    ids = [c for c in range(1, 400) if c % 5 and zlib.crc32(str(c).encode()) % 9 >= 1][:3]
    rows = [(c, 0, "user", "x", "", 0, 0, 0) for c in ids]
    got = prefix_trie(sequences(rebuilt_turns(keyed_turns(sc.createDataFrame(rows, SCHEMA))))).collect()
    assert list(map(tuple, got)) == brute(rebuild(turns_of(rows))) and len(got) == 1


def test_sparse_table():
    rng = np.random.default_rng(0)
    v = rng.integers(0, 6, 200)
    table = SparseTable(v)
    at, floor = rng.integers(0, 200, 500), rng.integers(0, 7, 500)
    for a, f, r, l in zip(at, floor, table.right(at, floor), table.left(at, floor)):
        want = a
        while want + 1 < 200 and v[want + 1] >= f:
            want += 1
        assert r == want
        want = a
        while want > 0 and v[want] >= f:
            want -= 1
        assert l == want
