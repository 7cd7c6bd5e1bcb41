"""Near and substring dedup against brute force, with nulls, ties, copies and clashing columns."""

import hashlib
import random
import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest

from settlekit.llm import near_dedup as N
from settlekit.llm import suffix_dedup as S
from settlekit.llm.components import connected_components

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def texts(seed):
    r = random.Random(seed)
    vocabulary = ["".join(r.choice("abcdeé") for _ in range(r.randint(1, 6))) for _ in range(300)]
    out = [None, "", " \t\n", "One two", "one TWO", "one", "x" * 60]
    base = [[r.choice(vocabulary) for _ in range(r.randint(3, 120))] for _ in range(12)]
    for words in base:
        for _ in range(r.randint(1, 6)):
            copy = [r.choice(vocabulary) if r.random() < r.choice((0, 0.01, 0.03, 0.1)) else w for w in words]
            out.append(r.choice((" ", "  ", "\n")).join(copy))
    out += out[8:14]
    r.shuffle(out)
    return list(enumerate(out))


def sets_of(text, width):
    w = re.findall("[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    return {tuple(w[k:k + width]) for k in range(len(w) - width + 1)} if len(w) >= width else ({tuple(w)} if w else set())


def brute_components(rows, width, percent):
    sets = {i: sets_of(t, width) for i, t in rows}
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in sets:
        for b in sets:
            both = len(sets[a] & sets[b])
            if a < b and both and 100 * both >= percent * len(sets[a] | sets[b]):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), root(i), root(i) == i) for i in sets}


@pytest.mark.parametrize("seed,width,percent", [(1, 3, 85), (2, 5, 80)])
def test_near_duplicates(sc, seed, width, percent):
    rows = texts(seed)
    df = sc.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, component_id string, tokens int")
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept)
           for r in N.near_duplicate_classes(df, width=width, percent=percent).collect()}
    assert got == brute_components(rows, width, percent)


def test_near_duplicates_edges(sc):
    df = sc.createDataFrame([(None, "a b c d"), (None, "a b c d"), (3, "a b c d"), (3, "a b c d"), (4, "A B c d")],
                            "doc_id long, text string")
    got = sorted(((r.doc_id, r.component_id, r.kept) for r in N.near_duplicate_classes(df, width=3, percent=85).collect()),
                 key=str)
    assert got == [(3, 3, True), (3, 3, True), (4, 3, False), (None, None, True), (None, None, True)]
    assert N.near_duplicate_classes(df.limit(0)).count() == 0
    assert sorted(str(r.doc_id) for r in N.drop_near_duplicates(df, width=3, percent=85).collect()) == ["3", "3", "None", "None"]


def test_large_group_of_near_copies_needs_few_pairs(sc):
    r = random.Random(5)
    base = [f"w{r.randint(0, 10**6)}" for _ in range(100)]
    rows = []
    for i in range(300):
        words = list(base)
        for _ in range(r.randint(0, 6)):
            words[r.randrange(100)] = f"v{r.randint(0, 10**9)}"
        rows.append((i, " ".join(words)))
    df = sc.createDataFrame(rows, "doc_id long, text string")
    got = {x.doc_id: (x.n_shingles, x.component_id, x.kept) for x in N.near_duplicate_classes(df, width=3, percent=85).collect()}
    assert got == brute_components(rows, 3, 85)


def test_matches_bound():
    assert N.matches_for(85, 48, 1e-8) == 22 and N.matches_for(80, 48, 1e-8) == 19
    assert N.matches_for(100, 48, 1e-8) == 46


def test_components(sc):
    r = random.Random(1)
    edges = [(r.randint(0, 80), r.randint(0, 80)) for _ in range(60)]
    got = {x.node: x.component for x in connected_components(sc.createDataFrame(edges, "a long, b long")).collect()}
    groups = {n: {n} for e in edges for n in e if e[0] != e[1]}
    for a, b in edges:
        if a != b and groups[a] is not groups[b]:
            joint = groups[a] | groups[b]
            for n in joint:
                groups[n] = joint
    assert got == {n: min(g) for n, g in groups.items()}
    assert connected_components(sc.createDataFrame([], "a long, b long")).count() == 0


def test_stars_are_extended_in_few_rounds(sc, monkeypatch):
    """Known stars with new links: the components of all edges together, and no round where nothing
    is left to do (a second one and a count of it, every time, before)."""
    from settlekit.llm import components as C
    made, plain = [], C.shared_table
    monkeypatch.setattr(C, "shared_table", lambda *a: made.append(a[2]) or plain(*a))
    star = C.stars(sc.createDataFrame([(i, 0) for i in range(1, 9)] + [(i, 20) for i in range(21, 26)], "a long, b long"))
    assert len(made) == 1 and sorted(map(tuple, star.collect())) == [(i, 0) for i in range(1, 9)] + [(i, 20) for i in range(21, 26)]
    links = [(23, 7), (40, 23), (50, 51)]
    both = C.stars(star.unionByName(sc.createDataFrame(links, "a long, b long")))
    assert {x.node: x.component for x in C.members(both).collect()} == {
        **{i: 0 for i in (*range(9), *range(20, 26), 40)}, 50: 50, 51: 50}


def test_stars_take_repeated_edges_and_few_exchanges(sc):
    from settlekit.llm import components as C
    edges = [(1, 2), (2, 1), (3, 2), (3, 2), (7, 5), (5, 7), (9, 5), (9, 7), (4, 4)] * 2
    df = sc.createDataFrame(edges, "a long, b long")
    star = C.stars(df)
    want = {1: 1, 2: 1, 3: 1, 5: 5, 7: 5, 9: 5}
    assert star.count() <= len(edges)
    assert sorted(map(tuple, C.members(star).collect())) == sorted(want.items())
    assert sorted(map(tuple, C.parents(star).collect())) == sorted((n, c) for n, c in want.items() if n != c)
    plan = C._small_star(C._large_star(df))._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("LocalTableScan") + plan.count("Scan ExistingRDD") <= 4      # 12 reads of the edges before


@pytest.mark.parametrize("copies,step,most", [(2, 0, 60), (40, 1, 84)])
def test_near_duplicates_use_few_jobs(sc, copies, step, most):
    """The driver holds something for each job. Before: 117 for two copies, in rounds without a pair to try,
    and 91 for groups of near copies."""
    r = random.Random(11)
    rows = []
    for i in range(4 if step else 1):
        words = [f"w{r.randint(0, 10**6)}" for _ in range(60)]
        rows += [(copies * i + k, " ".join(words[:60 - step * k] + [f"v{i}x{k}y{j}" for j in range(step * k)]))
                 for k in range(copies)]
    df = sc.createDataFrame(rows, "doc_id long, text string")
    sc.sparkContext.setJobGroup(f"near-dedup-{copies}", "")
    try:
        got = {x.doc_id: (x.n_shingles, x.component_id, x.kept)
               for x in N.near_duplicate_classes(df, width=3, percent=85).collect()}
    finally:
        sc.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert got == brute_components(rows, 3, 85)
    assert len(sc.sparkContext.statusTracker().getJobIdsForGroup(f"near-dedup-{copies}")) <= most


def brute_cut(rows, length):
    first = {}
    for i, t in rows:
        if i is not None:
            b = (t or "").encode()
            for k in range(len(b) - length + 1):
                first[b[k:k + length]] = min(i, first.get(b[k:k + length], i))
    out = defaultdict(list)
    for i, t in rows:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for k in range(len(b) - length + 1):
            if i is not None and first[b[k:k + length]] < i:
                gone[k:k + length] = b"\1" * length
        kept = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        spans = len([x for x in bytes(gone).split(b"\0") if x])
        out[i].append((len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return {i: sorted(v) for i, v in out.items()}


@pytest.mark.parametrize("seed,length", [(1, 50), (3, 24)])
def test_suffix_dedup(sc, seed, length):
    rows = texts(seed) + [(None, "y" * 90), (1000, "y" * 200), (1001, "ab" * 100), (1001, "ab" * 80), (1002, "é" * 60)]
    df = sc.createDataFrame([(i, t, "k", 7) for i, t in rows], "doc_id long, text string, lang string, n_bytes int")
    out = S.suffix_dedup(df, length=length, seed=12)
    assert out.columns == ["doc_id", "lang", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept_text"]
    got = defaultdict(list)
    for r in out.collect():
        got[r.doc_id].append((r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256))
    assert {i: sorted(v) for i, v in got.items()} == brute_cut(rows, length)
    assert S.suffix_dedup(df.limit(0)).count() == 0


def test_suffix_array():
    rng = np.random.default_rng(0)
    for _ in range(200):
        sigma = int(rng.integers(2, 6))
        t = np.append(rng.integers(1, sigma, rng.integers(1, 60)), 0).astype(np.uint16)
        assert S.suffix_array(t, sigma + 1).tolist() == sorted(range(len(t)), key=lambda i: t[i:].tolist())
    t = np.append(rng.integers(1, 200, 4000), 0)
    t = np.concatenate([t[:1500], t[:1500], t]).astype(np.uint16)
    assert S.suffix_array(t, 201).tolist() == sorted(range(len(t)), key=lambda i: t[i:].tolist())


def test_shard_memory():
    """Peak of a shard's arrays by byte of it: 80.8 before, 40.9 when this was written."""
    import tracemalloc
    rng = np.random.default_rng(3)
    run_len = rng.integers(50, 200, 4000)
    start = np.cumsum(run_len + 1) - run_len - 1
    word = rng.integers(97, 123, 300).astype(np.uint8)
    data = np.zeros(int(run_len.sum()) + len(run_len), np.uint8)
    for a, n in zip(start.tolist(), run_len.tolist(), strict=True):
        k = int(rng.integers(0, 100))
        data[a:a + n] = word[k:k + n]
    doc = rng.integers(0, 900, len(run_len))
    tracemalloc.start()
    run, offset = S.covered_windows(data, start, run_len, doc, 50)
    peak = tracemalloc.get_traced_memory()[1] / len(data)
    tracemalloc.stop()
    first = {}
    for r, (a, n) in enumerate(zip(start.tolist(), run_len.tolist(), strict=True)):
        for o in range(n - 49):
            w = data[a + o:a + o + 50].tobytes()
            first[w] = min(first.get(w, 10**9), int(doc[r]))
    want = [(r, o) for r, (a, n) in enumerate(zip(start.tolist(), run_len.tolist(), strict=True)) for o in range(n - 49)
            if first[data[a + o:a + o + 50].tobytes()] < doc[r]]
    assert list(zip(run.tolist(), offset.tolist(), strict=True)) == want
    assert peak < 60, peak


def test_groups_leave_no_freed_memory(monkeypatch):
    """Every function of a group gives freed memory back, before its work and after it (none did before)."""
    from settlekit.llm import blocks as B
    calls = []
    monkeypatch.setattr(B, "_trim", lambda: calls.append(1))
    blob = S._pack(doc=np.zeros(0, np.int64), fp=np.zeros(0, np.uint32), s=np.zeros(0, np.uint32), n=np.zeros(0, np.uint16),
                   data=np.zeros(0, np.uint8))
    assert S._judge_shard(pa.table({"blob": pa.array([blob], pa.binary())}), 50, 8).num_rows == 0
    assert len(calls) == 2
    assert all(hasattr(f, "__wrapped__") for f in (S._judge_bucket, S._extract, S._finish))
