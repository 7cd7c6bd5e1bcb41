"""Decontamination and license scan against brute force."""

import hashlib
import random
import re

import pytest

from settlekit.llm import decontaminate as D
from settlekit.llm.license_scan import scan_licenses

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(t):
    return re.findall("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(LOWER))


def brute_hits(text, items, window, coverage):
    w, hit, who = words(text), set(), set()
    for item, t in items:
        v = words(t)
        n = min(window, len(v))
        for k in range(len(v) - n + 1 if v else 0):
            for p in range(len(w) - n + 1):
                if w[p:p + n] == v[k:k + n]:
                    hit |= set(range(p, p + n))
                    who |= {str(item)} if item is not None else set()
    ids = sorted(who)
    return (len(w), len(hit), len(ids), hashlib.sha256(",".join(ids).encode()).hexdigest(),
            bool(hit) and coverage * len(hit) >= len(w))


def test_decontamination(sc, monkeypatch):
    r = random.Random(2)
    vocabulary = "ab cd é9 f g h i j".split()
    say = lambda n: r.choice((" ", ", ", "\n")).join(r.choice(vocabulary) for _ in range(n))
    items = [(i, say(r.randint(1, 9))) for i in range(8)] + [(3, say(4)), (None, say(5)), (10, None), (11, "?!")]
    docs = [(i, r.choice((None, "", "...", say(r.randint(1, 60)), "zz " * 40 + say(8), say(20).upper()))) for i in range(60)]
    docs += docs[:5]
    df = sc.createDataFrame([(i, t, "k", "c") for i, t in docs], "doc_id long, text string, lang string, n_hit string")
    it = sc.createDataFrame(items, "item_id long, text string")
    want = sorted((i, *brute_hits(t, items, 4, 5)) for i, t in docs)
    for block in (200_000, 12):      # one block, then several passes
        monkeypatch.setattr(D, "BLOCK_WORDS", block)
        got = sorted((x.doc_id, x.n_words, x.n_hit, x.n_items, x.items_sha256, x.contaminated)
                     for x in D.benchmark_hits(df, it, window=4, coverage=5).collect())
        assert got == want
    clean = D.drop_contaminated(df, it, window=4, coverage=5)
    assert clean.columns == df.columns
    assert sorted((x.doc_id, x.text or "") for x in clean.collect()) == sorted(
        (i, t or "") for i, t in docs if not brute_hits(t, items, 4, 5)[-1])
    assert D.benchmark_hits(df.limit(0), it).count() == 0
    assert {x.n_hit for x in D.benchmark_hits(df, it.limit(0)).collect()} == {0}


def test_cut_text(sc):
    df = sc.createDataFrame([(1, "Start. Alpha beta, gamma! End")], "doc_id long, text string")
    it = sc.createDataFrame([(1, "alpha BETA gamma")], "item_id long, text string")
    assert D.benchmark_hits(df, it, with_text=True).first().clean_text == "Start. ! End"


def test_licenses(sc):
    r = random.Random(4)
    templates = {"short": "All rights reserved.", "long": "one two three four five six seven eight nine ten eleven twelve",
                 "none": "?!"}
    vocabulary = templates["long"].split() + ["all", "Rights", "reserved", "zz"]
    docs = []
    for i in range(240):
        w = templates["long"].split()
        for _ in range(r.randint(0, 3)):
            w[r.choice((0, 1, 5, 11))] = r.choice(vocabulary)
        docs.append((i, r.choice((None, "", " ".join(r.choice(vocabulary) for _ in range(40)), "x y " + " ".join(w) + " all rights, reserved",
                               " ".join(w[:r.randint(3, 12)])))))
    df = sc.createDataFrame([(i, t, 1) for i, t in docs], "doc_id long, text string, license int")
    want = []
    for i, t in docs:
        w = words(t)
        for name, text in templates.items():
            v = words(text)
            k = min(5, len(v))
            places = len(v) - k + 1
            own = {tuple(v[j:j + k]) for j in range(places)} if v else set()
            found = []
            window = min(places, len(w) - k + 1)      # a shorter text is one window
            for p in range(len(w) - k + 1 - window + 1 if v and window > 0 else 0):
                both = len(own & {tuple(w[j:j + k]) for j in range(p, p + window)})
                if 100 * both >= 80 * len(own):
                    found.append((p, both))
            if found:
                want.append((i, name, len(found), max(b for _, b in found) / len(own), found[0][0]))
    got = [(x.doc_id, x.license, x.n_windows, x.containment, x.first_word) for x in scan_licenses(df, templates).collect()]
    assert sorted(got) == sorted(want) and len(want) > 30
    assert scan_licenses(df.limit(0), templates).count() == 0 and scan_licenses(df, {}).count() == 0


def test_license_bodies_from_a_table(sc, monkeypatch):
    from settlekit.llm import license_scan as L
    monkeypatch.setattr(L, "_CELLS", 4096)
    r = random.Random(8)
    body = {n: [f"{n}{r.randint(0, 400)}" for _ in range(900)] for n in "ab"}
    body["c"] = body["a"][:600] + ["other"] * 5         # shares most of its text with a
    docs, want = [], []
    for i in range(12):
        w = list(body["abc"[i % 3]])
        for _ in range((0, 10, 400)[i // 4]):
            w[r.randrange(len(w))] = "zz"
        docs.append((i, " ".join(["x"] * r.randint(0, 40) + w + ["y"] * r.randint(0, 2000))))
    docs.append((12, " ".join(body["b"][:800])))        # shorter than its template
    for i, t in docs:
        w = t.split()
        for name, v in sorted(body.items()):
            own = {tuple(v[j:j + 5]) for j in range(len(v) - 4)}
            size = min(len(v) - 4, len(w) - 4)
            sets = [own & {tuple(w[j:j + 5]) for j in range(p, p + size)} for p in range(len(w) - 4 - size + 1)]
            hit = [(p, len(x)) for p, x in enumerate(sets) if 100 * len(x) >= 80 * len(own)]
            if hit:
                want.append((i, name, len(hit), max(n for _, n in hit) / len(own), hit[0][0]))
    table = sc.createDataFrame([(n, " ".join(v)) for n, v in body.items()] + [("none", None), (None, "x"), ("a", "zzz")],
                               "license string, text string")
    df = sc.createDataFrame(docs, "doc_id long, text string")
    got = [(x.doc_id, x.license, x.n_windows, x.containment, x.first_word) for x in scan_licenses(df, table).collect()]
    assert sorted(got) == sorted(want) and {x[1] for x in want} == {"a", "b", "c"} and (12, "b") in {x[:2] for x in want}
    monkeypatch.setattr(L, "MAX_TEMPLATE_BYTES", 100)
    with pytest.raises(ValueError):
        scan_licenses(df, table)
