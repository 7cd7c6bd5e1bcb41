"""Held-out accuracy of the trained operators, on the test tables."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from settlekit.llm import blocks as B
from settlekit.llm import language_id, neighbours, quality, queries, toxicity

SF = "/root/testdata/sf0.1"


def auc(score, y):
    order = np.argsort(score, kind="stable")
    rank = np.empty(len(score))
    rank[order] = np.arange(1, len(score) + 1)
    for s in np.unique(score):
        rank[score == s] = rank[score == s].mean()
    n1 = (y == 1).sum()
    return (rank[y == 1].sum() - n1 * (n1 + 1) / 2) / (n1 * (y == 0).sum())


def test_language_id(sc):
    docs = sc.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang")
    got = queries.q_language_id(sc, SF).where("held_out").join(docs, "doc_id").toPandas()
    assert (got.lang_pred == got.lang).mean() > 0.97 and got.accepted.mean() > 0.99
    model = language_id.train(["der hund und die katze"] * 12 + ["the dog and the cat"] * 12, ["de"] * 12 + ["en"] * 12)
    df = sc.createDataFrame([(1, None, "a"), (2, "", "b"), (3, "12 !? 34", "c"), (4, "the cat " * 20000, "d"), (None, "und", "e")],
                            "doc_id long, text string, score string")
    got = {r.doc_id: (r.lang_pred, r.accepted) for r in language_id.identify(df, model).collect()}
    assert got[1] == got[2] == got[3] == ("und", False) and got[4] == ("en", True) and got[None][0] == "de"
    assert language_id.identify(df.limit(0), model).count() == 0
    with pytest.raises(ValueError):
        language_id.fit_language_model(df.limit(0).withColumn("lang", F.lit("x")))


@pytest.mark.parametrize("query,label,least", [(queries.q_toxicity, "toxic", 0.93), (queries.q_quality, "quality", 0.98)])
def test_classifiers(sc, query, label, least):
    labels = sc.read.parquet(f"{SF}/labels.parquet")
    got = query(sc, SF).where("held_out").join(labels, "doc_id").toPandas()
    assert got.score.between(0, 1).all()
    assert auc(got.score.to_numpy(), got[label].to_numpy()) > least


def test_sample_of_repeated_ids_is_bounded(sc):
    df = sc.createDataFrame([(i % 3, f"text {i:03}") for i in range(600)] + [(7, None)], "doc_id long, text string")
    labels = sc.createDataFrame([(0, 1), (0, 1), (1, 1), (2, 0), (7, 0), (None, 0)], "doc_id long, toxic int")
    got = B.labelled_sample(df, labels, "toxic", {1: 5, 0: 5}).collect()
    assert sorted((r.text, r.label) for r in got) == [("text 000", 1), ("text 001", 1), ("text 002", 0)]


def test_long_texts_are_learned_from(sc):
    long = [(i, "le chien et le chat sont ici " * 500, "fr", 1) for i in range(40)]
    short = [(100 + i, "the dog and the cat are here", "en", 0) for i in range(40)]
    mixed = [(200 + i, "der hund und die katze sind hier " * (500 if i % 4 else 1), "de", 0) for i in range(40)]
    df = sc.createDataFrame(long + short + mixed, "doc_id long, text string, lang string, toxic int")
    model = language_id.fit_language_model(df, per_language=20)
    assert model.languages == ["de", "en", "fr"]
    p, _ = model.probabilities(["le chat et le chien", "the cat", "die katze"])
    assert [model.languages[k] for k in p.argmax(axis=1)] == ["fr", "en", "de"]
    labels = df.select("doc_id", "toxic")
    model = toxicity.fit_toxicity_model(df.select("doc_id", "text"), labels, max_bytes=5000)
    got = toxicity.score_toxicity(df.select("doc_id", "text"), model).join(labels, "doc_id").toPandas()
    assert (got.predicted == got.toxic).all()
    picked = B.labelled_sample(df.select("doc_id", "text"), labels, "toxic", {0: 50}, max_bytes=5000).collect()
    assert len(picked) == 50 and sum(len(r.text) <= 5000 for r in picked) == 50


def test_classifier_edges(sc):
    docs = sc.createDataFrame([(i, t) for i, t in enumerate([None, "", "??", "nasty words " * 3000, "fine words", "fine words"])],
                              "doc_id long, text string").withColumn("score", F.lit("x"))
    model = toxicity.train(["nasty words here"] * 9, ["fine words here", "more of the same"] * 9)
    got = {r.doc_id: r.score for r in toxicity.score_toxicity(docs, model).collect()}
    assert got[0] == got[1] == got[2] and got[4] == got[5] and got[3] > got[4] and all(0 <= s <= 1 for s in got.values())
    with pytest.raises(ValueError):
        toxicity.train([], ["x"])
    x = np.random.default_rng(1).normal(size=(400, len(quality.statistics(F.lit("")))))
    rules = quality.train(x, (x[:, 2] > 0.3).astype(int), list(quality.statistics(F.lit(""))))
    scored = {r.doc_id: r.score for r in quality.score_quality(docs, rules).collect()}
    assert scored[0] == scored[1] and scored[4] == scored[5] and all(0 <= s <= 1 for s in scored.values())
    plan = quality.score_quality(docs, rules)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
    for f in (lambda d: toxicity.score_toxicity(d, model), lambda d: quality.score_quality(d, rules)):
        assert f(docs.limit(0)).count() == 0


def test_toxicity_of_many_words_some_quoted():
    r = np.random.default_rng(6)
    made = sorted({"".join(r.choice(list("bdfgklmnprstvz")) + r.choice(list("aeiou")) for _ in range(4)) for _ in range(700)})
    r.shuffle(made)
    bad, plain = made[:300], made[300:600]

    def text(n_bad):
        some = [*r.choice(plain, 60), *r.choice(bad, n_bad)]
        r.shuffle(some)
        return " ".join(some)

    toxic, ordinary = [text(5) for _ in range(1000)], [text(0) for _ in range(1000)]
    model = toxicity.train(toxic, [*ordinary, *(" ".join(bad[i:i + 20]) for i in range(0, 300, 20))])
    distances = model.distances()
    assert np.mean([model.score(distances.of(text(5))) >= 0.5 for _ in range(300)]) > 0.9
    assert np.mean([model.score(distances.of(text(0))) >= 0.5 for _ in range(300)]) < 0.1


def brute_nearest(rows, asked, k):
    ids = np.array([i for i, _ in rows])
    x = np.array([v for _, v in rows], dtype=np.float64)
    out = {}
    for q in asked:
        s = x @ x[ids == q][0]
        order = sorted((j for j in range(len(ids)) if ids[j] != q), key=lambda j: (-s[j], ids[j]))[:k]
        out[q] = [int(ids[j]) for j in order]
    return out


def test_neighbours_recall(sc):
    e = sc.read.parquet(f"{SF}/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in e.collect()]
    want = brute_nearest(rows, [i for i, _ in rows if i % 20 == 0], 20)
    got = {}
    for r in queries.q_neighbours(sc, SF).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append(r.vec_id)
    assert set(got) == set(want)
    assert np.mean([len(set(got[q]) & set(want[q])) / len(want[q]) for q in want]) > 0.9


def test_neighbours_search_ends_with_no_open_entry(sc, monkeypatch):
    monkeypatch.setattr(neighbours, "GROUP", 100)       # many small groups: the start is far from exact
    monkeypatch.setattr(neighbours, "WIDTH", 8)
    open_left, search = [], neighbours._search
    monkeypatch.setattr(neighbours, "_search", lambda *a: [beam := search(*a), open_left.append(beam.where("NOT done").count())][0])
    x = np.random.default_rng(3).normal(size=(3000, 24))
    rows = [(i, v.tolist()) for i, v in enumerate(x / np.linalg.norm(x, axis=1, keepdims=True))]
    df = sc.createDataFrame(rows, "vec_id long, embedding array<double>")
    want = brute_nearest(rows, range(0, 3000, 50), 20)
    got = {}
    for r in neighbours.nearest(df, df.where("vec_id % 50 = 0").select("vec_id").toDF("id"), k=20).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    assert open_left == [0]
    assert np.mean([len(got[q] & set(want[q])) / 20 for q in want]) > 0.95


def test_neighbours_of_very_unequal_norms(sc):
    r = np.random.default_rng(4)
    x = r.normal(size=(1200, 16)) * r.lognormal(0, 0.5, size=(1200, 1))
    x[7] *= 3000
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    df = sc.createDataFrame(rows, "vec_id long, embedding array<double>")
    asked = list(range(0, 1200, 40))
    want = brute_nearest(rows, asked, 20)
    got = {}
    for r in neighbours.nearest(df, df.where("vec_id % 40 = 0").select("vec_id").toDF("id"), k=20).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    assert np.mean([len(got[q] & set(want[q])) / 20 for q in want]) > 0.95


def test_neighbours_edges(sc):
    nan, inf = float("nan"), float("inf")
    bad = [(None, [1.0, 0.0]), (100, None), (101, []), (102, [0.0, 0.0]), (103, [nan, 1.0]), (104, [inf, 1.0]),
           (105, [None, 1.0]), (106, [1.0, 2.0, 3.0])]
    copies = [(i, [0.6, 0.8]) for i in range(40)]
    rows = copies + [(50, [1.0, 0.0]), (51, [0.0, 1.0]), (51, [0.5, 1.0]), (52, [-3.0, 4.0])]
    df = sc.createDataFrame([(i, v, 1) for i, v in rows + bad], "vec_id long, embedding array<float>, rank int")
    asked = df.select(F.col("vec_id").alias("id"))
    got = {}
    for r in neighbours.nearest(df, asked, k=20).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append(r.vec_id)
    one = [(i, [float(np.float32(x)) for x in v]) for i, v in rows if (i, v) != (51, [0.5, 1.0])]
    assert got == brute_nearest(one, sorted({i for i, _ in one}), 20)
    assert neighbours.nearest(df.limit(0), asked).count() == 0


def test_neighbours_rounds_move_blocks_not_edges(sc, monkeypatch):
    written, table = [], neighbours.Intermediates.table
    monkeypatch.setattr(neighbours.Intermediates, "table", lambda self, df: [made := table(self, df), written.append(made.count())][0])
    x = np.random.default_rng(6).normal(size=(2000, 24))
    rows = [(i, v.tolist()) for i, v in enumerate(x / np.linalg.norm(x, axis=1, keepdims=True))]
    df = sc.createDataFrame(rows, "vec_id long, embedding array<float>")
    rows = [(r.vec_id, r.embedding) for r in df.collect()]
    want = brute_nearest(rows, range(0, 2000, 100), 20)
    got = {}
    for r in neighbours.nearest(df, df.where("vec_id % 100 = 0").select("vec_id").toDF("id"), k=20).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    assert np.mean([len(got[q] & set(want[q])) / 20 for q in want]) > 0.95
    # vectors and beams are written once, a round's table is a few rows for each block
    assert sum(written) < 2 * 2000 + 20 * neighbours.BEAM + 3000


def test_neighbours_among_copies_and_ties(sc):
    vectors = [[1.0, 0.0], [0.5, 0.5], [0.5, -0.5], [0.5, 0.25], [-1.0, 0.0], [-1.0, -0.0], [0.25, 1.0]]
    rows = [(i, vectors[i * 5 % 7 if i % 3 else i % 4]) for i in range(150)] + [(1000 + i, vectors[4 + i % 2]) for i in range(30)]
    df = sc.createDataFrame(rows, "vec_id long, embedding array<float>")
    for k in (1, 7, 20, 200):
        got = {}
        for r in neighbours.nearest(df, df.select(F.col("vec_id").alias("id")), k=k).orderBy("query_id", "rank").collect():
            got.setdefault(r.query_id, []).append(r.vec_id)
        assert got == brute_nearest(rows, [i for i, _ in rows], k)


def test_sample_is_bounded(sc):
    docs = sc.createDataFrame([(i, f"t{i}") for i in range(50)], "doc_id long, text string")
    labels = sc.createDataFrame([(i, i % 2) for i in range(50)], "doc_id long, toxic int")
    got = B.labelled_sample(docs, labels, "toxic", {0: 5, 1: 7}).groupBy("label").count().collect()
    assert {r.label: r["count"] for r in got} == {0: 5, 1: 7}


def test_language_scores_by_a_plain_loop(sc):
    model = language_id.train(["der hund und die katze"] * 12 + ["the dog and the cat"] * 12 + ["le chien et le chat"] * 12,
                              ["de"] * 12 + ["en"] * 12 + ["fr"] * 12)
    texts = ["the cat", "Die KATZE ist 12 da!", "é", "a", "x y", "le chat, the dog. und " * 300, "no", "no"]
    want = []
    for text in texts:
        letters = "".join(c.lower() if c.isalpha() else " " for c in text).split()
        raw = f" {' '.join(letters)} ".encode()
        found = []
        for n in (2, 3, 4):
            for i in range(len(raw) - n + 1):
                h = n * 0x9E3779B9 % 2 ** 32
                for byte in raw[i:i + n]:
                    h = (h ^ byte) * 0x01000193 % 2 ** 32
                found.append(((h ^ h >> 15) * 0x2C1B3C6D % 2 ** 32 >> 8) % model.table.shape[1])
        logit = [(sum(float(row[h]) for h in found) / len(found) + float(b)) / model.temperature
                 for row, b in zip(model.table, model.bias, strict=True)]
        e = [np.exp(x - max(logit)) for x in logit]
        want.append((model.languages[int(np.argmax(e))], max(e) / sum(e)))
    df = sc.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: (r.lang_pred, r.score) for r in language_id.identify(df, model).collect()}
    for i, (lang, score) in enumerate(want):
        assert got[i][0] == lang and abs(got[i][1] - score) < 1e-4


def test_toxicity_scores_by_plain_window_lengths(sc):
    import zstandard
    model = toxicity.train(["nasty awful words here", "some awful text"] * 9, ["fine words here", "more of the same"] * 9)

    def size(content, raw):
        log = max(13, len(content).bit_length() + 1)
        settings = zstandard.ZstdCompressionParameters(
            compression_level=1, min_match=model.match, strategy=zstandard.STRATEGY_FAST, target_length=1, window_log=max(12, log),
            hash_log=log, chain_log=12, write_checksum=0, write_content_size=0)
        known = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        return len(zstandard.ZstdCompressor(dict_data=known, compression_params=settings).compress(raw))

    texts = [None, "", "fine nasty words", "Awful, AWFUL words 3 here " * 50, "more of the same text", "one two three four five six nasty"]
    want = []
    for text in texts:
        letters = "".join(c if c.isalpha() else " " for c in (text or "").lower()).split()
        d = []
        for i in range(0, len(letters), 6):
            raw = b"#" * 64 + f" {' '.join(letters[i:i + 6])} ".encode()
            d.append(size(model.ordinary, raw) - size(model.toxic, raw))
        d = d or [0]
        near = sum(x >= model.limit for x in d)
        parts = [min(near, 8) / 8, near / len(d), min(max(d), 24) / 24, sum(d) / len(d) / 3,
                 (sum(max(x, 0) ** 2 for x in d) / len(d)) ** 0.5 / 3]
        want.append(1 / (1 + np.exp(-(sum(p * w for p, w in zip(parts, model.weights, strict=True)) + model.bias))))
    df = sc.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: (r.score, r.predicted) for r in toxicity.score_toxicity(df, model).collect()}
    for i, score in enumerate(want):
        assert abs(got[i][0] - score) < 1e-9 and got[i][1] == (score >= 0.5)
