"""The pipeline's stages over small tables with planted cases."""

import corpus_pipeline as P


def test_stages(sc, tmp_path):
    en = "the dog and the cat went home with a fine hat and sat by the old fire"
    de = "der hund und die katze gehen mit dem alten hut nach haus und sitzen am feuer"
    item = "what is the largest planet that circles the sun in our known solar system today"
    passage = " ".join(f"shared{i}" for i in range(60))
    rows = []
    for i in range(40):
        words = (en if i % 2 else de).split()
        text = " ".join(words[(i * k) % len(words)] + ("" if k % 3 else str(i)) for k in range(1, 40))
        rows.append((i, text, "en" if i % 2 else "de"))
    rows += [(100, rows[0][1], "de"), (101, f"{rows[1][1]} {item}", "en"), (102, None, None), (103, "?!", None),
             (104, f"{en} first {passage}", "en"), (105, f"{de} zweites {passage}", "de")]
    sf = str(tmp_path)
    sc.createDataFrame([(i, t, x, "s", len(t or "")) for i, t, x in rows],
                       "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{sf}/documents.parquet")
    sc.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{sf}/benchmark.parquet")
    docs = sc.read.parquet(f"{sf}/documents.parquet")
    columns, kept = docs.columns, {}
    for name, stage in P.STAGES:
        docs = stage(sc, docs, sf)
        docs.write.parquet(f"{sf}/{name}")
        docs = sc.read.parquet(f"{sf}/{name}")
        kept[name] = {r.doc_id: r for r in docs.collect()}
        if name != "sentencepiece":
            assert docs.columns == columns
    assert {102, 103} & set(kept["language_id"]) == set() and len(kept["language_id"]) >= 40
    assert 100 not in kept["near_dedup"] and 0 in kept["near_dedup"]
    assert passage in kept["suffix_dedup"][104].text and "shared30" not in kept["suffix_dedup"][105].text
    assert kept["suffix_dedup"][105].n_chars == len(kept["suffix_dedup"][105].text)
    assert 101 not in kept["decontamination"] and 104 in kept["decontamination"]
    assert set(kept["sentencepiece"]) == set(kept["decontamination"])
    assert all(r.n_tokens == len(r.ids) > 0 for r in kept["sentencepiece"].values())
    assert {r.doc_id for r in P.run(sc, sf).collect()} == set(kept["sentencepiece"])


def test_last_stage_decodes(sc):
    docs = sc.createDataFrame([(1, "a text  with \n spaces"), (2, "")], "doc_id long, text string")
    assert [r.round_trip for r in P.token_ids(sc, docs, "").collect()] == [True, True]


def test_columns_of_any_name_come_through(sc, tmp_path):
    """Input columns named like what the operators make are kept as they were."""
    sf = str(tmp_path)
    sc.createDataFrame([(1, "an item of the test")], "item_id long, text string").write.parquet(f"{sf}/benchmark.parquet")
    extra = ["score", "accepted", "lang_pred", "n_removed", "n_bytes", "kept_text", "__x", "component_id", "n_words", "id"]
    rows = [(i, f"the dog and the cat number {i} went home with hat {i * 7} and sat by fire {i * 3}", "en", 1, *[f"{c}-{i}" for c in extra])
            for i in range(30)]
    schema = "doc_id long, text string, lang string, n_chars long, " + ", ".join(f"`{c}` string" for c in extra)
    docs = sc.createDataFrame(rows, schema)
    for name, stage in P.STAGES[:-1]:
        docs = stage(sc, docs, sf)
        docs.write.parquet(f"{sf}/{name}")
        docs = sc.read.parquet(f"{sf}/{name}")
        assert docs.columns[:4] == ["doc_id", "text", "lang", "n_chars"] and docs.columns[4:] == extra, name
        for r in docs.collect():
            assert all(r[c] == f"{c}-{r.doc_id}" for c in extra), name
