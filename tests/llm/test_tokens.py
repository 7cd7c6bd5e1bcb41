"""Token counts and SentencePiece ids against the library."""

import random

import public_tokenizers
import pytest
import sentencepiece

from settlekit.llm.piece_model import PieceModel
from settlekit.llm.pieces import Decoder, Encoder, decode, encode
from settlekit.llm.token_counts import PrefixCounts, count_tokens

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def raw():
    with open(PATH, "rb") as f:
        return f.read()


def some_texts(n, seed=1):
    r = random.Random(seed)
    parts = [" ", "  ", "     ", "\n", "\t", "▁", "e", "th", "in", "the", " and", "é", "日", "\x00", "ß", "1", "<s>", "<0x41>",
             "😀", " a", ".", "!!", "T", "Worth", "\r\n"]
    return ["".join(r.choice(parts) for _ in range(r.randint(0, 14))) for _ in range(n)]


def test_prefix_counts(raw):
    lib, counts = sentencepiece.SentencePieceProcessor(model_proto=raw), PrefixCounts(PieceModel.parse(raw))
    for k, t in enumerate(some_texts(1500)):
        assert counts.count(t) == len(lib.encode(t))
        if k % 10 == 0:
            every = [len(lib.encode(t[:i])) for i in range(len(t) + 1)]
            assert counts.table(t) == every
            for budget in (0, 1, 3, 8):
                assert counts.fitting(t, budget) == max(i for i, x in enumerate(every) if x <= budget)


def test_bpe_ids_and_round_trip(raw):
    lib, model = sentencepiece.SentencePieceProcessor(model_proto=raw), PieceModel.parse(raw)
    encoder, decoder = Encoder(model), Decoder(model)
    texts = some_texts(1500, 2)
    ids, cuts = encoder.encode_all(texts)
    assert [ids[a:b].tolist() for a, b in zip(cuts[:-1], cuts[1:], strict=True)] == lib.encode(texts)
    assert decoder.decode_all(ids, cuts) == [t.replace("▁", " ") for t in texts]


def best_score(model, text):
    """The best sum of piece scores, by trying every split."""
    text = ("▁" + text.replace(" ", "▁")) if text else ""
    low = min(s for s, k in zip(model.scores, model.kinds, strict=True) if k == 1) - 10
    best = [0.0] + [float("-inf")] * len(text)
    for end in range(1, len(text) + 1):
        for start in range(max(0, end - 20), end):
            i = model.ids.get(text[start:end])
            score = model.scores[i] if i is not None else low if end - start == 1 else float("-inf")
            best[end] = max(best[end], best[start] + score)
    return best[-1]


def test_unigram_scores(raw):
    """The same pieces as a unigram model: paths with the best score, nearly always the library's
    (which adds in single precision)."""
    at = raw.rindex(b"\x18\x02 \x80\xfa\x01")        # model type 2, vocabulary size 32,000
    patched = raw[:at + 1] + b"\x01" + raw[at + 2:]
    lib, model = sentencepiece.SentencePieceProcessor(model_proto=patched), PieceModel.parse(patched)
    assert model.model_type == 1
    encoder, same = Encoder(model), []
    for t in [x for x in some_texts(1500, 3) if "  " not in x and all(c == " " or c in model.ids for c in x)]:
        ours, theirs = encoder.encode(t), lib.encode(t)
        score = sum(model.scores[i] for i in ours)
        assert score == best_score(model, t) and score >= sum(model.scores[i] for i in theirs)
        assert Decoder(model).decode_all(*_one(ours)) == [t.replace("▁", " ")]
        same.append(ours == theirs)
    assert sum(same) > 0.8 * len(same)


def _one(ids):
    import numpy as np
    return np.array(ids, dtype=np.int64), np.array([0, len(ids)])


def test_frames(sc, raw):
    lib, model = sentencepiece.SentencePieceProcessor(model_proto=raw), PieceModel.read(PATH)
    texts = [None, "", *some_texts(40, 4), "word " * 3000]
    df = sc.createDataFrame([(i, t, "z") for i, t in enumerate(texts)], "doc_id long, text string, ids string")
    counted = {r.doc_id: r for r in count_tokens(df, model, limit=100).collect()}
    coded = {r.doc_id: r for r in encode(df.drop("ids"), model, check=True).collect()}
    back = {r.doc_id: r.text for r in decode(encode(df, model), model).collect()}
    for i, t in enumerate(texts):
        want = lib.encode(t or "")
        assert (counted[i].n_tokens, counted[i].over_limit) == (len(want), len(want) > 100)
        assert counted[i].n_bytes == len((t or "").encode()) and counted[i].ids == "z"
        assert coded[i].ids == want and coded[i].round_trip
        assert back[i] == (t or "").replace("▁", " ")
    assert count_tokens(df.limit(0), model).count() == 0 and encode(df.limit(0), model).count() == 0


def test_runs_of_spaces(raw):
    """Runs of spaces of any length, alone and before words, as the library has them."""
    lib, model = sentencepiece.SentencePieceProcessor(model_proto=raw), PieceModel.parse(raw)
    counts, encoder = PrefixCounts(model), Encoder(model)
    runs = [" " * n for n in (*range(1, 70), 333, 1000, 5000)]
    texts = [r + w for r in runs for w in ("", "the", "the end", "é", "\n", "日本", "<", "▁x", "zzzzqqq")]
    texts += ["a" + t + "  b" for t in texts]
    assert [counts.count(t) for t in texts] == [len(x) for x in lib.encode(texts)]
    ids, cuts = encoder.encode_all(texts)
    assert [ids[a:b].tolist() for a, b in zip(cuts[:-1], cuts[1:], strict=True)] == lib.encode(texts)


def test_a_million_spaces(raw):
    import time
    model = PieceModel.parse(raw)
    text = "x" + " " * 1_000_000 + "y"
    start = time.time()
    counts, encoder = PrefixCounts(model), Encoder(model)
    n = counts.count(text)
    assert n == len(encoder.encode(text)) == 1_000_000 // 16 + n - 1_000_000 // 16 and counts.fitting(text, 10) > 100
    assert time.time() - start < 60


def test_remembered_chunks_are_bounded_and_released(raw):
    from settlekit.llm import blocks, pieces
    model = PieceModel.parse(raw)
    encoder, _ = pieces._coders(model)
    want = encoder.encode("some words here")
    encoder.held = pieces.REMEMBERED_BYTES
    assert encoder.encode("some words here") == want and encoder.held < pieces.REMEMBERED_BYTES
    blocks.hold("another operator")
    assert not pieces._kept and not model._pairs and "automaton" not in model.__dict__
    assert pieces._coders(model)[0].encode("some words here") == want


def test_chunks_used_again_outlive_the_bound(raw, monkeypatch):
    """At the bound only what was seen once is forgotten; the ids stay those of the library."""
    from settlekit.llm import pieces
    monkeypatch.setattr(pieces, "REMEMBERED_BYTES", 20_000)
    lib, encoder = sentencepiece.SentencePieceProcessor(model_proto=raw), Encoder(PieceModel.parse(raw))
    r, encoded = random.Random(6), []
    plain = encoder.encode_chunk
    encoder.encode_chunk = lambda chunk: encoded.append(chunk) or plain(chunk)
    for k in range(30):
        texts = [f"the house  and\n the house  and {r.randint(0, 10**9)} zq{r.randint(0, 10**9)}日é" for _ in range(20)]
        ids, cuts = encoder.encode_all(texts)
        assert [ids[a:b].tolist() for a, b in zip(cuts[:-1], cuts[1:], strict=True)] == lib.encode(texts)
    assert len(encoded) > 1000 and sum(c == "▁house" for c in encoded) == 1
    assert encoder.held < 2 * 20_000 and len(encoder.codes) == len(encoder.first) - 1 == len(encoder.uses)


def test_encoder_covers_unknown_characters_as_the_merges_do(raw):
    """Random strings, among them characters no piece covers: the merged parts, by definition."""
    model = PieceModel.parse(raw)
    encoder, r = Encoder(model), random.Random(8)
    for _ in range(2000):
        chunk = "▁" * r.randint(0, 1) + "".join(r.choice("abcdeinorst.%&日é😀\x00") for _ in range(r.randint(1, 12)))
        assert encoder.encode_chunk(chunk) == encoder._ids(model.merged(chunk))


def test_a_released_encoder_is_gone_at_once(raw):
    """Not only when Python happens to collect cycles: the next stage needs the memory."""
    import gc
    import weakref
    from settlekit.llm import blocks, pieces
    gc.disable()
    try:
        coders = pieces._coders(PieceModel.parse(raw))
        coders[0].encode("some words here")
        encoder, codes = weakref.ref(coders[0]), weakref.ref(coders[0].codes)
        del coders
        blocks.hold("another operator")
        assert encoder() is None and codes() is None
    finally:
        gc.enable()
