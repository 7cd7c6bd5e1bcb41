"""Language identification: averaged hashed subword embeddings with a linear softmax.

A text's features are the hashed character n-grams of its lower-cased words
(with word marks). The model is the mean of their embeddings times a linear
layer, trained with stochastic gradient descent in numpy on a bounded sample
(``per_language`` texts, the least by a hash of the id; first those of at most
``max_bytes``, then longer ones, whose n-grams are counted over the whole text in
Spark, so the driver gets one number per bucket at most). A tenth of the sample is held back for calibration: a temperature for the
probabilities, and the rejection limit.

Prediction folds embeddings and layer into one table of scores per n-gram bucket,
so a whole text costs one look-up per n-gram.

Rejection: a text without letters is ``und``; otherwise a text is rejected when
its calibrated probability is below the limit. The limit is the ``alpha``
quantile of the probabilities of correctly predicted calibration texts, and at
most 0.5, so that a text with a majority language stays.

Defined results: null, empty or letterless texts are ``und`` with score 0 and not
accepted; repeated rows and ties are predicted alike (an exact tie takes the
first language by name); no labelled rows is an error; an empty table to predict
gives an empty result. Input columns named like an output column are replaced.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from settlekit.llm import blocks as B

BUCKETS, WIDTH = 1 << 15, 16
GRAMS = (2, 3, 4)               # bytes
PER_LANGUAGE, MAX_LANGUAGES, MAX_BYTES = 600, 256, 10_000
UNDETERMINED = "und"
OUTPUTS = ("lang_pred", "score", "accepted")


_WORD = re.compile(r"[^\W\d_]+")


def _normalised(text: str) -> bytes:
    """The lower-cased words of letters between single spaces; empty without a letter."""
    words = " ".join(_WORD.findall(text.lower()))
    return f" {words} ".encode() if any(c.isalpha() for c in words) else b""


def gram_parts(texts: list[str], buckets: int):
    """For each n-gram size: (bucket at every byte position, the positions that
    start no n-gram of their own text, first position and number of n-grams by text)."""
    raw = [_normalised(t) for t in texts]
    data = np.frombuffer(b"".join(raw), dtype=np.uint8)
    size = np.array([len(b) for b in raw], dtype=np.int64)
    end = np.cumsum(size)
    x = np.append(data, np.zeros(max(GRAMS), np.uint8)).astype(np.uint32)
    for n in GRAMS:
        h = np.full(len(data), n * 0x9E3779B9 % (1 << 32), np.uint32)
        for d in range(n):
            h = (h ^ x[d:d + len(h)]) * np.uint32(0x01000193)
        h = ((h ^ (h >> np.uint32(15))) * np.uint32(0x2C1B3C6D)) >> np.uint32(8)
        out = (end[:, None] - np.arange(1, n)).ravel()
        yield h & np.uint32(buckets - 1), out[out >= 0], end - size, np.maximum(size - n + 1, 0)


def _features(text: str, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """(buckets that occur, share of the text's n-grams in each)."""
    count = np.zeros(buckets, np.int64)
    for h, out, _, _ in gram_parts([text], buckets):
        count += np.bincount(np.delete(h, out), minlength=buckets)
    used = np.flatnonzero(count)
    return used.astype(np.int32), (count[used] / max(1, count.sum())).astype(np.float32)


@dataclass
class LanguageModel:
    languages: list[str]
    table: np.ndarray           # score per language and bucket
    bias: np.ndarray
    temperature: float
    limit: float

    def probabilities(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(probabilities by text and language, number of n-grams by text)."""
        sums, n = np.zeros((len(texts), len(self.languages))), np.zeros(len(texts), np.int64)
        for h, out, first, count in gram_parts(texts, self.table.shape[1]):
            some = np.flatnonzero(count)
            if len(some):
                for c, table in enumerate(self.table):
                    scores = table.take(h)
                    scores[out] = 0
                    sums[some, c] += np.add.reduceat(scores, first[some])
            n += count
        return self.softmax(sums / np.maximum(n, 1)[:, None] + self.bias), n

    def softmax(self, logits: np.ndarray) -> np.ndarray:
        logits = logits / self.temperature
        e = np.exp(logits - logits.max(axis=1, keepdims=True))
        return e / e.sum(axis=1, keepdims=True)


def train(texts: list[str], labels: list[str], buckets: int = BUCKETS, width: int = WIDTH, epochs: int = 6,
          batch: int = 64, rate: float = 16.0, alpha: float = 0.001, seed: int = 5,
          counted: Sequence[tuple[str, np.ndarray, np.ndarray]] = ()) -> LanguageModel:
    """Fits the model on texts with labels (in any order; the result does not depend on it),
    and on ``counted`` texts: (label, buckets, shares) as from ``_features``."""
    order = sorted(range(len(texts)), key=lambda i: (labels[i], texts[i]))
    texts, labels = [texts[i] for i in order], [labels[i] for i in order]
    counted = sorted(counted, key=lambda c: (c[0], c[1].tobytes(), c[2].tobytes()))
    languages = sorted({*labels, *(c[0] for c in counted)})
    y = np.array([languages.index(x) for x in [*labels, *(c[0] for c in counted)]])
    features = [_features(t, buckets) for t in texts] + [(used, share) for _, used, share in counted]
    rng = np.random.default_rng(seed)
    known = np.array([i for i, f in enumerate(features) if len(f[0])], dtype=np.int64)
    shuffled = rng.permutation(known)
    n_cal = len(shuffled) // 10
    cal, fit = shuffled[:n_cal], shuffled[n_cal:]
    embed = rng.normal(0, 1 / np.sqrt(width), (buckets, width)).astype(np.float32)
    layer = np.zeros((width, len(languages)), np.float32)
    bias = np.zeros(len(languages), np.float32)
    steps = max(1, epochs * -(-len(fit) // batch))
    step = 0
    for _ in range(epochs):
        fit = rng.permutation(fit)
        for lo in range(0, len(fit), batch):
            rows = fit[lo:lo + batch]
            share = np.zeros((len(rows), buckets), np.float32)
            for k, i in enumerate(rows.tolist()):
                share[k, features[i][0]] = features[i][1]
            hidden = share @ embed
            logits = hidden @ layer + bias
            p = np.exp(logits - logits.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            p[np.arange(len(rows)), y[rows]] -= 1
            g = p * (rate * (1 - step / steps) / len(rows))
            back = share.T @ (g @ layer.T)
            layer -= hidden.T @ g
            bias -= g.sum(axis=0)
            embed -= back
            step += 1
    model = LanguageModel(languages, np.ascontiguousarray((embed @ layer).T, dtype=np.float64), bias.astype(np.float64), 1.0, 0.0)
    if len(cal):
        is_text = cal < len(texts)
        p = np.zeros((len(cal), len(languages)))
        p[is_text] = model.probabilities([texts[i] for i in cal[is_text]])[0]
        for k in np.flatnonzero(~is_text):
            used, share = features[cal[k]]
            p[k] = model.softmax((model.table[:, used] @ share + model.bias)[None, :])[0]
        logits = np.log(np.maximum(p, 1e-300))
        best = None
        for t in np.geomspace(0.1, 10, 41):
            model.temperature = float(t)
            p = model.softmax(logits)
            loss = -np.log(np.maximum(p[np.arange(len(cal)), y[cal]], 1e-12)).mean()
            if best is None or loss < best[0]:
                best = (loss, float(t), p)
        model.temperature = best[1]
        right = best[2].argmax(axis=1) == y[cal]
        if right.any():
            model.limit = float(min(0.5, np.quantile(best[2].max(axis=1)[right], alpha)))
    return model


def _counted(batches: Iterator[pa.RecordBatch], buckets: int) -> Iterator[pa.RecordBatch]:
    """Long texts as the counts of their n-grams, others as they are."""
    for batch in batches:
        for k in range(batch.num_rows):
            lang, text, long = (c[k].as_py() for c in batch.columns)
            used, share = (x.tobytes() for x in _features(text, buckets)) if long else (None, None)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang], pa.string()), pa.array([None if long else text], pa.string()),
                 pa.array([used], pa.binary()), pa.array([share], pa.binary())], names=["lang", "text", "used", "share"])


def fit_language_model(labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                       per_language: int = PER_LANGUAGE, max_languages: int = MAX_LANGUAGES,
                       max_bytes: int = MAX_BYTES, **options) -> LanguageModel:
    """Trains on at most ``per_language`` texts of each of the ``max_languages`` most
    frequent languages, those over ``max_bytes`` only where shorter ones are too few
    (so at most per_language * max_languages ids are broadcast, and as many texts of
    ``max_bytes`` or bucket counts reach the driver)."""
    rows = labelled.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull() & F.col(id_col).isNotNull()).select(
        F.col(lang_col).cast("string").alias("lang"), F.col(id_col).alias("id"),
        (F.octet_length(F.col(text_col).cast("string")) > max_bytes).alias("long"))
    frequent = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("count"), F.count_if("long").alias("n_long")).orderBy(
        F.desc("count"), "lang").limit(max_languages).collect()
    # a hash threshold keeps about twice the wanted ids of each language before they meet in one task
    def share_of(wanted, n):
        return min(1 << 20, int((2 * wanted + 100) / n * (1 << 20)) + 1)

    share = []
    for lang, n, n_long in frequent:
        n_short = n - n_long
        if n_short:
            share.append((lang, False, share_of(per_language, n_short)))
        if n_short < per_language:
            share.append((lang, True, share_of(per_language - n_short, n_long or 1)))
    shares = labelled.sparkSession.createDataFrame(share, "lang string, long boolean, share int")
    key = F.xxhash64(F.col("id").cast("string"))
    near = rows.join(F.broadcast(shares), ["lang", "long"]).withColumn("key", key).where(F.pmod("key", F.lit(1 << 20)) < F.col("share"))
    per = Window.partitionBy("lang").orderBy("long", "key", "id")
    ids = near.withColumn("rank", F.row_number().over(per)).where(F.col("rank") <= per_language)
    texts = labelled.select(F.col(id_col).alias("id"), F.col(lang_col).cast("string").alias("lang"),
                            F.col(text_col).cast("string").alias("text")).where("text IS NOT NULL").withColumn(
                                "long", F.octet_length("text") > max_bytes)
    picked = texts.join(F.broadcast(ids.select("id", "lang", "long")), ["id", "lang", "long"])
    buckets = options.get("buckets", BUCKETS)
    chosen = picked.select("lang", "text", "long").mapInArrow(
        lambda it: _counted(it, buckets), "lang string, text string, used binary, share binary").collect()
    if not chosen:
        raise ValueError("no labelled text to learn from")
    short = [r for r in chosen if r.text is not None]
    counted = [(r.lang, np.frombuffer(r.used, np.int32), np.frombuffer(r.share, np.float32)) for r in chosen if r.text is None]
    return train([r.text for r in short], [r.lang for r in short], counted=counted, **options)


def identify(docs: DataFrame, model: LanguageModel, text_col: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred``, ``score`` (calibrated probability) and ``accepted``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)    # BUCKETS x languages numbers
    rest = [c for c in docs.columns if c not in OUTPUTS]
    column = rest.index(text_col)

    @B.tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        B.hold("language_id")
        m = shared.value
        for batch in batches:
            names, scores, kept = [], [], []
            for _lo, _hi, data, offsets in B.pieces(batch.column(column), 256 << 10):
                raw = data.tobytes()
                p, n = m.probabilities([raw[a:b].decode() for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)])
                top = p.argmax(axis=1)
                score = np.where(n > 0, p.max(axis=1), 0.0)
                names += [m.languages[t] if k else UNDETERMINED for t, k in zip(top.tolist(), n.tolist(), strict=True)]
                scores.append(score)
                kept.append((n > 0) & (score >= m.limit))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(names, pa.string()), pa.array(np.concatenate(scores) if scores else np.zeros(0)),
                 pa.array(np.concatenate(kept) if kept else np.zeros(0, bool))], names=[*rest, *OUTPUTS])

    schema = ", ".join([*(f"`{c}` {t}" for c, t in docs.select(rest).dtypes), "lang_pred string, score double, accepted boolean"])
    return docs.select(rest).mapInArrow(run, schema)
