"""Toxicity by compression distance: two zstandard dictionaries, one per class.

Training (bounded sample, documented limits): three quarters of the labelled sample train
the dictionaries, the other quarter calibrates. A class dictionary holds the class's
telling words, those whose first ``STEM`` letters are ``ratio`` times as frequent (in
texts) as in the other class (ratio 0: its whole texts). Before them both may hold one
background, trained on whole ordinary texts: what any text shares with it then costs both
compressors alike, so parts of telling words that occur everywhere make no distance. The
calibration texts choose among ``TRIED`` by the mean of best F1 and area under the ROC
curve. A text is scored in windows of ``WINDOW`` words: each window is compressed with both
dictionaries, and its distance is the length with the ordinary dictionary less the length
with the toxic one. The window limit is the distance that at most ``STRAY`` of ordinary
calibration windows reach, and a logistic fit over the document's window statistics gives
the score; its 0.5 lies where F1 is best.

Windows are compressed without literal coding and behind a fixed run of bytes, so
their lengths differ by matches only and short windows are not stored raw.

Defined results: null, empty or wordless texts score as a text without any near
window; equal texts score alike; a training sample without one of the classes is
an error; an empty table gives an empty result. Input columns named like an
output column are replaced by it.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from settlekit.llm import blocks as B

SEGMENT, DMER = 16, 6
#: (ratio, bytes of the class's part, bytes of the background, least match) tried in training.
TRIED = ((0, 64 << 10, 0, 5), *((ratio, size, *form) for ratio in (3, 10, 30) for size in (8 << 10, 64 << 10)
                                for form in ((0, 5), (64 << 10, 7))))
STEM, WINDOW, STRAY = 4, 6, 0.002
PER_CLASS, MAX_BYTES = (1500, 4000), 20_000     # toxic, ordinary
OUTPUTS = ("score", "predicted")
_WORD = re.compile(r"[^\W\d_]+")
_LEAD = b"#" * 64
#: End of a dictionary's tables: the three start offsets 1, 4, 8 (a fixed value of the format).
_OFFSETS = b"\x01\x00\x00\x00\x04\x00\x00\x00\x08\x00\x00\x00"


def words(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def _view(some: list[str]) -> bytes:
    return f" {' '.join(some)} ".encode()


def _uses(samples: list[list[str]]) -> Counter:
    """Number of texts that use each word stem."""
    return Counter(stem for d in samples for stem in {w[:STEM] for w in d})


def class_dictionary(samples: list[list[str]], other: list[list[str]], size: int, ratio: float = 0) -> bytes:
    """Dictionary content trained on ``samples``; with ``ratio`` on their words whose stems are in at
    least so many times the share of texts as in ``other`` (where one more text counts as using each)."""
    if ratio:
        own, theirs = _uses(samples), _uses(other)
        least = ratio * len(samples) / len(other)
        samples = [[w for w in d if own[w[:STEM]] >= least * (theirs[w[:STEM]] + 1)] for d in samples]
    views = [_view(d) for d in samples if d]
    try:
        trained = zstandard.train_dictionary(size, views, k=SEGMENT, d=DMER).as_bytes()
    except zstandard.ZstdError:         # too few samples to train on: their bytes themselves
        return (b"".join(views) or _view(["-"]))[:size].ljust(8, b" ")
    at = trained.find(_OFFSETS)
    return trained[at + len(_OFFSETS):] if at >= 0 else trained


def _compressor(content: bytes, match: int) -> zstandard.ZstdCompressor:
    log = max(13, len(content).bit_length() + 1)      # the table has room for every place of the dictionary
    settings = zstandard.ZstdCompressionParameters(
        compression_level=1, min_match=match, strategy=zstandard.STRATEGY_FAST, target_length=1, window_log=max(12, log), hash_log=log,
        chain_log=12, write_checksum=0, write_content_size=0)
    return zstandard.ZstdCompressor(
        dict_data=zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT), compression_params=settings)


class Distances:
    def __init__(self, toxic: bytes, ordinary: bytes, match: int = 5):
        self.toxic, self.ordinary = _compressor(toxic, match).compress, _compressor(ordinary, match).compress

    def of(self, text: str) -> np.ndarray:
        """Distance of each window of a text."""
        all_words = words(text)
        views = [_LEAD + _view(all_words[i:i + WINDOW]) for i in range(0, len(all_words), WINDOW)]
        return np.array([len(self.ordinary(v)) - len(self.toxic(v)) for v in views] or [0], dtype=np.int64)


@dataclass
class ToxicityModel:
    toxic: bytes
    ordinary: bytes
    match: int
    limit: float
    weights: np.ndarray
    bias: float

    def distances(self) -> Distances:
        return Distances(self.toxic, self.ordinary, self.match)

    def statistics(self, d: np.ndarray) -> np.ndarray:
        near = d >= self.limit
        return np.array([min(near.sum(), 8) / 8, near.mean(), min(d.max(), 24) / 24, d.mean() / 3,
                         np.sqrt((np.maximum(d, 0.0) ** 2).mean()) / 3])

    def score(self, d: np.ndarray) -> float:
        z = float(self.statistics(d) @ self.weights + self.bias)
        return float(1 / (1 + np.exp(-np.clip(z, -60, 60))))


def _logistic(x: np.ndarray, y: np.ndarray, steps: int = 60, ridge: float = 1e-2) -> tuple[np.ndarray, float]:
    """Newton's method with a ridge, classes weighted alike."""
    a = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(a.shape[1])
    c = np.where(y == 1, 0.5 / max(1, (y == 1).sum()), 0.5 / max(1, (y == 0).sum())) * len(y)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        g = a.T @ (c * (p - y)) + ridge * w
        h = (a * (c * p * (1 - p))[:, None]).T @ a + ridge * np.eye(len(w))
        w -= np.linalg.solve(h, g)
    return w[:-1], float(w[-1])


def train(toxic_texts: list[str], ordinary_texts: list[str]) -> ToxicityModel:
    if not toxic_texts or not ordinary_texts:
        raise ValueError("both classes are needed to learn from")
    t, o = [words(x) for x in sorted(toxic_texts)], [words(x) for x in sorted(ordinary_texts)]
    (fit_t, test_t), (fit_o, test_o) = _parted(t), _parted(o)
    backgrounds = {n: class_dictionary(fit_o, fit_t, n) if n else b"" for *_, n, _ in TRIED}
    parts, seen, best = {}, set(), None
    for ratio, size, background, match in TRIED:
        if (ratio, size) not in parts:
            parts[ratio, size] = class_dictionary(fit_t, fit_o, size, ratio), class_dictionary(fit_o, fit_t, size, ratio)
        form = *(backgrounds[background] + part for part in parts[ratio, size]), match
        if form not in seen:        # a larger limit need not give a larger dictionary
            seen.add(form)
            found = _calibrated(*form, test_t, test_o)
            best = found if best is None or found[0] > best[0] else best
    return best[1]


def _parted(texts: list[list[str]]) -> tuple[list[list[str]], list[list[str]]]:
    """(texts that train the dictionaries, every fourth that calibrates; a few texts do both)."""
    return ([x for i, x in enumerate(texts) if i % 4], texts[::4]) if len(texts) > 3 else (texts, texts)


def _auc(score: np.ndarray, y: np.ndarray) -> float:
    """Share of pairs of a toxic and an ordinary text in which the toxic one scores higher (ties: half)."""
    other = np.sort(score[y == 0])
    below = np.searchsorted(other, score[y == 1]) + np.searchsorted(other, score[y == 1], side="right")
    return float(below.mean() / 2 / len(other))


def _calibrated(toxic: bytes, ordinary: bytes, match: int, t: list[list[str]], o: list[list[str]]) -> tuple[float, ToxicityModel]:
    """(mean of F1 and area under the ROC curve of the calibration texts, model) for two dictionaries."""
    model = ToxicityModel(toxic, ordinary, match, 1.0, np.zeros(5), 0.0)
    distances = model.distances()
    d_t = [distances.of(" ".join(d)) for d in t]
    d_o = [distances.of(" ".join(d)) for d in o]
    flat = np.sort(np.concatenate(d_o))
    model.limit = float(max(1, flat[min(len(flat) - 1, int(len(flat) * (1 - STRAY)))] + 1))
    x = np.array([model.statistics(d) for d in d_t + d_o])
    y = np.array([1] * len(d_t) + [0] * len(d_o))
    model.weights, model.bias = _logistic(x, y)
    z = x @ model.weights + model.bias
    f1, best = max((2 * ((z >= c) & (y == 1)).sum() / ((z >= c).sum() + y.sum()), c) for c in np.unique(z))
    below = z[z < best]
    model.bias -= float(best + (below.max() if len(below) else best - 1)) / 2
    return (float(f1) + _auc(z, y)) / 2, model


def _spread(batches: Iterator[pa.RecordBatch], max_bytes: int) -> Iterator[pa.RecordBatch]:
    """Texts over ``max_bytes`` as every n-th of their windows, so that about ``max_bytes`` remain."""
    for batch in batches:
        texts = []
        for t in batch.column(1).to_pylist():
            n = -(-len(t.encode()) // max_bytes)
            if n > 1:
                w = words(t)
                t = " ".join(" ".join(w[i:i + WINDOW]) for i in range(0, len(w), n * WINDOW))
            texts.append(t)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["label", "text"])


def fit_toxicity_model(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       label_col: str = "toxic", per_class: tuple[int, int] = PER_CLASS, max_bytes: int = MAX_BYTES) -> ToxicityModel:
    """Trains on the documents of at most ``per_class`` labels of each class. Those over ``max_bytes``
    come in only where shorter ones are too few, as windows spread evenly over the whole text."""
    rows = B.labelled_sample(docs, labels, label_col, {1: per_class[0], 0: per_class[1]}, id_col, text_col, max_bytes).select(
        "label", "text").mapInArrow(lambda it: _spread(it, max_bytes), "label int, text string").collect()
    return train([r[1] for r in rows if r[0] == 1], [r[1] for r in rows if r[0] == 0])


def score_toxicity(docs: DataFrame, model: ToxicityModel, text_col: str = "text") -> DataFrame:
    """``docs`` without its text, with ``score`` and ``predicted`` (score >= 0.5)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)    # two dictionaries of at most 128 KB (TRIED)
    rest = [c for c in docs.columns if c != text_col and c not in OUTPUTS]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        distances = m.distances()
        for batch in batches:
            scores = np.array([m.score(distances.of(t.as_py() or "")) for t in batch.column(0)], dtype=np.float64)
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(scores), pa.array((scores >= 0.5).astype(np.int32))],
                                             names=[*rest, *OUTPUTS])

    schema = ", ".join([*(f"`{c}` {t}" for c, t in docs.select(rest).dtypes), "score double, predicted int"])
    return docs.select(F.col(text_col).cast("string"), *rest).mapInArrow(run, schema)
