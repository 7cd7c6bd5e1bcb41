"""SentencePiece encoding and decoding.

An Aho-Corasick automaton over the pieces reads a chunk once. At each position
its output links list the pieces that end there, longest first, and each relaxes
the best path to that position (Viterbi):

- unigram models: the path's score is the sum of its pieces' scores;
- BPE models: a path scores 0, and minus infinity once two neighbouring pieces
  would have been merged differently. Exactly one path to each position keeps 0,
  and it is the encoding that the merges give.

Equal scores keep the earlier start (the longer piece). Characters no piece
covers become byte pieces (or the unknown piece, if the model has none).

Defined results: null or empty text has no ids; ids decode to the text again,
but for the space mark itself, which reads as a space, and unknown pieces, which
read as " ⁇ "; an empty table gives an empty result. Input columns named like an
output column are replaced by it.
"""

from __future__ import annotations

import weakref
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from settlekit.llm import blocks as B
from settlekit.llm.piece_model import BPE, CONTROL, NORMAL, SPACE, PieceModel
from settlekit.llm.token_counts import CHUNK

REMEMBERED_BYTES = 32 << 20     # of remembered chunks per worker, about
_ENTRY_BYTES = 180              # of a remembered chunk besides its characters and ids
UNKNOWN_PENALTY = 10.0


class _Codes(dict):
    """Chunk to its code; a new chunk is encoded when it is looked up. Holds its encoder
    weakly, so that both go as soon as the encoder is let go."""

    def __init__(self, encoder: Encoder):
        self.encoder = weakref.proxy(encoder)

    def __missing__(self, chunk: str) -> int:
        known = self[chunk] = self.encoder.take(chunk)
        return known


class Encoder:
    def __init__(self, model: PieceModel):
        self.model = model
        low = min(s for s, k in zip(model.scores, model.kinds, strict=True) if k == NORMAL)
        self.unknown_score = low - UNKNOWN_PENALTY
        self._reset()

    def _reset(self):
        self.codes = _Codes(self)
        self.flat, self.first = array("i"), array("q", [0])     # ids of the chunks seen, and where each starts
        self.uses = np.zeros(0, np.int64)       # of each remembered chunk
        self.held = 0

    def _forget_rare(self):
        """Keeps what was used again, the most used up to half the bound; the rest, mostly
        chunks seen once, goes."""
        first, flat, chunks = np.array(self.first), np.array(self.flat, np.int32), list(self.codes)
        held = _ENTRY_BYTES + 4 * (np.fromiter(map(len, chunks), np.int64, len(chunks)) + np.diff(first))
        order = np.argsort(-self.uses, kind="stable")
        order = order[(self.uses[order] > 1) & (np.cumsum(held[order]) <= REMEMBERED_BYTES // 2)]
        length = np.diff(first)[order]
        self._reset()
        self.codes.update((chunks[i], k) for k, i in enumerate(order.tolist()))
        self.flat.frombytes(flat[B.ranges(first[order], length)].tobytes())
        self.first.extend(np.cumsum(length).tolist())
        self.uses = np.zeros(len(order), np.int64)
        self.held = int(held[order].sum())

    def encode_chunk(self, chunk: str) -> list[int]:
        """Best path over one chunk (written with the space mark)."""
        if self.model.model_type != BPE:
            return self._best_path(chunk)
        if chunk[:2] == SPACE * 2:      # equal scores: merged by position, as it stands
            return self._spaced(chunk)
        return self._kept_path(chunk)

    def _kept_path(self, chunk: str) -> list[int]:
        """BPE: the one path of score 0. A position has its last piece, -1 for a character that
        no piece covers, or None as long as no path of it was asked for."""
        model, n = self.model, len(chunk)
        known, compatible, width = model._pairs.get, model.compatible, len(model.pieces)
        last: list[int | None] = [None] * (n + 1)
        last[0] = -1
        for end, (piece, length) in model.automaton.iter(chunk):
            end += 1
            if last[end] is None:
                start = end - length
                before = last[start]
                if before is None:
                    before = self._uncovered(last, start)
                kept = known(before * width + piece)
                if kept is None:
                    kept = compatible(before, piece)
                if kept:
                    last[end] = piece
        if last[n] is None:
            self._uncovered(last, n)
        flat: list[int] = []
        lengths, at = model.lengths, n
        while at:
            piece = last[at]
            if piece >= 0:
                flat.append(piece)
                at -= lengths[piece]
            else:
                at -= 1
                ids = model.unknown(chunk[at])
                if model.byte_fallback or flat[-1:] != ids:     # neighbouring unknowns form one piece
                    flat += reversed(ids)
        flat.reverse()
        return flat

    @staticmethod
    def _uncovered(last: list[int | None], upto: int) -> int:
        """Marks the positions up to ``upto`` that no piece reached."""
        while last[upto] is None:
            last[upto] = -1
            upto -= 1
        return -1

    def _best_path(self, chunk: str) -> list[int]:
        """Unigram: the path with the best sum of scores."""
        model, n = self.model, len(chunk)
        scores = model.scores
        best: list[float | None] = [None] * (n + 1)
        back: list[tuple[int, int]] = [(0, -1)] * (n + 1)
        best[0] = 0.0
        ready = 0

        def settle(upto):
            """Positions that no piece reached, and a one-character step where no
            one-character piece exists."""
            nonlocal ready
            for i in range(ready + 1, upto + 1):
                step = best[i - 1] + self.unknown_score
                if best[i] is None or (chunk[i - 1] not in model.ids and step > best[i]):
                    best[i], back[i] = step, (i - 1, -1)
            ready = max(ready, upto)

        for end, (piece, length) in model.automaton.iter(chunk):
            start, end = end + 1 - length, end + 1
            if ready < end - 1:
                settle(end - 1)
            score = best[start] + scores[piece]
            if best[end] is None or score > best[end]:
                best[end], back[end] = score, (start, piece)
        settle(n)
        out, at = [], n
        while at:
            start, piece = back[at]
            out.append([piece] if piece >= 0 else model.unknown(chunk[start:at])[::1])
            at = start
        flat: list[int] = []
        for ids in reversed(out):
            if not model.byte_fallback and ids == [model.unk_id] and flat[-1:] == ids:
                continue                        # neighbouring unknowns form one piece
            flat += ids
        return flat

    def _spaced(self, chunk: str) -> list[int]:
        """Ids of two and more spaces and what follows them: it takes the last space, if a
        piece holds both, and the other spaces are a run of their own."""
        run = len(chunk) - len(chunk.lstrip(SPACE))
        if run == len(chunk):
            return self._ids(self.model.space_run(run))
        joined = self.encode_chunk(chunk[run - 1:])
        if joined[0] in self.model.byte_ids or len(self.model.pieces[joined[0]]) < 2:
            return self._ids(self.model.space_run(run)) + self.encode_chunk(chunk[run:])
        return self._ids(self.model.space_run(run - 1)) + joined

    def _ids(self, parts: list[str]) -> list[int]:
        return [i for p in parts for i in ([self.model.ids[p]] if p in self.model.ids else self.model.unknown(p))]

    def take(self, chunk: str) -> int:
        """The code of a chunk seen for the first time."""
        ids = self.encode_chunk(chunk.replace(" ", SPACE))
        self.flat.extend(ids)
        self.first.append(len(self.flat))
        self.held += _ENTRY_BYTES + 4 * (len(chunk) + len(ids))
        return len(self.first) - 2

    def encode_all(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, offsets of each)."""
        if self.held >= REMEMBERED_BYTES:
            self._forget_rare()
        lead = " " if self.model.dummy_prefix else ""
        code, codes, per_text = self.codes.__getitem__, [], []
        for t in texts:
            t = t.replace(SPACE, " ")
            cut = (CHUNK.findall(lead + t) if self.model.splits else [lead + t]) if t else []
            per_text.append(len(cut))
            codes += map(code, cut)
        at = np.array(codes, dtype=np.int64)
        uses = np.bincount(at, minlength=len(self.codes))
        uses[:len(self.uses)] += self.uses
        self.uses = uses
        first, flat = np.array(self.first), np.array(self.flat)
        length = first[at + 1] - first[at]
        by_text = np.concatenate(([0], np.cumsum(length)))
        return flat[B.ranges(first[at], length)].astype(np.int32), by_text[
            np.concatenate(([0], np.cumsum(per_text, dtype=np.int64)))]

    def encode(self, text: str) -> list[int]:
        return self.encode_all([text])[0].tolist()


class Decoder:
    def __init__(self, model: PieceModel):
        plain = []
        at_byte = {i: bytes([b]) for b, i in enumerate(model.byte_ids)}
        for i, p in enumerate(model.pieces):
            plain.append(at_byte.get(i) if i in at_byte else b"" if model.kinds[i] == CONTROL
                         else " ⁇ ".encode() if i == model.unk_id else p.replace(SPACE, " ").encode())
        self.length = np.array([len(p) for p in plain], dtype=np.int64)
        self.first = np.cumsum(self.length) - self.length
        self.data = np.frombuffer(b"".join(plain), dtype=np.uint8)
        self.lead = model.dummy_prefix

    def decode_all(self, ids: np.ndarray, offsets: np.ndarray) -> list[str]:
        size = self.length[ids]
        raw = self.data[B.ranges(self.first[ids], size)].tobytes()
        ends = np.concatenate(([0], np.cumsum(size)))[offsets].tolist()
        out = []
        for a, b in zip(ends[:-1], ends[1:], strict=True):
            part = raw[a:b]
            out.append((part[1:] if self.lead and part[:1] == b" " else part).decode("utf-8", "replace"))
        return out


_kept: dict[int, tuple[Encoder, Decoder]] = {}


def _let_go() -> None:
    for encoder, _ in _kept.values():
        encoder.model.forget()
    _kept.clear()


def _coders(model: PieceModel) -> tuple[Encoder, Decoder]:
    B.hold("pieces", _let_go)
    if id(model) not in _kept:
        _let_go()
        _kept[id(model)] = (Encoder(model), Decoder(model))
    return _kept[id(model)]


def encode(docs: DataFrame, model: PieceModel, text_col: str = "text", check: bool = False) -> DataFrame:
    """``docs`` without its text, with ``ids array<int>`` and ``n_tokens``; with
    ``check`` also ``round_trip``: do the ids decode to the text (null as empty)?"""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)
    made = ["ids", "n_tokens", *(["round_trip"] if check else [])]
    rest = [c for c in docs.columns if c != text_col and c not in made]

    @B.tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, decoder = _coders(shared.value)
        for batch in batches:
            for lo, hi, data, offsets in B.pieces(batch.column(0), 4 << 20):
                raw = data.tobytes()
                texts = [raw[a:b].decode() for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
                ids, cuts = encoder.encode_all(texts)
                made_now = [pa.ListArray.from_arrays(pa.array(cuts.astype(np.int32)), pa.array(ids)),
                            pa.array(np.diff(cuts))]
                if check:
                    back = decoder.decode_all(ids, cuts)
                    made_now.append(pa.array([a == b.replace(SPACE, " ") for a, b in zip(back, texts, strict=True)], pa.bool_()))
                yield pa.RecordBatch.from_arrays([*(c.slice(lo, hi - lo) for c in batch.columns[1:]), *made_now],
                                                 names=[*rest, *made])

    schema = ", ".join([*(f"`{c}` {t}" for c, t in docs.select(rest).dtypes), "ids array<int>, n_tokens bigint",
                        *(["round_trip boolean"] if check else [])])
    return docs.select(F.col(text_col).cast("string"), *rest).mapInArrow(run, schema)


def decode(docs: DataFrame, model: PieceModel, ids_col: str = "ids", out_col: str = "text") -> DataFrame:
    """``docs`` with ``out_col`` decoded from ``ids_col`` (null ids: null text)."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)
    rest = [c for c in docs.columns if c not in (ids_col, out_col)]

    @B.tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, decoder = _coders(shared.value)
        for batch in batches:
            column = batch.column(0)
            texts = decoder.decode_all(column.flatten().to_numpy(zero_copy_only=False).astype(np.int64),
                                       np.concatenate(([0], np.cumsum(column.value_lengths().fill_null(0).to_numpy(
                                           zero_copy_only=False)))).astype(np.int64))
            texts = [t if ok else None for t, ok in zip(texts, column.is_valid().to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(texts, pa.string())], names=[*rest, out_col])

    schema = ", ".join([*(f"`{c}` {t}" for c, t in docs.select(rest).dtypes), f"`{out_col}` string"])
    return docs.select(F.col(ids_col).cast("array<int>"), *rest).mapInArrow(run, schema)
