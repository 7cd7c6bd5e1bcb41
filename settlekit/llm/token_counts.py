"""Token counts by prefix dynamic programming.

For a BPE model, the encoding of every prefix of a text ends in one piece, and a
piece t can be the last one of prefix i only if it is kept whole by itself and
next to the last piece of prefix i - len(t). So one pass over the pieces ending
at each position gives count[i] = count[i - len(t)] + 1, exactly, for every
prefix: truncation and budget questions are look-ups.

Text splits before each run of spaces and around line ends, where no piece
crosses, so the table of a text is the chunks' tables one after the other.
Chunks repeat; their tables are computed once per task (bounded memory).

Defined results: a null or empty text has 0 tokens and its longest fitting
prefix is empty; repeated rows and null ids are counted like any row; an empty
table gives an empty result. Input columns named like an output column are
replaced by it.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from settlekit.llm.blocks import hold, text_bytes
from settlekit.llm.piece_model import BPE, SPACE, PieceModel

REMEMBERED = 1_000_000    # chunks held per task
OUTPUTS = ("n_bytes", "n_tokens", "over_limit", "fitting_chars")
CHUNK = re.compile(r" +[^ \n]*|[^ \n]+|\n+")


class PrefixCounts:
    """Token counts of all prefixes of a text, for one model."""

    def __init__(self, model: PieceModel):
        if model.model_type != BPE or not model.splits or not model.dummy_prefix:
            raise ValueError("a BPE model whose pieces end before white space is needed")
        self.model = model
        self.totals: dict[str, int] = {}

    def chunk_table(self, chunk: str) -> list[int]:
        """count[0..len] of a chunk written with the space mark."""
        return self._spaced_table(chunk) if chunk[:2] == SPACE * 2 else self._walk(chunk)[0]

    def _walk(self, chunk: str) -> tuple[list[int], list[int | None]]:
        """count[0..len], and the last piece of each prefix (-1: none)."""
        model, n = self.model, len(chunk)
        count, last = [0] * (n + 1), [None] * (n + 1)
        last[0] = -1
        known, compatible, width = model._pairs.get, model.compatible, len(model.pieces)

        def fill(upto):
            at = upto
            while last[at] is None:
                at -= 1
            for i in range(at + 1, upto + 1):   # characters no piece covers
                count[i], last[i] = count[i - 1] + len(model.unknown(chunk[i - 1])), -1

        for end, (piece, length) in model.automaton.iter(chunk):
            end += 1
            if last[end] is None:
                start = end - length
                if last[start] is None:
                    fill(start)
                before = last[start]
                kept = known(before * width + piece)
                if kept is None:
                    kept = compatible(before, piece)
                if kept:
                    count[end], last[end] = count[start] + 1, piece
        fill(n)
        return count, last

    def _spaced_total(self, chunk: str) -> int:
        """The last entry of ``_spaced_table``, without the others."""
        run = len(chunk) - len(chunk.lstrip(SPACE))
        if run == len(chunk):
            return self._spaces(run)
        count, last = self._walk(chunk[run - 1:])
        at = first = len(count) - 1
        while at > 0:
            first = len(self.model.pieces[last[at]]) if last[at] >= 0 else 1
            at -= first
        return self._spaces(run - 1) + count[-1] if first > 1 else self._spaces(run) + self._walk(chunk[run:])[0][-1]

    def _spaced_table(self, chunk: str) -> list[int]:
        """Runs of spaces merge by position, as their pieces score alike: each
        prefix of the run is merged as it stands, and what follows it joins its
        last space only."""
        run = len(chunk) - len(chunk.lstrip(SPACE))
        if run == len(chunk):
            return [0, *(self._spaces(i) for i in range(1, run + 1))]
        word = chunk[run - 1:]
        table = self.chunk_table(word)
        bare = self.chunk_table(chunk[run:])
        out = [0, *(self._spaces(i) for i in range(1, run + 1))]
        for i in range(1, len(word)):
            joined = self._joins(word[:i + 1])
            out.append(self._spaces(run - 1) + table[i + 1] if joined else self._spaces(run) + bare[i])
        return out

    def _joins(self, text: str) -> bool:
        """Does the first piece of a text that starts with one space hold more than the space?"""
        return len(self.model.merged(text)[0]) > 1

    def _spaces(self, n: int) -> int:
        return self.model.space_count(n)

    def chunks(self, text: str) -> list[str]:
        return CHUNK.findall(" " + text.replace(SPACE, " ")) if text else []

    def total(self, chunk: str) -> int:
        known = self.totals.get(chunk)
        if known is None:
            marked = chunk.replace(" ", SPACE)
            known = self._spaced_total(marked) if marked[:2] == SPACE * 2 else self._walk(marked)[0][-1]
            if len(self.totals) >= REMEMBERED:
                self.totals.clear()
            self.totals[chunk] = known
        return known

    def table(self, text: str) -> list[int]:
        """count[i] = tokens of ``text[:i]``, for every i."""
        out, base = [0], 0
        for k, chunk in enumerate(self.chunks(text)):
            counts = self.chunk_table(chunk.replace(" ", SPACE))
            out += [base + c for c in counts[1:]]
            base += counts[-1]
        return [0, *out[2:]] if text else out   # the first position is the added space

    def count(self, text: str) -> int:
        total = self.total
        return sum([total(c) for c in self.chunks(text)])

    def fitting(self, text: str, budget: int) -> int:
        """Length of the longest prefix of ``text`` with at most ``budget`` tokens."""
        chunks = self.chunks(text)
        at, base, length = 0, 0, -1
        for upto, c in zip(accumulate(map(self.total, chunks)), chunks, strict=True):
            if upto > budget:
                counts = self.chunk_table(c.replace(" ", SPACE))
                at = max(i for i, x in enumerate(counts) if base + x <= budget)
                return max(0, length + at)
            base, length = upto, length + len(c)
        return max(0, length)


_counters: dict[int, PrefixCounts] = {}


def counter_of(model: PieceModel) -> PrefixCounts:
    """One counter per model and Python worker."""
    hold("tokens", _counters.clear)
    if id(model) not in _counters:
        _counters.clear()
        _counters[id(model)] = PrefixCounts(model)
    return _counters[id(model)]


def count_tokens(docs: DataFrame, model: PieceModel, limit: int = 4096, text_col: str = "text") -> DataFrame:
    """``docs`` without its text, with ``n_bytes, n_tokens, over_limit`` and
    ``fitting_chars``, the length of the longest prefix within ``limit``."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)    # the size of the vocabulary, fixed
    rest = [c for c in docs.columns if c != text_col and c not in OUTPUTS]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = counter_of(shared.value)
        for batch in batches:
            texts = batch.column(0)
            n_tokens, fits = [], []
            for t in texts:
                text = t.as_py() or ""
                n = counter.count(text)
                n_tokens.append(n)
                fits.append(len(text) if n <= limit else counter.fitting(text, limit))
            _, offsets = text_bytes(texts)
            made = [pa.array(offsets[1:] - offsets[:-1]), pa.array(n_tokens, pa.int64()),
                    pa.array([n > limit for n in n_tokens], pa.bool_()), pa.array(fits, pa.int64())]
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], *made], names=[*rest, *OUTPUTS])

    schema = ", ".join([*(f"`{c}` {t}" for c, t in docs.select(rest).dtypes),
                        "n_bytes bigint, n_tokens bigint, over_limit boolean, fitting_chars bigint"])
    return docs.select(F.col(text_col).cast("string"), *rest).mapInArrow(run, schema)
