"""Benchmark decontamination with a generalised suffix automaton of test items.

The words of all test items form one automaton. A document's words stream
through it; the automaton's state gives the longest run of item words that ends
at each word. Where that run reaches ``window`` words (or is a whole item of
fewer words), its window is hit. Hits, items and coverage follow per document.

Words of a document that no item holds cannot be part of a hit, so only runs of
item words at least as long as the shortest window are streamed.

The benchmark is a stated test set. Its automaton is broadcast in blocks of at
most ``BLOCK_WORDS`` words; a larger benchmark takes several passes over the
documents, each adding its spans, so a task holds one block at a time.

Defined results: null or wordless texts have no words and no hits; null or
wordless items have no window; items with equal texts all count, an item id that
repeats counts once, a null item id can hit but is not listed; an empty table
gives an empty result. Input columns named like an output column are replaced.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from settlekit.llm import blocks as B

WINDOW = 13
COVERAGE = 20           # contaminated: at least one word in so many is hit
BLOCK_WORDS = 200_000
#: Bytes that separate words: all ASCII but digits and letters.
SEPARATORS = tuple(b for b in range(128) if not (48 <= b <= 57 or 97 <= b <= 122))
OUTPUTS = ("n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def words_of(data: np.ndarray, offsets: np.ndarray):
    """(hash, row, start, end) of the words of a piece."""
    data = B.lower_ascii(data)
    start, end, row = B.word_spans(data, offsets, SEPARATORS)
    return (B.SpanHash(data).of(start, end) if len(start) else np.zeros(0, np.uint64)), row, start, end


class ItemAutomaton:
    """Generalised suffix automaton over word numbers, with the windows each state completes."""

    def __init__(self, items: list[tuple[int | None, str]], window: int = WINDOW):
        self.window = window
        numbers: dict[int, int] = {}
        texts = []
        for item, text in items:
            h, *_ = words_of(*B.text_bytes(pa.array([text], pa.string())))
            if len(h):
                texts.append((item, [numbers.setdefault(x, len(numbers)) for x in h.tolist()]))
        known = np.array(sorted(numbers), dtype=np.uint64)
        self.known, self.number = known, np.array([numbers[x] for x in known.tolist()], dtype=np.int64)
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        for _, words in texts:
            last = 0
            for w in words:
                last = self._extend(last, w)
        self.shortest = min([window, *(len(words) for _, words in texts)])
        self._windows(texts)

    def _state(self, length: int, nxt: dict[int, int], link: int) -> int:
        self.next.append(nxt), self.link.append(link), self.length.append(length)
        return len(self.next) - 1

    def _fork(self, p: int, w: int) -> int:
        """The state of p + w with exactly that length: the target itself or a copy of it."""
        q = self.next[p][w]
        if self.length[p] + 1 == self.length[q]:
            return q
        copy = self._state(self.length[p] + 1, dict(self.next[q]), self.link[q])
        self.link[q] = copy
        while p >= 0 and self.next[p].get(w) == q:
            self.next[p][w] = copy
            p = self.link[p]
        return copy

    def _extend(self, last: int, w: int) -> int:
        if w in self.next[last]:
            return self._fork(last, w)
        new = self._state(self.length[last] + 1, {}, 0)
        p = last
        while p >= 0 and w not in self.next[p]:
            self.next[p][w] = new
            p = self.link[p]
        if p >= 0:
            self.link[new] = self._fork(p, w)
        return new

    def _windows(self, texts) -> None:
        """ends[state]: (length, item ids) of the windows that end where the state's words end."""
        own: list[dict[int, set]] = [{} for _ in self.next]
        for item, words in texts:
            state = 0
            size = min(self.window, len(words))
            for i, w in enumerate(words):
                state = self.next[state][w]
                if i + 1 >= size:
                    at = state
                    while self.length[self.link[at]] >= size:
                        at = self.link[at]
                    own[at].setdefault(size, set()).add(item)
        self.ends: list[tuple] = [()] * len(self.next)
        for state in sorted(range(1, len(self.next)), key=self.length.__getitem__):
            mine = tuple((n, tuple(i for i in items if i is not None)) for n, items in sorted(own[state].items()))
            self.ends[state] = self.ends[self.link[state]] + mine

    def numbers(self, hashes: np.ndarray) -> np.ndarray:
        """The words' numbers, -1 for words of no item."""
        if not len(self.known):
            return np.full(len(hashes), -1, np.int64)
        at = np.minimum(np.searchsorted(self.known, hashes), len(self.known) - 1)
        return np.where(self.known[at] == hashes, self.number[at], -1)

    def hits(self, words: list[int]) -> tuple[list[tuple[int, int]], set]:
        """(first word, word after) of each hit window of a run of item words, and its items."""
        spans, items = [], set()
        state = matched = 0
        nxt, link, length, ends = self.next, self.link, self.length, self.ends
        for i, w in enumerate(words):
            while state and w not in nxt[state]:
                state = link[state]
                matched = length[state]
            to = nxt[state].get(w)
            if to is None:
                continue
            state, matched = to, matched + 1
            for n, who in ends[state]:
                if n <= matched:
                    spans.append((i + 1 - n, i + 1))
                    items.update(who)
        return spans, items


def _union(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


@B.tidy
def _scan(batches: Iterator[pa.RecordBatch], automaton, names: list[str], keep_text: bool) -> Iterator[pa.RecordBatch]:
    """Adds one block's spans and items to the columns n_words, spans, items (at 1, 2, 3; text at 0)."""
    B.hold("decontaminate")
    auto: ItemAutomaton = automaton.value
    for batch in batches:
        spans = batch.column(2).to_pylist()
        items = batch.column(3).to_pylist()
        chars = batch.column(4).to_pylist()
        n_words = np.zeros(batch.num_rows, np.int64)
        for lo, hi, data, offsets in B.pieces(batch.column(0)):
            h, row, start, end = words_of(data, offsets)
            n_words[lo:hi] = np.bincount(row, minlength=hi - lo)
            number = auto.numbers(h)
            first = np.searchsorted(row, np.arange(hi - lo))
            good = number >= 0
            edge = B.group_starts(good, row)
            size = np.diff(np.append(edge, len(good)))
            for a, n in zip(edge[good[edge] & (size >= auto.shortest)].tolist(),
                            size[good[edge] & (size >= auto.shortest)].tolist(), strict=True) if len(edge) else ():
                found, who = auto.hits(number[a:a + n].tolist())
                if found:
                    r = int(row[a])
                    base = a - int(first[r])
                    found = _union(found)
                    spans[lo + r] = spans[lo + r] + [x + base for s in found for x in s]
                    chars[lo + r] = chars[lo + r] + [int(x - offsets[r]) for s, e in found
                                                     for x in (start[a + s], end[a + e - 1])]
                    items[lo + r] = items[lo + r] + list(who)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0) if keep_text else pa.nulls(batch.num_rows, pa.string()), pa.array(n_words), pa.array(spans, pa.list_(pa.int64())), pa.array(items, pa.list_(pa.int64())),
             pa.array(chars, pa.list_(pa.int64())), *batch.columns[5:]], names=names)


def _pairs(flat: list[int]) -> list[tuple[int, int]]:
    return _union(list(zip(flat[::2], flat[1::2], strict=True)))


def _sum_up(batches: Iterator[pa.RecordBatch], coverage: int, rest: list[str], cut: bool) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        n_words = batch.column(1).to_numpy(zero_copy_only=False)
        hit, n_items, digest, texts = [], [], [], []
        for i, (spans, items) in enumerate(zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)):
            hit.append(sum(b - a for a, b in _pairs(spans)))
            ids = sorted({str(x) for x in items})
            n_items.append(len(ids))
            digest.append(hashlib.sha256(",".join(ids).encode()).hexdigest())
            if cut:
                text = batch.column(0)[i].as_py()
                if spans:
                    raw, at, parts = text.encode(), 0, []
                    for a, b in _pairs(batch.column(4)[i].as_py()):
                        parts.append(raw[at:a])
                        at = b
                    text = b"".join([*parts, raw[at:]]).decode("utf-8", "ignore")
                texts.append(text)
        hit = np.array(hit, dtype=np.int64)
        made = [pa.array(n_words), pa.array(hit), pa.array(n_items, pa.int64()), pa.array(digest, pa.string()),
                pa.array((hit > 0) & (coverage * hit >= n_words))]
        if cut:
            made.append(pa.array(texts, pa.string()))
        yield pa.RecordBatch.from_arrays([*batch.columns[5:], *made], names=[*rest, *OUTPUTS, *(["clean_text"] if cut else [])])


def benchmark_hits(docs: DataFrame, items: DataFrame, window: int = WINDOW, coverage: int = COVERAGE,
                   text_col: str = "text", item_col: str = "item_id", with_text: bool = False) -> DataFrame:
    """``docs`` without its text, with ``n_words, n_hit, n_items, items_sha256,
    contaminated``; with ``with_text`` also ``clean_text``, the text without the hit spans."""
    spark = docs.sparkSession
    made = [*OUTPUTS, *(["clean_text"] if with_text else [])]
    rest = [c for c in docs.columns if c != text_col and c not in made and not c.startswith("__")]
    items = items.select(F.col(item_col).cast("bigint").alias("item"), F.col("text").cast("string").alias("text")).where(
        "text IS NOT NULL")
    volume = items.agg(F.coalesce(F.sum(F.size(F.split("text", r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"))), F.lit(0))).first()[0]
    n_blocks = 1 + int(volume) // BLOCK_WORDS
    none = F.array().cast("array<bigint>")
    found = docs.select(F.col(text_col).cast("string").alias("__text"), F.lit(0).cast("bigint").alias("__n"),
                        none.alias("__spans"), none.alias("__items"), none.alias("__chars"), *rest)
    schema, names = found.schema, found.columns
    for block in range(n_blocks):
        part = items.where(F.pmod(F.xxhash64("item", "text"), F.lit(n_blocks)) == block).collect()
        automaton = spark.sparkContext.broadcast(ItemAutomaton([(r[0], r[1]) for r in part], window))
        keep = with_text or block < n_blocks - 1
        found = found.mapInArrow(lambda it, a=automaton, keep=keep: _scan(it, a, names, keep), schema)
        if block < n_blocks - 1:
            found = B.shared_table(spark, found, "spans")
    kinds = "n_words bigint, n_hit bigint, n_items bigint, items_sha256 string, contaminated boolean"
    out = ", ".join([*(f"`{c}` {t}" for c, t in docs.select(rest).dtypes), kinds, *(["clean_text string"] if with_text else [])])
    return found.mapInArrow(lambda it: _sum_up(it, coverage, rest, with_text), out)


def drop_contaminated(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, unchanged."""
    columns = docs.columns
    kept = benchmark_hits(docs.withColumn("__keep", F.col("text")).withColumnRenamed("__keep", "kept__text"), items, **options)
    return kept.where("NOT contaminated").select(*[F.col("kept__text").alias("text") if c == "text" else F.col(c) for c in columns])
