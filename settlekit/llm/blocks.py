"""Arrow and numpy helpers shared by the operators.

A task receives Arrow record batches; ``pieces`` cuts a batch into runs of
rows with a bounded number of text bytes (a longer text forms its own run), so
numpy temporaries stay small whatever the batch size is.
"""

from __future__ import annotations

import contextlib
import ctypes
import functools
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

PIECE_BYTES = 1 << 19
#: Row separators of the word rules: space and \t \n \v \f \r.
SPACES = (0x20, *range(0x09, 0x0E))

_rng = np.random.default_rng(20250131)
_BYTE_CODE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = int(_rng.integers(1 << 61, 1 << 62)) * 2 + 1
_BASE_INV = pow(_BASE, -1, 1 << 64)
_powers: dict[int, np.ndarray] = {}
_KEPT_POWERS = 1 << 20          # longer tables are made for their block and dropped

_holders: dict[str, Callable[[], None]] = {}


def _trim() -> None:
    """Gives freed memory back to the system: Arrow's pool and, where it exists, the C heap."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)


def tidy(task):
    """A task function (an iterator of batches to one of batches) that leaves its Python
    worker, which Spark reuses, without freed memory."""
    @functools.wraps(task)
    def run(*args, **kw):
        try:
            yield from task(*args, **kw)
        finally:
            _trim()
    return run


def tidy_group(task):
    """The same for a function of one group's table (or of a pair of tables) to a table: what
    the last group left goes before the next one's work."""
    @functools.wraps(task)
    def run(*args):
        _trim()
        try:
            return task(*args)
        finally:
            _trim()
    return run


def hold(name: str, release: Callable[[], None] = lambda: None) -> None:
    """Says that operator ``name`` works in this Python worker now. What other operators
    keep in it is released: workers are reused, and the next stage needs the memory."""
    for other in [k for k in _holders if k != name]:
        _holders.pop(other)()
        _trim()
    _holders[name] = release


def _power_table(base: int, n: int) -> np.ndarray:
    """base^0 .. base^(n-1) modulo 2^64, kept for the next block."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        size = max(1 << 16, 1 << (n - 1).bit_length())
        have = np.ones(size, dtype=np.uint64)
        done = 1
        while done < size:
            step = min(done, size - done)
            have[done:done + step] = have[:step] * np.uint64(pow(base, done, 1 << 64))
            done += step
        if size <= _KEPT_POWERS:
            _powers[base] = have
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (xor-shift, multiply) over uint64 values."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class SpanHash:
    """Position-independent 64-bit hashes of any byte spans of one block."""

    def __init__(self, data: np.ndarray):
        n = len(data)
        self.sums = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(_BYTE_CODE[data] * _power_table(_BASE, n), out=self.sums[1:])
        self.undo = _power_table(_BASE_INV, n + 1)

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.undo[start])

    def fixed(self, k: int) -> np.ndarray:
        """Hashes of all k-byte spans, by start."""
        n = max(0, len(self.sums) - k)
        return mix((self.sums[k:k + n] - self.sums[:n]) * self.undo[:n])


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts and the rows' offsets; null counts as empty.
    Both are views of the Arrow buffers (no copy of the texts)."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if not (pa.types.is_string(texts.type) or pa.types.is_large_string(texts.type)):
        texts = texts.cast(pa.string())
    for _ in range(2):
        width = np.int64 if pa.types.is_large_string(texts.type) else np.int32
        raw_offsets, raw = texts.buffers()[1:]
        offsets = np.zeros(1, np.int64) if raw_offsets is None or not len(texts) else np.frombuffer(
            raw_offsets, dtype=width)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
        if not texts.null_count or not np.diff(offsets)[texts.is_null().to_numpy(zero_copy_only=False)].any():
            break
        texts = texts.fill_null("")     # null slots that hold bytes
    data = np.frombuffer(raw, dtype=np.uint8) if raw is not None else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def pieces(texts: pa.Array, limit: int = PIECE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of runs of rows of about ``limit`` bytes."""
    data, offsets = text_bytes(texts)
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + limit, side="right")) - 1)
        yield lo, hi, data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo]
        lo = hi


def lower_ascii(data: np.ndarray) -> np.ndarray:
    """A-Z lower-cased, all other bytes unchanged."""
    return np.where((data >= 65) & (data <= 90), data + np.uint8(32), data)


def word_spans(data: np.ndarray, offsets: np.ndarray, separators=SPACES) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, row) of the maximal runs of non-separator bytes; runs end at row ends."""
    is_word = np.ones(256, dtype=bool)
    is_word[list(separators)] = False
    inside = is_word[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    row_starts = offsets[:-1][offsets[:-1] < offsets[1:]]
    first[row_starts] = inside[row_starts]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    row_ends = offsets[1:][offsets[:-1] < offsets[1:]] - 1
    last[row_ends] = inside[row_ends]
    start = np.flatnonzero(first)
    end = np.flatnonzero(last) + 1
    return start, end, np.searchsorted(offsets, start, side="right") - 1


def group_starts(*keys: np.ndarray) -> np.ndarray:
    """Start positions of the runs of equal keys in arrays that are already sorted."""
    n = len(keys[0])
    change = np.zeros(n, dtype=bool)
    if n:
        change[0] = True
    for k in keys:
        change[1:] |= k[1:] != k[:-1]
    return np.flatnonzero(change)


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Concatenation of start, start+1, .. for each (start, length)."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, dtype=np.int64)
    shift = np.repeat(starts - np.concatenate(([0], np.cumsum(lengths)[:-1])), lengths)
    return shift + np.arange(total)


def crc_mod(column: str, m: int) -> Column:
    """crc32 of the id's decimal text modulo m; null for a null id."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % m


def shared_table(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet under ``spark.checkpoint.dir`` and read back."""
    import uuid

    from settlekit.session import shared_dir
    path = f"{shared_dir(spark)}/llm-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def text_volume(docs: DataFrame, column: str = "text") -> tuple[int, int]:
    """(rows, UTF-8 bytes) of a table: sizes the number of buckets."""
    row = docs.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length(column)), F.lit(0))).first()
    return int(row[0]), int(row[1])


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Sends this package to the Python workers, once per application.

    Needed only where the workers cannot import it (it is then deployed the
    usual way, as a zip through ``addPyFile``).
    """
    import shutil
    import tempfile
    from pathlib import Path

    sc = spark.sparkContext
    if sc.applicationId not in _shipped:
        root = Path(__file__).resolve().parents[2]
        zipped = shutil.make_archive(f"{tempfile.mkdtemp(prefix='settlekit-ship-')}/settlekit", "zip", root, "settlekit")
        sc.addPyFile(zipped)
        _shipped.add(sc.applicationId)


def labelled_sample(docs: DataFrame, labels: DataFrame, label_col: str, per_label: dict, id_col: str = "doc_id",
                    text_col: str = "text", max_bytes: int | None = None) -> DataFrame:
    """``(text, label, key)`` of at most ``per_label[label]`` labelled ids per label, the
    least by a hash of the id; with ``max_bytes`` ids of texts up to that length come
    first, longer ones only fill up. Of rows with one id the least text counts. Only the chosen ids are broadcast, so their number is
    bounded, and the documents are not shuffled."""
    key = F.xxhash64(F.col(id_col).cast("string"))
    long = F.lit(False).alias("long")
    if max_bytes is not None:
        sized = docs.where(F.col(text_col).isNotNull()).groupBy(F.col(id_col).alias(id_col)).agg(
            F.min(F.octet_length(F.col(text_col).cast("string")) > max_bytes).alias("long"))
        labels, long = labels.where(F.col(label_col).isin(*per_label)).select(id_col, label_col).join(sized, id_col), F.col("long")
    chosen = None
    for label, n in per_label.items():
        some = labels.where(F.col(label_col) == label).select(F.col(id_col).alias("__id"), F.lit(label).alias("label"),
                                                              key.alias("key"), long).where("__id IS NOT NULL")
        some = some.orderBy("long", "key", "__id").limit(n).drop("long")
        chosen = some if chosen is None else chosen.unionByName(some)
    texts = docs.where(F.col(text_col).isNotNull()).select(F.col(id_col).alias("__id"), F.col(text_col).cast("string").alias("text"))
    return texts.join(F.broadcast(chosen), "__id").groupBy("__id", "label", "key").agg(F.min("text").alias("text")).select(
        "text", "label", "key")
