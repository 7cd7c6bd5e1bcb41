"""MinHash near-dedup through an inverted index of signature coordinates.

A document's set is its distinct ``width``-word shingles (a shorter text is one
shingle). Documents with 100 * |A & B| >= percent * |A | B| are linked, and a
component's least id is kept.

How it runs
1. One pass computes each set's size, its 128-bit digest and a MinHash signature
   of ``coordinates`` values, each turned into a token (coordinate, value).
   Documents with equal sets form a class; one of each goes on (copies are never
   expanded into pairs).
2. Classes are posted under their tokens. Pairs above the similarity agree in
   at least ``matches`` coordinates but for a chance below ``missed`` (Chernoff
   bound; 22 of 48 at 85 %, 19 of 48 at 80 %). With tokens ordered by rarity, such a
   pair shares one of the first coordinates - matches + 1 of each side; tokens
   nobody shares come first and cost nothing, and a class with that many
   unshared tokens has no partner.
3. Posting lists are skipped through pivots: a round lets each class meet a few
   members of its lists, counts collisions, and confirms the class against the
   one it collides with most. Lists whose members are already in one component
   drop out, so a large group of near copies costs about one comparison per
   member. What is left, classes that still share a list with another component,
   is posted once more under the rarest shingles of the full sets (at 85 % two
   linked sets share one of the rarest 15 % of each, and enough shingles must be
   left from there on), so that members with many edits of their own meet nobody. Collisions of the remaining pairs are counted
   over the whole signatures, and pairs below ``matches`` are dropped.
4. Every link is confirmed on the full shingle sets, hashed to 64 bits.

Defined results: null or wordless texts have no shingles and no links; rows with
a null id are never linked (component null, kept); rows with equal ids count as
one document; an empty table gives an empty result. Input columns named like an
output column are replaced by it.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from settlekit.llm import blocks as B
from settlekit.llm.components import parents, stars

WIDTH, PERCENT = 5, 80
COORDINATES, MISSED = 48, 1e-8
PIVOTS, TRIES = 4, 2     # members of a list that the others meet (first the most central); how many are confirmed
PIVOT_ROUNDS = 6
WORTH = 50               # a round that confirms under one pair in so many is the last
OUTPUTS = ("n_shingles", "component_id", "kept")

_rng = np.random.default_rng(7)
_XOR = _rng.integers(0, 1 << 63, 256, dtype=np.uint64)
_MUL = _rng.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, shingle hash) of the rows' distinct shingles, sorted by both."""
    data = B.lower_ascii(data)
    start, end, row = B.word_spans(data, offsets)
    if not len(start):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    word = B.SpanHash(data).of(start, end)
    count = np.bincount(row, minlength=len(offsets) - 1)
    first = np.cumsum(count) - count
    size = np.minimum(count, width)
    at = B.ranges(first, np.where(count > 0, np.maximum(count - width + 1, 1), 0))
    rows = row[at]
    left = size[rows]
    h = np.full(len(at), 0x9E3779B97F4A7C15, dtype=np.uint64)
    for d in range(width):
        use = left > d
        step = B.mix(h + word[np.minimum(at + d, len(word) - 1)])
        h = step if use.all() else np.where(use, step, h)
    order = np.lexsort((h, rows))
    rows, h = rows[order], h[order]
    keep = B.group_starts(rows, h)
    return rows[keep], h[keep]


def matches_for(percent: int, coordinates: int, missed: float) -> int:
    """The most matches t such that a pair at the similarity has fewer with a chance below ``missed``."""
    j = min(percent / 100, 1 - 1e-9)
    for t in range(int(j * coordinates), 0, -1):
        p = t / coordinates
        if p < j and coordinates * (p * math.log(p / j) + (1 - p) * math.log((1 - p) / (1 - j))) > -math.log(missed):
            return t
    return 1


@B.tidy
def _signatures(batches: Iterator[pa.RecordBatch], width: int, coordinates: int) -> Iterator[pa.RecordBatch]:
    B.hold("near_dedup")
    for batch in batches:
        n_rows = batch.num_rows
        size = np.zeros(n_rows, np.int64)
        digest = np.zeros((2, n_rows), np.int64)
        tokens, of_row = [], []
        for lo, _hi, data, offsets in B.pieces(batch.column(1)):
            rows, h = shingle_sets(data, offsets, width)
            if not len(rows):
                continue
            heads = B.group_starts(rows)
            who = lo + rows[heads]
            size[who] = np.diff(np.append(heads, len(rows)))
            for i in (0, 1):
                digest[i, who] = np.add.reduceat(B.mix(h ^ _XOR[200 + i]), heads).view(np.int64)
            sig = np.empty((len(heads), coordinates), np.uint64)
            for c in range(coordinates):
                sig[:, c] = np.minimum.reduceat((h ^ _XOR[c]) * _MUL[c], heads)
            tokens.append(B.mix(sig + np.arange(1, coordinates + 1, dtype=np.uint64) * _MUL[255]).view(np.int64))
            of_row.append(who)
        lengths = np.zeros(n_rows, np.int64)
        if of_row:
            lengths[np.concatenate(of_row)] = coordinates
        flat = np.concatenate(tokens).ravel() if tokens else np.zeros(0, np.int64)
        cuts = np.concatenate(([0], np.cumsum(lengths))).astype(np.int32)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(size), pa.array(digest[0]), pa.array(digest[1]),
             pa.ListArray.from_arrays(pa.array(cuts), pa.array(flat))], names=["id", "n", "d1", "d2", "tokens"])


@B.tidy
def _zip_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    B.hold("near_dedup")
    zip_text = zstandard.ZstdCompressor(level=1).compress
    for batch in batches:
        blobs = []
        for _lo, _hi, data, offsets in B.pieces(batch.column(1)):
            raw = data.tobytes()
            blobs += [zip_text(raw[a:b]) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(blobs, pa.binary())], names=["id", "z"])


def _unzipped(blobs: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    unzip = zstandard.ZstdDecompressor().decompress
    raw = [unzip(b) for b in blobs]
    return np.frombuffer(b"".join(raw), np.uint8), np.concatenate(([0], np.cumsum([len(r) for r in raw])))


@B.tidy
def _confirm(batches: Iterator[pa.RecordBatch], width: int, percent: int, step: int = 256) -> Iterator[pa.RecordBatch]:
    """Keeps the pairs (a, b, za, zb) whose full sets are similar enough."""
    B.hold("near_dedup")
    for batch in batches:
        for lo in range(0, batch.num_rows, step):
            part = batch.slice(lo, step)
            n = part.num_rows
            ra, ha = shingle_sets(*_unzipped(part.column(2).to_pylist()), width)
            rb, hb = shingle_sets(*_unzipped(part.column(3).to_pylist()), width)
            rows, h = np.concatenate((ra, rb)), np.concatenate((ha, hb))
            order = np.lexsort((h, rows))
            rows, h = rows[order], h[order]
            both = np.bincount(rows[1:][(rows[1:] == rows[:-1]) & (h[1:] == h[:-1])], minlength=n)
            union = np.bincount(rows, minlength=n) - both
            ok = (union > 0) & (100 * both >= percent * union)
            yield pa.RecordBatch.from_arrays([part.column(i).filter(pa.array(ok)) for i in (0, 1)], names=["a", "b"])


@B.tidy
def _sets(batches: Iterator[pa.RecordBatch], width: int, step: int = 256) -> Iterator[pa.RecordBatch]:
    """The full sets of rows (rep, z, n, group)."""
    B.hold("near_dedup")
    for batch in batches:
        for lo in range(0, batch.num_rows, step):
            part = batch.slice(lo, step)
            rows, h = shingle_sets(*_unzipped(part.column(1).to_pylist()), width)
            cuts = np.searchsorted(rows, np.arange(part.num_rows + 1)).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.ListArray.from_arrays(pa.array(cuts), pa.array(h.view(np.int64))), *part.columns[2:]],
                names=["rep", "shingles", "n", "group"])


def near_duplicate_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH,
                           percent: int = PERCENT, coordinates: int = COORDINATES, missed: float = MISSED) -> DataFrame:
    """``(id, n_shingles, component_id, kept)``, one row per input row."""
    matches = matches_for(percent, coordinates, missed)
    spark = docs.sparkSession
    texts = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).cast("string").alias("text"))
    sig = B.shared_table(spark, texts.mapInArrow(
        lambda it: _signatures(it, width, coordinates), "id bigint, n bigint, d1 bigint, d2 bigint, tokens array<bigint>"),
        "signatures")
    classes = B.shared_table(spark, sig.where("n > 0 AND id IS NOT NULL").groupBy("n", "d1", "d2").agg(
        F.min("id").alias("rep"), F.first("tokens").alias("tokens")), "classes")

    # posting lists of shared tokens, and each class's prefix of the rarest
    posted = classes.select("rep", F.explode("tokens").alias("token"))
    shared = posted.groupBy("token").agg(F.count(F.lit(1)).alias("df")).where("df > 1")
    own = posted.join(shared, "token").groupBy("rep").agg(
        F.array_sort(F.collect_list(F.struct("df", "token"))).alias("list"), F.sum("df").alias("mass"))
    room = F.lit(coordinates - matches + 1) - (F.lit(coordinates) - F.size("list"))
    active = B.shared_table(spark, own.where(room > 0).select(
        "rep", "mass", F.col("list.token").alias("tokens"),
        F.slice(F.col("list.token"), F.lit(1), room).alias("prefix")), "active")
    sizes = classes.select("rep", "n")
    lists = B.shared_table(spark, active.select("rep", "mass", F.explode("prefix").alias("token")).join(sizes, "rep"), "lists")
    bodies = B.shared_table(spark, texts.where("id IS NOT NULL").mapInArrow(_zip_texts, "id bigint, z binary").join(
        active.select(F.col("rep").alias("id")).distinct(), "id", "left_semi"), "bodies")

    def confirmed(pairs: DataFrame) -> DataFrame:
        full = (pairs.join(bodies.select(F.col("id").alias("a"), F.col("z").alias("za")), "a")
                .join(bodies.select(F.col("id").alias("b"), F.col("z").alias("zb")), "b"))
        return full.select("a", "b", "za", "zb").mapInArrow(lambda it: _confirm(it, width, percent), "a bigint, b bigint")

    def similar_size(x: str, y: str):
        return (F.col(x) * 100 >= F.col(y) * percent) & (F.col(y) * 100 >= F.col(x) * percent)

    tested, star = None, None

    def labelled() -> DataFrame:
        if star is None:
            return lists.withColumn("group", F.col("rep"))
        groups = parents(star)
        return lists.join(groups, lists["rep"] == groups["node"], "left").select(
            "token", "rep", "n", "mass", F.coalesce("component", "rep").alias("group"))

    for turn in range(PIVOT_ROUNDS):
        now = labelled()
        mixed = now.groupBy("token").agg(F.min("group").alias("g0"), F.max("group").alias("g1")).where("g0 != g1")
        now = now.join(mixed.select("token"), "token")
        first = F.desc("mass") if turn == 0 else F.xxhash64("rep", F.lit(turn))
        order = Window.partitionBy("token").orderBy(first, "rep")
        pivots = now.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= PIVOTS).select(
            "token", F.col("rep").alias("b"), F.col("group").alias("b_group"), F.col("n").alias("b_n"))
        pairs = now.join(pivots, "token").where((F.col("group") != F.col("b_group")) & similar_size("n", "b_n"))
        pairs = pairs.groupBy(F.col("rep").alias("a"), "b").agg(F.count(F.lit(1)).alias("hits"))
        if tested is not None:
            pairs = pairs.join(tested, ["a", "b"], "left_anti")
        nearest = Window.partitionBy("a").orderBy(F.desc("hits"), "b")
        best = pairs.withColumn("rank", F.row_number().over(nearest)).where(F.col("rank") <= TRIES).select("a", "b")
        best = B.shared_table(spark, best, "pairs")
        tested = best if tested is None else tested.unionByName(best)
        links = B.shared_table(spark, confirmed(best), "links")
        n_pairs, n_links = best.select(F.lit(0).alias("linked")).unionByName(links.select(F.lit(1).alias("linked"))).agg(
            F.count_if(F.col("linked") == 0), F.count_if(F.col("linked") == 1)).first()
        if n_links:
            star = stars(links if star is None else star.unionByName(links))
        if not n_pairs or n_links * WORTH < n_pairs:
            break

    # what is left: classes that still share a list with another component
    now = labelled()
    mixed = now.groupBy("token").agg(F.min("group").alias("g0"), F.max("group").alias("g1")).where("g0 != g1")
    rest = now.join(mixed.select("token"), "token").select("rep", "n", "group").distinct()
    sets = rest.join(bodies, rest["rep"] == bodies["id"]).select("rep", "z", "n", "group").mapInArrow(
        lambda it: _sets(it, width), "rep bigint, shingles array<bigint>, n bigint, group bigint")
    post = B.shared_table(spark, sets.select("rep", "n", "group", F.explode("shingles").alias("shingle")), "rest")
    common = post.groupBy("shingle").agg(F.count(F.lit(1)).alias("df"), F.min("group").alias("g0"),
                                         F.max("group").alias("g1")).where("df > 1")
    by_rep = Window.partitionBy("rep")
    place = F.col("n") - F.count(F.lit(1)).over(by_rep) + F.row_number().over(by_rep.orderBy("df", "shingle"))
    room = F.floor(F.col("n") * F.lit(100 - percent) / 100) + 1
    front = post.join(common, "shingle").withColumn("place", place).where((F.col("place") <= room) & F.expr("g0 != g1"))
    front = front.select("shingle", "rep", "n", "group", (F.col("n") - F.col("place") + 1).alias("left"))
    x = front.toDF("shingle", "a", "a_n", "a_group", "a_left")
    y = front.toDF("shingle", "b", "b_n", "b_group", "b_left")
    overlap = F.least("a_left", "b_left") * (100 + percent) >= (F.col("a_n") + F.col("b_n")) * percent
    ordered = F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")
    pairs = x.join(y, "shingle").where((F.col("a_group") < F.col("b_group")) & overlap).select(*ordered).distinct()
    pairs = pairs.join(tested.select(*ordered), ["a", "b"], "left_anti")
    tokens = active.select(F.col("rep").alias("a"), F.col("tokens").alias("ta"))
    pairs = (pairs.join(tokens, "a").join(tokens.toDF("b", "tb"), "b")
             .where(F.size(F.array_intersect("ta", "tb")) >= matches).select("a", "b"))
    links = B.shared_table(spark, confirmed(B.shared_table(spark, pairs, "pairs")), "links")
    groups = parents(stars(links if star is None else star.unionByName(links)))

    labels = classes.join(groups, classes["rep"] == groups["node"], "left").select(
        "n", "d1", "d2", F.coalesce("component", "rep").alias("component_id"))
    known = F.col("id").isNotNull()
    return sig.select("id", "n", "d1", "d2").join(labels, ["n", "d1", "d2"], "left").select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"),
        F.when(known, F.coalesce("component_id", "id")).alias("component_id"),
        (~known | (F.coalesce("component_id", "id") == F.col("id"))).alias("kept"))


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` of which one document per component stays, its least id."""
    found = near_duplicate_classes(docs, id_col, text_col, **options)
    gone = found.where("NOT kept").select(F.col(id_col).alias("__gone")).distinct()
    return docs.join(gone, F.col(id_col).cast("bigint") == F.col("__gone"), "left_anti")
