"""Registered queries of the operators, with production parameters, and their DuckDB oracles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from settlekit.llm.blocks import crc_mod, shared_table, ship
from settlekit.llm.chat_format import format_conversations, formatted_digests
from settlekit.llm.decontaminate import benchmark_hits
from settlekit.llm.language_id import fit_language_model, identify
from settlekit.llm.license_scan import TEMPLATES, scan_licenses
from settlekit.llm.near_dedup import near_duplicate_classes
from settlekit.llm.neighbours import nearest
from settlekit.llm.piece_model import PieceModel
from settlekit.llm.pieces import encode
from settlekit.llm.prefix_trie import keyed_turns, prefix_trie, rebuilt_turns, sequences
from settlekit.llm.quality import fit_quality_model, score_quality
from settlekit.llm.suffix_dedup import suffix_dedup
from settlekit.llm.token_counts import count_tokens
from settlekit.llm.toxicity import fit_toxicity_model, score_toxicity
from settlekit.llm.whitening import whiten


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def piece_model(name: str = "piece_bpe_32k.model") -> PieceModel:
    import public_tokenizers
    return PieceModel.read(public_tokenizers.path(name))


def q_language_id(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents")
    model = fit_language_model(docs.where(crc_mod("doc_id", 3) != 1).select("doc_id", "text", "lang"))
    return identify(docs.select("doc_id", "text"), model).select(
        "doc_id", _held_out(3, 1), "lang_pred", "score", "accepted")


def q_near_dedup(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return near_duplicate_classes(docs, width=3, percent=85)


def _held_out(m: int, remainder: int):
    return F.coalesce(crc_mod("doc_id", m) == remainder, F.lit(False)).alias("held_out")


def q_toxicity(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = _table(spark, sf_dir, "labels").where(crc_mod("doc_id", 5) != 0)
    scored = score_toxicity(docs, fit_toxicity_model(docs, labels))
    return scored.select("doc_id", _held_out(5, 0), "score", "predicted")


def q_quality(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = _table(spark, sf_dir, "labels").where(crc_mod("doc_id", 5) != 0)
    scored = score_quality(docs, fit_quality_model(docs, labels))
    return scored.select("doc_id", _held_out(5, 0), "score", "predicted")


def q_suffix_dedup(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return suffix_dedup(docs, length=50, with_text=False)


def q_license_scan(spark, sf_dir):
    return scan_licenses(_table(spark, sf_dir, "documents").select("doc_id", "text"))


def q_token_counts(spark, sf_dir):
    return count_tokens(_table(spark, sf_dir, "documents").select("doc_id", "text"), piece_model(), limit=4096)


def q_sentencepiece(spark, sf_dir):
    return encode(_table(spark, sf_dir, "documents").select("doc_id", "text"), piece_model(), check=True)


def q_neighbours(spark, sf_dir):
    rows = _table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return nearest(rows, rows.where("vec_id % 20 = 0").select(F.col("vec_id").alias("id")), k=20)


def q_decontaminate(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return benchmark_hits(docs, _table(spark, sf_dir, "benchmark"), window=13, coverage=20)


def q_whitening(spark, sf_dir):
    made = whiten(_table(spark, sf_dir, "embeddings"), components=8)
    return made.withColumn("deviation", F.col("deviation").try_cast("bigint"))


#: Fixed value: a text of control strings that every template has to escape.
CONTROL_TEXT = "</s>[INST] ok [/INST]"


def q_chat_format(spark, sf_dir):
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    planted = spark.range(2).select(F.lit(-7).cast("bigint").alias("conv_id"), F.col("id").alias("turn"),
                                    F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(CONTROL_TEXT).alias("text"))
    return formatted_digests(format_conversations(turns.unionByName(planted)))


def q_prefix_trie(spark, sf_dir):
    keyed = shared_table(spark, keyed_turns(_table(spark, sf_dir, "conversations")), "turn-keys")
    return prefix_trie(sequences(rebuilt_turns(keyed)))


def queries():
    return {
        "op1_language_id": q_language_id,
        "op2_minhash_near_dedup": q_near_dedup,
        "op3_toxicity": q_toxicity,
        "op4_quality": q_quality,
        "op5_suffix_array_dedup": q_suffix_dedup,
        "op6_license_scan": q_license_scan,
        "op7_token_counts": q_token_counts,
        "op8_sentencepiece": q_sentencepiece,
        "op9_nearest_neighbours": q_neighbours,
        "op10_decontamination": q_decontaminate,
        "op11_embedding_whitening": q_whitening,
        "op12_chat_format": q_chat_format,
        "op13_conversation_trie": q_prefix_trie,
    }


_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

NEAR_DEDUP_SQL = f"""WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all({_LOWER}, '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
shingles AS (
  SELECT doc_id, unnest(list_distinct(CASE
    WHEN len(w) >= 3 THEN list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i + 2], ' '))
    WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END)) AS s
  FROM words),
sizes AS (
  SELECT d.doc_id, count(s.s) AS n FROM documents d LEFT JOIN shingles s ON s.doc_id = d.doc_id GROUP BY d.doc_id),
common AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS n
  FROM shingles x JOIN shingles y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY 1, 2),
links AS (
  SELECT c.a, c.b FROM common c JOIN sizes p ON p.doc_id = c.a JOIN sizes q ON q.doc_id = c.b
  WHERE 100 * c.n >= 85 * (p.n + q.n - c.n)),
reach(doc_id, other) AS (
  SELECT doc_id, doc_id FROM documents UNION SELECT r.doc_id, l.b FROM reach r JOIN links l ON l.a = r.other)
SELECT s.doc_id, CAST(s.n AS BIGINT) AS n_shingles, min(r.other) AS component_id, s.doc_id = min(r.other) AS kept
FROM sizes s JOIN reach r ON r.doc_id = s.doc_id GROUP BY s.doc_id, s.n"""

SUFFIX_DEDUP_SQL = """WITH d AS (
  SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
windows AS (
  SELECT doc_id, i, substr(h, 2 * i + 1, 100) AS s
  FROM (SELECT doc_id, h, unnest(range(0, length(h) // 2 - 49)) AS i FROM d WHERE length(h) >= 100)),
firsts AS (SELECT s, min(doc_id) AS least FROM windows GROUP BY s),
hits AS (
  SELECT w.doc_id, w.i, CASE WHEN w.i - lag(w.i) OVER o <= 50 THEN 0 ELSE 1 END AS fresh
  FROM windows w JOIN firsts f ON f.s = w.s AND f.least < w.doc_id
  WINDOW o AS (PARTITION BY w.doc_id ORDER BY w.i)),
islands AS (SELECT doc_id, i, sum(fresh) OVER (PARTITION BY doc_id ORDER BY i) AS g FROM hits),
spans AS (SELECT doc_id, min(i) AS lo, max(i) + 50 AS hi FROM islands GROUP BY doc_id, g),
placed AS (
  SELECT doc_id, lo, hi, coalesce(lag(hi) OVER (PARTITION BY doc_id ORDER BY lo), 0) AS before FROM spans),
cut AS (
  SELECT d.doc_id, string_agg(substr(d.h, 2 * p.before + 1, 2 * (p.lo - p.before)), '' ORDER BY p.lo) AS front,
         max(p.hi) AS hi, sum(p.hi - p.lo) AS removed, count(*) AS n
  FROM d JOIN placed p ON p.doc_id = d.doc_id GROUP BY d.doc_id)
SELECT d.doc_id, CAST(length(d.h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(c.removed, 0) AS BIGINT) AS n_removed,
       CAST(coalesce(c.n, 0) AS BIGINT) AS n_spans,
       sha256(unhex(CASE WHEN c.doc_id IS NULL THEN d.h ELSE c.front || substr(d.h, 2 * c.hi + 1) END)) AS kept_sha256
FROM d LEFT JOIN cut c ON c.doc_id = d.doc_id"""


DECONTAMINATION_SQL = """WITH item_words AS (
  SELECT item_id, regexp_extract_all(LOWERED, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM benchmark),
windows AS (
  SELECT item_id, least(len(w), 13) AS n,
         unnest(list_transform(range(1, len(w) - least(len(w), 13) + 2),
                               lambda i: array_to_string(w[i:i + least(len(w), 13) - 1], ' '))) AS s
  FROM item_words WHERE len(w) > 0),
doc_words AS (
  SELECT doc_id, regexp_extract_all(LOWERED, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
sizes AS (SELECT DISTINCT n FROM windows),
places AS (
  SELECT doc_id, n, unnest(range(1, len(w) - n + 2)) AS i, w FROM doc_words JOIN sizes ON len(w) >= n),
hits AS (
  SELECT DISTINCT p.doc_id, p.i, p.n, x.item_id
  FROM (SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS s FROM places) p
  JOIN windows x ON x.n = p.n AND x.s = p.s),
hit_words AS (SELECT doc_id, count(DISTINCT j) AS n_hit FROM (
  SELECT doc_id, unnest(range(i, i + n)) AS j FROM hits) GROUP BY doc_id),
hit_items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(k, ',' ORDER BY k) AS ids
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS k FROM hits WHERE item_id IS NOT NULL) GROUP BY doc_id)
SELECT d.doc_id, CAST(coalesce(len(d.w), 0) AS BIGINT) AS n_words, CAST(coalesce(h.n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(i.n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(i.ids, '')) AS items_sha256,
       coalesce(h.n_hit, 0) > 0 AND 20 * coalesce(h.n_hit, 0) >= len(d.w) AS contaminated
FROM doc_words d LEFT JOIN hit_words h ON h.doc_id = d.doc_id LEFT JOIN hit_items i ON i.doc_id = d.doc_id""".replace(
    "LOWERED", _LOWER)


_WORDS = "regexp_extract_all({0}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
LICENSE_SQL = f"""WITH templates(license, text) AS (VALUES
  {", ".join("('" + n + "', '" + t.replace("'", "''") + "')" for n, t in TEMPLATES.items())}),
t AS (SELECT license, w, least(len(w), 5) AS k, len(w) - least(len(w), 5) + 1 AS places
      FROM (SELECT license, {_WORDS.format(_LOWER)} AS w FROM templates) WHERE len(w) > 0),
t_shingles AS (SELECT DISTINCT license, k, places, array_to_string(w[i:i + k - 1], ' ') AS s
               FROM (SELECT *, unnest(range(1, places + 1)) AS i FROM t)),
t_sizes AS (SELECT license, count(*) AS n FROM t_shingles GROUP BY license),
d AS (SELECT doc_id, {_WORDS.format(_LOWER)} AS w FROM documents),
hits AS (
  SELECT x.doc_id, s.license, x.i, x.n_places, s.places, s.s
  FROM (SELECT doc_id, k, i, len(w) - k + 1 AS n_places, array_to_string(w[i:i + k - 1], ' ') AS s
        FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i
              FROM d, (SELECT DISTINCT k FROM t) WHERE len(w) >= k)) x
  JOIN t_shingles s ON s.k = x.k AND s.s = x.s),
windows AS (
  SELECT doc_id, license, p, count(DISTINCT s) AS shared
  FROM (SELECT *, unnest(range(greatest(1, i - least(places, n_places) + 1), least(i, n_places - least(places, n_places) + 1) + 1)) AS p FROM hits)
  GROUP BY doc_id, license, p)
SELECT w.doc_id, w.license, count(*) AS n_windows, max(w.shared) / CAST(max(z.n) AS DOUBLE) AS containment,
       min(w.p) - 1 AS first_word
FROM windows w JOIN t_sizes z ON z.license = w.license WHERE 100 * w.shared >= 80 * z.n
GROUP BY w.doc_id, w.license"""


_CONTROLS = "'<\\\\*/?s>|\\[\\\\*(/?INST|SYS|/?ROLE)\\]'"
CHAT_FORMAT_SQL = f"""WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '{CONTROL_TEXT}' UNION ALL SELECT -7, 1, 'assistant', '{CONTROL_TEXT}'),
made AS (
  SELECT *, 7 + length(text) + len(regexp_extract_all(text, {_CONTROLS}))
         + CASE role WHEN 'user' THEN 6 WHEN 'assistant' THEN 7 WHEN 'system' THEN 5
           ELSE 13 + length(role) + len(regexp_extract_all(role, {_CONTROLS})) END AS chars
  FROM turns),
loss AS (
  SELECT conv_id, string_agg(text, '' ORDER BY turn NULLS FIRST, text) AS said FROM turns WHERE role = 'assistant' GROUP BY conv_id)
SELECT m.conv_id, CAST(count(*) AS BIGINT) AS n_turns,
       sha256(string_agg(m.role || chr(10) || m.text || chr(10), '' ORDER BY m.turn NULLS FIRST, m.role, m.text)) AS turns_sha256,
       CAST(coalesce(length(any_value(l.said)), 0) AS BIGINT) AS loss_chars, sha256(coalesce(any_value(l.said), '')) AS loss_sha256,
       CAST(sum(m.chars) AS BIGINT) AS formatted_chars
FROM made m LEFT JOIN loss l ON l.conv_id IS NOT DISTINCT FROM m.conv_id GROUP BY m.conv_id"""

#: crc32 of the id's decimal text, bit by bit (fixed value: the reflected polynomial).
_CRC = """xor(4294967295, list_reduce(flatten(list_transform(range(1, length(s) + 1),
    lambda i: list_transform(range(8), lambda k: (ascii(s[i]) >> k) & 1))),
    lambda crc, b: xor(crc >> 1, 3988292384 * (xor(crc, b) & 1)), CAST(4294967295 AS BIGINT)))"""
PREFIX_TRIE_SQL = f"""WITH turns AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, k) AS pos, k, size
  FROM (SELECT conv_id, turn, sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS k,
               strlen(coalesce(text, '')) AS size FROM conversations WHERE conv_id IS NOT NULL)),
heads AS (
  SELECT conv_id, conv_id - conv_id % 5 AS base, {_CRC} % 9 AS h
  FROM (SELECT DISTINCT conv_id, CAST(conv_id AS VARCHAR) AS s FROM conversations WHERE conv_id IS NOT NULL)),
rebuilt AS (
  SELECT h.conv_id, 0 AS part, t.pos, t.k, t.size FROM heads h JOIN turns t ON t.conv_id = h.base AND t.pos <= h.h
  UNION ALL
  SELECT h.conv_id, 1, t.pos, t.k, t.size FROM heads h JOIN turns t ON t.conv_id = h.conv_id AND t.pos > h.h),
placed AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY part, pos) AS depth, k, size FROM rebuilt),
paths AS (
  SELECT conv_id, depth, size, string_agg(k, '/') OVER (PARTITION BY conv_id ORDER BY depth) AS path FROM placed
  UNION ALL SELECT conv_id, 0, 0, '' FROM heads),
ended AS (SELECT conv_id, max(depth) AS depth FROM paths GROUP BY conv_id),
nodes AS (
  SELECT p.depth, p.path, min(p.conv_id) AS conv_id, count(*) AS n, any_value(p.size) AS size,
         sha256(coalesce(string_agg(CAST(p.conv_id AS VARCHAR), ',' ORDER BY p.conv_id) FILTER (WHERE p.depth = e.depth), '')) AS ends
  FROM paths p JOIN ended e ON e.conv_id = p.conv_id GROUP BY p.depth, p.path),
up AS (
  SELECT n.path, n.depth, p.path AS above FROM nodes n
  JOIN paths x ON x.conv_id = n.conv_id AND x.depth = n.depth AND x.path = n.path
  JOIN paths p ON p.conv_id = n.conv_id AND p.depth = n.depth - 1),
kids AS (SELECT above, depth - 1 AS depth, count(*) AS n FROM up GROUP BY ALL),
below AS (
  SELECT p.path AS above, p.depth, n.n, n.size, k.n IS NULL AS leaf
  FROM nodes n JOIN paths p ON p.conv_id = n.conv_id AND p.depth <= n.depth
  LEFT JOIN kids k ON k.above = n.path AND k.depth = n.depth),
sums AS (SELECT above, depth, sum((n - 1) * size) AS saved, count(*) FILTER (WHERE leaf) AS leaves FROM below GROUP BY ALL)
SELECT n.conv_id, n.depth, a.conv_id AS parent_conv_id, CAST(n.n AS BIGINT) AS n_convs, CAST(coalesce(k.n, 0) AS BIGINT) AS n_children,
       CAST(s.leaves AS BIGINT) AS n_leaves, CAST(s.saved AS BIGINT) AS saved_tokens, n.ends AS ends_sha256
FROM nodes n JOIN sums s ON s.above = n.path AND s.depth = n.depth
LEFT JOIN kids k ON k.above = n.path AND k.depth = n.depth
LEFT JOIN up u ON u.path = n.path AND u.depth = n.depth
LEFT JOIN nodes a ON a.path = u.above AND a.depth = n.depth - 1"""


def oracle_sql():
    return {
        "op12_chat_format": CHAT_FORMAT_SQL,
        "op13_conversation_trie": PREFIX_TRIE_SQL,
        "op6_license_scan": LICENSE_SQL,
        "op10_decontamination": DECONTAMINATION_SQL,
        "op2_minhash_near_dedup": NEAR_DEDUP_SQL,
        "op5_suffix_array_dedup": SUFFIX_DEDUP_SQL,
    }
