"""The corpus pipeline: documents to token ids in five stages, each one operator.

Every stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame that is
written as Parquet and read again for the next one; all but the last return the
columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from settlekit.llm.blocks import crc_mod, shared_table, ship
from settlekit.llm.decontaminate import drop_contaminated
from settlekit.llm.language_id import fit_language_model, identify
from settlekit.llm.near_dedup import drop_near_duplicates
from settlekit.llm.pieces import encode
from settlekit.llm.queries import piece_model
from settlekit.llm.suffix_dedup import suffix_dedup


def _riding(docs: DataFrame, step) -> DataFrame:
    """``step`` over ``docs``, with the columns it does not read under names that no operator
    gives, so that columns of any name come through as they were."""
    names = {c: f"rides{i}" for i, c in enumerate(docs.columns) if c not in ("doc_id", "text", "lang")}
    out = step(docs.withColumnsRenamed(names))
    return out.select(*[F.col(f"`{names.get(c, c)}`").alias(c) for c in docs.columns])


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is identified; the model learns from two thirds of the labelled ones."""
    ship(spark)
    model = fit_language_model(docs.where(crc_mod("doc_id", 3) != 1))
    return _riding(docs, lambda d: identify(d, model).where("accepted"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (five-word shingles, 0.8)."""
    ship(spark)
    return _riding(docs, drop_near_duplicates)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without passages that an earlier document holds; a document of which nothing is left goes."""
    ship(spark)

    def cut(d: DataFrame) -> DataFrame:
        left = suffix_dedup(d).where("n_removed = 0 OR length(kept_text) > 0")
        return left.withColumn("text", F.col("kept_text"))

    out = _riding(docs, cut)
    return out.withColumn("n_chars", F.length("text").cast("bigint")) if "n_chars" in docs.columns else out


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by the benchmark, unchanged."""
    ship(spark)
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return _riding(docs, lambda d: drop_contaminated(d, benchmark))


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as SentencePiece ids, with the flag whether the ids decode to the text again."""
    ship(spark)
    return encode(docs, piece_model(), check=True)


STAGES = [("language_id", language), ("near_dedup", near_duplicates), ("suffix_dedup", repeated_passages),
          ("decontamination", benchmark_passages), ("sentencepiece", token_ids)]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = shared_table(spark, stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
