"""Corpus pipeline: STAGES in order, each written as Parquet and read again as the next one's documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weirflow.llm import decontam, nearcopies, pieces, quality, windowdedup
from weirflow.llm.common import stored
from weirflow.llm.queries import piece_model
from weirflow.session import load

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that the compression classifier scores below 0.5."""
    scored = quality.classify(docs.select(*COLUMNS), load(spark, sf_dir, "labels"))
    return scored.where("predicted = 1").select(*COLUMNS)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document, that with the smallest id, of each component of near copies: SimHash pairs within a ball and pairs
    further apart, all with a five-word shingle similarity of 0.8 or more."""
    return nearcopies.representatives(docs.select(*COLUMNS))


def substring_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes out words of windows that start earlier in the corpus; a text that loses none stays as it is, and no document goes."""
    cut = windowdedup.deduplicate(docs.select(*COLUMNS))
    text = F.when(F.col("n_removed") > 0, F.col("kept")).otherwise(F.col("text"))
    chars = F.when(F.col("n_removed") > 0, F.length("kept").cast("bigint")).otherwise(F.col("n_chars"))
    return cut.select("doc_id", text.alias("text"), "lang", "source", chars.alias("n_chars"))


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents with a word inside an occurrence of a benchmark window."""
    judged = decontam.contamination(docs.select(*COLUMNS), load(spark, sf_dir, "benchmark"))
    return judged.where(~F.col("contaminated")).select(*COLUMNS)


def pieces_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every document's pieces, and whether decoding them gives the text again."""
    return pieces.round_trip(docs.select("doc_id", "text"), piece_model()).select("doc_id", "n_pieces", "ids", "exact")


STAGES = [
    ("quality", quality_stage),
    ("near_dedup", near_dedup_stage),
    ("substring_dedup", substring_stage),
    ("decontamination", decontamination_stage),
    ("sentencepiece", pieces_stage),
]

# zstandard sizes, XXH64 and a tokenizer's vocabulary have no SQL; tests hold each stage against a brute-force version
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
