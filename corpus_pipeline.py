"""Corpus pipeline: five stages from raw documents to a weighted mix.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; between
stages the documents are written as Parquet and read again. All but the last
stage return the columns of ``documents``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import decontam, jaccard, linededup, mixing, toxicity
from tessera.llm.text import read
from tessera.session import ensure_checkpoint_dir


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity grammar scores below its threshold."""
    return toxicity.drop_toxic(docs, read(spark, sf_dir, "labels"))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that an earlier line equals or nearly equals, long
    lines of few words included where they are equal; a document that loses all
    of its lines goes. ``n_chars`` follows the text."""
    clean = linededup.dedupe_lines(docs, min_chars=linededup.MIN_CHARS).where("_n_removed = 0 OR text <> ''")
    if "n_chars" in docs.columns:
        clean = clean.withColumn("n_chars", F.when(F.col("_n_removed") > 0, F.char_length("text").cast("long")).otherwise(F.col("n_chars")))
    return clean.select(*docs.columns)


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest doc_id, of each group of near copies."""
    return jaccard.keep_one_per_class(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no window of a benchmark item occurs."""
    return decontam.drop_contaminated(docs, read(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sizes, targets and words taken of every document left."""
    mixed = mixing.mix_sources(docs.select("doc_id", "source", "text"), keep_text=False)
    return mixed.select("doc_id", "source", F.col("_size").alias("size"), F.col("_source_size").alias("source_size"),
                        F.col("_target").alias("target"), F.col("_copies").alias("copies"), F.col("_taken").alias("taken"))


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("jaccard_join", keep_one_of_near_copies),
    ("decontamination", drop_contaminated),
    ("mixing", mix),
]

#: the toxicity model and the seeded mix have no SQL form; tests hold the stages against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, with a written table after each but the last."""
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
