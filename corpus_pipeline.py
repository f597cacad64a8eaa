"""A corpus pipeline: language, repeated lines, near duplicates, benchmark passages, mixture.

Each stage works on all rows that the one before has kept, and all but the last return the columns
of ``documents``. ``run`` writes every stage to the shared folder, so a lost executor repeats no
earlier stage.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldspark.llm import language, lines, mixing, simhash, tiling
from fieldspark.llm.common import shared_folder, small_batches, table
from fieldspark.llm.queries import TARGETS, labelled_domains, labelled_languages

#: A document is rejected if its language is less likely than not.
LEAST_SCORE = 0.5


def identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is known: not those without a letter, or of no clear language."""
    small_batches(spark)
    predict = language.predictor(labelled_languages(docs))
    found = docs.select(F.struct(*docs.columns).alias("row"), predict(F.col("text")).alias("judged"))
    clear = (F.col("judged.lang_pred") != language.UNKNOWN) & (F.col("judged.score") >= LEAST_SCORE)
    return found.where(clear).select("row.*")


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without later copies of line runs; those that consist of copies alone go."""
    cut = lines.remove_repeated_lines(docs)
    left = cut.where((F.col("n_removed") == 0) | (F.trim(F.translate("text", "\t\n\r", "   ")) != ""))
    return left.select(*(F.char_length("text").cast(kind).alias(c) if c == "n_chars" else F.col(c) for c, kind in docs.dtypes))


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: that with the smallest id."""
    return simhash.one_of_each(docs, words=3, max_bits=3)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.col("text").alias("body"))
    found = tiling.contamination(rows, table(spark, sf_dir, "benchmark"), doc_text="body")
    return found.where(~F.col("contaminated")).select("row.*")


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with their rate in the mixture."""
    small_batches(spark)
    return mixing.mix(docs, labelled_domains(docs, table(spark, sf_dir, "labels")), TARGETS)


STAGES = [
    ("language_id", identified),
    ("line_dedup", without_repeated_lines),
    ("simhash_near_dedup", without_near_duplicates),
    ("benchmark_decontamination", decontaminated),
    ("source_mixing", mixed),
]

#: SQL has neither the models nor the fingerprints; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The result of all stages, applied to ``documents``."""
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
