"""The corpus pipeline: five stages over ``documents``, each one of the operators of ``tidemark.llm``.

A stage takes (spark, docs, sf_dir) and returns the documents it keeps, with their columns; the last returns the
training order of the mix (the documents' columns plus mix_epoch, mix_words, mix_position).  Every stage's result is written
as Parquet in the shared folder and read again, so a lost executor costs a stage's tasks and not the run.

Nulls, repeated rows, empty tables and extra columns are as the operators define them: null and empty texts pass the quality
stage by their shape alone, have no lines, form one near-duplicate group (fingerprint zero) of which one row stays, contain no
test item, and have size 0 in the mix, which gives them no training row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import materialize, table
from tidemark.llm.op2_simhash import keep_one
from tidemark.llm.op3_lines import dedup_lines
from tidemark.llm.op5_quality import accepted
from tidemark.llm.op7_decontaminate import decontaminate
from tidemark.llm.op8_mixing import training_order


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that the quality classifier rejects."""
    return accepted(docs, table(spark, sf_dir, "labels"), F.col("source"), F.col("lang"))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Take out lines that repeat, exactly or nearly."""
    return dedup_lines(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of every SimHash component (shingles of 4 words, at most 4 differing bits)."""
    return keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that contain a test item."""
    return decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The training order of the documents under the sources' weight schedules."""
    return training_order(docs)


STAGES = [("quality", quality), ("lines", lines), ("near_duplicates", near_duplicates),
          ("decontamination", decontamination), ("mix", mix)]

#: Fuzzy line components, trained classifiers and XXH64 fingerprints cannot be written in SQL; tests/llm holds the
#: stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
