"""A training corpus from raw documents: each stage works on what the one before it kept.

Every stage takes ``(spark, docs, sf_dir)``; all but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pledgewise.llm import decontaminate, linededup, neardup, quality, sentencepieces
from pledgewise.llm.common import read, use_checkpoints

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def drop_poor(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject (score 0.3 or more)."""
    return quality.keep_good(docs.select(*COLUMNS), read(spark, sf_dir, "labels"))


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that repeat a three-line window seen before; texts of fewer than three lines stay."""
    return linededup.dedup_lines(docs, carry=("lang", "source")).withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of texts linked by a similarity of 0.8 or more on five-word shingles, the least by (id, hash of the text)."""
    return neardup.drop_near_duplicates(docs.select(*COLUMNS))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by the benchmark, each row judged by its own text."""
    judged = decontaminate.decontaminate(docs, read(spark, sf_dir, "benchmark"), carry=("lang", "source", "n_chars"))
    return judged.where("not contaminated").select(*COLUMNS)


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, n_tokens, ids, decoded_sha256, round_trip``."""
    return sentencepieces.encode_and_check(docs).select("doc_id", "n_tokens", "ids", "decoded_sha256", "round_trip")


STAGES = [
    ("quality classifier", drop_poor),
    ("line dedup", dedup_lines),
    ("simhash near-dedup", drop_near_duplicates),
    ("benchmark decontamination", drop_contaminated),
    ("sentencepiece encoding", encode_pieces),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    use_checkpoints(spark)
    docs = read(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = stage(spark, docs, sf_dir).checkpoint()  # the next stage reads its documents more than once
    return STAGES[-1][1](spark, docs, sf_dir)


#: SQL has neither the classifier nor the fingerprints and pieces; the tests hold every stage against a plain version.
ORACLE_SQL = None
