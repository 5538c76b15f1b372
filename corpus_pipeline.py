"""A training corpus from raw documents: five stages, each on all that the one before kept.

Quality classifier, n-gram Jaccard join, personal data, mixing sources, SentencePiece. Every stage is written as
Parquet and read again, so a lost executor repeats tasks of one stage only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from airlattice.llm import budget, factorise, jaccard, pieces, private
from airlattice.llm.common import fresh, new_folder, ship_package, table
from airlattice.llm.queries import PIECES

#: SQL can express neither a trained model nor a trellis; tests compare with brute-force versions.
ORACLE_SQL = None


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the factorisation machine predicts to be good."""
    ship_package(spark)
    machine = factorise.train(docs, table(spark, sf_dir, "labels"))
    name, = fresh(docs, "quality_score")
    scored = factorise.score_quality(docs, machine)
    return scored.where(F.col(f"{name}.predicted") == 1).drop(name)


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, the one with the smallest doc_id."""
    ship_package(spark)
    return jaccard.keep_one_each(docs, jaccard.join_similar(docs))


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Identifiers in the texts become placeholders; n_chars follows the new text where it is a column."""
    ship_package(spark)
    masked = private.mask_personal(docs)
    return masked.withColumn("n_chars", F.char_length("text").cast("long")) if "n_chars" in docs.columns else masked


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    ship_package(spark)
    return budget.apply_mix(docs, budget.mix_sources(docs))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of every document, and whether they decode to its text."""
    ship_package(spark)
    both = pieces.encode_pieces(docs.select("doc_id", "source", "text"), PIECES)
    return both.select("doc_id", "source", F.size("ids").cast("long").alias("n_pieces"), "ids", "same")


STAGES = [
    ("quality classifier", keep_quality),
    ("n-gram Jaccard join", keep_one_of_each_group),
    ("personal data", mask_personal_data),
    ("mixing sources", mix),
    ("SentencePiece", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir.rstrip("/"), "documents")
    for name, stage in STAGES:
        path = new_folder(spark, "stage-" + "".join(c if c.isalnum() else "-" for c in name))
        stage(spark, docs, sf_dir.rstrip("/")).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
