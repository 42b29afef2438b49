"""The corpus pipeline: quality rules, quality classifier, near-duplicates, mixing to target weights, SentencePiece encoding.

Each stage works on all that the one before it kept, and what it decides takes effect: rejected documents go, one document of
each group of near-duplicates stays, documents are repeated and cut as the mix asks, and texts become piece ids. All stages but
the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parlance.llm import minhash, mix, pieces, quality_classifier, quality_rules
from parlance.llm.common import fresh, stash, table

#: Documents that the quality classifier scores lower are rejected, as its query calls them bad.
LEAST_QUALITY = 0.7


def keep_by_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    trusted = quality_rules.trusted_ids(table(spark, sf_dir, "labels"))
    (out,) = fresh(docs, ["quality"])
    judged = quality_rules.quality_rules(docs, trusted, out=out)
    return judged.where(F.col(f"{out}.kept")).select(*docs.columns)


def keep_by_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("key"), F.col("quality").alias("label"))
    (out,) = fresh(docs, ["score"])
    scored = quality_classifier.score(docs, quality_classifier.fit(docs, labels), out=out)
    return scored.where(F.col(out) >= LEAST_QUALITY).select(*docs.columns)


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return minhash.drop_near_duplicates(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mix.mixed(docs)


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The columns of documents, ids (piece ids) and round_trip (1 where decoding gives the text back)."""
    return pieces.encode(docs, out="ids", check="round_trip")


STAGES = [
    ("quality rules", keep_by_rules),
    ("quality classifier", keep_by_classifier),
    ("MinHash near-dedup", keep_one_of_each),
    ("mixing to target weights", mix_sources),
    ("SentencePiece encoding", encode_pieces),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = stash(docs)
    return docs
