"""The corpus pipeline: documents through five operators, each stage's rows written and reread.

Toxic documents go; repeated lines stay once; of documents with nearly the same shingles one stays;
documents that contain a test item go; what is left is encoded. Each stage works on all rows that
the one before kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lapsewise.llm import decontamination, jaccard, line_dedup, toxicity
from lapsewise.llm.queries import encoded_pieces, table, toxicity_model
from lapsewise.llm.store import written

#: The fuzzy lines and the learned grammar have no SQL form.
ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.drop_toxic(docs, toxicity_model(docs, table(spark, sf_dir, "labels")))


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return line_dedup.dedup_lines(docs)


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard.keep_one(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontamination.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return encoded_pieces(docs, "ids")


STAGES = [
    ("toxicity", drop_toxic),
    ("line dedup", dedup_lines),
    ("n-gram Jaccard join", keep_one_of_each_group),
    ("benchmark decontamination", drop_contaminated),
    ("SentencePiece encoding and decoding", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply STAGES to the documents of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
