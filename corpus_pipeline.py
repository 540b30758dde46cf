"""From documents to packed training sequences, in five stages over Parquet tables.

Each stage takes (session, documents, folder of the tables) and returns the rows for the next; all
but the last return the columns of ``documents``. ``run`` writes each result and reads it back.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from creditloom.llm import line_dedup, mixing, packing, quality_rules, simhash
from creditloom.llm.common import rest_of, restored
from creditloom.llm.queries import byte_bpe
from creditloom.session import written


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules and the boosted trees keep; the others go."""
    labels = spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet")
    trees = quality_rules.fit_rules(docs, labels)
    rows = docs.select(rest_of(docs, "text").alias("row"), "text")
    judged = quality_rules.judged(rows, trees, keys=("row", "text"))
    return restored(judged.where("kept"), docs, "row", text=F.col("text"))


def own_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that ten documents or more share stay at their first occurrence alone.

    What is left of further copies is for the next stage, which keeps one of each group.
    """
    return line_dedup.deduplicated(line_dedup.drop_common_lines(docs, keep="first"), docs)


def distinct_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that shares 80 % of its five-word shingles."""
    return simhash.one_of_each(docs)


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources mixed to weights 5, 2, 1; a document stands as often as the mix takes it."""
    return mixing.training_order(docs)


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 1024 tokens with their sequence and place in it."""
    return packing.pack(packing.tokenised(docs, **byte_bpe()))


STAGES = [
    ("quality rules", good_documents),
    ("line dedup", own_lines),
    ("SimHash near-dedup", distinct_documents),
    ("mixing sources to target weights", mixed_sources),
    ("best-fit packing", packed_sequences),
]

#: SQL has no trained trees, fingerprints or tokenizer; the stages are tested by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The result of the last stage for the documents in ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
