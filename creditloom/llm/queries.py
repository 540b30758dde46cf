"""The registered queries of this folder; each takes a session and the folder of the tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from creditloom.llm import (
    conversations,
    language,
    licenses,
    line_dedup,
    mixing,
    packing,
    quality_model,
    quality_rules,
    simhash,
    spelling,
    sql,
    topk,
    warc,
    winnowing,
)


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def _fold(folds: int) -> Column:
    """The fold of a document, from the checksum of its id as text; -1 for a null id."""
    checksum = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    return F.coalesce(checksum % folds, F.lit(-1))


def op1_warc_archive(spark: SparkSession, folder: str) -> DataFrame:
    return warc.page_report(warc.write_archive(_table(spark, folder, "pages")))


def op2_curriculum_mix(spark: SparkSession, folder: str) -> DataFrame:
    """``position_ppb`` is the training time in billionths."""
    mixed = mixing.mix(_table(spark, folder, "documents"))
    return mixed.select(
        "doc_id",
        "size",
        "source_size",
        "target",
        "taken",
        F.floor(F.col("position") * 1e9).alias("position_ppb"),
    )


def byte_bpe() -> dict[str, str]:
    """The tokenizer of the packing query: files of a package that every executor has."""
    import public_tokenizers

    return {
        "tokenizer": public_tokenizers.path("byte_bpe_50k.json"),
        "ranks": public_tokenizers.path("byte_bpe_50k.tiktoken"),
        "pattern": public_tokenizers.PATTERN,
    }


def op3_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    found = language.predicted(docs, language.dictionaries(docs.where(_fold(5) != 0)))
    return found.select("doc_id", (_fold(5) == 0).alias("held_out"), "lang_pred", "score", "accepted")


def op4_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.scan(_table(spark, folder, "documents"))


def op5_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(packing.tokenised(_table(spark, folder, "documents"), **byte_bpe()))


def op6_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = _table(spark, folder, "documents"), _table(spark, folder, "labels")
    weights = quality_model.learn(docs, labels.where(_fold(4) != 2))
    return quality_model.scored(docs, weights).select(
        "doc_id",
        (_fold(4) == 2).alias("held_out"),
        "score",
        (F.col("score") >= 0.7).cast("int").alias("predicted"),
    )


def op7_simhash_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(_table(spark, folder, "documents"))


def op8_exact_top_k(spark: SparkSession, folder: str) -> DataFrame:
    vectors = topk.quantised(_table(spark, folder, "embeddings"))
    return topk.top_k(vectors.where("vec_id % 50 = 0"), vectors)


def op9_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    trees = quality_rules.fit_rules(docs, _table(spark, folder, "labels"))
    return quality_rules.judged(docs, trees).drop("score")


def op10_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    return line_dedup.line_report(line_dedup.drop_common_lines(docs))


def op11_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    return conversations.repair_report(
        conversations.damaged(_table(spark, folder, "conversations"))
    )


def op12_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    return spelling.spelling_variants(spelling.word_counts(_table(spark, folder, "documents")))


def op13_document_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return winnowing.edit_report(_table(spark, folder, "documents"))


def callables() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: f for name, f in globals().items() if name.startswith("op") and callable(f)}


def statements() -> dict[str, str]:
    return {name: text for name, text in vars(sql).items() if name.startswith("op")}
