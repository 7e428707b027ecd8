"""The operators of this folder as queries over the given tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from precinct.llm import alignment, audit, bpe, decontaminate, hashing, licenses, lm, near_dups, pii, sharding, substrings, topk, toxicity
from precinct.llm.common import table

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
BYTE_LEVEL, PIECES = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("row")


def op2_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substrings.deduplicated(spark, table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.graded(docs, toxicity.train(spark, docs, table(spark, sf_dir, "labels")))


def op4_near_dups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dups.components(spark, table(spark, sf_dir, "documents"))


def op5_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents")).drop("places")


def op6_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.search(spark, table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents"), VOCABULARY)


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(spark, table(spark, sf_dir, "documents"))


def op9_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.scores(spark, table(spark, sf_dir, "documents"))


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digests(pii.find(spark, table(spark, sf_dir, "documents")))


def op11_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hashing.search(spark, table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op12_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.aligned(spark, table(spark, sf_dir, "documents"), alignment.Vocabularies.load(BYTE_LEVEL, PIECES))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (op1_decontamination, op2_substrings, op3_toxicity, op4_near_dups, op5_licenses, op6_topk, op7_bpe, op8_sharding, op9_lm, op10_pii,
              op11_neighbours, op12_audit, op13_alignment)
}
ORACLE_SQL: dict[str, str] = {
    "op1_decontamination": decontaminate.SQL, "op2_substrings": substrings.SQL, "op4_near_dups": near_dups.SQL, "op6_topk": topk.SQL, "op12_audit": audit.SQL,
}
