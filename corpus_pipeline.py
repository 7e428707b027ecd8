"""From raw documents to token ids: each stage is written and read again before the next.

All stages but the last keep the columns of their documents, whatever else these are called, and give no rows for an empty table. Rows without text have
nothing to object to and stay. Very long texts are worked on whole, in one row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from precinct.llm import bpe, decontaminate, near_dups, pii, toxicity
from precinct.llm.common import Scratch, table
from precinct.llm.queries import VOCABULARY


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The ordinal model is fitted on the labelled documents; those it rejects go.

    Rows are judged one by one: null and empty texts stay, repeated rows go or stay together. Without labels of both kinds all rows stay.
    """
    return toxicity.accepted(docs, toxicity.train(spark, docs, table(spark, sf_dir, "labels")))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of near duplicates stays: five-word shingles, similarity 0.8.

    It is the one of the smallest id. Texts without words are no duplicates of each other, rows without id are nobody's and stay, and of several rows of an id the
    first by text stays.
    """
    return near_dups.deduplicated(spark, docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go.

    Items without words or id have no windows. Rows are judged one by one, with null or repeated ids too. Without items all rows stay.
    """
    return decontaminate.remove_contaminated(spark, docs, table(spark, sf_dir, "benchmark"))


def sanitise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is masked, and terms that reveal it are generalised or removed.

    Null texts stay null, no row goes, and equal rows get equal texts. n_chars follows the new text.
    """
    return pii.sanitised(spark, docs)


def tokenise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids and the text decoded from them, a row per row; null and empty texts have no tokens."""
    return bpe.encode_decode(docs, VOCABULARY)


STAGES = [
    ("toxicity", reject_toxic),
    ("near_dedup", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("pii", sanitise),
    ("bpe", tokenise),
]

#: No stage but decontamination can be said in SQL as a whole; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, scratch, before = table(spark, sf_dir, "documents"), Scratch(spark), None
    for name, stage in STAGES[:-1]:
        docs = scratch.write(stage(spark, docs, sf_dir), name)
        if before:
            scratch.drop(before)
        before = name
    return STAGES[-1][1](spark, docs, sf_dir)
