"""The corpus pipeline: five stages, each over all that the stage before kept.

Quality rules drop documents, line dedup cuts repeated runs of lines from texts, MinHash
near-dedup keeps one document of each group, decontamination drops documents
that hold test items, and mixing says how many words of each document to take.
Every stage but the last returns the columns of documents.

Null texts fail the quality rules; rows that the first stage keeps have an id
that its own verdict names, so a null id is dropped there.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ledgerline.llm.common import forget, only_ids, table, written
from ledgerline.llm.decontamination import remove_contaminated
from ledgerline.llm.line_dedup import line_dedup
from ledgerline.llm.minhash import near_duplicates
from ledgerline.llm.mixing import mix
from ledgerline.llm.quality_rules import quality_rules


def _only(docs: DataFrame, verdict: DataFrame) -> DataFrame:
    """The documents whose id the verdict keeps; texts stay in place while the ids are few enough to broadcast."""
    return only_ids(docs, written(verdict.where("kept and doc_id is not null").select("doc_id").distinct(), "kept-ids"))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _only(docs, quality_rules(docs, table(spark, sf_dir, "labels")))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return line_dedup(docs, runs=True, counts=False)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _only(docs, near_duplicates(docs))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return remove_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mix(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality rules", quality),
    ("line dedup", lines),
    ("MinHash near-dedup", near),
    ("benchmark decontamination", decontaminate),
    ("mixing", mixture),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each stage's rows are written and read again."""
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
        if before is not None:  # nothing reads it again
            forget(before)
        before = docs
    return STAGES[-1][1](spark, docs, sf_dir)


#: A forest's verdict and a learned threshold are beyond SQL; tests hold the stages against plain loops.
ORACLE_SQL = None
