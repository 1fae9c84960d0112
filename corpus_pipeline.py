"""From raw documents to a training mix: every stage calls one operator of ``tallyline.llm``.

Each stage takes ``(spark, docs, sf_dir)`` and returns rows of ``docs``; its
result is written as Parquet to the cluster's shared folder and read again as
the next one's input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallyline.llm import decontaminate, mixing, pii, simhash, toxicity
from tallyline.llm.base import Scratch, table


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the toxicity model, trained on this stage's input, does not reject."""
    return toxicity.drop_toxic(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose fingerprints link at the contract's distance."""
    return simhash.drop_near_copies(docs, simhash.SHINGLE, simhash.DISTANCE)


def without_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.drop_leaks(docs, table(spark, sf_dir, "benchmark"))


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data replaced by its kind."""
    return pii.redact(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it, with the number of the copy."""
    return mixing.apply_mix(docs)


STAGES = [
    ("toxicity", without_toxic), ("simhash near-dedup", without_near_copies), ("benchmark decontamination", without_leaks),
    ("pii", without_personal_data), ("mixing", mixed),
]

#: Learned and iterative stages have no SQL; the tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole table of documents."""
    docs = table(spark, sf_dir, "documents")
    with Scratch(spark) as scratch:
        for k, (_, stage) in enumerate(STAGES):
            made = stage(spark, docs, sf_dir)
            docs = scratch.keep(made, "corpus") if k + 1 == len(STAGES) else scratch.write(made, "corpus")
    return docs
