"""A training-data pipeline over the documents: five stages, each written and read again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from marketstrata.llm import decontaminate, packing, secrets, simhash, toxicity
from marketstrata.llm.common import table
from marketstrata.llm.queries import tokenizer_path
from marketstrata.session import stored


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the toxicity model does not reject; it learns from the labelled ones among them.

    NULL and empty texts are judged like others. Without enough labels nothing is rejected.
    """
    return toxicity.drop_toxic(docs, toxicity.train_toxicity(docs, table(spark, sf_dir, "labels")))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the least id of each SimHash group; repeated rows of one id stay one row.

    A document with a NULL id names no group and cannot be told from others, so it stays, whatever its group.
    """
    groups = simhash.simhash_groups(docs.select("doc_id", "text"), width=3, seed=42, budget=3)
    firsts = groups.filter("component_id = doc_id").select("doc_id").distinct()
    named = docs.filter("doc_id IS NOT NULL").join(firsts, "doc_id", "left_semi")
    return named.dropDuplicates(["doc_id"]).unionByName(docs.filter("doc_id IS NULL")).select(*docs.columns)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item, NULL and empty texts included; an empty benchmark drops nothing."""
    return decontaminate.drop_leaking(docs, decontaminate.fit_leak_finder(docs, table(spark, sf_dir, "benchmark")))


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with their secrets blotted out; NULL texts stay NULL."""
    return secrets.redact_secrets(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the packed sequences; NULL and empty texts are an end sign alone."""
    return packing.pack_documents(docs, tokenizer_path())


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash_near_dedup", drop_near_copies),
    ("benchmark_decontamination", drop_leaks),
    ("secret_scans", redact),
    ("packing", pack),
]

#: SQL cannot express the classifier, the latent search and the tokenizer; the stages are tested by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order; every result but the last is written to the shared folder and read again.

    Repeated rows of one id leave one row, whole long texts pass every stage, further columns are carried along.
    Empty tables give an empty result.
    """
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
