"""A training corpus from documents: quality filter, exact and near-duplicate removal, mixing, packing.

Each stage takes (spark, docs, sf_dir) and all rows that its predecessor kept; all but the last return the columns of
documents. Packing can't be told in SQL, nor can the classifier's fit, so ORACLE_SQL is None and tests hold each stage
against a brute-force version. A document that the mix takes several times is that many rows.

Defined cases, at every stage: a null text counts as empty; texts without words go with the first stage; documents of
any length stay whole; rows with null or repeated doc_ids are told apart by their text; rows equal in doc_id and text
are one document after the exact dedup; ties go as each operator tells; other columns stay, whatever their names; an
empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from intervox.llm import exact_dedup, jaccard_join, mixing, packing, quality
from intervox.llm.common import discard, table, written
from intervox.llm.queries import tokenizer_path


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.good_documents(docs, table(spark, sf_dir, "labels"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.keep_first_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard_join.one_of_each_class(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_documents(docs)


def pack_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, tokenizer_path())


STAGES = [
    ("quality classifier", keep_good),
    ("exact dedup", drop_copies),
    ("n-gram Jaccard join", drop_near_copies),
    ("mixing sources to target weights", mix_sources),
    ("packing", pack_documents),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed pieces of documents after all stages."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        done, docs = docs, written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
        discard(done)
    return STAGES[-1][1](spark, docs, sf_dir)
