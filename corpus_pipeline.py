"""A corpus from raw documents to packed sequences, in five stages.

Every stage takes ``(spark, docs, sf_dir)``, works on all rows it is given and, but
for the last, returns the columns of documents; further columns stay as they are,
whatever their names.  Null and empty texts have no language and leave in the first
stage; texts may be of any length; repeated rows count as one from the second stage
on.  Empty tables stay empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pressmill.llm import langid, mixing, packing, pii, simhash
from pressmill.llm.common import learned
from pressmill.session import write_between


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of a known language; those the classifier rejects go."""
    model = langid.fit(docs, learned("doc_id", 5))
    return langid.keep_known(docs, model)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return simhash.keep_one(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with personal data replaced by its kind; ``n_chars`` stays that of the input."""
    return pii.redact(docs, pii.fit(docs))


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated so that sources meet their weights, in random order."""
    return mixing.mix(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents and their places in sequences."""
    return packing.pack_documents(docs)


STAGES = [
    ("language_id", language_id),
    ("simhash_near_dedup", simhash_near_dedup),
    ("personal_data", personal_data),
    ("source_mixing", source_mixing),
    ("best_fit_packing", best_fit_packing),
]

# Language identification and fingerprints cannot be said in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = write_between(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
