"""A corpus through five operators, each stage resting as a table before the next.

language     documents whose language is not recognised go
duplicates   one document of each class of near duplicates stays
benchmark    documents with a benchmark item go
personal     personal data is replaced by its kind; no document goes
mixture      documents are repeated to their source's weight, numbered by ``copy``

All stages but the last return the columns of documents. No stage limits its
input, and an empty table passes through all of them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.llm import decontaminate, jaccard_join, langid, mixing, pii
from tidewatch.llm.common import rest, table


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    guessed = langid.predict(F.col("text"), langid.fit(docs))
    marked = docs.select(F.struct(*docs.columns).alias("row"), guessed.alias("language"))
    return marked.where(~F.col("language.rejected")).select("row.*")


def duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard_join.keep_one(docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.drop_leaks(docs, table(spark, sf_dir, "benchmark"))


def personal(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pii.redact(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs)


STAGES = [
    ("language", language),
    ("duplicates", duplicates),
    ("benchmark", benchmark),
    ("personal", personal),
    ("mixture", mixture),
]

#: Trained models and hash draws have no SQL form; tests hold the rows against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = rest(stage(spark, docs, sf_dir), f"pipeline_{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
