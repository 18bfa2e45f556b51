"""From raw documents to a training mix: five stages, each over all that the one before kept.

Rows of a null doc_id pass the near-duplicate stage, as they belong to no document that could be compared; rows that share an
id stay or go together there and in decontamination. Null and empty texts, and texts without a letter, have no language that could be
recognised and go in the first stage. Equal rows are rows of their own until near-duplicates go. Texts are read whole, however long. Further
columns are kept as they are, whatever their names, but that the last stage's ``domain``, ``n_tokens`` and ``epoch`` replace columns of
these names. Empty tables give empty tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spanloom.llm import decontamination, language_id, line_templates, minhash_dedup, mixing
from spanloom.llm.common import table, unused, without, written


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language the classifier recognises."""
    model = language_id.train(docs)
    language = unused("language", docs)
    seen = docs.withColumn(language, language_id.predict(model, F.col("text")))
    return seen.where(~F.col(language)["rejected"]).drop(language)


def without_boilerplate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without their recurring lines."""
    out = line_templates.drop_templates(docs, counts=False)
    return out.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else out


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    gone = minhash_dedup.near_duplicates(docs).where(~F.col("kept"))
    return without(docs, gone).select(*docs.columns)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of the benchmark."""
    return decontamination.clean(docs, table(spark, sf_dir, "benchmark")).select(*docs.columns)


def to_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the target weights take them."""
    return mixing.mixed(docs)


STAGES = [
    ("language", known_language),
    ("lines", without_boilerplate),
    ("near_duplicates", without_near_duplicates),
    ("decontamination", without_benchmark),
    ("mixing", to_weights),
]

#: The classifier is not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in turn; each is written as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir))
    return docs
