"""Scans of (id, content) tables and what is asked of them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType


def text_column(table: DataFrame, id_column: str, preferred: str = "content") -> str:
    """The preferred text column if the table has it, else its first string column besides the id."""
    if preferred in table.columns:
        return preferred
    found = next((f.name for f in table.schema if f.name != id_column and isinstance(f.dataType, StringType)), None)
    if found is None:
        raise ValueError("the table has no text column")
    return found


def documents(table: DataFrame, id_column: str = "id", preferred: str = "content") -> DataFrame:
    """``table`` as (doc_id, text); rows without an id or text are left out."""
    text = text_column(table, id_column, preferred)
    out = table.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return out.where(F.col("doc_id").isNotNull() & F.col("text").isNotNull())


def spread(docs: DataFrame, least: int | None = None) -> DataFrame:
    """``docs`` in ``least`` partitions or more (as many as cores, unless given): a small corpus in few files is dealt out, a large one stays
    as it is read."""
    least = least or docs.sparkSession.sparkContext.defaultParallelism
    return docs.repartition(least) if docs.rdd.getNumPartitions() < least else docs


def after(docs: DataFrame, last_id: int) -> DataFrame:
    """Documents past an id; the predicate reaches the scan."""
    return docs.where(F.col("doc_id") > last_id)


def page(docs: DataFrame, last_id: int, size: int) -> DataFrame:
    """The next ``size`` documents past an id, in order."""
    return after(docs, last_id).orderBy("doc_id").limit(size)


def total_count(docs: DataFrame) -> DataFrame:
    return docs.agg(F.count("*").alias("total"))


def max_id(docs: DataFrame) -> DataFrame:
    """The largest id; 0 if there is none."""
    return docs.agg(F.coalesce(F.max("doc_id"), F.lit(0)).cast("long").alias("max_id"))


def jdbc(spark: SparkSession, url: str, table: str, id_column: str, low: int, high: int, partitions: int, fetch: int = 1000, **options: str) -> DataFrame:
    """A table over JDBC, dealt out by ranges of its id."""
    reader = spark.read.format("jdbc").options(url=url, dbtable=table, partitionColumn=id_column, lowerBound=low, upperBound=high, numPartitions=partitions, fetchsize=fetch)
    return reader.options(**options).load()
