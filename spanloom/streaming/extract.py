"""The extraction plan as a stream: what is new since the last run, each row once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from spanloom.operators.sinks import CSV
from spanloom.plans.extract import extract
from spanloom.sources import tables


def parquet_documents(spark: SparkSession, path: str, schema: str, id_column: str = "doc_id", text: str = "text", files_per_trigger: int | None = None) -> DataFrame:
    """Documents of a growing folder of Parquet files."""
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return tables.documents(reader.parquet(path), id_column, text)


def keyset_documents(spark: SparkSession, **options: str) -> DataFrame:
    """Documents of a database table past the last key that was read."""
    from spanloom.sources import keyset

    keyset.register(spark)
    return tables.documents(spark.readStream.format("keyset").options(**options).load(), "id", "content")


def start(docs: DataFrame, path: str, checkpoint: str, format: str = "parquet", delimiter: str = "|", **options) -> StreamingQuery:
    """Read what is there, write its rows and stop; a later start with the same checkpoint goes on after it.

    The file sink's log and the checkpoint make each document's rows appear once, also after a failure.
    """
    writer = extract(docs, **options).writeStream.trigger(availableNow=True).option("checkpointLocation", checkpoint).outputMode("append")
    if format == "csv":
        writer = writer.options(sep=delimiter, header="true", **CSV)
    return writer.format(format).option("path", path).start()


def reset(spark: SparkSession, checkpoint: str) -> None:
    """Forget what was read: the next start begins anew."""
    jvm = spark.sparkContext._jvm
    place = jvm.org.apache.hadoop.fs.Path(checkpoint)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)
