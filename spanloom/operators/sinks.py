"""Result tables as delimited files or Parquet."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

CSV = {"quote": '"', "escape": '"', "encoding": "UTF-8", "emptyValue": "", "nullValue": "", "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}


def write_rows(rows: DataFrame, path: str, format: str = "csv", delimiter: str = "|", mode: str = "append") -> None:
    """Rows into a folder; a task's file appears whole or not at all."""
    if format == "csv":
        rows.write.mode(mode).options(sep=delimiter, header="true", **CSV).csv(path)
    elif format == "parquet":
        rows.write.mode(mode).parquet(path)
    else:
        raise ValueError(f"unknown format {format}")


def read_rows(spark: SparkSession, path: str, schema: str, delimiter: str = "|") -> DataFrame:
    """Delimited rows as they were written; quoted line breaks included."""
    return spark.read.schema(schema).options(sep=delimiter, header="true", multiLine="true", **CSV).csv(path)
