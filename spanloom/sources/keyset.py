"""A data source that pages through a table by its key over any Python database driver, as a batch or a stream.

Options: ``module`` (the driver's module, ``pymysql`` if not given), ``connect`` (JSON of its connect arguments),
``table``, ``id_column``, ``text_column``, ``batch_size``, ``partitions``, ``last_id``, ``retries``, ``retry_wait``.
A batch is dealt out by ranges of the key; each range is read page by page, so a lost connection is taken up
after the last row that came. A stream's offset is the last key; each micro-batch reads up to the largest key.
"""

from __future__ import annotations

import importlib
import json
import time
from collections.abc import Iterator

from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition


class DriverMissing(RuntimeError):
    pass


class KeyRange(InputPartition):
    """Keys after ``low`` up to ``high``."""

    def __init__(self, low: int, high: int):
        super().__init__(None)
        self.low, self.high = low, high


class _Table:
    def __init__(self, options: dict):
        self.module = options.get("module", "pymysql")
        self.arguments = json.loads(options.get("connect", "{}"))
        self.table = options["table"]
        self.id, self.text = options.get("id_column", "id"), options.get("text_column", "content")
        self.size = int(options.get("batch_size", "1000"))
        self.parts = int(options.get("partitions", "1"))
        self.last = int(options.get("last_id", "0"))
        self.retries, self.wait = int(options.get("retries", "5")), float(options.get("retry_wait", "1"))
        for name in (self.table, self.id, self.text):
            if not name.replace("_", "").replace(".", "").isalnum():
                raise ValueError(f"not a plain name: {name}")

    def connect(self):
        try:
            driver = importlib.import_module(self.module)
        except ImportError as e:
            raise DriverMissing(f"the database driver {self.module} is not installed") from e
        return driver.connect(**self.arguments)

    def bounds(self) -> tuple[int, int]:
        connection = self.connect()
        try:
            cursor = connection.cursor()
            cursor.execute(f"SELECT MIN({self.id}), MAX({self.id}) FROM {self.table} WHERE {self.id} > {self.last}")
            low, high = cursor.fetchone()
            return (int(low) - 1, int(high)) if low is not None else (self.last, self.last)
        finally:
            connection.close()

    def rows(self, low: int, high: int) -> Iterator[tuple[int, str | None]]:
        at, failures, connection = low, 0, None
        try:
            while at < high:
                try:
                    connection = connection or self.connect()
                    cursor = connection.cursor()
                    cursor.execute(f"SELECT {self.id}, {self.text} FROM {self.table} WHERE {self.id} > {at} AND {self.id} <= {high} ORDER BY {self.id} LIMIT {self.size}")
                    got = cursor.fetchall()
                except DriverMissing:
                    raise
                except Exception:
                    failures += 1
                    if failures > self.retries:
                        raise
                    connection = None
                    time.sleep(self.wait)
                    continue
                failures = 0
                if not got:
                    break
                for row in got:
                    at = int(row[0])
                    yield at, None if row[1] is None else str(row[1])
        finally:  # also when the reader is given up
            if connection is not None:
                connection.close()


class _Batch(DataSourceReader):
    def __init__(self, options: dict):
        self.table = _Table(options)

    def partitions(self) -> list[KeyRange]:
        low, high = self.table.bounds()
        step = max(1, -(-(high - low) // self.table.parts))
        return [KeyRange(x, min(x + step, high)) for x in range(low, high, step)] or [KeyRange(low, low)]

    def read(self, partition: KeyRange) -> Iterator[tuple]:
        yield from self.table.rows(partition.low, partition.high)


class _Stream(DataSourceStreamReader):
    def __init__(self, options: dict):
        self.table = _Table(options)

    def initialOffset(self) -> dict:
        return {"last_id": self.table.last}

    def latestOffset(self) -> dict:
        return {"last_id": self.table.bounds()[1]}

    def partitions(self, start: dict, end: dict) -> list[KeyRange]:
        low, high = start["last_id"], end["last_id"]
        step = max(1, -(-(high - low) // self.table.parts))
        return [KeyRange(x, min(x + step, high)) for x in range(low, high, step)]

    def read(self, partition: KeyRange) -> Iterator[tuple]:
        yield from self.table.rows(partition.low, partition.high)


class KeysetSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "keyset"

    def schema(self) -> str:
        return "id BIGINT, content STRING"

    def reader(self, schema) -> DataSourceReader:
        return _Batch(dict(self.options))

    def streamReader(self, schema) -> DataSourceStreamReader:
        return _Stream(dict(self.options))


def register(spark: SparkSession) -> None:
    spark.dataSource.register(KeysetSource)
