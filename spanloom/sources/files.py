"""Small files and folder listings by Hadoop's file systems, so that a path may be in any store that Spark reaches."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, by ``spark.checkpoint.dir``; where a local session names none, one is made."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        found = tempfile.mkdtemp(prefix="spanloom-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found


class Files:
    def __init__(self, spark: SparkSession):
        self._jvm, self._conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()

    def _at(self, path: str):
        place = self._jvm.org.apache.hadoop.fs.Path(path)
        return place, place.getFileSystem(self._conf)

    def read(self, path: str) -> str | None:
        """The whole text of a small file; none if it is missing."""
        place, system = self._at(path)
        if not system.exists(place):
            return None
        stream = system.open(place)
        try:
            return bytes(self._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode("utf-8")
        finally:
            stream.close()

    def write(self, path: str, text: str) -> None:
        """The file appears whole or stays as it was."""
        place, system = self._at(path)
        part, _ = self._at(f"{path}.part")
        stream = system.create(part, True)
        try:
            stream.write(bytearray(text.encode("utf-8")))
        finally:
            stream.close()
        old, _ = self._at(f"{path}.old")
        if system.exists(place):
            system.delete(old, False)
            system.rename(place, old)
        if not system.rename(part, place):
            raise OSError(f"cannot write {path}")

    def data(self, path: str) -> set[str]:
        """Names of the data files in a folder."""
        place, system = self._at(path)
        if not system.exists(place):
            return set()
        return {n for f in system.listStatus(place) if f.isFile() and not (n := f.getPath().getName()).startswith(("_", "."))}

    def delete(self, path: str) -> None:
        place, system = self._at(path)
        system.delete(place, True)
