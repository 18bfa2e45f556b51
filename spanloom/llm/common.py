"""What several operators share: tables, the shared folder, connected components."""

from __future__ import annotations

import uuid

import numpy as np

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from spanloom.sources.files import shared_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame) -> DataFrame:
    """``df`` as a table in the shared folder: cuts the lineage and survives lost executors."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def counted(df: DataFrame) -> tuple[DataFrame, int]:
    """``df`` as a table in the shared folder, and the number of its rows, which is counted as they are written."""
    seen = Observation()
    out = written(df.observe(seen, F.count("*").alias("rows")))
    return out, seen.get["rows"]


def one_per_id(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, text) with null ids left out, null texts empty, and of rows that repeat an id the least text.

    The texts are only shuffled if some id is repeated.
    """
    rows = docs.where(F.col(doc_id).isNotNull()).select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    if rows.groupBy("doc_id").count().where("count > 1").limit(1).count():
        rows = rows.groupBy("doc_id").agg(F.min("text").alias("text"))
    return rows


def without(docs: DataFrame, ids: DataFrame, most: int = 1_000_000) -> DataFrame:
    """``docs`` but the rows whose doc_id (null too) is in ``ids`` (doc_id): sent to all tasks if counted to be no more
    than ``most``, so that texts stay where they are; beyond it both sides are shuffled."""
    gone = unused("gone", docs)
    ids, number = counted(ids.select(F.col("doc_id").alias(gone)).distinct())
    if number <= most:
        ids = F.broadcast(ids)
    return docs.join(ids, F.col("doc_id").eqNullSafe(F.col(gone)), "left_anti")


def unused(name: str, *frames: DataFrame) -> str:
    """``name``, with as many underscores before it as no column of ``frames`` needs."""
    taken = {c.lower() for df in frames for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def components(edges: DataFrame) -> DataFrame:
    """Connected components of ``edges`` (u, v long): one row (id, component) per vertex that has an edge.

    Alternates large-star and small-star steps until the edge set no longer changes; then every vertex
    points to the smallest id of its component. Each round is a written table. Nulls and loops are ignored.
    """
    def table_of(rows: DataFrame) -> tuple[DataFrame, tuple]:
        """The edges, and what tells whether they changed, gathered as they are written."""
        seen = Observation()
        rows = rows.where("m < x").distinct().observe(seen, F.count("*").alias("n"), F.sum(F.xxhash64("m", "x").cast("decimal(38,0)")).alias("sum"))
        return written(rows), tuple(seen.get.values())

    now, before = table_of(edges.select(F.least("u", "v").alias("m"), F.greatest("u", "v").alias("x")))
    while before[0]:
        both = now.select(F.col("x").alias("u"), F.col("m").alias("v")).union(now.select(F.col("m").alias("u"), F.col("x").alias("v")))
        least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
        large = both.where("v > u").join(least, "u").select("m", F.col("v").alias("x")).where("m < x").distinct()
        low = large.groupBy("x").agg(F.min("m").alias("m0"))
        small = large.join(low, "x").select(F.explode(F.array(F.struct("m0", "x"), F.struct("m0", F.col("m").alias("x")))).alias("e"))
        now, after = table_of(small.select(F.col("e.m0").alias("m"), F.col("e.x").alias("x")))
        if after == before:
            break
        before = after
    ids = now.select(F.col("x").alias("id"), F.col("m").alias("component"))
    return ids.union(now.select(F.col("m").alias("id"), F.col("m").alias("component"))).distinct()


def forest(n: int, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """For links between places x and y of n: the least place of each place's component."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[x], label[y])
        new = label.copy()
        for at in (x, y, label[x], label[y]):
            np.minimum.at(new, at, low)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def spanning(label: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Numbers of links between places x and y that join all that the links join, given that places of one label are joined."""
    _, label = np.unique(label, return_inverse=True)
    need: list[np.ndarray] = []
    left = np.arange(len(x))
    while True:
        left = left[label[x[left]] != label[y[left]]]
        if not len(left):
            return np.sort(np.concatenate(need)) if need else left
        # Of each component the first link that leaves it; equal ends are taken once, so no ring is closed but by ties.
        ends = np.r_[label[x[left]], label[y[left]]]
        _, at = np.unique(ends, return_index=True)
        taken = np.unique(left[at % len(left)])
        need.append(taken)
        joined = forest(int(label.max()) + 1, label[x[taken]], label[y[taken]])
        label = joined[label]
