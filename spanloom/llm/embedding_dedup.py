"""Near-duplicate vectors within a label, by a subspace pigeonhole join verified in double precision.

Unit vectors of cosine c are sqrt(2 - 2c) apart. The vectors are rotated, so that coordinates are uncorrelated, and split into ``blocks`` of
coordinates that get the widest ones in turn; if two are within the distance, then in at least one block they are within the block's
proportional part of the squared distance. Each block is range-joined on a grid over its first ``plane`` coordinates, which are its
widest: a vector is held at home in its cell and visits the later cells that its range reaches, so every pair within range
meets exactly once in a block, where the block's whole squared distance is compared. A pair that passes is a candidate of the
first block in which it does, and only there is it verified, by the cosine of the whole vectors; so the union of the candidates is
verified without being gathered. The rotation is fitted on a sample of ``sample`` components in expectation; it decides how
much the grid prunes, never what is found.

The grid prunes as far as the vectors of a label spread over more than the range in some directions. Where they fill all directions alike
(random vectors) a range is nearly as wide as a coordinate, and the vectors compared within a label stay a fixed share of
all pairs, a matrix product of a block's coordinates; rows shuffled are linear in any case but for cells of more than ``tile`` vectors.

Equal vectors of a label are one class with a count. A cell with more than ``tile`` vectors is joined in
tiles of that size, so no task holds a cell; links are counted where they are found, and of each tile only a
spanning forest of its links goes on to the components. So neither copies nor crowded neighbourhoods are
expanded into pairs, and none is left out.

Rows of a null vec_id are left out; of rows that repeat an id the least (label, vector) counts. Vectors that are
null, empty, zero or hold a null or non-finite component, and those of a null label, link with nothing;
vectors of different lengths never link. Further columns are passed over.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanloom.llm.common import components, forest, written


@dataclass(frozen=True)
class Settings:
    cosine: float = 0.98
    blocks: int = 4
    tile: int = 2048
    plane: int = 3
    cell: float = 3.0  #: width of a cell in ranges
    sample: int = 1_000_000
    seed: int = 3


_SLACK = 1e-9


class Rotation:
    """The principal axes of ``sample`` (vectors by rows), dealt out to the blocks from the widest on."""

    def __init__(self, dim: int, s: Settings, sample: np.ndarray | None = None):
        if sample is None or len(sample) < 2:
            sample = np.random.default_rng([s.seed, dim]).normal(size=(2 * dim, dim))
        unit = sample / np.linalg.norm(sample, axis=1, keepdims=True)
        _, axes = np.linalg.eigh(np.cov(unit, rowvar=False).reshape(dim, dim))
        number = min(s.blocks, dim)
        dealt = [list(range(b, dim, number)) for b in range(number)]
        self.matrix = np.ascontiguousarray(axes[:, ::-1][:, [k for part in dealt for k in part]])
        edges = np.cumsum([0] + [len(part) for part in dealt])
        self.parts = list(zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True))
        square = 2 - 2 * s.cosine
        self.budget = [square * (b - a) / dim + _SLACK for a, b in self.parts]

    def unit(self, vectors: np.ndarray) -> np.ndarray:
        return (vectors / np.linalg.norm(vectors, axis=1, keepdims=True)) @ self.matrix


def _rotations(classes: DataFrame, s: Settings) -> dict[int, Rotation]:
    """A rotation for each length of vector, fitted on a sample of ``sample`` components of each in expectation."""
    dims = [(r["dim"], min(1.0, s.sample / r["dim"] / r["count"])) for r in classes.groupBy(F.size("vector").alias("dim")).count().collect()]
    if not dims:
        return {}
    spot = F.pmod(F.xxhash64(F.lit(s.seed), "rep"), F.lit(1 << 30)) / float(1 << 30)
    share = F.broadcast(classes.sparkSession.createDataFrame(dims, "dim int, share double"))
    drawn = classes.select("rep", "vector", F.size("vector").alias("dim")).join(share, "dim").where(spot < F.col("share")).select("vector").toArrow()
    held: dict[int, list[np.ndarray]] = {d: [] for d, _ in dims}
    for vector in drawn.column(0):
        held[len(vector)].append(vector.values.to_numpy())
    return {d: Rotation(d, s, np.array(held[d])) for d, _ in dims}


_VISIT = "label string, dim int, block int, cell binary, home boolean, rep long, copies long, vector binary"


def _visits(s: Settings, turns: dict[int, Rotation]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            labels, dims, reps, copies, raw = (batch.column(k).to_pylist() for k in range(5))
            for dim in sorted(set(dims)):
                own = [k for k, d in enumerate(dims) if d == dim]
                turn = turns[dim]
                vectors = np.array([raw[k] for k in own], float)
                spun, packed = turn.unit(vectors), [v.tobytes() for v in vectors]
                for b, ((lo, hi), budget) in enumerate(zip(turn.parts, turn.budget, strict=True)):
                    r = np.sqrt(budget)
                    plane = spun[:, lo : min(lo + s.plane, hi)]
                    home = np.floor(plane / (s.cell * r)).astype(">i4")
                    low, high = np.floor((plane - r) / (s.cell * r)).astype(">i4"), np.floor((plane + r) / (s.cell * r)).astype(">i4")
                    rows = []
                    for k, at, x, y, vector in zip(own, home.tolist(), low.tolist(), high.tolist(), packed, strict=True):
                        for cell in product(*(range(u, v + 1) for u, v in zip(x, y, strict=True))):
                            # Of two cells within reach of each other, the vector of the former visits the latter.
                            if list(cell) >= at:
                                rows.append((labels[k], dim, b, np.array(cell, ">i4").tobytes(), list(cell) == at, reps[k], copies[k], vector))
                    types = [pa.string(), pa.int32(), pa.int32(), pa.binary(), pa.bool_(), pa.int64(), pa.int64(), pa.binary()]
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=[c.split()[0] for c in _VISIT.split(", ")])

    return run


def _joined(s: Settings, turns: dict[int, Rotation]):
    """One tile: links of vectors at home to others at home or visiting, counted, and a spanning forest of them."""
    empty = pa.table({"rep": pa.array([], pa.int64()), "links": pa.array([], pa.int64()), "other": pa.array([], pa.int64())})

    def run(tile: pa.Table) -> pa.Table:
        left, right, home = (tile.column(c).to_numpy() for c in ("left", "right", "home"))
        at, to = np.flatnonzero(left), np.flatnonzero(right)
        if not len(at) or not len(to):
            return empty
        dim, block = tile.column("dim")[0].as_py(), tile.column("block")[0].as_py()
        turn = turns[dim]
        rep, copies = tile.column("rep").to_numpy(), tile.column("copies").to_numpy()
        raw = np.frombuffer(b"".join(tile.column("vector").to_pylist()), float).reshape(-1, dim)
        unit = raw / np.linalg.norm(raw, axis=1, keepdims=True)
        spun = turn.unit(raw)
        parts = [np.ascontiguousarray(spun[:, a:b]) for a, b in turn.parts[: block + 1]]
        squares = [(p * p).sum(1) for p in parts]
        links = np.zeros(len(rep), np.int64)
        found: list[tuple[np.ndarray, np.ndarray]] = []
        for start in range(0, len(at), 256):
            rows = at[start : start + 256]
            # Two at home meet on both sides: once is enough.
            near = ~home[to][None] | (rep[rows][:, None] < rep[to][None])
            for k in range(block, -1, -1):
                within = squares[k][rows][:, None] + squares[k][to][None] - 2 * (parts[k][rows] @ parts[k][to].T) <= turn.budget[k]
                near &= within if k == block else ~within
                if not near.any():
                    break
            i, j = np.nonzero(near)
            for part in range(0, len(i), 200_000):
                x, y = rows[i[part : part + 200_000]], to[j[part : part + 200_000]]
                close = np.einsum("ij,ij->i", unit[x], unit[y]) >= s.cosine
                x, y = x[close], y[close]
                np.add.at(links, x, copies[y])
                np.add.at(links, y, copies[x])
                found.append((x, y))
        x, y = (np.concatenate(c) for c in zip(*found, strict=True)) if found else (at[:0], at[:0])
        if not len(x):
            return empty
        label = forest(len(rep), x, y)
        touched = np.unique(np.r_[x, y])
        return pa.table({"rep": rep[touched], "links": links[touched], "other": rep[label[touched]]})

    return run


_CELL = ["label", "dim", "block", "cell"]


def _tiles(visits: DataFrame, s: Settings) -> DataFrame:
    """The rows of ``visits`` in the tiles of their cells: those at home on the left of one i, all on the right of one j, once where the two meet."""
    size = visits.groupBy(*_CELL).agg(F.ceil(F.count_if("home") / s.tile).cast("int").alias("rows"), F.ceil(F.count("*") / s.tile).cast("int").alias("columns"), F.count("*").alias("all"))
    size = size.where("rows > 0 AND all > 1").drop("all")
    spot = lambda n, salt: F.pmod(F.xxhash64("rep", F.lit(salt)), F.col(n)).cast("int")
    every = lambda n: F.sequence(F.lit(0), F.col(n) - 1)
    right = F.transform(every("rows"), lambda i: F.struct(i.alias("i"), spot("columns", 2).alias("j"), (F.col("home") & (i == spot("rows", 1))).alias("left"), F.lit(True).alias("right")))
    left = F.transform(F.array_remove(every("columns"), spot("columns", 2)), lambda j: F.struct(spot("rows", 1).alias("i"), j.alias("j"), F.lit(True).alias("left"), F.lit(False).alias("right")))
    both = visits.join(size, _CELL).withColumn("at", F.explode_outer(F.when(F.col("home"), F.concat(right, left)).otherwise(right)))
    return both.select(*_CELL, "home", "rep", "copies", "vector", "at.*")


def near_duplicates(vectors: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for each vector of ``vectors`` (vec_id, embedding, label)."""
    s = settings
    rows = vectors.where(F.col("vec_id").isNotNull()).select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("string").alias("label"), F.col("embedding").cast("array<double>").alias("vector"))
    rows = written(rows.groupBy("vec_id").agg(F.min(F.struct("label", "vector")).alias("r")).select("vec_id", "r.label", "r.vector"))
    number = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    good = rows.where(F.col("label").isNotNull() & (F.size("vector") > 0) & F.forall("vector", number) & F.exists("vector", lambda x: x != 0))
    # Lengths differ from 1 by so little at most that only a zero or overflowing norm needs care: scale by the largest component.
    top = F.array_max(F.transform("vector", F.abs))
    good = good.withColumn("vector", F.when((top < 1e-100) | (top > 1e100), F.transform("vector", lambda x: x / top)).otherwise(F.col("vector")))
    classes = written(good.groupBy("label", "vector").agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies")))
    turns = _rotations(classes, s)
    visits = classes.select("label", F.size("vector").alias("dim"), "rep", "copies", "vector").repartition("rep").mapInArrow(_visits(s, turns), _VISIT)
    found = written(_tiles(written(visits), s).groupBy(*_CELL, "i", "j").applyInArrow(_joined(s, turns), "rep long, links long, other long"))
    links = found.groupBy("rep").agg(F.sum("links").alias("links"))
    component = components(found.where("rep <> other").select(F.col("rep").alias("u"), F.col("other").alias("v"))).withColumnRenamed("id", "rep")
    known = classes.select("label", "vector", "rep", "copies").join(links, "rep", "left").join(component, "rep", "left")
    known = known.select("label", "vector", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "rep").alias("component_id"))
    member = good.select("vec_id", "label", "vector").join(known, ["label", "vector"]).select("vec_id", "n_links", "component_id")
    out = rows.select("vec_id").join(member, "vec_id", "left")
    out = out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id"))
    return out.withColumn("kept", F.col("vec_id") == F.col("component_id"))
