import numpy as np
import pytest
from pyspark.sql import functions as F

from spanloom.llm import embedding_dedup as D

SCHEMA = "vec_id long, embedding array<double>, label int"


def by_hand(rows, cosine=0.98):
    ids = [r[0] for r in rows]
    v = np.array([r[1] for r in rows], float)
    u = v / np.linalg.norm(v, axis=1, keepdims=True)
    label = np.array([r[2] for r in rows])
    near = (u @ u.T >= cosine) & (label[:, None] == label[None])
    np.fill_diagonal(near, False)
    comp = np.array(ids)
    while True:
        new = np.minimum(comp, np.where(near, comp[None], 2**62).min(1))
        if (new == comp).all():
            return {i: (int(n), int(c)) for i, n, c in zip(ids, near.sum(1), comp, strict=True)}
        comp = new


@pytest.mark.parametrize("options", [{}, {"tile": 20}, {"blocks": 8, "cell": 2.5, "plane": 2}, {"blocks": 1, "sample": 100}])
def test_links_are_those_of_all_pairs(spark, options):
    r = np.random.default_rng(4)
    rows = []
    for _ in range(25):
        base = r.normal(size=16)
        for _ in range(int(r.integers(1, 30))):
            scale = r.choice([0, 0.02, 0.05, 0.08])
            rows.append((len(rows), [float(x) for x in base + scale * np.linalg.norm(base) / 2 * r.normal(size=16)], int(r.integers(2))))
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = {x.vec_id: (x.n_links, x.component_id) for x in D.near_duplicates(df, D.Settings(**options)).collect()}
    assert got == by_hand(rows)


def test_edge_rows(spark):
    nan = float("nan")
    rows = [(1, None, 1), (2, [0.0, 0.0], 1), (3, [1.0, nan], 1), (4, [1.0, None], 1), (5, [1.0, 1.0], None), (6, [1.0, 1.0], 1), (7, [2.0, 2.0], 1), (8, [1e-200, 1e-200], 1), (9, [1.0], 1), (10, [], 1), (None, [1.0, 1.0], 1), (6, [1.0, 1.0], 1), (11, [5.0], 1), (12, [1e300, 1e300], 2), (13, [1.0, 1.0], 2), (14, [1.0, float("inf")], 2)]
    df = spark.createDataFrame([(*r, 0) for r in rows], SCHEMA + ", rep int")
    got = {r.vec_id: (r.n_links, r.component_id) for r in D.near_duplicates(df).collect()}
    assert got == {1: (0, 1), 2: (0, 2), 3: (0, 3), 4: (0, 4), 5: (0, 5), 6: (2, 6), 7: (2, 6), 8: (2, 6), 9: (1, 9), 10: (0, 10), 11: (1, 9), 12: (1, 12), 13: (1, 12), 14: (0, 14)}
    assert D.near_duplicates(df.limit(0)).count() == 0


def test_pairs_compared_grow_with_the_vectors_where_these_fill_more_of_the_space(spark):
    """Five times the groups: pairs compared are in each block a hundredth of all pairs, and grow little faster than the vectors."""
    counts = []
    for groups in (40, 200):
        r = np.random.default_rng(1)
        spread = np.r_[np.full(12, 3.0), np.full(20, 0.1)]
        base = r.normal(size=(groups, 32)) * spread
        vectors = [(k, [float(x) for x in base[k % groups] + 0.01 * r.normal(size=32)], "a", 1) for k in range(5 * groups)]
        classes = spark.createDataFrame([(v, i, label, n) for i, v, label, n in vectors], "vector array<double>, rep long, label string, copies long")
        s = D.Settings(cosine=0.999)
        turns = D._rotations(classes, s)
        visits = classes.selectExpr("label", "size(vector) AS dim", "rep", "copies", "vector").mapInArrow(D._visits(s, turns), D._VISIT)
        cells = visits.groupBy(*D._CELL).agg(F.count_if("home").alias("h"), F.count("*").alias("n"))
        counts.append(cells.agg(F.sum(F.expr("h * (h - 1) / 2 + h * (n - h)"))).first()[0])
    assert counts[1] <= 0.01 * 4 * (1000 * 999 / 2) and counts[1] <= 7 * counts[0]


def test_rotation_keeps_distances():
    r = np.random.default_rng(2)
    for dim in (1, 2, 7, 64):
        x = r.normal(size=(50, dim))
        for sample in (None, x, x[:1], x[:2]):
            turn = D.Rotation(dim, D.Settings(), sample)
            u = x / np.linalg.norm(x, axis=1, keepdims=True)
            assert np.allclose(turn.unit(x) @ turn.unit(x).T, u @ u.T) and sum(b - a for a, b in turn.parts) == dim
