"""Large cells of vectors: links against brute force, rows in proportion to the members."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidalrec.llm import lattice

COLS = "vec_id long, embedding array<double>"


def cone(n, seed, spread, dim=64):
    """Unit vectors around one axis, at a mutual cosine of about 1 / (1 + spread^2)."""
    rng = np.random.default_rng(seed)
    axis = rng.normal(size=dim)
    axis /= np.linalg.norm(axis)
    u = axis + rng.normal(size=(n, dim)) * spread / np.sqrt(dim)
    return u / np.linalg.norm(u, axis=1)[:, None]


def brute(u):
    near = u @ u.T >= 0.95
    least = np.arange(len(u))
    while True:
        new = np.where(near, least[None], len(u)).min(axis=1)
        if (new == least).all():
            return near.sum(axis=1) - 1, least
        least = new


def frame(spark, u):
    return spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(u)], COLS)


def test_forest():
    rng = np.random.default_rng(0)
    for _ in range(50):
        near = rng.random((rng.integers(0, 9), rng.integers(0, 9))) < 0.15
        r, c = near.shape
        whole = np.zeros((r + c, r + c), bool)
        whole[:r, r:] = near
        whole |= whole.T | np.eye(r + c, dtype=bool)
        least = np.arange(r + c)
        for _ in range(r + c):
            least = np.array([least[w].min() for w in whole])
        assert lattice._forest(near).tolist() == least.tolist()


@pytest.mark.parametrize("block,crowd", [(1024, 64), (50, 8)])
def test_links_equal_brute_force(spark, block, crowd):
    # a cone without links, one whose vectors are all linked, one in between, and an outlier as least id of its cell
    u = np.concatenate([cone(150, 1, 0.42), cone(150, 2, 0.15), cone(150, 3, 0.24), cone(1, 2, 0.3)])
    u = u[np.random.default_rng(8).permutation(len(u))]
    n, least = brute(u)
    got = {r.vec_id: r for r in lattice.near_vectors(
        frame(spark, u), lattice.LatticeLinks(block=block, crowd=crowd)).collect()}
    assert [got[i].n_links for i in range(len(u))] == n.tolist()
    assert [got[i].component_id for i in range(len(u))] == least.tolist()
    assert all(r.kept == (r.component_id == r.vec_id) for r in got.values())


@pytest.mark.parametrize("spread", [0.42, 0.15])
def test_a_large_cell_gives_rows_in_proportion(spark, spread):
    p = lattice.LatticeLinks()
    for n in (300, 900):
        classes = frame(spark, cone(n, 5, spread)).toDF("id", "v")
        members = lattice.bucket_rows(classes, p)
        sizes = members.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > p.crowd)
        large = members.join(sizes, "key")
        assert lattice.crowded_links(large, classes, p).count() <= large.count()
        if spread > 0.4:
            assert lattice.crowded_links(large, classes, p).count() == 0
