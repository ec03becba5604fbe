"""Two-level cells with product-quantised codes against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidalrec.operators import pq_index as PQ

SF = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def given(spark):
    w = spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding")
    return PQ.build(w, "vec_id", "embedding")


def _matrix(index):
    rows = {r.item_id: np.array(r.vec) for r in index.vectors.collect()}
    ids = np.array(sorted(rows))
    return ids, np.stack([rows[i] for i in ids])


def test_recall_on_the_given_vectors(given):
    """At least 0.9 of the ten nearest, for every tenth vector, with a tenth of the vectors read."""
    ids, m = _matrix(given)
    q = given.vectors.where("item_id % 10 = 0").select(F.col("item_id").alias("qid"), "vec")
    got = {}
    for r in PQ.search(given, q, 10).collect():
        got.setdefault(r.qid, []).append(r.item_id)
    hits = [len(set(ids[np.lexsort((ids, -(m @ m[np.searchsorted(ids, i)])))[:10]]) & set(found)) for i, found in got.items()]
    assert len(hits) == (ids % 10 == 0).sum() and np.mean(hits) / 10 >= 0.9
    assert 20 * 10 <= len(ids) / 10


def test_every_row_has_a_cell_and_a_code(given):
    assert given.codes.count() == given.n_items == given.codes.select("item_id").distinct().count()
    assert {len(r.code) for r in given.codes.collect()} == {16}
    cells = {r.cell for r in given.codes.select("cell").distinct().collect()}
    assert cells <= {r.item_id for r in given.inner.collect()} and len(cells) > 10


def test_probed_share_falls_with_size():
    shares = [PQ.probes_for(c) / c for c in (10, 100, 1000, 10_000)]
    assert shares == sorted(shares, reverse=True)


def test_ties_nulls_and_empty_tables(spark):
    rows = [(i, [1.0, 0.0, 0.0, float(i % 3)]) for i in range(40)] + [(99, None)]
    w = spark.createDataFrame(rows, "id long, v array<double>")
    index = PQ.build(w, "id", "v", parts=2)
    q = spark.createDataFrame([(1, [1.0, 0.0, 0.0, 0.0]), (2, None)], "qid long, vec array<double>")
    got = PQ.search(index, q, 3, nprobe=index.n_cells, rescore=40).collect()
    assert [(r.qid, r.item_id) for r in sorted(got, key=lambda r: r["rank"])] == [(1, 0), (1, 3), (1, 6)]
    none = PQ.build(w.limit(0), "id", "v", parts=2)
    assert PQ.search(none, q, 3).count() == 0
    with pytest.raises(ValueError):
        PQ.build(w, "id", "v", parts=3)
