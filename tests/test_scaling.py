"""What moves or is computed per row stays bounded as tables grow."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidalrec.functions import backprop as BP
from tidalrec.operators import pq_index as PQ
from tidalrec.operators import skew as SK
from tidalrec.operators import topk as K
from tidalrec.operators import towers as TW
from tidalrec.operators import vector_search as VS
from tidalrec.operators import vocab as V


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_blocks_of_a_large_search_move_few_copies(spark):
    """900,000 queries and 1,200,000 items of length 8: copies of either side, and lists per query."""
    nq = spark.createDataFrame([(0, 900_000)], "cell int, rows long")
    ni = spark.createDataFrame([(0, 1_200_000, 8)], "cell int, rows long, dim int")
    r = VS._block_counts(nq, ni).first()
    assert r.n_q <= 64 and r.n_i <= 8
    small = VS._block_counts(spark.createDataFrame([(0, 15_000)], "cell int, rows long"), ni).first()
    assert small.n_q >= 24  # the tasks stay busy


@pytest.mark.parametrize("own", [False, True])
def test_tiles_keep_each_querys_best(monkeypatch, spark, own):
    rnd = np.random.default_rng(5)
    qs, its = rnd.integers(-3, 4, (70, 3)).astype(float), rnd.integers(-3, 4, (90, 3)).astype(float)  # many ties
    ks = [(i % 6) if own else 4 for i in range(70)]
    q = spark.createDataFrame([(i, v.tolist(), ks[i]) for i, v in enumerate(qs)], "qid long, vec array<double>, k long")
    c = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(its)], "item_id long, vec array<double>")
    seen = {(int(a), int(b)) for a, b in zip(rnd.integers(0, 70, 300), rnd.integers(0, 90, 300))}
    s = spark.createDataFrame([*seen, *list(seen)[:9], (1000, 1), (1, 1000)], "qid long, item_id long")
    monkeypatch.setattr(VS, "TILE_QUERIES", 8)
    monkeypatch.setattr(VS, "SCORE_BYTES", 8 * 8 * 7)  # tiles of 8 x 7
    got = {(r.qid, r["rank"]): (r.item_id, r.score) for r in VS.exact_topk(q, c, "k" if own else 4, seen=s, scale=2.0).collect()}
    want = {}
    for i, v in enumerate(qs):
        left = sorted((-2 * float(v @ x), j) for j, x in enumerate(its) if (i, j) not in seen)[:ks[i]]
        want.update({(i, n + 1): (j, -sc) for n, (sc, j) in enumerate(left)})
    assert got == want


def test_probed_cells_make_no_rows(spark):
    """The lists of a probe are k rows per query and item block, whatever the number of cells."""
    rnd = np.random.default_rng(6)
    vecs, cents = rnd.normal(size=(400, 4)), rnd.normal(size=(20, 4))
    cell = (vecs @ cents.T).argmax(1)
    index = spark.createDataFrame([(i, int(cell[i]), v.tolist()) for i, v in enumerate(vecs)], "item_id long, cell int, vec array<double>")
    centres = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(cents)], "cell int, centroid array<double>")
    q = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vecs[:50])], "qid long, vec array<double>")
    out = VS.probe_topk(q, index, centres, 3, 7)
    got = {}
    for r in out.orderBy("qid", "rank").collect():
        got.setdefault(r.qid, []).append(r.item_id)
    for i in range(50):
        near = np.argsort(-(cents @ vecs[i]), kind="stable")[:7]
        mine = [j for j in np.argsort(-(vecs @ vecs[i]), kind="stable") if cell[j] in near]
        assert got[i] == mine[:3]
    cell0 = lambda df, key: df.withColumn("cell", VS._only_cell(key))
    qs, items = cell0(q.withColumn("k", F.lit(3).cast("long")), "qid"), cell0(index.withColumnRenamed("cell", "part"), "item_id")
    lists = VS._score_groups(qs, items, VS._sizes(qs, items, None, None, None), 3, None, 1.0, None, False,
                             centres.select(F.col("cell").cast("long").alias("item_id"), F.col("centroid").alias("vec")), 7)
    assert lists.count() == 50 * 3


def test_scores_of_all_pairs_equal_those_of_rows():
    rnd = np.random.default_rng(7)
    u, v = rnd.normal(size=(9, 5)), rnd.normal(size=(31, 5))
    for hidden in ([], [6], [6, 4]):
        scorer = TW.init_pair_scorer(5, hidden, 3)
        want = [[scorer.score(a[None], b[None])[0] for b in v] for a in u]
        assert np.allclose(scorer.matrix(u, v), want, atol=1e-12)


def test_a_join_without_hot_keys_reads_the_facts_once(spark, monkeypatch):
    monkeypatch.setattr(SK, "BROADCAST_BYTES", 0)
    fact = spark.range(5000).select((F.col("id") % 2500).cast("string").alias("k"), "id")
    lookup = spark.createDataFrame([(str(i), i) for i in range(100)], "k string, v long")
    out = SK.lookup_join(fact, lookup, "k")
    assert _plan(out).count("Range (0, 5000") == 1
    assert out.where("v is not null").count() == 200 and out.count() == 5000


def test_a_dictionary_is_counted_once(spark):
    counts = V.value_counts([(spark.range(50).select((F.col("id") % 20).cast("string").alias("c")), {"c": "c"})])
    vocab = V.fit_vocabulary(counts, {"c": 3})
    assert "Range (0, 50" not in _plan(vocab) and vocab.where("is_tail").count() == 10 and vocab.count() == 20


def test_bitmaps_are_not_shuffled(spark):
    pairs = spark.range(100).select((F.col("id") % 7).alias("user_id"), (F.col("id") * 1000).alias("item_id"))
    plan = _plan(K.merge_bitmaps(K.user_item_bitmaps(pairs), K.user_item_bitmaps(pairs.where("user_id < 4"))))
    above = plan.split("partial_bitmap_construct_agg")[0]
    assert "Exchange" not in above


def test_local_tables_grow_by_doubling():
    t = BP.LocalTable(2)
    ix = t.rows(np.array([7, 3, 7, 5]), [[1.0, 2.0], None, [9.0, 9.0], [5.0, 6.0]])
    assert ix.tolist() == [0, 1, 0, 2] and t.w[ix].tolist() == [[1, 2], [0, 0], [1, 2], [5, 6]]
    held = t.w
    t.rows(np.arange(100), [[float(i)] * 2 for i in range(100)])
    assert t.w is held and t.w[t.index[50]].tolist() == [50, 50] and t.w[0].tolist() == [1, 2]
    t.rows(np.arange(5000), [[0.0, 1.0]] * 5000)
    assert len(t.index) == 5000 and t.w[t.index[50]].tolist() == [50, 50] and t.w[t.index[4999]].tolist() == [0, 1]


def test_a_fit_compares_few_rows_at_once(monkeypatch):
    x = np.random.default_rng(8).normal(size=(300, 4))
    whole = PQ.lloyd(x, 9, 1, False)
    monkeypatch.setattr(PQ, "FIT_STEP", 37)
    assert np.allclose(PQ.lloyd(x, 9, 1, False), whole)


def _streamed(k, queries, items, ids, seen=(), scale=1.0, ks=None):
    """Lists of one block, whose items come in records of 50."""
    g = VS._Group(k, scale, None, True, 0)
    ks = np.full(len(queries), k) if ks is None else ks
    g.add(VS.QUERIES, np.arange(len(queries)), ks, queries.ravel())
    if len(seen):
        g.add(VS.SEEN, seen[:, 0], seen[:, 1], np.empty(0))
    for a in range(0, len(ids), 50):
        g.add(VS.ITEMS, ids[a:a + 50], ids[a:a + 50], items[a:a + 50].ravel())
    out = [r for b in g.lists() for r in b.to_pylist()]
    return sorted((r["qid"], -r["score"], r["item_id"]) for r in out), out


@pytest.mark.parametrize("kind", ["random", "ties", "same", "odd"])
def test_passed_over_leaves_hold_nothing_of_a_list(monkeypatch, kind):
    """Items come in many chunks; lists equal those of all pairs, with ties, seen items, numbers that are none, and a negative scale."""
    monkeypatch.setattr(VS, "CHUNK_FIRST", 60)
    monkeypatch.setattr(VS, "CHUNK_ROWS", 400)
    monkeypatch.setattr(VS, "TILE_QUERIES", 4)
    monkeypatch.setattr(VS, "SCORE_BYTES", 16 * 8 * 8)  # leaves of 8
    rnd = np.random.default_rng(9)
    q, x = rnd.normal(size=(40, 3)), rnd.normal(size=(1500, 3))
    if kind == "ties":
        q, x = np.round(q), np.round(x)
    if kind == "same":
        x[:] = x[0]
    if kind == "odd":
        x[7], x[20, 1], q[3, 0] = np.nan, np.inf, np.nan
    ids = rnd.permutation(5000)[:1500]
    seen = np.stack([rnd.integers(0, 40, 4000), ids[rnd.integers(0, 1500, 4000)]], axis=1)
    old = set(map(tuple, seen.tolist()))
    for scale, ks in ((1.0, np.full(40, 6)), (-2.0, rnd.integers(0, 9, 40))):
        got, rows = _streamed(None, q, x, ids, seen, scale, ks)
        want = []
        for i in range(40):
            s = [(-(float(q[i] @ v) * scale), int(j)) for j, v in zip(ids, x) if (i, int(j)) not in old]
            want += [(i, *r) for r in sorted(r for r in s if np.isfinite(r[0]))[:ks[i]]]
        assert [(a, c) for a, _, c in got] == [(a, c) for a, _, c in want]
        assert np.allclose([b for _, b, _ in got], [b for _, b, _ in want])
        by_id = dict(zip(ids.tolist(), x))
        assert all(np.array_equal(r["vec"], by_id[r["item_id"]], equal_nan=True) for r in rows)


def test_a_search_scores_few_pairs_and_ties_make_no_news(monkeypatch):
    """Near-by items only are scored; equal scores of later ids don't pile up (they did: every tie was merged again)."""
    rnd = np.random.default_rng(10)
    shown, merged = [], []
    show, merge = VS._Best.show, VS._Best.merge
    monkeypatch.setattr(VS._Best, "show", lambda self, s, *a: (shown.append(s.size), show(self, s, *a)))
    monkeypatch.setattr(VS._Best, "merge", lambda self: (merged.append(sum(len(x[0]) for x in self.new)), merge(self)))
    q, x = rnd.normal(size=(300, 3)), rnd.normal(size=(60_000, 3))
    _streamed(5, q, x, np.arange(60_000))
    assert sum(shown) < 0.4 * 300 * 60_000
    merged.clear()
    _streamed(5, q, np.ones_like(x), np.arange(60_000))
    assert sum(merged) < 0.1 * 300 * 60_000


def test_a_large_search_moves_items_as_often_as_there_are_query_blocks(spark):
    """5,400,000 queries and 7,200,000 items: items moved 330 times and every query had 28 lists before."""
    nq = spark.createDataFrame([(0, 5_400_000, 67_500_000)], "cell int, rows long, entries long")
    ni = spark.createDataFrame([(0, 7_200_000, 8)], "cell int, rows long, dim int")
    r = VS._block_counts(nq, ni).first()
    assert r.n_q <= 24 and r.n_i == 1
    few = VS._block_counts(spark.createDataFrame([(0, 10)], "cell int, rows long"), ni).first()
    assert few.n_q == 1 and few.n_i >= 12  # a few queries' items are searched by many tasks


def test_a_search_shuffles_small_records(spark, monkeypatch):
    """Rows travel as records of at most PACK rows (a block of up to 16 MB was one record), all of them, to every block."""
    monkeypatch.setattr(VS, "PACK", 16)
    rnd = np.random.default_rng(11)
    q = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(rnd.normal(size=(70, 3)))], "qid long, vec array<double>")
    c = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(rnd.normal(size=(90, 3)))], "item_id long, vec array<double>")
    longest = []
    rows = q.select(F.lit(0).cast("long").alias("cell"), F.lit(0).alias("x"), F.lit(1).alias("y"), F.col("qid").alias("a"),
                    F.col("qid").alias("b"), "vec")
    packed = list(VS._pack(iter(rows.toArrow().to_batches())))
    longest = [len(a) for r in packed for a in r.column("a").to_pylist()]
    assert max(longest) <= 16 and sum(longest) == 70
    want = {(r.qid, r["rank"]): r.item_id for r in VS.exact_topk(q, c, 5).collect()}
    monkeypatch.setattr(VS, "QUERY_CHUNK", 9)
    assert {(r.qid, r["rank"]): r.item_id for r in VS.exact_topk(q, c, 5).collect()} == want and len(want) == 350
