"""Blockwise softmax loss, merged weighted draws and bitmap item sets against plain computations."""

import collections
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidalrec.operators import affinity as AF
from tidalrec.operators import losses as LS
from tidalrec.operators import topk as K


def _losses(rows, t):
    by = collections.defaultdict(list)
    for i, b, u, v in rows:
        if None not in (i, b, u, v):
            by[b].append((i, np.array(u), np.array(v)))
    out = {}
    for b, members in by.items():
        cols = np.stack([v for _, _, v in members])
        for i, u, v in members:
            s = cols @ u / t
            out[i, b] = s.max() + np.log(np.exp(s - s.max()).sum()) - u @ v / t
    return out


@pytest.mark.parametrize("block", [1, 3, 7, 4096])
def test_softmax_is_the_same_in_any_blocks(spark, block):
    rnd = np.random.default_rng(2)
    rows = [(i, i // 23, rnd.normal(size=3).tolist(), (30 * rnd.normal(size=3)).tolist()) for i in range(60)]
    rows += [(100, 0, None, [1.0, 2.0, 3.0]), (101, 0, [1.0, 2.0, 3.0], None), (None, 0, [0.0] * 3, [0.0] * 3),
             (102, None, [0.0] * 3, [0.0] * 3), (103, 9, [9.0, 0.0, 0.0], [9.0, 0.0, 0.0])]
    df = spark.createDataFrame(rows, "i long, b long, u array<double>, v array<double>")
    got = {(r.i, r.b): r.loss for r in LS.in_batch_softmax_loss(df, "i", "b", "u", "v", 0.05, block).collect()}
    want = _losses(rows, 0.05)
    assert got.keys() == want.keys()
    assert all(got[k] == pytest.approx(want[k], abs=1e-9) for k in want)
    assert LS.in_batch_softmax_loss(df.limit(0), "i", "b", "u", "v").count() == 0


def test_softmax_across_arrow_batches(spark):
    rnd = np.random.default_rng(3)
    rows = [(i, 0, rnd.normal(size=4).tolist(), rnd.normal(size=4).tolist()) for i in range(200)]
    df = spark.createDataFrame(rows, "i long, b long, u array<double>, v array<double>")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 13)
    try:
        got = {(r.i, r.b): r.loss for r in LS.in_batch_softmax_loss(df, "i", "b", "u", "v", 0.1, 64).collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    want = _losses(rows, 0.1)
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k], abs=1e-9) for k in want)


@pytest.mark.parametrize("shard", [1, 50, 10 ** 6])
def test_draws_are_those_of_their_intervals(spark, shard):
    """Every draw lies in the interval of its choice, however many shards a key has; zero weights are never drawn."""
    w = spark.createDataFrame([("k", "a", 2), ("k", "b", 0), ("k", "c", 5), ("j", "z", 1), ("j", None, 3), ("n", "a", 0)],
                              "key string, choice string, w long")
    cum = AF.cumulative_weights(w, "key", "choice", "w")
    draws = spark.range(400).select(F.col("id").cast("string").alias("d"), F.col("id").alias("lo"), F.when(
        F.col("id") % 4 == 3, F.lit(None)).otherwise(F.element_at(F.array(F.lit("k"), F.lit("j"), F.lit("n")),
                                                                  (F.col("id") % 4 + 1).cast("int"))).alias("key"))
    got = AF.weighted_sample(draws, "d", "key", cum, "choice", 11, shard)
    assert got.columns == ["d", "lo", "key", "choice"]
    u = {r.d: r.u for r in draws.select("d", AF.md5_unit(F.lit(11), F.col("d")).alias("u")).collect()}
    spans = {(r.key, r.choice): (r.lo, r.hi, r.total) for r in cum.collect()}
    rows = got.collect()
    assert {r.d for r in rows} == {str(i) for i in range(400) if i % 4 < 2}
    for r in rows:
        lo, hi, total = spans[r.key, r.choice]
        assert lo <= u[r.d] * total < hi


def test_bitmaps_hold_the_pairs(spark):
    rnd = random.Random(1)
    pairs = {(rnd.randrange(5), rnd.choice([rnd.randrange(40), 32767, 32768, 65536 + rnd.randrange(9), 3_000_000_000]))
             for _ in range(300)}
    rows = [*pairs, *list(pairs)[:20], (None, 3), (4, None)]
    df = spark.createDataFrame(rows, "user_id long, item_id long")
    b = K.user_item_bitmaps(df)
    assert {(r.user_id, r.item_id) for r in K.bitmap_items(b).collect()} == pairs
    assert b.agg(F.sum(F.bitmap_count("bitmap"))).first()[0] == len(pairs)
    more = spark.createDataFrame([(0, 7), (9, 1)], "user_id long, item_id long")
    merged = K.bitmap_items(K.merge_bitmaps(b, K.user_item_bitmaps(more)))
    assert sorted(map(tuple, merged.collect())) == sorted(pairs | {(0, 7), (9, 1)})
    assert K.bitmap_items(K.user_item_bitmaps(df.limit(0))).count() == 0
    with pytest.raises(Exception, match="negative"):
        K.user_item_bitmaps(spark.createDataFrame([(1, -1)], "user_id long, item_id long")).collect()
