"""Streaming folds equal the batch result; preparation columns; sampling."""

import random

import pytest
from pyspark.sql import functions as F

from tidalrec.operators import affinity as AF
from tidalrec.operators import latest as LT
from tidalrec.operators import prep as PR
from tidalrec.streaming import incremental as INC

SF = "/root/testdata/sf0.01"


def test_stream_equals_batch_with_shuffled_files(spark, tmp_path):
    e = spark.read.parquet(f"{SF}/events.parquet")
    # split the table into 6 files written in a shuffled order (several micro-batches)
    parts = list(range(6))
    random.Random(5).shuffle(parts)
    src = tmp_path / "src"
    for i in parts:
        e.filter(F.pmod(F.col("event_id") * 7, F.lit(6)) == i).coalesce(1).write.parquet(str(src / f"part{i}"))
    files = sorted(str(p) for p in src.rglob("*.parquet"))
    flat = tmp_path / "flat"
    flat.mkdir()
    order = list(range(len(files)))
    random.Random(9).shuffle(order)
    for n, idx in enumerate(order):
        (flat / f"f{n:02d}.parquet").write_bytes(open(files[idx], "rb").read())
    stream = INC.read_stream(spark, str(flat), like=e, max_files=1)
    out = str(tmp_path / "latest")
    INC.run_available(INC.stream_latest(stream, "user_id", "ts", ["event_id"], ["event_id", "event_type"]), out, "update")
    got = INC.state_latest_per_key(spark, out, ["user_id"])
    ref = LT.latest_per_key(e, "user_id", "ts", ["event_id"], ["event_id", "event_type"])
    assert spark.read.parquet(out).select("batch_id").distinct().count() == len(files)
    assert got.select(*ref.columns).exceptAll(ref).count() == 0 and ref.exceptAll(got.select(*ref.columns)).count() == 0

    stream2 = INC.read_stream(spark, str(flat), like=e, max_files=2)
    out2 = str(tmp_path / "counts")
    INC.run_available(INC.stream_value_counts(stream2, ["event_type"]), out2, "update")
    got2 = {(r["column"], r.value): r.cnt for r in INC.state_latest_per_key(spark, out2, ["column", "value"]).collect()}
    ref2 = {("event_type", r.event_type): r["count"] for r in e.groupBy("event_type").count().collect()}
    assert got2 == ref2


def test_prep_columns(spark):
    df = spark.createDataFrame([(1, "Toy Story (1995)", 17.0, None), (2, "No Year", 25.0, "12345"),
                                (3, "A (1999) B (2001)", -1.0, "9")], "i int, title string, age double, zip string")
    r = {x.i: x for x in df.select("i", PR.year_of_title("title").alias("y"), PR.decade_bucket(PR.year_of_title("title")).alias("b"),
                                   PR.clean_title("title").alias("t"), PR.range_bucket("age").alias("a"),
                                   PR.leading_bucket("zip").alias("z"), PR.prefixed("age", "age_").alias("g")).collect()}
    assert (r[1].y, r[1].b, r[1].t, r[1].a, r[1].z, r[1].g) == (1995, "year_1990s", "Toy Story", "age_0_17", "000", "age_17.0")
    assert (r[2].y, r[2].b, r[2].t, r[2].a, r[2].z) == (None, "year_unknown", "No Year", "age_25_34", "123")
    assert (r[3].y, r[3].t, r[3].a, r[3].z) == (1999, "A B", None, "9")


def test_surrogate_ids_and_dates(spark):
    df = spark.createDataFrame([(0, 0), (7, 86399), (1234567, 86400)], "i long, e long")
    got = [(x.s, x.d) for x in df.select(PR.surrogate_id("u", "i", 1234568).alias("s"), PR.epoch_to_date("e").alias("d")).collect()]
    assert got == [("u_0000000", "1970-01-01"), ("u_0000007", "1970-01-01"), ("u_1234567", "1970-01-02")]


def test_fold_rare_strictly_greater(spark):
    df = spark.createDataFrame([("a",)] * 11 + [("b",)] * 10, "g string")
    got = {(r.g, r.gg) for r in PR.fold_rare(df, "g", "gg").collect()}
    assert got == {("a", "a"), ("b", "other")}


def test_weighted_sample_shares(spark):
    w = spark.createDataFrame([("k", "x", 1), ("k", "y", 3), ("j", "z", 5)], "key string, choice string, w long")
    cum = AF.cumulative_weights(w, "key", "choice", "w")
    draws = spark.range(20000).select(F.col("id").cast("string").alias("d"),
                                      F.when(F.col("id") % 2 == 0, "k").otherwise("j").alias("key"))
    s = AF.weighted_sample(draws, "d", "key", cum, "choice", seed=11)
    assert s.count() == 20000
    shares = {r.choice: r["count"] for r in s.groupBy("choice").count().collect()}
    assert shares["z"] == 10000
    assert shares["y"] / 10000 == pytest.approx(0.75, abs=0.02)


def test_affinity_softmax_sums_to_one(spark):
    from tidalrec.plans import catalog as C
    keys, profiles, prefs, n = C._affinity_inputs(spark, "/root/testdata/sf0.001")
    s = AF.affinity_scores(keys, profiles, prefs, C.USER_SEGS, C.ITEM_PROFILE)
    sm = AF.affinity_softmax(s, keys, n, C.USER_SEGS, C.ITEM_PROFILE)
    tot = sm.groupBy(*C.USER_SEGS).agg(F.sum(F.col("n_items") * F.col("prob")).alias("t"),
                                       F.sum("n_items").alias("n")).collect()
    assert all(abs(r.t - 1) < 1e-9 and r.n == n for r in tot)


def test_stream_encode_unknown_values(spark, tmp_path):
    from tidalrec.operators import vocab as V
    known = spark.createDataFrame([("a",), ("a",), ("b",)], "c string")
    vocab = V.fit_vocabulary(V.value_counts([(known, {"c": "c"})]), {"c": 2})
    src = tmp_path / "src"
    spark.createDataFrame([(1, "a"), (2, "b"), (3, "zzz"), (4, None)], "i int, c string").write.parquet(str(src))
    stream = INC.read_stream(spark, str(src), like=spark.read.parquet(str(src)))
    out = str(tmp_path / "enc")
    INC.run_available(INC.stream_encode(stream, vocab, {"c": "c"}).select("i", "c_token"), out, "append")
    got = {r.i: r.c_token for r in spark.read.parquet(out).collect()}
    assert got == {1: 1, 2: 2, 3: 0, 4: 0}
