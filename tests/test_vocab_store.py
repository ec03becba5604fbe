"""Vocabulary, scaler and feature-store edge cases on literal micro tables."""

import pytest
from pyspark.sql import functions as F

from tidalrec.operators import store as ST
from tidalrec.operators import vocab as V
from tidalrec.sources import artifacts as AR


def _vocab(spark, values, min_count, column="c"):
    df = spark.createDataFrame([(v,) for v in values], f"{column} string")
    return V.fit_vocabulary(V.value_counts([(df, {column: column})]), {column: min_count})


def _tokens(spark, vocab, values, column="c"):
    q = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, {column} string")
    out = V.encode_column(q, vocab, column)
    return [r[column] for r in out.orderBy("i").collect()]


def test_tail_bucket(spark):
    vocab = _vocab(spark, ["a"] * 5 + ["b"] * 2 + ["c"] * 3, 3)
    assert _tokens(spark, vocab, ["a", "c", "b", "zzz"]) == [1, 2, 3, 0]
    card = V.cardinality(vocab, {"c": 3}).first()["cardinality"]
    assert card == 4


def test_no_tail_when_min_count_one(spark):
    vocab = _vocab(spark, ["x", "y", "y"], 1)
    assert _tokens(spark, vocab, ["x", "y", "q"]) == [1, 2, 0]
    assert V.cardinality(vocab, {"c": 1}).first()["cardinality"] == 3
    vocab0 = _vocab(spark, ["x", "y", "y"], 0)
    assert _tokens(spark, vocab0, ["x", "y", "q"]) == [1, 2, 0]


def test_tail_exists_even_if_empty(spark):
    vocab = _vocab(spark, ["x"] * 4, 2)
    assert V.cardinality(vocab, {"c": 2}).first()["cardinality"] == 3


def test_code_point_order(spark):
    vocab = _vocab(spark, ["2", "10", "1", "B", "b", "é"], 1)
    got = {r["value"]: r["token_index"] for r in vocab.collect()}
    assert [k for k, _ in sorted(got.items(), key=lambda kv: kv[1])] == ["1", "10", "2", "B", "b", "é"]


def test_missing_value_is_a_token(spark):
    df = spark.createDataFrame([(None,), (None,), ("a",)], "c string")
    vocab = V.fit_vocabulary(V.value_counts([(df, {"c": "c"})]), {"c": 1})
    got = {r["value"]: r["token_index"] for r in vocab.collect()}
    assert got == {"None": 1, "a": 2}


def test_round_trip(spark, tmp_path):
    vocab = _vocab(spark, ["x"] * 3 + ["y"], 2)
    scal = spark.createDataFrame([], "column string, mean double, std double")
    enc = V.Encoders(vocab, scal, ["c"], [])
    AR.save_encoders(enc, str(tmp_path / "enc"))
    loaded, meta = AR.load_encoders(spark, str(tmp_path / "enc"))
    assert _tokens(spark, loaded.vocab, ["x", "y", "z"]) == [1, 2, 0]
    assert _tokens(spark, vocab, ["x", "y", "z"]) == [1, 2, 0]
    ok, _ = AR.reusable(meta, ["c"], [], {"c": 2})
    assert ok
    assert not AR.reusable(meta, ["c"], [], {"c": 3})[0]
    assert not AR.reusable(meta, ["c", "d"], [], {"c": 2})[0]
    assert AR.reusable(AR.load_encoders(spark, str(tmp_path / "enc"))[1], ["c"], [], {"c": 2})[0]


def test_min_count_zero_equals_one_for_reuse():
    meta = {"cat_cols": ["c"], "dense_cols": [], "min_counts": {"c": 0}}
    assert AR.reusable(meta, ["c"], [], {"c": 1})[0]


def test_dense_scaler_edges(spark):
    df = spark.createDataFrame([(1.0, 5.0, None, "3"), (3.0, 5.0, None, "oops"), (None, 5.0, None, "5"),
                                (float("nan"), 5.0, None, None)],
                               "x double, const double, empty double, txt string")
    s = {r["column"]: (r["mean"], r["std"]) for r in V.fit_scalers(df, ["x", "const", "empty", "txt"]).collect()}
    assert s["x"] == pytest.approx((2.0, 1.0))
    assert s["const"] == (5.0, 1.0)
    assert s["empty"] == (0.0, 1.0)
    assert s["txt"] == pytest.approx((4.0, 1.0))
    sc = V.fit_scalers(df, ["x"])
    out = [r["x"] for r in V.scale_columns(df, sc, ["x"]).collect()]
    assert out == pytest.approx([-1.0, 1.0, 0.0, 0.0])


def test_shared_tail_keeps_distinct_positions(spark):
    users = spark.createDataFrame([(i, f"s{i % 3}") for i in range(20)], "uid long, seg string")
    counts = V.value_counts([(users, {"uid": "uid", "seg": "seg"})])
    vocab = V.fit_vocabulary(counts, {"uid": 10_000, "seg": 1})
    enc = V.Encoders(vocab, spark.createDataFrame([], "column string, mean double, std double"), ["uid", "seg"], [])
    st = ST.build_store(users, enc, "uid")
    rows = st.table.collect()
    assert sorted(r["position"] for r in rows) == list(range(1, 21))
    assert {r["uid"] for r in rows} == {1}          # every user in the shared tail token


def test_lookup_unknown_gives_zero_row(spark):
    users = spark.createDataFrame([(1, "a", 2.0), (2, "b", 4.0)], "uid long, seg string, bal double")
    counts = V.value_counts([(users, {"uid": "uid", "seg": "seg"})])
    vocab = V.fit_vocabulary(counts, {"uid": 1, "seg": 1})
    enc = V.Encoders(vocab, V.fit_scalers(users, ["bal"]), ["uid", "seg"], ["bal"])
    st = ST.build_store(users, enc, "uid")
    q = spark.createDataFrame([(1,), (99,)], "k long")
    got = {r["k"]: r for r in st.lookup(q, "k", prefix="user_").collect()}
    assert got[99]["user_position"] == 0 and got[99]["user_seg"] == 0 and got[99]["user_bal"] == 0.0
    assert got[1]["user_position"] == 1 and got[1]["user_bal"] == pytest.approx(-1.0)


def test_duplicate_ids_rejected(spark):
    users = spark.createDataFrame([(1, "a"), (1, "b")], "uid long, seg string")
    counts = V.value_counts([(users, {"uid": "uid", "seg": "seg"})])
    enc = V.Encoders(V.fit_vocabulary(counts, {"uid": 1, "seg": 1}),
                     spark.createDataFrame([], "column string, mean double, std double"), ["uid", "seg"], [])
    with pytest.raises(ValueError):
        ST.build_store(users, enc, "uid")


def test_vocab_mismatch_null_safe(spark):
    a = _vocab(spark, ["x", "y"], 1)
    b = _vocab(spark, ["x", "y", "z"], 1)
    rows = V.vocab_mismatch(a, b).collect()
    assert [(r["value"], r["left_index"], r["right_index"]) for r in rows] == [("z", None, 3)]
    assert V.vocab_mismatch(a, a).count() == 0


def test_encode_shuffle_path_equals_broadcast(spark):
    vocab = _vocab(spark, ["a"] * 5 + ["b"] * 2 + ["c"] * 3, 3)
    q = spark.createDataFrame([(i, v) for i, v in enumerate(["a"] * 50 + ["b", "c", "zz", None])], "i int, c string")
    a = sorted(map(tuple, V.encode_column(q, vocab, "c", broadcast=True).collect()), key=repr)
    b = sorted(map(tuple, V.encode_column(q, vocab, "c", broadcast=False).collect()), key=repr)
    assert a == b
