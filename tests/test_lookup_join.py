"""Lookup joins give the same rows whichever way they take."""

import pytest
from pyspark.sql import functions as F

from tidalrec.operators import skew as SK
from tidalrec.plans import catalog as C

SF = "/root/testdata/sf0.001"


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("name", ["feature_lookup_unknown", "encode_users", "vocab_encode", "stacked_pooling", "tower_embed",
                                  "rare_category_fold", "negatives_sampled", "train_rows_labeled", "stream_encode"])
def test_queries_without_any_broadcast(spark, monkeypatch, name):
    base = _rows(C.QUERIES[name](spark, SF))
    monkeypatch.setattr(SK, "BROADCAST_BYTES", 0)
    assert _rows(C.QUERIES[name](spark, SF)) == base


def _fact(spark):
    hot = F.when(F.col("id") < 3000, F.lit("hot")).when(F.col("id") < 6000, F.lit(None)).otherwise((F.col("id") % 700).cast("string"))
    return spark.range(9000).select(hot.alias("k"), F.pmod("id", F.lit(3)).alias("j"), "id")


def test_hot_keys_meet_their_lookup_rows_by_broadcast(spark, monkeypatch):
    monkeypatch.setattr(SK, "BROADCAST_BYTES", 0)
    fact = _fact(spark)
    lookup = spark.range(500).select(F.col("id").cast("string").alias("k"), "id").withColumnRenamed("id", "v").unionByName(
        spark.createDataFrame([("hot", -1), (None, -2)], "k string, v long"))
    assert SK._hot_hashes(fact.where("k is not null"), F.xxhash64("k"), 0.01) == [
        fact.where("k = 'hot'").select(F.xxhash64("k")).first()[0]]
    got = SK.lookup_join(fact, lookup, "k")
    assert _rows(got) == _rows(fact.join(lookup, "k", "left"))
    assert {r.v for r in got.where("k = 'hot'").collect()} == {-1} and got.where("k is null and v is not null").count() == 0


def test_two_keys_and_a_lookup_with_several_rows_for_a_key(spark, monkeypatch):
    fact = _fact(spark)
    lookup = spark.range(30).select(F.lit("hot").alias("k"), F.pmod("id", F.lit(2)).alias("j"), F.col("id").alias("v"))
    want = _rows(fact.join(lookup, ["k", "j"], "left"))
    assert _rows(SK.lookup_join(fact, lookup, ["k", "j"])) == want
    monkeypatch.setattr(SK, "BROADCAST_BYTES", 0)
    assert _rows(SK.lookup_join(fact, lookup, ["k", "j"])) == want
    monkeypatch.setattr(SK, "HOT_BYTES", 0)
    assert _rows(SK.lookup_join(fact, lookup, ["k", "j"])) == want


def test_bytes_of_a_table(spark):
    df = spark.createDataFrame([(1, "abc", [1.0, 2.0]), (2, None, None)], "a long, s string, v array<double>")
    fixed = 24 + 8 + 8 + 16
    assert SK.table_bytes(df) == 2 * fixed + 3 + 16
    assert SK.table_bytes(df.select("a"), rows=10) == 10 * 32 and SK.table_bytes(df.limit(0)) == 0
    long = spark.createDataFrame([("x" * 100_000,)], "s string")
    assert SK.table_bytes(long) > 100_000


def test_empty_sides(spark):
    fact, lookup = _fact(spark), spark.createDataFrame([], "k string, v long")
    assert SK.shuffled_left_join(fact, lookup, ["k"]).where("v is null").count() == 9000
    assert SK.shuffled_left_join(fact.limit(0), lookup, ["k"]).count() == 0
