"""Time split contract and the distributed numbering."""

import datetime as dt

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidalrec.operators import numbering as N
from tidalrec.operators import split as S


def test_boundary_row_goes_to_train(spark):
    # min 0s, max 10s, val_t 0.2 -> threshold 8s; the 8s row is train
    rows = [(i, dt.datetime(2020, 1, 1, 0, 0, s)) for i, s in enumerate([0, 5, 8, 9, 10])]
    df = spark.createDataFrame(rows, "i int, ts timestamp")
    train, val = S.split_by_time(df, "ts", 0.2)
    assert sorted(r.i for r in train.collect()) == [0, 1, 2]
    assert sorted(r.i for r in val.collect()) == [3, 4]


def test_split_errors(spark):
    df = spark.createDataFrame([(1, "2020-01-01"), (2, "not a date")], "i int, ts string")
    with pytest.raises(ValueError):
        S.split_by_time(df, "ts", 0.2)
    same = spark.createDataFrame([(1, "2020-01-01"), (2, "2020-01-01")], "i int, ts string")
    with pytest.raises(ValueError):
        S.split_by_time(same, "ts", 0.2)
    with pytest.raises(ValueError):
        S.split_by_time(same, "ts", 1.0)
    with pytest.raises(ValueError):
        S.split_by_time(same, "missing", 0.2)


def test_split_exhaustive_and_disjoint(spark):
    from tidalrec.sources import tables as TB
    x = TB.interactions(spark, "/root/testdata/sf0.001")
    train, val = S.split_by_time(x, "o_orderdate", 0.2)
    assert train.count() + val.count() == x.count()
    assert train.join(val, "row_key").count() == 0
    assert (train.count(), val.count()) == (4898, 1102)


@pytest.mark.parametrize("parts", [1, 3, 8])
def test_distributed_numbering_matches_window(spark, parts):
    df = spark.range(5000).select((F.col("id") * 7919 % 1000).alias("v"), (F.col("id") % 3).alias("g"),
                                  F.col("id"))
    got = N.number_rows(df, [F.col("v"), F.col("id")], ["g"], out="rn", partitions=parts,
                        force_distributed=True)
    w = Window.partitionBy("g").orderBy("v", "id")
    ref = df.withColumn("ref", F.row_number().over(w))
    j = got.join(ref, ["id", "g", "v"])
    assert j.count() == 5000
    assert j.filter(F.col("rn") != F.col("ref")).count() == 0


def test_distributed_numbering_global_skew(spark):
    # one value holds a third of the rows: still numbered 1..n without gaps
    df = spark.range(3000).select(F.when(F.col("id") < 1000, F.lit(0)).otherwise(F.col("id")).alias("v"),
                                  F.col("id"))
    got = N.number_rows(df, [F.col("v"), F.col("id")], out="rn", partitions=4, force_distributed=True)
    rns = sorted(r.rn for r in got.collect())
    assert rns == list(range(1, 3001))


def test_bounded_batched_scan_and_text_source(spark, tmp_path):
    from tidalrec.sources import tables as TB
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        df = TB.read_batches(spark, "/root/testdata/sf0.01/lineitem.parquet", batch_bytes=128 * 1024)
        assert df.select("l_orderkey").rdd.getNumPartitions() >= 1
        plan = df.select("l_orderkey")._jdf.queryExecution().executedPlan().toString()
        assert "ReadSchema: struct<l_orderkey:bigint>" in plan
        assert df.count() == 60000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    with pytest.raises(ValueError):
        TB.read_table(spark, "/root/testdata/sf0.01/lineitem.csv")
    p = tmp_path / "u.dat"
    p.write_bytes("1::F::25::4::12345\n2::M::é::7::\n".encode("latin-1"))
    raw = TB.read_delimited(spark, str(p), ["user_id", "gender", "age", "occupation", "zip"])
    rows = sorted(raw.collect())
    assert rows[0].zip == "12345" and rows[1].age == "é" and rows[1].zip is None


def test_numbering_leaves_no_storage_and_keeps_the_callers(spark):
    stored = lambda: set(spark.sparkContext._jsc.getPersistentRDDs().keySet().toArray())
    mine = spark.range(100).withColumn("g", F.col("id") % 3).persist()
    assert mine.count() == 100
    before = stored()
    for known in (None, 100):
        got = N.number_rows(mine, [F.col("id")], ["g"], known_rows=known, force_distributed=True)
        assert got.agg(F.max("rn")).first()[0] == 34
        assert mine.storageLevel.useMemory
    fresh = spark.range(50).withColumn("h", F.col("id") % 2)
    assert N.number_rows(fresh, [F.col("id")], force_distributed=True).count() == 50
    assert stored() == before
    mine.unpersist()


def test_ids_that_share_a_key_are_rejected(spark):
    from tidalrec.operators.store import check_unique
    assert check_unique(spark.createDataFrame([("a",), (None,)], "i string"), "i") == 2
    for rows in ([(None,), ("None",)], [(None,), (None,)], [("a",), ("a",)]):
        with pytest.raises(ValueError):
            check_unique(spark.createDataFrame(rows, "i string"), "i")
