"""Rows that earlier versions lost: NULL groups, the NULL entity, ids longer than their padding, rare draws."""

import hashlib

import pytest
from pyspark.sql import functions as F

from tidalrec.functions.columns import md5_uniform_int, md5_unit
from tidalrec.operators import numbering, prep, store, train, vocab
from tidalrec.spec import tpch_spec  # noqa: F401 - the package's specs import cleanly


@pytest.mark.parametrize("distributed", [False, True])
def test_null_group_is_numbered(spark, distributed):
    df = spark.createDataFrame([("a", 1), ("a", 2), (None, 3), (None, 4)], "g string, v int")
    got = numbering.number_rows(df, [F.col("v")], ["g"], out="rn", partitions=3, force_distributed=distributed)
    assert sorted((r.v, r.rn) for r in got.collect()) == [(1, 1), (2, 2), (3, 1), (4, 2)]


def test_long_surrogate_ids_stay_whole(spark):
    df = spark.createDataFrame([(1234567,), (1234568,), (12345679,), (5,)], "i long")
    got = [r.s for r in df.select(prep.surrogate_id("e", "i", 3).alias("s")).collect()]
    assert got == ["e_1234567", "e_1234568", "e_12345679", "e_000005"]


def test_draws_use_sixty_bits(spark):
    r = spark.range(1).select(md5_uniform_int(F.lit(1), F.lit("x")).alias("n"), md5_unit(F.lit(1), F.lit("x")).alias("u")).first()
    want = int(hashlib.md5(b"1|x").hexdigest()[:15], 16)
    assert r.n == want and r.u == (want >> 8) / 2**52 and 0 <= r.u < 1


def test_stopping_after_patience():
    s = train.EarlyStopping(patience=2, mode="min", min_delta=0.1, metric="loss")
    seen = [s.update({"loss": x}, e) for e, x in enumerate([1.0, 0.95, 0.5, 0.45, 0.6])]
    assert seen == [(True, False), (False, False), (True, False), (False, False), (False, True)]
    assert (s.best, s.best_epoch, s.stopped) == (0.5, 2, True)
    with pytest.raises(ValueError):
        train.EarlyStopping(mode="up")
    with pytest.raises(KeyError):
        s.update({}, 9)
