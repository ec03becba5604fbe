"""Negatives, batches, training-row invariants."""

from pyspark.sql import functions as F

from tidalrec.operators import training_rows as TR
from tidalrec.sources.tables import batch_count


def test_n_negatives_per_positive(spark):
    rows = spark.range(500).select(F.col("id").cast("string").alias("row_key"))
    d = TR.sample_negative_positions(rows, 3, 17, seed=1)
    per = d.groupBy("row_key").count().select(F.min("count"), F.max("count")).first()
    assert tuple(per) == (3, 3)
    rng = d.select(F.min("neg_position"), F.max("neg_position")).first()
    assert rng[0] >= 1 and rng[1] <= 17
    again = TR.sample_negative_positions(rows, 3, 17, seed=1)
    assert d.exceptAll(again).count() == 0       # deterministic


def test_batches(spark):
    rows = spark.range(1000).select(F.col("id").cast("string").alias("row_key"))
    b = TR.assign_batches(rows, 128, seed=3)
    sizes = sorted((r.batch_id, r["count"]) for r in b.groupBy("batch_id").count().collect())
    assert [s for _, s in sizes] == [128] * 7 + [104]
    assert batch_count(1000, 128, 2) == 8 * 3 and batch_count(0, 128) == 0


def test_labeled_rows_from_catalog(spark):
    from tidalrec.plans import catalog as C
    df = C.train_rows_labeled(spark, "/root/testdata/sf0.001")
    n_pos = df.filter("draw = 0").count()
    assert df.filter("draw > 0").count() == 2 * n_pos
    assert df.filter("draw > 0 AND label != 0").count() == 0
    assert df.filter("item_position = 0").count() == 0


def test_skew_safe_left_join_equals_plain_join(spark):
    from tidalrec.operators.skew import left_join_skew_safe
    fact = spark.range(3000).select(F.when(F.col("id") < 1000, F.lit(7)).otherwise(F.col("id") % 50).alias("k"),
                                    F.col("id"))
    fact = fact.unionByName(spark.createDataFrame([(None, -1)], "k long, id long"))
    lookup = spark.range(40).select(F.col("id").alias("k"), (F.col("id") * 10).alias("v"))
    got = left_join_skew_safe(fact, lookup, "k", hot_share=0.05)
    ref = fact.join(lookup, "k", "left")
    assert got.count() == ref.count() == 3001
    assert got.exceptAll(ref).count() == 0 and ref.exceptAll(got).count() == 0


def test_training_rows_with_forced_skew_path(spark, monkeypatch):
    from tidalrec.operators import training_rows as TRr
    from tidalrec.plans import catalog as C
    base = sorted(map(tuple, C.train_rows_positive(spark, "/root/testdata/sf0.001").collect()))
    monkeypatch.setattr(TRr, "BROADCAST_LOOKUP", 0)
    forced = sorted(map(tuple, C.train_rows_positive(spark, "/root/testdata/sf0.001").collect()))
    assert base == forced


def test_positives_of_labeled_rows_are_computed_once(spark):
    """Both parts read the stored positives: no plan above them joins or reads the facts again (both did before)."""
    from tidalrec.operators.store import EntityStore
    facts = spark.range(60).select(F.col("id").cast("string").alias("row_key"), (F.col("id") % 9).alias("l_partkey"),
                                   (F.col("id") % 4).alias("user_id"), (F.col("id") % 9 + 1).alias("item_id"),
                                   F.lit(1.0).alias("label"), F.lit(0).alias("draw"), (F.col("id") % 9 + 1).alias("item_position"),
                                   F.when(F.col("id") % 7 > 0, F.col("id") % 3).alias("item_c"))
    table = spark.createDataFrame([(str(i), i + 1, i % 3) for i in range(9)], "id_key string, position long, c long")
    store = EntityStore(table, "c", ["c"], ["c"], [], 9)
    rows = TR.labeled_rows(facts, store, 2, 7, "l_partkey")
    assert "Range (0, 60" not in rows._jdf.queryExecution().executedPlan().toString()
    got = rows.collect()
    assert len(got) == 180 and rows.columns == facts.columns
    assert sorted(map(tuple, (r for r in got if r.label))) == sorted(map(tuple, facts.collect()))
    drawn = {(r.row_key, r.draw): r for r in got if not r.label}
    want = {(r.row_key, r.draw): r.neg_position for r in TR.sample_negative_positions(facts.drop("draw"), 2, 9, 7).collect()}
    assert {k: r.item_position for k, r in drawn.items()} == want
    assert all(r.l_partkey == r.item_position - 1 and r.item_c == r.l_partkey % 3 for r in drawn.values())
