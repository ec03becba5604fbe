"""Segment affinity distributions and weighted sampling.

Re-aimed from the reference's synthetic generator: the segment -> preferred
item value maps are measured from train interactions instead of drawn at
random, and everything is computed at (user segment key x item profile)
granularity, whose size depends on segment cardinalities, not on the number
of users or items.  Items that match no preference share one 'rest' row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidalrec.functions.columns import md5_unit


def preference_maps(inter: DataFrame, user_segs: list[str], item_cols: list[str]) -> DataFrame:
    """(seg_col, seg_value, item_col, pref_value): for every user segment value
    the most frequent item value among its interactions (ties: smallest text)."""
    u = F.array(*[F.struct(F.lit(s).alias("seg_col"), F.col(s).cast("string").alias("seg_value"))
                  for s in user_segs])
    i = F.array(*[F.struct(F.lit(c).alias("item_col"), F.col(c).cast("string").alias("item_value"))
                  for c in item_cols])
    x = inter.select(F.explode(u).alias("u"), i.alias("i")).select("u.*", F.explode("i").alias("i")).select(
        "seg_col", "seg_value", "i.*")
    counts = x.groupBy("seg_col", "seg_value", "item_col", "item_value").agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy("seg_col", "seg_value", "item_col").orderBy(F.col("n").desc(), F.col("item_value"))
    return (counts.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") == 1)
            .select("seg_col", "seg_value", "item_col", F.col("item_value").alias("pref_value")))


def affinity_scores(keys: DataFrame, profiles: DataFrame, prefs: DataFrame, user_segs: list[str],
                    item_cols: list[str]) -> DataFrame:
    """(key cols, profile cols, score, n_items) for every (key, profile) with at
    least one matching preference; score = number of matching (seg, item col)
    terms.  Equi-joins only: key -> preferred value -> profiles holding it."""
    parts = []
    for s in user_segs:
        for c in item_cols:
            p = prefs.filter((F.col("seg_col") == s) & (F.col("item_col") == c)).select(
                F.col("seg_value").alias("_sv"), F.col("pref_value").alias("_pv"))
            k = keys.withColumn("_sv", F.col(s).cast("string")).join(p, "_sv").drop("_sv")
            m = k.join(profiles.withColumn("_pv", F.col(c).cast("string")), "_pv").drop("_pv")
            parts.append(m.select(*user_segs, *item_cols, "n_items"))
    allm = parts[0]
    for q in parts[1:]:
        allm = allm.unionByName(q)
    return allm.groupBy(*user_segs, *item_cols).agg(F.count(F.lit(1)).alias("score"),
                                                    F.first("n_items").alias("n_items"))


def affinity_softmax(scores: DataFrame, keys: DataFrame, n_items_total: int, user_segs: list[str],
                     item_cols: list[str], floor: float = -2.0) -> DataFrame:
    """Per key: probability of one item of each profile (scores floored at
    ``floor``), plus a rest row (item cols NULL, score 0) for items matching
    nothing.  sum over rows of n_items * prob = 1 per key."""
    matched = scores.withColumn("score", F.greatest(F.col("score").cast("double"), F.lit(floor)))
    per_key = matched.groupBy(*user_segs).agg(F.sum("n_items").alias("_nm"))
    rest = (keys.join(per_key, user_segs, "left")
            .select(*user_segs, *[F.lit(None).cast("string").alias(c) for c in item_cols],
                    F.lit(max(0.0, floor)).alias("score"),
                    (F.lit(n_items_total) - F.coalesce(F.col("_nm"), F.lit(0))).alias("n_items"))
            .filter(F.col("n_items") > 0))
    rows = matched.select(*user_segs, *[F.col(c).cast("string").alias(c) for c in item_cols], "score",
                          F.col("n_items").cast("bigint").alias("n_items")).unionByName(
        rest.withColumn("n_items", F.col("n_items").cast("bigint")))
    w = Window.partitionBy(*user_segs)
    mx = F.max("score").over(w)
    z = F.sum(F.col("n_items") * F.exp(F.col("score") - mx)).over(w)
    return rows.withColumn("prob", F.exp(F.col("score") - mx) / z)


def cumulative_weights(weights: DataFrame, key: str, choice: str, weight: str) -> DataFrame:
    """(key, choice, lo, hi, total) with intervals in choice order."""
    w = Window.partitionBy(key).orderBy(choice)
    return (weights.withColumn("hi", F.sum(weight).over(w.rowsBetween(Window.unboundedPreceding, 0)))
            .withColumn("lo", F.col("hi") - F.col(weight))
            .withColumn("total", F.sum(weight).over(Window.partitionBy(key))))


SHARD_DRAWS = 1_000_000  # draws of a key that one task walks through, about


def weighted_sample(draws: DataFrame, draw_key: str, key: str, cum: DataFrame, choice: str,
                    seed: int, shard_draws: int = SHARD_DRAWS) -> DataFrame:
    """One choice per draw with probability weight / total of its key: an md5
    uniform u in [0,1) picks the interval lo <= u * total < hi.

    Interval starts and draws of a key are merged in order: a draw takes the last
    start at or before it.  So no draw meets an interval that isn't its own, nothing
    is broadcast by assumption, and a window of running frames streams.  A key with
    many draws is split into shards of about ``shard_draws``, each with the key's
    intervals.  Draws of a key without weights are left out, as is a null key.
    """
    starts = cum.where(F.col("hi") > F.col("lo")).select(
        F.col(key).alias("_k"), F.struct(F.col(choice).alias("c")).alias("_c"), F.col("lo").cast("double").alias("_x"),
        F.col("total").alias("_total"))
    shards = draws.groupBy(F.col(key).alias("_k")).agg(
        F.ceil(F.count(F.lit(1)) / shard_draws).cast("int").alias("_shards"))
    keys = starts.groupBy("_k").agg(F.max("_total").alias("_total")).join(shards, "_k")
    mine = draws.select(F.struct(*draws.columns).alias("_row"), F.col(key).alias("_k"),
                        md5_unit(F.lit(seed), F.col(draw_key)).alias("_u"), F.xxhash64(draw_key).alias("_h")).join(keys, "_k")
    mine = mine.select("_k", F.pmod("_h", F.col("_shards")).cast("int").alias("_shard"),
                       (F.col("_u") * F.col("_total")).alias("_x"), F.lit(1).alias("_kind"), "_row")
    each = starts.drop("_total").join(keys.select("_k", "_shards"), "_k").select(
        "_k", F.explode(F.sequence(F.lit(0), F.col("_shards") - 1)).alias("_shard"), "_x", F.lit(0).alias("_kind"), "_c")
    order = Window.partitionBy("_k", "_shard").orderBy("_x", "_kind").rowsBetween(Window.unboundedPreceding, 0)
    merged = each.unionByName(mine, allowMissingColumns=True).withColumn("_c", F.last("_c", ignorenulls=True).over(order))
    return merged.where("_kind = 1").select("_row.*", F.col("_c.c").alias(choice))
