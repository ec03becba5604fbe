"""Losses as column expressions and aggregates."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidalrec.functions.vectors import dot


def bce_with_logits(x, y) -> Column:
    """max(x, 0) - x*y + log1p(exp(-|x|)): finite for any logit."""
    x = F.col(x) if isinstance(x, str) else x
    y = F.col(y) if isinstance(y, str) else y
    return F.greatest(x, F.lit(0.0)) - x * y + F.log1p(F.exp(-F.abs(x)))


def squared_error(p, y) -> Column:
    p = F.col(p) if isinstance(p, str) else p
    y = F.col(y) if isinstance(y, str) else y
    return (p - y) * (p - y)


def grouped_mean_loss(df: DataFrame, loss: Column, group: str) -> DataFrame:
    """Mean loss per group (a batch / epoch slice) and the overall mean
    recombined from the group summaries as sum(mean * n) / sum(n)."""
    per = df.groupBy(group).agg(F.count(F.lit(1)).alias("n"), F.avg(loss).alias("mean_loss"))
    total = per.agg(F.lit("ALL").alias(group), F.sum("n").alias("n"),
                    (F.sum(F.col("mean_loss") * F.col("n")) / F.sum("n")).alias("mean_loss"))
    return per.select(F.col(group).cast("string").alias(group), "n", "mean_loss").unionByName(total)


BLOCK_ROWS = 4096  # rows of one side of a batch that a task holds


def _block_sums(temperature: float):
    """Streams (batch, rb, cb) groups sorted by side: holds the row block, passes over the column block in
    Arrow batches, and keeps of each row the running maximum and the sum of exp(score - maximum)."""
    def run(batches):
        group, keys, own, rows = None, [], [], []
        top = total = matrix = None

        def done():
            if top is not None:
                yield pd.DataFrame({"key": keys, "batch": group[0], "m": top, "s": total, "own": own})

        for pdf in batches:
            columns = pdf[["batch", "rb", "cb"]].to_numpy()
            cuts = np.flatnonzero(np.r_[True, (columns[1:] != columns[:-1]).any(axis=1)])
            for at, to in zip(cuts, [*cuts[1:], len(pdf)]):
                now = tuple(columns[at])
                if now != group:
                    yield from done()
                    group, keys, own, rows = now, [], [], []
                    top = total = matrix = None
                part = pdf.iloc[at:to]
                left = part[part["side"] == 0]
                keys += left["key"].tolist()
                own += left["own"].tolist()
                rows += left["vec"].tolist()
                right = part.loc[part["side"] == 1, "vec"]
                if not len(right) or not rows:
                    continue
                if matrix is None:
                    matrix = np.stack(rows)
                    top, total = np.full(len(rows), -np.inf), np.zeros(len(rows))
                scores = matrix @ np.stack(right.to_numpy()).T / temperature
                higher = np.maximum(top, scores.max(axis=1))
                total = total * np.exp(top - higher) + np.exp(scores - higher[:, None]).sum(axis=1)
                top = higher
        yield from done()
    return run


def in_batch_softmax_loss(df: DataFrame, key: str, batch: str, u: str, v: str,
                          temperature: float = 0.05, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Per row i of a batch: logsumexp_j(s_ij) - s_ii with s_ij = <u_i, v_j> / t.

    A batch of B rows is cut into n = ceil(B / block_rows) blocks; each row is sent n times as a row and n times as a
    column, every pair of blocks meets in one task as matrix products, and the parts of a row (a maximum and a sum
    scaled by it) are merged by key.  So B^2 scores are computed but only about 2 n B rows move, and a batch of any
    size is spread over n^2 groups.  Keys are integers, unique in their batch; rows with a null key, batch or vector take no part.
    """
    rows = df.select(F.col(key).cast("bigint").alias("key"), F.col(batch).cast("bigint").alias("batch"), F.col(u).alias("u"),
                     F.col(v).alias("v")).where("key is not null and batch is not null and u is not null and v is not null")
    sizes = rows.groupBy("batch").agg(F.ceil(F.count(F.lit(1)) / block_rows).cast("int").alias("n"))
    rows = rows.join(sizes, "batch").withColumn("mine", F.pmod(F.xxhash64("key"), F.col("n")).cast("int"))
    every = F.explode(F.sequence(F.lit(0), F.col("n") - 1))
    double = lambda c: F.transform(c, lambda x: x.cast("double"))
    left = rows.select("batch", F.col("mine").alias("rb"), every.alias("cb"), F.lit(0).alias("side"), "key",
                       (dot("u", "v") / F.lit(temperature)).alias("own"), double("u").alias("vec"))
    right = rows.select("batch", every.alias("rb"), F.col("mine").alias("cb"), F.lit(1).alias("side"), "key",
                        F.lit(None).cast("double").alias("own"), double("v").alias("vec"))
    group = ["batch", "rb", "cb"]
    parts = left.unionByName(right).repartition(*group).sortWithinPartitions(*group, "side", "key").mapInPandas(
        _block_sums(temperature), "key bigint, batch bigint, m double, s double, own double")
    by_row = Window.partitionBy("key", "batch")
    merged = parts.withColumn("top", F.max("m").over(by_row)).groupBy("key", "batch").agg(
        (F.max("top") + F.log(F.sum(F.col("s") * F.exp(F.col("m") - F.col("top")))) - F.max("own")).alias("loss"))
    return merged.select(F.col("key").alias(key), F.col("batch").alias(batch), "loss")
