"""Importance resampling: hashed n-gram models of target and raw text, Gumbel top-k.

Words and word pairs are hashed into ``buckets``; the target model is fitted on
the labelled rows of good quality that are not toxic, the raw model on all rows.
The target's probability of a bucket is shrunk towards the raw one by a prior of
``prior`` counts, so a bucket without evidence has a ratio of 1, and a
document's own counts are left out of both models when it is scored.  A
document's log weight is the sum of its log ratios, tempered to ``temper`` grams
for longer documents so that length alone neither adds nor removes weight.

Adding a Gumbel draw keyed by (seed, id, text) to the log weights and keeping
the k largest draws k documents without replacement in proportion to their
weights.  k is the number of rows above the share ``miss`` of the weights of
labelled target documents; an explicit ``k`` overrides this.

Defined cases: null, empty and blank texts have no grams and are rejected; with
no labelled target or no labelled other document nothing can be learnt, every
weight is 0 and all documents with a word are kept; rows that share an id are
scored each by its own text; equal rows get equal draws and stand or fall
together; an empty table gives an empty result; other columns are never read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidalrec.llm.common import Scratch, load, mix64, word_hashes


@dataclass(frozen=True)
class Resampling:
    buckets: int = 1 << 16
    prior: float = 4.0
    temper: int = 200
    miss: float = 0.002
    k: int | None = None
    seed: int = 8


def gram_counts(text: bytes | None, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of a text's words and word pairs, and how often each occurs."""
    words = word_hashes(text or b"")
    pairs = mix64(words[:-1] * np.uint64(0x9E3779B97F4A7C15) + words[1:])
    return np.unique((np.concatenate([words, pairs]) % np.uint64(buckets)).astype(np.int64), return_counts=True)


def fit(docs: DataFrame, p: Resampling) -> tuple[np.ndarray, np.ndarray]:
    """Counts per bucket in target and raw text, from all rows of (id, t, target)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        target, raw = np.zeros(p.buckets, np.int64), np.zeros(p.buckets, np.int64)
        for batch in batches:
            for text, is_target in zip(batch.column(1).cast(pa.binary()), batch.column(2).to_pylist()):
                b, c = gram_counts(text.as_py(), p.buckets)
                raw[b] += c
                if is_target:
                    target[b] += c
        some = np.flatnonzero(raw)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(target[some]), pa.array(raw[some])],
                                         names=["bucket", "target", "raw"])

    rows = docs.mapInArrow(run, "bucket long, target long, raw long").groupBy("bucket").agg(
        F.sum("target").alias("target"), F.sum("raw").alias("raw")).toPandas()  # at most ``buckets`` rows
    target, raw = np.zeros(p.buckets), np.zeros(p.buckets)
    target[rows["bucket"]], raw[rows["bucket"]] = rows["target"], rows["raw"]
    return target, raw


def log_weights(docs: DataFrame, target: np.ndarray, raw: np.ndarray, p: Resampling,
                carry: tuple[str, ...] = ()) -> DataFrame:
    """(id, target, n_grams, log_weight, score, carried columns) of rows (id, t, target, carried columns)."""
    share = target.sum() / raw.sum() if raw.sum() else 0.0
    models = docs.sparkSession.sparkContext.broadcast((target, raw))  # 16 bytes a bucket

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash
        tgt, all_ = models.value
        for batch in batches:
            n, w, score = [], [], []
            for i, text, is_target in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()),
                                          batch.column(2).to_pylist()):
                text = text.as_py() or b""
                b, c = gram_counts(text, p.buckets)
                total = int(c.sum())
                expected = share * (all_[b] - c)
                seen = tgt[b] - c if is_target else tgt[b]
                ratio = np.log((np.maximum(seen, 0) + p.prior) / (expected + p.prior))
                weight = float(c @ ratio) * min(1.0, p.temper / max(total, 1)) if share else 0.0
                u = (xxhash.xxh3_64_intdigest(b"%d\x00%d\x00" % (p.seed, -1 if i is None else i) + text) + 0.5) / 2.0**64
                n.append(total)
                w.append(weight)
                score.append(weight - float(np.log(-np.log(u))))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(n, pa.int64()), pa.array(w, pa.float64()),
                 pa.array(score, pa.float64()), *batch.columns[3:]],
                names=["id", "target", "n_grams", "log_weight", "score", *carry])

    types = dict(docs.dtypes)
    return docs.mapInArrow(run, ", ".join(["id long, target boolean, n_grams long, log_weight double, score double",
                                           *(f"`{c}` {types[c]}" for c in carry)]))


def kth_largest(rows: DataFrame, column: str, k: int, bins: int = 4096) -> float:
    """The k-th largest value, by counting in ever finer bins: no sort, ``bins`` rows a pass."""
    lo, hi, n = rows.agg(F.min(column), F.max(column), F.count(column)).first()
    if k >= n:
        return lo if lo is not None else float("-inf")
    above = 0
    while lo < hi:
        step = (hi - lo) / bins
        if not lo + step > lo:
            break
        cell = F.least(F.floor((F.col(column) - F.lit(lo)) / F.lit(step)), F.lit(bins - 1))
        counts = rows.where(F.col(column).between(lo, hi)).groupBy(cell.alias("cell")).agg(
            F.count(F.lit(1)).alias("n"), F.min(column).alias("lo"), F.max(column).alias("hi")).collect()
        for r in sorted(counts, key=lambda r: -r["cell"]):
            if above + r["n"] >= k:
                lo, hi = r["lo"], r["hi"]
                break
            above += r["n"]
    return hi


BROADCAST_LABELS = 2_000_000  # rows of 9 bytes; beyond it the join is shuffled


def labelled(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             carry: tuple[str, ...] = ()) -> DataFrame:
    """(id, t, target, carried columns): target if some label says good and none says bad or toxic."""
    lab = labels.where(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").cast("long").alias("id")).agg(
        F.min((F.col("quality") == 1) & ~(F.coalesce(F.col("toxic"), F.lit(0)) == 1)).alias("good")).where("good")
    if lab.count() <= BROADCAST_LABELS:  # else the texts would be shuffled for one bit each
        lab = F.broadcast(lab)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("t"), *carry)
    return rows.join(lab, "id", "left").select("id", "t", F.coalesce("good", F.lit(False)).alias("target"), *carry)


def resample(docs: DataFrame, labels: DataFrame, p: Resampling = Resampling(), id_col: str = "doc_id",
             text_col: str = "text", carry: tuple[str, ...] = ()) -> DataFrame:
    """One row per input row: id, n_grams, log_weight, score, kept, carried columns."""
    scratch = Scratch(docs.sparkSession, "resampling")
    rows = labelled(docs, labels, id_col, text_col, carry)
    target, raw = fit(rows, p)
    scored = scratch.put(log_weights(rows, target, raw, p, carry))
    usable = scored.where("n_grams > 0")
    k = p.k
    if k is None:
        good = usable.where("target")
        n_good = good.count()
        if n_good:
            floor = kth_largest(good, "log_weight", n_good - int(p.miss * n_good))
            k = usable.where(F.col("log_weight") >= F.lit(floor)).count()
        else:
            k = usable.count()
    cut = kth_largest(usable, "score", k)
    return scored.select(F.col("id").alias(id_col), "n_grams", "log_weight", "score",
                         ((F.col("n_grams") > 0) & (F.col("score") >= F.lit(cut)) & F.lit(k > 0)).alias("kept"), *carry)


def op8_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents drawn by their likeness to labelled good text."""
    return resample(load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels"))
