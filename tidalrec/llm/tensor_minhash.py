"""MinHash near-duplicates with tensored banding.

Two collections of short minhash groups are computed per document, ``groups``
each; a table key is a pair (i-th group of the first, j-th of the second), so
``2 * groups`` groups give ``groups ** 2`` tables.  With 8 groups of 2 values a
document needs 32 minhash values for 64 tables of 4 values (256 values without
the pairing).  A pair of Jaccard similarity s is missed only if all groups of
one collection differ: at most 2 * (1 - s^2)^8, 7e-5 at 0.85 and 6e-4 at 0.8.
Every link is confirmed on the full shingle sets.

Words are ``[^\\x20\\x09-\\x0D]+`` after lower-casing A-Z; the set holds the
distinct 5-word shingles, with fewer words the whole sequence as one shingle.

Defined cases: null, empty and blank texts have an empty set and link with
nothing; equal sets (exact copies, repeated rows) form one class before any
table is built, so a class of any size costs one document; rows that share an id
are classed each by its own text; a row without an id joins the class of an
equal text and, if none of its rows has an id, is kept with a null component; an
empty table gives an empty result; other columns are never read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidalrec.llm.common import Scratch, load, mix64, sieve, window_hashes, word_hashes
from tidalrec.llm.components import least_ids, link_buckets, with_keys


@dataclass(frozen=True)
class NearDedup:
    """Parameters: link where 100 * |A and B| >= percent * |A or B|."""
    percent: int = 80
    width: int = 5
    groups: int = 8
    per_group: int = 2
    seed: int = 20


def shingle_set(text: bytes | None, width: int) -> np.ndarray:
    """Sorted distinct 64-bit shingle hashes of a text."""
    words = word_hashes((text or b"").lower())
    if not len(words):
        return words
    return np.unique(window_hashes(words, min(width, len(words))))


def _minhash(shingles: np.ndarray, salts: np.ndarray, odd: np.ndarray) -> np.ndarray:
    """Minimum of each hash function over the set, in blocks that stay in cache."""
    out = np.full(len(salts), np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(shingles), 2048):
        x = shingles[i:i + 2048, None] ^ salts
        x *= odd
        np.minimum(out, x.min(axis=0), out=out)
    return out


def _digest(shingles: np.ndarray) -> tuple[int, int]:
    digest = xxhash.xxh3_128_intdigest(shingles.tobytes())
    return (digest >> 64) - 2**63, (digest & (2**64 - 1)) - 2**63


def sketches(docs: DataFrame, p: NearDedup, id_col: str, text_col: str, carry: tuple[str, ...] = ()) -> DataFrame:
    """(id, n, d1, d2, halves, carried columns): set size, 128-bit digest of the set, 2 * groups group hashes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rng = np.random.default_rng(p.seed)
        k = 2 * p.groups * p.per_group
        salts = rng.integers(0, 2**64, k, dtype=np.uint64)
        odd = rng.integers(0, 2**64, k, dtype=np.uint64) | np.uint64(1)
        for batch in batches:
            n, d1, d2, halves = [], [], [], []
            for text in batch.column(1).cast(pa.binary()):
                s = shingle_set(text.as_py(), p.width)
                n.append(len(s))
                for half, of in zip(_digest(s), (d1, d2)):
                    of.append(half)
                if len(s):
                    values = _minhash(s, salts, odd).reshape(2 * p.groups, p.per_group)
                    acc = np.arange(2 * p.groups, dtype=np.uint64)
                    for j in range(p.per_group):
                        acc = mix64(acc * np.uint64(0x9E3779B97F4A7C15) + values[:, j])
                    halves.append(acc.view(np.int64))
                else:
                    halves.append(np.empty(0, np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(d1, pa.int64()), pa.array(d2, pa.int64()),
                 pa.array(halves, pa.list_(pa.int64())), *batch.columns[2:]],
                names=["id", "n", "d1", "d2", "halves", *carry])

    types = dict(docs.dtypes)
    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("t"), *carry).mapInArrow(
        run, ", ".join(["id long, n long, d1 long, d2 long, halves array<long>", *(f"`{c}` {types[c]}" for c in carry)]))


def _sets(docs: DataFrame, p: NearDedup) -> DataFrame:
    """(id, d1, d2, shingles) of documents (id, t), each different set of an id once."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingle_set(t.as_py(), p.width) for t in batch.column(1).cast(pa.binary())]
            halves = list(zip(*map(_digest, sets))) or [(), ()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(h, pa.int64()) for h in halves),
                 pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))], names=["id", "d1", "d2", "shingles"])
    return docs.mapInArrow(run, "id long, d1 long, d2 long, shingles array<long>").groupBy("id", "d1", "d2").agg(
        F.first("shingles").alias("shingles"))


def _prefix_pairs(sets: DataFrame, ids: DataFrame, p: NearDedup) -> DataFrame:
    """Pairs (a, b) in different components that may reach the similarity; none that does is left out.

    With the shingles of every set in one common order, two sets with
    |A and B| >= t |A or B| share one of the first n - ceil(t n) + 1 of each, and
    they share nothing before the first one they share, at ranks i and j, so
    |A and B| <= min(n - i, n' - j).  Ordered by how few sets hold them, the first
    shingles are mostly those of one document alone, so copies that drifted
    apart make no pairs.
    """
    tokens = sets.select("id", F.size("shingles").alias("n"), F.explode("shingles").alias("s"))
    often = tokens.groupBy("s").agg(F.count(F.lit(1)).alias("f")).where("f > 1")
    length = F.col("n") - F.ceil(F.col("n") * p.percent / 100) + 1
    alone = F.col("n") - F.size("shared")
    prefix = tokens.join(often, "s").groupBy("id", "n").agg(
        F.sort_array(F.collect_list(F.struct("f", "s"))).alias("shared")).where(length > alone).select(
        "id", "n", alone.alias("alone"),
        F.posexplode(F.slice("shared", F.lit(1), (length - alone).cast("int"))["s"]).alias("i", "s"))
    x = prefix.join(ids, "id").select("s", "id", "n", "component", (F.col("n") - F.col("alone") - F.col("i")).alias("rest"))
    y = x.select(*(F.col(c).alias(f"{c}_") for c in x.columns))
    most = F.least("rest", "rest_")
    return x.join(y, (F.col("s") == F.col("s_")) & (F.col("id") < F.col("id_"))
                  & (F.col("component") != F.col("component_"))
                  & (100 * most >= p.percent * (F.col("n") + F.col("n_") - most))).select(
        F.col("id").alias("a"), F.col("id_").alias("b")).distinct()


def near_duplicates(docs: DataFrame, p: NearDedup = NearDedup(), id_col: str = "doc_id",
                    text_col: str = "text", carry: tuple[str, ...] = ()) -> DataFrame:
    """One row per input row: id, n_shingles, component_id (least id reachable), carried columns, kept."""
    scratch = Scratch(docs.sparkSession, "near-dedup")
    marks = scratch.put(sketches(docs, p, id_col, text_col, carry))
    classes, several = with_keys(marks.where("n > 0").groupBy("d1", "d2").agg(
        F.min("id").alias("least"), F.first("n").alias("n"), F.first("halves").alias("halves")), scratch)
    classes = scratch.put(classes)

    first = F.slice("halves", 1, p.groups)
    second = F.slice("halves", p.groups + 1, p.groups)
    keys = F.flatten(F.transform(first, lambda a: F.transform(second, lambda b: F.xxhash64(a, b))))
    members = classes.select(F.explode(keys).alias("key"), "id", "n", F.lit(True).alias("home"))

    def sized(x, y):  # |A and B| <= the smaller set, so other sizes can't reach the similarity
        return 100 * F.least(x("n"), y("n")) >= p.percent * F.greatest(x("n"), y("n"))

    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("t"))

    def full_sets(keys: DataFrame) -> DataFrame:
        """(id, shingles) of classes, each from a row of its least id and its digest."""
        wanted = scratch.put(keys.join(classes.select("id", "least", "d1", "d2"), "id").withColumnRenamed("id", "class"))
        ids = wanted.select(F.col("least").alias("id")).distinct()
        sets = _sets(sieve(texts, "id", ids).join(ids, "id", "left_semi"), p)
        return scratch.put(sets.withColumnRenamed("id", "least").join(wanted, ["least", "d1", "d2"]).select(
            F.col("class").alias("id"), "shingles"))

    def verify(pairs: DataFrame) -> DataFrame:
        sets = full_sets(pairs.select(F.col("a").alias("id")).union(pairs.select(F.col("b").alias("id"))).distinct())
        both = pairs.join(sets.select(F.col("id").alias("a"), F.col("shingles").alias("sa")), "a").join(
            sets.select(F.col("id").alias("b"), F.col("shingles").alias("sb")), "b")
        shared = F.size(F.array_intersect("sa", "sb"))
        either = F.size("sa") + F.size("sb") - shared
        return both.where(100 * shared >= p.percent * either).select("a", "b").distinct()

    def across(named: DataFrame) -> DataFrame:
        ids = scratch.put(named.select("id", "component").distinct())
        return _prefix_pairs(full_sets(ids), ids, p)

    linked = least_ids(link_buckets(members, verify, sized, scratch, across), classes, several)
    classed = classes.join(linked, "id", "left").select("d1", "d2", F.coalesce("component", "least").alias("component"))
    out = marks.join(classed, ["d1", "d2"], "left").select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"),
        F.coalesce("component", "id").alias("component_id"), *carry)
    return out.withColumn("kept", F.col("component_id").eqNullSafe(F.col(id_col)))


def op5_tensor_minhash(spark, sf_dir: str) -> DataFrame:
    """Classes of documents linked at Jaccard 0.85 of their 5-word shingles."""
    return near_duplicates(load(spark, sf_dir, "documents"), NearDedup(percent=85))
