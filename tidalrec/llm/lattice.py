"""Embedding near-duplicates with E8 lattice hashing.

Per table a vector is projected to 8 dimensions by a random Gaussian matrix and
decoded to the nearest point of the E8 lattice, which names its cell.  A vector
is stored in its own cell of every table and probes the cells around it whose
points are nearest to its projection.  With unit scale, 8 tables and 8 probes a
pair of cosine 0.95 shares a cell of one table with probability 0.64 (measured
on random pairs), so it is missed by all tables in about 3 of 10,000 cases;
closer pairs are missed less.  A 64-bit sign sketch rules most strangers out
before their vectors are fetched; every link is verified by the cosine in double
precision.

A cell's vectors are first compared with its centre.  Cells that this leaves in
several components are compared pair by pair if they have at most ``crowd``
members; larger ones are cut into blocks that meet as matrix products, from
which no pairs leave the task but the edges of a spanning forest of its links, so
a cell of any size, linked or not, gives rows in proportion to its members.

The number of links of each vector is counted inside the components found, by
blocks of ``block`` vectors against each other: matrix products whose counts,
not pairs, leave the task.

Defined cases: null, zero and non-finite vectors, and vectors with null
components, link with nothing; vectors of different lengths never link; equal
vectors (copies, repeated rows) form one class before any table is built and
count as links of each other; an empty table gives an empty result; other
columns are never read.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidalrec.llm.common import Scratch, load, mix64
from tidalrec.llm.components import least_ids, link_buckets, with_keys
from tidalrec.operators.skew import lookup_join


@dataclass(frozen=True)
class LatticeLinks:
    cosine: float = 0.95
    tables: int = 8
    probes: int = 8
    scale: float = 1.0
    sketch_distance: int = 22   # of 64 sign bits; a pair of cosine 0.95 differs in 6.5 on average, 2.4 deviation
    block: int = 1024
    crowd: int = 64             # members up to which a cell's pairs are made
    seed: int = 2


def minimal_vectors() -> np.ndarray:
    """The 240 shortest vectors of E8."""
    out = []
    for i, j in itertools.combinations(range(8), 2):
        for a, b in itertools.product((1.0, -1.0), repeat=2):
            v = np.zeros(8)
            v[i], v[j] = a, b
            out.append(v)
    out += [np.array(s) for s in itertools.product((0.5, -0.5), repeat=8) if np.sum(np.array(s) < 0) % 2 == 0]
    return np.array(out)


def _nearest_d8(x: np.ndarray) -> np.ndarray:
    """Nearest integer points of even sum: round, and move the worst coordinate where the sum is odd."""
    r = np.rint(x)
    odd = np.flatnonzero(r.sum(axis=1) % 2)
    d = x[odd] - r[odd]
    k = np.abs(d).argmax(axis=1)
    r[odd, k] += np.where(d[np.arange(len(odd)), k] >= 0, 1.0, -1.0)
    return r


def nearest_e8(x: np.ndarray) -> np.ndarray:
    """Nearest points of E8, the union of D8 and D8 shifted by one half."""
    a, b = _nearest_d8(x), _nearest_d8(x - 0.5) + 0.5
    return np.where((((x - a) ** 2).sum(axis=1) <= ((x - b) ** 2).sum(axis=1))[:, None], a, b)


def unit_rows(v: np.ndarray) -> np.ndarray:
    v = v / np.abs(v).max(axis=-1, keepdims=True)  # no square overflows
    return v / np.sqrt((v * v).sum(axis=-1, keepdims=True))


def cells(u: np.ndarray, p: LatticeLinks) -> tuple[np.ndarray, np.ndarray]:
    """(n, tables, 1 + probes) cell keys, the own cell first, and (n,) sign sketches, of unit vectors."""
    dim = u.shape[1]
    rng = np.random.default_rng([p.seed, dim])
    around = minimal_vectors()
    keys = np.empty((len(u), p.tables, 1 + p.probes), np.uint64)
    for t in range(p.tables):
        y = u @ rng.normal(size=(dim, 8)) / p.scale
        home = nearest_e8(y)
        best = np.argsort(-((y - home) @ around.T), axis=1, kind="stable")[:, :p.probes]
        points = np.concatenate([home[:, None], home[:, None] + around[best]], axis=1)
        acc = np.full(points.shape[:2], t * 65_537 + dim, np.uint64)
        for c in np.moveaxis(np.rint(2 * points).astype(np.int64), 2, 0):
            acc = mix64(acc * np.uint64(0x9E3779B97F4A7C15) + c.view(np.uint64))
        keys[:, t] = acc
    signs = (u @ rng.normal(size=(dim, 64))) > 0
    return keys, np.packbits(signs, axis=1).view(np.uint64)[:, 0]


def _matrix(column: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
    """(rows, vectors) per vector length of a list column."""
    sizes = np.diff(column.offsets.to_numpy())
    flat, starts = column.values.to_numpy(zero_copy_only=False), column.offsets.to_numpy()[:-1]
    return [(rows, flat[starts[rows][:, None] + np.arange(d)]) for d in np.unique(sizes)
            for rows in [np.flatnonzero(sizes == d)]]


def bucket_rows(classes: DataFrame, p: LatticeLinks) -> DataFrame:
    """(key, id, home, sketch) of (id, v)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy()
            for rows, v in _matrix(batch.column(1)):
                for at in range(0, len(rows), 1024):
                    keys, sketch = cells(unit_rows(v[at:at + 1024]), p)
                    n, per = len(keys), p.tables * (1 + p.probes)
                    home = np.zeros((p.tables, 1 + p.probes), bool)
                    home[:, 0] = True
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(keys.reshape(-1).view(np.int64)), pa.array(np.repeat(ids[rows[at:at + 1024]], per)),
                         pa.array(np.tile(home.reshape(-1), n)), pa.array(np.repeat(sketch.view(np.int64), per))],
                        names=["key", "id", "home", "sketch"])
    return classes.mapInArrow(run, "key long, id long, home boolean, sketch long")


def _link_counts(table: pa.Table, p: LatticeLinks) -> pa.Table:
    """(id, n): links of each vector of a block with those of another block, or of its own."""
    ids, weight = table["id"].to_numpy(), table["copies"].to_numpy()
    lo, hi, own = (table[c].to_numpy() for c in ("lo", "hi", "own"))
    n = np.zeros(len(ids), np.int64)
    for rows, v in _matrix(table["v"].combine_chunks()):
        u = unit_rows(v)
        if lo[0] == hi[0]:
            near = u @ u.T >= p.cosine
            np.fill_diagonal(near, False)
            n[rows] = near @ weight[rows]
        else:
            a, b = np.flatnonzero(own[rows] == lo[0]), np.flatnonzero(own[rows] == hi[0])
            near = u[a] @ u[b].T >= p.cosine
            n[rows[a]] = near @ weight[rows[b]]
            n[rows[b]] = near.T @ weight[rows[a]]
    return pa.table({"id": ids, "n": n})


def _forest(near: np.ndarray) -> np.ndarray:
    """For a boolean matrix of links between rows and columns, the least node each one reaches.

    Nodes are the rows and behind them the columns; a node without links reaches itself.
    """
    rows, cols = near.shape
    least = np.arange(rows + cols)
    linked_r, linked_c = np.flatnonzero(near.any(axis=1)), np.flatnonzero(near.any(axis=0))
    near = near[np.ix_(linked_r, linked_c)]
    if not near.size:
        return least
    none = rows + cols
    while True:
        r, c = least[linked_r], least[rows + linked_c]
        new_c = np.minimum(c, np.where(near, r[:, None], none).min(axis=0))
        new_r = np.minimum(r, np.where(near, new_c[None], none).min(axis=1))
        if (new_r == r).all() and (new_c == c).all():
            return least
        least[linked_r], least[rows + linked_c] = new_r, new_c


def _block_links(table: pa.Table, p: LatticeLinks) -> pa.Table:
    """(a, b): a spanning forest of the links between stored (home) and all members of two blocks of a cell."""
    ids, home = table["id"].to_numpy(), table["home"].to_numpy(zero_copy_only=False)
    a, b = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    for rows, v in _matrix(table["v"].combine_chunks()):
        u, own = unit_rows(v), home[rows]
        if own.any() and not own.all():
            node = np.concatenate([ids[rows[own]], ids[rows[~own]]])
            root = node[_forest(u[own] @ u[~own].T >= p.cosine)]
            a.append(np.minimum(node, root)[node != root])
            b.append(np.maximum(node, root)[node != root])
    return pa.table({"a": np.concatenate(a), "b": np.concatenate(b)})


def crowded_links(members: DataFrame, classes: DataFrame, p: LatticeLinks) -> DataFrame:
    """(a, b) that connect all links of the members (key, id, home, n) of large cells; classes has id, v."""
    with_v = members.join(classes.select("id", "v"), "id").withColumn(
        "blocks", F.ceil(F.col("n") / p.block)).withColumn("own", F.pmod(F.xxhash64("id"), F.col("blocks")))
    each = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))
    stored = with_v.where("home").select("key", F.col("own").alias("i"), each.alias("j"), "id", "home", "v")
    every = with_v.select("key", each.alias("i"), F.col("own").alias("j"), "id", F.lit(False).alias("home"), "v")
    return stored.union(every).groupBy("key", "i", "j").applyInArrow(
        lambda t: _block_links(t, p), "a long, b long").distinct()


def near_vectors(vectors: DataFrame, p: LatticeLinks = LatticeLinks(), id_col: str = "vec_id",
                 vector_col: str = "embedding") -> DataFrame:
    """One row per input row: id, n_links, component_id (least id reachable), kept."""
    scratch = Scratch(vectors.sparkSession, "lattice")
    v = F.col(vector_col).cast("array<double>")
    finite = F.forall(v, lambda x: F.coalesce((F.abs(x) < float("inf")) & ~F.isnan(x), F.lit(False)))
    usable = F.coalesce(finite & F.exists(v, lambda x: x != 0), F.lit(False))
    rows = scratch.put(vectors.select(
        F.col(id_col).cast("long").alias("id"), F.when(usable, v).alias("v")).select(
        "id", "v", F.when(F.col("v").isNotNull(), F.xxhash64("v")).alias("d1"),
        F.when(F.col("v").isNotNull(), F.xxhash64(F.lit(p.seed), "v")).alias("d2")))
    classes, several = with_keys(rows.where("v is not null and id is not null").groupBy("d1", "d2").agg(
        F.min("id").alias("least"), F.count(F.lit(1)).alias("copies"), F.first("v").alias("v")), scratch)
    classes = scratch.put(classes)

    def verify(pairs: DataFrame) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                keep = np.zeros(batch.num_rows, bool)
                same = {d: (r, x) for (r, x) in _matrix(batch.column(2)) for d in [x.shape[1]]}
                for r, y in _matrix(batch.column(3)):
                    if y.shape[1] in same:
                        ra, x = same[y.shape[1]]
                        both, ia, ib = np.intersect1d(ra, r, return_indices=True)
                        keep[both] = (unit_rows(x[ia]) * unit_rows(y[ib])).sum(axis=1) >= p.cosine
                yield batch.select(["a", "b"]).filter(pa.array(keep))
        own = classes.select(F.col("id").alias("a"), F.col("v").alias("va"))
        other = classes.select(F.col("id").alias("b"), F.col("v").alias("vb"))
        return lookup_join(lookup_join(pairs, own, "a"), other, "b").select("a", "b", "va", "vb").mapInArrow(
            run, "a long, b long").distinct()

    def near(x, y):
        return F.bit_count(x("sketch").bitwiseXOR(y("sketch"))) <= p.sketch_distance

    found = link_buckets(bucket_rows(classes.select("id", "v"), p), verify, near, scratch,
                         crowded=lambda members: crowded_links(members, classes, p), crowd=p.crowd)

    sizes = found.groupBy("component").agg(F.ceil(F.count(F.lit(1)) / p.block).alias("blocks"))
    linked = found.join(sizes, "component").join(classes.select("id", "copies", "v"), "id").withColumn(
        "own", F.pmod(F.xxhash64("id"), F.col("blocks")))
    dealt = linked.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))).select(
        "component", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"), "own",
        "id", "copies", "v")
    counts = dealt.groupBy("component", "lo", "hi").applyInArrow(
        lambda t: _link_counts(t, p), "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))
    named = least_ids(found, classes, several)
    per_class = classes.select("id", "least", "d1", "d2", "copies").join(named, "id", "left").join(counts, "id", "left").select(
        "d1", "d2", F.coalesce("component", "least").alias("component"),
        (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("links"))
    out = rows.select("id", "d1", "d2").join(per_class, ["d1", "d2"], "left").select(
        F.col("id").alias(id_col), F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component", "id").alias("component_id"))
    return out.withColumn("kept", F.col("component_id").eqNullSafe(F.col(id_col)))


def op2_lattice_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classes of embeddings linked at cosine 0.95, and every vector's number of links."""
    return near_vectors(load(spark, sf_dir, "embeddings"))
