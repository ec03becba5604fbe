"""Nearest items from short codes: cells of cells, product-quantised codes, exact scores of what remains.

* Two levels of cells: about n^(1/4) centres, and about as many inside each,
  so about sqrt(n) cells in all, and a row or a query meets only about
  2 n^(1/4) centres.  The centres are DataFrames; no model is held anywhere.
* Each row is kept as ``parts`` bytes: its vector's parts, each replaced by the
  nearest of 256 code words.  A query is compared with the codes of the
  probed cells by table look-ups, and only its ``rescore`` best rows have
  their vectors read and are scored exactly.  A fixed number of vectors is read
  per query, so their share falls as one over the number of rows; the codes
  take 1/32 of the bytes of the vectors (64 doubles as 16 bytes).
* Centres and code words are fitted on at most about ``fit_rows`` rows, chosen by
  a hash of the id; every row is indexed.

Probing all cells and rescoring all rows equals exact search.  Rows with a null
vector take no part; ties go to the lesser id; an empty side gives no rows.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidalrec.functions.vectors import dot, l2_normalize
from tidalrec.operators import vector_search as VS
from tidalrec.session import cut_lineage

FIT_ROWS = 65_536
WORDS = 256
CODE_ROWS = 16_384  # rows of a block of codes
QUERY_CHUNK = 16_384  # queries that meet a block of codes at once
FIT_STEP = 4_096  # rows that a fit compares with its centres at once
INNER = 1 << 20  # an inner cell's id is outer * INNER + inner


@dataclass
class PQIndex:
    vectors: DataFrame     # item_id, vec
    codes: DataFrame       # item_id, cell, code
    outer: DataFrame       # item_id (the outer cell), vec
    inner: DataFrame       # cell (the outer cell), item_id (the cell), vec
    words: np.ndarray      # parts x WORDS x length of a part
    n_cells: int
    n_items: int


def lloyd(x: np.ndarray, k: int, seed: int, spherical: bool, rounds: int = 12) -> np.ndarray:
    """k-means centres of the rows of x (at most one per distinct row); unit centres by the inner product if spherical."""
    x = np.unique(x, axis=0)
    if len(x) <= k:
        return x
    c = x[np.sort(np.random.default_rng(seed).choice(len(x), k, replace=False))]
    for _ in range(rounds):
        less = 0 if spherical else 0.5 * (c * c).sum(1)
        near = np.concatenate([np.argmax(x[at:at + FIT_STEP] @ c.T - less, axis=1) for at in range(0, len(x), FIT_STEP)])
        n = np.bincount(near, minlength=k)
        total = np.zeros_like(c)
        np.add.at(total, near, x)
        c = np.where(n[:, None] > 0, total / np.maximum(n, 1)[:, None], c)
        if spherical:
            c /= np.maximum(np.linalg.norm(c, axis=1, keepdims=True), 1e-12)
    return c


def _centres(k: int, seed: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        c = lloyd(np.stack(pdf["vec"].to_numpy()), k, seed, True)
        return pd.DataFrame({"cell": int(pdf["cell"].iloc[0]), "at": np.arange(len(c)), "vec": list(c)})
    return run


def _code_words(seed: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        c = lloyd(np.stack(pdf["vec"].to_numpy()), WORDS, seed, False)
        return pd.DataFrame({"cell": int(pdf["cell"].iloc[0]), "at": np.arange(len(c)), "vec": list(c)})
    return run


_FITTED = "cell bigint, at bigint, vec array<double>"


def _best(queries: DataFrame, items: DataFrame, k: int) -> DataFrame:
    """(qid, item_id): the k best items of each (cell, qid, k, vec) among the (cell, item_id, vec) of its cells."""
    nq = queries.groupBy("cell").agg(F.count("vec").alias("rows"))
    ni = items.groupBy("cell").agg(F.count("vec").alias("rows"), F.max(F.size("vec")).alias("dim"))
    lists = VS._score_groups(queries, items, VS._block_counts(nq, ni), k, None, 1.0, None, False)
    return VS._final_topk(lists, k).select("qid", "item_id")


def _in_outer(rows: DataFrame, outer: DataFrame, n: int) -> DataFrame:
    """(cell, qid, k, vec): each (qid, vec) with the n outer cells nearest to it."""
    near = VS.exact_topk(rows, outer, n).select("qid", F.col("item_id").alias("cell"))
    return near.join(rows, "qid").select("cell", "qid", F.lit(1).cast("bigint").alias("k"), "vec")


def build(items: DataFrame, key: str, vec: str, parts: int = 16, n_cells: int | None = None, seed: int = 7,
          fit_rows: int = FIT_ROWS) -> PQIndex:
    """Index of the unit vectors of ``items``; the vectors' length must be a multiple of ``parts``."""
    base = items.where(F.col(vec).isNotNull()).select(F.col(key).cast("bigint").alias("item_id"), l2_normalize(vec).alias("vec"))
    n, dim = base.agg(F.count(F.lit(1)), F.max(F.size("vec"))).first()
    if n and dim % parts:
        raise ValueError(f"vectors of length {dim} don't fall into {parts} parts")
    n_cells = VS.cells_for(n) if n_cells is None else n_cells
    per = max(1, math.isqrt(max(0, n_cells - 1)) + 1)
    share = F.pmod(F.xxhash64("item_id", F.lit(seed)), F.lit(1 << 30))
    some = base if n <= fit_rows else base.where(share < int(fit_rows / n * (1 << 30)))
    zero = F.lit(0).cast("bigint")
    # one task fits few centres on the bounded sample; the inner ones and the code words are fitted side by side
    outer = cut_lineage(some.withColumn("cell", zero).groupBy("cell").applyInPandas(_centres(per, seed), _FITTED)).select(
        F.col("at").alias("item_id"), "vec")
    rows = base.select(F.col("item_id").alias("qid"), "vec")
    placed = _in_outer(rows, outer, 1)
    sample = placed if n <= fit_rows else placed.where(
        F.pmod(F.xxhash64("qid", F.lit(seed)), F.lit(1 << 30)) < int(fit_rows / n * (1 << 30)))
    inner = cut_lineage(sample.select("cell", "vec").groupBy("cell").applyInPandas(_centres(per, seed), _FITTED)).select(
        "cell", (F.col("cell") * INNER + F.col("at")).alias("item_id"), "vec")
    width = (dim or parts) // parts
    cut = F.array(*(F.slice("vec", j * width + 1, width) for j in range(parts)))
    fitted = some.select(F.posexplode(cut).alias("cell", "vec")).groupBy("cell").applyInPandas(_code_words(seed), _FITTED).collect()
    words = np.zeros((parts, WORDS, width))  # parts x 256 words, whatever the number of rows
    words[:, :, :] = np.inf
    for r in fitted:
        words[r.cell, r.at] = r.vec
    cells = _best(placed, inner, 1).select(F.col("qid").alias("item_id"), F.col("item_id").alias("cell"))
    codes = base.join(cells, "item_id").mapInPandas(_encode(words), "item_id bigint, cell bigint, code binary")
    return PQIndex(base, cut_lineage(codes), outer, inner, words, n_cells, n)


def encode(x: np.ndarray, words: np.ndarray) -> np.ndarray:
    """rows x parts: the nearest code word of each part of each row."""
    parts, _, width = words.shape
    out = np.empty((len(x), parts), np.uint8)
    for j in range(parts):
        w = words[j][np.isfinite(words[j]).all(axis=1)]
        out[:, j] = np.argmax(x[:, j * width:(j + 1) * width] @ w.T - 0.5 * (w * w).sum(1), axis=1)
    return out


def _encode(words: np.ndarray):
    def run(batches):
        for pdf in batches:
            if len(pdf):
                codes = encode(np.stack(pdf["vec"].to_numpy()), words)
                yield pd.DataFrame({"item_id": pdf["item_id"], "cell": pdf["cell"], "code": [c.tobytes() for c in codes]})
    return run


def _code_lists(probes: DataFrame, index: PQIndex, take: int) -> DataFrame:
    """Local lists (qid, item_id, score, k) of the ``take`` rows whose codes score best, per block of queries and codes."""
    items = index.codes
    nq = probes.groupBy("cell").agg(F.count("vec").alias("rows"))
    ni = items.groupBy("cell").agg(F.count("code").alias("rows"))
    per_block = F.lit(CODE_ROWS)
    sizes = F.broadcast(nq.select("cell", VS._n_blocks(F.col("rows"), F.lit(QUERY_CHUNK)).alias("n_q")).join(
        ni.select("cell", VS._n_blocks(F.col("rows"), per_block).alias("n_i")), "cell"))  # a row per cell, sqrt(n) at most
    upto = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    q = (probes.join(sizes, "cell").withColumn("qb", VS._block_of("qid", "n_q"))
         .groupBy("cell", "qb", "n_i").agg(F.collect_list(F.struct("qid", "vec")).alias("m"))
         .select("cell", "qb", upto("n_i").alias("ib"), F.lit(0).alias("side"), F.col("m.qid").alias("ids"),
                 F.flatten("m.vec").alias("flat"), F.lit(None).cast("array<binary>").alias("codes")))
    i = (items.join(sizes, "cell").withColumn("ib", VS._block_of("item_id", "n_i"))
         .groupBy("cell", "ib", "n_q").agg(F.collect_list(F.struct("item_id", "code")).alias("m"))
         .select("cell", upto("n_q").alias("qb"), "ib", F.lit(1).alias("side"), F.col("m.item_id").alias("ids"),
                 F.lit(None).cast("array<double>").alias("flat"), F.col("m.code").alias("codes")))
    words = np.where(np.isfinite(index.words), index.words, 0.0)

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        side = {int(r.side): r for r in pdf.itertuples()}
        out = []
        if len(side) == 2:
            qids, ids = np.asarray(side[0].ids, np.int64), np.asarray(side[1].ids, np.int64)
            codes = np.frombuffer(b"".join(side[1].codes), np.uint8).reshape(len(ids), -1)
            qm = np.asarray(side[0].flat, np.float64).reshape(len(qids), -1)
            step = max(1, VS.SCORE_BYTES // (8 * len(ids)))
            width = words.shape[2]
            for at in range(0, len(qids), step):
                part = qm[at:at + step]
                s = np.zeros((len(part), len(ids)))
                for j in range(words.shape[0]):
                    s += (part[:, j * width:(j + 1) * width] @ words[j].T)[:, codes[:, j]]
                rr, cc, _ = VS.topk_rows(s, ids, take)
                out.append(pd.DataFrame({"qid": qids[at + rr], "item_id": ids[cc], "score": s[rr, cc], "k": take}))
        return pd.concat(out) if out else pd.DataFrame({c: [] for c in ("qid", "item_id", "score", "k")})

    return q.unionByName(i).groupBy("cell", "qb", "ib").applyInPandas(run, VS.OUT_SCHEMA)


def probes_for(n_cells: int) -> int:
    """Cells whose codes are compared with a query; their share falls as the index grows."""
    return max(1, math.ceil(n_cells ** 0.9))


def search(index: PQIndex, queries: DataFrame, k: int, q_key: str = "qid", q_vec: str = "vec", nprobe: int | None = None,
           rescore: int | None = None) -> DataFrame:
    """(qid, item_id, score, rank): of the ``nprobe`` best cells' rows the ``rescore`` best by code, the k best by vector.

    ``rescore`` is 20 k unless given.  Query ids are unique.
    """
    nprobe = probes_for(index.n_cells) if nprobe is None else nprobe
    rescore = 20 * k if rescore is None else rescore
    q = queries.where(F.col(q_vec).isNotNull()).select(
        F.col(q_key).cast("bigint").alias("qid"), VS.to_double_vec(q_vec).alias("vec"))
    per = max(1, math.isqrt(max(0, index.n_cells - 1)) + 1)
    n_outer = min(per, math.ceil(nprobe / per) + math.isqrt(per) + 1)  # some more than the cells would fill
    cells = _best(_in_outer(q, index.outer, n_outer if nprobe < index.n_cells else per), index.inner, nprobe if
                  nprobe < index.n_cells else per * per)
    probes = cells.select("qid", F.col("item_id").alias("cell")).join(q, "qid")
    near = VS._final_topk(_code_lists(probes, index, rescore), rescore).select("qid", "item_id")
    scored = near.join(index.vectors, "item_id").join(q.select("qid", F.col("vec").alias("q")), "qid").select(
        "qid", "item_id", dot("q", "vec").alias("score"), F.lit(k).cast("bigint").alias("k"))
    return VS._final_topk(scored, k)
