"""Embedding tables, stacked pooling and tower / scorer inference.

Embedding tables live in a DataFrame ``(feature, token_index, vec)`` so that an
id table with hundreds of millions of rows is joined (shuffle) instead of
being shipped to every task; small tables are broadcast after a size check.
The dense parts (pooling weights, MLP layers) are small NumPy arrays passed to
``mapInPandas`` closures.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidalrec.functions import netmath as NM
from tidalrec.functions.columns import md5_unit
from tidalrec.operators import skew as SK

# embedding tables above this many bytes are joined with a shuffle
BROADCAST_TABLE_BYTES = 256 * 1024 * 1024


@dataclass
class TowerParams:
    """Small dense parameters of one tower (NumPy)."""
    features: list[str]                       # categorical features in stacking order
    dense: list[str]                          # dense feature names (sorted order is used)
    pool: np.ndarray                          # (D, F [+1 if dense])
    layers: list[tuple[np.ndarray, np.ndarray]] = field(default_factory=list)
    bottom: list[tuple[np.ndarray, np.ndarray]] = field(default_factory=list)
    normalize: bool = True
    pooling: str = "stacked"                  # stacked | concat

    @property
    def dim(self) -> int:
        return self.pool.shape[0]


def init_tables(spark: SparkSession, cardinalities: dict[str, int], dim: int, seed: int,
                scale: float = 0.5, prefix: str = "") -> DataFrame:
    """Embedding rows derived from the vocabulary sizes, value
    (md5(seed|feature|token|d) in [0,1) - 0.5) * 2 * scale; generated in
    Spark, one task per slice of token ids."""
    parts = []
    for f, card in cardinalities.items():
        name = prefix + f
        parts.append(spark.range(int(card)).select(
            F.lit(name).alias("feature"), F.col("id").alias("token_index"),
            F.transform(F.sequence(F.lit(0), F.lit(dim - 1)),
                        lambda d: (md5_unit(F.lit(seed), F.lit(name), F.col("id"), d) - 0.5) * (2 * scale))
            .alias("vec")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def md5_weights(seed: int, name: str, n_out: int, n_in: int, half: float) -> np.ndarray:
    """(n_out, n_in) initial weights in [-half, half): the md5 unit of
    'seed|name|row|column', so that any engine can recompute them."""
    def unit(*parts) -> float:
        digits = hashlib.md5("|".join(map(str, parts)).encode()).hexdigest()[:15]
        return (int(digits, 16) >> 8) / float(1 << 52)
    return np.array([[(unit(seed, name, o, i) - 0.5) * 2 * half for i in range(n_in)] for o in range(n_out)])


def md5_layers(seed: int, name: str, sizes: list[int]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Linear layers ``<name><n>`` with biases, spread by the width of their input."""
    out = []
    for n, (a, b) in enumerate(zip(sizes[:-1], sizes[1:])):
        bound = 1.0 / np.sqrt(a)
        out.append((md5_weights(seed, f"{name}{n}", b, a, bound), md5_weights(seed, f"{name}{n}.bias", b, 1, bound)[:, 0]))
    return out


def init_params(features: list[str], dense: list[str], dim: int, hidden: list[int], seed: int,
                bottom: list[int] | None = None, pooling: str = "stacked") -> TowerParams:
    n_slots = len(features) + (1 if dense else 0)
    pool = md5_weights(seed, "pool", dim, n_slots, np.sqrt(6.0 / (dim + n_slots)))
    bottom_dims = list(bottom or [])
    if pooling == "stacked" and dense and bottom_dims and bottom_dims[-1] != dim:
        raise ValueError("dense bottom output width must equal the embedding dim for stacking")
    if dense and not bottom_dims:
        bottom_dims = [dim]
    in_dim = dim if pooling == "stacked" else dim * len(features) + (bottom_dims[-1] if dense else 0)
    return TowerParams(features=list(features), dense=sorted(dense), pool=pool,
                       layers=md5_layers(seed, "layer", [in_dim, *hidden]),
                       bottom=md5_layers(seed, "bottom", [len(dense), *bottom_dims]) if dense else [], pooling=pooling)


def attach_embeddings(encoded: DataFrame, tables: DataFrame, features: list[str],
                      cardinalities: dict[str, int], dim: int, prefix: str = "") -> DataFrame:
    """One column ``<feature>__vec`` per categorical feature: left equi-join of
    the token on the feature's table (broadcast when its size is small)."""
    out = encoded
    for f in features:
        t = tables.filter(F.col("feature") == prefix + f).select(
            F.col("token_index").alias(f"__tok_{f}"), F.col("vec").alias(f"{f}__vec"))
        keyed = out.withColumn(f"__tok_{f}", F.col(f).cast("bigint"))
        if cardinalities.get(f, 0) * dim * 8 <= min(BROADCAST_TABLE_BYTES, SK.BROADCAST_BYTES):
            joined = keyed.join(F.broadcast(t), f"__tok_{f}", "left")
        else:
            joined = SK.shuffled_left_join(keyed, t, [f"__tok_{f}"])
        out = joined.drop(f"__tok_{f}")
    return out


def _stack(pdf: pd.DataFrame, features: list[str], dim: int) -> np.ndarray:
    cols = []
    for f in features:
        vals = pdf[f"{f}__vec"].values
        cols.append(np.stack([np.asarray(v, dtype=np.float64) if v is not None else np.zeros(dim)
                              for v in vals]))
    return np.stack(cols, axis=1)  # (B, F, D)


def tower_numpy(pdf: pd.DataFrame, p: TowerParams) -> np.ndarray:
    emb = _stack(pdf, p.features, p.dim)
    if p.pooling == "concat":
        bottom = None
        if p.dense:
            bottom = NM.mlp(pdf[p.dense].to_numpy(dtype=np.float64), p.bottom, activate_last=True)
        x = NM.mlp(NM.concat_pool(emb, bottom), p.layers, activate_last=True)
        return NM.l2_normalize(x) if p.normalize else x
    if p.dense:
        x = pdf[p.dense].to_numpy(dtype=np.float64)
        bottom = NM.mlp(x, p.bottom, activate_last=True)
        emb = np.concatenate([emb, bottom[:, None, :]], axis=1)
    x = NM.stacked_pool(emb, p.pool)
    x = NM.mlp(x, p.layers, activate_last=True)
    return NM.l2_normalize(x) if p.normalize else x


def tower_embed(encoded: DataFrame, key: str, tables: DataFrame, p: TowerParams,
                cardinalities: dict[str, int], prefix: str = "") -> DataFrame:
    """Entity table -> (key, emb): lookups as joins, pooling + MLP + L2 norm in
    one vectorised ``mapInPandas`` stage per Arrow batch."""
    joined = attach_embeddings(encoded.select(key, *p.features, *p.dense), tables, p.features,
                               cardinalities, p.dim, prefix)
    key_type = dict(encoded.dtypes)[key]

    def run(batches):
        for pdf in batches:
            if len(pdf) == 0:
                continue
            out = tower_numpy(pdf, p)
            yield pd.DataFrame({key: pdf[key].values, "emb": list(out)})

    return joined.mapInPandas(run, f"{key} {key_type}, emb array<double>")


def pool_long(encoded: DataFrame, key: str, tables: DataFrame, features: list[str],
              pool: DataFrame, prefix: str = "") -> DataFrame:
    """Stacked pooling in long form (key, dim, value) with SQL operators only:
    token -> embedding row join, softmax of the pooling weights per dimension
    (a tiny table), weighted sum per (key, dim)."""
    pairs = F.array(*[F.struct(F.lit(prefix + f).alias("feature"), F.col(f).cast("bigint").alias("token_index"))
                      for f in features])
    long = encoded.select(key, F.explode(pairs).alias("t")).select(key, "t.feature", "t.token_index")
    emb = long.join(tables, ["feature", "token_index"], "left")
    ex = emb.select(key, "feature", F.posexplode("vec").alias("dim", "e"))
    z = pool.groupBy("dim").agg(F.max("w").alias("_mx"))
    sm = pool.join(z, "dim").withColumn("_ex", F.exp(F.col("w") - F.col("_mx")))
    den = sm.groupBy("dim").agg(F.sum("_ex").alias("_den"))
    sm = sm.join(den, "dim").select("feature", "dim", (F.col("_ex") / F.col("_den")).alias("sm"))
    out = ex.join(F.broadcast(sm), ["feature", "dim"]).groupBy(key, "dim").agg(
        F.sum(F.col("sm") * F.col("e")).alias("value"))
    return out


def pool_vectors(encoded: DataFrame, key: str, tables: DataFrame, features: list[str],
                 pool: DataFrame, dim: int, prefix: str = "") -> DataFrame:
    """Stacked pooling with SQL operators on whole vectors: (key, vec).

    Softmax of the pooling weights over features per dimension is a tiny
    (feature -> weight vector) table, broadcast; each (key, feature) embedding
    row is weighted elementwise and the few rows of a key are summed (one
    shuffle of key x feature rows; the per-key list is bounded by the number
    of features)."""
    z = pool.groupBy("dim").agg(F.max("w").alias("_mx"))
    sm = pool.join(F.broadcast(z), "dim").withColumn("_ex", F.exp(F.col("w") - F.col("_mx")))
    den = sm.groupBy("dim").agg(F.sum("_ex").alias("_den"))
    sm = sm.join(F.broadcast(den), "dim").select("feature", "dim", (F.col("_ex") / F.col("_den")).alias("sm"))
    smv = sm.groupBy("feature").agg(F.array_sort(F.collect_list(F.struct("dim", "sm"))).alias("_s")).select(
        "feature", F.transform("_s", lambda x: x["sm"]).alias("_w"))
    pairs = F.array(*[F.struct(F.lit(prefix + f).alias("feature"), F.col(f).cast("bigint").alias("token_index"))
                      for f in features])
    long = encoded.select(key, F.explode(pairs).alias("t")).select(key, "t.feature", "t.token_index")
    emb = SK.lookup_join(long, tables, ["feature", "token_index"]).join(F.broadcast(smv), "feature")
    weighted = emb.select(key, F.zip_with("vec", "_w", lambda e, w: e * w).alias("_x"))
    zero = F.array_repeat(F.lit(0.0), dim)
    return weighted.groupBy(key).agg(F.collect_list("_x").alias("_xs")).select(
        key, F.aggregate("_xs", zero, lambda acc, x: F.zip_with(acc, x, lambda a, b: a + b)).alias("vec"))


def pool_table(spark: SparkSession, features: list[str], dim: int, seed: int, prefix: str = "") -> DataFrame:
    """Pooling weights (feature, dim, w) derived from md5 (for the long form)."""
    parts = [spark.range(dim).select(F.lit(prefix + f).alias("feature"), F.col("id").cast("int").alias("dim"),
                                     (md5_unit(F.lit(seed), F.lit("pool"), F.lit(prefix + f), F.col("id")) - 0.5)
                                     .alias("w")) for f in features]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# ---- scorers --------------------------------------------------------------------

@dataclass
class PairScorer:
    """Two-tower ranking head: MLP over [u, v, u*v, |u-v|], last layer linear."""
    layers: list[tuple[np.ndarray, np.ndarray]]

    def score(self, u: np.ndarray, v: np.ndarray) -> np.ndarray:
        return NM.mlp(NM.pair_features(u, v), self.layers, activate_last=False)[..., 0]

    def matrix(self, u: np.ndarray, v: np.ndarray) -> np.ndarray:
        """(len(u), len(v)): the score of every pair.  For a fixed u the first layer is linear in v and max(u, v), since
        |u - v| = 2 max(u, v) - u - v, so no pair's features are formed and the part of u alone is computed once."""
        (w, b), *rest = self.layers
        d = u.shape[1]
        wu, wv, wp, wa = (w[:, j * d:(j + 1) * d] for j in range(4))
        const = u @ (wu - wa).T + b
        vt = np.ascontiguousarray(v.T)
        x = np.concatenate([vt, np.empty_like(vt), np.ones((1, len(v)))])
        out = np.empty((len(u), len(v)))
        for i, row in enumerate(u):
            np.maximum(vt, row[:, None], out=x[d:2 * d])
            h = np.concatenate([wv - wa + wp * row, 2 * wa, const[i][:, None]], axis=1) @ x
            for lw, lb in rest:
                np.maximum(h, 0.0, out=h)
                h = lw @ h
                h += lb[:, None]
            out[i] = h[0]
        return out


def init_pair_scorer(dim: int, hidden: list[int], seed: int) -> PairScorer:
    return PairScorer(md5_layers(seed, "pair", [4 * dim, *hidden, 1]))


@dataclass
class DLRMScorer:
    """Concatenated embeddings + all pairwise dots (+ dense bottom output once)
    -> MLP with a linear last layer."""
    layers: list[tuple[np.ndarray, np.ndarray]]

    def score(self, feats: np.ndarray, dense_out: np.ndarray | None = None) -> np.ndarray:
        parts = [feats.reshape(feats.shape[0], -1), NM.pairwise_dots(feats)]
        if dense_out is not None:
            parts.append(dense_out)
        return NM.mlp(np.concatenate(parts, axis=1), self.layers, activate_last=False)[:, 0]


# ---- parameter naming (bundle layout) ---------------------------------------------

def _mlp_names(prefix: str, in_dim: int, dims: list[int], activate_last: bool = True) -> list[tuple[str, list[int]]]:
    """Linear layers of an MLP whose blocks are Linear, ReLU, Dropout."""
    out, a, idx = [], in_dim, 0
    for i, b in enumerate(dims):
        out.append((f"{prefix}.net.{idx}.weight", [b, a]))
        out.append((f"{prefix}.net.{idx}.bias", [b]))
        last = i == len(dims) - 1
        idx += 3 if (activate_last or not last) else 1
        a = b
    return out


def tower_param_shapes(prefix: str, cards: dict[str, int], dim: int, hidden: list[int],
                       n_dense: int = 0, bottom: list[int] | None = None) -> list[tuple[str, list[int]]]:
    out = [(f"{prefix}.embeddings.{f}.weight", [int(c), dim]) for f, c in cards.items()]
    if n_dense:
        out += _mlp_names(f"{prefix}.dense_bottom_mlp.mlp", n_dense, list(bottom or [dim]))
    out.append((f"{prefix}.weights", [dim, len(cards) + (1 if n_dense else 0)]))
    out += _mlp_names(f"{prefix}.mlp", dim, hidden)
    return out


def model_param_shapes(arch: str, ucards: dict[str, int], icards: dict[str, int], dim: int,
                       hidden: list[int], n_udense: int = 0, n_idense: int = 0,
                       scorer_hidden: list[int] | None = None) -> list[tuple[str, list[int]]]:
    """(name, shape) in parameter order for 'retrieval', 'two_tower' or 'dlrm'."""
    if arch in ("retrieval", "two_tower"):
        out = tower_param_shapes("user_tower", ucards, dim, hidden, n_udense)
        out += tower_param_shapes("item_tower", icards, dim, hidden, n_idense)
        if arch == "retrieval":
            out.append(("temperature", []))
        else:
            out += _mlp_names("scorer", 4 * hidden[-1], [*(scorer_hidden or [16]), 1], activate_last=False)
        return out
    if arch == "dlrm":
        cards = {**ucards, **icards}
        n = len(cards) + (1 if (n_udense + n_idense) else 0)
        out = [(f"encoder.embeddings.{f}.weight", [int(c), dim]) for f, c in cards.items()]
        if n_udense + n_idense:
            out += _mlp_names("encoder.dense_bottom_mlp.mlp", n_udense + n_idense, [dim])
        width = dim * n + n * (n - 1) // 2
        out += _mlp_names("mlp", width, [*hidden, 1], activate_last=False)
        return out
    raise ValueError(f"unknown architecture {arch}")


def shapes_frame(spark: SparkSession, shapes: list[tuple[str, list[int]]]) -> DataFrame:
    rows = [(n, "x".join(str(x) for x in s) if s else "scalar", i) for i, (n, s) in enumerate(shapes)]
    return spark.createDataFrame(rows, "param string, shape string, ord int")


def init_dlrm_scorer(n_slots: int, dim: int, hidden: list[int], seed: int) -> DLRMScorer:
    """Input width from the actual concatenation: n_slots*D + C(n_slots, 2)."""
    return DLRMScorer(md5_layers(seed, "dlrm", [n_slots * dim + n_slots * (n_slots - 1) // 2, *hidden, 1]))


def dlrm_score(rows: DataFrame, tables: DataFrame, user_features: list[str], item_features: list[str],
               dense: list[str], cards: dict[str, int], dim: int, scorer: DLRMScorer,
               bottom: list[tuple[np.ndarray, np.ndarray]] | None, key: str = "row_key") -> DataFrame:
    """Score (user, item) rows with a DLRM head: embedding lookups by join (columns
    ``user_<f>`` / ``item_<f>`` hold tokens), dense bottom output as one more
    slot, all pairwise dots, MLP.  One Arrow batch at a time."""
    feats = [("user.", f, f"user_{f}") for f in user_features] + [("item.", f, f"item_{f}") for f in item_features]
    x = rows.select(key, *[F.col(c).cast("bigint").alias(c) for _, _, c in feats], *dense)
    for pre, f, c in feats:
        t = tables.filter(F.col("feature") == pre + f).select(F.col("token_index").alias(c), F.col("vec").alias(c + "__vec"))
        if cards.get(pre + f, cards.get(f, 0)) * dim * 8 <= BROADCAST_TABLE_BYTES:
            t = F.broadcast(t)
        x = x.join(t, c, "left")
    cols = [c for _, _, c in feats]
    key_type = dict(rows.dtypes)[key]

    def run(batches):
        for pdf in batches:
            if len(pdf) == 0:
                continue
            emb = _stack(pdf.rename(columns={c + "__vec": c + "__vec" for c in cols}), cols, dim)
            if dense and bottom:
                d = NM.mlp(pdf[dense].to_numpy(dtype=np.float64), bottom, activate_last=True)
                emb = np.concatenate([emb, d[:, None, :]], axis=1)
            yield pd.DataFrame({key: pdf[key].values, "score": scorer.score(emb)})

    return x.mapInPandas(run, f"{key} {key_type}, score double")
