"""Named analytic queries over the supplied test tables.

Roles: customer = users, part = items, orders joined to lineitem =
interactions (user o_custkey, item l_partkey, time o_orderdate, label
l_quantity), events = event stream, embeddings = vectors.  Every query reads
whole tables; floats are rounded to 6 places for the oracle comparison.
"""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidalrec.functions.columns import md5_unit
from tidalrec.operators import metrics as M
from tidalrec.operators import split as S
from tidalrec.operators import topk as K
from tidalrec.sources import tables as TB
from tidalrec.spec import tpch_spec

VAL_T = 0.2
KS = (5, 10, 20)
TOPK = 10


def R(col, name=None):
    """Round a double column to 6 places for comparison."""
    c = F.col(col) if isinstance(col, str) else col
    return F.round(c.cast("double"), 6).alias(name or col)


def spec():
    return tpch_spec()


def split_parts(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Train / val interactions; one job finds the threshold."""
    x = TB.interactions(spark, sf)
    return S.split_at(x, "o_orderdate", S.split_threshold(x, "o_orderdate", VAL_T))


# ---- step 1: split, seen sets, popularity top-k, ranking metrics ------------------

def time_split_rows(spark, sf):
    x = TB.interactions(spark, sf)
    t = S.tag_split(x, "o_orderdate", VAL_T)
    return t.select("row_key", F.col("o_custkey").alias("user_id"),
                    F.col("l_partkey").alias("item_id"), "is_train")


def _pairs(spark, sf, side: str):
    train, val = split_parts(spark, sf)
    sp = spec()
    src = train if side == "train" else val
    return K.known_pairs(src, TB.users(spark, sf), TB.items(spark, sf),
                         sp.inter_user, sp.inter_item, sp.user_id, sp.item_id)


def known_pairs(spark, sf):
    return _pairs(spark, sf, "val")


def user_item_sets(spark, sf):
    s = K.user_item_sets(_pairs(spark, sf, "train"))
    return s.select("user_id", F.size("items").cast("bigint").alias("n_items"),
                    F.array_join("items", ",").alias("items"))


def user_item_bitmaps(spark, sf):
    """Train item sets as bitmaps: items and the least and greatest of each user's buckets."""
    b = K.user_item_bitmaps(_pairs(spark, sf, "train"))
    counts = b.select("user_id", "bucket", F.bitmap_count("bitmap").alias("n_items"))
    ends = K.bitmap_items(b).groupBy("user_id", (F.floor(F.col("item_id") / 32768) + 1).alias("bucket")).agg(
        F.min("item_id").alias("first_item"), F.max("item_id").alias("last_item"))
    return counts.join(ends, ["user_id", "bucket"])


def known_pairs_merged(spark, sf):
    """Train and val pairs: two bitmap histories merged, then unpacked."""
    both = K.merge_bitmaps(*(K.user_item_bitmaps(_pairs(spark, sf, side)) for side in ("train", "val")))
    return K.bitmap_items(both)


def _popularity_topk(spark, sf, k):
    train, _ = split_parts(spark, sf)
    return K.popularity_topk_unseen(train, TB.users(spark, sf), TB.items(spark, sf), spec(), k)


def popularity_topk_unseen(spark, sf):
    return _popularity_topk(spark, sf, TOPK)


def _metrics_per_user(spark, sf):
    topk = _popularity_topk(spark, sf, max(KS))
    rel = _pairs(spark, sf, "val")
    return M.ranking_metrics_per_user(topk, rel, list(KS))


def ranking_metrics_per_user(spark, sf):
    d = _metrics_per_user(spark, sf)
    return d.select(*[R(c) if c not in ("user_id", "n_rel") else F.col(c) for c in d.columns])


def ranking_metrics_macro(spark, sf):
    d = M.macro_average(_metrics_per_user(spark, sf))
    return d.select(*[R(c) if c != "n_users" else F.col(c) for c in d.columns])


QUERIES = {
    "time_split_rows": time_split_rows,
    "known_pairs": known_pairs,
    "user_item_sets": user_item_sets,
    "user_item_bitmaps": user_item_bitmaps,
    "known_pairs_merged": known_pairs_merged,
    "popularity_topk_unseen": popularity_topk_unseen,
    "ranking_metrics_per_user": ranking_metrics_per_user,
    "ranking_metrics_macro": ranking_metrics_macro,
}


# ---- step 2: vocabularies, scalers, feature store --------------------------------

from tidalrec.operators import store as ST  # noqa: E402
from tidalrec.operators import vocab as V  # noqa: E402

ITEM_CAT = ["p_brand", "p_type", "p_size"]
TAIL_MIN = {"p_partkey": 5, "p_brand": 80, "p_type": 5, "p_size": 30}
ENC_MIN_USER = {"c_custkey": 40, "c_mktsegment": 5, "c_nationkey": 5}
ENC_MIN_ITEM = {"p_partkey": 30, "p_brand": 80, "p_type": 5, "p_size": 30}


def _vocab_cols(df):
    return df.select("column", "value", F.col("cnt").cast("bigint").alias("cnt"),
                     F.col("token_index").cast("bigint").alias("token_index"), "is_tail")


def value_counts(spark, sf):
    return V.value_counts([(TB.items(spark, sf), {c: c for c in ITEM_CAT})])


def id_counts_multi_source(spark, sf):
    train, _ = split_parts(spark, sf)
    return V.value_counts([(TB.users(spark, sf), {"c_custkey": "c_custkey"}),
                           (train, {"o_custkey": "c_custkey"})])


def vocab_fit(spark, sf):
    counts = V.value_counts([(TB.items(spark, sf), {c: c for c in ITEM_CAT})])
    return _vocab_cols(V.fit_vocabulary(counts, {c: 1 for c in ITEM_CAT}))


def _item_vocab(spark, sf, mins):
    train, _ = split_parts(spark, sf)
    cols = ["p_partkey", *ITEM_CAT]
    counts = V.value_counts([(TB.items(spark, sf), {c: c for c in cols}),
                             (train, {"l_partkey": "p_partkey"})])
    return V.fit_vocabulary(counts, mins)


def _user_vocab(spark, sf, mins):
    train, _ = split_parts(spark, sf)
    cols = ["c_custkey", "c_mktsegment", "c_nationkey"]
    counts = V.value_counts([(TB.users(spark, sf), {c: c for c in cols}),
                             (train, {"o_custkey": "c_custkey"})])
    return V.fit_vocabulary(counts, mins)


def vocab_fit_tail(spark, sf):
    return _vocab_cols(_item_vocab(spark, sf, TAIL_MIN))


def vocab_cardinality(spark, sf):
    iv = V.cardinality(_item_vocab(spark, sf, TAIL_MIN), TAIL_MIN)
    uv = V.cardinality(_user_vocab(spark, sf, ENC_MIN_USER), ENC_MIN_USER)
    return iv.unionByName(uv)


def vocab_encode(spark, sf):
    _, val = split_parts(spark, sf)
    uv = _user_vocab(spark, sf, ENC_MIN_USER)
    iv = _item_vocab(spark, sf, ENC_MIN_ITEM)
    out = V.encode_column(val, uv, "o_custkey", "c_custkey", out="user_token")
    out = V.encode_column(out, iv, "l_partkey", "p_partkey", out="item_token")
    return out.select("row_key", "user_token", "item_token")


def vocab_mismatch(spark, sf):
    items = TB.items(spark, sf)
    cols = ["p_partkey", *ITEM_CAT]
    mins = {c: 5 for c in cols}
    left = V.fit_vocabulary(V.value_counts([(items, {c: c for c in cols})]), mins)
    right = _item_vocab(spark, sf, mins)
    return V.vocab_mismatch(left, right)


def dense_fit(spark, sf):
    u = TB.users(spark, sf).select(
        "c_acctbal", F.lit(7.0).alias("const_col"), F.lit(None).cast("double").alias("empty_col"),
        F.when(F.col("c_acctbal") > 0, F.col("c_acctbal").cast("string")).otherwise(F.lit("n/a"))
        .alias("text_col"))
    s1 = V.fit_scalers(u, ["c_acctbal", "const_col", "empty_col", "text_col"])
    s2 = V.fit_scalers(TB.items(spark, sf), ["p_retailprice"])
    s = s1.unionByName(s2)
    return s.select("column", R("mean"), R("std"))


def dense_transform(spark, sf):
    u = TB.users(spark, sf)
    s = V.fit_scalers(u, ["c_acctbal"])
    return V.scale_columns(u, s, ["c_acctbal"]).select("c_custkey", R("c_acctbal"))


def _stores(spark, sf):
    train, _ = split_parts(spark, sf)
    sp = tpch_spec(min_counts={**ENC_MIN_USER, **ENC_MIN_ITEM})
    uenc, ienc = V.build_encoders(TB.users(spark, sf), TB.items(spark, sf), train, sp)
    us = ST.build_store(TB.users(spark, sf), uenc, "c_custkey")
    its = ST.build_store(TB.items(spark, sf), ienc, "p_partkey")
    return us, its


def _store_out(st):
    t = st.table
    return t.select("id_key", F.col("position").cast("bigint").alias("position"),
                    *[F.col(c) for c in st.cat_cols], *[R(c) for c in st.dense_cols])


def encode_users(spark, sf):
    return _store_out(_stores(spark, sf)[0])


def encode_items(spark, sf):
    return _store_out(_stores(spark, sf)[1])


def entity_positions(spark, sf):
    return ST.entity_positions(TB.items(spark, sf), "p_partkey").select(
        "id_key", "p_partkey", "position", "row_index")


def feature_lookup_unknown(spark, sf):
    us, _ = _stores(spark, sf)
    o = TB.load(spark, sf, "orders")
    ids = (o.select(F.col("o_custkey").alias("lookup_id"))
           .unionByName(o.select((-F.col("o_custkey") - 1).alias("lookup_id"))).distinct())
    out = us.lookup(ids, "lookup_id", prefix="user_")
    return out.select("lookup_id", F.col("user_position").cast("bigint").alias("position"),
                      "user_c_custkey", "user_c_mktsegment", "user_c_nationkey", R("user_c_acctbal"))


QUERIES.update({
    "value_counts": value_counts,
    "id_counts_multi_source": id_counts_multi_source,
    "vocab_fit": vocab_fit,
    "vocab_fit_tail": vocab_fit_tail,
    "vocab_cardinality": vocab_cardinality,
    "vocab_encode": vocab_encode,
    "vocab_mismatch": vocab_mismatch,
    "dense_fit": dense_fit,
    "dense_transform": dense_transform,
    "encode_users": encode_users,
    "encode_items": encode_items,
    "entity_positions": entity_positions,
    "feature_lookup_unknown": feature_lookup_unknown,
})


# ---- step 3: training rows ------------------------------------------------------

from tidalrec.operators import skew as SK  # noqa: E402
from tidalrec.operators import training_rows as TR  # noqa: E402

SEED = 42
NEG = 2
BATCH = 512


def _train_ctx(spark, sf):
    train, val = split_parts(spark, sf)
    sp = tpch_spec(min_counts={**ENC_MIN_USER, **ENC_MIN_ITEM})
    uenc, ienc = V.build_encoders(TB.users(spark, sf), TB.items(spark, sf), train, sp)
    us = ST.build_store(TB.users(spark, sf), uenc, "c_custkey")
    its = ST.build_store(TB.items(spark, sf), ienc, "p_partkey")
    return train, val, sp, uenc, ienc, us, its


POS_COLS = ["row_key", "user_id", "item_id", "user_position", "user_c_custkey", "user_c_mktsegment",
            "user_c_nationkey", "user_c_acctbal", "item_position", "item_p_partkey", "item_p_brand",
            "item_p_type", "item_p_size", "item_p_retailprice"]


def _round_out(df, cols):
    dt = dict(df.dtypes)
    return df.select(*[R(c) if dt[c] == "double" else F.col(c) for c in cols])


def train_rows_positive(spark, sf):
    train, _, sp, uenc, ienc, us, its = _train_ctx(spark, sf)
    pos = TR.positive_rows(train, sp, us, its, uenc, ienc)
    return _round_out(pos, POS_COLS)


def negatives_sampled(spark, sf):
    train, _, sp, uenc, ienc, us, its = _train_ctx(spark, sf)
    n_items = its.count()
    d = TR.sample_negative_positions(train.select("row_key"), NEG, n_items, SEED)
    ids = its.table.select(F.col("position").alias("neg_position"), F.col("id_key").alias("neg_item"))
    return SK.lookup_join(d, ids, "neg_position").select(
        "row_key", F.col("draw").cast("int").alias("draw"), "neg_position", "neg_item")


def train_rows_labeled(spark, sf):
    train, _, sp, uenc, ienc, us, its = _train_ctx(spark, sf)
    pos = TR.positive_rows(train, sp, us, its, uenc, ienc, with_label=True)
    cols = ["row_key", "draw", "l_partkey", "user_id", "item_id", "user_position", "item_position",
            "item_p_brand", "item_p_retailprice", "label"]
    rows = TR.labeled_rows(pos.select(*cols), its, NEG, SEED, "l_partkey")  # other columns needn't be written
    return _round_out(rows.withColumn("draw", F.col("draw").cast("int")), cols)


def batch_assignment(spark, sf):
    train, _ = split_parts(spark, sf)
    b = TR.assign_batches(train.select("row_key"), BATCH, SEED)
    return b.select("row_key", "batch_id")


QUERIES.update({
    "train_rows_positive": train_rows_positive,
    "negatives_sampled": negatives_sampled,
    "train_rows_labeled": train_rows_labeled,
    "batch_assignment": batch_assignment,
})


# ---- step 4: pointwise metrics, losses, latest interaction -----------------------

from tidalrec.functions.vectors import l2_normalize  # noqa: E402,F401
from tidalrec.operators import latest as LT  # noqa: E402
from tidalrec.operators import losses as LS  # noqa: E402

TEMP = 0.05
W_BATCH = 50


def _item_mean_pred(spark, sf):
    """val rows with pred = mean train quantity of the item (global train mean
    when the item has no train rows)."""
    train, val = split_parts(spark, sf)
    g = train.agg(F.avg("l_quantity").alias("g")).first()["g"]
    per_item = train.groupBy("l_partkey").agg(F.avg("l_quantity").alias("item_mean"))
    return (val.join(per_item, "l_partkey", "left")
            .withColumn("pred", F.coalesce(F.col("item_mean"), F.lit(g)))
            .withColumn("label", F.col("l_quantity").cast("double")))


def pointwise_metrics(spark, sf):
    m = M.pointwise_metrics(_item_mean_pred(spark, sf), "pred", "label", loss_func="mse")
    return m.select("n", R("rmse"), R("mae"), R("corr"), R("accuracy"))


def _event_logits(spark, sf):
    e = TB.load(spark, sf, "events")
    return e.select("event_id", "event_type", "user_id",
                    ((F.col("value") - 100.0) / 25.0).alias("logit"),
                    F.when(F.col("event_type") == "purchase", 1.0).otherwise(0.0).alias("label"))


def binary_accuracy(spark, sf):
    m = M.pointwise_metrics(_event_logits(spark, sf), "logit", "label", loss_func="binary_cross_entropy")
    return m.select("n", R("rmse"), R("mae"), R("corr"), R("accuracy"))


def bce_loss(spark, sf):
    e = _event_logits(spark, sf)
    out = LS.grouped_mean_loss(e, LS.bce_with_logits("logit", "label"), "event_type")
    return out.select("event_type", "n", R("mean_loss"))


def mse_loss(spark, sf):
    d = _item_mean_pred(spark, sf).withColumn("order_year", F.year("o_orderdate").cast("string"))
    out = LS.grouped_mean_loss(d, LS.squared_error("pred", "label"), "order_year")
    return out.select("order_year", "n", R("mean_loss"))


def in_batch_softmax_loss(spark, sf):
    w = TB.load(spark, sf, "embeddings").select(
        "vec_id", (F.col("vec_id") / W_BATCH).cast("bigint").alias("batch_id"),
        F.col("embedding").alias("u"), F.reverse("embedding").alias("v"))
    out = LS.in_batch_softmax_loss(w, "vec_id", "batch_id", "u", "v", TEMP)
    return out.select("vec_id", "batch_id", R("loss"))


def latest_interaction(spark, sf):
    e = TB.load(spark, sf, "events")
    return LT.latest_per_key(e, "user_id", "ts", ["event_id"], ["event_id", "event_type"])


def latest_interaction_orders(spark, sf):
    x = TB.interactions(spark, sf)
    out = LT.latest_per_key(x, "o_custkey", "o_orderdate",
                            ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"], ["l_partkey"])
    return out.select(F.col("o_custkey").alias("user_id"), F.col("l_partkey").alias("item_id"), "latest_date")


QUERIES.update({
    "pointwise_metrics": pointwise_metrics,
    "binary_accuracy": binary_accuracy,
    "bce_loss": bce_loss,
    "mse_loss": mse_loss,
    "in_batch_softmax_loss": in_batch_softmax_loss,
    "latest_interaction": latest_interaction,
    "latest_interaction_orders": latest_interaction_orders,
})


# ---- step 5: vector operators on embeddings ----------------------------------------

from tidalrec.functions import vectors as VEC  # noqa: E402
from tidalrec.operators import pq_index as PQ  # noqa: E402
from tidalrec.operators import vector_search as VS  # noqa: E402

VK = 10
SLICES = 4


def _emb(spark, sf):
    return TB.load(spark, sf, "embeddings")


def _label_centroids(spark, sf):
    return VS.group_centroids(_emb(spark, sf), "label", "embedding").select(
        F.col("label").cast("bigint").alias("qid"), "vec")


def vector_topk(spark, sf):
    w = _emb(spark, sf).select(F.col("vec_id").alias("item_id"), VEC.to_double_array("embedding").alias("vec"))
    out = VS.exact_topk(_label_centroids(spark, sf), w, VK)
    return out.select(F.col("qid").alias("label"), "rank", F.col("item_id").alias("vec_id"),
                      R("score"), R(F.lit(1.0) - F.col("score"), "distance"))


def _long(df, key, arr):
    return df.select(key, F.posexplode(arr).alias("dim", "value")).select(
        key, F.col("dim").cast("int").alias("dim"), R("value"))


def vector_l2_normalize(spark, sf):
    w = _emb(spark, sf).select("vec_id", VEC.l2_normalize("embedding").alias("v"))
    return _long(w, "vec_id", "v")


def pair_features(spark, sf):
    w = _emb(spark, sf).select("vec_id", VEC.pair_features("embedding", F.reverse("embedding")).alias("v"))
    return _long(w, "vec_id", "v")


def pairwise_interactions(spark, sf):
    """DLRM interaction: the 64-d vector as 4 feature embeddings of 16, the
    dot product of every unordered pair (C(4,2) = 6 terms)."""
    e = _emb(spark, sf)
    d = 16
    cols = []
    for a in range(SLICES):
        for b in range(a + 1, SLICES):
            cols.append(F.struct(F.lit(a).alias("f1"), F.lit(b).alias("f2"),
                                 VEC.dot(F.slice("embedding", a * d + 1, d), F.slice("embedding", b * d + 1, d))
                                 .alias("dot")))
    x = e.select("vec_id", F.explode(F.array(*cols)).alias("p"))
    return x.select("vec_id", F.col("p.f1").cast("int").alias("f1"), F.col("p.f2").cast("int").alias("f2"),
                    R(F.col("p.dot"), "dot"))


def ann_topk(spark, sf):
    """Label centres against an index of about sqrt(n) KMeans cells."""
    w = _emb(spark, sf)
    n_cells = VS.cells_for(w.count())
    index, cents = VS.build_cell_index(w, "vec_id", "embedding", n_cells)
    q = _label_centroids(spark, sf).select("qid", VEC.l2_normalize("vec").alias("vec"))
    out = VS.probe_topk(q, index, cents, VK, VS.probes_for(n_cells))
    return _ann_out(out)


def _ann_out(out):
    return out.select(F.col("qid").alias("label"), "rank", F.col("item_id").alias("vec_id"), R("score"))


def ann_topk_all_cells(spark, sf):
    """As ``ann_topk``, probing every cell: equal to exact search."""
    w = _emb(spark, sf)
    n_cells = VS.cells_for(w.count())
    index, cents = VS.build_cell_index(w, "vec_id", "embedding", n_cells)
    q = _label_centroids(spark, sf).select("qid", VEC.l2_normalize("vec").alias("vec"))
    return _ann_out(VS.probe_topk(q, index, cents, VK, n_cells))


def _label_queries(spark, sf):
    return _label_centroids(spark, sf).select("qid", VEC.l2_normalize("vec").alias("vec"))


def ann_pq_topk(spark, sf):
    """Label centres against two-level cells of product-quantised codes, the best by code scored exactly."""
    index = PQ.build(_emb(spark, sf), "vec_id", "embedding")
    return _ann_out(PQ.search(index, _label_queries(spark, sf), VK))


def ann_pq_all(spark, sf):
    """As ``ann_pq_topk`` over all cells and with every row scored exactly: equal to exact search."""
    index = PQ.build(_emb(spark, sf), "vec_id", "embedding")
    return _ann_out(PQ.search(index, _label_queries(spark, sf), VK, nprobe=index.n_cells, rescore=max(1, index.n_items)))


LABEL_PROBES = 2


def ann_topk_label_cells(spark, sf):
    """Index whose cells are given centres, the normalised label means: every
    vector goes to its nearest centre, the label queries probe two cells."""
    cents = _label_centroids(spark, sf).select(F.col("qid").cast("int").alias("cell"),
                                               VEC.l2_normalize("vec").alias("centroid"))
    w = _emb(spark, sf).select(F.col("vec_id").alias("item_id"), VEC.l2_normalize("embedding").alias("vec"))
    index = VS.assign_cells(w, cents)
    q = cents.select(F.col("cell").cast("bigint").alias("qid"), F.col("centroid").alias("vec"))
    return _ann_out(VS.probe_topk(q, index, cents, VK, LABEL_PROBES))


QUERIES.update({
    "vector_topk": vector_topk,
    "vector_l2_normalize": vector_l2_normalize,
    "pair_features": pair_features,
    "pairwise_interactions": pairwise_interactions,
    "ann_topk": ann_topk,
    "ann_topk_all_cells": ann_topk_all_cells,
    "ann_topk_label_cells": ann_topk_label_cells,
    "ann_pq_topk": ann_pq_topk,
    "ann_pq_all": ann_pq_all,
})


# ---- step 6/7: embeddings, towers, all-user top-k, two-stage recommend ----------------

import hashlib  # noqa: E402

import numpy as np  # noqa: E402
import pandas as pd  # noqa: E402

from tidalrec.operators import recommend as RC  # noqa: E402
from tidalrec.operators import towers as TW  # noqa: E402

DIM = 8
MODEL_MIN = {"c_custkey": 5, "c_mktsegment": 5, "c_nationkey": 5,
             "p_partkey": 1, "p_brand": 5, "p_type": 5, "p_size": 5}
U_FEATS = ["c_custkey", "c_mktsegment", "c_nationkey"]
I_FEATS = ["p_partkey", "p_brand", "p_type", "p_size"]
REC_K_DEFAULT = 20


def _model_ctx(spark, sf):
    train, val = split_parts(spark, sf)
    sp = tpch_spec(min_counts=MODEL_MIN)
    uenc, ienc = V.build_encoders(TB.users(spark, sf), TB.items(spark, sf), train, sp)
    us = ST.build_store(TB.users(spark, sf), uenc, "c_custkey")
    its = ST.build_store(TB.items(spark, sf), ienc, "p_partkey")
    ucard = {f: uenc.cardinality(f, MODEL_MIN[f]) for f in U_FEATS}
    icard = {f: ienc.cardinality(f, MODEL_MIN[f]) for f in I_FEATS}
    utab = TW.init_tables(spark, ucard, DIM, SEED, prefix="user.").persist()
    itab = TW.init_tables(spark, icard, DIM, SEED, prefix="item.").persist()
    return dict(train=train, val=val, us=us, its=its, ucard=ucard, icard=icard, utab=utab, itab=itab,
                uvocab=uenc.vocab, ivocab=ienc.vocab, uscal=uenc.scalers, iscal=ienc.scalers,
                usizes=uenc.sizes, isizes=ienc.sizes)


def sp_mins(cols):
    return {c: MODEL_MIN[c] for c in cols}


def _pooled(spark, sf, side, ctx=None):
    """(ctx, (id_key, vec)) pooled vectors of one side."""
    ctx = ctx or _model_ctx(spark, sf)
    st, tab, feats = (ctx["us"], ctx["utab"], U_FEATS) if side == "user" else (ctx["its"], ctx["itab"], I_FEATS)
    pool = TW.pool_table(spark, feats, DIM, SEED, prefix=f"{side}.")
    return ctx, TW.pool_vectors(st.table, "id_key", tab, feats, pool, DIM, prefix=f"{side}.")


def stacked_pooling(spark, sf):
    _, out = _pooled(spark, sf, "item")
    return out.select(F.col("id_key").cast("bigint").alias("p_partkey"), F.posexplode("vec").alias("dim", "value")) \
        .select("p_partkey", F.col("dim").cast("int"), R("value"))


def _as_vec(long_df, key):
    return long_df.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("dim", "value"))).alias("_s")).select(
        F.col(key).cast("bigint").alias(key), F.transform("_s", lambda s: s["value"]).alias("vec"))


def _towers(spark, sf):
    ctx = _model_ctx(spark, sf)
    up = TW.init_params(U_FEATS, ["c_acctbal"], DIM, [16, DIM], SEED)
    ip = TW.init_params(I_FEATS, ["p_retailprice"], DIM, [16, DIM], SEED + 1)
    ue = TW.tower_embed(ctx["us"].table, "id_key", ctx["utab"], up, ctx["ucard"], prefix="user.")
    ie = TW.tower_embed(ctx["its"].table, "id_key", ctx["itab"], ip, ctx["icard"], prefix="item.")
    return ctx, ue, ie


def tower_embed(spark, sf):
    _, _, ie = _towers(spark, sf)
    return _tower_out(ie)


def _tower_out(ie):
    return ie.select(F.col("id_key").cast("bigint").alias("p_partkey"), F.posexplode("emb").alias("dim", "value")) \
        .select("p_partkey", F.col("dim").cast("int").alias("dim"), R("value"))


def _unseen_topk(spark, sf, ctx, ue, ie, k, **kw):
    """Exact top-k of every user's unseen items from user and item embeddings."""
    sp = spec()
    seen = K.known_pairs(ctx["train"], TB.users(spark, sf), TB.items(spark, sf),
                         sp.inter_user, sp.inter_item, sp.user_id, sp.item_id).withColumnRenamed("user_id", "qid")
    q = ue.select(F.col("id_key").cast("bigint").alias("qid"), F.col("emb").alias("vec"))
    cat = ie.select(F.col("id_key").cast("bigint").alias("item_id"), F.col("emb").alias("vec"))
    return VS.exact_topk(q, cat, k, n_queries=ctx["us"].count(), n_items=ctx["its"].count(), dim=DIM, seen=seen, **kw)


def score_all_topk(spark, sf):
    ctx, ue, ie = _towers(spark, sf)
    out = _unseen_topk(spark, sf, ctx, ue, ie, TOPK, scale=1.0 / TEMP)
    return out.select(F.col("qid").alias("user_id"), "rank", "item_id", R("score"))


def head_weights(n: int, seed: int = SEED) -> tuple[np.ndarray, np.ndarray]:
    """Linear ranking head from md5 (same rule as the SQL oracle): fixed values."""
    def u(*parts):
        h = hashlib.md5("|".join(str(p) for p in parts).encode()).hexdigest()[:15]
        return (int(h, 16) >> 8) / float(1 << 52)
    a = np.array([[u(seed, "head", j) - 0.5 for j in range(n)]])
    b = np.array([u(seed, "head", "bias") - 0.5])
    return a, b


def _rec_inputs(spark, sf):
    ctx, upool = _pooled(spark, sf, "user")
    _, ipool = _pooled(spark, sf, "item", ctx)
    uvec = upool.select(F.col("id_key").cast("bigint").alias("user_id"), "vec")
    ivec = ipool.select(F.col("id_key").cast("bigint").alias("item_id"), "vec")
    c = TB.users(spark, sf)
    req = (c.select(F.col("c_custkey").alias("user_id"), F.col("c_nationkey").cast("bigint").alias("k"))
           .unionByName(c.select((-F.col("c_custkey") - 1).alias("user_id"), F.lit(None).cast("bigint").alias("k"))))
    train_users = ctx["train"].select(F.col("o_custkey").alias("user_id"))
    return req, train_users, uvec, ivec


def two_stage_recommend(spark, sf):
    req, train_users, uvec, ivec = _rec_inputs(spark, sf)
    scorer = TW.PairScorer([head_weights(4 * DIM)])
    ranked, _ = RC.recommend(req, train_users, uvec, ivec, scorer, k_default=REC_K_DEFAULT)
    return ranked.select("user_id", "rank", "item_id", R("score"), R("retrieval_distance"))


def recommend_answers(spark, sf):
    """One answer per requested user: resolved k, latest train interaction, ranked items, or why there are none."""
    req, train_users, uvec, ivec = _rec_inputs(spark, sf)
    train, _ = split_parts(spark, sf)
    latest = LT.latest_per_key(train.withColumn("user_id", F.col("o_custkey")), "user_id", "o_orderdate",
                               ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"], ["l_partkey"])
    out = RC.answers(req, train_users, uvec, ivec, TW.PairScorer([head_weights(4 * DIM)]), latest, REC_K_DEFAULT)
    best = F.get("recommendations", F.lit(0))
    return out.select(
        "user_id", "top_k", "reason", F.col("latest_interaction.l_partkey").alias("latest_item"),
        F.col("latest_interaction.latest_date").alias("latest_date"),
        F.coalesce(F.array_size("recommendations"), F.lit(0)).cast("bigint").alias("n_items"),
        F.array_join(F.col("recommendations.item_id").cast("array<string>"), ",").alias("items"), R(best["score"], "best_score"))


def eligibility_reasons(spark, sf):
    req, train_users, uvec, _ = _rec_inputs(spark, sf)
    return RC.eligibility(req, train_users, uvec).filter(F.col("reason").isNotNull()).select("user_id", "reason")


QUERIES.update({
    "stacked_pooling": stacked_pooling,
    "tower_embed": tower_embed,
    "score_all_topk": score_all_topk,
    "two_stage_recommend": two_stage_recommend,
    "eligibility_reasons": eligibility_reasons,
    "recommend_answers": recommend_answers,
})


# ---- step 9: data preparation, affinity, weighted sampling ------------------------

import uuid  # noqa: E402

from pyspark.sql import types as T  # noqa: E402

from tidalrec.operators import affinity as AF  # noqa: E402
from tidalrec.operators import prep as PR  # noqa: E402
from tidalrec.session import checkpoint_dir, cut_lineage  # noqa: E402

USER_SEGS = ["c_mktsegment", "c_nationkey"]
ITEM_PROFILE = ["p_brand", "p_type", "p_size"]


def rare_category_fold(spark, sf):
    p = TB.items(spark, sf)
    return PR.fold_rare(p, "p_name", "name_grouped").select("p_partkey", "p_name", "name_grouped")


def numeric_bucket(spark, sf):
    c = TB.users(spark, sf).withColumn("age", F.col("c_nationkey") * 3 + 5)
    return c.select("c_custkey", F.col("age").cast("bigint").alias("age"), PR.range_bucket("age").alias("age_bucket"))


def prefix_bucket(spark, sf):
    c = TB.users(spark, sf)
    zipc = F.when(F.col("c_acctbal") >= 0, (F.col("c_custkey") * 7).cast("string"))
    return c.select("c_custkey", PR.prefixed(F.col("c_nationkey").cast("double"), "age_").alias("age_group"),
                    PR.prefixed("c_nationkey", "occ_").alias("occupation"),
                    PR.leading_bucket(zipc).alias("zip_prefix"))


def _titles(spark, sf):
    p = TB.items(spark, sf)
    return p.select("p_partkey", F.when(F.col("p_size") % 3 == 0, F.col("p_name")).otherwise(
        F.concat(F.col("p_name"), F.lit(" ("), (F.col("p_size") + 1940).cast("string"), F.lit(")"))).alias("title"))


def year_decade(spark, sf):
    t = _titles(spark, sf)
    y = PR.year_of_title("title")
    return t.select("p_partkey", "title", y.cast("string").alias("year"), PR.decade_bucket(y).alias("year_bucket"))


def title_clean(spark, sf):
    t = _titles(spark, sf)
    return t.select("p_partkey", PR.clean_title("title").alias("title_raw"))


def epoch_to_date(spark, sf):
    e = TB.load(spark, sf, "events")
    n = e.count()
    ep = F.unix_seconds(F.col("ts").cast("timestamp"))
    return e.select(F.col("event_id").cast("string").alias("id_text"), ep.alias("epoch"),
                    PR.epoch_to_date(ep).alias("event_date"),
                    PR.surrogate_id("e", F.col("event_id"), n).alias("surrogate_id"))


def prepare_ratings(spark, sf):
    """Write '::'-delimited latin-1 text derived from the tables, read it back
    as a header-less text source, prepare, split by time and write parquet."""
    base = f"{checkpoint_dir(spark).rstrip('/')}/prep-{uuid.uuid4().hex}"
    x = TB.interactions(spark, sf)
    text = x.select(F.concat_ws("::", "o_custkey", "l_partkey", F.col("l_quantity").cast("bigint"),
                                F.unix_seconds(F.col("o_orderdate").cast("timestamp"))).alias("value"))
    text.write.mode("overwrite").option("encoding", "ISO-8859-1").text(f"{base}/ratings.dat")
    raw = TB.read_delimited(spark, f"{base}/ratings.dat", ["user_id", "item_id", "rating", "timestamp"])
    ratings = PR.prepare_ratings(raw)
    thr = S.split_threshold(ratings, "timestamp", VAL_T)
    tagged = S.tag_at(ratings, "timestamp", thr, "is_train")
    TB.write_table(tagged, f"{base}/ratings_tagged", partition_by=["is_train"])
    back = TB.read_table(spark, f"{base}/ratings_tagged")
    return back.select("user_id", "item_id", F.col("rating").cast("bigint").alias("rating"), "timestamp", F.col("is_train").cast("boolean").alias("is_train"))


def _raw_texts(spark, sf):
    """Users, items and half-point ratings of the tables as '::' text, with lines that can't be prepared among them."""
    base = f"{checkpoint_dir(spark).rstrip('/')}/raw-{uuid.uuid4().hex}"
    c = TB.users(spark, sf)
    age = F.when(F.col("c_custkey") % 41 == 0, "old").when(F.col("c_custkey") % 37 == 0, "").otherwise(
        (F.col("c_nationkey") + 18).cast("string"))
    users = F.when(F.col("c_custkey") % 53 == 0, F.concat_ws("::", "c_custkey", F.lit("M"))).otherwise(
        F.concat_ws("::", F.col("c_custkey").cast("string"), F.lit("M"), age, F.lit("3"), F.lit("123")))
    p = _titles(spark, sf)
    items = F.concat_ws("::", F.when(F.col("p_partkey") % 31 == 0, "").otherwise(F.col("p_partkey").cast("string")), "title",
                        F.lit("Drama"))
    x = TB.interactions(spark, sf)
    key = F.col("l_orderkey") % 101
    ratings = F.when(key == 1, F.concat_ws("::", "o_custkey", "l_partkey")).otherwise(F.concat_ws(
        "::", "o_custkey", F.when(key == 2, " ").otherwise(F.col("l_partkey").cast("string")),
        F.when(key == 3, "x").when(key == 4, "NaN").otherwise((F.col("l_quantity") / 2).cast("double").cast("string")),
        F.when(key == 5, "bad").when(key == 6, "1.5").otherwise(F.unix_seconds(F.col("o_orderdate").cast("timestamp")).cast("string"))))
    for name, df, line in (("users", c, users), ("items", p, items), ("ratings", x, ratings)):
        df.select(line.alias("value")).write.option("encoding", "ISO-8859-1").text(f"{base}/{name}.dat")
    read = lambda name, columns: TB.read_lines(spark, f"{base}/{name}.dat", columns)
    return (read("users", ["user_id", "gender", "age", "occupation", "zip"]), read("items", ["item_id", "title", "genres"]),
            read("ratings", ["user_id", "item_id", "rating", "timestamp"]))


def _prepared(spark, sf):
    """The prepared tables, written as one version and read back."""
    out = PR.prepare_all(*_raw_texts(spark, sf), VAL_T)
    store = _version_store(spark, "prepared")
    names = ("users", "items", "train", "val", "rejected")
    version = store.version(store.publish({n: getattr(out, n) for n in names}, {}))
    return {n: store.table(version, n) for n in names}


def prepare_tables(spark, sf):
    """Train and val ratings of raw text with bad lines: half points kept, bad lines in neither."""
    t = _prepared(spark, sf)
    return t["train"].withColumn("is_train", F.lit(True)).unionByName(t["val"].withColumn("is_train", F.lit(False)))


def prepare_users_checked(spark, sf):
    """Prepared users of raw text with bad lines."""
    return _prepared(spark, sf)["users"].select("user_id", "age", "age_group")


def prepare_rejected(spark, sf):
    """Lines that no prepared table has, with the reason."""
    return _prepared(spark, sf)["rejected"]


def _affinity_inputs(spark, sf):
    train, _ = split_parts(spark, sf)
    c, p = TB.users(spark, sf), TB.items(spark, sf)
    inter = (train.select("o_custkey", "l_partkey")
             .join(c.select(F.col("c_custkey").alias("o_custkey"), *USER_SEGS), "o_custkey")
             .join(p.select(F.col("p_partkey").alias("l_partkey"), *ITEM_PROFILE), "l_partkey"))
    prefs = AF.preference_maps(inter, USER_SEGS, ITEM_PROFILE)
    keys = c.select(*USER_SEGS).distinct()
    profiles = p.groupBy(*ITEM_PROFILE).agg(F.count(F.lit(1)).alias("n_items"))
    return keys, profiles, prefs, p.count()


def _aff_out(df):
    return df.select(F.col("c_mktsegment"), F.col("c_nationkey").cast("bigint"),
                     *[F.col(c).cast("string").alias(c) for c in ITEM_PROFILE], *[c for c in df.columns
                                                                                 if c in ("score", "n_items", "prob")])


def affinity_scores(spark, sf):
    keys, profiles, prefs, _ = _affinity_inputs(spark, sf)
    s = AF.affinity_scores(keys, profiles, prefs, USER_SEGS, ITEM_PROFILE)
    return _aff_out(s.withColumn("score", F.col("score").cast("bigint")).withColumn("n_items", F.col("n_items").cast("bigint")))


def affinity_softmax(spark, sf):
    keys, profiles, prefs, n = _affinity_inputs(spark, sf)
    s = AF.affinity_scores(keys, profiles, prefs, USER_SEGS, ITEM_PROFILE)
    sm = AF.affinity_softmax(s, keys, n, USER_SEGS, ITEM_PROFILE)
    return _aff_out(sm.select(*USER_SEGS, *ITEM_PROFILE, "n_items", R("prob")))


def _weighted_draws(spark, sf):
    train, val = split_parts(spark, sf)
    c, p = TB.users(spark, sf), TB.items(spark, sf)
    seg = c.select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment")
    wts = (train.join(seg, "o_custkey").join(p.select(F.col("p_partkey").alias("l_partkey"), "p_type"), "l_partkey")
           .groupBy("c_mktsegment", "p_type").agg(F.count(F.lit(1)).alias("w")))
    cum = AF.cumulative_weights(wts, "c_mktsegment", "p_type", "w")
    draws = val.join(seg, "o_custkey").select("row_key", "o_custkey", "c_mktsegment")
    return AF.weighted_sample(draws, "row_key", "c_mktsegment", cum, "p_type", SEED)


def weighted_sample(spark, sf):
    return _weighted_draws(spark, sf).select("row_key", "c_mktsegment", "p_type")


def sample_counts_per_user(spark, sf):
    d = _weighted_draws(spark, sf)
    return d.groupBy(F.col("o_custkey").alias("user_id"), "p_type").agg(F.count(F.lit(1)).alias("n_draws"))


QUERIES.update({
    "rare_category_fold": rare_category_fold,
    "numeric_bucket": numeric_bucket,
    "prefix_bucket": prefix_bucket,
    "year_decade": year_decade,
    "title_clean": title_clean,
    "epoch_to_date": epoch_to_date,
    "prepare_ratings": prepare_ratings,
    "prepare_tables": prepare_tables,
    "prepare_users_checked": prepare_users_checked,
    "prepare_rejected": prepare_rejected,
    "affinity_scores": affinity_scores,
    "affinity_softmax": affinity_softmax,
    "weighted_sample": weighted_sample,
    "sample_counts_per_user": sample_counts_per_user,
})


# ---- step 10: streaming ------------------------------------------------------------

from tidalrec.streaming import incremental as INC  # noqa: E402
from tidalrec.streaming import keyed_state as KST  # noqa: E402


def _events_path(sf):
    return f"{sf.rstrip('/')}/events.parquet"


def stream_value_counts(spark, sf):
    s = INC.read_stream(spark, _events_path(sf))
    out = INC.scratch_path(spark, "counts")
    INC.run_available(INC.stream_value_counts(s, ["event_type", "user_id"]), out, "update")
    return INC.state_latest_per_key(spark, out, ["column", "value"]).select("column", "value", "cnt")


def stream_latest(spark, sf):
    s = INC.read_stream(spark, _events_path(sf))
    out = INC.scratch_path(spark, "latest")
    INC.run_available(INC.stream_latest(s, "user_id", "ts", ["event_id"], ["event_id", "event_type"]), out, "update")
    return INC.state_latest_per_key(spark, out, ["user_id"]).select("user_id", "event_id", "event_type", "latest_date")


def stream_counts_folded(spark, sf):
    """Running value counts without streaming state: deltas folded into a table of one row per value."""
    s = INC.read_stream(spark, _events_path(sf))
    return KST.count_stream(s, ["event_type", "user_id"], INC.scratch_path(spark, "folded-counts")).read()


def stream_latest_state_ttl(spark, sf):
    """Running latest event per user: RocksDB state that silent users lose, result table of one row per user."""
    s = INC.read_stream(spark, _events_path(sf))
    table = KST.latest_stream(s, "user_id", "ts", ["event_id"], ["event_type"], INC.scratch_path(spark, "latest-state"))
    return table.read().select("user_id", "event_id", "event_type", F.date_format("ts", "yyyy-MM-dd").alias("latest_date"))


def stream_encode(spark, sf):
    e = TB.load(spark, sf, "events")
    mins = {"event_type": 5, "user_id": 70}
    vocab = V.fit_vocabulary(V.value_counts([(e, {"event_type": "event_type", "user_id": "user_id"})]), mins).persist()
    s = INC.read_stream(spark, _events_path(sf))
    out = INC.scratch_path(spark, "encode")
    enc = INC.stream_encode(s, vocab, {"event_type": "event_type", "user_id": "user_id"})
    INC.run_available(enc.select("event_id", "event_type_token", "user_id_token"), out, "append")
    return spark.read.parquet(out).select("event_id", "event_type_token", "user_id_token")


QUERIES.update({
    "stream_value_counts": stream_value_counts,
    "stream_counts_folded": stream_counts_folded,
    "stream_latest_state_ttl": stream_latest_state_ttl,
    "stream_latest": stream_latest,
    "stream_encode": stream_encode,
})


# ---- artifacts: encoder round trip, warm start ---------------------------------------

from tidalrec.operators import warm_start as WS  # noqa: E402
from tidalrec.sources import artifacts as AR  # noqa: E402
from tidalrec.sources import model_store as MS  # noqa: E402
from tidalrec.sources import versions as VN  # noqa: E402


def encoder_round_trip(spark, sf):
    """Fit, save, reload (reuse check), then encode items with the reloaded
    dictionary."""
    train, _ = split_parts(spark, sf)
    sp = tpch_spec(min_counts={**ENC_MIN_USER, **ENC_MIN_ITEM})
    _, ienc = V.build_encoders(TB.users(spark, sf), TB.items(spark, sf), train, sp)
    path = f"{checkpoint_dir(spark).rstrip('/')}/encoders-{uuid.uuid4().hex}"
    fp = AR.fingerprint(train.select("o_custkey", "l_partkey", "o_orderdate"), "o_orderdate")
    AR.save_encoders(ienc, path, fp)
    loaded, meta = AR.load_encoders(spark, path)
    ok, why = AR.reusable(meta, ienc.cat_cols, ienc.dense_cols, ENC_MIN_ITEM, fp)
    if not ok:
        raise RuntimeError(f"saved encoders not reusable: {why}")
    out = V.encode_table(TB.items(spark, sf).withColumn("id", F.col("p_partkey")), loaded, keep=["id"])
    return out.select("id", *[F.col(c).alias(c + "_tok") for c in loaded.cat_cols],
                      R("p_retailprice"))


def _version_store(spark, name):
    return VN.VersionedStore(spark, f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}")


def encoders_load_or_build(spark, sf):
    """Encoders are built once, loaded when nothing changed, built anew when a minimum count or the train rows did."""
    train, _ = split_parts(spark, sf)
    users, items, store = TB.users(spark, sf), TB.items(spark, sf), _version_store(spark, "encoders")
    mins = {**ENC_MIN_USER, **ENC_MIN_ITEM}
    rows = []
    for step, rare, part in ((1, 80, train), (2, 80, train), (3, 1, train), (4, 1, train.where("l_partkey % 2 = 0"))):
        sp = tpch_spec(min_counts={**mins, "p_brand": rare})
        encoders, built, why = MS.load_or_build_encoders(store, users, items, part, sp)
        vocab = encoders[0].vocab.unionByName(encoders[1].vocab)
        rows.append(vocab.groupBy("column").agg(F.count(F.lit(1)).alias("n_values"), F.count_if("is_tail").alias("n_tail"),
                                                F.sum("cnt").alias("n_rows")).select(
            F.lit(step).alias("step"), F.lit(built).alias("built"), F.lit(why).alias("why"), "*"))
    out = rows[0]
    for r in rows[1:]:
        out = out.unionByName(r)
    return out


def model_reloaded_scores(spark, sf):
    """Item tower embeddings by a model that was published as one version and is read from there alone."""
    ctx = _model_ctx(spark, sf)
    sp = tpch_spec(min_counts=MODEL_MIN)
    towers = {"user": TW.init_params(U_FEATS, ["c_acctbal"], DIM, [16, DIM], SEED),
              "item": TW.init_params(I_FEATS, ["p_retailprice"], DIM, [16, DIM], SEED + 1)}
    encoders = [V.Encoders(ctx[k + "vocab"], ctx[k + "scal"], cats, dense) for k, cats, dense in (
        ("u", U_FEATS, ["c_acctbal"]), ("i", I_FEATS, ["p_retailprice"]))]
    store = _version_store(spark, "model")
    MS.save_model(store, MS.Model(sp, *encoders, ctx["utab"].unionByName(ctx["itab"]), towers, {"dim": DIM}))
    model = MS.load_model(VN.VersionedStore(spark, store.path))
    raw = TB.items(spark, sf)
    st = ST.build_store(raw, model.items, model.spec.item_id)
    cards = {f: model.items.cardinality(f) for f in model.items.cat_cols}
    return _tower_out(TW.tower_embed(st.table, "id_key", model.tables, model.towers["item"], cards, prefix="item."))


def _arch_shapes(spark, sf):
    train, _ = split_parts(spark, sf)
    sp = tpch_spec(min_counts=MODEL_MIN)
    uenc, ienc = V.build_encoders(TB.users(spark, sf), TB.items(spark, sf), train, sp)
    uc = {f: uenc.cardinality(f, MODEL_MIN[f]) for f in U_FEATS}
    ic = {f: ienc.cardinality(f, MODEL_MIN[f]) for f in I_FEATS}
    return uc, ic


def warm_start_mapping(spark, sf):
    uc, ic = _arch_shapes(spark, sf)
    src = TW.shapes_frame(spark, TW.model_param_shapes("retrieval", uc, ic, DIM, [16, DIM], 1, 1))
    outs = []
    for arch in ("two_tower", "dlrm"):
        tgt = TW.shapes_frame(spark, TW.model_param_shapes(arch, uc, ic, DIM, [16, DIM], 1, 1)).select("param", "shape")
        outs.append(WS.map_parameters(src, tgt).withColumn("target_arch", F.lit(arch)))
    return outs[0].unionByName(outs[1]).select("target_arch", "source_param", "target_param", "status")


def _param_rows(spark, shapes, seed):
    """(param, row_index, vec) with values from md5 for a list of (name, shape); a vector is one row."""
    named = spark.createDataFrame([(n, s[0] if len(s) == 2 else 1, s[-1] if s else 1) for n, s in shapes],
                                  "param string, n bigint, width bigint")
    rows = named.select("param", "width", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("n") - 1)).alias("row_index"))
    return rows.select("param", "row_index", F.transform(
        F.sequence(F.lit(0).cast("bigint"), F.col("width") - 1),
        lambda i: md5_unit(F.lit(seed), F.col("param"), F.col("row_index"), i) - 0.5).alias("vec"))


def warm_start_copy(spark, sf):
    """Ranking parameters of both architectures after the retrieval model's rows were copied by the mapping."""
    uc, ic = _arch_shapes(spark, sf)
    shapes = lambda arch: TW.model_param_shapes(arch, uc, ic, DIM, [16, DIM], 1, 1)
    src, source = TW.shapes_frame(spark, shapes("retrieval")), _param_rows(spark, shapes("retrieval"), 1)
    out = []
    for arch in ("two_tower", "dlrm"):
        mapping = WS.map_parameters(src, TW.shapes_frame(spark, shapes(arch)).select("param", "shape"))
        rows = WS.copy_parameters(source, _param_rows(spark, shapes(arch), 2), mapping)
        out.append(rows.select(F.lit(arch).alias("target_arch"), "param", "row_index", "copied",
                               R(F.aggregate("vec", F.lit(0.0), lambda a, x: a + x), "total")))
    return out[0].unionByName(out[1])


QUERIES.update({
    "warm_start_copy": warm_start_copy,
    "encoder_round_trip": encoder_round_trip,
    "warm_start_mapping": warm_start_mapping,
    "encoders_load_or_build": encoders_load_or_build,
    "model_reloaded_scores": model_reloaded_scores,
})


# ---- step 8: training, evaluation, early stopping, warm start, bundles ----------------

from tidalrec.operators import train as TRN  # noqa: E402

TRAIN_USER = TRN.Side("user", U_FEATS, ["c_acctbal"])
TRAIN_ITEM = TRN.Side("item", I_FEATS, ["p_retailprice"])
TRAIN_BATCH = 256


def _retrieval_eval(spark, sf, ctx, state, ks=KS):
    ue = TRN.embed_side(ctx["us"].table, state.tables, state.dense, TRAIN_USER, ctx["ucard"])
    ie = TRN.embed_side(ctx["its"].table, state.tables, state.dense, TRAIN_ITEM, ctx["icard"])
    sp = spec()
    users, items = TB.users(spark, sf), TB.items(spark, sf)
    rel = K.known_pairs(ctx["val"], users, items, sp.inter_user, sp.inter_item, sp.user_id, sp.item_id)
    n_items = ctx["its"].count()
    kk = M.valid_cutoffs(ks, n_items)
    top = _unseen_topk(spark, sf, ctx, ue, ie, max(kk)).select(F.col("qid").alias("user_id"), "rank", "item_id")
    m = M.macro_average(M.ranking_metrics_per_user(top, rel, kk)).first()
    return {k: float(v) for k, v in m.asDict().items() if k != "n_users"}


def _rows_for(spark, ctx, stage, sp):
    from tidalrec.operators import training_rows as TRr
    uenc_like = V.Encoders(ctx["uvocab"], ctx["uscal"], [], [], sizes=ctx["usizes"])
    ienc_like = V.Encoders(ctx["ivocab"], ctx["iscal"], [], [], sizes=ctx["isizes"])
    pos = TRr.positive_rows(ctx["train"], sp, ctx["us"], ctx["its"], uenc_like, ienc_like, with_label=True)
    if stage == "retrieval":
        rows = pos
    else:
        rows = TRr.labeled_rows(pos, ctx["its"], NEG, SEED, "l_partkey")
    rows = rows.withColumn("row_key", F.concat_ws("#", "row_key", "draw"))
    return TRr.assign_batches(rows, TRAIN_BATCH, SEED)


def _ranking_eval(spark, ctx, state, sp, loss, arch="two_tower"):
    from tidalrec.operators import training_rows as TRr
    uenc_like = V.Encoders(ctx["uvocab"], ctx["uscal"], [], [], sizes=ctx["usizes"])
    ienc_like = V.Encoders(ctx["ivocab"], ctx["iscal"], [], [], sizes=ctx["isizes"])
    pos = TRr.positive_rows(ctx["val"], sp, ctx["us"], ctx["its"], uenc_like, ienc_like, with_label=True)
    frame = TRN.training_frame(pos.withColumn("batch_id", F.lit(0)), state.tables, TRAIN_USER, TRAIN_ITEM, "label")
    dense = state.dense
    if arch == "dlrm":
        up = ip = scorer = None
    else:
        up, ip = TRN.tower_params(dense, TRAIN_USER), TRN.tower_params(dense, TRAIN_ITEM)
        scorer = TRN._layers(dense, "scorer")

    def run(batches):
        from tidalrec.functions import backprop as BP
        for pdf in batches:
            if len(pdf) == 0:
                continue
            def side(p, tp, s):
                emb = np.stack([np.stack([np.asarray(v) if v is not None else np.zeros(DIM)
                                          for v in pdf[f"{p}__{f}__vec"].values]) for f in s.features], axis=1)
                dn = pdf[[f"{p}__{c}" for c in sorted(s.dense)]].to_numpy(dtype=np.float64) if s.dense else None
                return BP.tower_fwd(emb, dn, tp.pool, tp.layers, tp.bottom)[0]
            if arch == "dlrm":
                rows_ = [np.stack([np.asarray(v) if v is not None else np.zeros(DIM) for v in pdf[f"{p}__{f}__vec"].values])
                         for s_, p in ((TRAIN_USER, "u"), (TRAIN_ITEM, "i")) for f in s_.features]
                feats, _, _ = TRN.dlrm_slots(pdf, rows_, dense, TRAIN_USER, TRAIN_ITEM)
                logits, _ = BP.dlrm_fwd(feats, TRN._layers(dense, "dlrm.mlp"))
            else:
                u, v = side("u", up, TRAIN_USER), side("i", ip, TRAIN_ITEM)
                _, logits, _, _, _ = BP.pair_head(u, v, scorer, pdf["label"].to_numpy(dtype=np.float64), loss)
            yield pd.DataFrame({"pred": logits, "label": pdf["label"].values})

    preds = frame.mapInPandas(run, "pred double, label double")
    m = M.pointwise_metrics(preds, "pred", "label", loss_func=loss).first()
    return {} if m is None else {k: (None if v is None else float(v)) for k, v in m.asDict().items() if k != "n"}


def run_training(spark, sf, cfg: TRN.TrainConfig, init: TRN.ModelState | None = None,
                 stopper: TRN.EarlyStopping | None = None, evaluate: bool = True):
    """Returns (best state, per-epoch report rows)."""
    ctx = _model_ctx(spark, sf)
    sp = tpch_spec(min_counts=MODEL_MIN, label_col=None)
    rows = cut_lineage_rows(_rows_for(spark, ctx, cfg.stage, sp))
    state = init or TRN.ModelState(
        ctx["utab"].unionByName(ctx["itab"]), TRN.init_dense(cfg, TRAIN_USER, TRAIN_ITEM))
    if init is not None and cfg.arch == "dlrm":
        # warm start: the retrieval embedding tables carry over (rewrite rule
        # *_tower.embeddings.* -> encoder.embeddings.*); dense layers are new
        state = TRN.ModelState(init.tables, TRN.init_dense(cfg, TRAIN_USER, TRAIN_ITEM))
    elif init is not None and cfg.stage == "ranking" and not any(k.startswith("scorer.") for k in init.dense):
        state = TRN.ModelState(init.tables, {**TRN.init_dense(cfg, TRAIN_USER, TRAIN_ITEM), **init.dense})
        state.dense.pop("temperature", None)
    report, best = [], (state, None)
    for epoch in range(cfg.epochs):
        state, loss = TRN.train_epoch(rows, state, cfg, TRAIN_USER, TRAIN_ITEM, "label", epoch)
        if not evaluate:
            report.append({"epoch": epoch + 1, "mean_loss": loss})
            best = (state, epoch + 1)
            continue
        if cfg.stage == "retrieval":
            metrics = _retrieval_eval(spark, sf, ctx, state)
        else:
            metrics = _ranking_eval(spark, ctx, state, sp, cfg.loss, cfg.arch)
        report.append({"epoch": epoch + 1, "mean_loss": loss, **metrics})
        if stopper is not None:
            improved, stop = stopper.update(metrics, epoch + 1)
            if improved:
                best = (state, epoch + 1)
            if stop:
                break
        else:
            best = (state, epoch + 1)
    return best[0], report


def cut_lineage_rows(df):
    from tidalrec.session import cut_costly_lineage
    return cut_costly_lineage(df)


def _report_df(spark, report):
    keys = sorted({k for r in report for k in r})
    rows = [tuple(r.get(k) for k in keys) for r in report]
    schema = ", ".join(f"{k} {'int' if k == 'epoch' else 'double'}" for k in keys)
    return spark.createDataFrame([tuple(int(v) if k == "epoch" else (None if v is None else float(v))
                                        for k, v in zip(keys, row)) for row in rows], schema)


def train_retrieval(spark, sf):
    cfg = TRN.TrainConfig(stage="retrieval", epochs=2, lr=0.01, partitions=4)
    stopper = TRN.EarlyStopping(patience=2, mode="max", metric="ndcg_at_10")
    _, report = run_training(spark, sf, cfg, stopper=stopper)
    return _report_df(spark, report)


def train_ranking(spark, sf):
    """Train all: retrieval, save the bundle, warm start the ranking model
    from the retrieval towers (parameter mapping), train ranking with BCE."""
    rcfg = TRN.TrainConfig(stage="retrieval", epochs=1, lr=0.01, partitions=4)
    rstate, _ = run_training(spark, sf, rcfg)
    path = f"{checkpoint_dir(spark).rstrip('/')}/bundle-{uuid.uuid4().hex}"
    dense_df = AR.params_frame(spark, rstate.dense)
    AR.save_bundle(path, rstate.tables, dense_df, {"stage": "retrieval", "dim": DIM})
    tables, dense_back, _meta = AR.load_bundle(spark, path)
    shapes = {k: np.shape(v) for k, v in rstate.dense.items()}
    dense = AR.frame_params(dense_back, shapes)
    kcfg = TRN.TrainConfig(stage="ranking", loss="bce", epochs=2, lr=0.01, partitions=4)
    init = TRN.ModelState(tables, {k: v for k, v in dense.items() if k != "temperature"})
    _, report = run_training(spark, sf, kcfg, init=init)
    return _report_df(spark, report)


QUERIES.update({
    "train_retrieval": train_retrieval,
    "train_ranking": train_ranking,
})


# ---- more inference and preparation queries -------------------------------------------

def score_all_topk_ranking(spark, sf):
    """Exact top-k for all users with a pair-scoring ranking head over every
    (user, item) pair, seen items masked; pairs are scored in blocks of users
    and items, never materialised as rows."""
    ctx, ue, ie = _towers(spark, sf)
    scorer = TW.init_pair_scorer(DIM, [16], SEED)
    out = _unseen_topk(spark, sf, ctx, ue, ie, TOPK, score_fn=scorer.matrix)
    return out.select(F.col("qid").alias("user_id"), "rank", "item_id", R("score"))


def _text_base(spark):
    return f"{checkpoint_dir(spark).rstrip('/')}/prep-{uuid.uuid4().hex}"


def prepare_users(spark, sf):
    """'::' text (user_id::gender::age::occupation::zip) derived from customer,
    read back as a header-less latin-1 source and prepared."""
    base = _text_base(spark)
    c = TB.users(spark, sf)
    key = F.col("c_custkey").cast("string")
    zipc = F.when(F.col("c_acctbal") >= 0, F.lpad(key, F.greatest(F.lit(5), F.char_length(key)), "0")).otherwise(F.lit(""))
    text = c.select(F.concat_ws("::", "c_custkey", F.substring("c_mktsegment", 1, 1), (F.col("c_nationkey") + 18),
                                F.col("c_nationkey") % 21, zipc).alias("value"))
    text.write.mode("overwrite").text(f"{base}/users.dat")
    raw = TB.read_delimited(spark, f"{base}/users.dat", ["user_id", "gender", "age", "occupation", "zip"])
    return PR.prepare_users(raw)


def prepare_items(spark, sf):
    """'::' text (item_id::title::genres) derived from part; genres folded when
    their count is not above 10, year / decade / clean title parsed."""
    base = _text_base(spark)
    t = _titles(spark, sf).join(TB.items(spark, sf).select("p_partkey", "p_type", "p_brand"), "p_partkey")
    text = t.select(F.concat_ws("::", "p_partkey", "title", F.concat_ws("|", "p_type", "p_brand")).alias("value"))
    text.write.mode("overwrite").text(f"{base}/movies.dat")
    raw = TB.read_delimited(spark, f"{base}/movies.dat", ["item_id", "title", "genres"])
    return PR.prepare_items(raw)


QUERIES.update({
    "score_all_topk_ranking": score_all_topk_ranking,
    "prepare_users": prepare_users,
    "prepare_items": prepare_items,
})


def dlrm_scores(spark, sf):
    """DLRM ranking scores for every validation interaction: user and item
    feature embeddings + dense bottom slot, all pairwise dots, MLP."""
    ctx = _model_ctx(spark, sf)
    sp = tpch_spec(min_counts=MODEL_MIN, label_col=None)
    from tidalrec.operators import training_rows as TRr
    uenc_like = V.Encoders(ctx["uvocab"], ctx["uscal"], [], [], sizes=ctx["usizes"])
    ienc_like = V.Encoders(ctx["ivocab"], ctx["iscal"], [], [], sizes=ctx["isizes"])
    rows = TRr.positive_rows(ctx["val"], sp, ctx["us"], ctx["its"], uenc_like, ienc_like)
    tables = ctx["utab"].unionByName(ctx["itab"])
    cards = {**{"user." + k: v for k, v in ctx["ucard"].items()}, **{"item." + k: v for k, v in ctx["icard"].items()}}
    n_slots = len(U_FEATS) + len(I_FEATS) + 1
    scorer = TW.init_dlrm_scorer(n_slots, DIM, [16], SEED)
    bottom = TW.init_params(U_FEATS, ["user_c_acctbal", "item_p_retailprice"], DIM, [DIM], SEED).bottom
    out = TW.dlrm_score(rows, tables, U_FEATS, I_FEATS, ["user_c_acctbal", "item_p_retailprice"], cards, DIM,
                        scorer, bottom)
    return out.select("row_key", R("score"))


def tower_embed_concat(spark, sf):
    """Item tower with concatenation pooling (feature embeddings side by side
    + dense bottom, then MLP and L2 norm)."""
    ctx = _model_ctx(spark, sf)
    ip = TW.init_params(I_FEATS, ["p_retailprice"], DIM, [16, DIM], SEED + 1, pooling="concat")
    return _tower_out(TW.tower_embed(ctx["its"].table, "id_key", ctx["itab"], ip, ctx["icard"], prefix="item."))


QUERIES.update({
    "dlrm_scores": dlrm_scores,
    "tower_embed_concat": tower_embed_concat,
})


def train_ranking_dlrm(spark, sf):
    """DLRM ranking (MSE on the quantity label is not used: BCE with implicit
    labels and 2 negatives per positive), warm-started embedding tables."""
    rcfg = TRN.TrainConfig(stage="retrieval", epochs=1, lr=0.01, partitions=4)
    rstate, _ = run_training(spark, sf, rcfg)
    kcfg = TRN.TrainConfig(stage="ranking", arch="dlrm", loss="bce", epochs=2, lr=0.01, partitions=4)
    _, report = run_training(spark, sf, kcfg, init=rstate)
    return _report_df(spark, report)


QUERIES.update({"train_ranking_dlrm": train_ranking_dlrm})


def two_stage_recommend_ann(spark, sf):
    """Two-stage recommend whose retrieval probes a KMeans-cell index of the
    item vectors (the serving path for catalogs too large to scan per user)."""
    req, train_users, uvec, ivec = _rec_inputs(spark, sf)
    ivec = cut_lineage(ivec)
    n_items = ivec.count()
    n_cells = VS.cells_for(n_items)
    index, cents = VS.build_cell_index(ivec.withColumnRenamed("item_id", "iid"), "iid", "vec", n_cells,
                                       normalize=False)
    scorer = TW.PairScorer([head_weights(4 * DIM)])
    ranked, _ = RC.recommend(req, train_users, uvec, ivec, scorer, k_default=REC_K_DEFAULT, n_items=n_items,
                             retriever=lambda q, k: VS.probe_topk(q, index, cents, k, VS.probes_for(n_cells), with_vec=True))
    return ranked.select("user_id", "rank", "item_id", R("score"), R("retrieval_distance"))


QUERIES.update({"two_stage_recommend_ann": two_stage_recommend_ann})


def end_to_end_train_pass(spark, sf):
    """split -> fit -> encode -> training rows -> one retrieval training pass
    (the end-to-end workflow measured by bench.py; not a registered query)."""
    cfg = TRN.TrainConfig(stage="retrieval", epochs=1, lr=0.01, partitions=8)
    state, report = run_training(spark, sf, cfg, evaluate=False)
    return _report_df(spark, report)
