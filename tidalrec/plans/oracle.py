"""Independent DuckDB SQL for each registered query (brute force where the
Spark plan is clever)."""

# interactions, the split threshold and the train / val tags
X = """
x AS (
  SELECT o.o_custkey, l.l_partkey, o.o_orderdate, l.l_quantity, l.l_orderkey, l.l_linenumber,
         l.l_suppkey, concat_ws('|', l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey) AS row_key,
         epoch_us(o.o_orderdate) AS ts_us
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey),
b AS (SELECT min(ts_us) AS lo, max(ts_us) AS hi FROM x),
t AS (SELECT x.*, (x.ts_us::DOUBLE <= b.lo::DOUBLE + (b.hi - b.lo)::DOUBLE * 0.8::DOUBLE) AS is_train
      FROM x CROSS JOIN b),
train AS (SELECT * FROM t WHERE is_train),
val AS (SELECT * FROM t WHERE NOT is_train),
seen AS (SELECT DISTINCT o_custkey AS user_id, l_partkey AS item_id FROM train
         WHERE o_custkey IN (SELECT c_custkey FROM customer) AND l_partkey IN (SELECT p_partkey FROM part)),
rel AS (SELECT DISTINCT o_custkey AS user_id, l_partkey AS item_id FROM val
        WHERE o_custkey IN (SELECT c_custkey FROM customer) AND l_partkey IN (SELECT p_partkey FROM part))
"""


def W(*ctes: str) -> str:
    return "WITH " + ",\n".join(c.strip() for c in (X,) + ctes) + "\n"


POP = """
pop AS (SELECT p.p_partkey AS item_id, COALESCE(c.cnt, 0)::BIGINT AS score
        FROM part p LEFT JOIN (SELECT l_partkey, count(*) AS cnt FROM train GROUP BY 1) c
        ON c.l_partkey = p.p_partkey)
"""


def pop_topk(k: int) -> str:
    return f"""
cand AS (SELECT u.c_custkey AS user_id, pop.item_id, pop.score FROM customer u CROSS JOIN pop
         WHERE NOT EXISTS (SELECT 1 FROM seen s WHERE s.user_id = u.c_custkey AND s.item_id = pop.item_id)),
topk AS (SELECT * FROM (SELECT user_id, item_id, score,
           row_number() OVER (PARTITION BY user_id ORDER BY score DESC, item_id ASC) AS rank FROM cand)
         WHERE rank <= {k})
"""


def per_user_sql(ks=(5, 10, 20)) -> str:
    cols = []
    for k in ks:
        h = f"count(*) FILTER (WHERE tk.rank <= {k} AND r.item_id IS NOT NULL)::DOUBLE"
        d = f"COALESCE(sum(CASE WHEN tk.rank <= {k} AND r.item_id IS NOT NULL THEN 1.0 / log2(tk.rank + 1.0) ELSE 0.0 END), 0.0)"
        idcg = f"list_sum(list_transform(range(1, least(n.n_rel, {k}) + 1), lambda i: 1.0 / log2(i + 1.0)))"
        cols += [
            f"round({h} / n.n_rel, 6) AS recall_at_{k}",
            f"round({h} / {k}.0, 6) AS precision_at_{k}",
            f"round(CASE WHEN {h} > 0 THEN 1.0 ELSE 0.0 END, 6) AS hit_at_{k}",
            f"round({d}, 6) AS dcg_at_{k}",
            f"round({d} / {idcg}, 6) AS ndcg_at_{k}",
        ]
    cols.append("round(COALESCE(1.0 / min(CASE WHEN r.item_id IS NOT NULL THEN tk.rank END), 0.0), 6) AS mrr")
    return f"""
nrel AS (SELECT user_id, count(*) AS n_rel FROM rel GROUP BY 1),
per_user AS (
  SELECT n.user_id, n.n_rel, {", ".join(cols)}
  FROM nrel n LEFT JOIN topk tk ON tk.user_id = n.user_id
  LEFT JOIN rel r ON r.user_id = tk.user_id AND r.item_id = tk.item_id
  GROUP BY n.user_id, n.n_rel)
"""


def _metric_names(ks=(5, 10, 20)):
    out = []
    for k in ks:
        out += [f"recall_at_{k}", f"precision_at_{k}", f"hit_at_{k}", f"dcg_at_{k}", f"ndcg_at_{k}"]
    return out + ["mrr"]


SQL = {
    "time_split_rows": W() + "SELECT row_key, o_custkey AS user_id, l_partkey AS item_id, is_train FROM t",
    "known_pairs": W() + "SELECT user_id, item_id FROM rel",
    "user_item_sets": W() + """SELECT user_id, count(*)::BIGINT AS n_items,
        string_agg(item_id::VARCHAR, ',' ORDER BY item_id) AS items FROM seen GROUP BY user_id""",
    "popularity_topk_unseen": W(POP, pop_topk(10)) +
        "SELECT user_id, rank::INTEGER AS rank, item_id, score FROM topk",
    "ranking_metrics_per_user": W(POP, pop_topk(20), per_user_sql()) + "SELECT * FROM per_user",
    "ranking_metrics_macro": W(POP, pop_topk(20), per_user_sql()) +
        "SELECT count(*) AS n_users, " +
        ", ".join(f"round(avg({m}), 6) AS {m}" for m in _metric_names()) + " FROM per_user",
}


# ---- step 2: vocabularies, scalers, store ------------------------------------------

def counts_sql(name: str, sources: list[tuple[str, dict[str, str]]]) -> str:
    parts = []
    for table, m in sources:
        for src, col in m.items():
            parts.append(f"SELECT '{col}' AS \"column\", COALESCE(CAST({src} AS VARCHAR), 'None') AS value FROM {table}")
    return f"""{name} AS (SELECT "column", value, count(*)::BIGINT AS cnt FROM ({' UNION ALL '.join(parts)}) GROUP BY 1, 2)"""


def vocab_sql(name: str, counts: str, mins: dict[str, int]) -> str:
    vals = ", ".join(f"('{c}', {m})" for c, m in mins.items())
    return f"""
{name}_thr AS (SELECT * FROM (VALUES {vals}) AS v("column", min_count)),
{name}_j AS (SELECT c.*, t.min_count, c.cnt < greatest(t.min_count, 1) AS is_tail
             FROM {counts} c JOIN {name}_thr t ON c."column" = t."column"),
{name}_head AS (SELECT "column", value, cnt,
                row_number() OVER (PARTITION BY "column" ORDER BY value) AS token_index, is_tail, min_count
                FROM {name}_j WHERE NOT is_tail),
{name}_nh AS (SELECT "column", max(token_index) AS n_head FROM {name}_head GROUP BY 1),
{name} AS (SELECT "column", value, cnt, token_index::BIGINT AS token_index, is_tail, min_count FROM {name}_head
           UNION ALL
           SELECT j."column", j.value, j.cnt, (COALESCE(nh.n_head, 0) + 1)::BIGINT, j.is_tail, j.min_count
           FROM {name}_j j LEFT JOIN {name}_nh nh ON j."column" = nh."column" WHERE j.is_tail)
"""


def card_sql(name: str, vocab: str, mins: dict[str, int]) -> str:
    return f"""
{name} AS (SELECT t."column", (COALESCE(n.n_head, 0) + 1 + CASE WHEN t.min_count > 1 THEN 1 ELSE 0 END)::BIGINT AS cardinality
           FROM {vocab}_thr t LEFT JOIN (SELECT "column", count(*) FILTER (WHERE NOT is_tail) AS n_head
                                        FROM {vocab} GROUP BY 1) n ON t."column" = n."column")
"""


ITEM_CAT = ["p_brand", "p_type", "p_size"]
TAIL_MIN = {"p_partkey": 5, "p_brand": 80, "p_type": 5, "p_size": 30}
ENC_MIN_USER = {"c_custkey": 40, "c_mktsegment": 5, "c_nationkey": 5}
ENC_MIN_ITEM = {"p_partkey": 30, "p_brand": 80, "p_type": 5, "p_size": 30}

ITEM_SRC = [("part", {c: c for c in ["p_partkey", *ITEM_CAT]}), ("train", {"l_partkey": "p_partkey"})]
USER_SRC = [("customer", {c: c for c in ["c_custkey", "c_mktsegment", "c_nationkey"]}),
            ("train", {"o_custkey": "c_custkey"})]

VC = 'SELECT "column", value, cnt, token_index, is_tail'


def tok(vocab: str, column: str, expr: str, alias: str) -> str:
    return (f"COALESCE((SELECT v.token_index FROM {vocab} v WHERE v.\"column\" = '{column}' "
            f"AND v.value = COALESCE(CAST({expr} AS VARCHAR), 'None')), 0)::BIGINT AS {alias}")


SCALE = """
sc AS (SELECT avg(x) AS m, CASE WHEN stddev_pop(x) IS NULL OR stddev_pop(x) = 0 THEN 1.0 ELSE stddev_pop(x) END AS s
       FROM (SELECT CASE WHEN isnan({col}) THEN NULL ELSE {col}::DOUBLE END AS x FROM {table}))
"""


def store_sql(table: str, id_col: str, cats: list[str], dense: str, vocab: str) -> str:
    toks = ", ".join(tok(vocab, c, f"e.{c}", c) for c in [id_col, *cats])
    return (f"SELECT CAST(e.{id_col} AS VARCHAR) AS id_key, "
            f"row_number() OVER (ORDER BY e.{id_col})::BIGINT AS position, {toks}, "
            f"round((COALESCE(e.{dense}, sc.m) - sc.m) / sc.s, 6) AS {dense} FROM {table} e CROSS JOIN sc")


SQL.update({
    "value_counts": W(counts_sql("cnts", [("part", {c: c for c in ITEM_CAT})])) +
        'SELECT "column", value, cnt FROM cnts',
    "id_counts_multi_source": W(counts_sql("cnts", [("customer", {"c_custkey": "c_custkey"}),
                                                   ("train", {"o_custkey": "c_custkey"})])) +
        'SELECT "column", value, cnt FROM cnts',
    "vocab_fit": W(counts_sql("cnts", [("part", {c: c for c in ITEM_CAT})]),
                   vocab_sql("voc", "cnts", {c: 1 for c in ITEM_CAT})) + VC + " FROM voc",
    "vocab_fit_tail": W(counts_sql("cnts", ITEM_SRC), vocab_sql("voc", "cnts", TAIL_MIN)) + VC + " FROM voc",
    "vocab_cardinality": W(counts_sql("ic", ITEM_SRC), vocab_sql("iv", "ic", TAIL_MIN), card_sql("icard", "iv", TAIL_MIN),
                           counts_sql("uc", USER_SRC), vocab_sql("uv", "uc", ENC_MIN_USER),
                           card_sql("ucard", "uv", ENC_MIN_USER)) +
        'SELECT * FROM icard UNION ALL SELECT * FROM ucard',
    "vocab_encode": W(counts_sql("uc", USER_SRC), vocab_sql("uv", "uc", ENC_MIN_USER),
                      counts_sql("ic", ITEM_SRC), vocab_sql("iv", "ic", ENC_MIN_ITEM)) +
        f"SELECT row_key, {tok('uv', 'c_custkey', 'o_custkey', 'user_token')}, "
        f"{tok('iv', 'p_partkey', 'l_partkey', 'item_token')} FROM val",
    "vocab_mismatch": W(counts_sql("lc", [("part", {c: c for c in ["p_partkey", *ITEM_CAT]})]),
                        vocab_sql("lv", "lc", {c: 5 for c in ["p_partkey", *ITEM_CAT]}),
                        counts_sql("rc", ITEM_SRC), vocab_sql("rv", "rc", {c: 5 for c in ["p_partkey", *ITEM_CAT]})) +
        """SELECT COALESCE(l."column", r."column") AS "column", COALESCE(l.value, r.value) AS value,
                  l.token_index AS left_index, r.token_index AS right_index
           FROM lv l FULL OUTER JOIN rv r ON l."column" = r."column" AND l.value = r.value
           WHERE l.token_index IS DISTINCT FROM r.token_index""",
    "dense_fit": """
        WITH u AS (SELECT c_acctbal, 7.0::DOUBLE AS const_col, NULL::DOUBLE AS empty_col,
                          CASE WHEN c_acctbal > 0 THEN c_acctbal END AS text_col FROM customer),
        long AS (SELECT 'c_acctbal' AS "column", c_acctbal AS x FROM u UNION ALL
                 SELECT 'const_col', const_col FROM u UNION ALL SELECT 'empty_col', empty_col FROM u UNION ALL
                 SELECT 'text_col', text_col FROM u UNION ALL SELECT 'p_retailprice', p_retailprice FROM part)
        SELECT "column", round(COALESCE(avg(x), 0.0), 6) AS mean,
               round(CASE WHEN stddev_pop(x) IS NULL OR stddev_pop(x) = 0 THEN 1.0 ELSE stddev_pop(x) END, 6) AS std
        FROM long GROUP BY 1""",
    "dense_transform": "WITH " + SCALE.format(col="c_acctbal", table="customer").strip() +
        " SELECT c_custkey, round((COALESCE(c_acctbal, sc.m) - sc.m) / sc.s, 6) AS c_acctbal FROM customer CROSS JOIN sc",
    "encode_users": W(counts_sql("uc", USER_SRC), vocab_sql("uv", "uc", ENC_MIN_USER),
                      SCALE.format(col="c_acctbal", table="customer")) +
        store_sql("customer", "c_custkey", ["c_mktsegment", "c_nationkey"], "c_acctbal", "uv"),
    "encode_items": W(counts_sql("ic", ITEM_SRC), vocab_sql("iv", "ic", ENC_MIN_ITEM),
                      SCALE.format(col="p_retailprice", table="part")) +
        store_sql("part", "p_partkey", ITEM_CAT, "p_retailprice", "iv"),
    "entity_positions": """SELECT CAST(p_partkey AS VARCHAR) AS id_key, p_partkey,
        row_number() OVER (ORDER BY p_partkey)::BIGINT AS position,
        greatest(row_number() OVER (ORDER BY p_partkey) - 1, 0)::BIGINT AS row_index FROM part""",
    "feature_lookup_unknown": W(counts_sql("uc", USER_SRC), vocab_sql("uv", "uc", ENC_MIN_USER),
                                SCALE.format(col="c_acctbal", table="customer"),
                                "st AS (" + store_sql("customer", "c_custkey", ["c_mktsegment", "c_nationkey"],
                                                      "c_acctbal", "uv") + ")",
                                "ids AS (SELECT DISTINCT o_custkey AS lookup_id FROM orders UNION "
                                "SELECT DISTINCT -o_custkey - 1 FROM orders)") +
        """SELECT ids.lookup_id, COALESCE(st.position, 0)::BIGINT AS position,
                  COALESCE(st.c_custkey, 0)::BIGINT AS user_c_custkey,
                  COALESCE(st.c_mktsegment, 0)::BIGINT AS user_c_mktsegment,
                  COALESCE(st.c_nationkey, 0)::BIGINT AS user_c_nationkey,
                  COALESCE(st.c_acctbal, 0.0) AS user_c_acctbal
           FROM ids LEFT JOIN st ON st.id_key = CAST(ids.lookup_id AS VARCHAR)""",
})


# ---- step 3: training rows ------------------------------------------------------

STORES = [counts_sql("uc", USER_SRC), vocab_sql("uv", "uc", ENC_MIN_USER),
          SCALE.format(col="c_acctbal", table="customer").replace("sc AS", "usc AS"),
          counts_sql("ic", ITEM_SRC), vocab_sql("iv", "ic", ENC_MIN_ITEM),
          SCALE.format(col="p_retailprice", table="part").replace("sc AS", "isc AS")]
UST = "ust AS (" + store_sql("customer", "c_custkey", ["c_mktsegment", "c_nationkey"], "c_acctbal", "uv").replace(
    "CROSS JOIN sc", "CROSS JOIN usc AS sc") + ")"
IST = "ist AS (" + store_sql("part", "p_partkey", ITEM_CAT, "p_retailprice", "iv").replace(
    "CROSS JOIN sc", "CROSS JOIN isc AS sc") + ")"


def md5_int(*parts: str) -> str:
    return "('0x' || substr(md5(concat_ws('|', " + ", ".join(parts) + ")), 1, 15))::BIGINT"


NEGS = """
draws AS (SELECT t.row_key, t.o_custkey, d.draw,
            (""" + md5_int("'42'", "t.row_key", "d.draw") + """ % (SELECT count(*) FROM part) + 1)::BIGINT AS neg_position
          FROM train t CROSS JOIN (SELECT unnest(range(1, 3)) AS draw) d)
"""

SQL.update({
    "train_rows_positive": W(*STORES, UST, IST) + f"""
        SELECT t.row_key, {tok('uv', 'c_custkey', 't.o_custkey', 'user_id')}, {tok('iv', 'p_partkey', 't.l_partkey', 'item_id')},
          COALESCE(us.position, 0)::BIGINT AS user_position, COALESCE(us.c_custkey, 0)::BIGINT AS user_c_custkey,
          COALESCE(us.c_mktsegment, 0)::BIGINT AS user_c_mktsegment, COALESCE(us.c_nationkey, 0)::BIGINT AS user_c_nationkey,
          COALESCE(us.c_acctbal, 0.0) AS user_c_acctbal,
          COALESCE(it.position, 0)::BIGINT AS item_position, COALESCE(it.p_partkey, 0)::BIGINT AS item_p_partkey,
          COALESCE(it.p_brand, 0)::BIGINT AS item_p_brand, COALESCE(it.p_type, 0)::BIGINT AS item_p_type,
          COALESCE(it.p_size, 0)::BIGINT AS item_p_size, COALESCE(it.p_retailprice, 0.0) AS item_p_retailprice
        FROM train t LEFT JOIN ust us ON us.id_key = CAST(t.o_custkey AS VARCHAR)
        LEFT JOIN ist it ON it.id_key = CAST(t.l_partkey AS VARCHAR)""",
    "negatives_sampled": W(NEGS, "pos AS (SELECT row_number() OVER (ORDER BY p_partkey) AS position, "
                                 "CAST(p_partkey AS VARCHAR) AS neg_item FROM part)") +
        """SELECT d.row_key, d.draw::INTEGER AS draw, d.neg_position, p.neg_item
           FROM draws d LEFT JOIN pos p ON p.position = d.neg_position""",
    "train_rows_labeled": W(*STORES, UST, IST, NEGS) + f"""
        SELECT t.row_key, 0 AS draw, t.l_partkey, {tok('uv', 'c_custkey', 't.o_custkey', 'user_id')},
          {tok('iv', 'p_partkey', 't.l_partkey', 'item_id')},
          COALESCE(us.position, 0)::BIGINT AS user_position, COALESCE(it.position, 0)::BIGINT AS item_position,
          COALESCE(it.p_brand, 0)::BIGINT AS item_p_brand, COALESCE(it.p_retailprice, 0.0) AS item_p_retailprice,
          round(t.l_quantity::DOUBLE, 6) AS label
        FROM train t LEFT JOIN ust us ON us.id_key = CAST(t.o_custkey AS VARCHAR)
        LEFT JOIN ist it ON it.id_key = CAST(t.l_partkey AS VARCHAR)
        UNION ALL
        SELECT d.row_key, d.draw::INTEGER, CAST(it.id_key AS BIGINT), {tok('uv', 'c_custkey', 'd.o_custkey', 'user_id')},
          it.p_partkey, COALESCE(us.position, 0)::BIGINT, it.position, it.p_brand, it.p_retailprice, 0.0
        FROM draws d JOIN ist it ON it.position = d.neg_position
        LEFT JOIN ust us ON us.id_key = CAST(d.o_custkey AS VARCHAR)""",
    "batch_assignment": W() + f"""SELECT row_key, ((row_number() OVER (ORDER BY {md5_int("'42'", "row_key")}, row_key) - 1) // 512)::BIGINT AS batch_id
        FROM train""",
})


# ---- step 4 -------------------------------------------------------------------

PRED = """
g AS (SELECT avg(l_quantity) AS g FROM train),
pi AS (SELECT l_partkey, avg(l_quantity) AS item_mean FROM train GROUP BY 1),
pv AS (SELECT v.*, COALESCE(pi.item_mean, g.g) AS pred, v.l_quantity::DOUBLE AS label
       FROM val v LEFT JOIN pi ON pi.l_partkey = v.l_partkey CROSS JOIN g)
"""


def pointwise_sql(src: str, pred: str, label: str, bce: bool) -> str:
    acc = (f"round(CASE WHEN bool_and({label} IN (0.0, 1.0)) THEN avg(CASE WHEN "
           f"(CASE WHEN 1.0 / (1.0 + exp(-{pred})) >= 0.5 THEN 1.0 ELSE 0.0 END) = {label} THEN 1.0 ELSE 0.0 END) END, 6)"
           if bce else "NULL::DOUBLE")
    return f"""SELECT count(*) AS n, round(sqrt(avg(({pred} - {label}) * ({pred} - {label}))), 6) AS rmse,
        round(avg(abs({pred} - {label})), 6) AS mae,
        round(CASE WHEN sqrt(var_pop({pred}) * var_pop({label})) > 0
              THEN covar_pop({pred}, {label}) / sqrt(var_pop({pred}) * var_pop({label})) ELSE 0.0 END, 6) AS corr,
        {acc} AS accuracy
        FROM {src} HAVING count(*) > 0"""


EV = """WITH ev AS (SELECT event_id, event_type, user_id, (value - 100.0) / 25.0 AS logit,
        CASE WHEN event_type = 'purchase' THEN 1.0 ELSE 0.0 END AS label FROM events)
"""


def grouped_loss_sql(src: str, group: str, loss: str) -> str:
    return f""",
per AS (SELECT CAST({group} AS VARCHAR) AS {group}, count(*) AS n, avg({loss}) AS mean_loss FROM {src} GROUP BY 1)
SELECT {group}, n, round(mean_loss, 6) AS mean_loss FROM per
UNION ALL SELECT 'ALL', sum(n)::BIGINT, round(sum(mean_loss * n) / sum(n), 6) FROM per"""


SQL.update({
    "pointwise_metrics": W(PRED) + pointwise_sql("pv", "pred", "label", False),
    "binary_accuracy": EV + pointwise_sql("ev", "logit", "label", True),
    "bce_loss": EV + grouped_loss_sql("ev", "event_type",
                                      "greatest(logit, 0.0) - logit * label + ln(1 + exp(-abs(logit)))"),
    "mse_loss": W(PRED, "pvy AS (SELECT *, CAST(year(o_orderdate) AS VARCHAR) AS order_year FROM pv)")[:-1] +
        grouped_loss_sql("pvy", "order_year", "(pred - label) * (pred - label)"),
    "in_batch_softmax_loss": """
        WITH w AS (SELECT vec_id, (vec_id // 50)::BIGINT AS batch_id, embedding::DOUBLE[] AS u,
                          list_reverse(embedding)::DOUBLE[] AS v FROM embeddings),
        s AS (SELECT a.vec_id, a.batch_id, b.vec_id AS j, list_dot_product(a.u, b.v) / 0.05 AS s
              FROM w a JOIN w b ON a.batch_id = b.batch_id),
        m AS (SELECT vec_id, batch_id, max(s) AS m, max(CASE WHEN vec_id = j THEN s END) AS sii FROM s GROUP BY 1, 2)
        SELECT m.vec_id, m.batch_id, round(m.m + ln(sum(exp(s.s - m.m))) - m.sii, 6) AS loss
        FROM m JOIN s ON s.vec_id = m.vec_id GROUP BY m.vec_id, m.batch_id, m.m, m.sii""",
    "latest_interaction": """SELECT user_id, event_id, event_type, strftime(ts, '%Y-%m-%d') AS latest_date FROM (
        SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC NULLS LAST, event_id DESC) AS rn FROM events)
        WHERE rn = 1""",
    "latest_interaction_orders": W() + """SELECT o_custkey AS user_id, l_partkey AS item_id,
        strftime(o_orderdate, '%Y-%m-%d') AS latest_date FROM (
        SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC NULLS LAST, l_orderkey DESC,
               l_linenumber DESC, l_partkey DESC, l_suppkey DESC) AS rn FROM x) WHERE rn = 1""",
})


# ---- step 5: vectors -------------------------------------------------------------

CENT = """
WITH ex AS (SELECT label, d.i - 1 AS dim, d.x::DOUBLE AS x
            FROM embeddings, LATERAL (SELECT unnest(embedding) AS x, generate_subscripts(embedding, 1) AS i) d),
cent AS (SELECT label, list(m ORDER BY dim) AS c FROM (SELECT label, dim, avg(x) AS m FROM ex GROUP BY 1, 2) GROUP BY 1)
"""


def long_sql(key: str, src: str, arr: str) -> str:
    return f"""SELECT {key}, (g._i - 1)::INTEGER AS dim, round(g._x, 6) AS value FROM {src},
        LATERAL (SELECT unnest({arr}) AS _x, generate_subscripts({arr}, 1) AS _i) g"""


NORM = "list_transform(embedding::DOUBLE[], lambda x: x / greatest(sqrt(list_sum(list_transform(embedding::DOUBLE[], lambda y: y * y))), 1e-12))"
PAIRS = []
for _a in range(4):
    for _b in range(_a + 1, 4):
        PAIRS.append(f"SELECT vec_id, {_a} AS f1, {_b} AS f2, round(list_dot_product(embedding[{_a * 16 + 1}:{_a * 16 + 16}]::DOUBLE[], "
                     f"embedding[{_b * 16 + 1}:{_b * 16 + 16}]::DOUBLE[]), 6) AS dot FROM embeddings")

SQL.update({
    "vector_topk": CENT + """SELECT label, rank::INTEGER AS rank, vec_id, round(score, 6) AS score, round(1.0 - score, 6) AS distance
        FROM (SELECT c.label, e.vec_id, list_dot_product(c.c, e.embedding::DOUBLE[]) AS score,
                     row_number() OVER (PARTITION BY c.label ORDER BY list_dot_product(c.c, e.embedding::DOUBLE[]) DESC, e.vec_id) AS rank
              FROM cent c, embeddings e) WHERE rank <= 10""",
    "vector_l2_normalize": "WITH n AS (SELECT vec_id, " + NORM + " AS v FROM embeddings) " + long_sql("vec_id", "n", "v"),
    "pair_features": """WITH p AS (SELECT vec_id, list_concat(embedding::DOUBLE[], list_reverse(embedding)::DOUBLE[],
            list_transform(list_zip(embedding::DOUBLE[], list_reverse(embedding)::DOUBLE[]), lambda z: z[1] * z[2]),
            list_transform(list_zip(embedding::DOUBLE[], list_reverse(embedding)::DOUBLE[]), lambda z: abs(z[1] - z[2]))) AS v
            FROM embeddings) """ + long_sql("vec_id", "p", "v"),
    "pairwise_interactions": " UNION ALL ".join(PAIRS),
})


# ---- step 6/7: pooling and recommend --------------------------------------------

MODEL_MIN = {"c_custkey": 5, "c_mktsegment": 5, "c_nationkey": 5,
             "p_partkey": 1, "p_brand": 5, "p_type": 5, "p_size": 5}
U_FEATS = ["c_custkey", "c_mktsegment", "c_nationkey"]
I_FEATS = ["p_partkey", "p_brand", "p_type", "p_size"]


def md5u(*parts: str) -> str:
    return "((" + md5_int(*parts) + " >> 8)::DOUBLE / 4503599627370496.0)"


def pooled_sql(side: str, table: str, id_col: str, feats: list[str], src, mins) -> list[str]:
    s = side[0]
    vals = ", ".join(f"('{side}.{f}')" for f in feats)
    long = " UNION ALL ".join(f"SELECT id_key, '{side}.{f}' AS feature, {f} AS tok FROM {s}st" for f in feats)
    toks = ", ".join(tok(f"{s}v", f, f"e.{f}", f) for f in [id_col, *feats[1:]])
    return [
        counts_sql(f"{s}c", src), vocab_sql(f"{s}v", f"{s}c", {f: mins[f] for f in feats}),
        f"{s}st AS (SELECT CAST(e.{id_col} AS VARCHAR) AS id_key, {toks} FROM {table} e)",
        f"{s}long AS ({long})",
        f"{s}pw AS (SELECT f.feature, d.dim, {md5u(chr(39) + '42' + chr(39), chr(39) + 'pool' + chr(39), 'f.feature', 'd.dim')} - 0.5 AS w "
        f"FROM (VALUES {vals}) AS f(feature) CROSS JOIN (SELECT unnest(range(0, 8)) AS dim) d)",
        f"{s}pm AS (SELECT feature, dim, exp(w - max(w) OVER (PARTITION BY dim)) AS ex FROM {s}pw)",
        f"{s}sm AS (SELECT feature, dim, ex / sum(ex) OVER (PARTITION BY dim) AS sm FROM {s}pm)",
        f"{s}pool AS (SELECT l.id_key, d.dim, sum(sm.sm * (({md5u(chr(39) + '42' + chr(39), 'l.feature', 'l.tok', 'd.dim')} - 0.5) * 1.0)) AS value "
        f"FROM {s}long l CROSS JOIN (SELECT unnest(range(0, 8)) AS dim) d "
        f"JOIN {s}sm sm ON sm.feature = l.feature AND sm.dim = d.dim GROUP BY 1, 2)",
        f"{s}vec AS (SELECT CAST(id_key AS BIGINT) AS id, list(value ORDER BY dim) AS vec FROM {s}pool GROUP BY 1)",
    ]


U_POOL = pooled_sql("user", "customer", "c_custkey", U_FEATS, USER_SRC, MODEL_MIN)
I_POOL = pooled_sql("item", "part", "p_partkey", I_FEATS, ITEM_SRC, MODEL_MIN)

HEAD = ("list_transform(range(0, 32), lambda j: " + md5u("'42'", "'head'", "j") + " - 0.5)")
BIAS = "(" + md5u("'42'", "'head'", "'bias'") + " - 0.5)"
REC = """
req AS (SELECT c_custkey AS user_id, c_nationkey::BIGINT AS k FROM customer
        UNION ALL SELECT -c_custkey - 1, NULL::BIGINT FROM customer),
tu AS (SELECT DISTINCT o_custkey AS user_id FROM train),
el AS (SELECT r.user_id, least(greatest(COALESCE(r.k, 20), 1), (SELECT count(*) FROM part)) AS k,
         CASE WHEN r.user_id NOT IN (SELECT user_id FROM tu) THEN 'not found in interactions_train'
              WHEN r.user_id NOT IN (SELECT id FROM uvec) THEN 'not found in feature store' END AS reason FROM req r),
cand AS (SELECT * FROM (SELECT el.user_id, el.k, iv.id AS item_id, uv.vec AS u, iv.vec AS v,
            list_dot_product(uv.vec, iv.vec) AS dot,
            row_number() OVER (PARTITION BY el.user_id ORDER BY list_dot_product(uv.vec, iv.vec) DESC, iv.id) AS rr
         FROM el JOIN uvec uv ON uv.id = el.user_id CROSS JOIN ivec iv WHERE el.reason IS NULL) WHERE rr <= k),
scored AS (SELECT user_id, item_id, 1.0 - dot AS retrieval_distance,
            list_dot_product(""" + HEAD + """, list_concat(u, v, list_transform(list_zip(u, v), lambda z: z[1] * z[2]),
                             list_transform(list_zip(u, v), lambda z: abs(z[1] - z[2])))) + """ + BIAS + """ AS score
           FROM cand)
"""

SQL.update({
    "stacked_pooling": W(*I_POOL) + "SELECT CAST(id_key AS BIGINT) AS p_partkey, dim::INTEGER AS dim, round(value, 6) AS value FROM ipool",
    "two_stage_recommend": W(*U_POOL, *I_POOL, REC) + """SELECT user_id,
        row_number() OVER (PARTITION BY user_id ORDER BY score DESC, item_id)::INTEGER AS rank, item_id,
        round(score, 6) AS score, round(retrieval_distance, 6) AS retrieval_distance FROM scored""",
    "eligibility_reasons": W(*U_POOL, REC) + "SELECT user_id, reason FROM el WHERE reason IS NOT NULL",
})


# ---- networks: towers, heads and DLRM from md5 weights --------------------------

def weights(seed: int, name: str, n_out: int, n_in: int, half: float) -> str:
    cell = md5u(f"'{seed}'", f"'{name}'", "o", "i")
    return (f"list_transform(range(0, {n_out}), lambda o: list_transform(range(0, {n_in}), "
            f"lambda i: ({cell} - 0.5) * {2 * half!r}::DOUBLE))")


def layer_weights(seed: int, name: str, n: int, n_in: int, n_out: int, w: str, b: str) -> str:
    half = n_in ** -0.5
    return f"{weights(seed, f'{name}{n}', n_out, n_in, half)} AS {w}, {weights(seed, f'{name}{n}.bias', n_out, 1, half)} AS {b}"


def linear(w: str, b: str, x: str, n_out: int, relu: bool = True) -> str:
    z = f"list_dot_product({w}[o], {x}) + {b}[o][1]"
    return f"list_transform(range(1, {n_out + 1}), lambda o: {f'greatest({z}, 0.0)' if relu else z})"


def embedding(side: str, feature: str, token: str) -> str:
    return f"list_transform(range(0, 8), lambda d: {md5u(chr(39) + '42' + chr(39), f'{chr(39)}{side}.{feature}{chr(39)}', token, 'd')} - 0.5)"


def scaled(table: str, dense: str, s: str) -> str:
    return SCALE.format(col=dense, table=table).replace("sc AS", f"{s}sc AS")


def tower_sql(side: str, table: str, id_col: str, feats: list[str], dense: str, seed: int, concat: bool = False) -> list[str]:
    """CTEs up to ``<s>emb`` (id, emb): embeddings and dense bottom pooled, two ReLU layers, unit length."""
    s, n = side[0], len(feats) + 1
    width = 8 * n if concat else 8
    lim = (6.0 / (8 + n)) ** 0.5
    slots = ", ".join(embedding(side, f, f"t.{f}") for f in feats)
    x = f"((COALESCE(e.{dense}, sc.m) - sc.m) / sc.s)"
    pooled = ("flatten(slots)" if concat else
              f"list_transform(range(1, 9), lambda d: list_sum(list_transform(range(1, {n + 1}), lambda f: sm[d][f] * slots[f][d])))")
    return [
        scaled(table, dense, s),
        f"{s}w0 AS MATERIALIZED (SELECT {weights(seed, 'pool', 8, n, lim)} AS pool, {layer_weights(seed, 'bottom', 0, 1, 8, 'wb', 'bb')}, "
        f"{layer_weights(seed, 'layer', 0, width, 16, 'w1', 'b1')}, {layer_weights(seed, 'layer', 1, 16, 8, 'w2', 'b2')})",
        f"{s}w AS MATERIALIZED (SELECT *, list_transform(pool, lambda r: list_transform(r, "
        f"lambda v: exp(v) / list_sum(list_transform(r, lambda q: exp(q))))) AS sm FROM {s}w0)",
        f"{s}slot AS (SELECT e.{id_col} AS id, [{slots}, list_transform(range(1, 9), lambda d: greatest({x} * wb[d][1] + bb[d][1], 0.0))] AS slots "
        f"FROM {s}st t JOIN {table} e ON CAST(e.{id_col} AS VARCHAR) = t.id_key CROSS JOIN {s}sc sc CROSS JOIN {s}w)",
        f"{s}z AS (SELECT id, {pooled} AS z FROM {s}slot CROSS JOIN {s}w)",
        f"{s}h AS (SELECT id, {linear('w1', 'b1', 'z', 16)} AS h FROM {s}z CROSS JOIN {s}w)",
        f"{s}g AS (SELECT id, {linear('w2', 'b2', 'h', 8)} AS g FROM {s}h CROSS JOIN {s}w)",
        f"{s}emb AS MATERIALIZED (SELECT id, list_transform(g, lambda v: v / greatest(sqrt(list_dot_product(g, g)), 1e-12)) AS emb FROM {s}g)",
    ]


U_TOWER = [*U_POOL[:3], *tower_sql("user", "customer", "c_custkey", U_FEATS, "c_acctbal", 42)]
I_TOWER = [*I_POOL[:3], *tower_sql("item", "part", "p_partkey", I_FEATS, "p_retailprice", 43)]
I_CONCAT = [*I_POOL[:3], *tower_sql("item", "part", "p_partkey", I_FEATS, "p_retailprice", 43, concat=True)]
EMB_OUT = """SELECT id AS p_partkey, (g._i - 1)::INTEGER AS dim, round(g._x, 6) AS value FROM iemb,
    LATERAL (SELECT unnest(emb) AS _x, generate_subscripts(emb, 1) AS _i) g"""


def unseen_topk_sql(score: str, extra: str = "") -> str:
    return f"""SELECT user_id, rank::INTEGER AS rank, item_id, round(score, 6) AS score FROM (
        SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY score DESC, item_id) AS rank FROM (
          SELECT u.id AS user_id, i.id AS item_id, {score} AS score FROM uemb u CROSS JOIN iemb i {extra}
          WHERE NOT EXISTS (SELECT 1 FROM seen s WHERE s.user_id = u.id AND s.item_id = i.id))) WHERE rank <= 10"""


PAIR_X = ("list_concat(u.emb, i.emb, list_transform(list_zip(u.emb, i.emb), lambda z: z[1] * z[2]), "
          "list_transform(list_zip(u.emb, i.emb), lambda z: abs(z[1] - z[2])))")
PAIR_W = (f"pw AS MATERIALIZED (SELECT {layer_weights(42, 'pair', 0, 32, 16, 'pw1', 'pb1')}, "
          f"{layer_weights(42, 'pair', 1, 16, 1, 'pw2', 'pb2')})")
PAIR_H = f"list_transform(range(1, 17), lambda o: greatest(list_dot_product(pw1[o], {PAIR_X}) + pb1[o][1], 0.0))"

DLRM_DOTS = ", ".join(f"list_dot_product(slots[{a}], slots[{b}])" for a in range(1, 9) for b in range(a + 1, 9))
DLRM = [
    *U_POOL[:3], *I_POOL[:3], scaled("customer", "c_acctbal", "u"), scaled("part", "p_retailprice", "i"),
    f"dw AS MATERIALIZED (SELECT {layer_weights(42, 'bottom', 0, 2, 8, 'wb', 'bb')}, "
    f"{layer_weights(42, 'dlrm', 0, 92, 16, 'w1', 'b1')}, {layer_weights(42, 'dlrm', 1, 16, 1, 'w2', 'b2')})",
    "drow AS (SELECT v.row_key, [" + ", ".join([embedding("user", f, f"us.{f}") for f in U_FEATS] +
                                               [embedding("item", f, f"its.{f}") for f in I_FEATS]) +
    """, list_transform(range(1, 9), lambda d: greatest(
          list_dot_product(wb[d], [(COALESCE(c.c_acctbal, usc.m) - usc.m) / usc.s, (COALESCE(p.p_retailprice, isc.m) - isc.m) / isc.s])
          + bb[d][1], 0.0))] AS slots
       FROM val v JOIN customer c ON c.c_custkey = v.o_custkey JOIN part p ON p.p_partkey = v.l_partkey
       JOIN ust us ON us.id_key = CAST(v.o_custkey AS VARCHAR) JOIN ist its ON its.id_key = CAST(v.l_partkey AS VARCHAR)
       CROSS JOIN usc CROSS JOIN isc CROSS JOIN dw)""",
    f"dx AS (SELECT row_key, list_concat(flatten(slots), [{DLRM_DOTS}]) AS x FROM drow)",
    f"dh AS (SELECT row_key, {linear('w1', 'b1', 'x', 16)} AS h FROM dx CROSS JOIN dw)",
]

SQL.update({
    "tower_embed": W(*I_TOWER) + EMB_OUT,
    "tower_embed_concat": W(*I_CONCAT) + EMB_OUT,
    "score_all_topk": W(*U_TOWER, *I_TOWER) + unseen_topk_sql("list_dot_product(u.emb, i.emb) * 20.0::DOUBLE"),
    "score_all_topk_ranking": W(*U_TOWER, *I_TOWER, PAIR_W) + unseen_topk_sql(
        f"list_dot_product(pw2[1], {PAIR_H}) + pb2[1][1]", "CROSS JOIN pw"),
    "dlrm_scores": W(*DLRM) + "SELECT row_key, round(list_dot_product(w2[1], h) + b2[1][1], 6) AS score FROM dh CROSS JOIN dw",
})

# ---- cell index: every cell probed, and cells around the label means ---------------

UNIT_C = "list_transform(c, lambda x: x / greatest(sqrt(list_dot_product(c, c)), 1e-12))"
CELLS = CENT.strip() + f""",
q AS MATERIALIZED (SELECT label, {UNIT_C} AS v FROM cent),
e AS MATERIALIZED (SELECT vec_id, {NORM} AS v FROM embeddings),
"""
ANN_OUT = """SELECT label::BIGINT AS label, rank::INTEGER AS rank, vec_id, round(score, 6) AS score FROM (
    SELECT *, row_number() OVER (PARTITION BY label ORDER BY score DESC, vec_id) AS rank FROM cand) WHERE rank <= 10"""

SQL.update({
    "ann_topk_all_cells": CELLS + """cand AS (SELECT q.label, e.vec_id, list_dot_product(q.v, e.v) AS score FROM q, e)
        """ + ANN_OUT,
    "ann_topk_label_cells": CELLS + """
        home AS (SELECT vec_id, label AS cell FROM (SELECT e.vec_id, q.label,
                   row_number() OVER (PARTITION BY e.vec_id ORDER BY list_dot_product(q.v, e.v) DESC, q.label) AS n FROM q, e) WHERE n = 1),
        probe AS (SELECT label, cell FROM (SELECT a.label, b.label AS cell,
                   row_number() OVER (PARTITION BY a.label ORDER BY list_dot_product(a.v, b.v) DESC, b.label) AS n FROM q a, q b) WHERE n <= 2),
        cand AS (SELECT p.label, e.vec_id, list_dot_product(q.v, e.v) AS score FROM probe p JOIN home h ON h.cell = p.cell
                 JOIN e ON e.vec_id = h.vec_id JOIN q ON q.label = p.label)
        """ + ANN_OUT,
})


# ---- step 9: preparation, affinity, sampling ------------------------------------

TITLES = """WITH t AS (SELECT p_partkey, CASE WHEN p_size % 3 = 0 THEN p_name
                ELSE p_name || ' (' || CAST(p_size + 1940 AS VARCHAR) || ')' END AS title FROM part),
ty AS (SELECT p_partkey, title, TRY_CAST(NULLIF(regexp_extract(title, '\\((\\d{4})\\)', 1), '') AS INTEGER) AS year FROM t)
"""

AGE_CASE = ("CASE WHEN a >= 0 AND a < 18 THEN 'age_0_17' WHEN a >= 18 AND a < 25 THEN 'age_18_24' "
            "WHEN a >= 25 AND a < 35 THEN 'age_25_34' WHEN a >= 35 AND a < 45 THEN 'age_35_44' "
            "WHEN a >= 45 AND a < 55 THEN 'age_45_54' WHEN a >= 55 AND a < 65 THEN 'age_55_64' "
            "WHEN a >= 65 AND a < 200 THEN 'age_65_plus' END")

AFF = """
c AS (SELECT * FROM customer), p AS (SELECT * FROM part),
inter AS (SELECT c.c_mktsegment, CAST(c.c_nationkey AS VARCHAR) AS c_nationkey, p.p_brand, p.p_type,
                 CAST(p.p_size AS VARCHAR) AS p_size
          FROM train tr JOIN c ON c.c_custkey = tr.o_custkey JOIN p ON p.p_partkey = tr.l_partkey),
cnt AS (SELECT seg_col, seg_value, item_col, item_value, count(*) AS n FROM (
          SELECT s.seg_col, s.seg_value, i.item_col, i.item_value FROM inter,
            LATERAL (VALUES ('c_mktsegment', inter.c_mktsegment), ('c_nationkey', inter.c_nationkey)) s(seg_col, seg_value),
            LATERAL (VALUES ('p_brand', inter.p_brand), ('p_type', inter.p_type), ('p_size', inter.p_size)) i(item_col, item_value))
        GROUP BY 1, 2, 3, 4),
pref AS (SELECT seg_col, seg_value, item_col, item_value AS pref_value FROM (
          SELECT *, row_number() OVER (PARTITION BY seg_col, seg_value, item_col ORDER BY n DESC, item_value) AS r FROM cnt)
         WHERE r = 1),
keys AS (SELECT DISTINCT c_mktsegment, CAST(c_nationkey AS VARCHAR) AS c_nationkey FROM customer),
prof AS (SELECT p_brand, p_type, CAST(p_size AS VARCHAR) AS p_size, count(*) AS n_items FROM part GROUP BY 1, 2, 3),
sc AS (SELECT k.c_mktsegment, k.c_nationkey, pr.p_brand, pr.p_type, pr.p_size, pr.n_items,
          (CASE WHEN pr.p_brand = (SELECT pref_value FROM pref WHERE seg_col='c_mktsegment' AND seg_value=k.c_mktsegment AND item_col='p_brand') THEN 1 ELSE 0 END
         + CASE WHEN pr.p_type = (SELECT pref_value FROM pref WHERE seg_col='c_mktsegment' AND seg_value=k.c_mktsegment AND item_col='p_type') THEN 1 ELSE 0 END
         + CASE WHEN pr.p_size = (SELECT pref_value FROM pref WHERE seg_col='c_mktsegment' AND seg_value=k.c_mktsegment AND item_col='p_size') THEN 1 ELSE 0 END
         + CASE WHEN pr.p_brand = (SELECT pref_value FROM pref WHERE seg_col='c_nationkey' AND seg_value=k.c_nationkey AND item_col='p_brand') THEN 1 ELSE 0 END
         + CASE WHEN pr.p_type = (SELECT pref_value FROM pref WHERE seg_col='c_nationkey' AND seg_value=k.c_nationkey AND item_col='p_type') THEN 1 ELSE 0 END
         + CASE WHEN pr.p_size = (SELECT pref_value FROM pref WHERE seg_col='c_nationkey' AND seg_value=k.c_nationkey AND item_col='p_size') THEN 1 ELSE 0 END) AS score
       FROM keys k CROSS JOIN prof pr)
"""

SAMPLE = """
seg AS (SELECT c_custkey, c_mktsegment FROM customer),
wts AS (SELECT s.c_mktsegment, p.p_type, count(*) AS w FROM train tr JOIN seg s ON s.c_custkey = tr.o_custkey
        JOIN part p ON p.p_partkey = tr.l_partkey GROUP BY 1, 2),
cum AS (SELECT *, sum(w) OVER (PARTITION BY c_mktsegment ORDER BY p_type ROWS UNBOUNDED PRECEDING) AS hi,
               sum(w) OVER (PARTITION BY c_mktsegment) AS total FROM wts),
dr AS (SELECT v.row_key, v.o_custkey, s.c_mktsegment, """ + md5u("'42'", "v.row_key") + """ AS u
       FROM val v JOIN seg s ON s.c_custkey = v.o_custkey),
smp AS (SELECT dr.row_key, dr.o_custkey, dr.c_mktsegment, cum.p_type FROM dr JOIN cum ON cum.c_mktsegment = dr.c_mktsegment
        AND cum.hi - cum.w <= dr.u * cum.total AND dr.u * cum.total < cum.hi)
"""

SQL.update({
    "rare_category_fold": """SELECT p.p_partkey, p.p_name, CASE WHEN c.n > 10 THEN p.p_name ELSE 'other' END AS name_grouped
        FROM part p JOIN (SELECT p_name, count(*) AS n FROM part GROUP BY 1) c ON c.p_name = p.p_name""",
    "numeric_bucket": "SELECT c_custkey, a AS age, " + AGE_CASE + " AS age_bucket FROM (SELECT c_custkey, (c_nationkey * 3 + 5)::BIGINT AS a FROM customer)",
    "prefix_bucket": """SELECT c_custkey, 'age_' || CAST(c_nationkey::DOUBLE AS VARCHAR) AS age_group,
        'occ_' || CAST(c_nationkey AS VARCHAR) AS occupation,
        COALESCE(substring(CASE WHEN c_acctbal >= 0 THEN CAST(c_custkey * 7 AS VARCHAR) END, 1, 3), '000') AS zip_prefix
        FROM customer""",
    "year_decade": TITLES + """SELECT p_partkey, title, CAST(year AS VARCHAR) AS year, CASE WHEN year IS NULL THEN 'year_unknown'
        ELSE 'year_' || CAST((year // 10) * 10 AS VARCHAR) || 's' END AS year_bucket FROM ty""",
    "title_clean": TITLES + "SELECT p_partkey, regexp_replace(title, '\\s\\(\\d{4}\\)', '', 'g') AS title_raw FROM t",
    "epoch_to_date": """SELECT CAST(event_id AS VARCHAR) AS id_text, (epoch_us(ts) // 1000000)::BIGINT AS epoch,
        strftime(ts, '%Y-%m-%d') AS event_date,
        'e_' || lpad(CAST(event_id AS VARCHAR), greatest(6, length(CAST((SELECT count(*) FROM events) AS VARCHAR)))::INTEGER, '0') AS surrogate_id
        FROM events""",
    "prepare_ratings": """WITH r AS (SELECT CAST(o.o_custkey AS VARCHAR) AS user_id, CAST(l.l_partkey AS VARCHAR) AS item_id,
            CAST(l.l_quantity AS BIGINT) AS rating, strftime(o.o_orderdate, '%Y-%m-%d') AS timestamp,
            epoch_us(CAST(strftime(o.o_orderdate, '%Y-%m-%d') AS TIMESTAMP)) AS us
          FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey),
        b AS (SELECT min(us) AS lo, max(us) AS hi FROM r)
        SELECT user_id, item_id, rating, timestamp, us::DOUBLE <= b.lo::DOUBLE + (b.hi - b.lo)::DOUBLE * 0.8::DOUBLE AS is_train
        FROM r CROSS JOIN b""",
    "affinity_scores": W(AFF) + """SELECT c_mktsegment, CAST(c_nationkey AS BIGINT) AS c_nationkey, p_brand, p_type, p_size,
        score::BIGINT AS score, n_items::BIGINT AS n_items FROM sc WHERE score >= 1""",
    "affinity_softmax": W(AFF, """rows AS (SELECT c_mktsegment, c_nationkey, p_brand, p_type, p_size, score::DOUBLE AS score, n_items FROM sc WHERE score >= 1
          UNION ALL SELECT c_mktsegment, c_nationkey, NULL, NULL, NULL, 0.0, sum(n_items) FROM sc WHERE score = 0 GROUP BY 1, 2),
        mx AS (SELECT *, max(score) OVER (PARTITION BY c_mktsegment, c_nationkey) AS m FROM rows)""") +
        """SELECT c_mktsegment, CAST(c_nationkey AS BIGINT) AS c_nationkey, p_brand, p_type, p_size, n_items::BIGINT AS n_items,
           round(exp(score - m) / sum(n_items * exp(score - m)) OVER (PARTITION BY c_mktsegment, c_nationkey), 6) AS prob FROM mx""",
    "weighted_sample": W(SAMPLE) + "SELECT row_key, c_mktsegment, p_type FROM smp",
    "sample_counts_per_user": W(SAMPLE) + "SELECT o_custkey AS user_id, p_type, count(*) AS n_draws FROM smp GROUP BY 1, 2",
})


# ---- step 10: streaming (final state = batch result) ---------------------------------

SQL.update({
    "stream_value_counts": """SELECT "column", value, count(*)::BIGINT AS cnt FROM (
        SELECT 'event_type' AS "column", COALESCE(CAST(event_type AS VARCHAR), 'None') AS value FROM events
        UNION ALL SELECT 'user_id', COALESCE(CAST(user_id AS VARCHAR), 'None') FROM events) GROUP BY 1, 2""",
    "stream_latest": SQL["latest_interaction"],
    "stream_encode": "WITH " + counts_sql("ec", [("events", {"event_type": "event_type", "user_id": "user_id"})]) + "," +
        vocab_sql("ev", "ec", {"event_type": 5, "user_id": 70}) +
        f"SELECT event_id, {tok('ev', 'event_type', 'event_type', 'event_type_token')}, "
        f"{tok('ev', 'user_id', 'user_id', 'user_id_token')} FROM events",
})
SQL["stream_counts_folded"] = SQL["stream_value_counts"]
SQL["stream_latest_state_ttl"] = SQL["stream_latest"]


# ---- artifacts ------------------------------------------------------------------

def _shape_sql(shapes, sentinels: dict[int, str]) -> str:
    rows = []
    for i, (n, s) in enumerate(shapes):
        if not s:
            sh = "'scalar'"
        else:
            parts = [sentinels.get(x, f"'{x}'") for x in s]
            sh = " || 'x' || ".join(parts)
        rows.append(f"SELECT '{n}' AS param, {sh} AS shape, {i} AS ord")
    return " UNION ALL ".join(rows)


def _warm_sql() -> str:
    from tidalrec.operators.towers import model_param_shapes
    feats = U_FEATS + I_FEATS
    fake = {f: 10 ** 9 + i for i, f in enumerate(feats)}
    sent = {10 ** 9 + i: f"(SELECT cardinality::VARCHAR FROM {'ucard' if f in U_FEATS else 'icard'} WHERE \"column\" = '{f}')"
            for i, f in enumerate(feats)}
    uc = {f: fake[f] for f in U_FEATS}
    ic = {f: fake[f] for f in I_FEATS}
    src = _shape_sql(model_param_shapes("retrieval", uc, ic, 8, [16, 8], 1, 1), sent)
    out = []
    for arch in ("two_tower", "dlrm"):
        tgt = _shape_sql(model_param_shapes(arch, uc, ic, 8, [16, 8], 1, 1), sent)
        out.append(f"""SELECT '{arch}' AS target_arch, * FROM (
          WITH src AS ({src}), tgt AS ({tgt}),
          cand AS (SELECT param, shape, ord, 0 AS rule, param AS cand FROM src
                   UNION ALL SELECT param, shape, ord, 1, 'encoder.embeddings.' || substr(param, 23) FROM src
                     WHERE starts_with(param, 'user_tower.embeddings.')
                   UNION ALL SELECT param, shape, ord, 2, 'encoder.embeddings.' || substr(param, 23) FROM src
                     WHERE starts_with(param, 'item_tower.embeddings.')),
          j AS (SELECT c.*, t.shape AS tshape FROM cand c JOIN tgt t ON t.param = c.cand),
          direct AS (SELECT param, arg_min(cand, rule) AS direct FROM j WHERE shape = tshape GROUP BY 1),
          mm AS (SELECT DISTINCT param FROM j WHERE shape <> tshape),
          sfx AS (SELECT s.param, count(*) AS n_sfx, min(t.param) AS sfx_target FROM src s JOIN tgt t
                  ON substr(s.param, strpos(s.param, '.') + 1) = substr(t.param, strpos(t.param, '.') + 1)
                  AND s.shape = t.shape WHERE strpos(s.param, '.') > 0 AND strpos(t.param, '.') > 0 GROUP BY 1),
          r AS (SELECT s.param, s.ord, COALESCE(d.direct, CASE WHEN x.n_sfx = 1 THEN x.sfx_target END) AS target_param,
                       x.n_sfx, m.param IS NOT NULL AS mm
                FROM src s LEFT JOIN direct d ON d.param = s.param LEFT JOIN mm m ON m.param = s.param
                LEFT JOIN sfx x ON x.param = s.param),
          rn AS (SELECT *, CASE WHEN target_param IS NOT NULL THEN
                   row_number() OVER (PARTITION BY target_param ORDER BY ord) END AS n FROM r)
          SELECT param AS source_param, target_param,
            CASE WHEN target_param IS NOT NULL AND n = 1 THEN 'loaded'
                 WHEN target_param IS NOT NULL THEN 'duplicate_target'
                 WHEN n_sfx > 1 THEN 'ambiguous' WHEN mm THEN 'shape_mismatch' ELSE 'no_match' END AS status
          FROM rn)""")
    return W(counts_sql("uc", USER_SRC), vocab_sql("uv", "uc", {f: MODEL_MIN[f] for f in U_FEATS}),
             card_sql("ucard", "uv", {f: MODEL_MIN[f] for f in U_FEATS}),
             counts_sql("ic", ITEM_SRC), vocab_sql("iv", "ic", {f: MODEL_MIN[f] for f in I_FEATS}),
             card_sql("icard", "iv", {f: MODEL_MIN[f] for f in I_FEATS})) + " UNION ALL ".join(out)


SQL.update({
    "encoder_round_trip": W(counts_sql("ic", ITEM_SRC), vocab_sql("iv", "ic", ENC_MIN_ITEM),
                            SCALE.format(col="p_retailprice", table="part")) +
        "SELECT e.p_partkey AS id, " + ", ".join(tok("iv", c, f"e.{c}", c + "_tok") for c in ["p_partkey", *ITEM_CAT]) +
        ", round((COALESCE(e.p_retailprice, sc.m) - sc.m) / sc.s, 6) AS p_retailprice FROM part e CROSS JOIN sc",
    "warm_start_mapping": _warm_sql(),
})


SQL.update({
    "prepare_users": """SELECT CAST(c_custkey AS VARCHAR) AS user_id, (c_nationkey + 18)::DOUBLE AS age,
        substring(c_mktsegment, 1, 1) AS gender, 'age_' || CAST((c_nationkey + 18)::DOUBLE AS VARCHAR) AS age_group,
        'occ_' || CAST(c_nationkey % 21 AS VARCHAR) AS occupation,
        CASE WHEN c_acctbal >= 0 THEN lpad(CAST(c_custkey AS VARCHAR), greatest(5, length(CAST(c_custkey AS VARCHAR)))::INTEGER, '0') END AS zip,
        COALESCE(substring(CASE WHEN c_acctbal >= 0 THEN lpad(CAST(c_custkey AS VARCHAR), greatest(5, length(CAST(c_custkey AS VARCHAR)))::INTEGER, '0') END, 1, 3), '000') AS zip_prefix
        FROM customer""",
    "prepare_items": TITLES + """, g AS (SELECT p_partkey, p_type || '|' || p_brand AS genres FROM part),
        gc AS (SELECT genres, count(*) AS n FROM g GROUP BY 1)
        SELECT CAST(ty.p_partkey AS VARCHAR) AS item_id, g.genres,
          CASE WHEN gc.n > 10 THEN g.genres ELSE 'other' END AS genre_grouped, ty.title,
          regexp_replace(ty.title, '\\s\\(\\d{4}\\)', '', 'g') AS title_raw, CAST(ty.year AS VARCHAR) AS year,
          CASE WHEN ty.year IS NULL THEN 'year_unknown' ELSE 'year_' || CAST((ty.year // 10) * 10 AS VARCHAR) || 's' END AS year_bucket
        FROM ty JOIN g ON g.p_partkey = ty.p_partkey JOIN gc ON gc.genres = g.genres""",
})

SQL["ann_pq_all"] = SQL["ann_topk_all_cells"]
SQL["user_item_bitmaps"] = W() + """SELECT user_id, item_id // 32768 + 1 AS bucket, count(*)::BIGINT AS n_items,
    min(item_id) AS first_item, max(item_id) AS last_item FROM seen GROUP BY 1, 2"""
SQL["known_pairs_merged"] = W() + "SELECT user_id, item_id FROM rel UNION SELECT user_id, item_id FROM seen"


# ---- versions ---------------------------------------------------------------------------

def _versions_sql() -> str:
    """Value counts of the four steps; a tail is what is rarer than the minimum count."""
    mins = {"c_custkey": 40, "c_mktsegment": 5, "c_nationkey": 5, "p_partkey": 30, "p_brand": 80, "p_type": 5, "p_size": 30}
    whys = {1: (True, "nothing stored"), 2: (False, "ok"), 3: (True, "item: min count changed for p_brand"),
            4: (True, "input data changed")}
    sources = lambda train: [("customer", {c: c for c in ("c_custkey", "c_mktsegment", "c_nationkey")}),
                             ("part", {c: c for c in ("p_partkey", "p_brand", "p_type", "p_size")}),
                             (train, {"o_custkey": "c_custkey", "l_partkey": "p_partkey"})]
    parts = []
    for step, (built, why) in whys.items():
        cases = " ".join(f"WHEN '{c}' THEN {1 if c == 'p_brand' and step > 2 else m}" for c, m in mins.items())
        parts.append(f"""SELECT {step} AS step, {built} AS built, '{why}' AS why, "column", count(*)::BIGINT AS n_values,
            count(*) FILTER (WHERE cnt < CASE "column" {cases} END)::BIGINT AS n_tail, sum(cnt)::BIGINT AS n_rows
            FROM {"halfc" if step == 4 else "wholec"} GROUP BY "column" """)
    return W("halftrain AS (SELECT * FROM train WHERE l_partkey % 2 = 0)", counts_sql("wholec", sources("train")),
             counts_sql("halfc", sources("halftrain"))) + " UNION ALL ".join(parts)


SQL["encoders_load_or_build"] = _versions_sql()
SQL["model_reloaded_scores"] = SQL["tower_embed"]


# ---- preparation with bad lines, copied parameters, answers --------------------------------

_RATING = """o.o_custkey, l.l_partkey, l.l_orderkey % 101 AS key, CAST(l.l_quantity / 2.0 AS DOUBLE) AS rating,
    strftime(o.o_orderdate, '%Y-%m-%d') AS day, epoch_us(CAST(strftime(o.o_orderdate, '%Y-%m-%d') AS TIMESTAMP)) AS us
    FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey"""
SQL["prepare_tables"] = f"""WITH r AS (SELECT * FROM (SELECT {_RATING}) WHERE key NOT BETWEEN 1 AND 6),
    b AS (SELECT min(us) AS lo, max(us) AS hi FROM r)
    SELECT CAST(o_custkey AS VARCHAR) AS user_id, CAST(l_partkey AS VARCHAR) AS item_id, rating, day AS timestamp,
      us::DOUBLE <= b.lo::DOUBLE + (b.hi - b.lo)::DOUBLE * 0.8::DOUBLE AS is_train FROM r CROSS JOIN b"""
SQL["prepare_users_checked"] = """SELECT CAST(c_custkey AS VARCHAR) AS user_id,
    CASE WHEN c_custkey % 37 <> 0 THEN (c_nationkey + 18)::DOUBLE END AS age,
    'age_' || CAST(CASE WHEN c_custkey % 37 <> 0 THEN (c_nationkey + 18)::DOUBLE END AS VARCHAR) AS age_group
    FROM customer WHERE c_custkey % 53 <> 0 AND c_custkey % 41 <> 0"""
SQL["prepare_rejected"] = TITLES + f""", r AS (SELECT * FROM (SELECT {_RATING}) WHERE key BETWEEN 1 AND 6)
    SELECT 'users' AS source, 'wrong number of fields' AS reason, c_custkey || '::M' AS line FROM customer WHERE c_custkey % 53 = 0
    UNION ALL SELECT 'users', 'age is not a number', c_custkey || '::M::old::3::123' FROM customer
      WHERE c_custkey % 41 = 0 AND c_custkey % 53 <> 0
    UNION ALL SELECT 'items', 'no item id', '::' || title || '::Drama' FROM ty WHERE p_partkey % 31 = 0
    UNION ALL SELECT 'ratings', CASE WHEN key = 1 THEN 'wrong number of fields' WHEN key = 2 THEN 'no item id'
        WHEN key <= 4 THEN 'rating is not a number' ELSE 'time is not a whole number' END,
      CASE WHEN key = 1 THEN o_custkey || '::' || l_partkey ELSE o_custkey || '::' ||
        CASE WHEN key = 2 THEN ' ' ELSE CAST(l_partkey AS VARCHAR) END || '::' ||
        CASE key WHEN 3 THEN 'x' WHEN 4 THEN 'NaN' ELSE CAST(rating AS VARCHAR) END || '::' ||
        CASE key WHEN 5 THEN 'bad' WHEN 6 THEN '1.5' ELSE CAST(us // 1000000 AS VARCHAR) END END FROM r"""


def _copy_sql() -> str:
    """Each target parameter's rows: the source's values where the mapping says loaded, else its own."""
    from tidalrec.operators.towers import model_param_shapes
    feats = U_FEATS + I_FEATS
    sent = {10 ** 9 + i: f"(SELECT cardinality::VARCHAR FROM {'ucard' if f in U_FEATS else 'icard'} WHERE \"column\" = '{f}')"
            for i, f in enumerate(feats)}
    uc, ic = ({f: 10 ** 9 + feats.index(f) for f in side} for side in (U_FEATS, I_FEATS))
    shapes = " UNION ALL ".join(f"SELECT '{arch}' AS target_arch, * FROM ({_shape_sql(model_param_shapes(arch, uc, ic, 8, [16, 8], 1, 1), sent)})"
                                for arch in ("two_tower", "dlrm"))
    value = md5u("CASE WHEN loaded THEN '1' ELSE '2' END", "CASE WHEN loaded THEN source_param ELSE param END", "row_index", "i")
    return W(counts_sql("uc", USER_SRC), vocab_sql("uv", "uc", {f: MODEL_MIN[f] for f in U_FEATS}),
             card_sql("ucard", "uv", {f: MODEL_MIN[f] for f in U_FEATS}),
             counts_sql("ic", ITEM_SRC), vocab_sql("iv", "ic", {f: MODEL_MIN[f] for f in I_FEATS}),
             card_sql("icard", "iv", {f: MODEL_MIN[f] for f in I_FEATS}), f"m AS ({_warm_sql()})", f"shapes AS ({shapes})",
             """sized AS (SELECT s.target_arch, s.param, m.source_param, m.source_param IS NOT NULL AS loaded,
                  CASE WHEN shape LIKE '%x%' THEN CAST(split_part(shape, 'x', 1) AS BIGINT) ELSE 1 END AS n,
                  CASE WHEN shape = 'scalar' THEN 1 WHEN shape LIKE '%x%' THEN CAST(split_part(shape, 'x', 2) AS BIGINT)
                       ELSE CAST(shape AS BIGINT) END AS width
                FROM shapes s LEFT JOIN m ON m.status = 'loaded' AND m.target_arch = s.target_arch AND m.target_param = s.param)""",
             "cells AS (SELECT *, unnest(range(n)) AS row_index FROM sized)") + f"""
        SELECT target_arch, param, row_index, loaded AS copied,
          round(list_sum(list_transform(range(width), lambda i: {value} - 0.5)), 6) AS total FROM cells"""


SQL["warm_start_copy"] = _copy_sql()
SQL["recommend_answers"] = W(*U_POOL, *I_POOL, REC, """
    lists AS (SELECT user_id, count(*)::BIGINT AS n_items, string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY score DESC, item_id) AS items,
                max(score) AS best_score FROM scored GROUP BY 1),
    asked AS (SELECT user_id, max(k)::BIGINT AS top_k, max(reason) AS reason FROM el GROUP BY 1),
    lasts AS (SELECT o_custkey AS user_id, l_partkey AS latest_item, strftime(o_orderdate, '%Y-%m-%d') AS latest_date FROM (
        SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC NULLS LAST, l_orderkey DESC,
               l_linenumber DESC, l_partkey DESC, l_suppkey DESC) AS rn FROM train) WHERE rn = 1)""") + """
    SELECT a.user_id, a.top_k, a.reason, l.latest_item, l.latest_date, COALESCE(s.n_items, 0) AS n_items, s.items,
      round(s.best_score, 6) AS best_score
    FROM asked a LEFT JOIN lists s ON s.user_id = a.user_id LEFT JOIN lasts l ON l.user_id = a.user_id"""
