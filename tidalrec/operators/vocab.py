"""Vocabularies (categorical -> token index) and dense scalers.

Dictionary table: ``(column, value, cnt, token_index, is_tail)``
  * value = str(v); a missing value is the token 'None'
  * head values (cnt >= max(min_count, 1)) are numbered 1..N per column in
    binary (code-point) order of the text
  * with min_count > 1 a tail bucket N+1 exists (even if empty); tail values
    carry token_index N+1
  * a value never seen encodes to 0 (OOV)
Scaler table: ``(column, mean, std)`` with population std, std 0 -> 1 and no
valid value -> (0, 1).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidalrec.functions.columns import as_key, lenient_double
from tidalrec.operators.numbering import number_rows
from tidalrec.operators.skew import left_join_skew_safe, lookup_join
from tidalrec.session import cut_costly_lineage

# Dictionaries up to this many values per column are broadcast when encoding;
# larger ones (id columns) go through a shuffle join.
BROADCAST_VALUES = 2_000_000


def unpivot_values(df: DataFrame, columns: list[str], rename: dict[str, str] | None = None) -> DataFrame:
    """(column, value) rows for every listed column, value as token text."""
    rename = rename or {}
    if not columns:
        raise ValueError("no columns to unpivot")
    keyed = df.select(*[as_key(c).alias(c) for c in columns])
    out = keyed.unpivot([], columns, "column", "value")
    if rename:
        mapping = F.create_map(*[x for k, v in rename.items() for x in (F.lit(k), F.lit(v))])
        out = out.withColumn("column", F.coalesce(mapping[F.col("column")], F.col("column")))
    return out


def value_counts(sources: list[tuple[DataFrame, dict[str, str]]]) -> DataFrame:
    """Frequency of each (column, value) over several sources in one aggregate.

    ``sources`` is a list of (table, {source column: vocabulary column}); the
    union is counted once (partial + final hash aggregate)."""
    parts = [unpivot_values(df, list(m.keys()), m) for df, m in sources]
    allv = parts[0]
    for p in parts[1:]:
        allv = allv.unionByName(p)
    return allv.groupBy("column", "value").agg(F.count(F.lit(1)).alias("cnt"))


def _thresholds(spark: SparkSession, min_counts: dict[str, int]) -> DataFrame:
    rows = [(c, int(m)) for c, m in min_counts.items()]
    schema = "column string, min_count bigint"
    return spark.createDataFrame(rows, schema)


def fit_vocabulary(counts: DataFrame, min_counts: dict[str, int]) -> DataFrame:
    """Number head values per column; mark tail values.  ``min_counts`` must name
    every column present in ``counts``."""
    spark = counts.sparkSession
    counts = cut_costly_lineage(counts)  # a row per value; head, tail and every reader of the dictionary would count anew
    thr = F.broadcast(_thresholds(spark, min_counts))  # one row per column
    j = counts.join(thr, "column", "inner").withColumn(
        "is_tail", F.col("cnt") < F.greatest(F.col("min_count"), F.lit(1)))
    head = number_rows(j.filter(~F.col("is_tail")), [F.col("value")], ["column"], out="token_index")
    n_head = head.groupBy("column").agg(F.max("token_index").alias("n_head"))
    tail = (j.filter(F.col("is_tail"))
            .join(F.broadcast(n_head), "column", "left")
            .withColumn("token_index", (F.coalesce(F.col("n_head"), F.lit(0)) + 1).cast("bigint"))
            .drop("n_head"))
    cols = ["column", "value", "cnt", "token_index", "is_tail", "min_count"]
    return head.select(*cols).unionByName(tail.select(*cols))


def cardinality(vocab: DataFrame, min_counts: dict[str, int]) -> DataFrame:
    """Embedding rows per column: N + 1, or N + 2 when a tail bucket exists."""
    spark = vocab.sparkSession
    thr = F.broadcast(_thresholds(spark, min_counts))
    n_head = vocab.groupBy("column").agg(F.count_if(~F.col("is_tail")).alias("n_head"))
    return (thr.join(n_head, "column", "left")
            .select("column",
                    (F.coalesce(F.col("n_head"), F.lit(0)) + 1
                     + F.when(F.col("min_count") > 1, 1).otherwise(0)).cast("bigint").alias("cardinality")))


def encode_column(df: DataFrame, vocab: DataFrame, source_col: str, vocab_col: str | None = None,
                  out: str | None = None, broadcast: bool | None = None) -> DataFrame:
    """Replace values by token indices with a left equi-join on the dictionary."""
    vocab_col = vocab_col or source_col
    out = out or source_col
    d = (vocab.filter(F.col("column") == vocab_col)
         .select(F.col("value").alias("_v"), F.col("token_index").alias("_tok")))
    keyed = df.withColumn("_v", as_key(source_col))
    if broadcast is None:
        joined = lookup_join(keyed, d, "_v")
    else:
        joined = keyed.join(F.broadcast(d), "_v", "left") if broadcast else left_join_skew_safe(keyed, d, "_v")
    return (joined.withColumn(out, F.coalesce(F.col("_tok"), F.lit(0)).cast("bigint"))
            .drop("_v", "_tok"))


# ---- dense scalers ----------------------------------------------------------------

def fit_scalers(df: DataFrame, columns: list[str]) -> DataFrame:
    """One aggregate for all dense columns; (column, mean, std)."""
    spark = df.sparkSession
    if not columns:
        return spark.createDataFrame([], "column string, mean double, std double")
    aggs = []
    for i, c in enumerate(columns):
        x = lenient_double(c)
        aggs += [F.avg(x).alias(f"m{i}"), F.stddev_pop(x).alias(f"s{i}")]
    stats = df.agg(*aggs)
    rows = [F.struct(F.lit(c).alias("column"),
                     F.coalesce(F.col(f"m{i}"), F.lit(0.0)).alias("mean"),
                     F.when(F.col(f"s{i}").isNull() | (F.col(f"s{i}") == 0), F.lit(1.0))
                     .otherwise(F.col(f"s{i}")).alias("std"))
            for i, c in enumerate(columns)]
    return stats.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def scale_columns(df: DataFrame, scalers, columns: list[str]) -> DataFrame:
    """z-score with mean imputation: missing -> mean -> 0.0.  The scaler table
    holds one row per dense column, so it is read as literals (``scalers`` may
    also be the already-read {column: (mean, std)} dict)."""
    if not columns:
        return df
    if isinstance(scalers, dict):
        stats = scalers
    else:
        stats = {r["column"]: (r["mean"], r["std"])
                 for r in scalers.filter(F.col("column").isin(columns)).collect()}
    out = df
    for c in columns:
        mean, std = stats.get(c, (0.0, 1.0))
        x = lenient_double(c)
        out = out.withColumn(c, (F.coalesce(x, F.lit(mean)) - F.lit(mean)) / F.lit(std))
    return out


def vocab_stats(vocab: DataFrame) -> dict[str, tuple[int, int, int]]:
    """(values, head values, min count) per column: one small aggregate."""
    rows = vocab.groupBy("column").agg(F.count(F.lit(1)).alias("n"), F.count_if(~F.col("is_tail")).alias("h"),
                                       F.max("min_count").alias("m")).collect()
    return {r["column"]: (int(r["n"]), int(r["h"]), int(r["m"])) for r in rows}


def vocab_sizes(vocab: DataFrame) -> dict[str, int]:
    return {c: v[0] for c, v in vocab_stats(vocab).items()}


@dataclass
class Encoders:
    """Fitted vocabularies and scalers for one entity side.  The dictionary is
    persisted once fitted; ``sizes`` decides broadcast vs shuffle per column."""
    vocab: DataFrame            # (column, value, cnt, token_index, is_tail, min_count)
    scalers: DataFrame          # (column, mean, std)
    cat_cols: list[str]
    dense_cols: list[str]
    sizes: dict | None = None
    stats: dict | None = None
    _scaler_values: dict | None = None

    def __post_init__(self):
        if self.sizes is None:
            self.vocab = self.vocab.persist()
            self.stats = vocab_stats(self.vocab)
            self.sizes = {c: v[0] for c, v in self.stats.items()}

    def broadcastable(self, column: str) -> bool:
        return self.sizes.get(column, 0) <= BROADCAST_VALUES

    def cardinality(self, column: str, min_count: int | None = None) -> int:
        """N + 1, or N + 2 with a tail bucket (from the fit-time statistics)."""
        _, head, m = self.stats.get(column, (0, 0, min_count or 1))
        m = m if min_count is None else min_count
        return head + 1 + (1 if m > 1 else 0)

    def scaler_values(self) -> dict:
        """(mean, std) per dense column, read once (one row per column)."""
        if self._scaler_values is None:
            self._scaler_values = {r["column"]: (r["mean"], r["std"]) for r in self.scalers.collect()} \
                if self.dense_cols else {}
        return self._scaler_values


def build_encoders(users: DataFrame, items: DataFrame, train: DataFrame, spec) -> tuple[Encoders, Encoders]:
    """Fit both sides.  Id counts = entity rows + train interaction rows.

    When user and item column names are distinct, both dictionaries come from
    one aggregation: the train interactions are scanned once for both id
    columns and a single numbering pass serves both sides."""
    u_cat = [spec.user_id, *spec.user_cat]
    i_cat = [spec.item_id, *spec.item_cat]
    u_mins = {c: spec.min_count(c) for c in u_cat}
    i_mins = {c: spec.min_count(c) for c in i_cat}
    u_sc = fit_scalers(users, list(spec.user_dense))
    i_sc = fit_scalers(items, list(spec.item_dense))
    if set(u_cat) & set(i_cat):
        u_counts = value_counts([(users, {c: c for c in u_cat}), (train, {spec.inter_user: spec.user_id})])
        i_counts = value_counts([(items, {c: c for c in i_cat}), (train, {spec.inter_item: spec.item_id})])
        return (Encoders(fit_vocabulary(u_counts, u_mins), u_sc, u_cat, list(spec.user_dense)),
                Encoders(fit_vocabulary(i_counts, i_mins), i_sc, i_cat, list(spec.item_dense)))
    counts = value_counts([(users, {c: c for c in u_cat}), (items, {c: c for c in i_cat}),
                           (train, {spec.inter_user: spec.user_id, spec.inter_item: spec.item_id})])
    vocab = fit_vocabulary(counts, {**u_mins, **i_mins}).persist()
    stats = vocab_stats(vocab)

    def side(cols, sc, dense):
        st = {c: stats.get(c, (0, 0, 1)) for c in cols}
        return Encoders(vocab.filter(F.col("column").isin(cols)), sc, cols, dense,
                        sizes={c: v[0] for c, v in st.items()}, stats=st)

    return side(u_cat, u_sc, list(spec.user_dense)), side(i_cat, i_sc, list(spec.item_dense))


def encode_table(df: DataFrame, enc: Encoders, keep: list[str] | None = None) -> DataFrame:
    """Encode every categorical column (one join each) and scale dense columns."""
    out = df
    for c in enc.cat_cols:
        out = encode_column(out, enc.vocab, c, broadcast=enc.broadcastable(c))
    out = scale_columns(out, enc.scaler_values(), enc.dense_cols)
    cols = (keep or []) + enc.cat_cols + enc.dense_cols
    return out.select(*cols)


def vocab_mismatch(left: DataFrame, right: DataFrame) -> DataFrame:
    """(column, value, left_index, right_index) where two dictionaries disagree
    (null-safe full outer join on (column, value))."""
    l = left.select("column", "value", F.col("token_index").alias("left_index"))
    r = right.select("column", "value", F.col("token_index").alias("right_index"))
    return (l.join(r, ["column", "value"], "full_outer")
            .filter(~F.col("left_index").eqNullSafe(F.col("right_index"))))
