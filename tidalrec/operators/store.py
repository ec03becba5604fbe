"""Feature store: encoded entity tables keyed by raw id and 1-based position.

Position 0 is the unknown row: every token feature 0 (OOV) and every dense
feature 0.0 (the scaled mean).  Positions follow id order (a DataFrame has
no file order) and are assigned with the distributed numbering.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidalrec.functions.columns import as_key
from tidalrec.operators.numbering import number_rows
from tidalrec.operators.skew import lookup_join
from tidalrec.operators.vocab import Encoders, encode_table


def check_unique(df: DataFrame, id_col: str) -> int:
    """Row count of the entity table; raises when two ids share a lookup key (one aggregate).

    Keys are texts, so a missing id and the text 'None' can't stand side by side.
    """
    r = df.agg(F.count(F.lit(1)).alias("n"), F.count_distinct(as_key(id_col)).alias("d")).first()
    if r["n"] != r["d"]:
        raise ValueError(f"duplicate id in entity table column {id_col!r}")
    return int(r["n"])


def entity_positions(df: DataFrame, id_col: str, n_rows: int | None = None) -> DataFrame:
    """(id_key, position 1..N, row_index = position - 1) ordered by id."""
    ids = df.select(F.col(id_col).alias("_id"))
    numbered = number_rows(ids, [F.col("_id")], out="position", known_rows=n_rows)
    return numbered.select(as_key("_id").alias("id_key"), F.col("_id").alias(id_col), "position",
                           F.greatest(F.col("position") - 1, F.lit(0)).alias("row_index"))


@dataclass
class EntityStore:
    """Encoded entity table: id_key, position, then feature columns."""
    table: DataFrame
    id_col: str
    feature_cols: list[str]
    cat_cols: list[str]
    dense_cols: list[str]
    _n: int | None = None

    def count(self) -> int:
        if self._n is None:
            self._n = self.table.count()
        return self._n

    def all_features(self) -> DataFrame:
        """Every entity's encoded row (positions 1..N)."""
        return self.table.select("position", *self.feature_cols)

    def all_ids(self) -> DataFrame:
        """(position, raw id text) in position order semantics."""
        return self.table.select("position", "id_key")

    def lookup(self, ids: DataFrame, id_col: str, prefix: str = "", broadcast: bool = False) -> DataFrame:
        """Left equi-join by raw id; unknown ids get position 0 and a zero row.
        The way of the join follows from the store's bytes; ``broadcast`` skips measuring them."""
        keyed = ids.withColumn("_k", as_key(id_col))
        pos = prefix + "position" if prefix else "position"
        t = self.table.select(F.col("id_key").alias("_k"), F.col("position").alias(pos),
                              *[F.col(c).alias(prefix + c) for c in self.feature_cols])
        joined = keyed.join(F.broadcast(t), "_k", "left") if broadcast else lookup_join(keyed, t, "_k")
        out = joined.drop("_k")
        fills = {pos: 0}
        for c in self.cat_cols:
            fills[prefix + c] = 0
        for c in self.dense_cols:
            fills[prefix + c] = 0.0
        for c, v in fills.items():
            out = out.withColumn(c, F.coalesce(F.col(c), F.lit(v)))
        return out


def build_store(entities: DataFrame, enc: Encoders, id_col: str, validate: bool = True) -> EntityStore:
    n = check_unique(entities, id_col) if validate else None
    pos = entity_positions(entities, id_col, n).select("id_key", "position", F.col(id_col).alias("_pid"))
    enc_tab = encode_table(entities.withColumn("_rid", F.col(id_col)), enc, keep=["_rid"])
    # null-safe: the entity without an id is the one with the token 'None'
    table = pos.join(enc_tab, F.col("_pid").eqNullSafe(F.col("_rid")), "inner").drop("_rid", "_pid")
    feats = enc.cat_cols + enc.dense_cols
    return EntityStore(table.select("id_key", "position", *feats).persist(), id_col, feats,
                       list(enc.cat_cols), list(enc.dense_cols), n)
