"""Left joins with a lookup table, by its bytes and by the fact table's heavy keys.

A lookup whose measured bytes fit ``BROADCAST_BYTES`` is broadcast.  Above that,
one aggregate over the facts gives their number and a frequent-items sketch of
the key, which merges between tasks in bounded memory; rows of keys above
``HOT_SHARE`` meet their few lookup rows by broadcast, all others by shuffle.
Without such a key (missing ones count as one) the facts are joined in one pass.
What the sketch says only chooses the way a row takes, never the result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A key is hot when it holds more than this share of the fact rows; at most
# 1 / HOT_SHARE keys qualify.
HOT_SHARE = 0.001
# Lookups up to this size are broadcast.
BROADCAST_BYTES = 64 * 1024 * 1024
# The lookup rows of the hot keys, which are at most as many as those unless a key has several.
HOT_BYTES = 64 * 1024 * 1024
_ROW = 24  # bytes of a row besides its values, about
_WIDTH = {T.BooleanType: 1, T.ByteType: 1, T.ShortType: 2, T.IntegerType: 4, T.LongType: 8, T.FloatType: 4, T.DoubleType: 8,
          T.DateType: 4, T.TimestampType: 8, T.TimestampNTZType: 8}


def _value_bytes(value: Column, kind: T.DataType) -> Column | int:
    if type(kind) in _WIDTH:
        return _WIDTH[type(kind)]
    if isinstance(kind, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(value), F.lit(0)) + 8
    if isinstance(kind, T.ArrayType) and type(kind.elementType) in _WIDTH:
        return F.coalesce(F.array_size(value), F.lit(0)) * _WIDTH[type(kind.elementType)] + 16
    return F.coalesce(F.octet_length(F.to_json(F.struct(value.alias("v")))), F.lit(0)) + 16


def table_bytes(df: DataFrame, rows: int | None = None) -> int:
    """Bytes of a table's values: no job if its row count is known and all columns have a fixed width."""
    parts = [_value_bytes(F.col(f"`{f.name}`"), f.dataType) for f in df.schema.fields]
    fixed = sum(p for p in parts if isinstance(p, int)) + _ROW
    varying = [p for p in parts if not isinstance(p, int)]
    if rows is not None and not varying:
        return rows * fixed
    size = F.lit(fixed)
    for p in varying:
        size = size + p
    return int(df.agg(F.coalesce(F.sum(size.cast("bigint")), F.lit(0))).first()[0])


def small_enough(df: DataFrame, rows: int | None = None) -> bool:
    return table_bytes(df, rows) <= BROADCAST_BYTES


def _hot_hashes(fact: DataFrame, hashed: Column, hot_share: float) -> list[int]:
    """Hashes of the keys that hold more than ``hot_share`` of the rows, by one aggregate."""
    tracked = min(1_000_000, int(8 / hot_share))  # the sketch errs by less than half of hot_share
    row = fact.select(hashed.alias("h")).agg(
        F.count(F.lit(1)).alias("n"), F.expr(f"approx_top_k(h, {int(1 / hot_share) + 1}, {tracked})").alias("top")).first()
    return [t["item"] for t in row["top"] if t["item"] is not None and t["count"] > max(1, row["n"] * hot_share)]


def shuffled_left_join(fact: DataFrame, lookup: DataFrame, on: list[str], hot_share: float | None = None) -> DataFrame:
    """``fact LEFT JOIN lookup USING (on)`` for a lookup too large to broadcast; where keys are hot, fact rows
    with a null key stay where they are."""
    hashed = F.xxhash64(*on)
    hot = _hot_hashes(fact, hashed, HOT_SHARE if hot_share is None else hot_share)
    if not hot:  # two branches would compute the facts twice
        return fact.join(lookup, on, "left")
    unkeyed = F.lit(False)
    for c in on:
        unkeyed = unkeyed | F.col(c).isNull()
    few = lookup.where(hashed.isin(hot))
    if table_bytes(few) > HOT_BYTES:  # a lookup with many rows for a hot key
        return fact.join(lookup, on, "left")
    apart = unkeyed | hashed.isin(hot)
    return (fact.where(apart).join(F.broadcast(few), on, "left")
            .unionByName(fact.where(~apart).join(lookup, on, "left")))


def lookup_join(fact: DataFrame, lookup: DataFrame, on: str | list[str], rows: int | None = None) -> DataFrame:
    """``fact LEFT JOIN lookup USING (on)``: broadcast by measured bytes, else shuffled with hot keys apart.

    ``rows`` is the lookup's row count if known."""
    on = [on] if isinstance(on, str) else list(on)
    if small_enough(lookup, rows):
        return fact.join(F.broadcast(lookup), on, "left")
    return shuffled_left_join(fact, lookup, on)


def left_join_skew_safe(fact: DataFrame, lookup: DataFrame, key: str, hot_share: float | None = None) -> DataFrame:
    """``shuffled_left_join`` on one column."""
    return shuffled_left_join(fact, lookup, [key], hot_share)
