"""Helpers shared by the training-data operators."""

from __future__ import annotations

import uuid
from collections.abc import Callable

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidalrec.session import checkpoint_dir

_U64 = np.uint64


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once per row.

    A lambda variable is never inlined, so a value read inside nested
    higher-order functions is not computed again for every element.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


class Scratch:
    """Parquet tables under the shared checkpoint folder that cut a query's lineage.

    A table written here survives lost executors.  ``drop`` deletes tables
    that nothing reads any more; what a returned frame still reads stays.
    """

    def __init__(self, spark: SparkSession, owner: str):
        self.spark = spark
        self.root = f"{checkpoint_dir(spark).rstrip('/')}/{owner}-{uuid.uuid4().hex}"
        self._n = 0

    def put(self, df: DataFrame) -> DataFrame:
        self._n += 1
        path = f"{self.root}/{self._n}"
        df.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out.scratch_path = path
        return out

    def drop(self, *tables: DataFrame) -> None:
        jvm = self.spark.sparkContext._jvm
        conf = self.spark.sparkContext._jsc.hadoopConfiguration()
        for t in tables:
            path = jvm.org.apache.hadoop.fs.Path(t.scratch_path)
            path.getFileSystem(conf).delete(path, True)


def sieve(df: DataFrame, column: str, wanted: DataFrame, log2_bits: int = 26) -> DataFrame:
    """The rows of ``df`` whose ``column`` may be among the values of ``wanted``'s ``column``.

    A Bloom filter of one hash as a table of 64-bit words, so what is broadcast
    has at most 2^(log2_bits - 6) rows of 16 bytes.  It lets no wanted row go;
    some others pass, all of them once there are far more values than bits.
    """
    h = F.xxhash64(F.col(column)).bitwiseAND(F.lit((1 << log2_bits) - 1).cast("long"))
    low = h.bitwiseAND(F.lit(63).cast("long")).cast("int")
    one = F.lit(1).cast("long")
    bit = F.call_function("shiftleft", one, low)
    words = wanted.select(F.shiftright(h, 6).alias("sieve_word"), bit.alias("b")).groupBy("sieve_word").agg(
        F.bit_or("b").alias("sieve_bits"))
    return df.join(F.broadcast(words), (F.shiftright(h, 6) == F.col("sieve_word"))
                   & (F.col("sieve_bits").bitwiseAND(bit) != 0), "left_semi")


def word_hashes(text: bytes) -> np.ndarray:
    """64-bit hashes of the ``[^\\x20\\x09-\\x0D]+`` words of UTF-8 bytes."""
    words = text.split()  # bytes.split() cuts at exactly \x20 and \x09-\x0D
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), dtype=_U64, count=len(words))


def mix64(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser (splitmix64 constants)."""
    x = (x ^ (x >> _U64(30))) * _U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U64(27))) * _U64(0x94D049BB133111EB)
    return x ^ (x >> _U64(31))


def window_hashes(words: np.ndarray, width: int) -> np.ndarray:
    """Order-sensitive hashes of all windows of ``width`` consecutive words."""
    n = len(words) - width + 1
    if n <= 0:
        return np.empty(0, _U64)
    acc = np.zeros(n, _U64)
    for j in range(width):
        acc = mix64(acc * _U64(0x9E3779B97F4A7C15) + words[j:j + n])
    return acc
