"""Table sources and sinks (parquet, `::`-delimited text)."""

from __future__ import annotations

import math
import re
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidalrec.session import checkpoint_dir


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """Whole-table parquet scan; other formats are rejected."""
    p = path.rstrip("/")
    if not (p.endswith(".parquet") or p.endswith(".pq") or "." not in p.rsplit("/", 1)[-1]):
        raise ValueError(f"only parquet tables are supported: {path}")
    return spark.read.parquet(path)


def read_batches(spark: SparkSession, path: str, batch_bytes: int | None = None) -> DataFrame:
    """Bounded-memory scan: every task's split holds about ``batch_bytes`` of the
    files, by a session of its own with that split size; the caller's settings
    stay as they are.  Spark prunes columns and streams row groups, so nothing is
    loaded whole."""
    if not batch_bytes:
        return read_table(spark, path)
    own = spark.newSession()
    own.conf.set("spark.sql.session.timeZone", spark.conf.get("spark.sql.session.timeZone"))
    own.conf.set("spark.sql.files.maxPartitionBytes", str(int(batch_bytes)))
    return read_table(own, path)


def read_delimited(spark: SparkSession, path: str, columns: list[str],
                   types: dict[str, T.DataType] | None = None, sep: str = "::",
                   encoding: str = "ISO-8859-1") -> DataFrame:
    """Header-less delimited text (latin-1 by default) with fixed column names."""
    types = types or {}
    schema = T.StructType([T.StructField(c, types.get(c, T.StringType()), True) for c in columns])
    return (spark.read.schema(schema).option("sep", sep).option("encoding", encoding)
            .option("header", "false").option("mode", "PERMISSIVE").csv(path))


def read_lines(spark: SparkSession, path: str, columns: list[str], sep: str = "::", encoding: str = "ISO-8859-1") -> DataFrame:
    """Delimited text with nothing lost: the fields as text, the whole ``line``, and whether it is ``complete``,
    that is, has as many fields as there are columns.  Absent fields are null, further ones stay in the line."""
    parts = F.split("line", re.escape(sep), -1)
    rows = spark.read.option("encoding", encoding).option("lineSep", "\n").text(path).select(F.col("value").alias("line"))
    return rows.select(*(F.get(parts, F.lit(n)).alias(c) for n, c in enumerate(columns)), "line",
                       (F.size(parts) == len(columns)).alias("complete"))


def write_table(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def stored(df: DataFrame, owner: str) -> DataFrame:
    """``df`` written as parquet under the shared checkpoint folder and read back: what it costs is paid once."""
    path = f"{checkpoint_dir(df.sparkSession).rstrip('/')}/{owner}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def batch_count(n_rows: int, batch_size: int, negatives: int = 0) -> int:
    """Training batches for ``n_rows`` positives: ceil(n/b) * (1 + negatives)."""
    if n_rows <= 0:
        return 0
    return math.ceil(n_rows / batch_size) * (1 + negatives)


# ---- the supplied test tables -------------------------------------------------

def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def interactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders joined to lineitem: one row per line; ``row_key`` is unique."""
    o = load(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    li = load(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity")
    x = li.join(o, li.l_orderkey == o.o_orderkey, "inner").drop("o_orderkey")
    return x.withColumn(
        "row_key", F.concat_ws("|", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"))


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "customer")


def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "part")
