"""Incremental folds as Structured Streaming queries.

Each micro-batch is written to ``<path>/batch_id=<n>`` with overwrite, so a
retried batch replaces its own output (idempotent sink); progress lives in a
checkpoint folder next to it.  The current state is then read back with a
batch reduction: latest batch per key (update mode) or the last batch
(complete mode).
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidalrec.operators.skew import small_enough
from tidalrec.operators.vocab import unpivot_values
from tidalrec.session import checkpoint_dir


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/stream-{name}-{uuid.uuid4().hex}"


def read_stream(spark: SparkSession, path: str, like: DataFrame | None = None,
                max_files: int | None = None) -> DataFrame:
    """Parquet file stream.  A folder streams every file in it; a single file
    is addressed through a one-file glob (the file source lists globs)."""
    schema = (like if like is not None else spark.read.parquet(path)).schema
    r = spark.readStream.schema(schema)
    if max_files:
        r = r.option("maxFilesPerTrigger", str(max_files))
    if path.endswith(".parquet"):
        head, _, name = path.rpartition("/")
        path = f"{head}/{name[0]}[{name[1]}]{name[2:]}" if len(name) > 2 else path
    return r.parquet(path)


def run_available(df: DataFrame, out_path: str, mode: str) -> None:
    """Drain everything available now into the batch-partitioned sink."""
    def sink(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out_path}/batch_id={batch_id}")

    q = (df.writeStream.outputMode(mode).foreachBatch(sink)
         .option("checkpointLocation", f"{out_path}/_checkpoint")
         .trigger(availableNow=True).start())
    q.awaitTermination()


def state_latest_per_key(spark: SparkSession, out_path: str, keys: list[str]) -> DataFrame:
    """Update-mode changelog -> current row per key (the newest batch wins)."""
    log = spark.read.parquet(out_path)
    cols = [c for c in log.columns if c not in keys and c != "batch_id"]
    g = log.groupBy(*keys).agg(F.max_by(F.struct(*cols), F.col("batch_id")).alias("_r"))
    return g.select(*keys, *[F.col("_r")[c].alias(c) for c in cols])


# ---- S1: running value counts ------------------------------------------------

def stream_value_counts(stream: DataFrame, columns: list[str]) -> DataFrame:
    """Running (column, value, cnt) over the stream (stateful aggregation)."""
    return unpivot_values(stream, columns).groupBy("column", "value").agg(F.count(F.lit(1)).alias("cnt"))


# ---- S2: running latest interaction ---------------------------------------------

def stream_latest(stream: DataFrame, key: str, time_col: str, tie_break: list[str],
                  payload: list[str]) -> DataFrame:
    """Running latest row per key; an older row never replaces a newer one
    because max_by keeps the greatest (valid, time, tie-break) across batches."""
    order = F.struct(F.col(time_col).isNotNull().alias("_valid"), F.col(time_col), *[F.col(c) for c in tie_break])
    val = F.struct(*[F.col(c) for c in payload], F.col(time_col).alias("_t"))
    g = stream.groupBy(key).agg(F.max_by(val, order).alias("_r"))
    return g.select(key, *[F.col("_r")[c].alias(c) for c in payload],
                    F.date_format(F.col("_r")["_t"], "yyyy-MM-dd").alias("latest_date"))


# ---- S3: encode a stream against fixed vocabularies ---------------------------------

def stream_encode(stream: DataFrame, vocab: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Stream-static left joins: {stream column: vocabulary column} -> token
    (0 when unknown).  Stateless, append mode."""
    from tidalrec.functions.columns import as_key
    out = stream
    for src, vcol in columns.items():
        d = vocab.filter(F.col("column") == vcol).select(
            F.col("value").alias(f"_v_{src}"), F.col("token_index").alias(f"_t_{src}"))
        if small_enough(d):  # else each micro-batch shuffles, and AQE splits what is skewed
            d = F.broadcast(d)
        out = (out.withColumn(f"_v_{src}", as_key(src)).join(d, f"_v_{src}", "left")
               .withColumn(f"{src}_token", F.coalesce(F.col(f"_t_{src}"), F.lit(0)).cast("bigint"))
               .drop(f"_v_{src}", f"_t_{src}"))
    return out
