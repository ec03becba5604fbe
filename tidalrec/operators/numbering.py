"""Dense 1..N numbering without funnelling a group through one task.

A plain ``row_number().over(Window.partitionBy(g).orderBy(o))`` sends a whole
group to one task; with an id column (one group holding every value) that is
the whole table.  Instead:

1. range-partition on (group, order) and sort inside each partition, so a big
   group is spread over many partitions in order;
2. tag rows with the partition id and ``monotonically_increasing_id`` (which is
   consecutive inside a partition);
3. cut lineage with a reliable checkpoint so both passes below see exactly
   the same partitions even after a retry;
4. per (partition, group): row count and first id -> a table with at most
   #groups + #partitions rows; cumulative counts over earlier partitions give
   each (partition, group) its offset;
5. number = id - first id + offset + 1.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidalrec.session import cut_costly_lineage, is_stored

# Up to this many rows a plain window numbers the rows (one task per group is
# cheap at this size); above it the range-partitioned path is used.
SMALL_ROWS = 1_000_000


def _as_cols(cols) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in cols]


def number_rows(df: DataFrame, order_by: list, group_by: list[str] | tuple = (),
                out: str = "rn", partitions: int | None = None,
                few_groups: bool = True, force_distributed: bool = False,
                known_rows: int | None = None) -> DataFrame:
    """Add ``out`` = 1..n inside each group in ``order_by`` order.

    ``order_by`` must make the order total (add a unique tie-break column).
    ``few_groups`` lets the per-(partition, group) offset table be broadcast;
    its size is bounded by #groups x #partitions, so only set it when the
    number of groups is bounded (e.g. one group per vocabulary column).
    Without ``known_rows`` the rows are cached to be counted; up to SMALL_ROWS
    rows the result is read from that cache, which Spark drops when it needs the room.
    """
    spark = df.sparkSession
    group_by = list(group_by)
    order_cols = _as_cols(order_by)
    own_cache = known_rows is None and not is_stored(df)
    if own_cache:
        df = df.persist()
    if known_rows is None:
        known_rows = df.count()
    if not force_distributed and known_rows <= SMALL_ROWS:
        w = Window.partitionBy(*group_by).orderBy(*order_cols)
        return df.withColumn(out, F.row_number().over(w).cast("bigint"))
    if partitions is None:
        partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = [F.col(g) for g in group_by] + order_cols
    ranged = (df.repartitionByRange(partitions, *keys)
              .sortWithinPartitions(*keys)
              .withColumn("_pid", F.spark_partition_id())
              .withColumn("_mid", F.monotonically_increasing_id()))
    ranged = cut_costly_lineage(ranged)
    if own_cache:  # a cache of the caller's stays
        df.unpersist()
    stats = ranged.groupBy("_pid", *group_by).agg(
        F.count(F.lit(1)).alias("_n"), F.min("_mid").alias("_first"))
    before = Window.partitionBy(*group_by).orderBy("_pid").rowsBetween(
        Window.unboundedPreceding, -1)
    stats = stats.withColumn("_offset", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    stats = stats.select("_pid", *group_by, "_first", "_offset")
    names = ["_pid", *group_by]
    stats = stats.select(*(F.col(c).alias(f"_s_{c}") for c in names), "_first", "_offset")
    if few_groups:
        stats = F.broadcast(stats)
    same = F.lit(True)
    for c in names:  # null-safe: a NULL group is a group
        same = same & F.col(c).eqNullSafe(F.col(f"_s_{c}"))
    joined = ranged.join(stats, same, "inner").drop(*(f"_s_{c}" for c in names))
    return joined.withColumn(
        out, (F.col("_mid") - F.col("_first") + F.col("_offset") + F.lit(1)).cast("bigint")
    ).drop("_pid", "_mid", "_first", "_offset")
