"""Running folds whose state does not grow for ever.

* ``count_stream`` (running value counts) keeps no streaming state at all: a
  micro-batch's counts are a delta, and the result table sums them.
* ``latest_stream`` (running latest row per key) keeps each key's latest row in
  the RocksDB state store, with a time to live that a key's rows renew.  The
  state only spares the result table rows that can't win; the table keeps the
  latest row of every key.  So a key that was silent beyond the time to live
  loses its state, not its result, and a late row that then meets no state goes
  to the table as a candidate and loses there against the newer row.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import BooleanType, StructField, StructType

from tidalrec.operators.vocab import unpivot_values
from tidalrec.streaming.result_table import ResultTable

_STATE_CONF = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # else a query with a time to live goes on with empty batches for ever and never is through
    "spark.sql.streaming.noDataMicroBatches.enabled": "false",
}


@contextmanager
def rocksdb_state(spark: SparkSession):
    """Queries started inside keep their state in RocksDB: beyond memory, with incremental snapshots."""
    old = {k: spark.conf.get(k) for k in _STATE_CONF}
    for k, v in _STATE_CONF.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def drain(stream: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str) -> None:
    """Runs all that is available now through ``write(rows, batch)``."""
    query = (stream.writeStream.outputMode("update").foreachBatch(write)
             .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    query.awaitTermination()


# ---- running counts ---------------------------------------------------------------


def fold_counts(rows: DataFrame) -> DataFrame:
    return rows.groupBy("column", "value").agg(F.sum("cnt").alias("cnt"))


def count_stream(stream: DataFrame, columns: list[str], path: str, every: int = 8) -> ResultTable:
    """Counts (column, value, cnt) of all values seen so far, as a result table."""
    table = ResultTable(stream.sparkSession, path, fold_counts, every)

    def write(batch: DataFrame, n: int) -> None:
        table.add(unpivot_values(batch, columns).groupBy("column", "value").agg(F.count(F.lit(1)).alias("cnt")), n)

    drain(stream, write, f"{path}/_checkpoint")
    return table


# ---- latest row per key -------------------------------------------------------------


class KeepLatest(StatefulProcessor):
    """Emits a key's row when it beats the one in state; state is forgotten ``ttl_ms`` after a key's last row.

    A row beats another by a known time, the later time, then the greater tie break.
    """

    def __init__(self, state_schema: StructType, order: list[str], columns: list[str], ttl_ms: int):
        self.state_schema, self.order, self.columns, self.ttl_ms = state_schema, order, columns, ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.best = handle.getValueState("best", self.state_schema, self.ttl_ms)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        frame = pd.concat(list(rows), ignore_index=True)
        won = frame.sort_values(self.order, na_position="first").iloc[[-1]]
        rank = tuple(won[self.order].iloc[0])
        state = self.best.get() if self.best.exists() else None
        self.best.update(rank if state is None or rank > tuple(state) else tuple(state))
        if state is None or rank > tuple(state):
            yield won[self.columns]

    def close(self) -> None:
        pass


def fold_latest(key: str, order: list[str]) -> Callable[[DataFrame], DataFrame]:
    """One row per key: that of the greatest ``order``."""
    def fold(rows: DataFrame) -> DataFrame:
        best = rows.groupBy(key).agg(F.max_by(F.struct(*rows.columns), F.struct(*order)).alias("r"))
        return best.select(*(F.col(f"r.`{c}`").alias(c) for c in rows.columns))
    return fold


def latest_stream(stream: DataFrame, key: str, time_col: str, tie_break: list[str], payload: list[str], path: str,
                  ttl_ms: int = 7 * 24 * 3600 * 1000, every: int = 8) -> ResultTable:
    """The latest row of each key over the stream, with columns key, tie_break, payload, time_col, timed, at.

    A row without a time (``timed`` false) loses against any that has one; ``at`` is the time in microseconds.
    Tie breaks must not be null.
    """
    spark = stream.sparkSession
    columns = list(dict.fromkeys([key, *tie_break, *payload, time_col]))
    rows = stream.select(*columns, F.col(time_col).isNotNull().alias("timed"),
                         F.coalesce(F.unix_micros(F.col(time_col).cast("timestamp")), F.lit(0).cast("long")).alias("at"))
    columns = [*columns, "timed", "at"]
    order = ["timed", "at", *tie_break]
    fields = {f.name: f for f in rows.schema.fields}
    state = StructType([StructField("timed", BooleanType()), *(fields[c] for c in order[1:])])
    kept = rows.groupBy(key).transformWithStateInPandas(
        statefulProcessor=KeepLatest(state, order, columns, ttl_ms), outputStructType=rows.schema, outputMode="Update",
        timeMode="ProcessingTime")
    table = ResultTable(spark, path, fold_latest(key, order), every)
    with rocksdb_state(spark):
        drain(kept, table.add, f"{path}/_checkpoint")
    return table
