"""Line dedup: lines that an earlier document holds are dropped, told by a bitmap per document.

Every line of at least ``min_chars`` code points gives one row: a 128-bit hash
of its key, its document and its position.  The rows are range-partitioned by
(hash, document, position), so a line that millions of documents share lies in
as many partitions as it needs, in the order of its documents.  A task streams
its partition and knows of each line the first document that holds it; rows of
any other document are dropped lines.  Only the first line of a partition may
have begun in an earlier one: its rows stay undecided and are settled by a table
of the first and the last line of each partition.  What goes back to the texts
is a compressed bitmap per document, never a text.

Defined cases: a null or empty text is one empty line and keeps it; lines with
fewer code points are never dropped; repeated lines inside one document all
stay or all go; rows that share an id are one document, told apart by their
texts, and rows without an id are one document that comes after all others;
an empty table gives no rows.  Columns beside id and text are not read.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StringType

from tidalrec.llm.common import Scratch, load

SPACE = b" \t\n\x0b\x0c\r"

#: What tells a row of documents: without id, id, two halves of a 128-bit digest of the text.
OWNER = ["gap", "doc", "d1", "d2"]
_LINES = "h1 long, h2 long, gap boolean, doc long, d1 long, d2 long, pos int, n int"
_FOUND = "kind byte, " + _LINES
_DROPPED, _UNDECIDED, _BOUND = 0, 1, 2


def owner_columns(id_col: Column, text_col: Column) -> list[Column]:
    """The OWNER columns and the text, an absent one empty."""
    text = F.coalesce(text_col.cast("string"), F.lit(""))
    return [id_col.isNull().alias("gap"), F.coalesce(id_col.cast("long"), F.lit(0).cast("long")).alias("doc"),
            F.xxhash64(text).alias("d1"), F.xxhash64(F.lit("second"), text).alias("d2"), text.alias("text")]


def owners(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(owner_columns(F.col(f"`{id_col}`"), F.col(f"`{text_col}`")))


def _line_rows(min_chars: int):
    """Rows of _LINES for the lines that are long enough; a line met again in its text gives one for each place."""
    def run(batches):
        schema = pa.schema([("h1", pa.int64()), ("h2", pa.int64()), ("gap", pa.bool_()), ("doc", pa.int64()),
                            ("d1", pa.int64()), ("d2", pa.int64()), ("pos", pa.int32()), ("n", pa.int32())])
        for b in batches:
            digests, rows, places, sizes = [], [], [], []
            for i, text in enumerate(b.column("text").cast(pa.binary()).to_pylist()):
                lines = text.split(b"\n")
                for j, line in enumerate(lines):
                    key = line.strip(SPACE).lower()
                    # a code point has at most four bytes
                    if len(key) >= min_chars and (len(key) >= 4 * min_chars or len(key.decode()) >= min_chars):
                        digests.append(xxhash.xxh3_128_digest(key))
                        rows.append(i)
                        places.append(j)
                        sizes.append(len(lines))
            if not rows:
                continue
            h = np.frombuffer(b"".join(digests), "<i8").reshape(-1, 2)
            at = pa.array(rows, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(h[:, 0]), pa.array(h[:, 1]), *(b.column(c).take(at) for c in OWNER),
                 pa.array(places, pa.int32()), pa.array(sizes, pa.int32())], schema=schema)
    return run


def _first_holders(batches):
    """Streams sorted rows of _LINES and gives the rows of _FOUND.

    Across batches it carries one line: its hash, its first document and whether
    the partition began with it.
    """
    line = owner = None  # of the last row so far
    opening = True  # that line is the partition's first
    for b in batches:
        if not b.num_rows:
            continue
        h1, h2, doc = (b.column(c).to_numpy() for c in ("h1", "h2", "doc"))
        gap = b.column("gap").to_numpy(zero_copy_only=False)
        new = np.empty(len(h1), bool)  # the first row of its line in this batch
        new[0] = True
        new[1:] = (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])
        start = np.maximum.accumulate(np.where(new, np.arange(len(h1)), 0))
        first_doc, first_gap = doc[start], gap[start]
        same = line == (h1[0], h2[0])
        run = int(np.argmax(new[1:])) + 1 if new[1:].any() else len(h1)  # rows of the batch's first line
        if same:
            first_gap[:run], first_doc[:run] = owner
        head = np.zeros(len(h1), bool)
        if line is None:
            yield _found(b, np.array([0]), _BOUND)
            head[:run] = True
        elif same and opening:
            head[:run] = True
        opening = bool(head[-1])
        line, owner = (h1[-1], h2[-1]), (first_gap[-1], first_doc[-1])
        yield _found(b, np.flatnonzero(~head & ((doc != first_doc) | (gap != first_gap))), _DROPPED)
        yield _found(b, np.flatnonzero(head), _UNDECIDED)
    if line is not None and not opening:  # the last line may go on in the next partition
        schema = _found(b, np.array([], int), _BOUND).schema
        yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(
            (_BOUND, *line, *owner, 0, 0, 0, 0), schema)], schema=schema)


def _found(b: pa.RecordBatch, rows: np.ndarray, kind: int) -> pa.RecordBatch:
    taken = b.take(pa.array(rows, pa.int64()))
    return pa.RecordBatch.from_arrays([pa.array(np.full(len(rows), kind, np.int8)), *taken.columns],
                                      names=["kind", *taken.schema.names])


def dropped_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 10,
                  scratch: Scratch | None = None) -> DataFrame:
    """OWNER, pos, n: the places (from 0, of n lines) that lose their line."""
    scratch = scratch or Scratch(docs.sparkSession, "line-dedup")
    lines = owners(docs, id_col, text_col).mapInArrow(_line_rows(min_chars), _LINES)
    order = ["h1", "h2", *OWNER, "pos"]
    found = scratch.put(lines.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(_first_holders, _FOUND))
    # at most two rows for each partition
    holders = found.where(F.col("kind") == _BOUND).groupBy(F.col("h1").alias("b1"), F.col("h2").alias("b2")).agg(
        F.min(F.struct("gap", "doc")).alias("holder"))
    settled = found.where(F.col("kind") == _UNDECIDED).join(
        F.broadcast(holders), (F.col("h1") == F.col("b1")) & (F.col("h2") == F.col("b2"))).where(
        F.struct("gap", "doc") != F.col("holder"))
    columns = [*OWNER, "pos", "n"]
    return found.where(F.col("kind") == _DROPPED).select(columns).unionByName(settled.select(columns))


def pack_bits(bits: np.ndarray) -> bytes:
    return zlib.compress(np.packbits(bits, bitorder="little").tobytes())


def unpack_bits(packed: bytes, n: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(zlib.decompress(packed), np.uint8), count=n, bitorder="little").astype(bool)


@F.pandas_udf(BinaryType())
def _bitmap(dropped: pd.Series, n: pd.Series) -> pd.Series:
    def one(places, size):
        bits = np.ones(size, bool)
        bits[places] = False
        return pack_bits(bits)
    return pd.Series([one(p, s) for p, s in zip(dropped, n)], dtype=object)


def keep_bitmaps(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 10,
                 scratch: Scratch | None = None) -> DataFrame:
    """OWNER, n_dropped, keep: a compressed bit per line, set where it stays, of each text that loses lines.

    A text that is not listed keeps all.  The places gathered for a row are
    those of one text, so no row outgrows the text it speaks of.
    """
    places = dropped_lines(docs, id_col, text_col, min_chars, scratch).groupBy(*OWNER).agg(
        F.collect_set("pos").alias("places"), F.max("n").alias("n"))
    return places.select(*OWNER, F.size("places").cast("long").alias("n_dropped"), _bitmap("places", "n").alias("keep"))


@F.pandas_udf(StringType())
def _kept(text: pd.Series, keep: pd.Series) -> pd.Series:
    def one(t, k):
        if k is None:
            return None
        lines = t.split("\n")
        return "\n".join(np.array(lines, dtype=object)[unpack_bits(k, len(lines))])
    return pd.Series([one(t, k) for t, k in zip(text, keep)], dtype=object)


def kept_text(text: Column, keep: Column) -> Column:
    """The lines of ``text`` whose bits are set in ``keep``; all of them where it is null."""
    return F.when(keep.isNull(), text).otherwise(_kept(F.when(keep.isNotNull(), text), keep))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 10) -> DataFrame:
    """``docs`` with the same columns, its texts without the dropped lines; a null text becomes empty."""
    maps = keep_bitmaps(docs, id_col, text_col, min_chars)
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"),
                       *owner_columns(F.col(f"`{id_col}`"), F.col(f"`{text_col}`")))
    return rows.join(maps, OWNER, "left").select(*(
        (kept_text(F.col("text"), F.col("keep")) if c == text_col else F.col(f"row.`{c}`")).alias(c)
        for c in docs.columns))


def op13_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's line counts and the digest of what stays of it."""
    docs = load(spark, sf_dir, "documents")
    rows = owners(docs, "doc_id", "text").join(keep_bitmaps(docs), OWNER, "left")
    return rows.select(
        F.when(~F.col("gap"), F.col("doc")).alias("doc_id"),
        F.size(F.split("text", "\n", -1)).cast("long").alias("n_lines"),
        F.coalesce("n_dropped", F.lit(0).cast("long")).alias("n_dropped"),
        F.sha2(kept_text(F.col("text"), F.col("keep")).cast("binary"), 256).alias("kept_sha256"))
