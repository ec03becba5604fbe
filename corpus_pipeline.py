"""From raw documents to packed training sequences.

STAGES are applied in order, each written as Parquet and read again as the next
one's documents.  Every stage but the last returns the columns of documents.

Defined cases: a verdict applies to the row itself, told by its id and text, so rows
that share an id, or have none, are judged each by its own text; of repeated rows
(same id and text) near-dedup keeps one.  Null and empty texts have too few words and
go with the quality rules.  An empty table gives no rows.  Columns beside doc_id and
text are carried along, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidalrec.llm.bestfit import pack
from tidalrec.llm.common import Scratch, load
from tidalrec.llm.importance import resample
from tidalrec.llm.rule_ledger import V1, keep
from tidalrec.llm.tensor_minhash import NearDedup, near_duplicates


def _digest(text: Column) -> Column:
    return F.md5(F.coalesce(text, F.lit("")))


def _marked(docs: DataFrame) -> DataFrame:
    """doc_id, text and text_digest, by which the rows of an id, or without one, are told apart; no other column."""
    return docs.select("doc_id", "text", _digest(F.col("text")).alias("text_digest"))


def _only(docs: DataFrame, verdict: DataFrame) -> DataFrame:
    """The rows of docs whose own id and text are kept in ``verdict`` (doc_id, text_digest, kept).

    The rows travel in one struct, so that their columns may have any names.
    """
    rows = verdict.where("kept").select(F.col("doc_id").alias("kept_id"), F.col("text_digest").alias("kept_digest")).distinct()
    held = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), F.col("doc_id").alias("own_id"),
                       _digest(F.col("text")).alias("own_digest"))
    return held.join(rows, F.col("own_id").eqNullSafe(F.col("kept_id")) & (F.col("own_digest") == F.col("kept_digest")),
                     "left_semi").select(*(F.col(f"row.`{c}`").alias(c) for c in docs.columns))


BROADCAST_IDS = 2_000_000  # rows of an id and a digest; beyond it the join is shuffled


def _row_keys(marked: DataFrame, scratch: Scratch) -> DataFrame:
    """With row_key: the id; for rows without one, and for further texts of an id, a hash from 2^62 up."""
    shared = scratch.put(marked.where("doc_id is not null").groupBy(F.col("doc_id").alias("shared_id")).agg(
        F.min("text_digest").alias("first_digest"), F.max("text_digest").alias("last_digest")).where(
        "first_digest != last_digest").drop("last_digest"))
    if shared.count() <= BROADCAST_IDS:
        shared = F.broadcast(shared)
    top = F.lit(1 << 62).cast("long")
    own = F.xxhash64("doc_id", "text_digest").bitwiseAND(F.lit((1 << 62) - 1).cast("long")).bitwiseOR(top)
    is_own = F.col("doc_id").isNull() | (F.col("text_digest") != F.coalesce("first_digest", "text_digest"))
    return marked.join(shared, F.col("doc_id") == F.col("shared_id"), "left").withColumn(
        "row_key", F.when(is_own, own).otherwise(F.col("doc_id").cast("long")))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass policy v1 of the rule ledger."""
    return keep(docs, V1)


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents drawn by importance resampling towards the labelled good ones."""
    return _only(docs, resample(_marked(docs), load(spark, sf_dir, "labels"), carry=("text_digest",)))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates (5-word shingles, similarity 0.8); one of repeated rows."""
    keyed = _row_keys(_marked(docs), Scratch(spark, "row-keys"))
    verdict = near_duplicates(keyed, NearDedup(), "row_key", carry=("doc_id", "text_digest"))
    return _only(docs, verdict).dropDuplicates(["doc_id", "text"])


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places of all documents' pieces in sequences of 1024 tokens."""
    return pack(docs)


STAGES = [("quality_rules", quality_rules), ("quality_classifier", quality_classifier),
          ("near_dedup", near_dedup), ("packing", packing)]

#: No SQL: hashed models, minhash and byte-pair tokens are not expressible; tests hold it against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "pipeline")
    docs = load(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = scratch.put(stage(spark, docs, sf_dir))
    return docs
