"""Warm start: map parameters of a retrieval model onto a ranking model.

Rules, in order, per source parameter (in its ordinal order):
1. exact name with the same shape;
2. prefix rewrite (user_tower.embeddings. / item_tower.embeddings. ->
   encoder.embeddings.) with the same shape;
3. unique target with the same suffix (text after the first '.') and shape;
   several such targets -> skipped as ambiguous.
A target keeps the first source mapped to it.  All steps are joins over the
two (param, shape) tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# fixed values: known cross-architecture prefix rewrites
REWRITES = [("user_tower.embeddings.", "encoder.embeddings."),
            ("item_tower.embeddings.", "encoder.embeddings.")]


def _suffix(c):
    return F.when(F.instr(c, ".") > 0, F.expr(f"substring({c}, instr({c}, '.') + 1)"))


def map_parameters(source: DataFrame, target: DataFrame) -> DataFrame:
    """source: (param, shape, ord); target: (param, shape).
    Returns (source_param, target_param, status) with status in
    loaded / duplicate_target / shape_mismatch / no_match / ambiguous."""
    cands = [F.struct(F.lit(0).alias("rule"), F.col("param").alias("cand"))]
    for i, (a, b) in enumerate(REWRITES):
        cands.append(F.struct(F.lit(i + 1).alias("rule"),
                              F.when(F.col("param").startswith(a),
                                     F.concat(F.lit(b), F.expr(f"substring(param, {len(a) + 1})"))).alias("cand")))
    s = source.select("param", "shape", "ord", F.explode(F.array(*cands)).alias("c")).select(
        "param", "shape", "ord", "c.rule", "c.cand").filter(F.col("cand").isNotNull())
    t = target.select(F.col("param").alias("cand"), F.col("shape").alias("tshape"))
    j = s.join(t, "cand", "inner")
    direct = (j.filter(F.col("shape") == F.col("tshape"))
              .groupBy("param").agg(F.min_by("cand", "rule").alias("direct")))
    mismatch = j.filter(F.col("shape") != F.col("tshape")).select("param").distinct().withColumn("mm", F.lit(True))
    ts = target.select(F.col("param").alias("sfx_target"), F.col("shape").alias("sshape"),
                       _suffix("param").alias("sfx")).filter(F.col("sfx").isNotNull())
    sfx = (source.select("param", "shape", _suffix("param").alias("sfx"))
           .join(ts, "sfx").filter(F.col("shape") == F.col("sshape"))
           .groupBy("param").agg(F.count(F.lit(1)).alias("n_sfx"), F.min("sfx_target").alias("sfx_target")))
    r = (source.join(direct, "param", "left").join(mismatch, "param", "left").join(sfx, "param", "left"))
    matched = F.coalesce(F.col("direct"), F.when(F.col("n_sfx") == 1, F.col("sfx_target")))
    r = r.withColumn("target_param", matched)
    first = Window.partitionBy("target_param").orderBy("ord")
    r = r.withColumn("_n", F.when(F.col("target_param").isNotNull(), F.row_number().over(first)))
    status = (F.when(F.col("target_param").isNotNull() & (F.col("_n") == 1), "loaded")
              .when(F.col("target_param").isNotNull(), "duplicate_target")
              .when(F.col("n_sfx") > 1, "ambiguous")
              .when(F.col("mm"), "shape_mismatch")
              .otherwise("no_match"))
    return r.select(F.col("param").alias("source_param"), "target_param", status.alias("status"))


def copy_parameters(source: DataFrame, target: DataFrame, mapping: DataFrame) -> DataFrame:
    """(param, row_index, vec, copied): the target's rows, those of loaded parameters with the source's values.

    source, target: (param, row_index, vec), one row per matrix row; mapping as of ``map_parameters``.  Rows are
    joined on (parameter, row), so tables of any size are copied without passing the driver.  A loaded parameter
    whose rows differ in number or width is an error: the mapping promised equal shapes.
    """
    loaded = mapping.where("status = 'loaded'").select("source_param", "target_param")
    moved = source.join(F.broadcast(loaded), F.col("param") == F.col("source_param")).select(  # a row per parameter
        F.col("target_param").alias("param"), "row_index", F.col("vec").alias("new"))
    mapped = loaded.select(F.col("target_param").alias("param"), F.lit(True).alias("wanted"))
    both = target.join(F.broadcast(mapped), "param", "left").join(moved, ["param", "row_index"], "full")
    wrong = F.col("vec").isNull() | (F.col("wanted") & (F.col("new").isNull() | (F.size("new") != F.size("vec"))))
    vec = F.when(wrong, F.raise_error(F.concat(F.lit("shapes differ in row "), F.col("row_index").cast("string"),
                                               F.lit(" of "), F.col("param"))).cast("array<double>"))
    return both.select("param", "row_index", vec.otherwise(F.coalesce("new", "vec")).alias("vec"),
                       F.col("new").isNotNull().alias("copied"))


def skip_counts(mapping: DataFrame) -> DataFrame:
    return mapping.groupBy("status").agg(F.count(F.lit(1)).alias("n"))
