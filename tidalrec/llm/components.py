"""Connected components, and links found through shared bucket keys.

Neither routine gathers a component, a bucket or the links on the driver or in
one task: everything is joins and partial aggregates, with lineage cut by
tables in the shared folder.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidalrec.llm.common import Scratch, sieve
from tidalrec.operators.skew import lookup_join


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _point_to_least(near: DataFrame) -> DataFrame:
    """(a, b, least): least of a's neighbours and a itself, beside each neighbour."""
    least = near.groupBy("a").agg(F.min("b").alias("least"))
    return near.join(least, "a").withColumn("least", F.least("a", "least"))


def connected_components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """(id, component): the least id reachable, for every id with an edge.

    ``edges`` has columns a and b.  Alternating large-star and small-star steps
    (Kiveris et al. 2014) end in stars around the least ids, after a number of
    rounds logarithmic in the size; each round joins edges with one row per node.
    """
    edges = scratch.put(edges.where("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    state = None
    while True:
        large = _point_to_least(_both_ways(edges)).where("b > a").select(F.col("b").alias("a"), F.col("least").alias("b"))
        down = large.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
        pointed = _point_to_least(down)
        small = pointed.select(F.col("b").alias("a"), F.col("least").alias("b")).union(
            pointed.select("a", F.col("least").alias("b")))
        new = scratch.put(small.where("a <> b").distinct())
        scratch.drop(edges)
        edges = new
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == state:
            break
        state = now
    return edges.select(F.col("a").alias("id"), F.col("b").alias("component")).union(
        edges.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct())


def with_keys(classes: DataFrame, scratch: Scratch) -> tuple[DataFrame, bool]:
    """``classes`` (least, d1, d2, ...) with a key of its own for each class; whether some id was the least of several.

    The key is the class's least id, but where rows of one id fall into several classes, all but
    one of those get a hash of their digest from 2^62 up.
    """
    shared = scratch.put(classes.where("least is not null").groupBy(F.col("least").alias("shared_least")).agg(
        F.count(F.lit(1)).alias("classes"), F.min(F.struct("d1", "d2")).alias("first")).where("classes > 1"))
    if shared.isEmpty():
        return classes.withColumn("id", F.col("least")), False
    own = F.xxhash64("least", "d1", "d2").bitwiseAND(F.lit((1 << 62) - 1).cast("long")).bitwiseOR(F.lit(1 << 62).cast("long"))
    is_first = F.col("first").isNull() | (F.struct("d1", "d2") == F.col("first"))
    return classes.join(shared, F.col("least") == F.col("shared_least"), "left").withColumn(
        "id", F.when(is_first, F.col("least")).otherwise(own)).drop("shared_least", "classes", "first"), True


def least_ids(found: DataFrame, classes: DataFrame, several: bool) -> DataFrame:
    """(id, component) of ``link_buckets`` with each component named by the least id of its rows."""
    if not several:
        return found
    named = found.join(classes.select("id", "least"), "id").groupBy("component").agg(F.min("least").alias("name"))
    return found.join(named, "component").select("id", F.col("name").alias("component"))


def link_buckets(members: DataFrame, verify: Callable[[DataFrame], DataFrame], near,
                 scratch: Scratch, across: Callable[[DataFrame], DataFrame] | None = None,
                 crowded: Callable[[DataFrame], DataFrame] | None = None, crowd: int = 64) -> DataFrame:
    """Components of the links among ids that share a bucket key; (id, component).

    ``members`` has key, id, home (true if the id is stored under the key, false
    if it only probes it) and any columns that ``near(x, y)`` reads to rule a
    pair out from the rows' aliases.  ``verify`` gets pairs (a, b), a < b, each
    once, and returns those that are links.

    First every member is compared with the least id of its bucket, which joins
    a large group of copies with one comparison each.  Then the members of
    buckets that are not in one component yet are compared with each other, so
    no link that could change the result is left out, and pairs within a group
    of copies are never made.  ``across`` makes these pairs from the members
    (key, id, home, component and the others) where it knows a better way than
    all pairs of a bucket.  ``crowded``, if given, gets the members of buckets of
    more than ``crowd`` members, whose pairs are not made, and returns links (a, b)
    that connect whatever is linked there.
    """
    full = members.groupBy("key").agg(
        F.min(F.when(F.col("home"), F.col("id"))).alias("centre"), F.max("id").alias("top"), F.min("id").alias("low")
    ).where("centre is not null and low < top").select("key", "centre")
    full = scratch.put(full)
    members = scratch.put(sieve(members, "key", full).join(full, "key"))
    extra = [c for c in members.columns if c not in ("key", "id", "home", "centre")]
    hubs = members.where("home and id = centre").dropDuplicates(["key"]).select(
        "key", *(F.col(c).alias(f"hub_{c}") for c in extra))
    spokes = members.where("id <> centre").join(hubs, "key")
    pairs = scratch.put(spokes.where(near(F.col, lambda c: F.col(f"hub_{c}"))).select(
        F.least("id", "centre").alias("a"), F.greatest("id", "centre").alias("b")).distinct())
    links = scratch.put(verify(pairs))
    first = scratch.put(connected_components(links, scratch))

    named = members.drop("centre").join(first, "id", "left").withColumn("component", F.coalesce("component", "id"))
    mixed = named.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo < hi")
    named = scratch.put(named.join(mixed.select("key"), "key", "left_semi"))
    dense = None
    if crowded is not None:
        full = scratch.put(named.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > crowd))
        marked = lookup_join(named, full, "key")
        dense = scratch.put(crowded(marked.where("n is not null")))
        named = marked.where("n is null").drop("n")
    if across is None:
        x, y = named.where("home").alias("x"), named.alias("y")
        rest = x.join(y, F.col("x.key") == F.col("y.key")).where(
            (F.col("x.component") != F.col("y.component"))
            & near(lambda c: F.col(f"x.{c}"), lambda c: F.col(f"y.{c}"))).select(
            F.least("x.id", "y.id").alias("a"), F.greatest("x.id", "y.id").alias("b")).distinct()
    else:
        rest = across(named)
    more = verify(scratch.put(rest.join(pairs, ["a", "b"], "left_anti")))
    more = scratch.put(more if dense is None else more.union(dense))
    # components of components: the links found second join the ids' first components
    joined = more.join(first.withColumnRenamed("id", "a").withColumnRenamed("component", "ca"), "a", "left").join(
        first.withColumnRenamed("id", "b").withColumnRenamed("component", "cb"), "b", "left").select(
        F.coalesce("ca", "a").alias("a"), F.coalesce("cb", "b").alias("b"))
    second = connected_components(joined, scratch)
    merged = first.join(second.select(F.col("id").alias("component"), F.col("component").alias("final")),
                        "component", "left").select("id", F.coalesce("final", "component").alias("component"))
    new = second.join(first.select("id"), "id", "left_anti")
    return scratch.put(merged.union(new.select("id", "component")))
