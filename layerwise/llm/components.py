"""Connected components of an edge table by alternating large-star and small-star steps.

Every step is an aggregate and a join on the node, so a node with very many edges is combined
before the shuffle and its join may be split by adaptive execution.  Each round is written to the
shared folder; the driver sees one row per round, which tells whether the edges still change.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import stored

#: Ids given to classes without an id of their own start here; ids of rows are smaller.
UNNAMED = 1 << 62


def with_nodes(classes: DataFrame, key: str) -> DataFrame:
    """``classes`` with ``node``: ``least``, the smallest id in the class, or a number made from its
    ``key`` where no row of it has an id or another class has the same smallest one."""
    shared = classes.groupBy("least").agg(F.count(F.lit(1)).alias("n")).filter("n > 1 and least is not null") \
        .select("least", F.lit(True).alias("shared"))
    own = F.lit(UNNAMED) + (F.shiftright(F.xxhash64(key), 3) % (1 << 60)) + (1 << 60)
    return classes.join(shared, "least", "left").withColumn("node", F.when(
        F.col("least").isNull() | F.col("shared"), own).otherwise(F.col("least"))).drop("shared")


def named(classes: DataFrame, linked: DataFrame, key: str) -> DataFrame:
    """``key, component, name`` of every class: ``name`` is the smallest id in its component, or null."""
    placed = classes.select(key, "node", "least").join(linked, "node", "left") \
        .withColumn("component", F.coalesce("component", "node"))
    names = placed.groupBy("component").agg(F.min("least").alias("name"))
    return placed.select(key, "component").join(names, "component")


def _pull(edges: DataFrame) -> DataFrame:
    """Large star: every larger neighbour of a node is linked to the smallest of the node and its neighbours."""
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("low")).select("a", F.least("a", "low").alias("low"))
    return both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("low").alias("b")).distinct()


def _flatten(edges: DataFrame) -> DataFrame:
    """Small star: a node and its smaller neighbours are linked to the smallest of them.  Edges run from a to b < a."""
    least = edges.groupBy("a").agg(F.min("b").alias("low"))
    linked = edges.join(least, "a").filter("b > low").select(F.col("b").alias("a"), F.col("low").alias("b"))
    return linked.union(least.select("a", F.col("low").alias("b"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` for every node of ``edges`` (``a``, ``b``: long); component: the smallest node reachable."""
    current = stored(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                     .filter("a > b").distinct(), "edges")
    state = None
    while True:
        current = stored(_flatten(_pull(current)), "edges")
        found = current.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s")).first()
        if state == (found["n"], found["s"]):
            break
        state = (found["n"], found["s"])
    return current.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        current.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
