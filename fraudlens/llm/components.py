"""Connected components of an edge table, by alternating star steps.

Edges may be any number and any shape; a node's neighbours are only ever
reduced by a partially aggregated minimum, never gathered.  Each round joins
the edges with those minima (a sort-merge join, whose hot keys adaptive
execution splits) and is written to the shared folder, which cuts the
lineage.  Rounds grow with the logarithm of the longest path.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fraudlens.llm.common import staged


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (columns a, b; longs):
    component is the smallest node reachable, itself included.  Loops and
    repeated edges are allowed; rows with a null end are ignored."""
    links = staged(edges.where("a is not null and b is not null and a != b")
                   .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    mark = _mark(links)
    while mark[0]:
        links = staged(_small_star(_large_star(links)), "links")
        before, mark = mark, _mark(links)
        if before == mark:
            break
    roots = links.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return links.select(F.col("a").alias("node"), F.col("b").alias("component")).unionAll(roots)


def _mark(links: DataFrame):
    """Count and an order-free checksum: equal marks mean equal tables."""
    h = F.xxhash64("a", "b")
    return tuple(links.agg(F.count("*"), F.sum(h.bitwiseAND(0xFFFFFFFF)),
                           F.sum(F.shiftrightunsigned(h, 32))).first())


def _large_star(links: DataFrame) -> DataFrame:
    """Every node hands its smallest neighbour (or itself) to its larger ones."""
    both = links.unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    # Written first: with an exchange of its own on either side, adaptive
    # execution can split the join's hot keys.
    least = staged(both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")), "least")
    return (both.where("b > a").join(least, "a")
            .select(F.col("b").alias("a"), F.col("m").alias("b")).where("a != b").distinct())


def _small_star(links: DataFrame) -> DataFrame:
    """Every node links itself and its smaller neighbours to the smallest."""
    least = links.groupBy("a").agg(F.min("b").alias("m"))
    moved = links.join(least, "a").where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionAll(least.select("a", F.col("m").alias("b"))).distinct()
