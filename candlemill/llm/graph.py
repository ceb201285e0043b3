"""Connected components of an edge table, by alternating large and small stars.

Each round hangs the larger neighbours of a vertex on its smallest neighbour, then the
smaller ones; rounds grow with the logarithm of the longest path. Edges stay a
distributed table; every round is written to the shared scratch folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from candlemill.session import written


def _lowest(edges: DataFrame) -> DataFrame:
    return edges.groupBy("u").agg(F.min("v").alias("low"))


def _marks() -> list:
    """Number and hash of distinct edges; no sum, which could pass the range of bigint."""
    return [F.count("*").alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("hash")]


def fingerprint(edges: DataFrame) -> tuple:
    return tuple(edges.agg(*_marks()).head())


def _written(edges: DataFrame) -> tuple[DataFrame, tuple]:
    """The edges as a table, and their fingerprint, seen while they are written."""
    seen = Observation()
    table = written(edges.observe(seen, *_marks()), "edges")
    return table, (seen.get["n"], seen.get["hash"])


def components(edges: DataFrame) -> DataFrame:
    """(vertex, component) for every vertex of `edges` (columns a, b; any order, repeats and loops allowed).

    The component is the smallest vertex reachable. Edges with a NULL end are left out; an
    empty table gives no rows.
    """
    ends = edges.where("a is not null and b is not null").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    tree, now = _written(ends.where("u <> v").distinct())
    before = None
    while now[0] and now != before:
        before = now
        both = tree.unionByName(tree.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = _lowest(both).withColumn("low", F.least("u", "low"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("low").alias("v")).distinct()
        joined = large.join(_lowest(large), "u")
        small = joined.select(F.explode(F.array(F.struct("u", "low"), F.struct(F.col("v").alias("u"), "low"))).alias("e"))
        tree, now = _written(small.select("e.u", F.col("e.low").alias("v")).where("u <> v").distinct())
    roots = _lowest(tree).select(F.col("u").alias("vertex"), F.col("low").alias("component"))
    return roots.unionByName(roots.select(F.col("component").alias("vertex"), "component").distinct())
