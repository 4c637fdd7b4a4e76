"""Connected components of a table of edges, by alternating large and small stars.

Every round links each node's larger neighbours to the least node it knows of, then its smaller ones; the edges
end as stars around the least node of each component after a number of rounds that grows with the logarithm of
the longest path. Each round is written to the shared folder. Nothing but counts reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._shared import save


def _least(edges: DataFrame) -> DataFrame:
    """Edges (u, v) with m, the least of u and its neighbours."""
    least = edges.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return edges.join(least, "u")


def components(edges: DataFrame) -> DataFrame:
    """edges: u, v (longs). One row per node that has an edge: node, component (its least node). The rounds end
    when the edges no longer change, as they do once all are stars."""
    now = save(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    sign = None
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _least(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        down = large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        small = _least(down).select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")))).alias("e"))
        now = save(small.select("e.u", "e.v").where("u <> v").distinct(), "edges")
        seen = tuple(now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if seen == sign:
            break
        sign = seen
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
