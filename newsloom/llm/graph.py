"""Connected components by alternating star contraction; every round is a written table.

Edges only shrink towards the smallest vertex of each component, so no vertex's neighbours are
gathered anywhere: each round takes minima with combination before the shuffle and joins them
back.  Two stars a round reach components of any diameter in logarithmically many rounds.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.llm import scratch


def _star(edges: DataFrame, small: bool) -> DataFrame:
    """Link each vertex's larger (or its smaller) neighbours to its least neighbour."""
    near = edges if small else edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    if small:
        near = near.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = near.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    joined = near.join(least, "u")
    if small:
        out = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
    else:
        out = joined.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    out = out.where("u <> v")
    return out.distinct() if small else out


def components(edges: DataFrame) -> DataFrame:
    """(vertex, component) of all vertices of the (u, v) edges; a component is its least vertex."""
    seen = None
    edges = scratch.table(edges.where("u <> v").select("u", "v").distinct(), "edges")
    while True:
        state = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()  # exact: a sum of doubles varies with the order of tasks
        if state == seen or not state[0]:
            break
        seen = state
        wide = scratch.table(_star(edges, small=False), "edges")
        scratch.discard(edges)
        edges = scratch.table(_star(wide, small=True), "edges")
        scratch.discard(wide)
    roots = edges.select(F.col("v").alias("u"), "v").distinct()
    return scratch.table(edges.unionByName(roots).select(F.col("u").alias("vertex"), F.col("v").alias("component")), "components")
