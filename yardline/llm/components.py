"""Connected components of a graph too large for one machine."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from yardline.llm.text import materialise


def _state(edges: DataFrame) -> tuple[int, int | None]:
    row = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()
    return row["n"], row["s"]


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for the nodes of edges (u, v); component is the smallest node it reaches.

    Large-star and small-star by turns: every node is hung under the smallest of its neighbours,
    until trees have depth one. Minima are aggregated before each shuffle and joined back to the
    edges, so a node with very many neighbours is split like any skewed join. The driver only sees
    a count and a checksum per turn; each turn is written to the shared scratch folder.
    """
    edges = materialise(
        edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(),
        "edges",
    )
    last = _state(edges)
    while last[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        smallest = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(smallest, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.filter("u <> v").distinct()
        large = materialise(large, "edges")
        below = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(below, "u").select(F.col("v").alias("a"), F.col("u").alias("b"), "m")
        small = small.select(F.explode(F.array("a", "b")).alias("u"), F.col("m").alias("v"))
        edges = materialise(small.filter("u <> v").distinct(), "edges")
        now = _state(edges)
        if now == last:
            break
        last = now
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component"))
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots).distinct()
