"""Connected components of a graph given as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.shared import checkpointed


def connected_components(links: DataFrame) -> DataFrame:
    """(id, component) for every end of a link (a, b); the component is its smallest id.

    Alternates two steps: every id hands its larger neighbours to its smallest
    one, then its smaller neighbours. Both are an aggregate and a join, rows
    never exceed the links, and the table shrinks towards one row for each id.
    Minima are stored before the join so that both its sides are shuffled and a
    hub with many links is split among tasks.
    """
    edges = checkpointed(
        links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u != v").distinct()
    )
    while True:
        ends = edges.select(F.col("u").alias("id"), F.lit(1).alias("child"), F.lit(0).alias("root")).union(edges.select("v", F.lit(0), F.lit(1)))
        seen = ends.groupBy("id").agg(F.sum("child").alias("links"), F.max("root").alias("root"))
        if seen.where("links > 1 or (links = 1 and root = 1)").isEmpty():
            # every id hangs on one smallest id, which hangs on none
            return edges.select(F.col("u").alias("id"), F.col("v").alias("component")).union(edges.select("v", "v").distinct())
        both = edges.union(edges.select("v", "u"))
        lowest = checkpointed(both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m")))
        wide = checkpointed(both.join(lowest, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        lowest = checkpointed(wide.groupBy("u").agg(F.min("v").alias("m")))
        near = wide.join(lowest, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = checkpointed(near.union(lowest).distinct())
