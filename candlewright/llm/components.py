"""Connected components by alternating large-star and small-star rounds (Kiveris et al., SoCC 2014).

Every half-round is written to the shared folder. Both sides of its join are then plain scans, so adaptive
execution can split the rows of a node that a third of all edges meet.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import drop_path, path_of, written


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def connected_components(edges: DataFrame, a: str = "a", b: str = "b", most_rounds: int = 64) -> DataFrame:
    """(node, root) for every node of an edge between different nodes; root is the least node reachable.

    Repeated edges, loops and nulls are ignored. No edges give no rows.
    """
    spark = edges.sparkSession
    edges = edges.filter(F.col(a) != F.col(b))
    stars = written(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(), "edges")
    mark = _mark(stars)
    for _ in range(most_rounds):
        if not mark[0]:
            break
        both = stars.unionByName(stars.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = written(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "star-min")
        large = written(both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), "large-star")
        lower = written(large.groupBy("u").agg(F.min("v").alias("m")), "star-min")
        small = large.join(lower, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        after = written(small.unionByName(lower.select("u", F.col("m").alias("v"))).distinct(), "small-star")
        for old in (stars, least, large, lower):
            drop_path(spark, path_of(old)) if old.inputFiles() else None
        stars, before, mark = after, mark, _mark(after)
        if mark == before:
            break
    else:
        raise RuntimeError(f"components did not settle in {most_rounds} rounds")
    return stars.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(stars.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
