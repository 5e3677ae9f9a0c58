"""Connected components of an edge table by alternating star joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dealsieve.llm.common import materialise


def _signature(edges: DataFrame):
    row = edges.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")).first()
    return row.n, row.x


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, root): every node that has an edge, with the smallest node of its component.

    Large-star links each node's larger neighbours to its smallest neighbour,
    small-star its smaller neighbours; the edges turn into stars in a
    logarithmic number of rounds.  Each round is joins and partial aggregates
    over the edge table, written to the shared folder; the driver sees only a
    count and a checksum.  Self-loops and repeated edges are allowed.
    """
    current = materialise(
        edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u != v").distinct(), "edges")
    before = _signature(current)
    while True:
        both = current.select(F.col("u").alias("x"), F.col("v").alias("y")) \
            .unionAll(current.select(F.col("v").alias("x"), F.col("u").alias("y")))
        # Stored, so that the join below has an exchange of its own and a hub's edges can be split over tasks.
        least = materialise(both.groupBy("x").agg(F.least(F.min("y"), F.col("x")).alias("m")), "least")
        large = both.where("y > x").join(least, "x").select(F.col("y").alias("u"), F.col("m").alias("v")).distinct()
        lowest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(lowest, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v")) \
            .unionAll(lowest.select("u", F.col("m").alias("v"))).distinct()
        current = materialise(small, "edges")
        after = _signature(current)
        if after == before:
            break
        before = after
    return current.select(F.col("u").alias("node"), F.col("v").alias("root")) \
        .unionAll(current.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
