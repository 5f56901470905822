"""Connected components of a graph of 64-bit nodes, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandline.llm.common import written


def _hang(pairs: DataFrame) -> DataFrame:
    """Every pair (a, b) with the smallest partner of ``a``; a partial aggregate and
    a join, so the partners of a busy node are never gathered."""
    lowest = pairs.groupBy("a").agg(F.min("b").alias("low"))
    return pairs.join(lowest, "a")


def components(edges: DataFrame) -> DataFrame:
    """``node``, ``root``: the smallest node that each node reaches.

    ``edges`` has the columns ``a`` and ``b``, in any direction, with repeats.
    Nodes without an edge do not appear; no edges give no rows.  Each round hangs
    larger neighbours, then smaller ones, on the smallest one known (large star and
    small star); their number grows with the logarithm of the longest path.  Each
    round is a table in the shared folder.
    """
    forest = written(
        edges.filter("a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct(),
        "edges",
    )
    while not stars(forest):
        both = forest.union(forest.select("b", "a"))
        # A table of its own: Spark would join it again for every use.
        large = written(
            _hang(both)
            .filter("b > a")
            .select(F.col("b").alias("a"), F.least("low", "a").alias("b"))
            .distinct(),
            "edges",
        )
        ends = F.explode(F.array("a", "b")).alias("a")
        small = _hang(large).select(ends, F.col("low").alias("b")).filter("a <> b")
        forest = written(small.distinct(), "edges")
    return forest.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        forest.select(F.col("b"), F.col("b")).distinct()
    )


def stars(forest: DataFrame) -> bool:
    """Whether each node of the different pairs (a, b), a > b, hangs on one that hangs on none."""
    ends = forest.select(F.col("a").alias("node"), F.lit(1).alias("up")).union(
        forest.select("b", F.lit(0))
    )
    times = ends.groupBy("node").agg(F.sum("up").alias("up"), F.min("up").alias("least"))
    return times.filter("up > 1 OR up = 1 AND least = 0").isEmpty()
