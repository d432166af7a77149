"""Connected components by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvid.llm.common import stored


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``edges(a, b)`` of long node ids -> ``(node, label)``, label = smallest node of the component.

    Every node of some edge between two different nodes is returned.  Each round is two
    joins on a node id and two distincts over at most as many rows as there are
    edges; it is written to the shared checkpoint folder, and only a row count
    and a checksum come to the driver.  Rounds grow with the logarithm of the
    component size.
    """
    e = stored(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
               "edges")
    mark = _mark(e)
    for _ in range(max_rounds):
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = (both.join(low, "a").filter(F.col("b") > F.col("a"))
                 .select(F.col("b").alias("a"), F.col("m").alias("b")).distinct())
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(low, "a").filter(F.col("b") > F.col("m"))
                 .select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .unionByName(low.select("a", F.col("m").alias("b"))).distinct())
        e = stored(small, "edges")
        mark, before = _mark(e), mark
        if mark == before:
            roots = e.select(F.col("b").alias("node")).distinct().select("node", F.col("node").alias("label"))
            return e.select(F.col("a").alias("node"), F.col("b").alias("label")).unionByName(roots)
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")


def _mark(e: DataFrame) -> tuple:
    return tuple(e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
