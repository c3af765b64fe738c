"""Connected components of links between document ids, on DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import remove_written, written


def components(links: DataFrame, rounds: int = 50) -> DataFrame:
    """node, root (the least node of its component) for every node of links (a, b).

    Alternating large-star and small-star steps: each hooks the neighbours of a node to its least neighbour. A node of
    very many links is only aggregated (with partial sums) and joined, never gathered. Each round is written to the
    shared folder, so a lost executor costs one round. No links give no rows.
    """
    edges = written(links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    mark = _mark(edges)
    for _ in range(rounds):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("n"), F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, F.col("u") == F.col("n")).select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        down = large.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("n"), "m")
        hooked = large.join(down, F.col("u") == F.col("n")).where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        new = written(hooked.unionByName(down.select(F.col("n").alias("u"), F.col("m").alias("v"))).distinct(), "edges")
        after = _mark(new)
        if mark[0]:
            remove_written(edges)
        edges = new
        if after == mark:
            break
        mark = after
    else:
        raise RuntimeError("components did not settle")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("root"))).groupBy("node").agg(F.min("root").alias("root"))


def _mark(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
    return row["n"], row["h"]
