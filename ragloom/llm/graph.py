"""Connected components of an edge table, as rounds of grouped minima."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ragloom.llm.common import keep


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """`edges` (long columns a, b) -> (node, component): every node that has an
    edge, with the smallest node of its component. Alternates the large-star
    and small-star steps until the edges are stars; each round is written to
    the shared folder. A node with many edges meets them only in a grouped
    minimum and a join that Spark can split. No edges give no rows."""
    low, high = F.least("a", "b"), F.greatest("a", "b")
    now = keep(edges.where("a <> b").select(high.alias("a"), low.alias("b")).distinct(), "edges")
    before = None
    for _ in range(max_rounds):
        seen = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if before == seen or not seen[0]:
            break
        before = seen
        both = now.union(now.select("b", "a"))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a <> b").distinct()
        small = large.groupBy("a").agg(F.min("b").alias("m"))
        star = (large.join(small, "a")
                .select(F.explode(F.array(F.struct(F.col("b").alias("a"), F.col("m").alias("b")),
                                          F.struct(F.col("a"), F.col("m").alias("b")))).alias("e"))
                .select("e.*").where("a <> b").distinct())
        now = keep(star, "edges")
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        now.select("b", "b").distinct()).distinct()
