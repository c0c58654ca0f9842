"""Connected groups of a link table, as joins and partial aggregates only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from surveyprep.llm.common import Scratch


def components(links: DataFrame, scratch: Scratch, name: str = "cc", keep: str = "keep") -> DataFrame:
    """(v, root) for every node of ``links(a, b)``: root is the group's smallest node.

    Alternating star contraction: each round every node links its larger
    neighbours to its smallest neighbour, then its smaller ones likewise,
    until the links are stars. A hub's links are reduced by map-side minima
    and joined back by a join that Spark may split, so no task gathers a hub.
    Each round is written to the shared folder; rounds grow with the logarithm
    of the longest chain. No links give an empty table.
    """
    kind = links.schema["a"].dataType
    edges = scratch.cut(
        links.where("a is not null and b is not null and a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), f"{name}-0")
    made, last = [f"{name}-0"], None
    for step in range(1, 200):
        # large star: every node points its larger neighbours at its smallest neighbour (or itself)
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m")).withColumnRenamed("a", "n")
        large = both.where("b > a").join(low, F.col("a") == F.col("n")).select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a <> b").distinct()
        # small star: every node points its smaller neighbours and itself at the smallest of them
        small_low = large.groupBy("a").agg(F.min("b").alias("m")).withColumnRenamed("a", "n")
        small = large.join(small_low, F.col("a") == F.col("n")).select(
            F.explode(F.array(F.struct(F.col("a"), F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e")).select("e.*")
        edges = scratch.cut(small.where("a <> b").distinct(), f"{name}-{step}")
        made.append(f"{name}-{step}")
        stats = edges.agg(F.count("*").alias("n"), F.sum(F.hash("a", "b").cast("long")).alias("h"),
                          F.sum(F.xxhash64("b", "a").bitwiseAND(F.lit(0xFFFFFFFF))).alias("x")).first()
        if tuple(stats) == last:
            break
        last = tuple(stats)
    else:
        raise RuntimeError("the groups were not connected in 199 rounds")
    scratch.drop(*made[:-1])
    stars = edges.select(F.col("a").cast(kind).alias("v"), F.col("b").cast(kind).alias("root"))
    return stars.union(stars.select(F.col("root").alias("v"), "root").distinct())
