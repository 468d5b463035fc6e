"""Connected components of an edge table, by alternating star contractions.

Every round is written to the shared folder; nothing but two numbers per round reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlark.session import delete_scratch, noted_scratch, written


def star_round(edges: DataFrame) -> DataFrame:
    """One large and one small star over edges (a, b) with a above b: neighbours move to smaller ones."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
    least = large.groupBy("a").agg(F.min("b").alias("m"))
    moved = large.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b"))).distinct()


def components(edges: DataFrame, label: str) -> DataFrame:
    """(id, component) of every id in undirected (a, b) edges; the component is its smallest id.

    Loops and repeated edges do not matter; no edges give no rows. The result is a written table; those
    of the rounds are deleted.
    """
    spark = edges.sparkSession
    state = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    with noted_scratch() as rounds:
        state = written(state, label)
        before = None
        while True:
            mark = state.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
            if mark == before or mark[0] == 0:
                break
            before = mark
            state = written(star_round(state), label)
            delete_scratch(spark, rounds[:-1])
            del rounds[:-1]
    roots = state.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct()
    found = state.select(F.col("a").alias("id"), F.col("b").alias("component")).unionByName(roots)
    found = written(found, f"{label}-found")
    delete_scratch(spark, rounds)
    return found
