"""Connected components over links, as joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stocktide.llm.store import kept, release


def components(links: DataFrame, left: str, right: str) -> DataFrame:
    """(id, component) of every id that has a link; the component is the smallest id reachable.

    Alternates large-star and small-star steps: every node points its larger (then its smaller) neighbours at the smallest
    one it knows, until nothing changes. A node's neighbours are never gathered: the smallest is a partial aggregate, the
    pointing a join whose hot keys adaptive execution can split. Each round is written to the shared folder.
    """
    edges = links.select(F.col(left).alias("u"), F.col(right).alias("v")).where("u <> v").select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    edges = kept(edges, "edges")
    before = None
    while True:
        both = edges.union(edges.select("v", "u"))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        # large star: of u's neighbours the larger ones point at u's smallest
        larger = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = larger.where("u <> v").distinct()
        # small star: u and its smaller neighbours point at the smallest of them
        least = edges.groupBy("u").agg(F.min("v").alias("m"))
        smaller = edges.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = kept(smaller.union(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct(), "edges")
        release(edges.sparkSession)
        state = edges.agg(F.count("*"), F.sum("v"), F.sum(F.xxhash64("u", "v").bitwiseAND(F.lit((1 << 40) - 1))),
                          F.count_distinct("u")).first()
        if state == before or state[0] == 0:
            break
        before = state
    pointing = edges.select(F.col("u").alias("id"), F.col("v").alias("component"))
    heads = edges.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
    return pointing.union(heads)
