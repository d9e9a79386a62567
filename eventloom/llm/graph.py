"""Connected components of links between integer ids."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom.llm.common import cut


def _large_star(links: DataFrame) -> DataFrame:
    both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a != b").distinct()


def _small_star(links: DataFrame) -> DataFrame:
    least = links.groupBy("a").agg(F.min("b").alias("m"))
    rest = links.join(least, "a").where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return rest.union(least.select("a", F.col("m").alias("b"))).where("a != b").distinct()


def components(links: DataFrame) -> DataFrame:
    """links(a, b) -> (id, component): for each id in a link the smallest id that it can reach.

    Alternates large-star and small-star steps until each id is linked to its smallest one alone. Each step is an aggregation and an
    equi-join, so no task gathers an id's links, and Spark divides a hot id's. Links of an id to itself and nulls are ignored; no links, no
    rows. A round's result is cut from its lineage, as rounds would otherwise repeat all before them.
    """
    now = cut(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a != b").distinct())
    state = None
    while True:
        signature = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if not signature[0] or state == signature:
            return now.select(F.col("a").alias("id"), F.col("b").alias("component"))
        state = signature
        now = cut(_small_star(_large_star(now)))
