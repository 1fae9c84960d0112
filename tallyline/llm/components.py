"""Connected components of a link table by alternating large-star and small-star rounds.

Each round is two aggregations and two joins; hubs fold map-side and their
join partitions may be split, so no task gathers a component.  The links of a
round are written to the shared folder and the driver sees two numbers of them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyline.llm.base import Scratch


def _large_star(links: DataFrame) -> DataFrame:
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
    out = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return out.where("a <> b").distinct()


def _small_star(links: DataFrame) -> DataFrame:
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b"))).distinct()


def _mark(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).head())


def stars(links: DataFrame, scratch: Scratch) -> DataFrame:
    """(``node``, ``root``) for every node of ``links`` (``a``, ``b``, both long), roots included.

    The root is the least node of its component.  Links in any direction,
    repeated ones and a node linked to itself are allowed; no links give no rows.
    """
    now = scratch.write(links.select("a", "b").where("a <> b").distinct(), "links")
    before, mark = None, _mark(now)
    while mark[0] and mark != before:
        now = scratch.write(_small_star(_large_star(now)), "links")
        before, mark = mark, _mark(now)
    ends = now.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return ends.unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
