"""Connected components of a graph of links, by alternating large-star and small-star steps.

Every step is a grouped minimum and an equi-join, both on plain rows; a hub's
neighbours are rows too, never one list.  The edges are written after each
round, so a lost executor repeats one round at most, and only two numbers a
round reach the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelforge.llm.common import Scratch


def _state(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v") % 1_000_003).alias("h")).first()
    return row["n"], row["h"] or 0


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node`` and ``component`` (the least node that links reach) for every node that has a link to another.

    Links may be repeated, in either direction, and from a node to itself;
    those with a null end are left out.  No links give no rows.  Nodes may be
    of any type that has an order.
    """
    scratch, step = Scratch(links.sparkSession, "components"), 0
    edges = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col("u") != F.col("v"))).distinct()
    edges = scratch.write(edges, "small0")
    before = _state(edges)
    while before[0]:
        step += 1
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = scratch.write(large, f"large{step}")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").unionByName(least.select("u", F.col("m").alias("v"))).distinct()
        edges = scratch.write(small, f"small{step}")
        scratch.clear(f"large{step}", f"small{step - 1}")
        now = _state(edges)
        if now == before:
            break
        before = now
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
