"""Comparison of two tables by a tree of digests: only branches whose digests differ are read.

A table is written by bucket of its keys, with the digests of all its leaves
beside it.  A digest adds up two hashes of each row, so that it does not depend
on order or on how the table is dealt.  Digests of inner nodes are sums of
those below; comparing two trees reads digests, whose number is fixed, and then
the rows of the unequal leaves.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Branches of the tree and leaves of each; an unequal branch is a folder that is read, an unequal leaf what is left of it.
BRANCHES, LEAVES = 64, 64
_DIGEST = ["n", "sum_a", "sum_b"]


@dataclass
class HashTree:
    """A table and its digests under ``path``."""

    spark: SparkSession
    path: str
    keys: list[str]

    @classmethod
    def write(cls, rows: DataFrame, path: str, keys: list[str], columns: list[str]) -> HashTree:
        """Write ``keys`` and ``columns``, in folders of branches and sorted by leaf; each branch is written by one task or more."""
        h = F.xxhash64(*keys)
        row = F.struct(*keys, *columns)
        placed = rows.select(*keys, *columns, F.pmod(h, F.lit(BRANCHES)).cast("int").alias("branch"), F.pmod(F.shiftright(h, 8), F.lit(LEAVES)).cast("int").alias("leaf"))
        placed.repartition("branch", "leaf").sortWithinPartitions("branch", "leaf", *keys).write.mode("overwrite").partitionBy("branch").parquet(f"{path}/rows")
        tree = cls(rows.sparkSession, path, keys)
        second = F.conv(F.substring(F.md5(F.to_json(row, {"ignoreNullFields": "false"})), 1, 15), 16, 10)
        digests = tree.rows().groupBy("branch", "leaf").agg(F.count("*").alias("n"), F.sum(F.xxhash64(row).cast("decimal(38,0)")).alias("sum_a"), F.sum(second.cast("decimal(38,0)")).alias("sum_b"))
        digests.coalesce(1).write.mode("overwrite").parquet(f"{path}/digests")
        return tree

    def rows(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/rows")

    def digests(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/digests")

    def root(self) -> tuple:
        """The digest of the whole table."""
        return tuple(self.digests().agg(*[F.sum(c) for c in _DIGEST]).first())


def _unequal(a: DataFrame, b: DataFrame, by: list[str]) -> DataFrame:
    sums = [x.groupBy(*by).agg(*[F.sum(c).alias(c) for c in _DIGEST]).select(*by, F.struct(*_DIGEST).alias(side)) for x, side in ((a, "a"), (b, "b"))]
    return sums[0].join(sums[1], by, "full_outer").where(~F.col("a").eqNullSafe(F.col("b"))).select(*by)


def unequal_leaves(a: HashTree, b: HashTree) -> list[tuple[int, int]]:
    """(branch, leaf) of the leaves whose digests differ: branches first, then the leaves of the unequal ones; at most ``BRANCHES`` * ``LEAVES``."""
    branches = [r[0] for r in _unequal(a.digests(), b.digests(), ["branch"]).collect()]
    if not branches:
        return []
    among = F.col("branch").isin(branches)
    return sorted((r[0], r[1]) for r in _unequal(a.digests().where(among), b.digests().where(among), ["branch", "leaf"]).collect())


def opened(a: HashTree, b: HashTree) -> tuple[DataFrame, DataFrame]:
    """The rows of both tables in the leaves that differ; of all other leaves nothing is read.

    All keys that only one has, or that differ in a column, are in them, so
    that any comparison by key gives the same of these as of the whole tables.
    """
    leaves = unequal_leaves(a, b)
    chosen = F.broadcast(a.spark.createDataFrame(leaves, "branch int, leaf int"))
    branches = F.col("branch").isin(sorted({x for x, _ in leaves}))
    return tuple(t.rows().where(branches).join(chosen, ["branch", "leaf"], "left_semi").drop("branch", "leaf") for t in (a, b))
