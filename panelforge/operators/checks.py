"""Checks of tables against each other and against themselves."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelforge.functions.expr import equal_loosely


def regression_gate(audited: DataFrame, rebuilt: DataFrame, keys: list[str], strict: list[str], lenient: list[str], quarantined: DataFrame, root: str = "cnpj_basico") -> DataFrame:
    """Every difference between two versions of a month, with ``verdict``.

    ``missing`` and ``added`` keys and differences in strict fields are
    failures.  A lenient field may differ only for a quarantined root and
    only by being null in the rebuilt version (``allowed``); else it is
    ``not_null`` or ``forbidden``.  No rows: the versions agree.
    """
    fields = [*strict, *lenient]
    image = F.struct(*fields)
    both = audited.select(*keys, image.alias("a")).join(rebuilt.select(*keys, image.alias("b")), keys, "full_outer")
    roots = quarantined.select(F.col(root)).distinct().withColumn("__q", F.lit(True))
    both = both.join(roots, root, "left")
    held = F.coalesce(F.col("__q"), F.lit(False))

    def cell(c: str) -> Column:
        a, b = F.col(f"a.{c}"), F.col(f"b.{c}")
        verdict = F.lit("failure") if c in strict else F.when(~held, "forbidden").when(b.isNull(), "allowed").otherwise("not_null")
        unlike = ~equal_loosely(a, b) if c in strict else ~a.eqNullSafe(b)
        return F.when(unlike, F.struct(F.lit(c).alias("field"), a.cast("string").alias("audited"), b.cast("string").alias("rebuilt"), verdict.alias("verdict")))

    lone = F.struct(F.lit(None).cast("string").alias("field"), F.lit(None).cast("string").alias("audited"), F.lit(None).cast("string").alias("rebuilt"), F.when(F.col("b").isNull(), "missing").otherwise("added").alias("verdict"))
    cells = F.when(F.col("a").isNull() | F.col("b").isNull(), F.array(lone)).otherwise(F.array_compact(F.array(*[cell(c) for c in fields])))
    return both.select(*keys, F.explode(cells).alias("x")).select(*keys, "x.*")


def gate_passes(differences: DataFrame) -> bool:
    """Whether all differences are allowed ones."""
    return differences.where(F.col("verdict") != "allowed").isEmpty()


def key_differences(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that only one side has, with ``side`` a or b."""
    x, y = a.select(*keys), b.select(*keys)
    return x.exceptAll(y).withColumn("side", F.lit("a")).unionByName(y.exceptAll(x).withColumn("side", F.lit("b")))


def checksum(panel: DataFrame, columns: list[str], month: str = "reference_month", key: list[str] | None = None) -> DataFrame:
    """Per month rows, distinct keys and a digest that doesn't depend on order: MD5 of the sum of row hashes."""
    row = F.md5(F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("~")) for c in columns]))
    number = F.conv(F.substring(row, 1, 12), 16, 10).cast("decimal(38,0)")
    distinct = F.count_distinct(F.struct(*(key or columns)))
    return panel.groupBy(month).agg(F.count("*").alias("n"), distinct.alias("n_keys"), F.md5(F.sum(number).cast("string")).alias("digest"))


def verify(rows: DataFrame, key: str, lengths: dict[str, int] | None = None) -> DataFrame:
    """One row: rows, distinct keys, and for each column of a fixed length how many values have another."""
    bad = [F.count_if(F.length(c) != n).alias(f"bad_{c}") for c, n in (lengths or {}).items()]
    return rows.agg(F.count("*").alias("n"), F.count_distinct(key).alias(f"n_{key}"), *bad)


def require_rows(rows: DataFrame, name: str) -> DataFrame:
    """The same rows; an empty table is an error."""
    if rows.isEmpty():
        raise ValueError(f"{name} has no rows")
    return rows


def describe_counts(rows: DataFrame, key: str) -> DataFrame:
    """Rows per key: keys, mean, median and most."""
    counts = rows.groupBy(key).agg(F.count("*").alias("n"))
    return counts.agg(F.count("*").alias("n_keys"), F.round(F.avg("n").cast("decimal(20,10)"), 2).alias("mean"), F.percentile("n", F.lit(0.5)).alias("median"), F.max("n").alias("most"))
