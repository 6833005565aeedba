"""Secret scans over an incremental blob ledger.

Every version of a text is content-addressed by its SHA-256.  A pair of blob
and rule version is scanned once: what the ledger has already is left out
before any expression is tried, what is new is scanned and entered, with or
without findings, and findings are joined back to every path (row) that holds
the blob.  Thousands of copies cost one scan, and a later run over the same
versions costs their hashes only.

A native prefilter, made of what every match of a rule contains, says which of
the new blobs any rule can match at all.  Only those texts are shuffled to be
made unique (with a map-side combine, so a blob with a third of all rows
leaves each task once); of the others only the hash is.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelforge.llm.common import OUT_ROWS, sized, without, written

#: (kind, pattern, flags, group whose length counts, its least length, what every match contains).  A match that is too short is dropped.
RULES = [
    ("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A, 2, 12, r"(?i:passw|secret|token|api_?key)"),
    ("access", r"AKIA[A-Z0-9]+", 0, 0, 18, r"AKIA"),
    ("hex", r"[0-9a-f]+", 0, 0, 16, r"[0-9a-f]{16}"),
    ("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", 0, 0, 1, r"-----BEGIN "),
]
#: The native prefilter.
PREFILTER = "|".join(holds for *_, holds in RULES)
#: Most blob hashes that are broadcast.
BROADCAST_BLOBS = 100_000
#: To be raised with every change of the rules.
RULE_VERSION = "1"

LEDGER = "blob string, rule_version string, spans array<struct<kind:string,start:int,stop:int>>"


def scan_text(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, stop) in code points by start, then by the order of ``RULES``; per kind leftmost and without overlap."""
    found = []
    for rank, (_, pattern, flags, group, least, _) in enumerate(RULES):
        for m in re.finditer(pattern, text, flags):
            if m.end(group) - m.start(group) >= least:
                found.append((m.start(), rank, m.end()))
    return [(RULES[rank][0], start, stop) for start, rank, stop in sorted(found)]


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("stop", pa.int32())]))
    for batch in batches:
        for at in range(0, batch.num_rows, OUT_ROWS):
            part = batch.slice(at, OUT_ROWS)
            spans = [[{"kind": k, "start": a, "stop": b} for k, a, b in scan_text(x.as_py() or "")] for x in part.column(1)]
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array([RULE_VERSION] * part.num_rows, pa.string()), pa.array(spans, kind)], ["blob", "rule_version", "spans"])


def _whole(versions: DataFrame, text: str) -> Column:
    return F.coalesce(versions[text], F.lit(""))


def _suspects(blobs: DataFrame) -> DataFrame:
    """The text of a blob that no rule can match is not needed."""
    return blobs.select("blob", F.when(F.col("text").rlike(PREFILTER), F.col("text")).alias("text"))


def unseen(versions: DataFrame, ledger: DataFrame | None, text: str = "text") -> DataFrame:
    """Ledger rows of the blobs in ``versions`` that the ledger lacks under the present rules: the only ones that are scanned."""
    whole = _whole(versions, text)
    blobs = versions.select(F.sha2(whole, 256).alias("blob"), whole.alias("text"))
    done = None if ledger is None else ledger.where(F.col("rule_version") == RULE_VERSION).select("blob")
    if done is None:
        blobs = _suspects(blobs)
    elif done.count() <= BROADCAST_BLOBS:
        blobs = _suspects(blobs.join(F.broadcast(done), "blob", "left_anti"))
    else:
        # hashes alone tell what is new
        new = written(blobs.select("blob").distinct().join(done, "blob", "left_anti"), "secret-new")
        if new.count() <= BROADCAST_BLOBS:
            blobs = _suspects(blobs.join(F.broadcast(new), "blob", "left_semi"))
        else:
            # of a table that is shuffled only suspect texts are moved
            blobs = _suspects(blobs).join(new, "blob", "left_semi")
    return blobs.groupBy("blob").agg(F.min("text").alias("text")).mapInArrow(_scan, LEDGER)


def findings(versions: DataFrame, ledger: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns with ``blob`` and ``spans`` for every row of ``versions``, from a ledger that has all of its blobs."""
    keep = without(["doc_id"] if keep is None else keep, "blob", "spans")
    known = ledger.where((F.col("rule_version") == RULE_VERSION) & (F.size("spans") > 0)).select("blob", "spans").dropDuplicates(["blob"])
    paths = versions.select(*keep, F.sha2(_whole(versions, text), 256).alias("blob"))
    empty = F.array().cast("array<struct<kind:string,start:int,stop:int>>")
    # a blob that very many paths hold stays where they are
    return paths.join(sized(known, BROADCAST_BLOBS), "blob", "left").select(*keep, "blob", F.coalesce("spans", empty).alias("spans"))


def scan(versions: DataFrame, ledger: DataFrame | None = None, text: str = "text", keep: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """(findings, ledger): ``keep`` columns with ``blob`` and ``spans`` for every row, and the ledger with this scan's blobs added.

    ``ledger`` has the columns of ``LEDGER`` (None: nothing was scanned yet);
    rows of other rule versions stay in it and count for nothing.  A null text
    is an empty one.  ``spans`` is an empty array where nothing was found.
    Repeated rows stay repeated; other columns of ``versions`` are ignored,
    and one of ``keep`` that is named like a result gives way to it.
    """
    fresh = written(unseen(versions, ledger, text), "secret-ledger")
    after = fresh if ledger is None else ledger.select("blob", "rule_version", "spans").unionByName(fresh)
    return findings(versions, after, text, keep), after


class Ledger:
    """A ledger kept as a table at ``path``, which every scan adds its new blobs to and no scan rewrites.

    A scan that breaks off adds nothing, as Spark commits an append as a whole.
    """

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path
        spark.createDataFrame([], LEDGER).write.mode("append").parquet(path)

    def read(self) -> DataFrame:
        return self.spark.read.schema(LEDGER).parquet(self.path)

    def scan(self, versions: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
        """Enter the blobs of ``versions`` that are new and give the findings of all its rows, as :func:`scan` does."""
        unseen(versions, self.read(), text).write.mode("append").parquet(self.path)
        return findings(versions, self.read(), text, keep)
