"""Records of delimited text whose quoted fields hold line breaks, from files that are read in splits.

Whether a line begins inside quotes depends on all lines before it.  But a
line only turns one of two states into one of two, and so does a split as a
whole.  So the splits' turns are found in one pass, followed up file by file
over a row a split, and a second pass joins lines from states that it knows.
Only records that a boundary of splits cuts are put together by a shuffle.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from panelforge.storage import materialise

#: With more splits than this their states meet the lines by a shuffle and not by a broadcast.
BROADCAST_SPLITS = 200_000

_SPLIT = ["file", "block", "length"]
_SPLIT_TYPES = "file string, block long, length long"


def open_pattern(sep: str) -> str:
    """A pattern of lines whose last field begins with a quote that the line does not close.

    A quote opens a field at its beginning only, and two are one in it.
    """
    s = re.escape(sep)
    unquoted = f'(?:[^"{s}][^{s}]*)?'
    inner = '(?:[^"]|"")*'
    return f'^(?:(?:"{inner}"{unquoted}|{unquoted}){s})*"{inner}$'


def turns_of(lines: pa.Array, pattern: str) -> tuple[np.ndarray, np.ndarray]:
    """Of each line, whether it ends inside quotes if it begins outside of them, and if it begins inside."""
    after_out = pc.match_substring_regex(lines, pattern)
    after_in = pc.match_substring_regex(pc.binary_join_element_wise('"', lines, ""), pattern)
    return after_out.to_numpy(zero_copy_only=False), after_in.to_numpy(zero_copy_only=False)


def _parts(batch: pa.RecordBatch) -> Iterator[tuple[tuple, int, int]]:
    """The splits of a batch: their names, and where their rows begin and end."""
    n, columns = batch.num_rows, [batch.column(k) for k in range(len(_SPLIT))]
    new = np.zeros(max(n - 1, 0), bool)
    for c in columns:
        new |= pc.not_equal(c.slice(1), c.slice(0, max(n - 1, 0))).to_numpy(zero_copy_only=False)
    bounds = [0, *(np.flatnonzero(new) + 1).tolist(), n] if n else []
    for a, b in zip(bounds, bounds[1:]):  # noqa: B905  one less
        yield tuple(c[a].as_py() for c in columns), a, b


class Joiner:
    """Lines in their order to records, a batch at a time; ``inside`` says that the first line continues a record."""

    def __init__(self, inside: bool = False) -> None:
        self.inside, self.head, self.pieces = inside, inside, []

    def feed(self, lines: pa.Array, turns: tuple[np.ndarray, np.ndarray]) -> tuple[pa.Array, list[str], list[str]]:
        """Records of one line, records of several, and ends of records that began before the first line of all."""
        n, at = len(lines), 0
        opening, closing = np.flatnonzero(turns[0]), np.flatnonzero(~turns[1])
        alone, joined, ends = np.ones(n, bool), [], []
        while True:
            begin = at
            if not self.inside:
                k = np.searchsorted(opening, at)
                if k == len(opening):
                    break
                begin, at, self.inside = int(opening[k]), int(opening[k]) + 1, True
            k = np.searchsorted(closing, at)
            at = int(closing[k]) + 1 if k < len(closing) else n
            alone[begin:at] = False
            self.pieces += lines.slice(begin, at - begin).to_pylist()
            if k == len(closing):
                break
            (ends if self.head else joined).append("\n".join(self.pieces))
            self.inside, self.head, self.pieces = False, False, []
        return lines.filter(pa.array(alone)), joined, ends

    def rest(self) -> str | None:
        """What is left of a record that no line has closed."""
        return "\n".join(self.pieces) if self.inside and self.pieces else None


def _turns(sep: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A row a split: the states that it ends in if it begins outside of quotes, and if inside."""
    pattern = open_pattern(sep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, ends = None, (False, True)

        def made() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([x]) for x in (*split, *ends)], [*_SPLIT, "after_out", "after_in"])

        for batch in batches:
            turns = turns_of(batch.column("line"), pattern)
            for name, a, b in _parts(batch):
                if name != split:
                    if split is not None:
                        yield made()
                    split, ends = name, (False, True)
                out, inside = turns[0][a:b], turns[1][a:b]
                fixed = np.flatnonzero(out == inside)  # such a line's end does not depend on its beginning
                last = int(fixed[-1]) if len(fixed) else -1
                swap = bool((out & ~inside)[last + 1 :].sum() % 2)
                ends = (bool(out[last]) ^ swap,) * 2 if last >= 0 else tuple(e ^ swap for e in ends)
        if split is not None:
            yield made()

    return run


def _pieces(sep: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Records, and of those that are cut by a boundary the parts: ``begun`` before the split, ``open`` at its end."""
    pattern = open_pattern(sep)

    def made(split: tuple, texts: pa.Array, begun: bool = False, left: bool = False) -> pa.RecordBatch:
        n = len(texts)
        columns = [pa.repeat(pa.scalar(x, kind), n) for x, kind in zip((*split, begun, left), (pa.string(), pa.int64(), pa.int64(), pa.bool_(), pa.bool_()), strict=True)]
        return pa.RecordBatch.from_arrays([*columns, texts.cast(pa.string())], [*_SPLIT, "begun", "open", "line"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, lines = None, Joiner()

        def rest() -> Iterator[pa.RecordBatch]:
            if (text := lines.rest()) is not None:
                yield made(split, pa.array([text]), lines.head, True)

        for batch in batches:
            turns = turns_of(batch.column("line"), pattern)
            for name, a, b in _parts(batch):
                if name != split:
                    yield from rest()
                    starts = batch.column("starts")[a].as_py()
                    if starts is None:
                        raise RuntimeError(f"splits have changed between two passes over {name[0]}; read it again")
                    split, lines = name, Joiner(starts)
                alone, joined, ends = lines.feed(batch.column("line").slice(a, b - a), (turns[0][a:b], turns[1][a:b]))
                yield made(split, alone)
                if joined:
                    yield made(split, pa.array(joined))
                if ends:
                    yield made(split, pa.array(ends), begun=True)
        yield from rest()

    return run


def _states(turns: DataFrame) -> DataFrame:
    """A row a split: whether it ``starts`` and ``ends`` inside quotes, if a file starts outside of them."""
    before = Window.partitionBy("file").orderBy("block")
    so_far = before.rowsBetween(Window.unboundedPreceding, Window.currentRow)

    # the state is that of the last split whose end is fixed, changed by each swapping split since
    fixed, n = F.col("after_out") == F.col("after_in"), F.sum((F.col("after_out") & ~F.col("after_in")).cast("int")).over(so_far)
    rows = turns.withColumn("n", n).withColumn("known", F.last(F.when(fixed, F.col("after_out").cast("int") + F.col("n")), ignorenulls=True).over(so_far))
    rows = rows.withColumn("ends", (F.coalesce("known", F.lit(0)) + F.col("n")) % 2 == 1)
    return rows.select(*_SPLIT, F.lag("ends", 1, False).over(before).alias("starts"), "ends")


def _with_states(lines: DataFrame, states: DataFrame, few: bool) -> DataFrame:
    """Each split's lines in their order, with its states; null where a split is unknown."""
    if few:
        return lines.join(F.broadcast(states), _SPLIT, "left")
    return lines.join(states, _SPLIT, "left").repartition(*_SPLIT).sortWithinPartitions(*_SPLIT, "id")


def read_records(spark: SparkSession, path: str | list[str], sep: str = ";", encoding: str = "ISO-8859-1") -> DataFrame:
    """``file`` and ``line`` of the records of text files, line breaks in quoted fields kept; empty lines are left out.

    Files are split like any text and read twice, and once more in those
    splits whose boundaries cut a record, if there are any.  The first pass
    runs at once.  A field whose quote is never closed goes on to the end of
    its file.  The encoding has to have line feeds, quotes and ``sep`` as ASCII has.
    """
    text = F.col("value") if encoding.upper() in ("UTF-8", "UTF8") else F.decode(F.col("value").cast("binary"), encoding)
    named = [F.col(f"_metadata.{c}").alias(n) for c, n in (("file_path", "file"), ("file_block_start", "block"), ("file_block_length", "length"))]
    lines = spark.read.option("lineSep", "\n").text(path).select(*named, text.alias("line"), F.monotonically_increasing_id().alias("id"))
    turns = lines.select(*_SPLIT, "line").mapInArrow(_turns(sep), f"{_SPLIT_TYPES}, after_out boolean, after_in boolean")
    states = materialise(_states(turns), "splits")
    n, n_cut = states.agg(F.count("*"), F.count_if("ends")).first()

    rows, types = _with_states(lines, states, n <= BROADCAST_SPLITS), f"{_SPLIT_TYPES}, begun boolean, open boolean, line string"
    needed = [*_SPLIT, "line", "starts"]
    whole = rows.select(*needed).mapInArrow(_pieces(sep), types).where(~F.col("begun") & ~F.col("open")).select("file", "line")
    if n_cut:
        cut = rows.where(F.col("starts").isNull() | F.col("starts") | F.col("ends")).select(*needed)
        parts = cut.mapInArrow(_pieces(sep), types).where(F.col("begun") | F.col("open"))
        order = Window.partitionBy("file").orderBy("block", ~F.col("begun"))
        parts = parts.withColumn("record", F.count_if(~F.col("begun")).over(order))
        texts = F.array_sort(F.collect_list(F.struct("block", (~F.col("begun")).alias("after"), "line")))
        whole = whole.unionByName(parts.groupBy("file", "record").agg(F.array_join(F.transform(texts, lambda x: x["line"]), "\n").alias("line")).select("file", "line"))
    line = F.col("line")
    return whole.withColumn("line", F.when(F.endswith(line, F.lit("\r")), F.substring(line, 1, F.length(line) - 1)).otherwise(line)).where(F.col("line") != "")
