"""Benchmark decontamination by Wu-Manber multi-pattern search over words.

The patterns are all windows of ``WINDOW`` consecutive words of each test item
(an item with fewer words is one pattern).  For each pattern length class the
search keeps three tables over blocks of words: how far the block that ends at
the present word lets the window move on (SHIFT), which patterns end with the
block (the suffix buckets), and within a bucket the patterns by their first
block (the prefix).  Only what passes all three is compared word by word, so
an occurrence is always confirmed directly.

The search is one narrow stage over the documents, with no shuffle.  Patterns
go to the tasks in blocks of at most ``BLOCK_WORDS`` item words; a larger test
set makes further passes, of each of which only the hits are kept and put
together by row.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelforge.llm.common import OUT_ROWS, Scratch, sized, without

WINDOW = 13
#: Most words of test items whose windows are sent to the tasks at once.
BLOCK_WORDS = 500_000

#: Bytes that are no part of a word become spaces, A-Z become a-z; bytes from 0x80 on belong to words.
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))


def words(text: str | None) -> list[bytes]:
    """The lower-cased words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of a text."""
    return text.encode("utf-8", "replace").translate(_FOLD).split() if text else []


class WuManber:
    """Searches word lists for the windows of items: each of ``length`` words, or, of shorter items, all.

    A window is kept as its place in its item's words, and blocks that are
    equal are one object, so the tables take about half a kilobyte a word.
    """

    def __init__(self, items: list[tuple[str, list[bytes]]], length: int | None) -> None:
        self.length = length
        self.least = least = length or min(len(w) for _, w in items)
        self.block = block = min(3, least)
        self.most_shift = least - block + 1
        self.shift: dict[tuple[bytes, ...], int] = {}
        self.buckets: dict[tuple[bytes, ...], list[tuple[tuple[bytes, ...], list[bytes], int, list[str]]]] = {}
        same: dict[tuple[bytes, ...], tuple[bytes, ...]] = {}
        for item, w in items:
            last = len(w) - length if length else 0
            keys = [same.setdefault(t, t) for t in (tuple(w[end - block : end]) for end in range(block, last + least + 1))]
            for end, key in enumerate(keys, block):
                self.shift[key] = min(self.shift.get(key, self.most_shift), max(0, least - end))
            for start in range(last + 1):
                bucket = self.buckets.setdefault(keys[start + least - block], [])
                n = length or len(w)
                for _, other, at, of in bucket:
                    if other[at : at + (length or len(other))] == w[start : start + n]:
                        if of[-1] != item:
                            of.append(item)
                        break
                else:
                    bucket.append((keys[start], w, start, [item]))

    def search(self, text: list[bytes], hit: bytearray, items: set[str]) -> None:
        """Mark the words of every occurrence in ``hit`` and add the items they come from."""
        least, block, most, shift = self.least, self.block, self.most_shift, self.shift.get
        at, n = least, len(text)
        while at <= n:
            suffix = tuple(text[at - block : at])
            step = shift(suffix, most)
            if step:
                at += step
                continue
            start = at - least
            first = tuple(text[start : start + block])
            for prefix, w, place, of in self.buckets[suffix]:
                if prefix == first:
                    size = self.length or len(w)
                    if text[start : start + size] == w[place : place + size]:
                        hit[start : start + size] = b"\1" * size
                        items.update(of)
            at += 1


#: The tables of the last block a worker searched for, by the block's name.
_tables: dict[str, list[WuManber]] = {}


def _searchers(name: str, items: list[tuple[str, list[bytes]]]) -> list[WuManber]:
    if name not in _tables:
        _tables.clear()
        parts = [([x for x in items if len(x[1]) >= WINDOW], WINDOW), ([x for x in items if len(x[1]) < WINDOW], None)]
        _tables[name] = [WuManber(x, length) for x, length in parts if x]
    return _tables[name]


def _blocks(benchmark: DataFrame, item: str, text: str) -> Iterator[list[tuple[str, list[bytes]]]]:
    out, size = [], 0
    for row in benchmark.select(benchmark[item].cast("string"), benchmark[text]).toLocalIterator():
        if row[0] is not None and (w := words(row[1])):
            out.append((row[0], w))
            size += len(w)
            if size >= BLOCK_WORDS:
                yield out
                out, size = [], 0
    if out:
        yield out


def find(df: DataFrame, benchmark: DataFrame, text: str = "text", keep: list[str] | None = None, item: str = "item_id", item_text: str = "text") -> DataFrame:
    """``keep`` columns with ``n_words`` long, ``n_hit`` long (words inside any occurrence) and ``items`` array of item ids as strings, sorted.

    Null and empty texts have no words and no hits; items without words or
    with a null id have no windows; equal item ids count as one item.  Rows
    are kept as they are, repeated ones too.  Other columns of both tables
    are ignored, and one of ``keep`` that is named like a result gives way to
    it.
    """
    keep = without(["doc_id"] if keep is None else keep, "n_words", "n_hit", "items")
    columns = list(dict.fromkeys([*keep, text]))
    rows, n, at_text = df.select(*columns), len(keep), columns.index(text)
    kinds = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields][:n]
    blocks = _blocks(benchmark, item, item_text)
    first, following = next(blocks, []), next(blocks, None)
    if following is None:
        return rows.mapInArrow(_whole(first, at_text, keep), ", ".join([*kinds, "n_words long, n_hit long, items array<string>"]))
    # of the further blocks only the hits are carried, under a number that each row gets once
    scratch = Scratch(df.sparkSession, "contamination")
    numbered = scratch.write(rows.withColumn("__row", F.monotonically_increasing_id()), "rows").select("__row", F.col(f"`{text}`").alias("__text"), *[f"`{c}`" for c in keep])
    hits = [scratch.write(numbered.select("__row", "__text").mapInArrow(_hits(first), "__row long, hit binary, items array<string>"), "hits0")]
    while following is not None:
        hits.append(scratch.write(numbered.select("__row", "__text").mapInArrow(_hits(following), "__row long, hit binary, items array<string>"), f"hits{len(hits)}"))
        following = next(blocks, None)
    every = reduce(DataFrame.unionByName, hits).groupBy("__row").agg(F.collect_list("hit").alias("hits"), F.collect_list("items").alias("items"))
    merged = scratch.write(every.mapInArrow(_merged, "__row long, n_hit long, items array<string>"), "merged")
    scratch.clear(*[f"hits{k}" for k in range(len(hits))])
    counted = numbered.select("__row", "__text", *[f"`{c}`" for c in keep]).mapInArrow(_counted(keep), ", ".join(["__row long", *kinds, "n_words long"]))
    out = counted.join(sized(merged), "__row", "left")
    return out.select(*[f"`{c}`" for c in keep], "n_words", F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"), F.coalesce("items", F.array().cast("array<string>")).alias("items"))


def _parts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, OUT_ROWS):
            yield batch.slice(at, OUT_ROWS)


def _look(searchers: list[WuManber], texts: pa.Array) -> tuple[list[int], list[bytearray], list[list[str]]]:
    """For each text the number of its words, which of them are hit, and the items found."""
    counts, hits, found = [], [], []
    for x in texts:
        w = words(x.as_py())
        hit, of = bytearray(len(w)), set()
        for s in searchers:
            s.search(w, hit, of)
        counts.append(len(w))
        hits.append(hit)
        found.append(sorted(of))
    return counts, hits, found


def _whole(items: list[tuple[str, list[bytes]]], at_text: int, keep: list[str]):
    name, n = uuid.uuid4().hex, len(keep)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _parts(batches):
            counts, hits, found = _look(_searchers(name, items), part.column(at_text))
            out = [pa.array(counts, pa.int64()), pa.array([h.count(1) for h in hits], pa.int64()), pa.array(found, pa.list_(pa.string()))]
            yield pa.RecordBatch.from_arrays([*part.columns[:n], *out], [*keep, "n_words", "n_hit", "items"])

    return run


def _hits(items: list[tuple[str, list[bytes]]]):
    name = uuid.uuid4().hex

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _parts(batches):
            _, hits, found = _look(_searchers(name, items), part.column(1))
            some = [k for k, x in enumerate(found) if x]
            out = [part.column(0).take(pa.array(some, pa.int64())), pa.array([bytes(hits[k]) for k in some], pa.binary()), pa.array([found[k] for k in some], pa.list_(pa.string()))]
            yield pa.RecordBatch.from_arrays(out, ["__row", "hit", "items"])

    return run


def _merged(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        n_hit = [sum(map(any, zip(*x, strict=True))) for x in batch.column(1).to_pylist()]
        items = [sorted(set().union(*x)) for x in batch.column(2).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n_hit, pa.int64()), pa.array(items, pa.list_(pa.string()))], ["__row", "n_hit", "items"])


def _counted(keep: list[str]):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _parts(batches):
            n = pa.array([len(words(x.as_py())) for x in part.column(1)], pa.int64())
            yield pa.RecordBatch.from_arrays([part.column(0), *part.columns[2:], n], ["__row", *keep, "n_words"])

    return run
