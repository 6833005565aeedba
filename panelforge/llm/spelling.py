"""Spelling variants: words that one inserted, deleted or replaced letter makes of each other, and the form that each most likely is of.

1.  *Two dictionaries.*  Of two words that are one edit apart, let m be the
    length of the shorter one.  Their first m // 2 letters are the same, or
    their last.  So each word is entered in a forward dictionary by its first
    half and in a reversed one by its last half, for both values of m that its
    length allows: its own, and one less.
2.  *Range scans.*  The entries are dealt over sorted ranges; a task reads its
    range and meets each block of entries with the same half in a row.
3.  *Subdividing.*  What two words of a block do not yet share is again one
    edit apart, so that a half of it is intact.  Blocks with more than
    ``LIMIT`` entries are not compared but entered again by both halves of
    the rest; so is the first and last block of a range, which may go on in
    another one.  A range may therefore end within a block, and a prefix of
    which very many words begin meets in no single task.  Once one letter is
    left, a block has no more entries than the alphabet allows, and is kept
    together.
4.  *Verification.*  Pairs of a block are compared letter by letter.  A pair
    that shares both halves is taken in the forward block only: a block knows
    between which lengths the common beginning of its pairs must be.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelforge.llm.common import Scratch

#: Letters of a word, in the syntax of Java's patterns: those of Latin-1.
LETTERS = r"A-Za-zÀ-ÿ"
LEAST_LENGTH, LEAST_COUNT = 5, 3
#: A word is taken for a variant of a near one that is at least so many times as frequent.
TIMES = 2
#: Entries of a block that are compared with one another; more are subdivided.
LIMIT = 48
#: Letters that are compared at a time.
CELLS = 1 << 20
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_SCANNED = "word string, n long, near string, near_n long, m int, longer boolean, path string, a int, b int, below int"


def misspelt(word: Column, number: Column, one_in: int) -> Column:
    """``word`` without its code point at ``number`` % length where ``one_in`` divides ``number``, else as it is."""
    at = (number % F.char_length(word)).cast("int")
    return F.when(number % one_in == 0, F.concat(word.substr(F.lit(1), at), word.substr(at + 2, F.char_length(word)))).otherwise(word)


def count_words(df: DataFrame, key: str = "doc_id", text: str = "text", letters: str = LETTERS, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT, one_in: int | None = None) -> DataFrame:
    """``word`` and ``n`` long: the maximal runs of ``letters`` in all texts, A-Z in lower case, of at least so many letters and so frequent.

    With ``one_in``, one in so many runs, by the CRC-32 of the key (null:
    empty), a colon and the run, loses a letter: misspellings that are the
    same however the table is dealt.  Null and empty texts have no words;
    repeated rows count each time.  Other columns are ignored.
    """
    runs = df.select(F.coalesce(F.col(f"`{key}`").cast("string"), F.lit("")).alias("key"), F.explode(F.regexp_extract_all(F.col(f"`{text}`"), F.lit(f"[{letters}]{{{least_length},}}"), F.lit(0))).alias("run"))
    word = F.translate("run", _UPPER, _UPPER.lower())
    if one_in:
        runs = runs.select("key", word.alias("run"))
        word = misspelt(F.col("run"), F.crc32(F.concat("key", F.lit(":"), "run")), one_in)
    counted = runs.select(word.alias("word")).where(F.char_length("word") >= least_length).groupBy("word").agg(F.count("*").alias("n"))
    return counted.where(F.col("n") >= least_count)


def _halves(entries: DataFrame) -> DataFrame:
    """Each entry twice: by the first and by the last half of what its block does not share yet."""
    half = F.expr("(m - a - b) div 2").cast("int")
    forward = F.struct(F.concat("path", F.lit("P")).alias("path"), (F.col("a") + half).alias("a"), F.col("b").alias("b"), F.col("below").alias("below"))
    reverse = F.struct(F.concat("path", F.lit("S")).alias("path"), F.col("a").alias("a"), (F.col("b") + half).alias("b"), (F.col("a") + half).alias("below"))
    out = entries.select("word", "n", "m", "longer", F.explode(F.array(forward, reverse)).alias("x")).select("word", "n", "m", "longer", "x.*")
    out = out.withColumn("part", F.expr("concat(substring(word, 1, a), right(word, b))"))
    # entries of a block that is kept together have the same place in the order
    out = out.withColumn("place", F.when(F.expr("m - a - b > 1"), F.col("word")).otherwise(""))
    return out.repartitionByRange("m", "path", "part", "place").sortWithinPartitions("m", "path", "part", "word")


@lru_cache(maxsize=4096)
def _places(short: int, every: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of the pairs of a small block: each short word with all that stand after it."""
    pairs = [(i, j) for i in range(short) for j in range(i + 1, every)]
    return np.array([i for i, _ in pairs], np.int64), np.array([j for _, j in pairs], np.int64)


def near_pairs(m: int, letters: np.ndarray, i: np.ndarray, j: np.ndarray, longer: np.ndarray, low: np.ndarray, below: np.ndarray) -> np.ndarray:
    """Which pairs (rows ``i`` of m letters, rows ``j`` of m or, where ``longer``, m + 1) are one edit apart and share a beginning of ``low`` to ``below`` - 1 letters."""
    x, y = letters[i, :m], letters[j]
    same = x == y[:, :m]
    common = np.logical_and.accumulate(same, axis=1).sum(axis=1)
    ending = np.logical_and.accumulate((x == y[:, 1 : m + 1])[:, ::-1], axis=1).sum(axis=1)
    near = np.where(longer[j], common + ending >= m, same.sum(axis=1) == m - 1)
    return near & (common >= low) & (common < below)


class _Blocks:
    """Small blocks of words of one length, verified together."""

    def __init__(self, limit: int, cells: int) -> None:
        self.limit, self.most_cells = limit, cells
        self.found: list[tuple] = []
        self._clear()

    def _clear(self) -> None:
        self.words, self.counts, self.longer, self.blocks, self.cells, self.m = [], [], [], [], 0, 0

    def add(self, m: int, low: int, below: int, block: list[tuple[str, int, bool]]) -> None:
        block.sort(key=lambda x: x[2])
        short = sum(not x[2] for x in block)
        if not short or len(block) < 2:
            return
        if m != self.m:
            self.verify()
            self.m = m
        self.blocks.append((len(self.words), short, len(block), low, below))
        for word, n, longer in block:
            self.words.append(word)
            self.counts.append(n)
            self.longer.append(longer)
        self.cells += (short * len(block) + len(block)) * (m + 1)
        if self.cells >= self.most_cells:
            self.verify()

    def _slices(self) -> Iterator[tuple[np.ndarray, ...]]:
        """The pairs, in slices of a bounded number of letters."""
        most, parts, size = max(1, self.most_cells // (self.m + 1)), [], 0
        for at, short, every, low, below in self.blocks:
            # a block at its last letter may have very many entries: its rows come one by one
            rows = [_places(short, every)] if every <= self.limit else ((np.full(every - i - 1, i), np.arange(i + 1, every)) for i in range(short))
            for i, j in rows:
                parts.append((i + at, j + at, np.full(len(i), low), np.full(len(i), below)))
                size += len(i)
                if size >= most:
                    yield tuple(map(np.concatenate, zip(*parts, strict=True)))
                    parts, size = [], 0
        if size:
            yield tuple(map(np.concatenate, zip(*parts, strict=True)))

    def verify(self) -> None:
        if self.blocks:
            letters = np.array(self.words, f"U{self.m + 1}").view(np.uint32).reshape(len(self.words), self.m + 1)
            longer = np.array(self.longer)
            for i, j, low, below in self._slices():
                near = near_pairs(self.m, letters, i, j, longer, low, below)
                for x, y in zip(i[near].tolist(), j[near].tolist(), strict=True):
                    self.found.append((self.words[x], self.counts[x], self.words[y], self.counts[y]))
                    self.found.append((self.words[y], self.counts[y], self.words[x], self.counts[x]))
        self._clear()


def _scan(limit: int, cells: int):
    """Near words of the blocks that are small and lie within the range, and the entries of all others to be subdivided."""
    schema = pa.schema([("word", pa.string()), ("n", pa.int64()), ("near", pa.string()), ("near_n", pa.int64()), ("m", pa.int32()), ("longer", pa.bool_()), ("path", pa.string()), ("a", pa.int32()), ("b", pa.int32()), ("below", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        small, left, block, key, whole, first = _Blocks(limit, cells), [], [], None, True, True

        def opened() -> None:
            m, path, _, a, b, below = key
            left.extend((word, n, None, None, m, longer, path, a, b, below) for word, n, longer in block)
            block.clear()

        def closed(at_end: bool) -> None:
            if key is not None and (at_end or not whole) and key[0] - key[3] - key[4] > 1:
                opened()
            elif key is not None:
                small.add(key[0], key[3], key[5], block)

        def made() -> pa.RecordBatch:
            rows = [*left, *((*x, None, None, None, None, None, None) for x in small.found)]
            left.clear()
            small.found.clear()
            return pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*rows, strict=True) if rows else [[]] * len(schema), schema, strict=True)], schema=schema)

        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("m", "path", "part", "a", "b", "below", "word", "n", "longer")]
            for *own, word, n, longer in zip(*columns, strict=True):
                if own != key:
                    closed(first)
                    first = key is None
                    key, whole, block = own, True, []
                block.append((word, n, longer))
                if len(block) > limit and own[0] - own[3] - own[4] > 1:
                    whole = False
                    opened()
            if len(left) + len(small.found) >= 10_000:
                yield made()
        closed(True)
        small.verify()
        yield made()

    return run


def near_words(words: DataFrame, scratch: Scratch, limit: int = LIMIT, cells: int = CELLS) -> DataFrame:
    """All pairs of different ``word``s one edit apart, in both directions, with both counts: ``word``, ``n``, ``near``, ``near_n``."""
    sizes = F.array(F.struct(F.char_length("word").alias("m"), F.lit(False).alias("longer")), F.struct((F.char_length("word") - 1).alias("m"), F.lit(True).alias("longer")))
    entries = words.select("word", "n", F.explode(sizes).alias("x")).select("word", "n", "x.*").where("m >= 0")
    entries = entries.select("*", F.lit("").alias("path"), F.lit(0).alias("a"), F.lit(0).alias("b"), (F.col("m") + 1).alias("below"))
    found, level = [], 0
    while not level or not entries.isEmpty():
        scanned = scratch.write(_halves(entries).mapInArrow(_scan(limit, cells), _SCANNED), f"scan{level}")
        found.append(scanned.where("near IS NOT NULL").select("word", "n", "near", "near_n"))
        entries, level = scanned.where("near IS NULL").drop("near", "near_n"), level + 1
    out = found[0]
    for x in found[1:]:
        out = out.unionByName(x)
    return out


def roots(forms: DataFrame, scratch: Scratch) -> DataFrame:
    """``word`` and ``root``, the last that ``form`` after ``form`` leads to, for words that have a form; the number of steps doubles each round."""
    now, step = scratch.write(forms.select("word", F.col("form").alias("root")), "roots0"), 0
    while True:
        following = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        joined = scratch.write(now.join(following, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), f"roots{step + 1}")
        scratch.clear(f"roots{step}")
        now, step = joined.select("word", "root"), step + 1
        if joined.where("moved").isEmpty():
            return now


def variants(words: DataFrame, times: int = TIMES, limit: int = LIMIT, cells: int = CELLS) -> DataFrame:
    """``word``, ``n``, ``n_near`` long (words one edit away), ``form``, ``form_n`` and ``root`` for a table of ``word`` and ``n``.

    A word's form is its near word with the greatest n (of equal ones the least
    in code-point order), if that n is at least ``times`` its own, else null;
    its root is where following forms ends, the word itself without one.
    Counts of repeated words are added up; null words are left out, and an
    empty word is near to those of one letter.  Other columns are ignored.
    ``limit`` entries of a block are compared with one another, and ``cells``
    letters at a time: the result does not depend on either.
    """
    if times < 2:
        raise ValueError("forms must be more frequent, or following them might not end")
    scratch, scans = Scratch(words.sparkSession, "spelling"), Scratch(words.sparkSession, "spelling-scans")
    words = scratch.write(words.where("word IS NOT NULL").groupBy("word").agg(F.sum("n").cast("long").alias("n")), "words")
    near = near_words(words, scans, limit, cells).groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("form"))).alias("best"))
    near = scratch.write(near.select("word", "n_near", F.col("best.form").alias("form"), (-F.col("best.less")).alias("form_n")), "near")
    scans.drop()
    all_words = words.join(near, "word", "left").withColumn("has", F.coalesce(F.col("form_n") >= times * F.col("n"), F.lit(False)))
    all_words = scratch.write(all_words.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(F.col("has"), F.col("form")).alias("form"), F.when(F.col("has"), F.col("form_n")).alias("form_n")), "all")
    last = roots(all_words.where("form IS NOT NULL"), scratch)
    return all_words.join(last, "word", "left").select("word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root"))
