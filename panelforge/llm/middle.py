"""Fill-in-middle transformation: a text is cut in three at two ranks of its units, and the parts are put in another order.

The units are the isolated matches of a pattern in a ``Split`` pre-tokenizer of
the tokenizers library, which needs no training: it gives the code-point
offsets of all units.  The length of that array is the text's n, two numbers
drawn from the key give two ranks in 0..n, and the offsets at these ranks give
the slices.  Everything drawn depends on the key alone, so that a task that is
run again, or a table dealt otherwise, gives the same output.

A text is split window by window, and of a window only its number of units is
kept; the windows of the two ranks are split once more.  So a worker's memory
does not follow the length of a text beyond the text itself.  Where each code
point is a unit, a window's parts at blanks, which texts repeat all the time,
are split once a worker, and their numbers of units remembered.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from tokenizers import Regex, pre_tokenizers

from panelforge.llm.common import OUT_ROWS, without

#: One code point, line breaks included, in the library's syntax of patterns.
CODE_POINT = r"(?m:.)"
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: Of 100 documents so many are transformed, and of 100 transformed ones so many have their suffix first.
RATE, SPM_RATE = 90, 20
#: Code points that are split at a time; a unit that is longer than a window gets a longer one.
WINDOW = 256
#: Where each code point is a unit: code points whose parts are counted at a time, parts that a worker remembers, and what a part is.
SINGLE_WINDOW, KNOWN = 1 << 16, 200_000
_parts = re.compile("[^ ]{1,40} ?| ").findall
_RESULTS = "n", "form", "prefix_chars", "middle_chars", "output"


@lru_cache(maxsize=8)
def _splitter(pattern: str):
    return pre_tokenizers.Split(Regex(pattern), "isolated").pre_tokenize_str


class _Counts(dict):
    """Numbers of units of parts, each part split when it is first met."""

    def __missing__(self, part: str) -> int:
        if len(self) >= KNOWN:
            self.clear()
        self[part] = n = len(_splitter(CODE_POINT)(part))
        return n


_counts = _Counts()


class Units:
    """The units of a text: ``n``, their number, and :meth:`offset`, the place of each in code points.

    Matches of the pattern and what stands between them are units.  Where a
    unit may be longer than a code point, a window's last one may go on behind
    it, so that the next window begins with it; a pattern must therefore not
    look behind its match, or ahead of it farther than to the end of the next
    unit.
    """

    def __init__(self, text: str, pattern: str = CODE_POINT, window: int | None = None) -> None:
        self.text, self.split, self.single = text, _splitter(pattern), pattern == CODE_POINT
        #: For each window its first code point and the one behind it, and the number of units up to its end.
        self.windows: list[tuple[int, int]] = []
        self.ends: list[int] = []
        self.n = 0
        if self.single:
            size = window or SINGLE_WINDOW
            for start in range(0, len(text), size):
                self._add(start, start + size, sum(map(_counts.__getitem__, _parts(text[start : start + size]))))
        else:
            self._overlapping(window or WINDOW)

    def _add(self, start: int, stop: int, units: int) -> None:
        self.n += units
        self.windows.append((start, stop))
        self.ends.append(self.n)

    def _overlapping(self, window: int) -> None:
        start, size = 0, window
        while start < len(self.text):
            stop = start + size
            spans = self.split(self.text[start:stop])
            if stop >= len(self.text):
                self._add(start, stop, len(spans))
            elif len(spans) > 1:
                self._add(start, stop, len(spans) - 1)
                stop = start + spans[-1][1][0]
            else:
                size *= 2
                continue
            start, size = stop, window

    def offset(self, rank: int) -> int:
        """Code points before the unit ``rank`` (from 0); for ``rank`` = n, those of the text."""
        if rank == 0:
            return 0
        k = bisect_left(self.ends, rank)
        start, stop = self.windows[k]
        part, rank = self.text[start:stop], rank - (self.ends[k - 1] if k else 0)
        if self.single:
            parts = _parts(part)
            ends = list(accumulate(map(_counts.__getitem__, parts)))
            k = bisect_left(ends, rank)
            start, part, rank = start + sum(map(len, parts[:k])), parts[k], rank - (ends[k - 1] if k else 0)
        return start + self.split(part)[rank - 1][1][1]


def draws(key: Column, seed: str) -> list[Column]:
    """Four integers of 32 bits: the first groups of eight hexadecimal digits of the SHA-256 of ``seed``, a colon and the key (null: empty)."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long") for k in range(4)]


def _cut(text: str, first: int, second: int, form: str | None, pattern: str) -> tuple[int, str, int | None, int | None, str]:
    units = Units(text, pattern)
    if form is None:
        return units.n, "plain", None, None, text
    at = sorted((first % (units.n + 1), second % (units.n + 1)))
    i, j = map(units.offset, at)
    prefix, middle, suffix = text[:i], text[i:j], text[j:]
    ordered = (PREFIX, prefix, SUFFIX, suffix, MIDDLE, middle) if form == "psm" else (SUFFIX, suffix, PREFIX, prefix, MIDDLE, middle)
    return units.n, form, i, j - i, "".join(ordered)


def transform(df: DataFrame, key: str = "doc_id", text: str = "text", keep: list[str] | None = None, pattern: str = CODE_POINT, seed: str = "1", rate: int = RATE, spm_rate: int = SPM_RATE) -> DataFrame:
    """``keep`` columns with ``n`` long, ``form`` (plain, psm or spm), ``prefix_chars`` and ``middle_chars`` long (code points; null if plain) and ``output``.

    A text that is null (taken as empty), empty or contains one of the three
    marks stays plain, and so do those that ``rate`` leaves out.  Parts may be
    empty.  One row comes out per row that goes in; rows with the same key are
    cut by the same numbers, and a null key counts as an empty one.  A column
    of ``keep`` that is named like a result gives way to it; other columns are
    ignored.
    """
    keep = without([key] if keep is None else keep, *_RESULTS)
    first, second, third, fourth = draws(F.col(f"`{key}`"), seed)
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    plain = (body == "") | body.contains(PREFIX) | body.contains(SUFFIX) | body.contains(MIDDLE) | (third % 100 >= rate)
    form = F.when(~plain, F.when(fourth % 100 < spm_rate, "spm").otherwise("psm"))
    rows, n = df.select(*[f"`{c}`" for c in keep], body.alias("__text"), first.alias("__first"), second.alias("__second"), form.alias("__form")), len(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, OUT_ROWS):
                part = batch.slice(at, OUT_ROWS)
                made = [_cut(*(x.as_py() for x in row), pattern) for row in zip(*part.columns[n:], strict=True)]
                kinds = pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string()
                yield pa.RecordBatch.from_arrays([*part.columns[:n], *(pa.array(x, kind) for x, kind in zip(zip(*made, strict=True), kinds, strict=True))], [*keep, *_RESULTS])

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:n]]
    return rows.mapInArrow(run, ", ".join([*fields, "n long, form string, prefix_chars long, middle_chars long, output string"]))


def restored(output: Column, form: Column) -> Column:
    """The text that :func:`transform` made ``output`` of, from the output and its form alone.

    Each mark stands once in a transformed output, as no text that contains
    one is transformed and none can arise where parts meet.
    """
    rest, last = F.substring(output, len(PREFIX) + 1, 2**31 - 1), F.substring_index(output, MIDDLE, -1)
    psm = F.concat(F.substring_index(rest, SUFFIX, 1), last, F.substring_index(F.substring_index(rest, SUFFIX, -1), MIDDLE, 1))
    spm = F.concat(F.substring_index(F.substring_index(rest, PREFIX, -1), MIDDLE, 1), last, F.substring_index(rest, PREFIX, 1))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)
