"""Byte-level BPE encoding and decoding by prefix dynamic programming.

For every byte prefix of a piece there is exactly one token that can stand
last in its encoding.  The table of these last tokens is filled from left to
right: a token that ends at byte ``i`` is the last one if the pair (last token
of what comes before it, this token) is stable, that is, if merging the bytes
of both tokens together gives the two tokens again.  Only tokens that end with
the last three bytes, and are no longer than the longest of these, are tried.  The encoding is read back
from the end.  A table is therefore valid for every prefix at once: appending
bytes only fills further cells, and an edit re-fills cells from the edit until
the table agrees with its former self again (:class:`PrefixTable`).

Work is one narrow ``mapInArrow`` stage: no shuffle, memory bounded by one
batch plus a bounded piece cache.
"""

from __future__ import annotations

import base64
import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from panelforge.llm.common import OUT_ROWS, begins

#: Distinct pieces whose encodings a worker remembers (two generations of this size).
CACHE_PIECES = 100_000
#: Prefixes of up to so many bytes keep their last token from piece to piece, up to so many of them.
PREFIX_BYTES, PREFIXES = 12, 250_000

_LOW = re.compile(r"[\x00-\u024f]*\Z").match


class Vocabulary:
    """Ranks of a byte-level BPE, with what the stability test needs: the merge that makes each token."""

    def __init__(self, ranks: dict[bytes, int]) -> None:
        self.ranks = ranks
        self.bytes = {i: b for b, i in ranks.items()}
        self.longest = max(map(len, ranks))
        #: length of the longest token that ends with three bytes
        self.reach: dict[bytes, int] = {}
        for token in ranks:
            if len(token) > self.reach.get(token[-3:], 0):
                self.reach[token[-3:]] = len(token)
        self.left: dict[int, int] = {}
        self.right: dict[int, int] = {}
        self.merged: dict[tuple[int, int], int] = {}
        for token, i in sorted(ranks.items(), key=lambda x: x[1]):
            parts = self._parts(token, i)
            if len(parts) == 2:
                self.left[i], self.right[i] = parts
                self.merged[parts[0], parts[1]] = i
        self._stable: dict[tuple[int, int], bool] = {}
        self.cells: dict[bytes, int] = {}

    @classmethod
    @lru_cache(maxsize=4)
    def load(cls, path: str) -> Vocabulary:
        with open(path, "rb") as f:
            return cls({base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())})

    def _parts(self, token: bytes, below: int) -> list[int]:
        """The token's bytes after all merges of lower rank."""
        parts = [self.ranks[token[k : k + 1]] for k in range(len(token))]
        while len(parts) > 1:
            found = [(self.merged.get((parts[k], parts[k + 1]), below), k) for k in range(len(parts) - 1)]
            rank, k = min(found)
            if rank >= below:
                break
            parts[k : k + 2] = [rank]
        return parts

    def stable(self, a: int, b: int) -> bool:
        """Whether token ``a`` followed by token ``b`` is what the bytes of both encode to."""
        known = self._stable.get((a, b))
        if known is None:
            if len(self._stable) > 300_000:
                self._stable.clear()
            known = self._stable[a, b] = self._border_holds(a, b)
        return known

    def _border_holds(self, a: int, b: int) -> bool:
        """Take the merges along the border apart, latest first; no merge across it may come before the one undone last."""
        undone = len(self.bytes) + 1
        while True:
            across = self.merged.get((a, b))
            if across is not None and across < undone:
                return False
            a_open, b_open = a in self.right, b in self.left
            if a_open and (a > b or not b_open):
                undone, a = a, self.right[a]
            elif b_open:
                # a merge of equal rank further left comes first, so an equal one across the border is earlier too
                undone, b = b + 1, self.left[b]
            else:
                return True


class PrefixTable:
    """The last token of every prefix of a byte string; grows at the end and follows edits."""

    def __init__(self, vocabulary: Vocabulary, data: bytes = b"") -> None:
        self.vocabulary, self.data, self.last = vocabulary, b"", [-1]
        self.append(data)

    def append(self, data: bytes) -> None:
        start = len(self.data)
        self.data += data
        self.last.extend(self._cells(start))

    def _cells(self, start: int) -> list[int]:
        """The cells after the first ``start`` bytes, all at once."""
        v, data, last = self.vocabulary, self.data, self.last[: start + 1]
        token_of, known, stable, reach = v.ranks.get, v._stable.get, v.stable, v.reach.get
        cells = v.cells
        if not start:  # other pieces began alike
            for end in range(1, min(len(data), PREFIX_BYTES) + 1):
                token = cells.get(data[:end])
                if token is None:
                    break
                last.append(token)
        for end in range(len(last), len(data) + 1):
            longest = reach(data[end - 3 : end], 2) if end > 2 else end
            for begin in range(end - longest if end > longest else 0, end):
                token = token_of(data[begin:end])
                if token is not None:
                    before = last[begin]
                    if before < 0:
                        break
                    holds = known((before, token))
                    if holds or holds is None and stable(before, token):
                        break
            else:
                raise ValueError("the vocabulary lacks a byte")
            last.append(token)
            if end <= PREFIX_BYTES:
                if len(cells) >= PREFIXES:
                    cells.clear()
                cells[data[:end]] = token
        return last[start + 1 :]

    def edit(self, start: int, stop: int, data: bytes) -> int:
        """Replace bytes ``start:stop``; returns how many cells had to be filled again."""
        former, shift = self.last, len(data) - (stop - start)
        self.data = self.data[:start] + data + self.data[stop:]
        self.last = former[: start + 1] + [-1] * (len(self.data) - start)
        same = filled = 0
        for end in range(start + 1, len(self.data) + 1):
            self.last[end] = self._last(end)
            filled += 1
            # once as many cells as the longest token spans agree beyond the edit, all later ones do
            same = same + 1 if end - shift > stop and self.last[end] == former[end - shift] else 0
            if same >= self.vocabulary.longest and end - start - len(data) >= self.vocabulary.longest:
                self.last[end + 1 :] = former[end - shift + 1 :]
                break
        return filled

    def _last(self, end: int) -> int:
        v, data = self.vocabulary, self.data
        longest = v.reach.get(data[end - 3 : end], 2) if end > 2 else end
        for begin in range(max(0, end - longest), end):
            token = v.ranks.get(data[begin:end])
            if token is not None and (not begin or v.stable(self.last[begin], token)):
                return token
        raise ValueError("the vocabulary lacks a byte")

    def tokens(self, end: int | None = None) -> list[int]:
        """The encoding of the first ``end`` bytes (all of them if None)."""
        at, out = len(self.data) if end is None else end, []
        while at:
            out.append(token := self.last[at])
            at -= len(self.vocabulary.bytes[token])
        return out[::-1]


class _Pieces(dict):
    """Piece -> its ids, each after a space; an older generation keeps what is still in use when this one is full."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        super().__init__()
        self.vocabulary, self.older = vocabulary, {}

    def __missing__(self, piece: str) -> str:
        found = self.older.get(piece)
        if found is None:
            data = piece.encode("utf-8", "replace")
            whole = self.vocabulary.ranks.get(data)
            ids = PrefixTable(self.vocabulary, data).tokens() if whole is None else [whole]
            found = "".join([f" {i}" for i in ids])
        if len(self) >= CACHE_PIECES:
            self.older = dict(self)
            self.clear()
        if len(piece) <= 64:
            self[piece] = found
        return found


def _splitters(pattern: str):
    """Two functions that split a text by ``pattern``: one for any text, and a faster one for texts of characters below U+0250."""
    # the separators FS, GS, RS and US count as white space in Python only
    any_text = regex.compile(pattern.replace(r"[^\s", r"[^\p{White_Space}").replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}")).findall
    low = [chr(c) for c in range(0x250)]
    classes = {
        r"\p{L}": [c for c in low if unicodedata.category(c)[0] == "L"],
        r"\p{N}": [c for c in low if unicodedata.category(c)[0] == "N"],
        r"\s": [c for c in low if regex.match(r"\p{White_Space}", c)],
    }
    inside = {k: "".join(re.escape(c) for c in v) for k, v in classes.items()}
    named = re.compile("|".join(map(re.escape, inside)))
    simple = re.sub(r"\[\^[^\]]*\]", lambda m: named.sub(lambda x: inside[x[0]], m[0]), pattern)
    simple = named.sub(lambda x: f"[{inside[x[0]]}]", simple.replace(r"\S", rf"[^{inside[r'\s']}]"))
    return any_text, None if r"\p" in simple else re.compile(simple).findall


class Codec:
    """Encodes texts to space-joined ids and decodes these."""

    def __init__(self, path: str, pattern: str) -> None:
        self.vocabulary = Vocabulary.load(path)
        self.any_text, self.low_text = _splitters(pattern)
        self.known = _Pieces(self.vocabulary)
        self.of_id = {str(i): b for i, b in self.vocabulary.bytes.items()}

    def pieces(self, text: str) -> list[str]:
        return self.low_text(text) if self.low_text and _LOW(text) else self.any_text(text)

    def encode(self, text: str | None) -> str:
        return "".join(map(self.known.__getitem__, self.pieces(text)))[1:] if text else ""

    def decode(self, ids: str) -> bytes:
        return b"".join(map(self.of_id.__getitem__, ids.split(" "))) if ids else b""


@lru_cache(maxsize=4)
def codec(path: str, pattern: str) -> Codec:
    return Codec(path, pattern)


def _forget() -> None:
    codec.cache_clear()
    Vocabulary.load.cache_clear()


def encode(df: DataFrame, vocabulary: str, pattern: str, text: str = "text", keep: list[str] | None = None, decode: bool = True) -> DataFrame:
    """``keep`` columns, ``n_tokens`` long, ``ids`` (decimal ids joined by one space) and, with ``decode``, ``decoded`` binary.

    Each match of ``pattern`` is encoded by itself; special tokens get no ids.
    A null or empty text has no tokens, empty ``ids`` and empty ``decoded``.
    One row comes out per row that goes in, repeated rows included.  Columns
    not in ``keep`` are ignored; none of ``n_tokens``, ``ids``, ``decoded``
    may be in ``keep``.
    """
    keep = ["doc_id"] if keep is None else keep
    columns = list(dict.fromkeys([*keep, text]))
    rows, at_text = df.select(*columns), columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begins(_forget)
        c = codec(vocabulary, pattern)
        for batch in batches:
            for at in range(0, batch.num_rows, OUT_ROWS):
                part = batch.slice(at, OUT_ROWS)
                ids = [c.encode(x.as_py()) for x in part.column(at_text)]
                out = [*part.columns[: len(keep)], pa.array([x.count(" ") + 1 if x else 0 for x in ids], pa.int64()), pa.array(ids, pa.string())]
                if decode:
                    out.append(pa.array([c.decode(x) for x in ids], pa.binary()))
                yield pa.RecordBatch.from_arrays(out, [*keep, "n_tokens", "ids", *["decoded"] * decode])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[: len(keep)])
    return rows.mapInArrow(run, f"{fields}, n_tokens long, ids string" + ", decoded binary" * decode)


def decode(df: DataFrame, vocabulary: str, pattern: str, ids: str = "ids", keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns and ``decoded`` binary for rows whose ``ids`` column is as :func:`encode` makes it (null: empty)."""
    keep = ["doc_id"] if keep is None else keep
    rows = df.select(*keep, df[ids].alias("__ids"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begins(_forget)
        c = codec(vocabulary, pattern)
        for batch in batches:
            for at in range(0, batch.num_rows, OUT_ROWS):
                part = batch.slice(at, OUT_ROWS)
                out = pa.array([c.decode(x.as_py() or "") for x in part.column(len(keep))], pa.binary())
                yield pa.RecordBatch.from_arrays([*part.columns[: len(keep)], out], [*keep, "decoded"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1])
    return rows.mapInArrow(run, f"{fields}, decoded binary")
