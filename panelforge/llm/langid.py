"""Language identification by a linear-chain conditional random field over words.

Each word of a text has one language.  Its score for a language is the sum of
the weights of its affixes, its letter n-grams and, for the frequent words of
the training sample, the word itself (the lexicon); neighbouring words are
tied by learned transition weights.  The forward-backward algorithm gives each
word's distribution over languages given the whole text, so that a foreign
passage is labelled as such; a text's language is the one with the greatest
mean probability.

The weights are fitted on the driver to a bounded sample, ``SAMPLE`` documents
per language outside the held-out fold, cut into code-switched sequences.
Labelling is one narrow stage.  Long texts are no slow case: forward-backward
runs over all blocks of ``BLOCK`` words of a batch at once, block products are
chained, and the result is the same as word by word.  Of a batch only the
numbers of its words are held whole; texts are taken apart by slices and
probabilities computed by segments, so that memory follows a text's length a
few times over at most.
"""

from __future__ import annotations

import re
import unicodedata
import zlib
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelforge.llm.common import begins, held_out, sized, slices, without, written

#: Most documents per language that the model is fitted to, and most of all languages together.
SAMPLE, SAMPLE_ALL = 200, 20_000
BUCKETS = 1 << 15
BLOCK = 64
#: Words whose scores a worker remembers.
CACHE_WORDS = 200_000
UNKNOWN = "und"

#: Code points of text that are taken apart at a time, and blocks of words whose probabilities are computed at a time.
SLICE, SEGMENT = 1 << 19, 1 << 10

#: What the plain pattern below does not tell apart: marks, and numerals that are neither digits nor letters (Roman or circled ones).
_UNUSUAL = "".join(c for c in map(chr, range(0x10000)) if unicodedata.category(c)[0] == "M" or c.isnumeric() and not c.isalpha() and not c.isdecimal())
#: A quick look that keeps to one table of characters; those beyond it count as unusual.
_unusual = re.compile(f"[{_UNUSUAL}\U00010000-\U0010ffff]").search
_plain = re.compile(r"[^\W\d_]{1,40}").findall
_runs = regex.compile(r"\p{L}[\p{L}\p{M}]*").findall
_break = regex.compile(r"[^\p{L}\p{M}]").search


def words_of(text: str) -> list[str]:
    """Runs of letters (``\\p{L}``) with the marks (``\\p{M}``) on them; a longer run than 40, as in scripts without spaces, is cut into pieces that are words of the chain."""
    if text.isascii() or not _unusual(text):
        return _plain(text)
    return [run[k : k + 40] for run in _runs(text) for k in range(0, len(run), 40)]


def _slices(text: str) -> Iterator[str]:
    """A text in slices, cut where no run of letters goes on."""
    at = 0
    while at < len(text):
        end = _break(text, at + SLICE)
        stop = end.start() if end else len(text)
        yield text[at:stop]
        at = stop


class _Buckets(dict):
    """Word part -> its bucket."""

    def __missing__(self, part: str) -> int:
        if len(self) > 100_000:
            self.clear()
        found = self[part] = zlib.crc32(part.encode("utf-8", "replace")) % BUCKETS
        return found


_buckets = _Buckets()
_bucket = _buckets.__getitem__


def _forget() -> None:
    _buckets.clear()


def features(word: str, lexicon: frozenset[str]) -> list[int]:
    """Hashed prefixes, suffixes and n-grams of a lower-case word, and the word itself if it is in the lexicon."""
    w = f"^{word}$"
    parts = [w[k : k + n] for n in (2, 3) for k in range(len(w) - n + 1)]
    parts += [f"<{w[1 : 1 + n]}" for n in (1, 2, 3)] + [f">{w[-1 - n : -1]}" for n in (1, 2, 3)]
    if word in lexicon:
        parts.append(f"={word}")
    return list(map(_bucket, parts))


def marginals(emit: np.ndarray, lengths: np.ndarray, tie: np.ndarray) -> np.ndarray:
    """Each word's distribution over languages.

    ``emit`` has a row of positive scores for every word of one text after
    another, ``lengths`` the words of each text (one or more), ``tie`` the
    positive transition scores.  Before the first word all languages are
    alike.
    """
    return np.concatenate([found for _, found in segments(lambda a, b: emit[a:b], lengths, tie)])


def segments(emit: Callable[[int, int], np.ndarray], lengths: np.ndarray, tie: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """:func:`marginals` by segments of ``SEGMENT`` blocks: the place of the first word of each, and its words' distributions.

    ``emit`` gives the scores of the words from one place up to another.
    """
    k = len(tie)
    blocks = -(-lengths // BLOCK)
    first = np.cumsum(blocks) - blocks
    n = int(blocks.sum())
    of = np.repeat(np.arange(len(lengths)), blocks)
    starts = (np.cumsum(lengths) - lengths)[of] + (np.arange(n) - first[of]) * BLOCK
    starts = np.append(starts, lengths.sum())

    def cells(b: int) -> tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Of the blocks from ``b`` the place of the first word, the places of all in their blocks, scores, and where there are words."""
        size = np.diff(starts[b : b + SEGMENT + 1])
        row = np.repeat(np.arange(len(size)), size)
        column = np.arange(len(row)) - (starts[b:][: len(size)] - starts[b])[row]
        scores, real = np.ones((BLOCK, len(size), k)), np.zeros((BLOCK, len(size), 1), bool)
        scores[column, row] = emit(starts[b], starts[b] + len(row))
        real[column, row] = True
        return starts[b], row, column, scores, real

    whole = np.broadcast_to(np.eye(k), (n, k, k)).copy()
    for b in range(0, n, SEGMENT):
        _, _, _, scores, real = cells(b)
        product = whole[b : b + SEGMENT]
        for c in range(BLOCK):
            step = (product @ tie) * scores[c][:, None, :]
            product = np.where(real[c][:, :, None], step / step.sum((1, 2), keepdims=True), product)
        whole[b : b + SEGMENT] = product
    all_ahead, all_behind = np.empty((n, k)), np.empty((n, k))
    most = int(blocks.max())
    by_size = np.argsort(-blocks, kind="stable")
    active = np.searchsorted(-blocks[by_size], -np.arange(1, most + 1), side="right")
    state = np.full((len(lengths), k), 1 / k)
    for b in range(most):
        now = by_size[: active[b]]
        all_ahead[first[now] + b] = state[now]
        new = np.einsum("ni,nij->nj", state[now], whole[first[now] + b])
        state[now] = new / new.sum(1, keepdims=True)
    state = np.full((len(lengths), k), 1 / k)
    for b in range(most - 1, -1, -1):
        now = by_size[: active[b]]
        all_behind[first[now] + b] = state[now]
        new = np.einsum("nij,nj->ni", whole[first[now] + b], state[now])
        state[now] = new / new.sum(1, keepdims=True)

    for b in range(0, n, SEGMENT):
        start, row, column, scores, real = cells(b)
        ahead, behind, out = all_ahead[b : b + SEGMENT], all_behind[b : b + SEGMENT], np.empty_like(scores)
        for c in range(BLOCK):
            step = (ahead @ tie) * scores[c]
            ahead = out[c] = np.where(real[c], step / step.sum(1, keepdims=True), ahead)
        for c in range(BLOCK - 1, -1, -1):
            out[c] *= behind
            step = (behind * scores[c]) @ tie.T
            behind = np.where(real[c], step / step.sum(1, keepdims=True), behind)
        found = out[column, row]
        yield start, found / found.sum(1, keepdims=True)


@dataclass
class Chain:
    """A fitted field: languages, feature weights, transition weights and lexicon."""

    languages: list[str]
    weights: np.ndarray
    tie: np.ndarray
    lexicon: frozenset[str]
    _row: dict[str, int] = field(default_factory=dict)
    _scores: np.ndarray | None = None

    def __getstate__(self) -> dict:
        return self.__dict__ | {"_row": {}, "_scores": None}

    def _rows(self, words: list[str]) -> np.ndarray:
        """Where each word's scores stand; words that are new are scored."""
        row = self._row
        if new := [w for w in dict.fromkeys(words) if w not in row]:
            ids = [features(w, self.lexicon) for w in new]
            starts = np.cumsum([0, *map(len, ids[:-1])])
            scores = np.add.reduceat(self.weights[np.concatenate(ids)], starts, axis=0)
            scores = np.exp(np.clip(scores - scores.max(1, keepdims=True), -30, 0))
            if self._scores is None or len(row) + len(new) > len(self._scores):
                more = np.empty((2 * (len(row) + len(new)), scores.shape[1]), scores.dtype)
                more[: len(row)] = self._scores[: len(row)] if self._scores is not None else 0
                self._scores = more
            self._scores[len(row) : len(row) + len(new)] = scores
            row.update(zip(new, range(len(row), len(row) + len(new)), strict=True))
        return np.fromiter(map(row.__getitem__, words), np.int32, len(words))

    def _emit(self, words: list[str]) -> np.ndarray:
        rows = self._rows(words)
        return self._scores[rows]

    def label(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Which texts have words, and of these the mean probability of each language and last the mean of each word's greatest one."""
        if len(self._row) > CACHE_WORDS:
            self._row, self._scores = {}, None
        parts = [[self._rows(words_of(x)) for x in _slices(text)] for text in texts]
        lengths = np.array([sum(map(len, x)) for x in parts], np.int64)
        some = np.nonzero(lengths)[0]
        lengths, rows = lengths[some], np.concatenate([np.empty(0, np.int32), *(x for text in parts for x in text)])
        del parts
        sums, ends = np.zeros((len(some), len(self.languages) + 1)), np.cumsum(lengths)
        if len(some):
            for start, each in segments(lambda a, b: self._scores[rows[a:b]], lengths, np.exp(self.tie)):
                each = np.concatenate([each, each.max(1, keepdims=True)], axis=1)
                of = np.searchsorted(ends, np.arange(start, start + len(each)), side="right")
                at = np.nonzero(np.diff(of, prepend=-1))[0]
                sums[of[at]] += np.add.reduceat(each, at, axis=0)
        return some, sums / lengths[:, None]

    @classmethod
    def fit(cls, sample: list[tuple[str, list[str]]], epochs: int = 4, length: int = 48, sequences: int = 2400, seed: int = 7) -> Chain:
        """Adagrad on the log likelihood of code-switched sequences cut from (language, words) documents."""
        languages = sorted({lang for lang, _ in sample})
        k, rng = len(languages), np.random.default_rng(seed)
        docs = [[w for lang, w in sample if lang == of and w] for of in languages]
        seen = Counter(w for _, t in sample for w in t)
        lexicon = frozenset(w for w, n in seen.most_common(20_000) if n >= 3)
        weights, tie = np.zeros((BUCKETS, k)), np.zeros((k, k))
        if k < 2 or not all(docs):
            return cls(languages, weights, tie, lexicon)
        made = []
        for _ in range(sequences):
            words, gold = [], []
            while len(words) < length:
                y = int(rng.integers(k))
                doc = docs[y][int(rng.integers(len(docs[y])))]
                n, at = int(rng.integers(4, length)), int(rng.integers(len(doc)))
                words += doc[at : at + n]
                gold += [y] * len(doc[at : at + n])
            made.append((words[:length], gold[:length]))
        ids = {w: features(w, lexicon) for w in {w for x, _ in made for w in x}}
        g_weights, g_tie = np.full((BUCKETS, k), 1e-2), np.full((k, k), 1e-2)
        size = 40
        for _ in range(epochs):
            for at in range(0, sequences, size):
                part = made[at : at + size]
                flat = [ids[w] for words, _ in part for w in words]
                count = np.array([len(x) for x in flat])
                where, of = np.concatenate(flat), np.repeat(np.arange(len(flat)), count)
                score = np.add.reduceat(weights[where], np.cumsum(count) - count, axis=0)
                emit = np.exp(np.clip(score - score.max(1, keepdims=True), -30, 0)).reshape(len(part), length, k)
                gold = np.array([y for _, y in part])
                node, pair = _expected(emit, np.exp(tie))
                right = np.zeros_like(node)
                np.put_along_axis(right, gold[:, :, None], 1, axis=2)
                slope = (right - node).reshape(-1, k)[of]
                step = np.stack([np.bincount(where, slope[:, c], BUCKETS) for c in range(k)], 1) - 1e-4 * weights
                g_weights += step**2
                weights += 0.2 * step / np.sqrt(g_weights)
                edges = np.zeros((k, k))
                np.add.at(edges, (gold[:, :-1], gold[:, 1:]), 1)
                step = edges - pair - 1e-2 * tie
                g_tie += step**2
                tie += 0.2 * step / np.sqrt(g_tie)
        return cls(languages, weights.astype(np.float32), tie, lexicon)


def _expected(emit: np.ndarray, tie: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Expected labels of each word and, in all, of neighbours, for sequences of one length."""
    b, t, k = emit.shape
    ahead, behind = np.empty((t, b, k)), np.ones((t, b, k))
    state = np.full((b, k), 1 / k)
    for c in range(t):
        state = (state @ tie) * emit[:, c]
        state /= state.sum(1, keepdims=True)
        ahead[c] = state
    for c in range(t - 2, -1, -1):
        state = (behind[c + 1] * emit[:, c + 1]) @ tie.T
        behind[c] = state / state.sum(1, keepdims=True)
    node = ahead * behind
    node /= node.sum(2, keepdims=True)
    pair = np.zeros((k, k))
    for c in range(t - 1):
        joint = ahead[c][:, :, None] * tie * (emit[:, c + 1] * behind[c + 1])[:, None, :]
        pair += (joint / joint.sum((1, 2), keepdims=True)).sum(0)
    return node.transpose(1, 0, 2), pair


def fit(documents: DataFrame, sample: int = SAMPLE, most: int = SAMPLE_ALL) -> Chain:
    """Fit to at most ``sample`` documents per language and ``most`` in all, chosen by a hash of their key, none of them held out."""
    rows = documents.where(~held_out(F.col("doc_id")) & F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}")).select("lang", "doc_id", F.xxhash64("doc_id").alias("h"))
    first = F.row_number().over(Window.partitionBy("lang").orderBy("h", "doc_id"))
    chosen = rows.withColumn("k", first).where(F.col("k") <= sample).orderBy("k", "h", "lang").limit(most).select("doc_id", "lang")
    # one row a key, though the table may repeat it
    texts = documents.select("doc_id", "lang", "text").join(sized(written(chosen.distinct(), "langid-sample")), ["doc_id", "lang"], "left_semi").groupBy("doc_id", "lang").agg(F.min("text").alias("text"))
    return Chain.fit([(r["lang"], words_of(r["text"].lower())) for r in texts.orderBy("doc_id", "lang").collect()])


def identify(documents: DataFrame, model: Chain, keep: list[str] | None = None, sure: bool = False) -> DataFrame:
    """``keep`` columns with ``lang_pred`` and ``score`` (the language's mean probability) for every document.

    ``sure`` adds a column of that name: how probable the words' own best
    languages are on average.  It is high for a text in several languages too.

    Texts that are null or have no letters, and all texts if the model knows
    no language, are ``und`` with score 0.  Rows are judged one by one,
    repeated ones too; no other column is read.  A column of ``keep`` that is
    named like a result gives way to it.
    """
    names = ["lang_pred", "score", *["sure"] * sure]
    keep = without(["doc_id"] if keep is None else keep, *names)
    columns = list(dict.fromkeys([*keep, "text"]))
    rows, n, at_text = documents.select(*columns), len(keep), columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begins(_forget)
        for batch in batches:
            for part in slices(batch, at_text):
                found, score, clear = [UNKNOWN] * part.num_rows, np.zeros(part.num_rows), np.zeros(part.num_rows)
                some, mean = model.label([(x.as_py() or "").lower() for x in part.column(at_text)]) if model.languages else ([], None)
                if len(some):
                    clear[some] = np.clip(mean[:, -1], 0, 1)
                    best = mean[:, :-1].argmax(1)
                    score[some] = np.clip(mean[np.arange(len(some)), best], 0, 1)
                    for k, y in zip(some, best, strict=True):
                        found[k] = model.languages[y]
                yield pa.RecordBatch.from_arrays([*part.columns[:n], pa.array(found, pa.string()), pa.array(score, pa.float64()), *[pa.array(clear, pa.float64())] * sure], [*part.schema.names[:n], *names])

    fields = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in rows.schema.fields[:n])
    return rows.mapInArrow(run, f"{fields}lang_pred string, score double" + ", sure double" * sure)
