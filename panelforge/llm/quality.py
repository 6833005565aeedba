"""Quality classifier: a regularised quadratic discriminant over document statistics.

One pass turns every whole text into a short vector of transformed statistics.
Class counts, sums and products of these vectors are added up by Spark over
all labelled rows outside the held-out fold, so the model sees every such row
and only sums reach the driver (their size depends on the number of
statistics alone).  The class covariances are shrunk towards the pooled one
and towards its diagonal; their Cholesky factors are computed once and go to
the tasks, where the score of a document is the logistic of the difference of
its two log densities (from Mahalanobis distances) plus the log prior odds.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelforge.llm.common import held_out, written

STATISTICS = ["size", "word_length", "symbols", "marks", "exclaims", "bars", "capitals", "digits", "stops", "variety", "line_variety", "phrase_variety"]
#: Weight of the pooled covariance in each class covariance, and of its diagonal in that.
TO_POOLED, TO_DIAGONAL = 0.1, 0.05

_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = _LETTER[128:] = True
_START = np.ones(256, bool)
_START[128:192] = False
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&<>@^~=_\\{}[]+")] = True


def statistics(text: str | None) -> list[float]:
    """The transformed statistics of a whole text (null: as empty): logarithms of ratios with one added to each count."""
    data = (text or "").encode("utf-8", "replace")
    counts = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    words, lines = data.split(), [x for x in data.split(b"\n") if x.strip()]
    n, chars, letters = len(words), int(counts[_START].sum()), int(counts[_LETTER & _START].sum())
    upper, lower = int(counts[65:91].sum()), int(counts[97:123].sum())
    symbols, exclaims, bars = int(counts[_SYMBOL].sum()), int(counts[33]), int(counts[124])
    stops, digits = int(counts[46] + counts[44] + counts[63]), int(counts[48:58].sum())
    pairs = len(set(zip(words, words[1:], strict=False))) if n > 1 else 1
    ratios = [
        (chars, 0), (letters, n), (symbols, n), (chars - letters - n, n), (exclaims, n), (bars, n), (upper, lower), (digits, n), (stops, n),
        (len(set(words)), n), (len(set(lines)), len(lines)), (pairs, max(n - 1, 1)),
    ]
    return [float(np.log((max(a, 0) + 1) / (b + 1))) for a, b in ratios]


@dataclass
class Discriminant:
    """Two classes: log priors, means, and inverse Cholesky factors with their log determinants."""

    log_prior: np.ndarray
    mean: np.ndarray
    inverse: np.ndarray
    log_det: np.ndarray

    @classmethod
    def fit(cls, n: np.ndarray, sums: np.ndarray, products: np.ndarray) -> Discriminant:
        """From each class's number of rows, sum of vectors and sum of outer products; a class without rows is as the other one."""
        p = sums.shape[1]
        total = n.sum()
        pooled_mean = sums.sum(0) / max(total, 1)
        mean = np.array([sums[k] / n[k] if n[k] else pooled_mean for k in (0, 1)])
        scatter = products - n[:, None, None] * mean[:, :, None] * mean[:, None, :]
        pooled = scatter.sum(0) / max(total - 2, 1)
        pooled = (1 - TO_DIAGONAL) * pooled + TO_DIAGONAL * np.diag(np.diag(pooled)) + 1e-4 * np.eye(p)
        inverse, log_det = np.empty((2, p, p)), np.empty(2)
        for k in (0, 1):
            own = scatter[k] / n[k] if n[k] else pooled
            weight = (TO_POOLED * n[k] + 10 * p) / (n[k] + 10 * p)  # few rows: mostly the pooled covariance
            factor = np.linalg.cholesky((1 - weight) * own + weight * pooled)
            inverse[k] = np.linalg.inv(factor)
            log_det[k] = 2 * np.log(np.diag(factor)).sum()
        return cls(np.log((n + 1) / (total + 2)), mean, inverse, log_det)

    def score(self, x: np.ndarray) -> np.ndarray:
        """The probability of class 1 for each row of ``x``."""
        log = [self.log_prior[k] - 0.5 * self.log_det[k] - 0.5 * np.square((x - self.mean[k]) @ self.inverse[k].T).sum(1) for k in (0, 1)]
        return 1 / (1 + np.exp(np.clip(log[0] - log[1], -700, 700)))


def _vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        x = [statistics(t.as_py()) for t in batch.column(2)]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(x, pa.list_(pa.float64()))], ["doc_id", "held_out", "x"])


def vectors(documents: DataFrame) -> DataFrame:
    """``doc_id``, ``held_out`` and the vector ``x`` of every document."""
    rows = documents.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text")
    return rows.mapInArrow(_vectors, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, held_out boolean, x array<double>")


def fit(vectors: DataFrame, labels: DataFrame, label: str = "quality") -> Discriminant:
    """Learn from the vectors outside the held-out fold that have a label 0 or 1.

    Rows with a null key or another label are left out.  Repeated rows of
    documents count each time, equal labels of a key once, and a key with both
    labels counts for either class.
    """
    known = labels.select("doc_id", labels[label].cast("int").alias("y")).where("y IN (0, 1)").distinct()
    rows = vectors.where(~F.col("held_out")).join(known, "doc_id").select("y", "x").groupBy("y")
    p = len(STATISTICS)
    cells = [F.sum(F.col("x")[i]).alias(f"s{i}") for i in range(p)] + [F.sum(F.col("x")[i] * F.col("x")[j]).alias(f"p{i}_{j}") for i in range(p) for j in range(i, p)]
    n, sums, products = np.zeros(2), np.zeros((2, p)), np.zeros((2, p, p))
    for row in rows.agg(F.count("*").alias("n"), *cells).collect():  # one row a class
        k = row["y"]
        n[k] = row["n"]
        sums[k] = [row[f"s{i}"] for i in range(p)]
        for i in range(p):
            for j in range(i, p):
                products[k, i, j] = products[k, j, i] = row[f"p{i}_{j}"]
    return Discriminant.fit(n, sums, products)


def classify(documents: DataFrame, labels: DataFrame, label: str = "quality") -> DataFrame:
    """``doc_id``, ``held_out``, ``score`` (0 to 1, higher: label 1 likelier) and ``predicted`` for every document.

    A null text is an empty one and gets a score like it.  Without any usable
    label all scores are one half.  Repeated rows stay repeated; other columns
    of ``documents``, its language and source among them, are never read.
    """
    x = written(vectors(documents), "quality-vectors")
    model = fit(x, labels, label)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat = batch.column(2).flatten().to_numpy(zero_copy_only=False)
            score = model.score(flat.reshape(batch.num_rows, len(STATISTICS))) if batch.num_rows else np.empty(0)
            out = [batch.column(0), batch.column(1), pa.array(score, pa.float64()), pa.array((score >= 0.5).astype(np.int32), pa.int32())]
            yield pa.RecordBatch.from_arrays(out, ["doc_id", "held_out", "score", "predicted"])

    return x.mapInArrow(run, f"doc_id {x.schema['doc_id'].dataType.simpleString()}, held_out boolean, score double, predicted int")
