"""Near duplicates among embeddings by tiles of int8 products with rigorous error bounds.

1.  *Quantisation.*  A vector u of length one becomes codes q = round(u / s)
    of one byte each, with a scale s of its own, and the norm e of what is
    lost, u - s q.  For any two vectors the cosine then differs from
    s_u s_v (q_u . q_v) by at most e_u + e_v + e_u e_v (Cauchy-Schwarz).
    Equal vectors are one class from here on.
2.  *Tiles.*  Classes are dealt over stripes of about ``STRIPE``; each pair of
    stripes, and each stripe with itself, is a tile that one task multiplies.
    A tile's size is bounded whatever the data are, so there is no hot one.
    Products of codes are whole numbers and exact in single precision.
3.  *Bounds.*  A pair whose greatest possible cosine is below the threshold is
    no link; all others are computed again in double precision from the
    vectors as they are.
4.  *Links.*  A tile gives one row per vector that has links in it: their
    number, and one vector that stands for its component within the tile.  So
    a thousand near copies give a thousand rows and not half a million pairs.

Every pair of classes meets in one tile: the result is exact, and the work is
the square of their number, which is what a product of all tiles costs.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelforge.llm.common import Scratch
from panelforge.llm.components import components

THRESHOLD = 0.9
#: Vectors a stripe, and the least number of stripes, which keeps all cores of a small cluster busy.
STRIPE, LEAST_STRIPES = 8192, 8
#: Rows of a tile that are multiplied at a time, and pairs that are computed in double precision at a time.
ROWS, PAIRS = 256, 1 << 14
#: Products of so many codes have sums that single precision holds exactly: 127 * 127 * 1024 < 2**24.
EXACT = 1024
#: More than all rounding of a bound in double precision.
SLACK = 1e-9


def quantise(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Codes, scales and norms of the lost rest for rows that are not zero, after these are brought to length one."""
    unit = unit_rows(vectors)
    scale = np.abs(unit).max(axis=1) / 127
    codes = np.rint(unit / scale[:, None])
    lost = np.sqrt(((unit - scale[:, None] * codes) ** 2).sum(axis=1))
    return codes.astype(np.int8), scale, lost


def unit_rows(vectors: np.ndarray) -> np.ndarray:
    # the greatest component first: squares of very large or small ones leave the range of doubles
    vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return vectors / np.sqrt((vectors**2).sum(axis=1, keepdims=True))


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact products of rows of codes, given as single precision."""
    if a.shape[1] <= EXACT:
        return a @ b.T
    return sum((a[:, k : k + EXACT] @ b[:, k : k + EXACT].T).astype(np.float64) for k in range(0, a.shape[1], EXACT))


def linked_pairs(left: tuple, right: tuple, threshold: float, same: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places (in ``left``, in ``right``) of the pairs whose cosine reaches the threshold; with ``same``, of each pair once.

    Either side is vectors, codes, scales and lost norms.
    """
    (u, q, s, e), (v, p, t, d) = left, right
    u, v, q, p = unit_rows(u), unit_rows(v), q.astype(np.float32), p.astype(np.float32)
    most_t, most_d = t.max(), d.max()
    for at in range(0, len(u), ROWS):
        part = slice(at, at + ROWS)
        exact = _products(q[part], p)
        # a first look with the largest scale and loss of the other side, a little lower for its own rounding
        floor = threshold - e[part] - most_d - e[part] * most_d - SLACK
        least = np.where(floor > 0, floor / (s[part] * most_t) * (1 - 1e-6) - 1, -np.inf)
        i, j = np.nonzero(exact >= least[:, None].astype(exact.dtype))
        if same:
            i, j = i[i + at < j], j[i + at < j]
        bound = s[part][i] * t[j] * exact[i, j] + e[part][i] + d[j] + e[part][i] * d[j]
        i, j = i[bound >= threshold - SLACK] + at, j[bound >= threshold - SLACK]
        for k in range(0, len(i), PAIRS):
            a, b = i[k : k + PAIRS], j[k : k + PAIRS]
            near = np.einsum("kd,kd->k", u[a], v[b]) >= threshold
            yield a[near], b[near]


def _merge(root: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``root`` (of each node the least node known of its component) after the links (a, b)."""
    while True:
        x, y = root[a], root[b]
        apart = x != y
        if not apart.any():
            return root
        np.minimum.at(root, np.maximum(x, y)[apart], np.minimum(x, y)[apart])
        while (root != root[root]).any():
            root = root[root]


def _tile(threshold: float, dtype: type):
    """Of the rows of one tile (both stripes; ``side`` 1 is the second) those with links: number of copies linked, and the tile's component."""

    def read(t: pa.Table) -> tuple[np.ndarray, ...]:
        raw = np.frombuffer(b"".join(t["raw"].to_pylist()), dtype).reshape(t.num_rows, -1).astype(np.float64)
        codes = np.frombuffer(b"".join(t["codes"].to_pylist()), np.int8).reshape(t.num_rows, -1)
        return raw, codes, t["scale"].to_numpy(), t["lost"].to_numpy()

    def run(t: pa.Table) -> pa.Table:
        t = t.sort_by("side")
        side, copies = t["side"].to_numpy(), t["copies"].to_numpy()
        first = int((side == 0).sum())
        left, right = t.slice(0, first), t.slice(first)
        # a stripe with itself has one side only
        same = t["i"][0].as_py() == t["j"][0].as_py()
        links, root, n = np.zeros(t.num_rows, np.int64), np.arange(t.num_rows), 0 if same else first
        if first and (same or right.num_rows):
            a_side = read(left)
            for a, b in linked_pairs(a_side, a_side if same else read(right), threshold, same):
                b = b + n
                np.add.at(links, a, copies[b])
                np.add.at(links, b, copies[a])
                root = _merge(root, a, b)
        some = np.nonzero(links)[0]
        return pa.table({"name": t["name"].take(pa.array(some)), "n": links[some], "boss": t["name"].take(pa.array(root[some]))})

    return run


def join(df: DataFrame, key: str = "vec_id", vector: str = "embedding", threshold: float = THRESHOLD, stripe: int = STRIPE) -> DataFrame:
    """One row per row: ``key``, ``n_links`` long (other rows at a cosine of ``threshold`` or more), ``component_id`` (least key that links reach, the own one included) and ``kept`` (whether that is the own one).

    Rows whose vector is null, empty, zero or has a component that is null, NaN
    or infinite link with nothing, as do those without a key, whose component
    is null and which are kept.  Vectors link with those of their own length
    only.  Each row is a vector of its own: repeated rows link with each other.
    A key may be of any type that has an order, the vector an array of float
    or double.  All other columns are ignored.
    """
    kind, of = df.schema[vector].dataType.elementType.typeName(), df.schema[key].dataType.simpleString()
    if kind not in ("float", "double"):
        raise TypeError(f"{vector} must be an array of float or double, not of {kind}")
    dtype, scratch = np.float32 if kind == "float" else np.float64, Scratch(df.sparkSession, "vectors")
    rows = df.select(F.col(f"`{key}`").alias("vec"), F.col(f"`{vector}`").alias("x"))
    rows = scratch.write(rows.mapInArrow(_codes(dtype), f"vec {of}, raw binary, codes binary, scale double, lost double"), "rows")
    usable, others = rows.where("raw IS NOT NULL AND vec IS NOT NULL"), rows.where("raw IS NULL OR vec IS NULL")
    classes = usable.groupBy("raw").agg(F.min("vec").alias("vec"), F.count("*").alias("copies"), *[F.first(c).alias(c) for c in ("codes", "scale", "lost")])
    # named by its least key first, so that the least name of a component has its least key
    classes = scratch.write(classes.select(F.struct("vec", F.md5("raw").alias("digest")).alias("name"), "raw", "copies", "codes", "scale", "lost"), "classes")
    name = classes.schema["name"].dataType.simpleString()
    stripes = max(LEAST_STRIPES, ceil(classes.count() / stripe))
    linked = scratch.write(_tiled(classes, stripes).groupBy("dim", "i", "j").applyInArrow(_tile(threshold, dtype), f"name {name}, n long, boss {name}"), "linked")
    found = components(linked, "name", "boss")
    counted = classes.select("name", "raw", "copies").join(linked.groupBy("name").agg(F.sum("n").alias("n")), "name", "left").join(found.withColumnRenamed("node", "name"), "name", "left")
    counted = scratch.write(counted.select("raw", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n"), F.coalesce("component", "name")["vec"].alias("least")), "counted")
    scratch.clear("classes", "linked")
    # two written tables, so that Spark splits the rows of a vector that very many have
    out = usable.select("vec", "raw").join(counted, "raw").select("vec", "n", "least")
    out = out.unionByName(others.select("vec", F.lit(0).cast("long").alias("n"), F.col("vec").alias("least")))
    return out.select(F.col("vec").alias(key), F.col("n").alias("n_links"), F.col("least").alias("component_id"), F.coalesce(F.col("least") == F.col("vec"), F.lit(True)).alias("kept"))


def _codes(dtype: type):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, codes = [None] * batch.num_rows, [None] * batch.num_rows
            scale, lost = [None] * batch.num_rows, [None] * batch.num_rows
            lengths = batch.column(1).value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            for dim in np.unique(lengths[lengths > 0]):
                at = np.nonzero(lengths == dim)[0]
                # zeros of either sign are the same component
                x = batch.column(1).take(pa.array(at)).flatten().to_numpy(zero_copy_only=False).astype(dtype).reshape(-1, dim) + dtype(0)
                good = np.isfinite(x).all(axis=1) & (x != 0).any(axis=1)
                at, x = at[good], np.ascontiguousarray(x[good])
                if len(at):
                    for k, a, b, c, d in zip(at, x, *quantise(x.astype(np.float64)), strict=True):
                        raw[k], codes[k], scale[k], lost[k] = a.tobytes(), b.tobytes(), c, d
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(raw, pa.binary()), pa.array(codes, pa.binary()), pa.array(scale, pa.float64()), pa.array(lost, pa.float64())], ["vec", "raw", "codes", "scale", "lost"])

    return run


def _tiled(classes: DataFrame, stripes: int) -> DataFrame:
    """Each class once for every tile that its stripe is a side of."""
    own = classes.withColumn("stripe", F.pmod(F.xxhash64("raw"), F.lit(stripes)).cast("int"))
    sides = own.withColumn("other", F.explode(F.sequence(F.lit(0), F.lit(stripes - 1))))
    sides = sides.select("name", "raw", "codes", "scale", "lost", "copies", F.length("raw").alias("dim"), F.least("stripe", "other").alias("i"), F.greatest("stripe", "other").alias("j"), (F.col("stripe") > F.col("other")).cast("int").alias("side"))
    return sides.repartition(stripes * (stripes + 1) // 2, "dim", "i", "j")
