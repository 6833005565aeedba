"""Quality rules: fixed limits, then robust multivariate outliers per language and source.

Every whole text is counted with built-in functions in one narrow stage.  The
documents that pass the fixed limits get a vector of transformed statistics,
and each (language, source) group, each language and the whole table get a
minimum-covariance-determinant estimate of these:

1.  *Starts.*  Medians and median absolute deviations give the centre and the
    scales; the correlations are none, those of the hyperbolic tangents of the
    standardised statistics, or those of their spatial signs.
2.  *Concentration steps.*  Each takes mean and covariance over the share
    ``CORE`` of the group that is nearest under the last estimate, until the
    determinant stops falling.  The covariance is regularised by a fixed
    diagonal, under which the steps still can't raise the determinant.
3.  Of the starts the one with the least determinant is the estimate.
4.  *Shrinkage.*  Centre and covariance of a group of ``n`` documents are
    ``n / (n + TRUST)`` its own and for the rest its language's, which are
    shrunk towards the whole table's alike; to the latter's covariance
    ``WIDE**2 * (FEW / (FEW + n))**2`` is added in all directions.  So a few
    documents are judged mildly and by their language, and no size of a group
    changes the rule.

A document is rejected if its squared Mahalanobis distance is above
``CUTOFF``, a quantile of the chi-square distribution.

All of it is DataFrame work.  A group is never gathered: means and covariances
are partial sums, and quantiles come from counts of narrow bins, so a source
with a third of all rows adds a few hundred rows to a shuffle like any other.
The table of counts is written once (a few numbers a document), as is each
step's table of estimates (a row a group and start), which is broadcast if it
was counted to be small.
"""

from __future__ import annotations

from functools import reduce
from math import erfc, exp, gamma, sqrt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelforge.llm.common import Scratch, written

#: The fixed limits.
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50
#: Statistic and the standard deviation that regularises it: several have no spread at all in most documents.  Each is small enough for its statistic to pass ``CUTOFF`` alone.
FEATURES = {"f_length": 0.05, "f_symbols": 0.35, "f_lines": 0.6, "f_repeats": 0.5, "f_capitals": 0.25}
_NAMES = list(FEATURES)
_P = len(_NAMES)
_CELLS = [(i, j) for i in range(_P) for j in range(i + 1)]


def above(x: float, dimensions: int) -> float:
    """The share of a chi-square distribution that is above ``x``."""
    share = erfc(sqrt(x / 2)) if dimensions % 2 else exp(-x / 2)
    for k in range(2 - dimensions % 2, dimensions, 2):
        share += (x / 2) ** (k / 2) * exp(-x / 2) / gamma(k / 2 + 1)
    return share


def quantile(tail: float, dimensions: int) -> float:
    """What the share ``tail`` of a chi-square distribution is above, by bisection."""
    low, high = 0.0, 1000.0
    for _ in range(200):
        middle = (low + high) / 2
        low, high = (middle, high) if above(middle, dimensions) > tail else (low, middle)
    return (low + high) / 2


#: Share of a group that an estimate rests on, and the factor that makes its covariance that of a normal sample.
CORE = 0.5
CONSISTENCY = CORE / (1 - above(quantile(1 - CORE, _P), _P + 2))
#: Share of a normal sample that is rejected, and the greatest squared distance that is kept.
TAIL = 1e-6
CUTOFF = quantile(TAIL, _P)
#: How much of an estimate is a group's own, and how wide that of a small table is.
TRUST, FEW, WIDE = 200, 20, 2.0
#: A step that lowers the logarithm of the determinant by less is the last.
FALL = 1e-6
#: Share of a start's correlations that is used, which keeps its matrix invertible.
DAMP = 0.95
#: Widths of the bins of statistics and of log(1 + squared distance), and most groups whose estimates are broadcast.
BIN, BIN_DISTANCE = 1 / 64, 1 / 256
GROUPS = 20_000

_SPACE = r"[\x20\x09-\x0D]+"

def _repeats(words: Column) -> Column:
    """How many of the words stand in a 3-word window that is found twice or more."""

    def counted(keys: Column) -> Column:
        # windows that are equal stand side by side once sorted; each sorts with its position
        rows = F.array_sort(F.transform(keys, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        twins = F.transform(F.array(rows), lambda s: F.filter(s, lambda x, k: F.coalesce(x["h"] == F.get(s, k - 1)["h"], F.lit(False)) | F.coalesce(x["h"] == F.get(s, k + 1)["h"], F.lit(False))))[0]
        inside = F.flatten(F.transform(twins, lambda x: F.array(x["i"], x["i"] + 1, x["i"] + 2)))
        return F.when(F.size(F.array_distinct(keys)) == F.size(keys), 0).otherwise(F.size(F.array_distinct(inside)))

    keys = F.transform(F.slice(words, 3, F.greatest(F.size(words) - 2, F.lit(0))), lambda w, i: F.xxhash64(F.get(words, i), F.get(words, i + 1), w))
    return F.transform(F.array(keys), counted)[0]


def counts(documents: DataFrame, keep: list[str]) -> DataFrame:
    """``keep`` columns and the counts of each whole text (null: no words)."""
    text = F.coalesce(documents["text"], F.lit(""))
    words = F.filter(F.split(text, _SPACE), lambda w: w != "")
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    of_words = F.transform(
        F.array(words),
        lambda w: F.struct(F.size(w).cast("long").alias("n_words"), F.length(F.array_join(w, "")).cast("long").alias("word_chars"), F.when(F.size(w) > 3, _repeats(w)).otherwise(0).cast("long").alias("n_repeat_words")),
    )[0]
    of_lines = F.transform(F.array(lines), lambda x: F.struct(F.size(x).cast("long").alias("n_lines"), (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines")))[0]
    rows = documents.select(
        *keep, of_words.alias("w"), F.regexp_count(text, F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"), of_lines.alias("l"),
        F.regexp_count(text, F.lit(r"\p{Lu}")).cast("long").alias("n_capitals"),
    )
    return rows.select(*keep, "w.n_words", "w.word_chars", "n_symbols", "l.n_dup_lines", "w.n_repeat_words", "l.n_lines", "n_capitals")


def _percent(part: str, of: str) -> Column:
    return F.log1p(100 * F.col(part) / F.greatest(F.col(of), F.lit(1)))


def _quantile(rows: DataFrame, by: list[str], value: Column, share: float, width: float) -> DataFrame:
    """Per group the upper edge of the bin of ``width`` where the share of rows is reached; the same on any partitioning."""
    bins = rows.select(*by, F.floor(value / width).cast("long").alias("bin")).groupBy(*by, "bin").agg(F.count("*").alias("n"))
    w = Window.partitionBy(*by)
    counted = bins.withColumn("upto", F.sum("n").over(w.orderBy("bin"))).withColumn("least", share * F.sum("n").over(w))
    return counted.where((F.col("upto") >= F.col("least")) & (F.col("upto") - F.col("n") < F.col("least"))).select(*by, ((F.col("bin") + 1) * width).alias("edge"))


def _long(rows: DataFrame, values: list[Column]) -> DataFrame:
    return rows.select("key", F.posexplode(F.array(*values)).alias("f", "v"))


def _wide(rows: DataFrame, value: str, prefix: str) -> DataFrame:
    return rows.groupBy("key").agg(*[F.max(F.when(F.col("f") == i, F.col(value))).alias(f"{prefix}{i}") for i in range(_P)])


def _joined(rows: DataFrame, table: DataFrame, on: list[str], small: bool) -> DataFrame:
    return rows.join(F.broadcast(table) if small else table, on)


_CENTRE = [f"m{i}" for i in range(_P)]
_COVARIANCE = [f"c{i}_{j}" for i, j in _CELLS]
_FACTOR = [f"l{i}_{j}" for i, j in _CELLS]


def _starts(rows: DataFrame, small: bool, scratch: Scratch) -> DataFrame:
    """``key``, ``start``, centre and covariance of each start."""
    middle = scratch.write(_wide(_quantile(_long(rows, [F.col(c) for c in _NAMES]), ["key", "f"], F.col("v"), 0.5, BIN), "edge", "m"), "median")
    away = [F.abs(F.col(c) - F.col(f"m{i}")) for i, c in enumerate(_NAMES)]
    spread = _wide(_quantile(_long(_joined(rows, middle, ["key"], small), away), ["key", "f"], F.col("v"), 0.5, BIN), "edge", "d")
    scale = [F.sqrt(F.pow(1.4826 * F.col(f"d{i}"), 2) + FEATURES[c] ** 2).alias(f"s{i}") for i, c in enumerate(_NAMES)]
    base = scratch.write(middle.join(spread, "key").select("key", *_CENTRE, *scale), "scale")
    z = [(F.col(c) - F.col(f"m{i}")) / F.col(f"s{i}") for i, c in enumerate(_NAMES)]
    z = _joined(rows, base, ["key"], small).select("key", *[x.alias(f"z{i}") for i, x in enumerate(z)])
    norm = F.greatest(F.sqrt(reduce(Column.__add__, [F.pow(f"z{i}", 2) for i in range(_P)])), F.lit(1e-9))
    alike = z.select("key", *[F.tanh(f"z{i}").alias(f"t{i}") for i in range(_P)], *[(F.col(f"z{i}") / norm).alias(f"u{i}") for i in range(_P)]).groupBy("key")
    alike = alike.agg(*[F.covar_pop(f"t{i}", f"t{j}").alias(f"t{i}_{j}") for i, j in _CELLS], *[F.avg(F.col(f"u{i}") * F.col(f"u{j}")).alias(f"u{i}_{j}") for i, j in _CELLS])

    def covariance(kind: str | None, i: int, j: int) -> Column:
        if i == j:
            shared = F.lit(1.0)
        elif kind is None:
            shared = F.lit(0.0)
        else:
            both = F.sqrt(F.col(f"{kind}{i}_{i}") * F.col(f"{kind}{j}_{j}"))
            shared = F.when(both > 0, DAMP * F.col(f"{kind}{i}_{j}") / both).otherwise(0.0)
        return (shared * F.col(f"s{i}") * F.col(f"s{j}")).alias(f"c{i}_{j}")

    every = [F.struct(F.lit(k).alias("start"), *[covariance(kind, i, j) for i, j in _CELLS]) for k, kind in enumerate((None, "t", "u"))]
    return base.join(alike, "key").select("key", *_CENTRE, F.explode(F.array(*every)).alias("e")).select("key", "e.start", *_CENTRE, *[f"e.{c}" for c in _COVARIANCE])


def _factor(rows: DataFrame) -> DataFrame:
    """Adds the Cholesky factor ``l`` of the covariance ``c``, a column a cell, and ``log_det``."""

    def left(i: int, j: int) -> Column:
        return reduce(Column.__sub__, [F.col(f"l{i}_{k}") * F.col(f"l{j}_{k}") for k in range(j)], F.col(f"c{i}_{j}"))

    for j in range(_P):
        rows = rows.withColumn(f"l{j}_{j}", F.sqrt(left(j, j)))
        rows = rows.withColumns({f"l{i}_{j}": left(i, j) / F.col(f"l{j}_{j}") for i in range(j + 1, _P)})
    return rows.withColumn("log_det", 2 * reduce(Column.__add__, [F.log(f"l{i}_{i}") for i in range(_P)]))


def _distance(rows: DataFrame) -> DataFrame:
    """Adds ``distance``: the squared Mahalanobis distance, by forward substitution."""
    for i, name in enumerate(_NAMES):
        left = F.col(name) - F.col(f"m{i}")
        for k in range(i):
            left = left - F.col(f"l{i}_{k}") * F.col(f"z{k}")
        rows = rows.withColumn(f"z{i}", left / F.col(f"l{i}_{i}"))
    total = sum((F.pow(F.col(f"z{i}"), 2) for i in range(1, _P)), F.pow(F.col("z0"), 2))
    return rows.withColumn("distance", total).drop(*[f"z{i}" for i in range(_P)])


def _concentrated(rows: DataFrame, now: DataFrame, small: bool) -> DataFrame:
    """One step: ``key``, ``start``, ``log_det`` of ``now`` as ``before``, and centre, covariance, factor and ``log_det`` of the core that is nearest under ``now``."""
    # both uses of the distances read the same columns of the estimates, so that these are broadcast once
    by = ["key", "start", "before"]
    near = _distance(_joined(rows, now.select("key", "start", F.col("log_det").alias("before"), *_CENTRE, *_FACTOR), ["key"], small)).select(*by, *_NAMES, F.log1p("distance").alias("d"))
    core = _joined(near, _quantile(near, by, F.col("d"), CORE, BIN_DISTANCE), by, small).where("d <= edge")
    sums = core.groupBy(*by).agg(*[F.avg(c).alias(f"m{i}") for i, c in enumerate(_NAMES)], *[F.covar_pop(_NAMES[i], _NAMES[j]).alias(f"v{i}_{j}") for i, j in _CELLS])
    cells = [(CONSISTENCY * F.col(f"v{i}_{j}") + (FEATURES[_NAMES[i]] ** 2 if i == j else 0.0)).alias(f"c{i}_{j}") for i, j in _CELLS]
    return _factor(sums.select(*by, *_CENTRE, *cells))


def estimates(rows: DataFrame, small: bool = True) -> DataFrame:
    """Centre ``m`` and covariance ``c`` of every ``key`` in ``rows``, which has the columns of ``FEATURES``.

    ``small`` says that the keys are few enough to be broadcast.  The loop
    ends: each step lowers the logarithm of a determinant by ``FALL`` or
    more, and the regularising diagonal bounds it from below.  A step is one
    table, so that the driver plans and broadcasts little for each.
    """
    scratch, fallen = Scratch(rows.sparkSession, "rules-mcd"), []
    now = scratch.write(_factor(_starts(rows, small, scratch)).withColumn("log_det", F.lit(float("inf"))), "step0")
    while not now.isEmpty():
        # a start that fell goes on from its new estimate; the others keep the one before, which is the last that fell
        now = scratch.write(_concentrated(rows, now, small), f"step{len(fallen) + 1}").where(F.col("before") - F.col("log_det") >= FALL)
        fallen.append(now)
    columns = ["key", *_CENTRE, *_COVARIANCE]
    # of a start, the last that fell has the least determinant
    every = reduce(DataFrame.unionByName, [x.select("start", "log_det", *columns) for x in fallen or [now]])
    best = every.groupBy("key").agg(F.min_by(F.struct(*columns[1:]), F.struct("log_det", "start")).alias("b")).select("key", "b.*")
    out = written(best, "rules-estimates")
    scratch.clear("")
    return out


def _shrunk(groups: DataFrame, known: DataFrame) -> DataFrame:
    """``lang``, ``source`` and the estimate by which a group is judged; ``groups`` has the keys and sizes of its three levels."""
    every = groups
    for level in ("own", "of_lang", "of_all"):
        every = every.join(known.select(F.col("key").alias(level), F.struct(*_CENTRE, *_COVARIANCE).alias(f"e_{level}")), level)

    def value(c: str) -> Column:
        wide = WIDE**2 * F.pow(FEW / (FEW + F.col("n_all")), 2) if c in [f"c{i}_{i}" for i in range(_P)] else F.lit(0.0)
        out = F.col(f"e_of_all.{c}") + wide
        for level, n in (("of_lang", "n_lang"), ("own", "n")):
            w = F.col(n) / (F.col(n) + TRUST)
            out = w * F.col(f"e_{level}.{c}") + (1 - w) * out
        return out.alias(c)

    return _factor(every.select("lang", "source", *[value(c) for c in [*_CENTRE, *_COVARIANCE]])).drop("log_det", *_COVARIANCE)


def judge(documents: DataFrame) -> DataFrame:
    """``doc_id``, the counts, ``base_failed``, ``kept`` and ``distance`` for every document.

    Words are ``[^\\x20\\x09-\\x0D]+``.  A null text has no words and fails the
    fixed limits, as do all texts of under ``MIN_WORDS`` words; these have no
    ``distance``.  A null language or source counts as an empty one.  Rows
    are judged one by one, repeated ones too.  Columns other than ``doc_id``,
    ``text``, ``lang`` and ``source`` are ignored.
    """
    group = documents.select("doc_id", F.coalesce("lang", F.lit("")).alias("lang"), F.coalesce("source", F.lit("")).alias("source"), "text")
    rows = counts(group, ["doc_id", "lang", "source"])
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    rows = written(
        rows.select(
            *rows.columns, failed.alias("base_failed"), F.log(F.col("word_chars") / F.greatest(F.col("n_words"), F.lit(1)) + 0.01).alias("f_length"), _percent("n_symbols", "n_words").alias("f_symbols"),
            _percent("n_dup_lines", "n_lines").alias("f_lines"), _percent("n_repeat_words", "n_words").alias("f_repeats"), _percent("n_capitals", "word_chars").alias("f_capitals"),
        ), "rules-counts",
    )
    passed = rows.where(~F.col("base_failed"))
    levels = {"own": F.to_json(F.array("lang", "source")), "of_lang": F.to_json(F.array("lang")), "of_all": F.lit("[]")}
    groups = passed.groupBy("lang", "source").agg(F.count("*").alias("n")).select("*", *[x.alias(name) for name, x in levels.items()])
    groups = groups.withColumn("n_lang", F.sum("n").over(Window.partitionBy("lang")))
    total = groups.groupBy("of_all").agg(F.sum("n").alias("n_all"))
    groups = written(groups.join(total, "of_all"), "rules-groups")
    small = groups.count() <= GROUPS
    known = estimates(passed.select(F.explode(F.array(*levels.values())).alias("key"), *_NAMES), small)
    final = written(_shrunk(groups, known), "rules-final")
    out = _distance(rows.join(F.broadcast(final) if small else final, ["lang", "source"], "left"))
    distance = F.when(~F.col("base_failed"), F.col("distance"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", (~F.col("base_failed") & (distance <= CUTOFF)).alias("kept"), distance.alias("distance"))
