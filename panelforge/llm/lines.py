"""Line dedup by a log-template tree.

Every line is parsed to a fixed depth: first by its number of tokens, then by
its leading tokens, tokens with a digit in them being variable fields.  Within
such a leaf the line seen in most places is the template; lines that agree
with it in enough positions are instances of it, and the positions where they
differ are its variable fields.  A leaf may hold further templates: of the
other lines, tokens that few places have in their position are variable, and
lines that are equal without them are instances of one.  A template that recurs
across documents is boilerplate, and its lines are dropped from all of them.

Copies of a document are no evidence that its lines are boilerplate (they are
the business of the near-duplicate operator).  Documents with the same set of
templates are one group, however many they are.  A group is evidence if it has
something to say besides the candidates: of its other lines, more are new than
are variants of candidates.  A variant has three tokens in a row in common with
a candidate, at the same place from the beginning or from the end; the edited
lines of a near copy are such, as all its lines are another document's.  A
template recurs if ``MIN_FAMILIES`` groups or more that are evidence hold it.
No share enters, neither of a document's lines nor of the documents that hold a
template: a page of ten shared lines and one of its own is evidence for the
ten, and copies never save a line from being dropped.

All of it is DataFrame work.  Only hashes are exploded and shuffled; a line
that a third of all documents hold is spread over its groups first and meets
only as partial counts.  The text itself is shuffled once, to meet the lines
to be dropped from it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelforge.llm.common import sized, written

#: Leading tokens that the tree branches on.
DEPTH = 3
#: Lines of fewer tokens are never dropped; in scripts without spaces every character counts as one.
MIN_TOKENS = 3
_UNSPACED = r"[\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsThai}\p{IsLao}\p{IsKhmer}\p{IsMyanmar}]"
MIN_FAMILIES = 6
#: Tokens of a line that, at the same place, make it a variant of another.
ANCHOR = 3
#: Share of equal positions after the leading ones that makes a line an instance of its leaf's template.
SIMILAR = 0.7


def _template(line: Column) -> Column:
    """The line's tokens with one space between them, variable ones masked."""
    masked = F.when(line.rlike("[0-9]"), F.regexp_replace(line, r"[^\x20\x09-\x0D0-9]*+[0-9][^\x20\x09-\x0D]*+", "<*>")).otherwise(line)
    # most lines have single spaces only, and are not rewritten
    uneven = F.contains(masked, F.lit("  ")) | masked.startswith(" ") | masked.endswith(" ") | masked.rlike(r"[\x09-\x0D]")
    return F.when(uneven, F.trim(F.regexp_replace(masked, r"[\x20\x09-\x0D]++", " "))).otherwise(masked)


def _tokens(template: Column) -> Column:
    return F.length(template) - F.length(F.replace(template, F.lit(" "))) + 1


def _enough(template: Column, n: Column) -> Column:
    """Whether a line with ``n`` tokens is long enough to be dropped."""
    return (n >= MIN_TOKENS) | (F.regexp_count(template, F.lit(_UNSPACED)) >= MIN_TOKENS)


def _leaf(template: Column, n: Column) -> Column:
    return F.xxhash64(n, F.substring_index(template, " ", DEPTH))


def _let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once."""
    return F.transform(F.array(value), use)[0]


def _hash(line: Column) -> Column:
    """The hash of a line's template; null for a short line."""
    return _let(_template(line), lambda x: F.when(_enough(x, _tokens(x)), F.xxhash64(x)))


def _anchors(template: Column, n: Column) -> Column:
    """Hashes of a line's first and last tokens and of those next to them; of a line that is too short for that, of its first and last half."""

    def ends(size: int) -> list[Column]:
        return [F.substring_index(template, " ", size), F.substring_index(template, " ", -size)]

    inner = [F.substring_index(F.substring_index(template, " ", sign * 2 * ANCHOR), " ", -sign * ANCHOR) for sign in (1, -1)]
    long = F.array(*[F.xxhash64(F.lit(k), x) for k, x in enumerate(ends(ANCHOR) + inner)])
    short = [F.array(*[F.xxhash64(n, F.lit(k), x) for k, x in enumerate(ends(max(1, size // 2)))]) for size in range(1, 2 * ANCHOR)]
    return F.when(n >= 2 * ANCHOR, long).otherwise(F.element_at(F.array(*short), F.greatest(F.least(n, F.lit(2 * ANCHOR - 1)), F.lit(1)).cast("int")))


def _parsed(text: Column, shown: bool) -> Column:
    """A text's distinct templates as structs of ``leaf``, ``t`` and ``anchors`` or, if they are to be shown, ``x``, the template itself."""

    def node(line: Column) -> Column:
        return _let(_template(line), lambda x: _let(_tokens(x), lambda n: F.when(_enough(x, n), F.struct(_leaf(x, n).alias("leaf"), F.xxhash64(x).alias("t"), x.alias("x") if shown else _anchors(x, n).alias("anchors")))))

    return F.array_distinct(F.filter(F.transform(F.split(text, "\n"), node), lambda x: x.isNotNull()))


def _nodes(documents: DataFrame) -> DataFrame:
    """``doc_id``, ``leaf``, ``t``, ``anchors`` and the document's group of copies, for every distinct template of every document."""

    def with_group(found: Column) -> Column:
        return F.struct(found.alias("lines"), F.xxhash64(F.array_sort(F.transform(found, lambda x: x["t"]))).alias("group"))

    parsed = documents.select("doc_id", _let(_parsed(F.col("text"), False), with_group).alias("d"))
    return parsed.select("doc_id", "d.group", F.explode("d.lines").alias("x")).select("doc_id", "x.leaf", "x.t", "x.anchors", "group")


def recurring(documents: DataFrame, nodes: DataFrame) -> DataFrame:
    """The hashes ``t`` of all lines whose template recurs across documents."""
    # a leaf that is in too few places holds no template that recurs; nearly all are
    leaves = written(nodes.groupBy("leaf").agg(F.count("*").alias("n")).where(F.col("n") >= MIN_FAMILIES).select("leaf"), "line-leaves")
    often = nodes.join(sized(leaves), "leaf", "left_semi")
    least = F.min("doc_id").alias("doc_id")
    held = often.groupBy("leaf", "t", "group").agg(F.count("*").alias("n"), least)
    seen = written(held.groupBy("leaf", "t").agg(F.count("*").alias("families"), F.sum("n").alias("docs"), least), "line-templates")
    # only a leaf with several lines needs generalising, and one document that holds it shows the text of a line
    several = written(seen.groupBy("leaf").agg(F.sum("families").alias("f"), F.count("*").alias("n")).where((F.col("f") >= MIN_FAMILIES) & (F.col("n") > 1)).select("leaf"), "line-several")
    holders = written(seen.join(sized(several), "leaf", "left_semi").select(F.col("doc_id").alias("__holder")).distinct(), "line-holders")
    shown = documents.join(sized(holders), documents["doc_id"].eqNullSafe(F.col("__holder")), "left_semi")
    shapes = shown.select(F.explode(_parsed(F.col("text"), True)).alias("x")).select("x.*").join(sized(several), "leaf", "left_semi").groupBy("leaf", "t").agg(F.min("x").alias("x"))
    shapes = written(seen.drop("doc_id").join(shapes, ["leaf", "t"]).withColumn("tokens", F.split("x", " ")).drop("x"), "line-shapes")
    # a leaf with very many lines is one row here, so its lines stay where they are
    top = shapes.groupBy("leaf").agg(F.max(F.struct("families", "docs", "t", "tokens")).alias("top")).select("leaf", F.col("top.t").alias("of"), F.col("top.tokens").alias("template"))
    top = sized(written(top, "line-tops"), 200_000)
    agree = F.aggregate(F.zip_with("tokens", "template", lambda a, b: (a == b).cast("int")), F.lit(0), lambda n, x: n + x)
    first = agree - DEPTH >= SIMILAR * (F.size("tokens") - DEPTH)
    tree = written(shapes.join(top, "leaf").select("leaf", "t", "families", "tokens", F.when(first, F.col("of")).alias("template")), "line-tree")
    further = _further(tree.where(F.col("template").isNull()))
    tree = tree.join(further, ["leaf", "t"], "left").select("leaf", "t", "families", F.coalesce("template", "other", "t").alias("template"))
    tree = written(tree, "line-trees")
    merged = written(tree.groupBy("leaf", "template").agg(F.sum("families").alias("families")).where(F.col("families") >= MIN_FAMILIES).select("leaf", "template"), "line-merged")
    general = tree.select("leaf", "t", "template").join(sized(merged), ["leaf", "template"], "left_semi").select("t", "template")
    alone = seen.where(F.col("families") >= MIN_FAMILIES).select("t", F.col("t").alias("template"))
    return _evident(nodes, written(alone.unionByName(general).distinct(), "line-candidates"))


def _further(lines: DataFrame) -> DataFrame:
    """``other``, a template by the tokens that are frequent in their positions, for lines ``t`` of a ``leaf`` that have enough of these."""
    cells = lines.select("leaf", "t", "families", F.size("tokens").alias("n"), F.posexplode("tokens").alias("at", "token")).where(F.col("at") >= DEPTH)
    fixed = written(cells.groupBy("leaf", "at", "token").agg(F.sum("families").alias("seen")).where(F.col("seen") >= MIN_FAMILIES).drop("seen"), "line-fixed")
    masks = cells.join(sized(fixed), ["leaf", "at", "token"]).groupBy("leaf", "t", "n").agg(F.sort_array(F.collect_list(F.struct("at", "token"))).alias("mask"))
    return masks.where(F.size("mask") >= SIMILAR * (F.col("n") - DEPTH)).select("leaf", "t", F.xxhash64("leaf", F.to_json("mask")).alias("other"))


def _evident(nodes: DataFrame, candidates: DataFrame) -> DataFrame:
    """The ``t`` of those ``candidates`` (``t``, ``template``) whose template is in enough groups that are evidence."""
    known = sized(written(candidates.select("t").distinct(), "line-known"))
    found = written(nodes.join(known, "t", "left_semi").groupBy("t", "group").agg(F.min("doc_id").alias("doc_id"), F.first("anchors").alias("anchors")), "line-found")
    # one document of each group shows what else the group says
    holders = written(found.groupBy("group").agg(F.min("doc_id").alias("__holder")), "line-groups").withColumnRenamed("group", "__group")
    others = nodes.join(sized(holders), (F.col("group") == F.col("__group")) & F.col("doc_id").eqNullSafe(F.col("__holder")), "left_semi").join(known, "t", "left_anti")
    anchors = written(found.groupBy("t").agg(F.first("anchors").alias("anchors")).select(F.explode("anchors").alias("anchor")).distinct(), "line-anchors")
    met = others.select("group", "t", F.explode("anchors").alias("anchor")).join(sized(anchors.withColumn("met", F.lit(1))), "anchor", "left")
    other = met.groupBy("group", "t").agg(F.max(F.coalesce("met", F.lit(0))).alias("met"))
    evident = written(other.groupBy("group").agg(F.sum("met").alias("variants"), F.count("*").alias("n")).where(F.col("n") > 2 * F.col("variants")).select("group"), "line-evident")
    places = found.select("t", "group").join(sized(evident), "group", "left_semi").join(sized(candidates), "t")
    enough = places.groupBy("template", "group").agg(F.count("*").alias("n")).groupBy("template").agg(F.count("*").alias("n")).where(F.col("n") >= MIN_FAMILIES)
    return written(candidates.join(enough, "template", "left_semi").select("t").distinct(), "line-recurring")


def dedup(documents: DataFrame) -> DataFrame:
    """``documents`` with the lines of recurring templates taken out of ``text``, and ``n_lines`` and ``n_dropped`` (long) added.

    Lines end at ``\\n``; an empty text is one empty line, a null text stays
    null and has none.  Lines of under ``MIN_TOKENS`` tokens stay.  A text
    all of whose lines go becomes empty; no row is ever dropped.  Rows with a
    null or a repeated ``doc_id`` are treated like others.  Columns other than
    ``doc_id`` and ``text`` pass through, but for ones named ``n_lines`` or
    ``n_dropped`` in any case, which are replaced.
    """
    nodes = written(_nodes(documents), "line-nodes")
    found = nodes.select("doc_id", "t").join(sized(recurring(documents, nodes)), "t", "left_semi")
    drops = found.groupBy("doc_id").agg(F.collect_set("t").alias("__drop")).withColumnRenamed("doc_id", "__id")
    rows = documents.join(drops, documents["doc_id"].eqNullSafe(F.col("__id")), "left").drop("__id")
    kept = F.filter(F.split("text", "\n"), lambda x: ~F.coalesce(F.array_contains(F.col("__drop"), _hash(x)), F.lit(False)))
    less = F.when(F.col("__drop").isNotNull(), _let(kept, lambda k: F.struct(F.array_join(k, "\n").alias("text"), F.size(k).alias("n"))))
    all_lines = F.length("text") - F.length(F.replace("text", F.lit("\n"))) + 1
    rows = rows.withColumn("__all", F.coalesce(all_lines, F.lit(0))).withColumn("__less", less)
    others = [c for c in documents.columns if c.lower() not in ("n_lines", "n_dropped")]
    text = F.coalesce(F.col("__less.text"), F.col("text")).alias("text")
    return rows.select(*[text if c == "text" else F.col(c) for c in others], F.col("__all").cast("long").alias("n_lines"), F.coalesce(F.col("__all") - F.col("__less.n"), F.lit(0)).cast("long").alias("n_dropped"))
