"""N-gram Jaccard join through a token-group matrix.

A document is the set of its 5-word shingles, as 64-bit hashes (tokens).  Two
sets link at a Jaccard similarity of 0.75 or more; the result is each
document's component under these links.

1.  *Sets.*  Equal sets are one class from here on, with the least document
    as its representative.
2.  *Groups.*  Representatives that meet in a band of min-hashes are compared
    with one leader of the bucket, the one that has most company over all its
    bands.  Links found are exact, and their components are the groups: a
    thousand near copies of one text become one group after a thousand
    comparisons, not half a million.
3.  *Token-group matrix.*  A row (token, group) says that the group's token
    union has the token, with the sizes of the members that have it.  Of each
    set only the prefix that any partner must share a token with is entered,
    in one order of tokens for all: those that a sample shows in many sets
    come last.  With every entry goes the greatest size of a partner whose
    first common token it can be (the common tokens are from here on only).
    Of two sets that link, the smaller one's first common token stands where
    this limit is no less than its own size; so the matrix is joined with
    those entries only, and on (token, size class).  A passage in nearly all
    of a million documents reaches these entries only in documents that
    consist of it to six sevenths and so link with one another.
4.  *Bound.*  Pairs of groups that share an entry, within the limits, are
    candidates.  Two documents must also be close by the parity bitmaps of
    their sets, whose distance is never more than the sets'.
5.  *Opening.*  Two documents are compared exactly.  A larger group is stored
    as its token union, in blocks, and queried by the members of the other:
    a query that shares too few tokens with the union is passed over, and
    only then the members are counted.

No link between different texts is lost: two linked documents either are in
one group, or their groups share an entry within the limits.  The order of
tokens, the sample, the leaders, the bitmaps and the spreading of frequent
tokens over several keys only decide how much work it is.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelforge.llm.common import Scratch, fitting, lower_ascii, sized
from panelforge.llm.components import components

SHINGLE, PERCENT = 5, 75
BANDS, ROWS = 8, 2
#: One set in so many shows its tokens; those seen so often in the sample come last in the order, up to so many of them.
SAMPLE, SEEN, HOT_TOKENS = 16, 3, 2_000_000
#: Entries of a frequent token that stay under one key, as far as the sample tells; more are spread over several.
SPREAD = 20_000
#: Most bytes of document keys that are broadcast to pick texts; more are joined by a shuffle.
BROADCAST_BYTES = 1 << 26
#: Documents that meet one copy of another's set; a set that more are compared with is copied.
CROWD = 500
#: Groups of several members are opened in blocks of about so many tokens.
BLOCK_TOKENS = 400_000
#: Least number of 64-bit words of a set's parity bitmap, which has a bit a token or more.
WORDS = 8
#: Members of a group up to which a query is tried against their bitmaps before the group's union.
FEW_MEMBERS = 8

_SLICE = 64
_U = np.uint64
_rng = np.random.default_rng(20240607)
_BYTE = _rng.integers(1, 2**63, 256, dtype=np.uint64) * _U(2) + _U(1)
_BASE = 0x9E3779B97F4A7C15
_BACK = pow(_BASE, -1, 2**64)
_STEP = _rng.integers(1, 2**63, SHINGLE, dtype=np.uint64) * _U(2) + _U(1)
_FLIP = _rng.integers(1, 2**63, (BANDS * ROWS, 1), dtype=np.uint64)
_TURN = _rng.integers(1, 2**63, (BANDS * ROWS, 1), dtype=np.uint64) * _U(2) + _U(1)
_A, _B = (_rng.integers(1, 2**63, 2, dtype=np.uint64) * _U(2) + _U(1)).tolist()
_A, _B = _U(_A), _U(_B)
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_powers: tuple[np.ndarray, np.ndarray] = (np.ones(1, np.uint64), np.ones(1, np.uint64))


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2^64, for n bytes or more."""
    global _powers
    if len(_powers[0]) < n:
        size = 1 << n.bit_length()
        made = []
        for base in (_BASE, _BACK):
            x = np.full(size, _U(base))
            x[0] = 1
            made.append(np.cumprod(x))
        _powers = (made[0], made[1])
    return _powers


def shingle_sets(texts: list[str | None]) -> list[np.ndarray]:
    """Each text's distinct shingles as sorted 64-bit hashes; under five words the whole sequence is one, without words none."""
    parts = [lower_ascii(t) if t else b"" for t in texts]
    data = np.frombuffer(b" " + b" ".join(parts) + b" ", np.uint8)
    inside = ~_SPACE[data]
    edge = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    start, stop = edge[::2], edge[1::2]
    up, down = _power(len(data))
    upto = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_BYTE[data] * up[: len(data)])])
    word = _mix((upto[stop] - upto[start]) * down[start])
    first = np.searchsorted(start, np.cumsum([1, *(len(p) + 1 for p in parts)]))
    terms = [word * s for s in _STEP]
    n = len(word)
    five = _mix(sum((terms[k][k : n - SHINGLE + 1 + k] for k in range(1, SHINGLE)), terms[0][: n - SHINGLE + 1].copy())) if n >= SHINGLE else word[:0]
    out = []
    for a, b in zip(first[:-1], first[1:], strict=True):
        if b - a >= SHINGLE:
            out.append(np.unique(five[a : b - SHINGLE + 1]))
        elif b > a:
            whole = sum((terms[k][a + k] for k in range(1, b - a)), terms[0][a]) + _U(b - a)
            out.append(_mix(np.array([whole], np.uint64)))
        else:
            out.append(word[:0])
    return out


def _least_overlap(n: int) -> int:
    """Tokens that any partner shares with a set of n."""
    return -(-PERCENT * n // 100)


def similar(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether 100 |a and b| >= 75 |a or b| for two sorted sets."""
    if len(a) > len(b):
        a, b = b, a
    if not len(a) or 100 * len(a) < PERCENT * len(b):
        return False
    at = np.searchsorted(b, a)
    both = int((b[np.minimum(at, len(b) - 1)] == a).sum())
    return 100 * both >= PERCENT * (len(a) + len(b) - both)


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    with np.errstate(over="ignore"):
        for batch in batches:
            for at in range(0, batch.num_rows, _SLICE):
                part = batch.slice(at, _SLICE)
                yield part, shingle_sets(part.column(1).to_pylist())


def _sign(s: np.ndarray) -> tuple[int, int]:
    with np.errstate(over="ignore"):
        x = _mix(s + _U(0x9E3779B97F4A7C15))
        return int(x.sum().view(np.int64)), int(np.bitwise_xor.reduce(_mix(x), initial=_U(len(s))).view(np.int64))


def bitmap(s: np.ndarray) -> np.ndarray:
    """Parities of the numbers of tokens by their low bits: sets that differ in d tokens have bitmaps that differ in d bits at most.

    The size is a power of two; a bitmap of half the size is the halves of this one, added bit by bit.
    """
    bits = max(64 * WORDS, 1 << (len(s) - 1).bit_length())
    return np.packbits(np.bincount(_mix(s) & _U(bits - 1), minlength=bits).astype(np.uint8) & 1, bitorder="little").view(np.int64)


def _signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part, sets in _slices(batches):
        signs = [_sign(s) for s in sets]
        bands, tokens = [], []
        for s, (sign, _) in zip(sets, signs, strict=True):
            if len(s):
                with np.errstate(over="ignore"):
                    low = ((s ^ _FLIP) * _TURN).min(1).reshape(BANDS, ROWS)
                    bands.append(_mix(low[:, 0] * _U(3) + low[:, 1] + np.arange(BANDS, dtype=np.uint64)).view(np.int64).tolist())
            else:
                bands.append([])
            tokens.append(s.tobytes() if sign % SAMPLE == 0 else None)
        maps = [bitmap(s) if len(s) else s.view(np.int64) for s in sets]
        bits = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, maps)]), pa.int32()), pa.array(np.concatenate(maps)))
        out = [part.column(0), pa.array(map(len, sets), pa.int64()), pa.array([x for x, _ in signs], pa.int64()), pa.array([y for _, y in signs], pa.int64()), pa.array(bands, pa.list_(pa.int64())), bits, pa.array(tokens, pa.binary())]
        yield pa.RecordBatch.from_arrays(out, ["doc_id", "n", "s1", "s2", "bands", "bits", "tokens"])


def _unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for x in batch.column(0):
            yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(x.as_py(), np.int64))], ["token"])


def entries(s: np.ndarray, sign: int, hot: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The matrix entries of one set: keys, limits (the greatest size of a partner), and whether the entry asks or only answers.

    ``hot`` are the frequent tokens, sorted, and ``keys`` the numbers of keys
    each is spread over: an entry asks under one of them and answers under
    all.  An entry answers if its limit is the set's own size or more, then
    in all size classes up to the limit's.
    """
    n = len(s)
    count = n - _least_overlap(n) + 1
    times = None
    if len(hot):
        at = np.minimum(np.searchsorted(hot, s), len(hot) - 1)
        late = hot[at] == s
        first = np.argsort(late, kind="stable")[:count]
        s, times = s[first], np.where(late[first], keys[at[first]], 1)
    s = s[:count]
    limit = (100 + PERCENT) * (n - np.arange(count)) // PERCENT - n
    size = n.bit_length()
    with np.errstate(over="ignore"):
        token, asks = s + _U(size) * _A, np.ones(count, bool)
        further = limit >= 1 << size
        parts = [(token, limit, asks), ((s + _U(size + 1) * _A)[further], limit[further], ~asks[further])]
        if times is not None and (times > 1).any():
            spread = []
            for (t, u, q), k in zip(parts, (times, times[further]), strict=True):
                own = _U(sign % 2**64) % k.astype(np.uint64)
                spread.append((t + own * _B, u, q))
                answers = np.flatnonzero((k > 1) & (u >= n))
                for other in answers:
                    x = np.setdiff1d(np.arange(k[other], dtype=np.uint64), own[other : other + 1])
                    spread.append((t[other] + x * _B, np.repeat(u[other], len(x)), np.zeros(len(x), bool)))
            parts = spread
        return tuple(np.concatenate(x) for x in zip(*[(_mix(t), u, q) for t, u, q in parts], strict=True))


def _prefixes(hot, keys):
    """(key, s1, about) for the entries of each set; within a task equal sets are entered once.

    ``about`` holds the set's size, the limit and whether the entry asks, in one number that is greatest for the entry that says most.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, spread, entered = hot.value, keys.value, set()
        for _, sets in _slices(batches):
            made, signs, sizes = [], [], []
            for s in sets:
                if not len(s) or (sign := _sign(s)[0]) in entered:
                    continue
                if len(entered) < 100_000:
                    entered.add(sign)
                made.append(entries(s, sign, last, spread))
                signs.append(sign)
                sizes.append(len(s))
            if made:
                key, limit, asks = (np.concatenate(x) for x in zip(*made, strict=True))
                count = [len(x) for x, _, _ in made]
                about = (np.repeat(np.array(sizes, np.int64), count) << 32) + (limit.astype(np.int64) << 1) + asks
                yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(np.repeat(np.array(signs, np.int64), count)), pa.array(about)], ["key", "s1", "about"])

    return run


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part, sets in _slices(batches):
        yield pa.RecordBatch.from_arrays([part.column(0), pa.array([s.tobytes() for s in sets], pa.binary())], ["doc_id", "tokens"])


def _compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        a, b = batch.column(2), batch.column(3)
        keep = [similar(np.frombuffer(a[k].as_buffer(), np.uint64), np.frombuffer(b[k].as_buffer(), np.uint64)) for k in range(batch.num_rows)]
        yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))


def _type(documents: DataFrame) -> str:
    return documents.schema["doc_id"].dataType.simpleString()


def _sets(documents: DataFrame, needed: DataFrame) -> DataFrame:
    """``doc_id`` and ``tokens`` of the documents whose keys are needed; ``needed`` is a written table of distinct keys."""
    texts = documents.join(fitting(needed, BROADCAST_BYTES), "doc_id", "left_semi")
    return texts.mapInArrow(_packed, f"doc_id {_type(documents)}, tokens binary").groupBy("doc_id").agg(F.min("tokens").alias("tokens"))


def _links(documents: DataFrame, pairs: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """Those of the pairs (a, b) of document keys whose sets are similar."""
    both = pairs = scratch.write(pairs, name)
    for c, other in (("a", "b"), ("b", "a")):
        met = scratch.write(pairs.groupBy(F.col(c).alias("doc_id")).agg(F.count("*").alias("n")), f"{name}-{c}")
        sets = _sets(documents, met.select("doc_id")).select(F.col("doc_id").alias(c), F.col("tokens").alias(f"of_{c}"))
        both = _dealt(both, sets, c, other, met.where(F.col("n") > CROWD).select(F.col("doc_id").alias(c), F.ceil(F.col("n") / CROWD).cast("int").alias("copies")))
    return both.select("a", "b", "of_a", "of_b").mapInArrow(_compared, f"a {_type(documents)}, b {_type(documents)}")


def _dealt(rows: DataFrame, sets: DataFrame, c: str, other: str, crowded: DataFrame) -> DataFrame:
    """``rows`` joined with the sets of their column ``c``; a set that very many rows meet is copied, and they are dealt over its copies.

    Spark splits no partition of a join with an aggregate, as these sets are.
    """
    if crowded.isEmpty():
        return rows.join(sets, c)
    crowded = sized(crowded)
    few = rows.join(crowded, c, "left_anti").join(sets, c)
    copies = sets.join(crowded, c).withColumn("copy", F.explode(F.sequence(F.lit(0), F.col("copies") - 1))).drop("copies")
    many = rows.join(crowded, c).withColumn("copy", F.pmod(F.xxhash64(other), F.col("copies")).cast("int")).drop("copies").join(copies, [c, "copy"]).drop("copy")
    return few.unionByName(many)


def _sizes_allow(small: Column, large: Column) -> Column:
    return 100 * small >= PERCENT * large


def _leaders(reps: DataFrame, scratch: Scratch) -> DataFrame:
    """Pairs of each representative with the leaders of its buckets."""
    rows = scratch.write(reps.select("doc_id", "n", F.explode("bands").alias("band")), "bands")
    size = scratch.write(rows.groupBy("band").agg(F.count("*").alias("size")).where("size > 1"), "buckets")
    met = scratch.write(rows.join(sized(size), "band"), "met")
    company = met.groupBy("doc_id").agg(F.sum("size").alias("company"))
    met = scratch.write(met.join(company, "doc_id").select("band", "doc_id", "n", "company"), "company")
    leader = met.groupBy("band").agg(F.min_by(F.struct("doc_id", "n"), F.struct(-F.col("company"), "doc_id")).alias("top")).select("band", F.col("top.doc_id").alias("b"), F.col("top.n").alias("m"))
    pairs = met.join(sized(scratch.write(leader, "leaders")), "band").where(F.col("doc_id") != F.col("b")).where(_sizes_allow(F.least("n", "m"), F.greatest("n", "m")))
    return pairs.select(F.col("doc_id").alias("a"), "b").distinct()


def candidates(prefixes: DataFrame, members: DataFrame, scratch: Scratch) -> DataFrame:
    """Pairs (g1, g2) of groups that share an entry of the matrix within its limits."""
    # keys that hold one set only, or none that answers, go before anything is joined; nearly all do
    rows = prefixes.repartition("key").groupBy("key", "s1").agg(F.max("about").alias("about"))
    about = F.col("about")
    rows = rows.select("key", "s1", F.shiftright(about, 32).alias("n"), F.shiftright(about.bitwiseAND(F.lit(2**32 - 1)), 1).alias("most"), (about.bitwiseAND(F.lit(1)) == 1).alias("asks"))
    of_key = Window.partitionBy("key")
    rows = rows.withColumns({"k": F.count("*").over(of_key), "answered": F.max(F.col("most") >= F.col("n")).over(of_key)}).where("k > 1 AND answered").select("key", "s1", "n", "most", "asks")
    asks, answers = F.col("asks"), F.col("most") >= F.col("n")
    matrix = rows.join(members.select("s1", "g"), "s1").groupBy("key", "g").agg(
        F.min(F.when(asks, F.col("n"))).alias("least_asked"), F.max(F.when(asks, F.col("n"))).alias("most_asked"), F.max(F.when(asks, F.col("most"))).alias("asked_limit"),
        F.min(F.when(answers, F.col("n"))).alias("least"), F.max(F.when(answers, F.col("most"))).alias("limit"),
    )
    matrix = scratch.write(matrix, "matrix")
    x = matrix.where("least_asked IS NOT NULL").select("key", F.col("g").alias("g1"), "least_asked", "most_asked", "asked_limit")
    y = matrix.where("least IS NOT NULL").select("key", F.col("g").alias("g2"), "least", "limit")
    # the one that asks is no smaller: least size that answers <= size that asks <= limit that answers, and the answer's size within the limit that asks
    within = (F.col("least") <= F.col("most_asked")) & (F.col("least_asked") <= F.col("limit")) & (F.col("least") <= F.col("asked_limit"))
    return x.join(y, "key").where((F.col("g1") != F.col("g2")) & within).select(F.least("g1", "g2").alias("g1"), F.greatest("g1", "g2").alias("g2")).distinct()


def _close(pairs: DataFrame, reps: DataFrame) -> DataFrame:
    """Those of the pairs (a, b) of documents whose sizes and bitmaps allow a link."""
    own = pairs.columns
    for c in ("a", "b"):
        pairs = pairs.join(reps.select(F.col("doc_id").alias(c), F.col("n").alias(f"n_{c}"), F.col("bits").alias(f"bits_{c}")), c)
    size = F.least(F.size("bits_a"), F.size("bits_b"))

    def folded(c: str) -> Column:
        # sizes that allow a link are a factor of two apart at most
        halves = F.zip_with(F.slice(c, 1, size), F.slice(c, size + 1, size), lambda x, y: x.bitwiseXOR(y))
        return F.when(F.size(c) > size, halves).otherwise(F.col(c))

    apart = F.aggregate(F.zip_with(folded("bits_a"), folded("bits_b"), lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda n, x: n + x)
    # sets that link differ in n_a + n_b - 2 * overlap tokens at most
    bound = (100 + PERCENT) * apart <= (100 - PERCENT) * (F.col("n_a") + F.col("n_b"))
    return pairs.where(_sizes_allow(F.least("n_a", "n_b"), F.greatest("n_a", "n_b"))).where(bound).select(*own)


def _union(block: pd.DataFrame) -> pd.DataFrame:
    """The token union of a block of a group: its members' tokens in order, and which member each is of."""
    sets = [np.frombuffer(t, np.uint64) for t in block["tokens"]]
    every = np.concatenate(sets)
    order = np.argsort(every, kind="stable")
    member = np.repeat(np.arange(len(sets), dtype=np.int32), [len(s) for s in sets])[order]
    return pd.DataFrame({"g": block["g"].iloc[:1], "x": block["x"].iloc[:1], "ids": [list(block["doc_id"])], "union": [every[order].tobytes()], "member": [member.tobytes()]})


def _searched(key: tuple, blocks: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
    """One link of each query to a block of a group, if it has any; a query that shares too little with the block's token union is passed over."""
    found = []
    for ids, union, member in zip(blocks["ids"], blocks["union"], blocks["member"], strict=True):
        union, member = np.frombuffer(union, np.uint64), np.frombuffer(member, np.int32)
        size = np.bincount(member, minlength=len(ids))
        for q, tokens in zip(queries["doc_id"], queries["tokens"], strict=True):
            s = np.frombuffer(tokens, np.uint64)
            low, high = np.searchsorted(union, s), np.searchsorted(union, s, side="right")
            least = max(_least_overlap(len(s)), -(-PERCENT * (len(s) + int(size.min())) // (100 + PERCENT)))
            if (high > low).sum() < least:
                continue
            count = high - low
            hits = np.repeat(low - np.cumsum(count) + count, count) + np.arange(count.sum())
            both = np.bincount(member[hits], minlength=len(ids))
            linked = np.flatnonzero(100 * both >= PERCENT * (len(s) + size - both))
            if len(linked):
                found.append((q, ids[linked[0]]))
    return pd.DataFrame(found, columns=["a", "b"])


def _opened(documents: DataFrame, pairs: DataFrame, members: DataFrame, sizes: DataFrame, reps: DataFrame, scratch: Scratch) -> DataFrame:
    """Links (a, b) between groups of which one has several members.

    The larger one is the group, stored as token unions of blocks of so many
    tokens; the members of the others that qualify are its queries, cut
    likewise.  A task holds one block of each, and gives one link a query at
    most, as a group's members are in one component already.
    """
    g, q = F.when(F.col("k1") >= F.col("k2"), F.col("g1")), F.when(F.col("k1") >= F.col("k2"), F.col("g2"))
    pairs = pairs.select(F.coalesce(g, "g2").alias("g"), F.coalesce(q, "g1").alias("q"))
    asked = pairs.join(members.select(F.col("g").alias("q"), "doc_id", "n"), "q").join(sizes.select("g", "lo", "hi", "k"), "g")
    asked = scratch.write(asked.where(_sizes_allow(F.col("lo"), F.col("n")) & _sizes_allow(F.col("n"), F.col("hi"))).select("g", "doc_id", "n", "k"), "asked")
    # of a small group some member must be close to the query
    few = asked.where(F.col("k") <= FEW_MEMBERS).join(members.select("g", F.col("doc_id").alias("b")), "g").select("g", F.col("doc_id").alias("a"), "n", "b")
    few = _close(few, reps).select("g", F.col("a").alias("doc_id"), "n").distinct()
    asked = scratch.write(asked.where(F.col("k") > FEW_MEMBERS).select("g", "doc_id", "n").unionByName(few), "queries")
    cuts = asked.groupBy("g").agg(F.sum("n").alias("asked")).join(sizes.select("g", "tokens"), "g")
    cuts = scratch.write(cuts.select("g", *[F.ceil(F.col(c) / BLOCK_TOKENS).cast("int").alias(f"cut_{c}") for c in ("asked", "tokens")]), "cuts")

    def place(cut: str) -> Column:
        return F.pmod(F.xxhash64("doc_id"), F.col(cut)).cast("int")

    def every(cut: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.col(cut) - 1))

    kind = _type(documents)
    held = scratch.write(members.select("g", "doc_id").join(cuts, "g").select("g", "doc_id", place("cut_tokens").alias("x")), "held")
    sets = _sets(documents, scratch.write(held.select("doc_id").distinct(), "held-keys"))
    unions = held.join(sets, "doc_id").groupBy("g", "x").applyInPandas(_union, f"g {kind}, x int, ids array<{kind}>, union binary, member binary")
    unions = scratch.write(unions, "unions").join(cuts, "g").select("g", "x", every("cut_asked").alias("y"), "ids", "union", "member")
    sets = _sets(documents, scratch.write(asked.select("doc_id").distinct(), "query-keys"))
    asked = asked.join(cuts, "g").select("g", "doc_id", place("cut_asked").alias("y"), every("cut_tokens").alias("x")).join(sets, "doc_id")
    return unions.groupBy("g", "x", "y").cogroup(asked.select("g", "x", "y", "doc_id", "tokens").groupBy("g", "x", "y")).applyInPandas(_searched, f"a {kind}, b {kind}")


def join(documents: DataFrame) -> DataFrame:
    """``doc_id``, ``n_shingles`` and ``component_id`` (the least document that links reach, itself included) for every document.

    A null or empty text, or one without words, has no shingles and is linked
    with nothing.  A null ``doc_id`` gets a null component.  Repeated rows
    stay repeated.  ``doc_id`` may be of any type that has an order and is
    meant to be a key: if rows with one key have different texts, one of these
    stands for the key when it is compared, and the texts are in one
    component.  Other columns are ignored.
    """
    spark, scratch = documents.sparkSession, Scratch(documents.sparkSession, "jaccard")
    docs = documents.select("doc_id", "text")
    key = _type(documents)
    signed = scratch.write(docs.mapInArrow(_signed, f"doc_id {key}, n long, s1 long, s2 long, bands array<long>, bits array<long>, tokens binary"), "signed")
    reps = signed.where("n > 0 AND doc_id IS NOT NULL").groupBy("s1", "s2", "n").agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("copies"), F.min("bands").alias("bands"), F.min("bits").alias("bits"))
    reps = scratch.write(reps, "reps")

    seen = signed.where("tokens IS NOT NULL AND n > 0").groupBy("s1", "s2").agg(F.min("tokens").alias("tokens")).select("tokens")
    often = seen.mapInArrow(_unpacked, "token long").groupBy("token").agg(F.count("*").alias("k")).where(F.col("k") >= SEEN)
    often = often.orderBy(F.desc("k"), "token").limit(HOT_TOKENS).toPandas()
    tokens = often["token"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(tokens)
    hot = spark.sparkContext.broadcast(tokens[order])
    keys = spark.sparkContext.broadcast((1 + often["k"].to_numpy(np.int64) * SAMPLE // SPREAD)[order])

    near = scratch.write(components(_links(docs, _close(_leaders(reps, scratch), reps), scratch, "near")), "groups")
    scratch.clear("bands", "buckets", "met", "company", "leaders", "near", "near-a", "near-b")
    members = reps.join(near, reps["doc_id"] == near["node"], "left").select("doc_id", "s1", "n", F.coalesce("component", "doc_id").alias("g"))
    members = scratch.write(members, "members")
    groups = scratch.write(members.groupBy("g").agg(F.min("n").alias("lo"), F.max("n").alias("hi"), F.sum("n").alias("tokens"), F.count("*").alias("k")), "sizes")
    pairs = candidates(docs.mapInArrow(_prefixes(hot, keys), "key long, s1 long, about long"), members, scratch)
    for i in (1, 2):
        pairs = pairs.join(groups.select(F.col("g").alias(f"g{i}"), F.col("k").alias(f"k{i}")), f"g{i}")
    pairs = scratch.write(pairs, "candidates")
    scratch.clear("matrix")
    alone = (F.col("k1") == 1) & (F.col("k2") == 1)
    single = _close(pairs.where(alone).select(F.col("g1").alias("a"), F.col("g2").alias("b")), reps)
    found = _links(docs, single, scratch, "single").unionByName(_opened(docs, pairs.where(~alone), members, groups, reps, scratch))
    of = members.select("doc_id", "g")
    far = found.join(of.withColumnsRenamed({"doc_id": "a", "g": "x"}), "a").join(of.withColumnsRenamed({"doc_id": "b", "g": "y"}), "b").select(F.col("x").alias("a"), F.col("y").alias("b"))
    joined = scratch.write(components(far), "joined")
    final = members.join(joined, members["g"] == joined["node"], "left").select("doc_id", F.coalesce("component", "g").alias("component_id"))
    # only classes that say more than "alone" are joined back to the documents
    classes = reps.join(final, "doc_id").where((F.col("copies") > 1) | (F.col("component_id") != F.col("doc_id"))).select("s1", "s2", "n", "component_id")
    classes = scratch.write(classes, "classes")
    scratch.clear("reps", "groups", "members", "sizes", "candidates", "single", "single-a", "single-b", "asked", "queries", "cuts", "held", "held-keys", "unions", "query-keys", "joined")
    out = signed.join(sized(classes), ["s1", "s2", "n"], "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id"))
