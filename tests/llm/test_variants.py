"""Embedding near duplicates, fill-in-middle and spelling variants against brute force, and their odd cases."""

import hashlib
import random
import re
import zlib
from collections import Counter
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelforge.llm import middle, spelling, vectors

VECTORS = "vec_id long, embedding array<double>, label int"


def brute_links(rows, threshold=0.9):
    """For each row (key, vector) its number of links and the least key of its component."""
    good = [k for k, (key, x) in enumerate(rows) if key is not None and x and all(c is not None and np.isfinite(c) for c in x) and any(x)]
    boss, links = list(range(len(rows))), Counter()

    def find(i):
        while boss[i] != i:
            i = boss[i]
        return i

    for i, j in combinations(good, 2):
        if len(rows[i][1]) == len(rows[j][1]):
            a, b = np.array(rows[i][1]), np.array(rows[j][1])
            a, b = a / abs(a).max(), b / abs(b).max()
            if a @ b / np.sqrt((a @ a) * (b @ b)) >= threshold:
                links.update((i, j))
                boss[find(i)] = find(j)
    least = {}
    for i in good:
        least[find(i)] = min(rows[i][0], least.get(find(i), rows[i][0]))
    return sorted(((key, links[i], least.get(find(i), key)) for i, (key, _) in enumerate(rows)), key=str)


def odd_vectors(seed=1):
    """Groups at all distances around the threshold, copies, multiples, other lengths, and vectors that have no direction."""
    rng, out = np.random.default_rng(seed), []
    for _ in range(12):
        centre = rng.normal(size=16)
        for spread in rng.uniform(0.05, 0.5, size=12):
            out.append(list(centre + spread * np.linalg.norm(centre) / 4 * rng.normal(size=16)))
    out += [out[0], out[0], [5 * c for c in out[7]], [1e-200 * c for c in out[9]], [1e200 * c for c in out[9]], list(rng.normal(size=5)), [1.0, 0.0], [2.0, 0.0], [0.0, -0.0], [], None, [1.0, None], [float("nan"), 1.0], [float("inf"), 1.0]]
    out = [x and [c if c is None else float(c) for c in x] for x in out]
    order = rng.permutation(len(out))
    rows = [(int(k) * 3, out[k]) for k in order] + [(None, out[0]), (None, None), (6, out[20]), (9, out[3])]
    return rows


def found(df, name="vec_id"):
    return sorted(((r[name], r["n_links"], r["component_id"]) for r in df.collect()), key=str)


@pytest.mark.parametrize("stripe", [8192, 7])
def test_vectors_are_linked_as_brute_force_links_them(spark, stripe):
    rows = odd_vectors()
    out = vectors.join(spark.createDataFrame([(*r, 1) for r in rows], VECTORS), stripe=stripe)
    assert found(out) == brute_links(rows) and sum(n for _, n, _ in found(out)) > 300
    assert all(r["kept"] == (r["vec_id"] is None or r["component_id"] == r["vec_id"]) for r in out.collect())


def test_vectors_of_floats_with_text_keys_and_clashing_columns(spark):
    rows = [(None if k is None else f"k{k:05}", x) for k, x in odd_vectors(2) if not x or max(abs(c or 0) for c in x) < 1e9 and min(abs(c or 1) for c in x) > 1e-9]
    df = spark.createDataFrame([(*r, 1, "c") for r in rows], "key string, x array<float>, n_links int, component_id string")
    single = [(k, x and [c if c is None else float(np.float32(c)) for c in x]) for k, x in rows]
    assert found(vectors.join(df, "key", "x"), "key") == brute_links(single)
    assert vectors.join(df.limit(0), "key", "x").collect() == []
    with pytest.raises(TypeError):
        vectors.join(spark.createDataFrame([(1, [1])], "vec_id long, embedding array<long>"))


@pytest.mark.parametrize("dim", [3, 64, 2500])
def test_bounds_of_quantised_products_hold(monkeypatch, dim):
    monkeypatch.setattr(vectors, "PAIRS", 50)
    monkeypatch.setattr(vectors, "ROWS", 9)
    rng = np.random.default_rng(dim)
    x = rng.normal(size=(60, dim)) * 10.0 ** rng.integers(-8, 8, size=(60, 1))
    x[::7] *= rng.pareto(1.0, size=(len(x[::7]), dim))
    x[1::5] = x[::5] + 0.3 * np.abs(x[::5]).mean() * rng.normal(size=x[::5].shape)
    codes, scale, lost = vectors.quantise(x)
    unit = vectors.unit_rows(x)
    exact = vectors._products(codes.astype(np.float32), codes.astype(np.float32))
    assert (exact == codes.astype(np.int64) @ codes.astype(np.int64).T).all()
    bound = lost[:, None] + lost + lost[:, None] * lost
    assert (np.abs(unit @ unit.T - scale[:, None] * scale * exact) <= bound + 1e-12).all() and bound.max() < 0.6
    side = (x, codes, scale, lost)
    for threshold in (-0.5, 0.0, 0.6, 0.9):
        pairs = {p for a, b in vectors.linked_pairs(side, side, threshold, True) for p in zip(a.tolist(), b.tolist(), strict=True)}
        assert pairs == {(i, j) for i, j in combinations(range(60), 2) if unit[i] @ unit[j] >= threshold}


ODD_TEXTS = ["", "a", "\n", "é漢🙂́x", "a\r\n\x00b", "<P", "x<S>y", "x" * 1500, "🙂\n" * 700]


@pytest.mark.parametrize("window", [2, 3, 256])
def test_units_are_those_of_the_whole_text(window):
    for text in ODD_TEXTS:
        units = middle.Units(text, window=window)
        assert units.n == len(text) and [units.offset(k) for k in range(len(text) + 1)] == list(range(len(text) + 1))
    for pattern in (r"\s*\S+", r"[^\n]*\n"):
        for text in [*ODD_TEXTS, "some words of  a text \n and more\n\n", " ".join(map(str, range(400)))]:
            whole = [e for _, (_, e) in middle._splitter(pattern)(text)]
            units = middle.Units(text, pattern, window)
            assert [units.offset(k) for k in range(units.n + 1)] == [0, *whole]


def brute_middle(key, text):
    h = hashlib.sha256(f"1:{'' if key is None else key}".encode()).hexdigest()
    h = [int(h[8 * k : 8 * k + 8], 16) for k in range(4)]
    n = len(text)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return n, "plain", None, None, text
    i, j = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = text[:i], text[i:j], text[j:]
    return (n, "spm", i, j - i, f"<S>{s}<P>{p}<M>{m}") if h[3] % 100 < 20 else (n, "psm", i, j - i, f"<P>{p}<S>{s}<M>{m}")


def test_middle_is_what_brute_force_gives(spark, documents):
    rows = middle.transform(documents, keep=["doc_id", "text"]).withColumn("back", middle.restored(F.col("output"), F.col("form"))).collect()
    assert len(rows) == documents.count()
    for r in rows:
        assert tuple(r)[2:-1] == brute_middle(r["doc_id"], r["text"] or "") and r["back"] == (r["text"] or "")
    assert {r["form"] for r in rows} == {"plain", "psm", "spm"}


def test_middle_odd_cases(spark, odd):
    texts = [*ODD_TEXTS, None, "ends with <", "<S", "a<P>", "P>b", "x>"]
    rows = [(k, t) for k in range(40) for t in texts] + [(None, "no key"), (None, None)]
    out = middle.transform(spark.createDataFrame(rows, "doc_id long, text string"), keep=["doc_id", "text"]).withColumn("back", middle.restored(F.col("output"), F.col("form"))).collect()
    assert len(out) == len(rows)
    for r in out:
        assert tuple(r)[2:-1] == brute_middle(r["doc_id"], r["text"] or "") and r["back"] == (r["text"] or "")
    assert middle.transform(odd, keep=odd.columns).count() == odd.count()
    assert middle.transform(odd.limit(0)).collect() == []
    words = middle.transform(spark.createDataFrame([(k, f"one two {k} four") for k in range(50)], "doc_id long, text string"), pattern=r"\s*\S+", rate=100, spm_rate=0)
    assert all(r["n"] == 4 and re.fullmatch(r"<P>(\S+( \S+)*)?<S>(( |^)?\S+)*<M>( ?\S+)*", r["output"]) for r in words.collect())


def one_edit(x, y):
    if len(x) > len(y):
        x, y = y, x
    if len(x) == len(y):
        return sum(a != b for a, b in zip(x, y, strict=True)) == 1
    return len(y) == len(x) + 1 and any(y[:k] + y[k + 1 :] == x for k in range(len(y)))


def brute_variants(words, times=2):
    near = {w: [x for x in words if one_edit(w, x)] for w in words}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda x: (-words[x], x), default=None)
        if best is not None and words[best] >= times * words[w]:
            form[w] = best
    out = {}
    for w in words:
        root = w
        while root in form:
            root = form[root]
        out[w] = (words[w], len(near[w]), form.get(w), words[form[w]] if w in form else None, root)
    return out


@pytest.mark.parametrize(("limit", "cells"), [(48, 1 << 20), (2, 40), (5, 300)])
def test_variants_are_what_brute_force_gives(spark, limit, cells):
    rng = random.Random(limit)
    words = {"".join(rng.choice("abé🙂") for _ in range(rng.choice([0, 1, 1, 2, 3, 4, 5, 6, 7, 9]))): int(2 ** rng.uniform(0, 9)) for _ in range(220)}
    # beginnings, endings and both that very many words share
    words |= {"verylongbeginning" + "".join(rng.choice("xyz") for _ in range(rng.randint(2, 4))): rng.randint(1, 9) for _ in range(60)}
    words |= {"".join(rng.choice("xyz") for _ in range(3)) + "verylongending": rng.randint(1, 9) for _ in range(40)}
    words |= {"begin" + "".join(rng.choice("xy") for _ in range(rng.randint(3, 4))) + "endof": rng.randint(1, 9) for _ in range(40)}
    rows = [(w, n - n // 3, "c") for w, n in words.items()] + [(w, n // 3, "d") for w, n in words.items() if n // 3] + [(None, 5, "e")]
    out = spelling.variants(spark.createDataFrame(rows, "word string, n long, form string"), limit=limit, cells=cells).collect()
    assert len(out) == len(words) and {r["word"]: (r["n"], r["n_near"], r["form"], r["form_n"], r["root"]) for r in out} == brute_variants(words)
    assert sum(r["root"] not in (r["word"], r["form"]) for r in out) > 3


def test_long_chains_of_forms_end_at_their_root(spark):
    rows = [("a" * k, 2**k) for k in range(1, 41)]
    out = {r["word"]: r["root"] for r in spelling.variants(spark.createDataFrame(rows, "word string, n long")).collect()}
    assert out == {w: "a" * 40 for w, _ in rows}
    with pytest.raises(ValueError):
        spelling.variants(spark.createDataFrame(rows, "word string, n long"), times=1)


def brute_words(rows, one_in):
    out = Counter()
    for key, text in rows:
        for run in re.findall(r"[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if one_in and h % one_in == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= 5:
                out[run] += 1
    return {w: n for w, n in out.items() if n >= 3}


@pytest.mark.parametrize("one_in", [None, 3, 97])
def test_words_are_counted_as_brute_force_counts_them(spark, documents, odd, one_in):
    rows = [(r["doc_id"], r["text"]) for r in documents.limit(60).collect()]
    for df in (spark.createDataFrame(rows, "doc_id long, text string"), odd):
        expected = brute_words([(r["doc_id"], r["text"]) for r in df.collect()], one_in)
        assert {r["word"]: r["n"] for r in spelling.count_words(df, one_in=one_in).collect()} == expected and expected
    assert spelling.variants(spelling.count_words(odd.limit(0))).collect() == []
