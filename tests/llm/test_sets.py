"""Line dedup, the Jaccard join, components and the pipeline against brute force, and their odd cases."""

import random
import re
from collections import Counter, defaultdict

import corpus_pipeline
import numpy as np
import xxhash
from pyspark.sql import functions as F

from panelforge.llm import common, contamination, jaccard, langid, lines
from panelforge.llm.components import components
from tests.llm.conftest import prose


def brute_sets(rows):
    out = []
    for _, text in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        out.append({tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set())
    return out


def brute_components(rows):
    sets, boss = brute_sets(rows), list(range(len(rows)))

    def find(i):
        while boss[i] != i:
            i = boss[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
                boss[find(i)] = find(j)
    least = {}
    for i, (k, _) in enumerate(rows):
        least[find(i)] = min(k, least.get(find(i), k))
    return {k: (len(sets[i]), least[find(i)]) for i, (k, _) in enumerate(rows)}


def near_copies(seed, families=14, copies=9):
    rng, out = random.Random(seed), []
    shared = prose(rng, 30)
    for _ in range(families):
        base = prose(rng, rng.choice([3, 5, 8, 40, 120])).split()
        for _ in range(rng.randint(1, copies)):
            w = list(base)
            for _ in range(rng.choice([0, 1, 1, 2, 3])):
                w[rng.randrange(len(w))] = prose(rng, 1)
            out.append(" ".join(w) + (" " + shared if rng.random() < 0.3 else ""))
    # longer texts around a size at which bitmaps grow, with links and near misses
    base = [prose(rng, 1) for _ in range(560)]
    for n in (430, 470, 500, 515, 520, 530, 560):
        out.append(" ".join([*base[:n], prose(rng, 20)]))
    rng.shuffle(out)
    return [(k * 3, t.upper() if k % 7 == 0 else t) for k, t in enumerate(out)]


def test_jaccard_is_what_brute_force_gives(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK_TOKENS", 500)
    for seed, spread in ((1, 20_000), (2, 5)):  # with 5 frequent tokens are spread over several keys
        monkeypatch.setattr(jaccard, "SPREAD", spread)
        rows = near_copies(seed)
        frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
        assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.join(frame).collect()} == brute_components(rows)


def test_jaccard_by_shuffle_only(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "BROADCAST_BYTES", -1)
    rows = near_copies(3, 8)
    got = jaccard.join(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got.collect()} == brute_components(rows)


def test_a_crowded_set_is_met_in_copies(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "CROWD", 7)
    rng, rows = random.Random(9), near_copies(4, 5)
    base = prose(rng, 90).split()
    for k in range(120):
        w = list(base)
        w[k % 90] = prose(rng, 1)
        rows.append((10_000 + k, " ".join(w)))
    got = jaccard.join(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got.collect()} == brute_components(rows)


def test_followers_of_one_leader_are_spread_over_tasks(spark):
    """20,000 rows that meet one set: the largest task gets no more than a few times the rows of the others."""
    rows = spark.range(20_000).select(F.col("id").alias("a"), F.lit(-1).cast("long").alias("b"))
    sets = spark.range(1).select(F.lit(-1).cast("long").alias("b"), F.lit("set").alias("of_b")).groupBy("b").agg(F.min("of_b").alias("of_b"))
    crowded = rows.groupBy("b").agg(F.ceil(F.count("*") / jaccard.CROWD).cast("int").alias("copies"))
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        out = jaccard._dealt(rows, sets, "b", "a", crowded)
        sizes = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert sum(sizes) == 20_000 and len(sizes) == 4 and max(sizes) < 0.5 * sum(sizes)


def test_jaccard_with_keys_that_are_text(spark):
    rows = near_copies(5, 6)
    expected = brute_components([(f"k{k:05d}", t) for k, t in rows])
    got = jaccard.join(spark.createDataFrame(rows, "doc_id long, text string").withColumn("doc_id", F.format_string("k%05d", "doc_id")))
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got.collect()} == expected


def test_linked_sets_always_share_an_entry():
    rng = np.random.default_rng(4)
    hot = np.sort(rng.integers(0, 2**63, 400, dtype=np.uint64))
    keys = rng.integers(1, 6, len(hot))
    linked = 0
    for _ in range(3000):
        shared = np.concatenate([rng.integers(0, 2**63, rng.choice([20, 80, 700, 1500]), dtype=np.uint64), rng.choice(hot, rng.integers(0, 40), replace=False)])
        own = [rng.integers(0, 2**63, rng.integers(0, 1 + len(shared) // 3), dtype=np.uint64) for _ in range(2)]
        a, b = (np.unique(np.concatenate([shared, x])) for x in own)
        if not jaccard.similar(a, b):
            continue
        linked += 1
        maps = sorted((jaccard.bitmap(a), jaccard.bitmap(b)), key=len)
        folded = np.bitwise_xor.reduce(maps[1].reshape(-1, len(maps[0])))
        assert np.bitwise_count((maps[0] ^ folded).view(np.uint64)).sum() <= len(np.setxor1d(a, b))
        a, b = (a, b) if len(a) >= len(b) else (b, a)
        (ka, ua, qa), (kb, ub, _) = (jaccard.entries(x, int(x[0]), hot, keys) for x in (a, b))
        asked = {k: u for k, u, q in zip(ka, ua, qa, strict=True) if q}
        assert any(k in asked and len(a) <= u and len(b) <= asked[k] for k, u in zip(kb, ub, strict=True) if u >= len(b))
    assert linked > 500


def test_a_passage_under_three_quarters_makes_no_pairs(spark, tmp_path):
    """Documents of 84 shared and 20 own shingles: the matrix gives no pair, however many there are."""
    rng = random.Random(31)
    passage = [f"w{rng.randrange(10**6)}" for _ in range(88)]
    rows = [(k, " ".join([*passage, *[f"x{rng.randrange(10**9)}" for _ in range(20)]])) for k in range(1200)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    assert all(r["component_id"] == r["doc_id"] for r in jaccard.join(frame).collect())
    hot = np.sort(jaccard.shingle_sets([" ".join(passage)])[0])
    members = frame.mapInArrow(jaccard._signed, "doc_id long, n long, s1 long, s2 long, bands array<long>, bits array<long>, tokens binary").select("doc_id", "s1", "n", F.col("doc_id").alias("g"))
    several = lambda x: spark.sparkContext.broadcast(x)
    made = frame.mapInArrow(jaccard._prefixes(several(hot), several(np.ones(len(hot), np.int64))), "key long, s1 long, about long")
    assert jaccard.candidates(made, members, common.Scratch(spark, "test")).count() == 0


def test_jaccard_on_the_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    expected = brute_components([tuple(r) for r in docs.collect()])
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.join(docs).collect()} == expected


def test_jaccard_threshold_is_exact():
    a = np.arange(8, dtype=np.uint64)
    assert jaccard.similar(a, a[:6]) and not jaccard.similar(a, a[:5]) and not jaccard.similar(a[:0], a[:0])
    assert [len(s) for s in jaccard.shingle_sets([None, "", " \n", "a", "A", "a b c d e f", "é\x0bb"])] == [0, 0, 0, 1, 1, 2, 1]


def test_jaccard_odd_cases(spark, odd):
    rows = jaccard.join(odd).collect()
    assert len(rows) == odd.count()
    got = {(r["doc_id"], r["component_id"]) for r in rows}
    assert {(0, 0), (1, 1), (2, 2), (7, 7), (8, 7), (None, None)} <= got
    assert jaccard.join(odd.where("false")).count() == 0


def test_components(spark):
    rng = random.Random(8)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(k, k + 1) for k in range(400, 440)] + [(5, 5), (None, 4)]
    boss = list(range(500))

    def find(i):
        while boss[i] != i:
            i = boss[i]
        return i

    for a, b in links:
        if a is not None:
            x, y = sorted((find(a), find(b)))
            boss[y] = x
    nodes = {n for a, b in links if a is not None and a != b for n in (a, b)}
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {n: find(n) for n in nodes}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def brute_lines(docs):
    """Text and number of dropped lines per document, by the rule that the module's text states."""

    def template(line):
        return " ".join(re.sub(r"[^\x20\x09-\x0D]*[0-9][^\x20\x09-\x0D]*", "<*>", line).split())

    def t_of(x):
        t = xxhash.xxh64(x.encode(), seed=42).intdigest()
        return t - 2**64 if t >= 2**63 else t

    enough = lambda x: len(x.split()) >= lines.MIN_TOKENS
    leaf = lambda x: (len(x.split()), *x.split()[: lines.DEPTH])
    parsed = {k: [template(x) for x in text.split("\n")] for k, text in docs}
    own = {k: frozenset(x for x in ts if enough(x)) for k, ts in parsed.items()}
    groups = Counter(own.values())
    families, held, by_leaf = Counter(), Counter(), defaultdict(list)
    for group, copies in groups.items():
        for x in group:
            families[x] += 1
            held[x] += copies
    for x in families:
        by_leaf[leaf(x)].append(x)
    name = {x: {x} for x in families if families[x] >= lines.MIN_FAMILIES}  # candidate -> the templates it is an instance of
    for key, xs in by_leaf.items():
        if len(xs) < 2 or sum(families[x] for x in xs) < lines.MIN_FAMILIES:
            continue
        rest = key[0] - lines.DEPTH
        top = max(xs, key=lambda x: (families[x], held[x], t_of(x)))
        first = {x for x in xs if sum(a == b for a, b in zip(x.split(" "), top.split(" "), strict=True)) - lines.DEPTH >= lines.SIMILAR * rest}
        cells = Counter()
        for x in set(xs) - first:
            for cell in list(enumerate(x.split(" ")))[lines.DEPTH :]:
                cells[cell] += families[x]
        merged = defaultdict(list)
        for x in xs:
            mask = tuple(c for c in list(enumerate(x.split(" ")))[lines.DEPTH :] if cells[c] >= lines.MIN_FAMILIES)
            merged[top if x in first else (key, mask) if mask and len(mask) >= lines.SIMILAR * rest else x].append(x)
        for of, members in merged.items():
            if sum(families[x] for x in members) >= lines.MIN_FAMILIES:
                for x in members:
                    name.setdefault(x, set()).add(of)
    def anchors(x):
        w, k = x.split(), lines.ANCHOR
        if len(w) < 2 * k:
            half = max(1, len(w) // 2)
            return {(len(w), 0, *w[:half]), (len(w), 1, *w[-half:])}
        return {(0, *w[:k]), (1, *w[-k:]), (2, *w[k : 2 * k]), (3, *w[-2 * k : -k])}

    known = {a for x in name for a in anchors(x)}
    rest_of = {g: [bool(anchors(x) & known) for x in g if x not in name] for g in groups}
    evident = [g for g, r in rest_of.items() if len(r) > 2 * sum(r)]
    places = defaultdict(set)
    for k, group in enumerate(evident):
        for x in group & name.keys():
            for of in name[x]:
                places[of].add(k)
    drop = {x for x, of in name.items() if any(len(places[y]) >= lines.MIN_FAMILIES for y in of)}
    out = {}
    for k, text in docs:
        kept = [x for x, y in zip(text.split("\n"), parsed[k], strict=True) if y not in drop]
        out[k] = ("\n".join(kept), len(parsed[k]) - len(kept))
    return out


def line_docs(seed):
    rng, out = random.Random(seed), []
    for k in range(60):
        ls = [prose(rng, rng.randint(1, 12)) for _ in range(rng.randint(2, 7))]
        if k % 3 == 0:
            ls.insert(rng.randrange(len(ls)), f"Page  {k} of this site was seen on 2024-01-{k % 28:02d} by  you")
        if k % 4 == 0:
            ls.append(f"Subscribe to our {prose(rng, 1)} letter and read more of it every day")
        if k % 9 == 0:
            ls.append("All rights reserved.")
        out.append((k, "\n".join(ls)))
    copy = "\n".join(prose(rng, 9) for _ in range(5))
    return out + [(100 + k, copy) for k in range(12)] + [(200, ""), (201, "one\ntwo")]


def test_line_dedup_is_what_brute_force_gives(spark):
    docs = line_docs(6)
    got = {r["doc_id"]: (r["text"], r["n_dropped"]) for r in lines.dedup(spark.createDataFrame(docs, "doc_id long, text string").repartition(4)).collect()}
    expected = brute_lines(docs)
    assert got == expected
    assert all("Page" not in t and "Subscribe" not in t and "rights" not in t for t, _ in got.values())
    assert all(got[100 + k][1] == 0 for k in range(12))  # copies of one document are no boilerplate


def test_shared_lines_go_whatever_copies_or_blocks_hold_them(spark):
    rng = random.Random(11)
    line, block = "You are reading the printed edition of this page", [prose(rng, 9) for _ in range(10)]
    docs = [(k, "\n".join([*[prose(rng, 9) for _ in range(4)], line])) for k in range(12)]
    docs += [(100 + k, "\n".join([*copy, line])) for copy in [[prose(rng, 9) for _ in range(4)]] for k in range(90)]
    docs += [(300 + k, "\n".join([*block, prose(rng, 9), prose(rng, 9)])) for k in range(40)]
    near = [prose(rng, 9) for _ in range(12)]
    for k in range(40):  # near copies: in one line each another word
        words = near[k % 12].split()
        words[k % 9] = prose(rng, 1)
        docs.append((400 + k, "\n".join([*near[: k % 12], " ".join(words), *near[k % 12 + 1 :]])))
    got = {r["doc_id"]: (r["text"], r["n_dropped"]) for r in lines.dedup(spark.createDataFrame(docs, "doc_id long, text string").repartition(4)).collect()}
    assert not any(line in t for t, _ in got.values())
    assert all(got[300 + k][1] == 10 for k in range(40))
    assert all(got[400 + k][1] == 0 for k in range(40))  # near copies are no evidence either


def test_short_pages_with_one_line_of_their_own_are_evidence(spark):
    rng = random.Random(13)
    block = [prose(rng, 9) for _ in range(10)]
    docs = [(k, "\n".join([*block[:5], prose(rng, 9), *block[5:]])) for k in range(500)]
    copy = [prose(rng, 9) for _ in range(10)]
    for k in range(1, 300):
        words = [x.split() for x in copy]
        for _ in range(4):
            words[rng.randrange(10)][rng.randrange(9)] = prose(rng, 1)
        docs.append((1000 + k, "\n".join(map(" ".join, words))))
    got = {r["doc_id"]: (r["text"], r["n_dropped"]) for r in lines.dedup(spark.createDataFrame(docs, "doc_id long, text string").repartition(4)).collect()}
    assert all(got[k][1] == 10 for k in range(500))
    assert not any(n for k, (_, n) in got.items() if k > 1000)  # near copies of one document
    assert got == brute_lines(docs)


def test_several_templates_of_a_leaf_and_lines_without_spaces(spark):
    rng = random.Random(12)
    name = lambda: "".join(rng.choice("bcdfgklmnp") for _ in range(7))
    made = [
        lambda: f"Posted in the section {name()} of our very large online archive",
        lambda: f"Posted in the morning by {name()} who also wrote many others",
        lambda: "Posted in the " + " ".join(name() for _ in range(8)),
        lambda: "版権所有禁止転載",
    ]
    docs = [(k, "\n".join([prose(rng, 9), prose(rng, 9), made[k % 4](), "中"])) for k in range(80)]
    got = {r["doc_id"]: r["n_dropped"] for r in lines.dedup(spark.createDataFrame(docs, "doc_id long, text string").repartition(4)).collect()}
    assert got == {k: int(k % 4 != 2) for k, _ in docs}


def test_line_dedup_runs_no_python(spark, documents):
    plan = lines.dedup(documents)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_line_dedup_odd_cases(spark, odd):
    rows = lines.dedup(odd)
    assert sorted(rows.columns) == sorted([*odd.columns, "n_dropped"]) and rows.count() == odd.count()
    by_text = {r["text"]: (r["n_lines"], r["n_dropped"]) for r in rows.collect()}
    assert by_text[None] == (0, 0) and by_text[""] == (1, 0) and by_text[" \n\t "] == (2, 0)
    assert lines.dedup(odd.where("false")).count() == 0
    clash = odd.drop("n_lines").withColumns({"N_Lines": F.lit("x"), "N_DROPPED": F.lit("y")})
    assert [c for c in lines.dedup(clash).columns if c.lower() in ("n_lines", "n_dropped")] == ["n_lines", "n_dropped"]


def test_pipeline_stages_against_brute_force(spark, sf, documents):
    kept = documents
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["language", "line_dedup", "near_duplicates", "decontamination", "encoding"]
    first = stages["language"](spark, kept, sf)
    assert first.columns == documents.columns
    before = {r["doc_id"]: r for r in documents.collect()}
    gone = before.keys() - {r["doc_id"] for r in first.collect()}
    assert all(not langid.words_of(before[k]["text"]) for k in gone) or len(gone) < 0.02 * len(before)
    second = {r["doc_id"]: r for r in stages["line_dedup"](spark, first, sf).collect()}
    expected = brute_lines([(r["doc_id"], r["text"]) for r in first.collect()])
    assert {k: r["text"] for k, r in second.items()} == {k: t for k, (t, _) in expected.items()}
    assert all(r["n_chars"] == len(r["text"]) for r in second.values())
    second = spark.createDataFrame(list(second.values()), documents.schema)
    third = stages["near_duplicates"](spark, second, sf)
    groups = brute_components([(r["doc_id"], r["text"]) for r in second.collect()])
    assert {r["doc_id"] for r in third.collect()} == {k for k, (_, c) in groups.items() if c == k}
    fourth = stages["decontamination"](spark, third, sf)
    hits = contamination.find(third, spark.read.parquet(f"{sf}/benchmark.parquet")).where("n_hit > 0 AND 20 * n_hit >= n_words").select("doc_id")
    assert {r["doc_id"] for r in fourth.collect()} == {r["doc_id"] for r in third.collect()} - {r["doc_id"] for r in hits.collect()}
    last = stages["encoding"](spark, fourth, sf)
    assert last.count() == fourth.count() and last.where(~F.col("round_trip")).isEmpty()


def test_pipeline_keeps_texts_in_three_languages(spark, sf):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    plain = docs.where("length(text) > 900 AND text NOT LIKE '%!!%' AND text NOT LIKE '%|%' AND text NOT LIKE '%$%'").orderBy("doc_id").collect()
    part = {r["lang"]: " ".join(r["text"].split()[:80]) for r in plain}
    assert len(part) >= 3
    mixed = [(10**6, " ".join(part[x] for x in sorted(part)[:3]), "en", "s", 0), (10**6 + 1, "123 456", "en", "s", 0)]
    out = corpus_pipeline.language(spark, docs.unionByName(spark.createDataFrame(mixed, docs.schema)), sf)
    assert [r["doc_id"] for r in out.where("doc_id >= 1000000").collect()] == [10**6]


def test_pipeline_runs_as_a_whole_and_on_odd_rows(spark, sf, odd):
    ids = [r["doc_id"] for r in corpus_pipeline.run(spark, sf).select("doc_id").collect()]
    assert len(ids) == len(set(ids)) > 100
    docs, last = odd, corpus_pipeline.STAGES[-1][0]
    for name, stage in corpus_pipeline.STAGES:
        docs = spark.createDataFrame((out := stage(spark, docs, sf)).collect(), out.schema)
        assert name == last or docs.columns == odd.columns and {(r["score"], r["items"], r["n_words"], r["n_lines"]) for r in docs.collect()} <= {(0.5, "i", 1, 1)}
    assert docs.columns == ["doc_id", "n_tokens", "ids", "round_trip"]
    docs = odd.select("doc_id", "text", "lang", "source", "n_chars").where("false")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf)
    assert docs.count() == 0
