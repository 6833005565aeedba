"""BPE, contamination, secrets and URL filters against brute force, and their odd cases."""

import base64
import random
import re

import public_tokenizers
import tiktoken
from pyspark.sql import functions as F

from panelforge.llm import bpe, common, contamination, langid, secrets, urls
from panelforge.llm.queries import URL_RULES
from tests.llm.conftest import prose

PATH, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


def reference():
    with open(PATH, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary


def test_bpe_is_what_tiktoken_gives(spark, documents):
    encode = reference()
    rows = bpe.encode(documents, PATH, PATTERN, keep=["doc_id", "text"]).collect()
    assert len(rows) == documents.count()
    for r in rows:
        ids = encode(r["text"])
        assert (r["ids"], r["n_tokens"], bytes(r["decoded"])) == (" ".join(map(str, ids)), len(ids), r["text"].encode())


def test_bpe_on_unusual_characters():
    encode, codec, rng = reference(), bpe.codec(PATH, PATTERN), random.Random(3)
    letters = " \t\n\r\x0b\x0c\x1c\x85\xa0 abXY019éßñ漢字🙂'\"-_.,:;()<>strevemld"
    for _ in range(3000):
        text = "".join(rng.choice(letters) for _ in range(rng.randint(0, 40)))
        assert codec.encode(text) == " ".join(map(str, encode(text))) and codec.decode(codec.encode(text)) == text.encode()
    assert codec.encode("<|endoftext|>") == " ".join(map(str, encode("<|endoftext|>")))


def test_bpe_table_follows_appends_and_edits():
    v, rng, saved = bpe.codec(PATH, PATTERN).vocabulary, random.Random(4), 0
    for _ in range(300):
        data = bytes(rng.choice(b"abcde the ing tion 0123") for _ in range(rng.randint(0, 400)))
        i = rng.randint(0, len(data))
        j, new = min(len(data), i + rng.randint(0, 5)), bytes(rng.choice(b"abtheing") for _ in range(rng.randint(0, 5)))
        table = bpe.PrefixTable(v, data[:i])
        table.append(data[i:])
        assert table.last == bpe.PrefixTable(v, data).last and table.tokens(i) == bpe.PrefixTable(v, data[:i]).tokens()
        saved += len(data) - table.edit(i, j, new)
        assert table.last == bpe.PrefixTable(v, data[:i] + new + data[j:]).last
    assert saved > 1000


def test_bpe_odd_cases(spark, odd):
    out = bpe.encode(odd, PATH, PATTERN)
    rows = out.collect()
    assert len(rows) == odd.count() and [r["n_tokens"] for r in rows if r["ids"] == ""] == [0] * 3
    again = bpe.decode(out.select("doc_id", "ids"), PATH, PATTERN).collect()
    assert sorted(bytes(r["decoded"]) for r in again) == sorted((t[0] or "").encode() for t in odd.select("text").collect())
    assert bpe.encode(odd.where("false"), PATH, PATTERN).count() == 0


def brute_hits(text, items):
    split = lambda x: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), x or ""))
    w, hit, found = split(text), set(), set()
    for item, t in items:
        v = split(t)
        for k in range(max(1, len(v) - 12)) if v else ():
            window = v[k : k + 13]
            for at in range(len(w) - len(window) + 1):
                if w[at : at + len(window)] == window:
                    hit |= set(range(at, at + len(window)))
                    found.add(str(item))
    return len(w), len(hit), sorted(found)


def test_contamination_is_what_brute_force_gives(spark, monkeypatch):
    rng = random.Random(9)
    items = [(k, prose(rng, rng.choice([3, 12, 13, 14, 30]))) for k in range(12)] + [(12, ""), (13, None), (None, "null id of an item"), (3, "A b-C!")]
    docs = []
    for k in range(60):
        parts = [prose(rng, rng.randint(0, 40)) for _ in range(3)]
        source = rng.choice(items[:12])[1].split()
        a = rng.randint(0, len(source) - 1)
        docs.append((k, " ".join([parts[0], *([" ".join(source[a : a + rng.randint(1, 30)]).upper()] if k % 2 else [rng.choice(items[:12])[1]]), parts[1], "a B c" if k % 5 == 0 else "", parts[2]])))
    frame, bench = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    expected = {k: brute_hits(t, [i for i in items if i[0] is not None]) for k, t in docs}
    got = lambda: {r["doc_id"]: (r["n_words"], r["n_hit"], r["items"]) for r in contamination.find(frame, bench).collect()}
    assert got() == expected
    monkeypatch.setattr(contamination, "BLOCK_WORDS", 40)  # several passes
    assert got() == expected
    kept = contamination.find(frame.withColumn("n_hit", F.lit("x")), bench, keep=["text", "doc_id", "n_hit"])
    assert kept.columns == ["text", "doc_id", "n_words", "n_hit", "items"] and {r["doc_id"]: (r["n_words"], r["n_hit"], r["items"]) for r in kept.collect()} == expected


def test_contamination_odd_cases(spark, odd):
    bench = spark.createDataFrame([(1, "same text of a few words here")], "item_id long, text string")
    rows = contamination.find(odd, bench).collect()
    assert len(rows) == odd.count() and sum(r["n_hit"] for r in rows) == 21 and all(r["items"] == (["1"] if r["n_hit"] else []) for r in rows)
    assert [r["n_hit"] for r in contamination.find(odd, bench.where("false")).collect()] == [0] * odd.count()
    assert contamination.find(odd.where("false"), bench).count() == 0


def test_secrets_are_scanned_once_per_blob(spark):
    texts = [(1, 'my Password = "abcdefghijkl" x'), (2, 'my Password = "abcdefghijkl" x'), (3, "AKIA" + "Q" * 14 + " 0123456789abcdef0"), (4, "token: short and AKIAQQ"), (5, None), (6, "plain"), (7, "-----BEGIN RSA PRIVATE KEY-----")]
    first = spark.createDataFrame(texts, "doc_id long, text string")
    found, ledger = secrets.scan(first)
    spans = {r["doc_id"]: [tuple(s) for s in r["spans"]] for r in found.collect()}
    assert spans == {1: [("assign", 3, 27)], 2: [("assign", 3, 27)], 3: [("access", 0, 18), ("hex", 19, 36)], 4: [], 5: [], 6: [], 7: [("pem", 0, 31)]}
    assert ledger.count() == 6  # every blob is entered, also those without findings
    calls = first.where("doc_id < 4").unionByName(spark.createDataFrame([(8, "secret=zzzzzzzzzzzzzz")], first.schema))
    again, after = secrets.scan(calls, ledger)
    assert after.count() == 7 and {r["doc_id"]: len(r["spans"]) for r in again.collect()} == {1: 1, 2: 1, 3: 2, 8: 1}
    other = ledger.withColumn("rule_version", F.lit("0"))
    assert secrets.scan(first, other)[1].count() == 12
    # what is in the ledger is not scanned again, nor even matched
    assert secrets.unseen(calls, ledger).count() == 1 and secrets.unseen(first, ledger).count() == 0 and secrets.unseen(first, other).count() == 6


def test_ledger_table_grows_by_what_is_new(spark, documents, tmp_path, monkeypatch):
    ledger = secrets.Ledger(spark, str(tmp_path / "ledger"))
    half = documents.where("doc_id % 2 = 0")
    few = {r["doc_id"]: r["spans"] for r in ledger.scan(half).collect()}
    n = ledger.read().count()
    assert n == half.select("text").distinct().count()
    every = {r["doc_id"]: r["spans"] for r in ledger.scan(documents).collect()}
    assert few.items() <= every.items() and ledger.read().count() == documents.select("text").distinct().count() > n
    assert every == {r["doc_id"]: r["spans"] for r in secrets.scan(documents)[0].collect()}
    assert secrets.unseen(documents, ledger.read()).count() == 0
    for most in (n - 1, -1):  # the new hashes are broadcast; nothing is
        monkeypatch.setattr(secrets, "BROADCAST_BLOBS", most)
        ledger = secrets.Ledger(spark, str(tmp_path / f"ledger{most}"))
        ledger.scan(half)
        assert every == {r["doc_id"]: r["spans"] for r in ledger.scan(documents).collect()} and secrets.unseen(half, ledger.read()).count() == 0


def brute_spans(text):
    """The base spans, read off the contract character by character."""
    low = "".join(c.lower() if c.isascii() else c for c in text)
    found, n = [], len(text)
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
    value = set(letters + "0123456789+/_.=-")

    def run(at, of):
        while at < n and text[at] in of:
            at += 1
        return at

    def assign(at):
        for word in ("password", "passwd", "secret", "token", "apikey", "api_key"):
            if low.startswith(word, at):
                k = at + len(word)
                for quote in ([1, 0] if k < n and text[k] in "\"'" else [0]):
                    j = run(k + quote, " ")
                    if j < n and text[j] in ":=":
                        j = run(j + 1, " ")
                        for open_ in ([1, 0] if j < n and text[j] in "\"'" else [0]):
                            if (stop := run(j + open_, value)) > j + open_:
                                return stop, stop - j - open_
        return None

    def access(at):
        stop = run(at + 4, set(letters[:26] + "0123456789")) if text.startswith("AKIA", at) else at
        return (stop, stop - at) if stop > at + 4 else None

    def hexes(at):
        stop = run(at, set("0123456789abcdef"))
        return (stop, stop - at) if stop > at else None

    for rank, (kind, match, least) in enumerate((("assign", assign, 12), ("access", access, 18), ("hex", hexes, 16))):
        at = 0
        while at < n:
            m = match(at)
            if m and m[1] >= least:
                found.append((at, rank, kind, m[0]))
            at = m[0] if m else at + 1
    return [(kind, start, stop) for start, _, kind, stop in sorted(found)]


def test_base_spans_are_what_brute_force_gives(spark, documents):
    rng = random.Random(6)
    parts = ["password", "PassWd", "secret", "toKen", "api_key", "APIKEY", "\"", "'", " ", ":", "=", "AKIA", "0123456789abcdef", "deadbeef" * 2, "Qq+/_.=-", "ABCDEFGHIJKLMNOP", "é🙂", "\n", "\u017fecret", "to\u212aen"]
    made = [(10**6 + k, "".join(rng.choice(parts) for _ in range(rng.randint(1, 40)))) for k in range(1500)]
    frame = documents.select("doc_id", "text").unionByName(spark.createDataFrame(made, "doc_id long, text string"))
    rows = secrets.scan(frame, keep=["doc_id", "text"])[0].collect()
    assert len(rows) == frame.count() and sum(len(r["spans"]) for r in rows) > 500
    for r in rows:
        assert [tuple(x) for x in r["spans"] if x["kind"] != "pem"] == brute_spans(r["text"]), r["text"]


def test_secret_prefilter_passes_all_that_the_rules_find(documents):
    for (text,) in documents.select("text").collect():
        assert not secrets.scan_text(text) or re.search(secrets.PREFILTER, text)


def test_secrets_odd_cases(spark, odd):
    found, ledger = secrets.scan(odd)
    assert found.count() == odd.count() and ledger.where("size(spans) > 0").count() == 0 and ledger.count() == odd.select(F.coalesce("text", F.lit(""))).distinct().count()
    assert secrets.scan(odd.where("false"))[0].count() == 0
    clash = odd.withColumns({"spans": F.lit(1), "blob": F.lit(2)})
    assert secrets.scan(clash, keep=["doc_id", "spans", "blob"])[0].columns == ["doc_id", "blob", "spans"]


def test_urls(spark):
    pages = [
        (1, "https://WWW.example.org/en/17"), (2, "http://example.org/es/"), (3, "http://badexample.org/es/1"), (4, "http://x.com/de/a?b#c"), (5, "http://x.com/fr/"), (6, "http://x.net/de/"), (7, None), (8, "no scheme"),
        (9, "http://example.org"), (10, "http://example.org?x=/es/"), (11, "://a.example.org/en/1"), (12, "http://org/"), (13, "http:///de/"), (14, "http://example.org#/es/://b.com/de/"), (1, "https://WWW.example.org/en/17"),
    ]
    frame = spark.createDataFrame([(*p, "x", "y") for p in pages], "page_id long, url string, rule string, verdict string")
    got = sorted((r["page_id"], r["host"], r["path"], r["rule"], r["verdict"]) for r in urls.judge(frame, URL_RULES).collect() if r["page_id"] not in (7, 8, 13))
    assert [x[3:] for x in got] == [("example.org/en/1", "block")] * 2 + [("example.org/es/", "block"), ("org/", "allow"), ("com/de/", "block"), ("com/fr/", "allow"), (None, "allow"), (None, "allow"), (None, "allow"), ("example.org/en/1", "block"), ("org/", "allow"), (None, "allow")]
    empty = {r["page_id"]: (r["host"], r["path"], r["rule"]) for r in urls.judge(frame.where("page_id IN (7, 8, 13)"), URL_RULES).collect()}
    assert empty == {7: ("", "", None), 8: ("", "", None), 13: ("", "/de/", None)}
    assert urls.judge(frame.where("false"), URL_RULES).count() == 0 and urls.judge(frame, []).where("rule IS NULL").count() == 15


def test_urls_against_brute_force_in_several_sweeps(spark, monkeypatch):
    rng = random.Random(2)
    label = lambda n: ".".join(rng.choice("ab") for _ in range(rng.randint(1, n)))
    rules = [(label(3), "/" + "".join(rng.choice("xy/") for _ in range(rng.randint(0, 3))), rng.choice(["allow", "block"])) for _ in range(60)]
    pages = [(k, f"http://{label(5)}/" + "".join(rng.choice("xy/") for _ in range(rng.randint(0, 6)))) for k in range(400)]
    unique = {}
    for h, p, v in rules:
        unique.setdefault((h, p), v)

    def brute(url):
        host, path = url[7:].split("/", 1)
        fits = [((len(h) + len(p), len(h)), h + p, v) for (h, p), v in unique.items() if (host == h or host.endswith("." + h)) and ("/" + path).startswith(p)]
        return max(fits)[1:] if fits else (None, "allow")

    frame = spark.createDataFrame(pages, "page_id long, url string").repartition(3)
    expected = {k: brute(u) for k, u in pages}
    assert {r["page_id"]: (r["rule"], r["verdict"]) for r in urls.judge(frame, rules).collect()} == expected
    for block in (9, 59):
        monkeypatch.setattr(urls, "RULE_BLOCK", block)
        assert {r["page_id"]: (r["rule"], r["verdict"]) for r in urls.judge(frame, rules).collect()} == expected


def test_url_verdicts_do_not_depend_on_the_block_size(spark, monkeypatch):
    rules = [("a.org", "/xx", "block"), ("b.a.org", "/", "allow")]
    frame = spark.createDataFrame([(1, "http://b.a.org/xx", "mine"), (2, "http://" + "c." * 20_000 + "a.org/" + "x" * 100_000, "mine")], "page_id long, url string, verdict string")
    for block in (1, 10):
        monkeypatch.setattr(urls, "RULE_BLOCK", block)
        for rows in (rules, rules[::-1]):
            got = {r["page_id"]: (r["rule"], r["verdict"]) for r in urls.judge(frame, rows, keep=["page_id", "verdict"]).collect()}
            assert got == {1: ("b.a.org/", "allow"), 2: ("a.org/xx", "block")}


def test_a_worker_remembers_one_operator_at_a_time():
    common.begins(bpe._forget)
    bpe.codec(PATH, PATTERN).encode("a word")
    assert bpe.codec.cache_info().currsize and bpe.Vocabulary.load.cache_info().currsize
    common.begins(bpe._forget)
    assert bpe.codec.cache_info().currsize
    common.begins(langid._forget)
    assert not bpe.codec.cache_info().currsize and not bpe.Vocabulary.load.cache_info().currsize
    langid.features("word", frozenset())
    common.begins(bpe._forget)
    assert not langid._buckets
