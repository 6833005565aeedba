"""The thin queries over the driver tables: each runs its operator over a whole table and derives the contract's columns."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelforge.llm import bpe, contamination, html, jaccard, langid, lines, middle, quality, rules, secrets, spelling, urls, vectors
from panelforge.llm.common import fresh_path, held_out, table

URL_RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"), ("com", "/de/", "block")]
#: One in so many runs of letters loses one.
MISSPELT = 97


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.join(table(spark, sf_dir, "documents"))


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = bpe.encode(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    return out.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))), ",")


def op4_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))


def _is(kind: str) -> Callable[[Column], Column]:
    return lambda s: s["kind"] == kind


def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.Ledger(spark, fresh_path(spark, "secret-ledger")).scan(table(spark, sf_dir, "documents"))
    n = [F.size(F.filter("spans", _is(kind))).cast("long").alias(f"n_{kind}") for kind in ("assign", "access", "hex")]
    base = F.filter("spans", lambda s: s["kind"].isin("assign", "access", "hex"))
    return found.select("doc_id", *n, F.sha2(_joined(base), 256).alias("base_sha256"), _joined(F.col("spans")).alias("spans"))


def op6_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(table(spark, sf_dir, "pages"), URL_RULES)


def op7_contamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = contamination.find(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return out.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        ((F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))).alias("contaminated"),
    )


def op8_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract(table(spark, sf_dir, "pages"), html.model(spark))


def op9_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.judge(table(spark, sf_dir, "documents"))


def op10_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = langid.identify(docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text"), langid.fit(docs), ["doc_id", "held_out"])
    return found.select("doc_id", "held_out", "lang_pred", "score")


def op11_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.join(table(spark, sf_dir, "embeddings"))


def op12_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = middle.transform(table(spark, sf_dir, "documents"))
    digests = {"output_sha256": F.col("output"), "restored_sha256": middle.restored(F.col("output"), F.col("form"))}
    return out.select("doc_id", "n", "form", "prefix_chars", "middle_chars", *[F.sha2(c.cast("binary"), 256).alias(name) for name, c in digests.items()])


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = spelling.count_words(table(spark, sf_dir, "documents"), one_in=MISSPELT)
    return spelling.variants(words).select("word", "form", "root", "n", "n_near", "form_n")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_quality, op2_jaccard, op3_bpe, op4_lines, op5_secrets, op6_urls, op7_contamination, op8_html, op9_rules, op10_langid, op11_embeddings, op12_middle, op13_spelling)}


_HOST = r"translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_PATH = r"coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '')"


def oracle_sql() -> dict[str, str]:
    rules = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in URL_RULES)
    return {
        "op6_urls": f"""
WITH u AS (SELECT page_id, {_HOST} AS host, {_PATH} AS path FROM pages),
r(rh, rp, rv) AS (VALUES {rules}),
m AS (SELECT u.page_id, r.rh || r.rp AS rule, r.rv, row_number() OVER (PARTITION BY u.page_id ORDER BY length(r.rh) + length(r.rp) DESC, length(r.rh) DESC) AS k
      FROM u JOIN r ON (u.host = r.rh OR ends_with(u.host, '.' || r.rh)) AND starts_with(u.path, r.rp))
SELECT u.page_id, u.host, u.path, m.rule, coalesce(m.rv, 'allow') AS verdict FROM u LEFT JOIN m ON m.page_id = u.page_id AND m.k = 1
""",
        "op11_embeddings": """
WITH RECURSIVE v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS x FROM embeddings),
good AS (SELECT vec_id, x FROM v WHERE vec_id IS NOT NULL AND len(x) > 0 AND len(list_filter(x, lambda c: c IS NULL OR NOT isfinite(c))) = 0 AND len(list_filter(x, lambda c: c <> 0)) > 0),
link AS (SELECT a.vec_id AS a, b.vec_id AS b FROM good a JOIN good b ON a.vec_id <> b.vec_id AND len(a.x) = len(b.x) AND list_cosine_similarity(a.x, b.x) >= 0.9),
reach(a, b) AS (SELECT a, b FROM link UNION SELECT r.a, l.b FROM reach r JOIN link l ON r.b = l.a),
least AS (SELECT a, min(b) AS b FROM reach GROUP BY a), n AS (SELECT a, count(*) AS n FROM link GROUP BY a)
SELECT v.vec_id, coalesce(n.n, 0) AS n_links, least(v.vec_id, coalesce(least.b, v.vec_id)) AS component_id, coalesce(least.b >= v.vec_id, true) AS kept
FROM v LEFT JOIN least ON least.a = v.vec_id LEFT JOIN n ON n.a = v.vec_id
""",
        "op12_middle": """
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
x AS (SELECT doc_id, t, CAST(length(t) AS BIGINT) AS n, list_transform(range(4), lambda k: CAST('0x' || substr(h, CAST(8 * k + 1 AS INT), 8) AS BIGINT)) AS h FROM d),
c AS (SELECT *, least(h[1] % (n + 1), h[2] % (n + 1)) AS i, greatest(h[1] % (n + 1), h[2] % (n + 1)) AS j,
 CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h[3] % 100 >= 90 THEN 'plain' WHEN h[4] % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM x),
p AS (SELECT *, t[: i] AS prefix, t[i + 1 : j] AS middle, t[j + 1 :] AS suffix FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN i END AS prefix_chars, CASE WHEN form <> 'plain' THEN j - i END AS middle_chars,
 sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256, sha256(t) AS restored_sha256 FROM p
""",
        "op13_spelling": rf"""
WITH RECURSIVE crc AS (SELECT list_transform(range(256), lambda b: list_reduce(list_prepend(b, [0, 0, 0, 0, 0, 0, 0, 0]), lambda c, z: xor(c >> 1, 3988292384 * (c & 1)))) AS t),
run AS (SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS k, translate(unnest(regexp_extract_all(text, '[A-Za-z\x{{C0}}-\x{{FF}}]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS r FROM documents),
kinds AS (SELECT k, r, count(*) AS n, hex(k || ':' || r) AS x FROM run WHERE length(r) >= 5 GROUP BY ALL),
hashed AS (SELECT r, n, xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(range(length(x) // 2), lambda i: CAST('0x' || substr(x, CAST(2 * i + 1 AS INT), 2) AS BIGINT))), lambda c, y: xor(c >> 8, t[(xor(c, y) & 255) + 1]))) AS h FROM kinds, crc),
typed AS (SELECT CASE WHEN h % {MISSPELT} = 0 THEN r[: h % length(r)] || r[h % length(r) + 2 :] ELSE r END AS word, n FROM hashed),
w AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM typed WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3),
gap AS (SELECT word, n, unnest(range(length(word))) AS i FROM w), cut AS (SELECT word, n, i, word[: i] || word[i + 2 :] AS rest FROM gap),
near AS (SELECT a.word, a.n, b.word AS other, b.n AS m FROM cut a JOIN cut b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
 UNION SELECT a.word, a.n, b.word, b.n FROM cut a JOIN w b ON a.rest = b.word UNION SELECT b.word, b.n, a.word, a.n FROM cut a JOIN w b ON a.rest = b.word),
best AS (SELECT word, other, m, n, row_number() OVER (PARTITION BY word ORDER BY m DESC, other) AS k, count(*) OVER (PARTITION BY word) AS n_near FROM near),
form AS (SELECT word, other AS form, m FROM best WHERE k = 1 AND m >= 2 * n),
walk(word, root, depth) AS (SELECT word, word, 0 FROM w UNION ALL SELECT walk.word, form.form, depth + 1 FROM walk JOIN form ON form.word = walk.root),
last AS (SELECT word, arg_max(root, depth) AS root FROM walk GROUP BY word)
SELECT w.word, form.form, last.root, w.n, coalesce(best.n_near, 0) AS n_near, form.m AS form_n
FROM w JOIN last ON last.word = w.word LEFT JOIN form ON form.word = w.word LEFT JOIN best ON best.word = w.word AND best.k = 1
""",
    }
