"""Registered queries of the operators, and their DuckDB SQL where SQL can
express the result."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabsieve.llm import (arrow_tokens, byte_convnet, chunked_bpe, collocations, divergence, metric_join, pfair_mix, quality_gam,
                          secrets_forest, simhash_anchor, spelling_tree, toxicity, url_filter)
from tabsieve.llm.common import prepare, table


def vocabulary(name: str) -> str:
    """Path of a public vocabulary file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_quality_gam(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality_gam.train(docs, table(spark, sf_dir, "labels"))
    return quality_gam.score(docs, model).select("doc_id", quality_gam.held_out_column(), "score", "predicted")


def op2_arrow_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = f"{prepare(spark)}/tokens-{uuid.uuid4().hex}"
    manifest = arrow_tokens.write_tokens(table(spark, sf_dir, "documents"), folder, vocabulary("word_bpe_49k.json"))
    return arrow_tokens.read_documents(manifest, folder)


def op9_pfair_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Schedule of every document, mixed as a whole row; its text as a hash."""
    return pfair_mix.mix(table(spark, sf_dir, "documents")).select(
        "row.doc_id", "row.source", F.xxhash64("row.text").alias("text_hash"), "block", "slot", "position")


def op10_chunked_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    prepare(spark)
    ranks, pattern = vocabulary("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    return chunked_bpe.encode_digest(table(spark, sf_dir, "documents"), ranks, pattern)


def op3_byte_convnet(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return byte_convnet.identify(docs, byte_convnet.train(docs)).select(
        "doc_id", byte_convnet.held_out_column(), "lang_pred", "score")


def op4_divergence_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    judged = divergence.apply_rules(docs, divergence.references(docs))
    return judged.withColumns({c: F.round(c, 6) for c in ("char_distance", "word_distance")})


def op5_counterfactual_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).select("doc_id", toxicity.held_out_column(), "score", "predicted")


def op6_secrets_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row a finding; the finding itself only as its hash."""
    prepare(spark)
    return secrets_forest.scan(table(spark, sf_dir, "documents")).select(
        "doc_id", "start", F.length("candidate").alias("length"), F.sha2("candidate", 256).alias("candidate_sha256"),
        "word_before", "score", "predicted")


def op7_metric_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metric_join.near_vectors(table(spark, sf_dir, "embeddings"))


def op8_simhash_anchor(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return simhash_anchor.near_duplicates(table(spark, sf_dir, "documents"))


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


def op12_spelling_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_tree.variants(spelling_tree.misspelt_words(table(spark, sf_dir, "documents")))


# The rules of the query.
URL_RULES = [url_filter.Rule("block", "net", "/"), url_filter.Rule("allow", "example.net", "/en/"),
             url_filter.Rule("block", "example.com", "/de/"), url_filter.Rule("allow", "org", "/fr/")]


def op13_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on every page; listed are the URLs of pages full of marks."""
    prepare(spark)
    pages = table(spark, sf_dir, "pages")
    listed = url_filter.listing(url_filter.junk_urls(pages))
    return url_filter.judge(pages.select("page_id", "url"), listed, URL_RULES).select(
        "row.page_id", "host", "path", "rule", "verdict")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality_gam": op1_quality_gam,
    "op2_arrow_tokens": op2_arrow_tokens,
    "op3_byte_convnet": op3_byte_convnet,
    "op4_divergence_rules": op4_divergence_rules,
    "op5_counterfactual_toxicity": op5_counterfactual_toxicity,
    "op6_secrets_forest": op6_secrets_forest,
    "op7_metric_join": op7_metric_join,
    "op8_simhash_anchor": op8_simhash_anchor,
    "op9_pfair_mix": op9_pfair_mix,
    "op10_chunked_bpe": op10_chunked_bpe,
    "op11_collocations": op11_collocations,
    "op12_spelling_tree": op12_spelling_tree,
    "op13_url_filter": op13_url_filter,
}

OP7_SQL = """
WITH RECURSIVE v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
sound AS (SELECT vec_id, e, sqrt(list_dot_product(e, e)) AS norm FROM v
          WHERE e IS NOT NULL AND len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0
                AND len(list_filter(e, lambda x: x <> 0)) > 0),
links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM sound a JOIN sound b ON a.vec_id <> b.vec_id
          WHERE list_dot_product(a.e, b.e) / (a.norm * b.norm) >= 0.9),
reach AS (SELECT vec_id, vec_id AS other FROM v
          UNION SELECT r.vec_id, l.b FROM reach r JOIN links l ON r.other = l.a),
low AS (SELECT vec_id, min(other) AS component_id FROM reach GROUP BY 1),
n AS (SELECT a AS vec_id, count(*) AS n_links FROM links GROUP BY 1)
SELECT low.vec_id, coalesce(n.n_links, 0) AS n_links, component_id, low.vec_id = component_id AS kept
FROM low LEFT JOIN n ON n.vec_id = low.vec_id"""

_SPACE = r"[^\x20\x09-\x0D]"
_KINDS = {"lower": "a-z", "upper": "A-Z", "digit": "0-9", "space": r"\x20\x09-\x0D",
          "punctuation": r"!\"''(),\-./:;?\[\]_", "symbol": "#*$%&|<>", "other_ascii": None,
          "beyond_ascii": r"^\x00-\x7F"}
_LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def _count(chars: str) -> str:
    """Characters of a class in ``text``."""
    negated = chars[1:] if chars.startswith("^") else "^" + chars
    return f"length(regexp_replace(text, '[{negated}]', '', 'g'))"


def _divergence_sql() -> str:
    d = divergence
    counted = {k: _count(c) for k, c in _KINDS.items() if c}
    kinds = ", ".join(f"CAST({c} AS DOUBLE) AS {k}" for k, c in counted.items())
    js = """sqrt(greatest(0, least(1, 0.5 * sum((CASE WHEN p > 0 THEN p * log2(p / ((p + q) / 2)) ELSE 0 END)
                                             + (CASE WHEN q > 0 THEN q * log2(q / ((p + q) / 2)) ELSE 0 END)))))"""
    limit = lambda base, bins, n: f"{base} + {d.NOISE_WEIGHT} * sqrt(({bins}) / (8 * {n} * ln(2)))"
    return f"""
WITH t AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text, text IS NOT NULL AS has, lang
           FROM documents),
w AS (SELECT rid, regexp_extract_all(text, '{_SPACE}+') AS ws FROM t),
lines AS (SELECT rid, sum(n - 1) AS dup FROM (
              SELECT rid, line, count(*) AS n FROM (SELECT rid, unnest(string_split(text, chr(10))) AS line FROM t)
              WHERE regexp_matches(line, '{_SPACE}') GROUP BY 1, 2) GROUP BY 1),
pos AS (SELECT rid, ws, unnest(range(1, len(ws) - {d.WINDOW_WORDS - 2})) AS i FROM w WHERE len(ws) >= {d.WINDOW_WORDS}),
win AS (SELECT rid, i, array_to_string(ws[i:i + {d.WINDOW_WORDS - 1}], ' ') AS g FROM pos),
twice AS (SELECT rid, i FROM win QUALIFY count(*) OVER (PARTITION BY rid, g) > 1),
covered AS (SELECT rid, count(DISTINCT k) AS repeat FROM (
                SELECT rid, unnest(range(i, i + {d.WINDOW_WORDS})) AS k FROM twice) GROUP BY 1),
base AS (SELECT t.rid, doc_id, len(ws) AS n_words,
                coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0) AS word_chars,
                {_count(_KINDS['symbol'])} AS n_symbols, coalesce(dup, 0) AS n_dup_lines,
                coalesce(repeat, 0) AS n_repeat_words
         FROM t JOIN w ON t.rid = w.rid LEFT JOIN lines ON t.rid = lines.rid LEFT JOIN covered ON t.rid = covered.rid),
bare AS (SELECT * FROM (
             SELECT t.rid, lang, has, unnest(list_transform(w.ws, lambda x: trim(translate(x, '{_LETTERS}',
                    '{_LETTERS.lower()}'), '!"''(),-./:;?[]_#*$%&|<>'))) AS word
             FROM t JOIN w ON t.rid = w.rid) WHERE word <> ''),
lang_n AS (SELECT lang, count(*) AS n FROM bare WHERE has AND lang IS NOT NULL GROUP BY 1),
langs AS (SELECT lang, n FROM lang_n WHERE n >= {d.REFERENCE_WORDS}),
common AS (SELECT bare.lang, word, count(*) AS c, any_value(n) AS n FROM bare JOIN langs ON bare.lang = langs.lang
           WHERE has GROUP BY 1, 2 HAVING count(*) >= {d.COMMON_SHARE} * any_value(n)),
k AS (SELECT rid, {kinds}, length(text) AS n_chars, lang, has FROM t),
kt AS (SELECT k.*, n_chars - {' - '.join(counted)} AS other_ascii FROM k),
klong AS (SELECT rid, n_chars, lang, has, kind, v FROM kt UNPIVOT (v FOR kind IN ({', '.join(_KINDS)}))),
kref AS (SELECT langs.lang, kind, sum(v) AS v FROM klong JOIN langs ON klong.lang = langs.lang WHERE has GROUP BY 1, 2),
kq AS (SELECT lang, kind, v / sum(v) OVER (PARTITION BY lang) AS q FROM kref),
cd AS (SELECT rid, lang, n_chars, {js} AS dist FROM (
           SELECT klong.rid, kq.lang, n_chars, v / n_chars AS p, q FROM klong JOIN kq ON klong.kind = kq.kind
           WHERE n_chars >= {d.MIN_CHARS}) GROUP BY 1, 2, 3),
seen AS (SELECT rid, word, count(*) AS c FROM bare GROUP BY 1, 2),
totals AS (SELECT seen.rid, sum(c) AS total FROM seen JOIN w ON seen.rid = w.rid WHERE len(ws) >= {d.MIN_WORDS}
           GROUP BY 1 HAVING sum(c) >= {d.MIN_WORDS}),
cells AS (SELECT totals.rid, common.lang, total, coalesce(seen.c, 0) / total AS p, common.c / common.n AS q
          FROM totals CROSS JOIN common LEFT JOIN seen ON seen.rid = totals.rid AND seen.word = common.word),
filled AS (SELECT rid, lang, total, p, q FROM cells
           UNION ALL SELECT rid, lang, total, 1 - sum(p), 1 - sum(q) FROM cells GROUP BY 1, 2, 3),
wd AS (SELECT rid, lang, total, count(*) AS bins, {js} AS dist FROM filled GROUP BY 1, 2, 3),
best AS (SELECT rid, arg_min(lang, (dist, lang)) AS lang FROM (
             SELECT rid, lang, dist FROM wd
             UNION ALL SELECT rid, lang, dist FROM cd WHERE rid NOT IN (SELECT rid FROM wd))
         WHERE rid NOT IN (SELECT rid FROM t WHERE lang IS NOT NULL AND lang NOT IN (SELECT lang FROM langs)) GROUP BY 1),
judged AS (SELECT base.*, n_words < {d.BASE_MIN_WORDS} OR 100 * n_repeat_words > {d.BASE_MAX_REPEAT_PERCENT} * n_words
                      AS base_failed,
                  cd.dist AS cdist, wd.dist AS wdist, best.lang AS nearest_lang,
                  coalesce(cd.dist > {limit(d.MAX_CHAR_DISTANCE, len(_KINDS), 'n_chars')}, false)
                  OR coalesce(wd.dist > {limit(d.MAX_WORD_DISTANCE, 'bins', 'total')}, false) AS far
           FROM base LEFT JOIN best ON base.rid = best.rid
           LEFT JOIN cd ON cd.rid = best.rid AND cd.lang = best.lang
           LEFT JOIN wd ON wd.rid = best.rid AND wd.lang = best.lang)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars,
       CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines,
       CAST(n_repeat_words AS BIGINT) AS n_repeat_words, base_failed, NOT base_failed AND NOT far AS kept,
       round(cdist, 6) AS char_distance, round(wdist, 6) AS word_distance, nearest_lang
FROM judged"""


_LOWER = f"translate(coalesce(text, ''), '{_LETTERS}', '{_LETTERS.lower()}')"

OP11_SQL = f"""
WITH p AS (SELECT row_number() OVER () AS pid, lang, piece FROM (
               SELECT coalesce(lang, 'und') AS lang,
                      unnest(regexp_extract_all({_LOWER}, '[^.,;:!?\\x0A-\\x0D]+')) AS piece FROM documents)),
w AS MATERIALIZED (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS ws FROM p),
f1 AS (SELECT lang, w1, count(*) AS c FROM (SELECT lang, unnest(ws) AS w1 FROM w) GROUP BY 1, 2),
at2 AS (SELECT lang, ws, unnest(range(1, len(ws))) AS i FROM w WHERE len(ws) > 1),
f2 AS (SELECT lang, w1, w2, count(*) AS c FROM (SELECT lang, ws[i] AS w1, ws[i + 1] AS w2 FROM at2) GROUP BY 1, 2, 3),
at3 AS (SELECT lang, ws, unnest(range(1, len(ws) - 1)) AS i FROM w WHERE len(ws) > 2),
f3 AS (SELECT lang, w1, w2, w3, count(*) AS c FROM (
           SELECT lang, ws[i] AS w1, ws[i + 1] AS w2, ws[i + 2] AS w3 FROM at3) GROUP BY 1, 2, 3, 4 HAVING count(*) >= 10),
longer AS (SELECT lang, w1, w2, max(c) AS c FROM (
               SELECT lang, w1, w2, c FROM f3 UNION ALL SELECT lang, w2, w3, c FROM f3) GROUP BY 1, 2, 3),
two AS (SELECT f2.lang, f2.w1 || ' ' || f2.w2 AS phrase, f2.c AS a, x.c AS l, y.c AS r,
               1000000::HUGEINT * f2.c * f2.c // (x.c::HUGEINT * y.c) AS score
        FROM f2 JOIN f1 x ON x.lang = f2.lang AND x.w1 = f2.w1 JOIN f1 y ON y.lang = f2.lang AND y.w1 = f2.w2
        LEFT JOIN longer g ON g.lang = f2.lang AND g.w1 = f2.w1 AND g.w2 = f2.w2
        WHERE f2.c >= 10 AND (g.c IS NULL OR 100 * g.c < 50 * f2.c)),
cut AS (SELECT f3.lang, f3.w1 || ' ' || f3.w2 || ' ' || f3.w3 AS phrase, f3.c AS a, x.c AS l1, q.c AS r1, p.c AS l2, z.c AS r2,
               1000000::HUGEINT * f3.c * f3.c // (x.c::HUGEINT * q.c) AS s1,
               1000000::HUGEINT * f3.c * f3.c // (p.c::HUGEINT * z.c) AS s2
        FROM f3 JOIN f1 x ON x.lang = f3.lang AND x.w1 = f3.w1 JOIN f1 z ON z.lang = f3.lang AND z.w1 = f3.w3
        JOIN f2 p ON p.lang = f3.lang AND p.w1 = f3.w1 AND p.w2 = f3.w2
        JOIN f2 q ON q.lang = f3.lang AND q.w1 = f3.w2 AND q.w2 = f3.w3),
found AS (SELECT * FROM two
          UNION ALL SELECT lang, phrase, a, CASE WHEN s1 <= s2 THEN l1 ELSE l2 END, CASE WHEN s1 <= s2 THEN r1 ELSE r2 END,
                           least(s1, s2) FROM cut),
total AS (SELECT lang, CAST(sum(c) AS BIGINT) AS n FROM f1 GROUP BY 1),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM found)
SELECT ranked.lang, rank, phrase, a, l, r, n, CAST(score AS BIGINT) AS score
FROM ranked JOIN total ON total.lang = ranked.lang WHERE rank <= 2000"""

OP12_SQL = f"""
WITH RECURSIVE tab AS (SELECT list_transform(range(256), lambda x: list_reduce(list_prepend(x, range(8)), lambda c, k:
                 CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
run AS (SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS d, unnest(regexp_extract_all({_LOWER}, '[a-zA-Z\u00C0-\u00FF]+')) AS w
        FROM documents),
seen AS (SELECT w, hex(encode(d || ':' || w)) AS h, count(*) AS n FROM run WHERE length(w) >= 7 GROUP BY d, w),
crc AS (SELECT w, n, xor(4294967295, list_reduce(
            list_prepend(4294967295, list_transform(range(0, length(h) // 2), lambda i: CAST('0x' || h[2 * i + 1:2 * i + 2] AS BIGINT))),
            lambda c, b: xor(c >> 8, tab.t[(xor(c, b) & 255) + 1]))) AS c FROM seen, tab),
word AS MATERIALIZED (SELECT w AS word, CAST(sum(n) AS BIGINT) AS n FROM (
             SELECT CASE WHEN c % 31 = 0 THEN left(w, c % length(w)) || substr(w, c % length(w) + 2) ELSE w END AS w, n FROM crc)
         WHERE length(w) >= 7 GROUP BY 1 HAVING sum(n) >= 2),
less AS MATERIALIZED (SELECT word, n, i, left(word, i - 1) || substr(word, i + 1) AS rest
         FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM word)),
shorter AS (SELECT DISTINCT less.word AS y, less.n AS yn, word.word AS x, word.n AS xn FROM less JOIN word ON word.word = less.rest),
near AS (SELECT a.word AS word, b.word AS other, b.n AS m FROM less a JOIN less b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
         UNION ALL SELECT y, x, xn FROM shorter UNION ALL SELECT x, y, yn FROM shorter),
best AS (SELECT word, count(*) AS n_near, arg_min(other, (-m, other)) AS form, max(m) AS m FROM near GROUP BY 1),
formed AS MATERIALIZED (SELECT word.word, n, coalesce(n_near, 0) AS n_near, CASE WHEN m >= 10 * n THEN form END AS form,
                  CASE WHEN m >= 10 * n THEN m END AS form_n FROM word LEFT JOIN best ON best.word = word.word),
walk AS (SELECT word, word AS here, 0 AS steps FROM formed
         UNION ALL SELECT walk.word, formed.form, steps + 1 FROM walk JOIN formed ON formed.word = walk.here WHERE formed.form IS NOT NULL),
root AS (SELECT word, arg_max(here, steps) AS root FROM walk GROUP BY 1)
SELECT formed.word, form, root, n, n_near, form_n FROM formed JOIN root ON root.word = formed.word"""


def _url_sql() -> str:
    u = url_filter
    rules = ", ".join(f"('{r.verdict}', '{r.host}', '{r.path}')" for r in URL_RULES)
    host = f"""translate(regexp_extract(url, '^(?s:.*?)://([^/?#]*)', 1), '{_LETTERS}', '{_LETTERS.lower()}')"""
    return f"""
WITH rules AS (SELECT * FROM (VALUES {rules}) AS v(verdict, rh, rp)),
part AS (SELECT row_number() OVER () AS rid, page_id, html, coalesce({host}, '') AS host,
                coalesce(regexp_extract(url, '^(?s:.*?)://[^/?#]*([^?#]*)', 1), '') AS path,
                list_sort(list_filter(string_split(regexp_extract(url, '^[^#?]*[?]([^#]*)', 1), '&'), lambda q:
                    q <> '' AND NOT regexp_matches(q, '^(utm_[^=]*|gclid|fbclid|ref)(=|$)'))) AS asked FROM pages),
page AS (SELECT *, CASE WHEN bare <> '' THEN bare || regexp_replace(path, '/+$', '')
                        || CASE WHEN len(asked) > 0 THEN '?' || array_to_string(asked, '&') ELSE '' END END AS canonical
         FROM (SELECT *, regexp_replace(regexp_replace(host, '^www[.]', ''), '[.]?(:80|:443)?$', '') AS bare FROM part)),
listed AS (SELECT DISTINCT canonical FROM page WHERE canonical IS NOT NULL
           AND length(html) - length(translate(html, '{u.JUNK_MARKS}', '')) >= {u.JUNK_SHARE} * greatest(length(html), 1)),
fits AS (SELECT rid, arg_max(rh || rp, (length(rh || rp), rh || rp)) AS rule, arg_max(verdict, (length(rh || rp), rh || rp)) AS verdict
         FROM page JOIN rules ON (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp) GROUP BY 1)
SELECT page_id, host, path, rule,
       coalesce(fits.verdict, CASE WHEN listed.canonical IS NULL THEN 'allow' ELSE 'block' END) AS verdict
FROM page LEFT JOIN fits ON fits.rid = page.rid LEFT JOIN listed ON listed.canonical = page.canonical"""


# Order of rows is by XXH64 (op8 fingerprints, op9 places), merges and trained models: beyond SQL.
ORACLE: dict[str, str] = {"op4_divergence_rules": _divergence_sql(), "op7_metric_join": OP7_SQL, "op11_collocations": OP11_SQL,
                          "op12_spelling_tree": OP12_SQL, "op13_url_filter": _url_sql()}
