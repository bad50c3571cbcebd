"""Registered queries of the training-text operators and their comparison SQL."""

from __future__ import annotations

from staylens.llm.decontaminate import decontaminate
from staylens.llm.language import identify
from staylens.llm.order_minhash import fingerprint_documents
from staylens.llm.pieces import piece_digests
from staylens.llm.pii import find_pii
from staylens.llm.prefix_trie import prefix_trie
from staylens.llm.quality_model import score_quality
from staylens.llm.quality_rules import judge
from staylens.llm.secret_scan import scan_secrets
from staylens.llm.simhash import simhash_components
from staylens.llm.sphere_kmeans import CLUSTERS, ROUNDS, cluster_vectors
from staylens.llm.text import read_table
from staylens.llm.token_counts import count_sections
from staylens.llm.url_filter import filter_urls, marked_pages


def op1_decontaminate(spark, sf_dir):
    return decontaminate(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op2_token_counts(spark, sf_dir):
    return count_sections(read_table(spark, sf_dir, "documents"))


def op3_pii(spark, sf_dir):
    return find_pii(read_table(spark, sf_dir, "documents"))


def op4_quality_classifier(spark, sf_dir):
    return score_quality(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op5_sentencepiece(spark, sf_dir):
    return piece_digests(read_table(spark, sf_dir, "documents"))


def op6_language_id(spark, sf_dir):
    return identify(read_table(spark, sf_dir, "documents"))


def op7_quality_rules(spark, sf_dir):
    return judge(read_table(spark, sf_dir, "documents"))


def op8_simhash(spark, sf_dir):
    return simhash_components(read_table(spark, sf_dir, "documents"))


def op9_url_filter(spark, sf_dir):
    pages = read_table(spark, sf_dir, "pages")
    return filter_urls(pages, marked_pages(pages))


def op10_secret_scan(spark, sf_dir):
    return scan_secrets(read_table(spark, sf_dir, "documents"))


def op11_order_minhash(spark, sf_dir):
    return fingerprint_documents(read_table(spark, sf_dir, "documents"))


def op12_sphere_kmeans(spark, sf_dir):
    return cluster_vectors(read_table(spark, sf_dir, "embeddings"))


def op13_prefix_trie(spark, sf_dir):
    return prefix_trie(read_table(spark, sf_dir, "conversations"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_decontaminate,
        op2_token_counts,
        op3_pii,
        op4_quality_classifier,
        op5_sentencepiece,
        op6_language_id,
        op7_quality_rules,
        op8_simhash,
        op9_url_filter,
        op10_secret_scan,
        op11_order_minhash,
        op12_sphere_kmeans,
        op13_prefix_trie,
    )
}

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _op1_sql():
    words = rf"list_filter(regexp_split_to_array(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')"
    return f"""WITH d AS (SELECT doc_id, row_number() OVER () AS r, {words} AS w FROM documents),
b AS (SELECT item_id, {words} AS w FROM benchmark),
win AS (SELECT DISTINCT item_id, array_to_string(w[i:i + 12], ' ') AS t, CAST(least(len(w), 13) AS BIGINT) AS n
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
size AS (SELECT DISTINCT n FROM win),
place AS (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, size WHERE len(w) >= n),
hit AS (SELECT r, i, place.n, item_id FROM (SELECT r, i, n, array_to_string(w[i:i + n - 1], ' ') AS t FROM place) place JOIN win ON win.t = place.t AND win.n = place.n),
word AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS p FROM (SELECT DISTINCT r, i, n FROM hit)) GROUP BY r),
item AS (SELECT r, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
  FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS id FROM hit WHERE item_id IS NOT NULL) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN word USING (r) LEFT JOIN item USING (r)"""


def _op7_sql():
    rates = {
        "symbol_rate": "CAST(n_symbols + 1 AS DOUBLE) / (word_chars + 2)",
        "line_ratio": "(n_dup_lines + CAST(0.5 AS DOUBLE)) / (n_lines - n_dup_lines + CAST(0.5 AS DOUBLE))",
        "mean_chars": "CAST(greatest(word_chars, 1) AS DOUBLE) / greatest(n_words, 1)",
    }
    buckets = ", ".join(f"CAST(floor(ln({r}) / ln(CAST(1.1 AS DOUBLE))) AS INT) AS {n}" for n, r in rates.items())
    pairs = " UNION ALL ".join(f"SELECT l, s, '{n}' AS name, {n} AS bucket FROM good" for n in rates)

    def limits(n):
        low = f" AND {n} >= low" if n == "mean_chars" else ""
        return f"coalesce((SELECT bool_and({n} <= high{low}) FROM fence c WHERE c.l = base.l AND c.s = base.s AND c.name = '{n}'), true)"

    return rf"""WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(lang, chr(1)) AS l, coalesce(source, chr(1)) AS s, coalesce(text, '') AS text FROM documents),
w AS (SELECT *, list_filter(regexp_split_to_array(text, '[ 	-]+'), lambda x: x <> '') AS w FROM d),
run AS (SELECT r, i, array_to_string(w[i:i + 4], ' ') AS t FROM (SELECT r, w, unnest(range(1, len(w) - 3)) AS i FROM w WHERE len(w) >= 5)),
twice AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, t) AS c FROM run) WHERE c > 1),
again AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest(range(i, i + 5)) AS p FROM twice) GROUP BY r),
line AS (SELECT r, count(*) AS a, count(*) - count(DISTINCT x) AS n FROM (SELECT r, unnest(string_split(text, chr(10))) AS x FROM d) WHERE regexp_matches(x, '[^ 	-]') GROUP BY r),
count AS (SELECT w.r, doc_id, l, s, CAST(len(w) AS BIGINT) AS n_words, CAST(length(regexp_replace(text, '[ 	-]+', '', 'g')) AS BIGINT) AS word_chars,
  CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]+', '', 'g')) AS BIGINT) AS n_symbols, CAST(coalesce(line.n, 0) AS BIGINT) AS n_dup_lines,
  CAST(coalesce(again.n, 0) AS BIGINT) AS n_repeat_words, coalesce(line.a, 0) AS n_lines FROM w LEFT JOIN line USING (r) LEFT JOIN again USING (r)),
base AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed, {buckets} FROM count),
good AS (SELECT * FROM base WHERE NOT base_failed),
sketch AS (SELECT l, s, name, bucket, count(*) AS n FROM ({pairs}) GROUP BY l, s, name, bucket),
whole AS (SELECT name, bucket, sum(n) / CAST(sum(sum(n)) OVER (PARTITION BY name) AS DOUBLE) AS share FROM sketch GROUP BY name, bucket),
lang AS (SELECT l, name, bucket, (coalesce(n, 0) + 50 * share) / (sum(coalesce(n, 0)) OVER (PARTITION BY l, name) + 50) AS share
  FROM (SELECT DISTINCT l, name FROM sketch) JOIN whole USING (name) LEFT JOIN (SELECT l, name, bucket, sum(n) AS n FROM sketch GROUP BY ALL) USING (l, name, bucket)),
mixed AS (SELECT l, s, name, bucket, coalesce(n, 0) + 50 * share AS n, sum(coalesce(n, 0)) OVER (PARTITION BY l, s, name) + 50 AS total
  FROM (SELECT DISTINCT l, s, name FROM sketch) JOIN lang USING (l, name) LEFT JOIN sketch USING (l, s, name, bucket)),
ranked AS (SELECT *, round(sum(n) OVER (PARTITION BY l, s, name ORDER BY bucket) / total, 9) AS upto FROM mixed),
fence AS (SELECT l, s, name, q1 - (2 * (q3 - q1) + 1) AS low, q3 + 2 * (q3 - q1) + 1 AS high
  FROM (SELECT l, s, name, min(bucket) FILTER (upto >= 0.25) AS q1, min(bucket) FILTER (upto >= 0.75) AS q3 FROM ranked GROUP BY l, s, name))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND {" AND ".join(limits(n) for n in rates)} AS kept FROM base"""


_OP9_SQL = r"""WITH p AS (SELECT page_id, CASE WHEN contains(url, '://') THEN url[strpos(url, '://') + 3:] ELSE '' END AS rest FROM pages),
q AS (SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), '@U', '@L') AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path,
  regexp_extract(rest, '^[^?#]*\?([^#]*)', 1) AS query FROM p),
c AS (SELECT page_id, host, path, concat(regexp_replace(regexp_replace(host, '^(www|m|mobile|amp)\.([^.]+\.)', '\2'), ':(80|443)$', ''),
  rtrim(regexp_replace(rtrim(path, '/'), '(/index)?(\.html?)?\z', ''), '/'), CASE WHEN len(kept) > 0 THEN '?' || array_to_string(list_sort(kept), '&') ELSE '' END) AS key
  FROM (SELECT *, list_filter(string_split(query, '&'), lambda x: x <> '' AND NOT regexp_matches(x, '^(utm_[^=]*|ref|fbclid|gclid)(=|\z)')) AS kept FROM q)),
l AS (SELECT DISTINCT key FROM c JOIN (SELECT DISTINCT page_id FROM pages WHERE regexp_matches(html, '<title>[^<]*(#{3}|[*]{3}|[$]{3}|%{3}|&{3})')) USING (page_id) WHERE key <> ''),
r AS (SELECT *, key IN (SELECT key FROM l) AS listed, CASE
  WHEN (host = 'example.net' OR ends_with(host, '.example.net')) AND starts_with(path, '/en/') THEN 'example.net/en/'
  WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/de/') THEN 'example.com/de/'
  WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/fr/') THEN 'org/fr/'
  WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/') THEN 'net/' END AS rule FROM c)
SELECT page_id, host, path, rule, CASE WHEN rule IN ('example.net/en/', 'org/fr/') THEN 'allow' WHEN rule IS NOT NULL OR listed THEN 'block' ELSE 'allow' END AS verdict, listed FROM r""".replace("@U", _UPPER).replace("@L", _LOWER)


def _op12_sql(clusters: int = CLUSTERS, rounds: int = ROUNDS) -> str:
    """Lloyd's rounds written out: every vector against every centroid, whole numbers only."""
    whole = "list_transform(embedding, lambda x: CAST(least(greatest(floor(1024 * CAST(x AS DOUBLE)), -67108864), 67108864) AS BIGINT))"
    ctes = [
        f"""v AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id, {whole} AS w FROM embeddings
  WHERE len(embedding) = 64 AND list_count(embedding) = 64 AND list_bool_and(list_transform(embedding, lambda x: isfinite(x))))""",
        f"""c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY h, w) - 1 AS c, w AS p
  FROM (SELECT w, sha256('3:' || coalesce(CAST(vec_id AS VARCHAR), '')) AS h FROM v) ORDER BY h, w LIMIT {clusters})""",
    ]
    square = "list_sum(list_transform(range(1, 65), lambda i: (v.w[i] - c.p[i]) * (v.w[i] - c.p[i])))"
    for n in range(rounds + 1):
        ctes.append(
            f"""a{n} AS MATERIALIZED (SELECT r, c, CAST(d AS BIGINT) AS d FROM (SELECT v.r, c.c, {square} AS d FROM v, c{n} c) QUALIFY row_number() OVER (PARTITION BY r ORDER BY d, c) = 1)"""
        )
        if n < rounds:
            ctes.append(
                f"""m{n} AS MATERIALIZED (SELECT c, list(CAST((s - ((s % k) + k) % k) // k AS BIGINT) ORDER BY i) AS p
  FROM (SELECT c, i, sum(w[i]) AS s, count(*) AS k FROM (SELECT a.c, v.w, unnest(range(1, 65)) AS i FROM a{n} a JOIN v USING (r)) GROUP BY c, i) GROUP BY c),
c{n + 1} AS MATERIALIZED (SELECT o.c, coalesce(m.p, o.p) AS p FROM c{n} o LEFT JOIN m{n} m USING (c))"""
            )
    return f"""WITH {", ".join(ctes)}
SELECT vec_id, CAST(c AS INTEGER) AS cluster, d AS distance, CAST(sum(d) OVER (PARTITION BY c) AS BIGINT) AS cluster_inertia, CAST(sum(d) OVER () AS BIGINT) AS inertia,
  sha256(array_to_string(p, ',')) AS centroid_sha256 FROM a{rounds} JOIN c{rounds} USING (c) JOIN v USING (r)"""


_CRC = "list_reduce(list_prepend(4294967295, list_transform(string_split(CAST(c AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))), lambda a, b: list_reduce(list_prepend(xor(a, b), range(8)), lambda s, k: xor(s >> 1, (s & 1) * 3988292384)))"

_OP13_SQL = f"""WITH t AS (SELECT conv_id AS c, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, sha256(length(r) || ':' || r || x)) AS k, length(r) || ':' || r || x AS w, length(x) AS n
  FROM (SELECT conv_id, turn, coalesce(role, '') AS r, coalesce(text, '') AS x FROM conversations WHERE conv_id IS NOT NULL)),
o AS (SELECT c, xor({_CRC}, 4294967295) % 6 AS h FROM (SELECT DISTINCT c FROM t)),
b AS (SELECT o.c, t.k, t.w, t.n FROM o JOIN t ON t.c = o.c - o.c % 100 WHERE t.k <= o.h UNION ALL SELECT o.c, t.k, t.w, t.n FROM o JOIN t ON t.c = o.c WHERE t.k > o.h),
z AS (SELECT c, w, n, row_number() OVER (PARTITION BY c ORDER BY k) AS k FROM b),
s AS MATERIALIZED (SELECT o.c, coalesce(q.w, []) AS w, coalesce(q.n, []) AS n FROM o LEFT JOIN (SELECT c, list(w ORDER BY k) AS w, list(n ORDER BY k) AS n FROM z GROUP BY c) q USING (c)),
p AS MATERIALIZED (SELECT c, w[1:d] AS w, CASE WHEN d > 0 THEN n[d] ELSE 0 END AS n, d, len(w) = d AS last FROM (SELECT *, unnest(range(0, len(w) + 1)) AS d FROM s)),
e AS MATERIALIZED (SELECT w, d, any_value(n) AS n, min(c) AS c, count(*) AS convs, sha256(coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (last), '')) AS ends FROM p GROUP BY w, d),
up AS (SELECT e.*, a.c AS parent FROM e LEFT JOIN e a ON e.d > 0 AND a.d = e.d - 1 AND a.w = e.w[1:e.d - 1]),
kids AS (SELECT w[1:d - 1] AS w, count(*) AS k FROM e WHERE d > 0 GROUP BY 1),
f AS MATERIALIZED (SELECT up.*, coalesce(kids.k, 0) AS k FROM up LEFT JOIN kids USING (w)),
below AS (SELECT w[1:i] AS w, sum((convs - 1) * n) AS saved, count(*) FILTER (k = 0) AS leaves FROM (SELECT *, unnest(range(0, d + 1)) AS i FROM f) GROUP BY 1)
SELECT c AS conv_id, CAST(d AS BIGINT) AS depth, parent AS parent_conv_id, CAST(convs AS BIGINT) AS n_convs, CAST(k AS BIGINT) AS n_children, CAST(leaves AS BIGINT) AS n_leaves,
  CAST(saved AS BIGINT) AS saved_tokens, ends AS ends_sha256 FROM f JOIN below USING (w)"""


def oracles() -> dict[str, str]:
    return {
        "op1_decontaminate": _op1_sql(),
        "op7_quality_rules": _op7_sql(),
        "op9_url_filter": _OP9_SQL,
        "op12_sphere_kmeans": _op12_sql(),
        "op13_prefix_trie": _OP13_SQL,
    }
