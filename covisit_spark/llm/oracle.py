"""DuckDB SQL of the queries that SQL can express."""

from __future__ import annotations

from covisit_spark.llm.merkle import FAN, FIELDS
from covisit_spark.llm.phrases import COVERED, LEAST, TOP
from covisit_spark.llm.queries import LISTED_HOSTS
from covisit_spark.llm.topk import EVERY, K, SCALE
from covisit_spark.llm.url_filter import RULES
from covisit_spark.llm.warc import BASE32

URL_PARTS = "(?s)^.*?://([^/?#]*)([^?#]*)(\\?[^#]*)?"


def _rules() -> str:
    rows = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in RULES)
    return f"(VALUES {rows}) AS r(rule_host, rule_path, says)"


def url_filter_sql() -> str:
    hosts = ", ".join(f"'{h}'" for h in LISTED_HOSTS)
    part = lambda g: f"regexp_extract(coalesce(url, ''), '{URL_PARTS}', {g})"
    return f"""
WITH parts AS (
  SELECT page_id, translate({part(1)}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         {part(2)} AS path, list_sort(list_filter(string_split(substr({part(3)}, 2), '&'),
           lambda x: x <> '' AND NOT regexp_matches(x, '^(utm_[a-z]+|ref|fbclid|gclid|sessionid)(=|$)'))) AS args,
         row_number() OVER () AS row_no
  FROM pages),
named AS (
  SELECT *, CASE WHEN host_only <> '' THEN host_only || regexp_replace(path, '/+$', '')
            || CASE WHEN len(args) > 0 THEN '?' || array_to_string(args, '&') ELSE '' END END AS canonical
  FROM (SELECT *, regexp_replace(regexp_replace(host, ':(80|443)$', ''), '^(www|m)\\.', '') AS host_only FROM parts)),
listed AS (SELECT DISTINCT canonical FROM named WHERE split_part(host, '.', 1) IN ({hosts}) AND canonical IS NOT NULL),
fitting AS (
  SELECT row_no, rule_host || rule_path AS rule, says,
         row_number() OVER (PARTITION BY row_no ORDER BY length(rule_host || rule_path) DESC) AS place
  FROM named JOIN {_rules()} ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path))
SELECT n.page_id, n.host, n.path, f.rule,
       coalesce(f.says, CASE WHEN l.canonical IS NOT NULL THEN 'block' ELSE 'allow' END) AS verdict,
       n.canonical, l.canonical IS NOT NULL AS listed
FROM named n LEFT JOIN fitting f ON f.row_no = n.row_no AND f.place = 1 LEFT JOIN listed l ON l.canonical = n.canonical
"""


def warc_sql() -> str:
    return f"""
WITH hashed AS (
  SELECT page_id, encode(coalesce(html, '')) AS payload, sha1(coalesce(html, '')) AS hex FROM pages),
named AS (
  SELECT page_id, octet_length(payload) AS payload_bytes,
         array_to_string(list_transform(range(32), lambda k: substr('{BASE32}',
           1 + (((('0x' || substr(hex, 1 + 5 * (k // 4), 5))::BIGINT) >> (15 - 5 * (k % 4))) & 31)::BIGINT, 1)), '') AS payload_digest
  FROM hashed),
firsts AS (SELECT payload_digest, min(page_id) AS first FROM named GROUP BY payload_digest)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = first THEN NULL ELSE first END AS refers_to
FROM named JOIN firsts USING (payload_digest)
"""


def phrases_sql() -> str:
    return f"""
WITH docs AS (
  SELECT row_number() OVER () AS d, coalesce(lang, 'und') AS lang,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
pieces AS (SELECT d, lang, unnest(regexp_split_to_array(text, '[.,;:!?\\x0A-\\x0D]')) AS piece FROM docs),
listed AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[\\x20\\x09]+'), lambda w: w <> '') AS w FROM pieces),
starts AS (SELECT lang, unnest(w) AS w1, unnest(list_append(w[2:], NULL)) AS w2, unnest(list_append(w[3:], NULL)) AS w3 FROM listed WHERE len(w) > 0),
f1 AS (SELECT lang, w1, count(*) AS f FROM starts GROUP BY ALL),
f2 AS (SELECT lang, w1, w2, count(*) AS f FROM starts WHERE w2 IS NOT NULL GROUP BY ALL HAVING count(*) >= {LEAST}),
f3 AS (SELECT lang, w1, w2, w3, count(*) AS f FROM starts WHERE w3 IS NOT NULL GROUP BY ALL HAVING count(*) >= {LEAST}),
totals AS (SELECT lang, sum(f)::BIGINT AS n FROM f1 GROUP BY lang),
wider AS (SELECT lang, w1, w2, max(f) AS f FROM (SELECT lang, w1, w2, f FROM f3 UNION ALL SELECT lang, w2, w3, f FROM f3) GROUP BY ALL),
cuts AS (
  SELECT p.lang, p.w1 || ' ' || p.w2 AS phrase, p.f AS a, x.f AS l, y.f AS r, 1 AS j
  FROM f2 p JOIN f1 x ON x.lang = p.lang AND x.w1 = p.w1 JOIN f1 y ON y.lang = p.lang AND y.w1 = p.w2
  LEFT JOIN wider v ON v.lang = p.lang AND v.w1 = p.w1 AND v.w2 = p.w2 WHERE v.f IS NULL OR 100 * v.f < {COVERED} * p.f
  UNION ALL
  SELECT t.lang, t.w1 || ' ' || t.w2 || ' ' || t.w3, t.f, x.f, y.f, 1
  FROM f3 t JOIN f1 x ON x.lang = t.lang AND x.w1 = t.w1 JOIN f2 y ON y.lang = t.lang AND y.w1 = t.w2 AND y.w2 = t.w3
  UNION ALL
  SELECT t.lang, t.w1 || ' ' || t.w2 || ' ' || t.w3, t.f, x.f, y.f, 2
  FROM f3 t JOIN f2 x ON x.lang = t.lang AND x.w1 = t.w1 AND x.w2 = t.w2 JOIN f1 y ON y.lang = t.lang AND y.w1 = t.w3),
graded AS (SELECT *, (1000000::HUGEINT * a * a) // (l::HUGEINT * r) AS score FROM cuts),
scored AS (SELECT * FROM graded QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1),
placed AS (
  SELECT s.*, row_number() OVER (PARTITION BY s.lang ORDER BY score DESC, a DESC, s.phrase) AS rank
  FROM scored s)
SELECT p.lang, rank, phrase, a, l, r, n, score::BIGINT AS score FROM placed p JOIN totals t ON t.lang = p.lang WHERE rank <= {TOP}
"""


# Levels of runs that the statement below spells out: enough for 3^14 documents a source.
SQL_LEVELS = 14


def _tree(base: str, name: str) -> list[str]:
    """CTEs of a tree over ``base`` (tree, idx, digest): levels, sizes and each leaf's (siblings, folded digests) level by level."""
    made = [f"{name}0 AS MATERIALIZED (SELECT tree, idx, digest, count(*) OVER (PARTITION BY tree) AS size FROM {base})"]
    for k in range(1, SQL_LEVELS + 1):
        made.append(
            f"{name}{k} AS MATERIALIZED (SELECT tree, idx, digest, count(*) OVER (PARTITION BY tree) AS size FROM ("
            f"SELECT tree, idx // {FAN} AS idx, sha256(string_agg(digest, '' ORDER BY idx)) AS digest"
            f" FROM {name}{k - 1} WHERE size > 1 GROUP BY tree, idx // {FAN}))"
        )
    tops = " UNION ALL ".join(f"SELECT tree, digest FROM {name}{k} WHERE size = 1" for k in range(SQL_LEVELS + 1))
    made.append(f"{name}_roots AS MATERIALIZED ({tops})")
    return made


def _climb(name: str, start: str, carried: str) -> list[str]:
    """CTEs that take ``start`` (tree, idx, leaf_idx, proof, folded, ``carried``) up the levels of ``name``."""
    made, last = [], start
    for k in range(SQL_LEVELS):
        now = f"{name}_up{k + 1}"
        side = lambda op: f"coalesce(string_agg(s.digest, '' ORDER BY s.idx) FILTER (WHERE s.idx {op} u.idx), '')"  # noqa: B023, E731
        made.append(
            f"{now} AS MATERIALIZED (SELECT u.row_no, u.tree, u.idx // {FAN} AS idx, {carried}, u.proof || {side('<')} || {side('>')} AS proof,"
            f" CASE WHEN max(s.size) > 1 THEN sha256({side('<')} || u.folded || {side('>')}) ELSE u.folded END AS folded"
            f" FROM {last} u LEFT JOIN {name}{k} s ON s.tree = u.tree AND s.size > 1 AND s.idx // {FAN} = u.idx // {FAN}"
            f" GROUP BY u.row_no, u.tree, u.idx, {carried}, u.proof, u.folded)"
        )
        last = now
    return made


def merkle_sql() -> str:
    field = lambda c: f"CASE WHEN {c} IS NULL THEN '-' ELSE strlen({c}::VARCHAR)::VARCHAR || ':' || {c}::VARCHAR END"
    leaf = lambda text: "sha256(" + " || ".join(field(text if c == "text" else c) for c in FIELDS) + ")"
    bits = "list_reduce(list_prepend(4294967295, flatten([[ascii(c), 0, 0, 0, 0, 0, 0, 0] for c in string_split(doc_id::VARCHAR, '')])), lambda x, y: "
    step = "xor(xor(x, y) >> 1, 3988292384 * (xor(x, y) & 1)))"
    ctes = [
        f"rows AS MATERIALIZED (SELECT *, row_number() OVER () AS row_no, coalesce(xor({bits}{step}, 4294967295) % 2 = 0, false) AS hit FROM documents)",
        "cut AS (SELECT *, CASE WHEN hit THEN replace(text, chr(10), '') ELSE text END AS bad FROM rows)",
        f"leaves AS (SELECT row_no, doc_id, source, {leaf('text')} AS leaf, {leaf('bad')} AS folded FROM cut)",
        "ranked AS MATERIALIZED (SELECT *, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS tree,"
        " row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx FROM leaves)",
        "base AS (SELECT tree, idx, leaf AS digest FROM ranked)",
        *_tree("base", "n"),
        "top AS (SELECT 0 AS tree, tree AS idx, digest FROM n_roots)",
        *_tree("top", "t"),
        "asked AS (SELECT row_no, tree, idx, doc_id, leaf, '' AS proof, folded FROM ranked)",
        *_climb("n", "asked", "doc_id, u.leaf"),
        f"between AS MATERIALIZED (SELECT u.row_no, 0 AS tree, u.tree AS idx, doc_id, u.leaf, proof, folded, digest AS subroot FROM n_up{SQL_LEVELS} u JOIN n_roots USING (tree))",
        *_climb("t", "between", "doc_id, u.leaf, u.subroot"),
    ]
    return (
        "WITH " + ",\n".join(ctes) + f"""
SELECT doc_id, leaf, subroot, digest AS root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = digest AS verified
FROM t_up{SQL_LEVELS}, t_roots
"""
    )


def topk_sql() -> str:
    return f"""
WITH v AS (
  SELECT vec_id, min(list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)::BIGINT)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 GROUP BY vec_id),
met AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_sum(list_transform(list_zip(q.v, c.v), lambda z: z[1] * z[2]))::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % {EVERY} = 0 AND c.vec_id <> q.vec_id)
SELECT query_id, rank::INTEGER AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM met) WHERE rank <= {K}
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op3_url_filter": url_filter_sql(),
        "op8_warc": warc_sql(),
        "op11_phrases": phrases_sql(),
        "op12_merkle": merkle_sql(),
        "op13_topk": topk_sql(),
    }
