"""DuckDB SQL with the results of the corpus queries, where SQL can express them."""

from __future__ import annotations

import string

from . import licenses

LOWER = f"translate(coalesce(text, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}')"

OP9 = rf"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all({LOWER}, '[^\x20\x09-\x0D]+') AS w FROM documents
), sets AS (
  SELECT doc_id, CASE len(w) WHEN 0 THEN [] WHEN 1 THEN w
    ELSE list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) END AS s FROM words
), grams AS MATERIALIZED (
  SELECT doc_id, len(s) AS n, unnest(s) AS g FROM sets
), links AS MATERIALIZED (
  SELECT a.doc_id AS x, b.doc_id AS y FROM grams a JOIN grams b USING (g)
  WHERE a.doc_id <> b.doc_id AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))
), reach AS (
  SELECT doc_id AS x, doc_id AS y FROM documents
  UNION SELECT r.x, l.y FROM reach r JOIN links l ON r.y = l.x
), least_of AS (
  SELECT x, min(y) AS component_id FROM reach GROUP BY x
)
SELECT doc_id, len(s) AS n_shingles, component_id, doc_id = component_id AS kept
FROM sets JOIN least_of ON doc_id = x
"""


def _values(rows) -> str:
    return ", ".join("(" + ", ".join(repr(v) for v in row) + ")" for row in rows)


OP2 = rf"""
WITH templates(template, label, phrase, base) AS (
  VALUES {_values((k, label, phrase, k < len(licenses.BASE)) for k, (label, phrase) in enumerate([*licenses.BASE, *licenses.NOTICES]))}
), split AS (
  SELECT template, label, base, string_split(phrase, ' ') AS w FROM templates
), runs AS (
  SELECT template, label, base, len(w) - 2 AS runs, unnest(range(0, len(w) - 2)) AS t, w FROM split
), words AS MATERIALIZED (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), places AS (
  SELECT r, w, unnest(range(1, len(w) - 1)) AS p FROM words
), hits AS (
  SELECT r, template, label, base, runs, t, p - 1 AS p, p - 1 - t AS d
  FROM places a JOIN runs b ON a.w[p] = b.w[t + 1] AND a.w[p + 1] = b.w[t + 2] AND a.w[p + 2] = b.w[t + 3]
), votes AS (
  SELECT r, template, label, base, runs, d, list(DISTINCT t) AS ts, min(p) AS s, max(p) AS e FROM hits GROUP BY ALL
), marked AS (
  SELECT *, CASE WHEN base OR coalesce(d - lag(d) OVER a > 3, true) THEN 1 ELSE 0 END AS first FROM votes
  WINDOW a AS (PARTITION BY r, template ORDER BY d)
), numbered AS (
  SELECT *, sum(first) OVER (PARTITION BY r, template ORDER BY d) AS span FROM marked
), spans AS (
  SELECT r, label, base, runs, len(list_distinct(flatten(list(ts)))) AS covered, min(s) AS s, max(e) AS e
  FROM numbered GROUP BY r, template, label, base, runs, span
), good AS (
  SELECT r, label, base, covered / runs AS cover, s FROM spans
  WHERE CASE WHEN base THEN covered = runs ELSE covered >= 0.8 * runs AND e - s + 1 <= 1.5 * runs + 3 END
), per_doc AS (
  SELECT r, count(*) FILTER (base) AS n_base, min(s) FILTER (base) AS first_word, max(s) FILTER (base) AS last_word,
    list_sort(list(DISTINCT label) FILTER (base)) AS bl, list_sort(list(DISTINCT label)) AS l, max(cover) AS score
  FROM good GROUP BY r
)
SELECT doc_id, len(w) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
  coalesce(array_to_string(bl, ','), '') AS base_labels, coalesce(array_to_string(l, ','), '') AS labels, coalesce(score, 0.0) AS score
FROM words LEFT JOIN per_doc USING (r)
"""

OP6 = r"""
WITH RECURSIVE given AS MATERIALIZED (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS tokens,
    md5('mix|' || coalesce(doc_id::VARCHAR, '-') || '|' || coalesce(md5(text), '-')) AS k FROM documents
), sized AS MATERIALIZED (
  SELECT source, sum(tokens)::BIGINT AS size FROM given GROUP BY source
), whole AS MATERIALIZED (
  SELECT sum(size)::BIGINT AS total, list(size) FILTER (size > 0) AS sizes FROM sized
), bisect(i, low, high) AS (
  SELECT 0, -1::BIGINT, (1 << 24)::BIGINT
  UNION ALL
  SELECT i + 1, CASE WHEN good THEN low ELSE mid END, CASE WHEN good THEN mid ELSE high END FROM (
    SELECT i, low, high, mid, ln(z) - e / z <= 0.95 * ln(len(sizes)) + 1e-9
      AND pow(list_min(sizes) / total, x) / z * total / list_min(sizes) <= 4.0 + 1e-9 AS good FROM (
        SELECT *, list_sum(list_transform(sizes, lambda s: pow(s / total, x))) AS z,
          list_sum(list_transform(sizes, lambda s: pow(s / total, x) * x * ln(s / total))) AS e FROM (
            SELECT i, low, high, (low + high) // 2 AS mid, ((low + high) // 2) / 16777216.0::DOUBLE AS x, sizes, total FROM bisect, whole
            WHERE high - low > 1)))
), exponent AS (
  SELECT round(min(high) / 16777216.0::DOUBLE, 6) AS x FROM bisect
), weighed AS (
  SELECT source, size, CASE WHEN size > 0 THEN pow(size / total::DOUBLE, x) / sum(CASE WHEN size > 0 THEN pow(size / total::DOUBLE, x) END) OVER () ELSE 0 END AS weight, total, x
  FROM sized, whole, exponent
), goals AS (
  SELECT *, CASE WHEN x = 1 THEN (total::HUGEINT * size // greatest(total, 1))::BIGINT ELSE floor(total * weight)::BIGINT END AS goal, least(ceil(size / 1e6), 65536)::BIGINT AS blocks FROM weighed
), placed AS (
  SELECT g.*, weight, goal, size, total, floor(('0x' || substr(k, 1, 8))::BIGINT * blocks / 4294967296.0::DOUBLE)::BIGINT AS block
  FROM given g JOIN goals s ON g.source IS NOT DISTINCT FROM s.source
), counted AS (
  SELECT *, CASE WHEN tokens = 0 THEN 1 ELSE goal // size
    + CASE WHEN sum(tokens) OVER (PARTITION BY source, tokens > 0 ORDER BY block, k) <= goal % size THEN 1 ELSE 0 END END AS repeats FROM placed
), copies AS (
  SELECT *, unnest(range(1, repeats + 1)) AS pass FROM counted
), drawn AS (
  SELECT *, md5(k || '|' || pass::VARCHAR) AS digest FROM copies
)
SELECT doc_id, source, tokens, round(weight, 9) AS weight, repeats::BIGINT AS repeats, pass::BIGINT AS pass,
  floor(('0x' || substr(digest, 1, 8))::BIGINT * greatest(1, ceil(total / 1e6)) / 4294967296.0::DOUBLE)::BIGINT AS mix_block,
  ('0x' || substr(digest, 9, 8))::BIGINT AS mix_order
FROM drawn
"""

OP8 = r"""
WITH rules(host, path, verdict) AS (
  VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'), ('com', '/fr/', 'allow'), ('com', '/de/', 'block')
), read AS (
  SELECT row_number() OVER () AS r, page_id,
    translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path FROM pages
), fits AS (
  SELECT r, a.host || a.path AS rule, verdict, row_number() OVER (PARTITION BY r ORDER BY length(a.host || a.path) DESC, length(a.host) DESC) AS n
  FROM read JOIN rules a ON (read.host = a.host OR ends_with(read.host, '.' || a.host)) AND starts_with(read.path, a.path)
)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM read LEFT JOIN fits ON read.r = fits.r AND n = 1
"""

OP4 = """
WITH given AS (
  SELECT page_id, coalesce(html, '') AS payload, sha256(coalesce(html, '')) AS payload_digest FROM pages
), linked AS (
  SELECT *, CASE WHEN strlen(payload) >= 100 THEN min(page_id) OVER (PARTITION BY payload_digest) END AS first FROM given
), found AS (
  SELECT *, CASE WHEN page_id IS DISTINCT FROM first THEN first END AS refers_to FROM linked
)
SELECT page_id, strlen(payload)::BIGINT AS payload_bytes, payload_digest, refers_to,
  CASE WHEN refers_to IS NULL THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN refers_to IS NULL THEN true END AS verified
FROM found
"""


def _field(value: str) -> str:
    return f"coalesce(strlen({value}::VARCHAR)::VARCHAR || ':' || {value}::VARCHAR, '-')"


def _crc32(text: str) -> str:
    """CRC-32 of ASCII digits, bit by bit."""
    bits = "[0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]"
    byte = f"list_reduce(list_concat([xor(c, b)], {bits}), lambda y, z: xor(y >> 1, 3988292384::BIGINT * (y & 1)))"
    return f"xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split({text}, ''), lambda d: ascii(d)::BIGINT)), lambda c, b: {byte}), 4294967295::BIGINT)"


#: Levels of threes that the SQL goes through; enough for 3^19 rows in a source.
TREE_LEVELS = 19


def _levels(prefix: str, of: str) -> str:
    """Tables <prefix>k of the nodes of each level, with what stands left and right of a node in its run of three."""
    out = []
    for k in range(TREE_LEVELS + 1):
        run = "OVER (PARTITION BY tree, rank // 3 ORDER BY rank ROWS BETWEEN"
        source = of if not k else f"""(SELECT tree, rank // 3 AS rank, CASE WHEN n > 1 THEN sha256(string_agg(digest, '' ORDER BY rank)) ELSE min(digest) END AS digest
    FROM {prefix}{k - 1} GROUP BY tree, rank // 3, n)"""
        out.append(f"""{prefix}{k} AS MATERIALIZED (
  SELECT tree, rank, digest, count(*) OVER (PARTITION BY tree) AS n,
    coalesce(string_agg(digest, '') {run} UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
    coalesce(string_agg(digest, '') {run} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r FROM {source}
)""")
    return ", ".join(out)


def _walk(prefix: str, levels: str, of: str) -> str:
    out = []
    for k in range(TREE_LEVELS + 1):
        before = of if not k else f"{prefix}{k - 1}"
        out.append(f"""{prefix}{k} AS (
  SELECT w.* REPLACE (w.rank // 3 AS rank, CASE WHEN n > 1 THEN sha256(l || now || r) ELSE now END AS now, CASE WHEN n > 1 THEN proof || l || r ELSE proof END AS proof)
  FROM {before} w JOIN {levels}{k} v ON w.tree = v.tree AND w.rank = v.rank
)""")
    return ", ".join(out)


OP11 = f"""
WITH hashed AS MATERIALIZED (
  SELECT doc_id, coalesce('=' || source, '') AS tree,
    sha256({_field('doc_id')} || {_field('source')} || {_field('lang')} || {_field('n_chars')} || {_field('text')}) AS leaf,
    sha256({_field('doc_id')} || {_field('source')} || {_field('lang')} || {_field('n_chars')} || {_field("CASE WHEN hit THEN replace(text, chr(10), '') ELSE text END")}) AS offered
  FROM (SELECT *, coalesce({_crc32("doc_id::VARCHAR")} % 2 = 0, false) AS hit FROM documents)
), leaves AS MATERIALIZED (
  SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS rank FROM hashed
), {_levels('a', '(SELECT tree, rank, leaf AS digest FROM leaves)')}, groups AS MATERIALIZED (
  SELECT 'all' AS tree, tree AS source, row_number() OVER (ORDER BY tree) - 1 AS rank, digest FROM a{TREE_LEVELS}
), {_levels('b', '(SELECT tree, rank, digest FROM groups)')}, start AS (
  SELECT doc_id, leaf, tree, rank, offered AS now, '' AS proof FROM leaves
), {_walk('u', 'a', 'start')}, further AS (
  SELECT doc_id, leaf, 'all' AS tree, g.rank AS rank, now, proof, g.digest AS subroot FROM u{TREE_LEVELS} w JOIN groups g ON w.tree = g.source
), {_walk('x', 'b', 'further')}
SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, now AS folded_root, now = root AS verified
FROM x{TREE_LEVELS}, (SELECT digest AS root FROM b{TREE_LEVELS})
"""

_FLOOR = "(s - ((s % n) + n) % n) // n"


def _rounds(n: int) -> str:
    out = []
    for t in range(n + 1):
        out.append(f"""a{t} AS MATERIALIZED (
  SELECT r, vec_id, x, j, d FROM (
    SELECT r, vec_id, v.x, j, list_sum(list_transform(list_zip(v.x, c.x), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::BIGINT AS d FROM v, c{t} c
  ) QUALIFY row_number() OVER (PARTITION BY r ORDER BY d, j) = 1
)""")
        if t < n:
            out.append(f"""c{t + 1} AS MATERIALIZED (
  SELECT c.j, coalesce(m.x, c.x) AS x FROM c{t} c LEFT JOIN (
    SELECT j, list(({_FLOOR})::BIGINT ORDER BY i) AS x FROM (
      SELECT j, i, sum(y) AS s, count(*) AS n FROM (SELECT j, unnest(x) AS y, unnest(range(1, 65)) AS i FROM a{t}) GROUP BY j, i
    ) GROUP BY j
  ) m ON c.j = m.j
)""")
    return ", ".join(out)


OP13 = f"""
WITH v AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda y: floor(64 * y::DOUBLE)::BIGINT) AS x FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda y: coalesce(isfinite(y), false))) = 64
), c0 AS MATERIALIZED (
  SELECT j, x FROM (SELECT row_number() OVER (ORDER BY sha256('1:' || vec_id::VARCHAR) NULLS LAST, x, r) - 1 AS j, x FROM v) WHERE j < 16
), {_rounds(3)}
SELECT vec_id, a3.j::INTEGER AS cluster, d AS distance, (sum(d) OVER (PARTITION BY a3.j))::BIGINT AS cluster_inertia,
  (sum(d) OVER ())::BIGINT AS inertia, sha256(array_to_string(c3.x, ',')) AS centroid_sha256
FROM a3 JOIN c3 ON a3.j = c3.j
"""

ORACLE: dict[str, str] = {
    "op4_warc": OP4,
    "op2_diagonal_voting": OP2,
    "op6_temperature_mixing": OP6,
    "op8_range_sweep": OP8,
    "op9_superminhash": OP9,
    "op11_merkle_manifest": OP11,
    "op13_sharded_lloyd": OP13,
}
