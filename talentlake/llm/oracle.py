"""DuckDB SQL for the queries that SQL can express over whole tables."""

from __future__ import annotations

from talentlake.llm import url_rules

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

OP2 = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
     p AS (SELECT doc_id, len(w) AS n, unnest(range(1, len(w) + 1)) AS pos, unnest(w) AS word, w FROM d),
     s AS (SELECT doc_id, n, pos, word, CASE WHEN pos + 34 <= n THEN array_to_string(list_slice(w, pos, pos + 34), ' ') END AS win FROM p),
     c AS (SELECT *, win IS NOT NULL AND count(*) OVER (PARTITION BY win) > 1 AS twice FROM s),
     g AS (SELECT *, coalesce(max(CASE WHEN twice THEN pos END) OVER (PARTITION BY doc_id ORDER BY pos) >= pos - 34, false) AS gone FROM c),
     k AS (SELECT doc_id, count(*) FILTER (gone) AS n_removed, string_agg(word, ' ' ORDER BY pos) FILTER (NOT gone) AS kept FROM g GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(k.n_removed, 0) AS BIGINT) AS n_removed, sha256(coalesce(k.kept, '')) AS kept_sha256
FROM d LEFT JOIN k USING (doc_id)
"""

OP3 = rf"""
WITH word AS (SELECT '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+' AS re),
     d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), re) AS w FROM documents, word),
     b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), re) AS w FROM benchmark, word),
     bw AS (SELECT DISTINCT item_id, array_to_string(list_slice(w, s, s + 9), ' ') AS win, least(len(w), 10) AS size
            FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS s FROM b WHERE len(w) > 0)),
     p AS (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS pos FROM d),
     m AS (SELECT p.doc_id, p.pos, x.size, array_to_string(list_slice(p.w, p.pos, p.pos + x.size - 1), ' ') AS win
           FROM p, (SELECT DISTINCT size FROM bw) x WHERE p.pos + x.size - 1 <= len(p.w)),
     f AS (SELECT m.doc_id, m.pos, m.size, bw.item_id FROM m JOIN bw ON m.win = bw.win AND m.size = bw.size),
     h AS (SELECT doc_id, count(DISTINCT spot) AS n_hit FROM (SELECT doc_id, unnest(range(pos, pos + size)) AS spot FROM f) GROUP BY doc_id),
     i AS (SELECT doc_id, count(*) AS n_items, string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS items FROM (SELECT DISTINCT doc_id, item_id FROM f) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN h USING (doc_id) LEFT JOIN i USING (doc_id)
"""

OP7 = """
WITH d AS (SELECT doc_id, octet_length(encode(coalesce(text, ''))) AS n, hex(encode(coalesce(text, ''))) AS x FROM documents),
     p AS (SELECT doc_id, unnest(range(0, n)) AS pos, unnest(list_transform(range(0, n), lambda i: substr(x, 2 * i + 1, 100))) AS win FROM d),
     l AS (SELECT doc_id, pos, left(win, 2) AS byte, length(win) = 100 AND min(doc_id) OVER (PARTITION BY win) < doc_id AS later FROM p),
     g AS (SELECT *, coalesce(max(CASE WHEN later THEN pos END) OVER (PARTITION BY doc_id ORDER BY pos) >= pos - 49, false) AS gone FROM l),
     s AS (SELECT *, gone AND NOT coalesce(lag(gone) OVER (PARTITION BY doc_id ORDER BY pos), false) AS opens FROM g),
     k AS (SELECT doc_id, count(*) FILTER (gone) AS n_removed, count(*) FILTER (opens) AS n_spans, string_agg(byte, '' ORDER BY pos) FILTER (NOT gone) AS kept FROM s GROUP BY doc_id)
SELECT d.doc_id, CAST(d.n AS BIGINT) AS n_bytes, CAST(coalesce(k.n_removed, 0) AS BIGINT) AS n_removed, CAST(coalesce(k.n_spans, 0) AS BIGINT) AS n_spans,
       sha256(unhex(coalesce(k.kept, ''))) AS kept_sha256
FROM d LEFT JOIN k USING (doc_id)
"""

# The method's own list (url_rules.WORDS), in the dialect of SQL's expressions, which have no look-around.
_words = [w for words in url_rules.WORDS.values() for w in words]
HOSTS = "^([^/]*[.-])?(" + "|".join(w for w in _words if "-" not in w) + ")[.-]"
PHRASES = "(^|[./-])(" + "|".join(w.replace("-", "[.-]") for w in _words if "-" in w) + ")([./-]|$)"

OP9 = rf"""
WITH a AS (SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
     b AS (SELECT page_id, rest, regexp_extract(rest, '^[^/?#]*') AS h FROM a),
     c AS (SELECT page_id, translate(h, '{UPPER}', '{LOWER}') AS host, regexp_extract(substr(rest, length(h) + 1), '^[^?#]*') AS path FROM b),
     rules(rh, rp, verdict) AS (VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'), ('com', '/fr/', 'allow'), ('com', '/de/', 'block')),
     f AS (SELECT page_id, max_by(rh || rp, length(rh || rp)) AS rule, max_by(verdict, length(rh || rp)) AS verdict
           FROM c JOIN rules ON (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp) GROUP BY page_id)
SELECT c.page_id, c.host, c.path, f.rule,
       coalesce(f.verdict, CASE WHEN regexp_matches(translate(host || path, '{UPPER}', '{LOWER}'), '{HOSTS}|{PHRASES}') THEN 'block' ELSE 'allow' END) AS verdict
FROM c LEFT JOIN f USING (page_id)
"""

OP11 = """
WITH r AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
           FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
     s AS (SELECT a.vec_id AS anchor_id, r.vec_id, r.label = a.label AS same, CAST(list_inner_product(a.v, r.v) AS BIGINT) AS score
           FROM r a, r WHERE a.vec_id % 100 = 0 AND a.vec_id <> r.vec_id),
     p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY s.score DESC, s.vec_id) AS INTEGER) AS rank, s.vec_id AS negative_id, positive_score, s.score AS negative_score
FROM p JOIN s USING (anchor_id) WHERE NOT s.same AND 100 * s.score BETWEEN 30 * positive_score AND 90 * positive_score QUALIFY rank <= 10
"""

OP12 = rf"""
WITH word AS (SELECT '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+' AS re),
     d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), re) AS w FROM documents, word),
     z AS (SELECT count(*) FILTER (len(w) > 0) AS n, sum(len(w)) AS l FROM d),
     t AS (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(w) AS term FROM d) GROUP BY ALL),
     f AS (SELECT term, CAST(floor(1000 * ln(CAST(2 * any_value(n) + 2 AS DOUBLE) / (2 * count(*) + 1))) AS BIGINT) AS weight FROM t, z GROUP BY term),
     m AS (SELECT doc_id, 100 - 75 + CAST((75 * len(w) * n) // l AS BIGINT) AS m FROM d, z WHERE len(w) > 0),
     b AS (SELECT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), re)) AS term FROM benchmark, word),
     s AS (SELECT item_id, doc_id, CAST(sum(weight * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
           FROM b JOIN f USING (term) JOIN t USING (term) JOIN m USING (doc_id) GROUP BY ALL)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score FROM s WHERE score > 0 QUALIFY rank <= 10
"""

ORACLE = {"op2_substring_dedup": OP2, "op3_decontamination": OP3, "op7_suffix_dedup": OP7, "op9_url_filters": OP9, "op11_hard_negatives": OP11, "op12_ranked_search": OP12}
