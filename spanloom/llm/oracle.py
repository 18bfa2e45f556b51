"""SQL for queries whose operator is procedural: the same rows by plain joins over all rows."""

from __future__ import annotations

#: Least id of each component by repeated neighbour minima.
_CLOSURE = """walk AS (SELECT id, id AS root FROM vertex UNION SELECT e.v, w.root FROM walk w JOIN edge e ON e.u = w.id),
comp AS (SELECT id, min(root) AS component_id FROM walk GROUP BY id)"""

MINHASH = f"""
WITH RECURSIVE d AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM documents WHERE doc_id IS NOT NULL),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')] ELSE list_transform(range(len(w) - 4), lambda i: array_to_string(w[i + 1 : i + 5], ' ')) END) AS g FROM d),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
l AS (SELECT u, v FROM p JOIN n a ON a.doc_id = u JOIN n b ON b.doc_id = v WHERE 100 * c >= 75 * (a.n + b.n - c)),
edge AS (SELECT u, v FROM l UNION ALL SELECT v, u FROM l), vertex AS (SELECT DISTINCT doc_id AS id FROM d),
{_CLOSURE}
SELECT id AS doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, component_id, id = component_id AS kept FROM comp LEFT JOIN n ON n.doc_id = id
"""

EMBEDDING = f"""
WITH RECURSIVE e AS (SELECT vec_id, embedding::DOUBLE[] AS x, label FROM embeddings WHERE vec_id IS NOT NULL),
g AS (SELECT * FROM e WHERE label IS NOT NULL AND len(x) > 0 AND len(list_filter(x, lambda c: c IS NULL OR NOT isfinite(c))) = 0 AND len(list_filter(x, lambda c: c <> 0)) > 0),
l AS (SELECT a.vec_id AS u, b.vec_id AS v FROM g a JOIN g b ON a.label = b.label AND a.vec_id < b.vec_id AND len(a.x) = len(b.x) WHERE list_cosine_similarity(a.x, b.x) >= 0.98),
edge AS (SELECT u, v FROM l UNION ALL SELECT v, u FROM l), vertex AS (SELECT vec_id AS id FROM e), {_CLOSURE}
SELECT id AS vec_id, (SELECT count(*) FROM edge WHERE u = id)::BIGINT AS n_links, component_id, id = component_id AS kept FROM comp
"""

#: Bytes are pairs of hexadecimal digits; windows are compared by their digest.
SUFFIX = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents WHERE doc_id IS NOT NULL),
w AS (SELECT doc_id, p, md5(substring(h, 2 * p + 1, 200)) AS k FROM (SELECT doc_id, h, unnest(range(len(h) // 2 - 99)) AS p FROM d WHERE len(h) >= 200)),
r AS (SELECT doc_id, p FROM w QUALIFY row_number() OVER (PARTITION BY k ORDER BY doc_id, p) > 1),
t AS (SELECT doc_id, p, CASE WHEN p <= lag(p) OVER (PARTITION BY doc_id ORDER BY p) + 100 THEN 0 ELSE 1 END AS new FROM r),
u AS (SELECT doc_id, p, sum(new) OVER (PARTITION BY doc_id ORDER BY p) AS run FROM t),
s AS (SELECT doc_id, min(p) AS a, max(p) + 100 AS b FROM u GROUP BY doc_id, run),
k AS (SELECT doc_id, a, b, lag(b) OVER (PARTITION BY doc_id ORDER BY a) AS before FROM s),
j AS (SELECT d.doc_id, h, coalesce(sum(b - a), 0) AS gone, count(a) AS spans, coalesce(max(b), 0) AS last,
        coalesce(string_agg(substring(h, 2 * coalesce(before, 0) + 1, 2 * (a - coalesce(before, 0))), '' ORDER BY a), '') AS kept FROM d LEFT JOIN k ON k.doc_id = d.doc_id GROUP BY d.doc_id, h)
SELECT doc_id, (len(h) // 2)::BIGINT AS n_bytes, gone::BIGINT AS n_removed, spans::BIGINT AS n_spans, sha256(unhex(kept || substring(h, 2 * last + 1))) AS kept_sha256 FROM j
"""

#: Lines, their templates and their ends are compared as strings.
LINES = """
WITH t AS (SELECT DISTINCT text FROM documents WHERE text IS NOT NULL),
l AS (SELECT text, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS n FROM t),
m AS (SELECT *, regexp_replace(line, '[^ ]*[0-9][^ ]*', '<*>', 'g') AS m, string_split(line, ' ') AS w FROM l),
e AS (SELECT m, count(*) AS c, string_split(m, ' ') AS w FROM (SELECT regexp_replace(unnest(string_split(text, chr(10))), '[^ ]*[0-9][^ ]*', '<*>', 'g') AS m FROM documents WHERE text IS NOT NULL)
      WHERE trim(m, ' ' || chr(9) || chr(13)) <> '' GROUP BY m),
i AS (SELECT *, len(w)::VARCHAR || ' ' || array_to_string(w[1:3], ' ') AS leaf FROM e),
z AS (SELECT leaf, sum(c) AS every FROM i GROUP BY leaf),
p AS (SELECT m, c, leaf, unnest(w) AS tok, unnest(range(len(w))) AS place FROM i),
k AS (SELECT leaf, place, tok, sum(c) AS lines FROM p GROUP BY ALL HAVING sum(c) >= 5 AND tok <> '<*>'),
f AS (SELECT p.m, p.leaf, p.place, p.tok, k.lines, z.every FROM p JOIN z USING (leaf) LEFT JOIN k ON k.leaf = p.leaf AND k.place = p.place AND k.tok = p.tok),
tpl AS (SELECT m, leaf || chr(3) || string_agg(CASE WHEN lines > 0 THEN tok ELSE chr(1) END, chr(2) ORDER BY place) AS tpl FROM f GROUP BY m, leaf
          HAVING count(lines) > 0 AND 100 * count(lines) >= 70 * count(*) FILTER (WHERE tok <> '<*>')
        UNION SELECT m, leaf || chr(3) || string_agg(CASE WHEN 100 * lines >= 5 * every THEN tok ELSE chr(1) END, chr(2) ORDER BY place) FROM f GROUP BY m, leaf
          HAVING count(*) FILTER (WHERE 100 * lines >= 5 * every) > 0 AND 100 * count(*) FILTER (WHERE 100 * lines >= 5 * every) >= 70 * count(*) FILTER (WHERE tok <> '<*>')),
h AS (SELECT text, n, length(line) AS size, unnest(['first ' || array_to_string(w[1:6], ' '), 'last ' || array_to_string(w[-6:], ' ')]) AS x FROM m),
o AS (SELECT x FROM h WHERE size > 0 GROUP BY x HAVING count(DISTINCT text) >= 5),
y AS (SELECT text, sum(size) AS copied, count(*) AS lines FROM (SELECT DISTINCT text, n, size FROM h JOIN o USING (x) WHERE size > 0) GROUP BY text),
q AS (SELECT text FROM y JOIN (SELECT text, sum(length(line)) AS size, count(*) AS every FROM l WHERE line <> '' GROUP BY text) USING (text) WHERE 100 * copied >= 75 * size AND 100 * lines >= 75 * every),
s AS (SELECT DISTINCT tpl, text FROM m JOIN tpl USING (m)),
g AS (SELECT tpl FROM s LEFT JOIN (SELECT text, 1 AS near FROM q) USING (text) GROUP BY tpl
      HAVING count(*) FILTER (WHERE near IS NULL) >= 5 AND 100 * count(*) FILTER (WHERE near IS NULL) >= 20 * count(*)),
r AS (SELECT text, count(*) AS n, count(*) FILTER (WHERE gone) AS dropped, coalesce(string_agg(line, chr(10) ORDER BY n) FILTER (WHERE NOT gone), '') AS kept
      FROM (SELECT m.*, m IN (SELECT m FROM tpl JOIN g USING (tpl)) AS gone FROM m) GROUP BY text)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_lines, coalesce(dropped, 0)::BIGINT AS n_dropped, coalesce(length(kept), 0)::BIGINT AS kept_chars, sha256(kept) AS text_sha256
FROM documents LEFT JOIN r USING (text)
"""


def secrets() -> str:
    """Matches, what they must hold and the text between them, for each rule; offsets are sums of lengths."""
    from spanloom.llm.secret_scan import BASE_RULES, RULES

    each = []
    for rank, rule in enumerate(RULES):
        pattern = ("(?i)" if rule.fold else "") + rule.pattern.replace("'", "''")
        each.append(
            f"SELECT doc_id, n, {rank} AS rank, '{rule.kind}' AS kind, {rule.least} AS least, regexp_extract_all(t, '{pattern}') AS m, "
            f"regexp_extract_all(t, '{pattern}', {rule.group}) AS h, regexp_split_to_array(t, '{pattern}') AS g FROM d"
        )
    span = "kind || ':' || start || ':' || stop, ',' ORDER BY start, rank"
    count = ", ".join(f"count(*) FILTER (WHERE kind = '{r.kind}') AS n_{r.kind}" for r in BASE_RULES)
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, row_number() OVER () AS n FROM documents),
r AS ({" UNION ALL ".join(each)}),
u AS (SELECT doc_id, n, rank, kind, least, unnest(m) AS m, unnest(h) AS h, unnest(g[1:len(m)]) AS g, unnest(range(len(m))) AS k FROM r),
p AS (SELECT *, sum(length(g) + length(m)) OVER (PARTITION BY n, rank ORDER BY k) AS stop FROM u),
s AS (SELECT n, rank, kind, (stop - length(m))::BIGINT AS start, stop::BIGINT AS stop FROM p WHERE length(h) >= least),
a AS (SELECT n, {count}, coalesce(string_agg({span}) FILTER (WHERE rank < {len(BASE_RULES)}), '') AS base, string_agg({span}) AS spans FROM s GROUP BY n)
SELECT doc_id, {", ".join(f"coalesce(n_{r.kind}, 0)::BIGINT AS n_{r.kind}" for r in BASE_RULES)}, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans FROM d LEFT JOIN a USING (n)
"""
