"""SQL for the queries that SQL can express, for another engine on the same tables."""

from __future__ import annotations

from .chat_format import DEFAULT

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORD = r"[^\x20\x09-\x0D]+"


def components(nodes: str, links: str) -> str:
    """Smallest node that each of ``nodes`` (column id) reaches by ``links`` (a, b, both ways)."""
    return f"""reached(id, c) AS (SELECT id, id FROM {nodes} UNION SELECT {links}.b, reached.c FROM reached JOIN {links} ON {links}.a = reached.id),
component AS (SELECT id, min(c) AS component_id FROM reached GROUP BY id)"""


REPEATS = """WITH h AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents),
p AS (SELECT doc_id, o, substr(x, 2 * o + 1, 598) AS y FROM (SELECT doc_id, x, unnest(range(0, length(x) // 2 - 49, 250)) AS o FROM h WHERE length(x) >= 100)),
w AS (SELECT doc_id, o + i AS s, hash(substr(y, 2 * i + 1, 100)) AS g FROM (SELECT doc_id, o, y, unnest(range(least(250, length(y) // 2 - 49))) AS i FROM p)),
first_seen AS (SELECT g, min(doc_id) AS d FROM w GROUP BY g HAVING min(doc_id) < max(doc_id)),
hit AS (SELECT doc_id, s FROM w JOIN first_seen USING (g) WHERE d < doc_id),
cut AS (SELECT doc_id, s, CASE WHEN s <= lag(s) OVER (PARTITION BY doc_id ORDER BY s) + 50 THEN 0 ELSE 1 END AS fresh FROM hit),
run AS (SELECT doc_id, s, sum(fresh) OVER (PARTITION BY doc_id ORDER BY s) AS r FROM cut),
span AS (SELECT doc_id, r, min(s) AS a, max(s) + 50 AS b FROM run GROUP BY doc_id, r),
gap AS (SELECT doc_id, a, b, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS e FROM span),
kept AS (SELECT doc_id, sum(b - a) AS n_removed, count(*) AS n_spans, string_agg(substr(x, 2 * e + 1, 2 * (a - e)), '' ORDER BY a) || substr(any_value(x), 2 * max(b) + 1) AS rest
  FROM gap JOIN h USING (doc_id) GROUP BY doc_id)
SELECT doc_id, length(x) // 2 AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, coalesce(n_spans, 0) AS n_spans, sha256(unhex(coalesce(rest, x))) AS kept_sha256
FROM h LEFT JOIN kept USING (doc_id)"""

NGRAM_JOIN = f"""WITH RECURSIVE t AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{WORD}') AS w FROM documents),
g AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
  ELSE list_transform(range(1, len(w) - 2), lambda i: array_to_string(list_slice(w, i, i + 3), ' ')) END) AS s FROM t),
n AS (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id),
common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM g a JOIN g b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2),
link AS (SELECT a, b FROM common JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * k >= 85 * (x.n + y.n - k)),
node AS (SELECT doc_id AS id FROM documents), {components("node", "link")}
SELECT id AS doc_id, coalesce(n, 0) AS n_shingles, component_id FROM component LEFT JOIN n ON n.doc_id = id"""

PIVOTS = f"""WITH RECURSIVE v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
  AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
link AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND len(a.e) = len(b.e) AND a.vec_id <> b.vec_id WHERE list_cosine_similarity(a.e, b.e) >= 0.98),
n AS (SELECT a, count(*) AS n_links FROM link GROUP BY a),
node AS (SELECT vec_id AS id FROM embeddings), {components("node", "link")}
SELECT id AS vec_id, coalesce(n_links, 0) AS n_links, component_id, id = component_id AS kept FROM component LEFT JOIN n ON n.a = id"""

# The fixed parts of the default template, around the turns and around a turn's role and text.
_OUTSIDE = len(DEFAULT[: DEFAULT.index("{%")]) + len(DEFAULT[DEFAULT.rindex("%}") + 2 :])
_AROUND = len("<turn >\n</turn>\n")
_MARKED = r"regexp_replace(text, '\\|</?turn|###', 'x\0', 'g')"
_NAMED = r"regexp_replace(role, '[\\>]', 'x\0', 'g')"
CHAT = rf"""WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, unnest([0, 1]), unnest(['user', 'assistant']), '\### Assistant: </turn> ok'),
c AS (SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '') AS loss,
  CAST({_OUTSIDE} + sum({_AROUND} + length({_NAMED}) + length({_MARKED})) AS BIGINT) AS formatted_chars FROM t GROUP BY conv_id)
SELECT conv_id, n_turns, turns_sha256, length(loss) AS loss_chars, sha256(loss) AS loss_sha256, formatted_chars FROM c"""

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
SEARCH = f"""WITH t AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{TERM}') AS w FROM documents),
g AS (SELECT count(*) AS big_n, sum(len(w)) AS big_l FROM t WHERE len(w) > 0),
q AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{TERM}')) AS s FROM benchmark),
tf AS (SELECT doc_id, n, s, count(*) AS tf FROM (SELECT doc_id, len(w) AS n, unnest(w) AS s FROM t) WHERE s IN (SELECT s FROM q) GROUP BY doc_id, n, s),
w AS (SELECT s, CAST(floor(1000 * ln((2 * big_n + 2) / (2 * df + 1))) AS BIGINT) AS w FROM (SELECT s, count(*) AS df FROM tf GROUP BY s), g),
p AS (SELECT doc_id, s, w * ((1000000000 * tf) // (1000 * tf + 20 * CAST(100 - 50 + ((50 * n * big_n) // big_l) AS BIGINT))) AS c FROM tf JOIN w USING (s), g),
r AS (SELECT item_id, doc_id, CAST(sum(c) AS BIGINT) AS score FROM q JOIN p USING (s) GROUP BY item_id, doc_id HAVING sum(c) > 0)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score FROM r QUALIFY rank <= 50"""

PASSAGES = f"""WITH t AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM benchmark),
i AS (SELECT item_id, w, least(len(w), 10) AS k, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS o FROM b WHERE len(w) > 0),
x AS (SELECT DISTINCT item_id, k, array_to_string(list_slice(w, o, o + k - 1), ' ') AS s FROM i),
k AS (SELECT DISTINCT k FROM x),
d AS (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS o FROM t, k WHERE len(w) >= k),
hit AS (SELECT DISTINCT doc_id, o, d.k, item_id FROM d JOIN x ON x.k = d.k AND x.s = array_to_string(list_slice(w, o, o + d.k - 1), ' ')),
n AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(o, o + k)) AS p FROM hit) GROUP BY doc_id),
m AS (SELECT doc_id, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS ids FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS i FROM hit) GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM t LEFT JOIN n USING (doc_id) LEFT JOIN m USING (doc_id)"""


def _codes(rounds: int) -> str:
    steps = ["""v AS MATERIALIZED (SELECT vec_id, label, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)""",
    "p AS MATERIALIZED (SELECT vec_id, label, k, list_slice(e, k * len(e) // 4 + 1, (k + 1) * len(e) // 4) AS x FROM v, range(4) AS r(k))",
    "c0 AS MATERIALIZED (SELECT k, row_number() OVER (PARTITION BY k ORDER BY vec_id) - 1 AS i, x FROM p QUALIFY i < 256)"]
    for r in range(rounds + 1):
        # All components are whole numbers, so these products are exact; distance * 256 + index takes the lower index of ties.
        steps.append(f"""a{r} AS MATERIALIZED (SELECT vec_id, label, p.k, min(CAST(list_inner_product(p.x, p.x) - 2 * list_inner_product(p.x, c.x) + list_inner_product(c.x, c.x) AS BIGINT) * 256 + i) AS d
  FROM p JOIN c{r} c ON c.k = p.k GROUP BY vec_id, label, p.k)""")
        if r < rounds:
            steps.append(f"""m{r} AS (SELECT k, i, list(y ORDER BY j) AS x FROM (SELECT k, i, j, floor(sum(y) / count(*)) AS y FROM (SELECT a.k, a.d % 256 AS i, unnest(p.x) AS y, generate_subscripts(p.x, 1) AS j
  FROM a{r} a JOIN p ON p.vec_id = a.vec_id AND p.k = a.k) GROUP BY k, i, j) GROUP BY k, i),
c{r + 1} AS MATERIALIZED (SELECT c.k, c.i, coalesce(m.x, c.x) AS x FROM c{r} c LEFT JOIN m{r} m ON m.k = c.k AND m.i = c.i)""")
    steps.append(f"s AS (SELECT vec_id, label, string_agg(printf('%02x', d % 256), '' ORDER BY k) AS code, CAST(sum(d // 256) AS BIGINT) AS error FROM a{rounds} GROUP BY vec_id, label)")
    steps.append(f"b AS (SELECT sha256(string_agg(array_to_string(list_transform(x, lambda y: CAST(CAST(y AS BIGINT) AS VARCHAR)), ','), ',' ORDER BY k, i)) AS codebooks_sha256 FROM c{rounds})")
    return f"WITH {', '.join(steps)}\nSELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256 FROM s, b"


CODES = _codes(4)
