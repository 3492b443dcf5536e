"""DuckDB SQL for the operators that SQL expresses."""

_URL = """
  SELECT page_id, url, html,
         translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(regexp_replace(rest, '^[^/?#]*', ''), '^[^?#]*') AS path
  FROM (SELECT *, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages)
"""

#: No page of the tables carries a canonical link or a refresh; the method's verdict is then allow.
OP1 = f"""
WITH u AS ({_URL}),
rules(verdict, name, start, rule) AS (VALUES ('block', 'net', '/', 'net/'), ('allow', 'example.net', '/en/', 'example.net/en/'),
                                            ('block', 'example.com', '/de/', 'example.com/de/'), ('allow', 'org', '/fr/', 'org/fr/')),
hit AS (
  SELECT page_id, url, max_by(struct_pack(verdict := verdict, rule := rule), length(rule)) AS best
  FROM (SELECT DISTINCT page_id, url, host, path FROM u) JOIN rules
    ON (host = name OR ends_with(host, '.' || name)) AND starts_with(path, start)
  GROUP BY page_id, url)
SELECT u.page_id, u.host, u.path, best.rule AS rule, coalesce(best.verdict, 'allow') AS verdict
FROM u LEFT JOIN hit ON u.page_id IS NOT DISTINCT FROM hit.page_id AND u.url IS NOT DISTINCT FROM hit.url
"""

#: Two of three pages point to the page after them; blocks and allows pass along these links.
LINKED = f"""
WITH RECURSIVE u AS (SELECT *, host || CASE WHEN path = '' THEN '/' ELSE path END || coalesce(nullif(regexp_extract(split_part(url, '#', 1), '[?].*$'), ''), '') AS node FROM ({_URL})),
rules(verdict, name, start, rule) AS (VALUES ('block', 'net', '/', 'net/'), ('allow', 'example.net', '/en/', 'example.net/en/'),
                                            ('block', 'example.com', '/de/', 'example.com/de/'), ('allow', 'org', '/fr/', 'org/fr/')),
hit AS (
  SELECT host, path, max_by(struct_pack(verdict := verdict, rule := rule), length(rule)) AS best
  FROM (SELECT DISTINCT host, path FROM u) JOIN rules ON (host = name OR ends_with(host, '.' || name)) AND starts_with(path, start)
  GROUP BY host, path),
e AS (SELECT DISTINCT a.node AS x, b.node AS y FROM u a JOIN u b ON b.page_id = a.page_id + 1 WHERE a.page_id % 3 <> 0 AND a.node <> b.node),
b AS (SELECT x, y FROM e UNION SELECT y, x FROM e),
walk AS (SELECT x AS node, x AS seen FROM b UNION SELECT walk.node, b.y FROM walk JOIN b ON b.x = walk.seen),
told AS (SELECT walk.node, bool_or(best.verdict = 'allow') AS allow, bool_or(best.verdict = 'block') AS block
         FROM walk JOIN u ON u.node = walk.seen LEFT JOIN hit ON hit.host = u.host AND hit.path = u.path GROUP BY walk.node)
SELECT u.page_id, u.host, u.path, best.rule AS rule,
       coalesce(best.verdict, CASE WHEN allow THEN 'allow' WHEN block THEN 'block' ELSE 'allow' END) AS verdict, told.node IS NOT NULL AS aliased
FROM u LEFT JOIN hit ON hit.host = u.host AND hit.path = u.path LEFT JOIN told ON told.node = u.node
"""

OP2 = """
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages),
k AS (SELECT payload_digest, payload_bytes, max(page_id) AS keeper FROM p WHERE payload_bytes >= 1000 GROUP BY ALL)
SELECT p.page_id, p.payload_bytes, p.payload_digest,
       CASE WHEN keeper IS NULL OR keeper IS NOT DISTINCT FROM p.page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN keeper IS NOT DISTINCT FROM p.page_id THEN NULL ELSE keeper END AS refers_to
FROM p LEFT JOIN k USING (payload_digest, payload_bytes)
"""

_OP9 = r"""
m AS (SELECT row_number() OVER () AS id, conv_id, turn, role, coalesce(text, '') AS text FROM messages),
l AS (
  SELECT id, conv_id, turn, i, length(regexp_extract(line, '^(?:[ \t]*>)+')) - length(replace(regexp_extract(line, '^(?:[ \t]*>)+'), '>', '')) AS level,
         regexp_replace(regexp_replace(line, '^(?:[ \t]*>)+', ''), '^ ', '') AS line
  FROM (SELECT id, conv_id, turn, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS i FROM m WHERE regexp_matches(text, '(?m)^[ \t]*>'))),
r AS (SELECT id, conv_id, turn, i, level, line, sum(CASE WHEN level IS DISTINCT FROM before THEN 1 ELSE 0 END) OVER (PARTITION BY id ORDER BY i) AS run
      FROM (SELECT *, lag(level) OVER (PARTITION BY id ORDER BY i) AS before FROM l)),
p AS (SELECT id, conv_id, turn, run, level, string_agg(line, chr(10) ORDER BY i) AS passage FROM r WHERE level > 0 GROUP BY ALL),
own AS (SELECT id, string_agg(line, chr(10) ORDER BY i) AS own FROM l WHERE level = 0 GROUP BY id),
s AS (SELECT m.*, CASE WHEN m.id IN (SELECT id FROM l) THEN regexp_replace(coalesce(own, ''), '^\n+|\n+$', '', 'g') ELSE text END AS reply,
             coalesce(levels, 0) AS levels, coalesce(n_quotes, 0) AS n_quotes
      FROM m LEFT JOIN own USING (id) LEFT JOIN (SELECT id, max(level) AS levels, count(*) AS n_quotes FROM p GROUP BY id) USING (id)),
qf AS (SELECT id, conv_id, turn, level, 0 AS rank, passage AS form FROM p UNION ALL
       SELECT id, conv_id, turn, level, 1, unnest(string_split(passage, chr(10))) FROM p),
q AS (SELECT DISTINCT conv_id, turn, level, rank, trim(regexp_replace(lower(form), '[^\p{L}\p{N}]+', ' ', 'g')) AS form FROM qf WHERE conv_id IS NOT NULL AND turn IS NOT NULL),
of AS (SELECT conv_id, turn, reply AS form FROM s UNION ALL SELECT conv_id, turn, unnest(string_split(reply, chr(10))) FROM s),
o AS (SELECT form, conv_id, min(turn) AS first FROM (SELECT conv_id, turn, trim(regexp_replace(lower(form), '[^\p{L}\p{N}]+', ' ', 'g')) AS form FROM of WHERE conv_id IS NOT NULL AND turn IS NOT NULL)
      WHERE form <> '' GROUP BY ALL),
c AS (SELECT q.conv_id, q.turn, q.level, q.rank, CASE WHEN o.conv_id = q.conv_id THEN 0 ELSE 1 END AS far, o.conv_id AS c, o.first AS t
      FROM q JOIN o ON o.form = q.form AND CASE WHEN o.conv_id = q.conv_id THEN o.first < q.turn ELSE length(q.form) >= 8 END),
b AS (SELECT conv_id, turn, min(struct_pack(far := far, level := level, rank := rank, c := c, t := t)) AS b FROM c GROUP BY ALL),
f AS (SELECT conv_id, turn, b.c AS parent_conv, b.t AS parent_turn FROM b),
w AS (SELECT conv_id, turn, parent_turn AS up, 1 AS depth FROM f WHERE parent_conv = conv_id
      UNION ALL SELECT w.conv_id, w.turn, f.parent_turn, w.depth + 1 FROM w JOIN f ON f.conv_id = w.conv_id AND f.turn = w.up AND f.parent_conv = f.conv_id),
d AS (SELECT conv_id, turn, min(up) AS thread_turn, max(depth) AS depth FROM w GROUP BY ALL)
SELECT s.conv_id, s.turn, role, reply, CAST(levels AS INTEGER) AS levels, CAST(n_quotes AS INTEGER) AS n_quotes, parent_conv, parent_turn,
       coalesce(thread_turn, s.turn) AS thread_turn, CAST(coalesce(depth, 0) AS INTEGER) AS depth
FROM s LEFT JOIN f ON s.conv_id = f.conv_id AND s.turn = f.turn LEFT JOIN d ON s.conv_id = d.conv_id AND s.turn = d.turn
"""

OP9 = "WITH RECURSIVE messages AS (SELECT * FROM conversations)," + _OP9

#: The conversations of the tables hold no quotation, so replies are made to quote the turns before them.
QUOTED = """WITH RECURSIVE said AS (SELECT conv_id, turn, min(text) AS said FROM conversations WHERE conv_id IS NOT NULL AND turn IS NOT NULL GROUP BY ALL),
messages AS (
  SELECT c.conv_id, c.turn, role, CASE
    WHEN c.turn % 4 = 1 AND a.said IS NOT NULL THEN '> ' || replace(a.said, chr(10), chr(10) || '> ') || chr(10) || coalesce(text, '')
    WHEN c.turn % 4 = 2 AND a.said IS NOT NULL AND b.said IS NOT NULL THEN '>> ' || replace(b.said, chr(10), chr(10) || '> > ') || chr(10) || '>' || replace(a.said, chr(10), chr(10) || '> ') || chr(10) || coalesce(text, '')
    WHEN c.turn % 4 = 3 AND o.said IS NOT NULL THEN coalesce(text, '') || chr(10) || '> ' || split_part(o.said, chr(10), 1) || chr(10) || 'so I read' ELSE text END AS text
  FROM conversations c LEFT JOIN said a ON a.conv_id = c.conv_id AND a.turn = c.turn - 1 LEFT JOIN said b ON b.conv_id = c.conv_id AND b.turn = c.turn - 2
  LEFT JOIN said o ON o.conv_id = c.conv_id + 1 AND o.turn = 0),""" + _OP9

ORACLES = {"op1_url_filter": OP1, "linked_pages": LINKED, "op2_warc_index": OP2, "op9_quotations": OP9, "quoted_conversations": QUOTED}
