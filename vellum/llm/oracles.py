"""SQL for the queries that plain SQL can express on whole tables."""

from __future__ import annotations

FOLD = r"regexp_replace(lower({0}), '[^\p{{L}}\p{{N}}]', '', 'g')"


def fold(x: str) -> str:
    return FOLD.format(x)


_SIXTEEN = "sha1('0:' || doc_id::VARCHAR)"
_UNSIGNED = "('0x' || " + " || ".join(f"substr({_SIXTEEN}, {i}, 2)" for i in range(15, 0, -2)) + ")::UBIGINT::HUGEINT"
#: The mixture's drawing order: ranges are told by the key's leading bits, so keys count as unsigned there.
_KEY = _UNSIGNED
_SOURCE = "nullif(replace(trim(lower(source)), ' ', '_'), '')"

P6_CLASSES = f"""
WITH d AS (
  SELECT 'documents' AS in_table, doc_id AS id, {fold('text')} AS k FROM documents WHERE text IS NOT NULL
), o AS (
  SELECT record_id, CASE WHEN json_valid(raw) THEN raw::JSON END AS j FROM records
), r AS (
  SELECT 'records' AS in_table, record_id AS id, {fold("j->>'text'")} || '|' || coalesce({fold("j->>'title'")}, '') || '|' ||
    coalesce({fold("j->>'lang'")}, '') || '|' || coalesce({fold("j->>'year'")}, '') AS k
  FROM o WHERE json_type(j) = 'OBJECT' AND json_type(j, '$.text') = 'VARCHAR' AND regexp_matches(j->>'text', '\\S')
), a AS (
  SELECT * FROM d WHERE k <> '' UNION ALL SELECT * FROM r
), c AS (
  SELECT in_table, id, min(id) OVER (PARTITION BY in_table, k) AS first_id, count(*) OVER (PARTITION BY in_table, k) AS n_copies FROM a
)
"""

P2_SHARES = f"""
WITH f AS (SELECT doc_id, {fold('text')} AS t FROM documents WHERE text IS NOT NULL),
w AS (SELECT doc_id, p::INT AS p, substr(t, p::INT, 30) AS run FROM (SELECT doc_id, t, unnest(range(1, length(t) - 28)) AS p FROM f WHERE length(t) >= 30)),
a AS (SELECT doc_id, p FROM (SELECT doc_id, p, row_number() OVER (PARTITION BY doc_id, run ORDER BY p) AS k FROM w) WHERE k > 1),
g AS (SELECT doc_id, least(30, p - coalesce(lag(p) OVER (PARTITION BY doc_id ORDER BY p), -30)) AS more FROM a),
r AS (SELECT doc_id, sum(more)::BIGINT AS n FROM g GROUP BY doc_id)
SELECT doc_id, length(t)::BIGINT AS folded_chars, coalesce(n, 0)::BIGINT AS repeated_chars,
  CASE WHEN length(t) > 0 THEN round(coalesce(n, 0)::DOUBLE / length(t), 6) ELSE 0.0 END AS repeated_share
FROM f LEFT JOIN r USING (doc_id)"""

_P4 = """
WITH w AS (SELECT doc_id, p, hash(substr(text, p::INT + 1, 200)) AS h FROM (SELECT doc_id, text, unnest(range(0, length(text) - 199)) AS p FROM documents WHERE length(text) >= 200)),
s AS (SELECT h FROM w GROUP BY h HAVING min(doc_id) <> max(doc_id)),
m AS (SELECT doc_id, p, CASE WHEN p <= lag(p) OVER (PARTITION BY doc_id ORDER BY p) + 200 THEN 0 ELSE 1 END AS fresh FROM w SEMI JOIN s USING (h)),
k AS (SELECT doc_id, p, sum(fresh) OVER (PARTITION BY doc_id ORDER BY p) AS k FROM m),
f AS (SELECT doc_id, min(p)::INT AS start_pos, (max(p) + 200)::INT AS end_pos FROM k GROUP BY doc_id, k)
"""

_P5 = f"""
WITH RECURSIVE f AS (SELECT doc_id, {fold('text')} AS t FROM documents WHERE text IS NOT NULL),
r AS (SELECT DISTINCT doc_id, hash(substr(t, p::INT, 24)) AS h FROM (SELECT doc_id, t, unnest(range(1, length(t) - 22)) AS p FROM f WHERE length(t) >= 24)),
n AS (SELECT doc_id, count(*) AS n FROM r GROUP BY doc_id),
c AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS common FROM r a JOIN r b ON a.h = b.h AND a.doc_id <> b.doc_id GROUP BY 1, 2),
e AS (SELECT x, y FROM c JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y WHERE 2 * common >= nx.n + ny.n - common),
z AS (SELECT doc_id AS node, doc_id AS met FROM n UNION SELECT z.node, e.y FROM z JOIN e ON e.x = z.met),
g AS (SELECT node, min(met) AS least FROM z GROUP BY node)
"""

_MIX = f"""
WITH i AS (SELECT doc_id, {_SOURCE} AS source, coalesce(length(text), 0)::BIGINT AS size FROM documents WHERE {_SOURCE} IS NOT NULL),
k AS (SELECT *, {_KEY} AS key FROM i),
o AS (SELECT *, sum(size) OVER (PARTITION BY source ORDER BY key, doc_id ROWS UNBOUNDED PRECEDING) AS upto FROM k),
s AS (SELECT source, sum(size) AS own FROM i GROUP BY source),
j AS (SELECT m.source, target_share, max_repeats, coalesce(own, 0)::BIGINT AS own FROM mix_targets m LEFT JOIN s USING (source)),
b AS (SELECT *, floor(least(target_share * (SELECT sum(own) FROM j), (max_repeats * own)::DOUBLE))::BIGINT AS budget FROM j),
e AS (SELECT source, CASE WHEN own > 0 THEN budget // own ELSE 0 END AS epochs, budget - CASE WHEN own > 0 THEN budget // own ELSE 0 END * own AS rest FROM b),
u AS (SELECT source, doc_id, size, (upto - size)::BIGINT AS position, (epochs + CASE WHEN upto <= rest AND rest > 0 THEN 1 ELSE 0 END)::BIGINT AS uses FROM o JOIN e USING (source))
SELECT * FROM u WHERE uses > 0"""

P10_LIMITS = f"""
WITH t AS (SELECT coalesce({_SOURCE}, '') AS source, length(text) AS chars, octet_length(encode(text)) AS bytes FROM documents WHERE regexp_matches(text, '[^\\s]')),
c AS (SELECT source, unit, length, count(*) AS ends FROM (SELECT source, 'chars' AS unit, chars AS length FROM t UNION ALL SELECT source, 'bytes', bytes FROM t) GROUP BY ALL),
r AS (SELECT *, sum(ends) OVER (PARTITION BY source, unit ORDER BY length ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS reach FROM c),
x AS (SELECT *, sum(ends) OVER w - ends AS near, max(reach) OVER w AS at_risk FROM r WINDOW w AS (PARTITION BY source, unit ORDER BY length RANGE BETWEEN 25 PRECEDING AND 25 FOLLOWING)),
m AS (SELECT *, reach * (near + 1) / (50.0::DOUBLE * at_risk) AS mu FROM x),
p AS (SELECT *, CASE WHEN ends > mu THEN -(ends * ln(ends / mu) - ends + mu) ELSE 0.0 END AS log_p FROM m),
k AS (SELECT *, count(*) OVER (ORDER BY log_p) AS rank, count(*) OVER () AS tests FROM p),
b AS (SELECT max(log_p) AS bar FROM k WHERE exp(log_p) < 0.001 AND exp(log_p) <= rank / tests * 0.001::DOUBLE)
SELECT source, unit, length::BIGINT AS length, ends, reach::BIGINT AS reach, round(ends / reach, 6) AS hazard, round(mu / reach, 6) AS near_hazard, round(log_p, 4) AS log_p
FROM k WHERE log_p <= (SELECT bar FROM b)"""

ORACLES: dict[str, str] = {
    "p2_found": f"SELECT doc_id FROM ({P2_SHARES}) WHERE folded_chars > 0 AND repeated_chars >= 0.3 * folded_chars",
    "p2_shares": P2_SHARES,
    "p4_found": _P4 + "SELECT * FROM f",
    "p4_coverage": _P4 + """, g AS (SELECT doc_id, count(*) AS n, sum(end_pos - start_pos) AS c FROM f GROUP BY doc_id)
SELECT doc_id, length(text)::BIGINT AS chars, coalesce(n, 0)::BIGINT AS stretches, coalesce(c, 0)::BIGINT AS shared_chars,
  CASE WHEN length(text) > 0 THEN round(coalesce(c, 0)::DOUBLE / length(text), 6) ELSE 0.0 END AS shared_share FROM documents LEFT JOIN g USING (doc_id) WHERE text IS NOT NULL""",
    "p5_found": _P5 + "SELECT least AS first_id, node AS doc_id FROM g WHERE least <> node",
    "p5_groups": _P5 + "SELECT node AS doc_id, least AS class_id FROM g",
    "p9_mixture_by_chars": _MIX,
    "p10_limits": P10_LIMITS,
    "p6_found": P6_CLASSES + "SELECT in_table, first_id, id AS copy_id FROM c WHERE id <> first_id",
    "p6_contents": P6_CLASSES + "SELECT DISTINCT in_table, first_id, n_copies FROM c",
    "p9_found": f"""
WITH s AS (SELECT {_SOURCE} AS source, sum(length(text)) AS own FROM documents GROUP BY 1),
j AS (SELECT m.source, m.target_share, m.max_repeats, coalesce(s.own, 0)::BIGINT AS own
      FROM mix_targets m LEFT JOIN s ON m.source = s.source)
SELECT source FROM j WHERE target_share * (SELECT sum(own) FROM j) > max_repeats * own""",
    "p8_found": f"""
WITH i AS (SELECT item_id, {fold('text')} AS t FROM benchmark),
w AS (SELECT DISTINCT item_id, substr(t, p::INT, 40) AS run FROM (SELECT item_id, t, unnest(range(1, length(t) - 38)) AS p FROM i WHERE length(t) >= 40)),
d AS (SELECT doc_id, {fold('text')} AS t FROM documents),
v AS (SELECT doc_id, substr(t, p::INT, 40) AS run FROM (SELECT doc_id, t, unnest(range(1, length(t) - 38)) AS p FROM d WHERE length(t) >= 40))
SELECT DISTINCT item_id, doc_id FROM v JOIN w USING (run)""",
}
