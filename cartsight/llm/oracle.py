"""DuckDB SQL for the queries of this subpackage that SQL can express."""

from cartsight.llm.mixing import MOST, UNITS, WEIGHTS
from cartsight.llm.secrets import BASE, RULES

_WORD = r"[^\x20\x09-\x0D]+"


def _rule(number: int, kind: str) -> str:
    expression, group, least = RULES[kind]
    quoted = expression.replace("'", "''")
    return f"""
    SELECT rid, {number} AS k, '{kind}' AS kind, {least} AS least, string_split_regex(t, '{quoted}') AS gaps,
           regexp_extract_all(t, '{quoted}', 0) AS hits, regexp_extract_all(t, '{quoted}', {group}) AS parts
    FROM d WHERE regexp_matches(t, '{quoted}')"""


SECRETS = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
m AS ({' UNION ALL '.join(_rule(i, kind) for i, kind in enumerate(RULES))}),
s AS (SELECT *, unnest(range(1, len(hits) + 1)) AS i FROM m),
f AS (
    SELECT rid, k, kind, length(hits[i]) AS n,
           list_sum(list_transform(gaps[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(hits[1:i - 1], lambda x: length(x))), 0) AS a
    FROM s WHERE length(parts[i]) >= least
),
g AS (
    SELECT rid, count(*) FILTER (k = 0) AS n_assign, count(*) FILTER (k = 1) AS n_access, count(*) FILTER (k = 2) AS n_hex,
           string_agg(kind || ':' || a::BIGINT || ':' || (a + n)::BIGINT, ',' ORDER BY a, k) FILTER (k < {len(BASE)}) AS base,
           string_agg(kind || ':' || a::BIGINT || ':' || (a + n)::BIGINT, ',' ORDER BY a, k) AS spans
    FROM f GROUP BY rid
)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN g USING (rid)
"""

MIXING = f"""
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{_WORD}'))::BIGINT AS size FROM documents),
t AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
r AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS r FROM t),
w AS (SELECT *, {MOST}.0::DOUBLE * source_size AS stop, list_extract({[float(w) for w in WEIGHTS]}::DOUBLE[], (r % {len(WEIGHTS)} + 1)::INT) AS w FROM r),
o AS (
    SELECT *, stop / w AS ratio, sum(source_size) OVER () AS everything,
           sum(stop) OVER (ORDER BY stop / w, r ROWS UNBOUNDED PRECEDING) - stop AS given,
           sum(w) OVER (ORDER BY stop / w DESC, r DESC ROWS UNBOUNDED PRECEDING) AS shares
    FROM w
),
l AS (SELECT (everything - given) / shares AS factor FROM o WHERE stop >= (everything - given) / shares * w ORDER BY ratio, r LIMIT 1),
g AS (
    SELECT source, source_size, r, least(stop, factor * w) AS target,
           CASE WHEN source_size > 0 THEN least({MOST * UNITS}, round(least(stop, factor * w) / source_size * {UNITS})::BIGINT) ELSE 0 END AS rate,
           ('0x' || substr(md5('mix' || r), 1, 6))::BIGINT AS shift
    FROM o CROSS JOIN l
),
p AS (
    SELECT d.doc_id, d.size, g.source_size, g.target, g.rate,
           g.shift + g.rate * (row_number() OVER (
               PARTITION BY g.r ORDER BY d.size, md5(coalesce(d.doc_id::VARCHAR, '')), coalesce(d.doc_id::VARCHAR, '')) - 1) AS low
    FROM d JOIN g ON d.source IS NOT DISTINCT FROM g.source
)
SELECT doc_id, size, source_size, target, ((low + rate) // {UNITS} - low // {UNITS})::BIGINT AS copies,
       (((low + rate) // {UNITS} - low // {UNITS}) * size)::BIGINT AS taken
FROM p
"""

ORACLES = {"op3_secrets": SECRETS, "op4_mixing": MIXING}
