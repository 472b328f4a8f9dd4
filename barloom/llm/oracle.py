"""SQL for the queries of this subpackage that SQL can express."""

from __future__ import annotations

VARIABLE = r"^([0-9]+|[0-9a-f]{8,}|[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}|[0-9]{4}-[0-9]{2}-[0-9]{2})(\.[a-z]{1,5})?$"

# The rules, longest first.
RULES = (
    ("www.example.com", "/en/", "www.example.com/en/", "allow"),
    ("example.com", "/en/", "example.com/en/", "block"),
    ("net", "/es/", "net/es/", "block"),
    ("net", "/fr/", "net/fr/", "block"),
    ("com", "/", "com/", "allow"),
)


def _case(value: str) -> str:
    arms = " ".join(
        f"WHEN (host = '{host}' OR ends_with(host, '.{host}')) AND starts_with(path, '{start}') THEN '{(rule, verdict)[value == 'verdict']}'"
        for host, start, rule, verdict in RULES
    )
    return f"CASE {arms} END"


def _level(number: int) -> str:
    """Segments of one depth: a place of many values with few pages each becomes a wildcard."""
    return f"""
here_{number} AS (SELECT *, segments[{number + 1}] AS segment FROM tree_{number - 1}),
place_{number} AS (SELECT host, prefix, count(*) >= 20 AND sum(n) < 5 * count(*) AS varies
  FROM (SELECT host, prefix, segment, sum(n) AS n FROM here_{number} WHERE segment IS NOT NULL GROUP BY ALL) GROUP BY ALL),
tree_{number} AS (SELECT h.* EXCLUDE (prefix, segment), CASE WHEN segment IS NULL THEN prefix
    WHEN varies AND NOT starts_with(segment, '*') THEN prefix || '/*' ELSE prefix || '/' || segment END AS prefix
  FROM here_{number} h LEFT JOIN place_{number} USING (host, prefix))"""


def _alike(hits: str, of: str, other_hits: str, other_of: str) -> str:
    a, n, b, m = (f"CAST({x} AS DOUBLE)" for x in (hits, of, other_hits, other_of))
    pooled = f"(({a} + {b}) / nullif({n} + {m}, 0))"
    gap = f"({a} / nullif({n}, 0) - {b} / nullif({m}, 0))"
    return f"{gap} * {gap} <= 4.0 * ({pooled} * (1 - {pooled}) * (1.0 / nullif({n}, 0) + 1.0 / nullif({m}, 0)))"


PATH_TEMPLATES = rf"""
WITH split_ AS (SELECT page_id,
    translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 1),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 2) AS path FROM pages),
ruled AS (SELECT *, {_case("rule")} AS rule, {_case("verdict")} AS verdict_,
    list_filter(string_split(path, '/'), lambda x: x <> '') AS parts FROM split_),
shown AS (SELECT *, list_aggregate(list_transform(parts[1:3], lambda x: '/' || regexp_replace(x, '{VARIABLE}', '*\3')), 'string_agg', '')
  AS start FROM ruled),
paged AS (SELECT * EXCLUDE (start, parts), coalesce(start, '') || CASE WHEN len(parts) > 3 THEN '/**' ELSE '' END
    || CASE WHEN ends_with(path, '/') AND len(parts) > 0 THEN '/' ELSE '' END AS pattern FROM shown),
patterns AS (SELECT host, pattern, count(*) AS n, count(verdict_) AS labelled,
    count(*) FILTER (verdict_ = 'block') AS blocked FROM paged GROUP BY ALL),
tree_0 AS (SELECT *, string_split(regexp_replace(pattern, '/$', ''), '/') AS segments, '' AS prefix FROM patterns),
{_level(1)}, {_level(2)}, {_level(3)},
named AS (SELECT *, string_split(prefix || '/', '/')[2] AS head FROM tree_3),
tree AS (SELECT host, pattern, n, labelled, blocked, head, substr(prefix, length(head) + 2)
    || CASE WHEN regexp_matches(pattern, '/[*][*]/?$') THEN '/**' ELSE '' END
    || CASE WHEN ends_with(pattern, '/') THEN '/' ELSE '' END AS tail FROM named),
tails AS (SELECT host, tail, sum(n) AS n FROM tree GROUP BY ALL),
common AS (SELECT host, tail AS common FROM tails QUALIFY row_number() OVER (PARTITION BY host ORDER BY n DESC, tail DESC) = 1),
kinds AS (SELECT host, head, sum(n) AS n, sum(labelled) AS labelled, sum(blocked) AS blocked,
    sum(CASE WHEN tail = common THEN n ELSE 0 END) AS n_common, sum(labelled) >= 3 AS known
  FROM tree JOIN common USING (host) GROUP BY host, head),
largest AS (SELECT host, known AS r_known, head AS r_head, n AS r_n, labelled AS r_labelled, blocked AS r_blocked, n_common AS r_common
  FROM kinds QUALIFY row_number() OVER (PARTITION BY host ORDER BY known DESC, n DESC, head DESC) = 1),
merged AS (SELECT host, head, CASE WHEN {_alike("n_common", "n", "r_common", "r_n")}
    AND (NOT known OR NOT r_known OR {_alike("blocked", "labelled", "r_blocked", "r_labelled")}) THEN r_head ELSE head END AS branch
  FROM kinds JOIN largest USING (host)),
branched AS (SELECT tree.*, branch FROM tree JOIN merged USING (host, head)),
overall AS (SELECT sum(blocked)::DOUBLE / greatest(sum(labelled), 1) AS share FROM tree),
by_host AS (SELECT host, (sum(blocked) + 5.0::DOUBLE * any_value(overall.share)) / (sum(labelled) + 5.0::DOUBLE) AS host_share
  FROM tree, overall GROUP BY host),
templates AS (SELECT host, branch, tail, sum(labelled) AS labelled, sum(blocked) AS blocked FROM branched GROUP BY ALL),
judged AS (SELECT host, branch, tail, labelled, round((blocked + 5.0::DOUBLE * host_share) / (labelled + 5.0::DOUBLE), 6) AS share
  FROM templates JOIN by_host USING (host))
SELECT page_id, paged.host, path, rule, '/' || branch || tail AS template, share,
  CASE WHEN share >= 0.8 AND judged.labelled >= 3 THEN 'block' ELSE 'allow' END AS template_verdict,
  coalesce(verdict_, CASE WHEN share >= 0.8 AND judged.labelled >= 3 THEN 'block' ELSE 'allow' END) AS verdict
FROM paged JOIN branched USING (host, pattern) JOIN judged USING (host, branch, tail)"""


def _lloyd(clusters: int = 16, rounds: int = 3) -> str:
    """Rounds unrolled: distances, nearest centroid, floor of the mean in whole numbers."""
    steps = []
    for r in range(rounds + 1):
        steps.append(f"""
near_{r} AS (SELECT row, c AS cluster, distance FROM (SELECT row, c, sum((x - y) * (x - y)) AS distance FROM parts JOIN centre_{r} USING (dim) GROUP BY ALL)
  QUALIFY row_number() OVER (PARTITION BY row ORDER BY distance, c) = 1)""")
        if r < rounds:
            steps.append(f"""
sum_{r} AS (SELECT cluster AS c, dim, sum(x) AS s, count(*) AS n FROM parts JOIN near_{r} USING (row) GROUP BY ALL),
centre_{r + 1} AS (SELECT c, dim, CASE WHEN n IS NULL THEN y ELSE (s - ((s % n) + n) % n) // n END AS y FROM centre_{r} LEFT JOIN sum_{r} USING (c, dim))""")
    return f"""
WITH kept AS (SELECT vec_id, row_number() OVER () AS row, list_transform(embedding, lambda e: CAST(floor(64 * CAST(e AS DOUBLE)) AS HUGEINT)) AS v
  FROM embeddings WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda e: e IS NULL OR NOT isfinite(e))) = 0),
parts AS MATERIALIZED (SELECT row, unnest(range(1, 65)) AS dim, unnest(v) AS x FROM kept),
start AS (SELECT v, row_number() OVER (ORDER BY sha256('1:' || vec_id) NULLS LAST, v) - 1 AS c FROM kept QUALIFY c < {clusters}),
centre_0 AS (SELECT c, unnest(range(1, 65)) AS dim, unnest(v) AS y FROM start),{",".join(steps)},
inertias AS (SELECT cluster, sum(distance) AS s FROM near_{rounds} GROUP BY ALL),
hashes AS (SELECT c AS cluster, sha256(string_agg(CAST(y AS VARCHAR), ',' ORDER BY dim)) AS centroid_sha256 FROM centre_{rounds} GROUP BY ALL)
SELECT vec_id, CAST(cluster AS INT) AS cluster, CAST(distance AS BIGINT) AS distance, CAST(s AS BIGINT) AS cluster_inertia,
  CAST((SELECT sum(s) FROM inertias) AS BIGINT) AS inertia, centroid_sha256
FROM kept JOIN near_{rounds} USING (row) JOIN inertias USING (cluster) JOIN hashes USING (cluster)"""


def _crc32(text: str) -> str:
    """crc32 of an ASCII text, eight shifts a byte."""
    codes = f"list_transform(string_split({text}, ''), lambda c: CAST(ascii(c) AS BIGINT))"
    byte = "list_reduce([xor(crc, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda y, i: xor(y >> 1, 3988292384 * (y & 1)))"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {codes}), lambda crc, b: {byte}), 4294967295)"


# States: 0 nothing yet, 1 system, 2 user, 3 assistant. Forward search, all insertions before a row at once.
TURN_REPAIR = rf"""
WITH RECURSIVE named AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    {_crc32("coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ')")} % 20 AS damage FROM conversations),
damaged AS (SELECT conv_id, turn, CASE damage WHEN 4 THEN 'user' ELSE role END AS role,
    CASE damage WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(range(CASE damage WHEN 3 THEN 2 ELSE 1 END)) AS copy FROM named WHERE damage <> 0),
placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text)) AS i,
    regexp_replace(text, '[ 	-
]', '', 'g') AS dense FROM damaged),
seen AS (SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS again FROM placed),
turns AS MATERIALIZED (SELECT conv_id, i, turn, role, text, substr(role, 1, 1) AS initial,
    CASE WHEN dense = '' THEN 'blank' WHEN again THEN 'duplicate' WHEN right(dense, 1) NOT IN ('.', '!', '?') THEN 'truncated' END AS fault FROM seen),
insertions(q, q2, paid, names, lines) AS (VALUES (0, 0, 0, '', ''), (1, 1, 0, '', ''), (2, 2, 0, '', ''), (3, 3, 0, '', ''),
  (0, 2, 5, 'I', chr(10) || 'user:'), (1, 2, 5, 'I', chr(10) || 'user:'), (2, 3, 5, 'I', chr(10) || 'assistant:'), (3, 2, 5, 'I', chr(10) || 'user:'),
  (0, 3, 10, 'II', chr(10) || 'user:' || chr(10) || 'assistant:'), (1, 3, 10, 'II', chr(10) || 'user:' || chr(10) || 'assistant:')),
edits(q2, q3, edit, initial, role2) AS (VALUES (0, 0, 'D', NULL, NULL), (1, 1, 'D', NULL, NULL), (2, 2, 'D', NULL, NULL), (3, 3, 'D', NULL, NULL),
  (0, 1, 'K', 's', NULL), (0, 2, 'K', 'u', NULL), (1, 2, 'K', 'u', NULL), (3, 2, 'K', 'u', NULL), (2, 3, 'K', 'a', NULL),
  (0, 2, 'R', NULL, 'user'), (1, 2, 'R', NULL, 'user'), (3, 2, 'R', NULL, 'user'), (2, 3, 'R', NULL, 'assistant')),
found AS (SELECT DISTINCT conv_id, 0::BIGINT AS i, 0 AS q, {{'cost': 0::BIGINT, 'audit': '', 'body': ''}} AS best FROM conversations
  UNION ALL
  SELECT conv_id, i, q, min(option) FROM (
    SELECT f.conv_id, t.i, q3 AS q, {{'cost': best.cost + paid + CASE edit WHEN 'D' THEN 2 WHEN 'R' THEN 1 ELSE 0 END
        + CASE WHEN fault = 'truncated' AND edit <> 'D' THEN 5 ELSE 0 END,
      'audit': best.audit || names || edit,
      'body': best.body || lines || CASE edit WHEN 'D' THEN '' ELSE chr(10) || coalesce(role2, role) || ':' || text END}} AS option
    FROM found f JOIN turns t ON t.conv_id IS NOT DISTINCT FROM f.conv_id AND t.i = f.i + 1 JOIN insertions n ON n.q = f.q
      JOIN edits e ON e.q2 = n.q2 AND (e.initial IS NULL OR e.initial = t.initial) AND (edit = 'D' OR fault IS NULL OR fault = 'truncated'))
  GROUP BY ALL),
ends AS (SELECT f.conv_id, min({{'cost': best.cost + paid, 'audit': best.audit || names, 'body': best.body || lines}}) AS best
  FROM found f JOIN insertions n USING (q) JOIN (SELECT conv_id, max(i) AS i FROM found GROUP BY ALL) m
    ON m.conv_id IS NOT DISTINCT FROM f.conv_id AND m.i = f.i WHERE q2 IN (0, 3) GROUP BY ALL),
pairs AS (SELECT *, lag(initial) OVER (PARTITION BY conv_id ORDER BY i) || initial AS pair,
    lag(initial) OVER (PARTITION BY conv_id ORDER BY i) IS NOT NULL AS follows FROM turns),
counts AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
    count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
    count(*) FILTER (follows AND pair NOT IN ('su', 'ua', 'au')) AS illegal FROM pairs GROUP BY ALL)
SELECT e.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
  coalesce(illegal, 0) AS illegal, best.cost AS cost, best.audit AS audit, sha256(substr(best.body, 2)) AS repaired_sha256
FROM ends e LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM e.conv_id"""


# Profiles of 300 n-grams of 1 to 3 letters; shorter n-grams, then smaller code points, come first among equal counts.
RANK_ORDER = rf"""
WITH numbered AS MATERIALIZED (SELECT row_number() OVER () AS row, doc_id, text, lang,
    coalesce({_crc32("CAST(doc_id AS VARCHAR)")} % 3 = 1, false) AS held FROM documents),
words AS (SELECT row, word, count(*) AS n FROM (SELECT row, unnest(regexp_extract_all(lower(text), '\p{{L}}+')) AS word FROM numbered) GROUP BY ALL),
parts AS (SELECT word, g, count(*) AS k FROM (SELECT word, substr(' ' || word || ' ', unnest(range(1, length(word) + 4 - size)), size) AS g
    FROM (SELECT DISTINCT word FROM words), (VALUES (1), (2), (3)) t(size)) WHERE g <> ' ' GROUP BY ALL),
grams AS MATERIALIZED (SELECT row, g, sum(n * k) AS c FROM words JOIN parts USING (word) GROUP BY ALL),
own AS (SELECT row, g, row_number() OVER (PARTITION BY row ORDER BY c DESC, length(g), g) - 1 AS r FROM grams QUALIFY r < 300),
summed AS (SELECT lang, g, sum(c) AS c FROM grams JOIN numbered USING (row) WHERE NOT held AND lang IS NOT NULL GROUP BY ALL),
profile AS MATERIALIZED (SELECT lang, g, row_number() OVER (PARTITION BY lang ORDER BY c DESC, length(g), g) - 1 AS r FROM summed QUALIFY r < 300),
far AS (SELECT row, l.lang, CAST(sum(coalesce(abs(p.r - o.r), 300)) AS DOUBLE) AS d
  FROM own o CROSS JOIN (SELECT DISTINCT lang FROM profile) l LEFT JOIN profile p ON p.lang = l.lang AND p.g = o.g GROUP BY ALL),
best AS (SELECT row, lang, d, coalesce(lead(d) OVER (PARTITION BY row ORDER BY d, lang), 90000::DOUBLE) AS further
  FROM far QUALIFY row_number() OVER (PARTITION BY row ORDER BY d, lang) = 1)
SELECT doc_id, held AS held_out, coalesce(best.lang, 'und') AS lang_pred,
  CASE WHEN further > 0 THEN greatest(0::DOUBLE, 1 - d / further) ELSE 0::DOUBLE END AS score
FROM numbered LEFT JOIN best USING (row)"""


def oracle_sql() -> dict[str, str]:
    return {
        "op6_path_templates": PATH_TEMPLATES,
        "op11_rank_order": RANK_ORDER,
        "op12_sharded_lloyd": _lloyd(),
        "op13_turn_repair": TURN_REPAIR,
    }
