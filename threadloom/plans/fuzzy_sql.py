"""SQL of the queries that compare names or excerpts: token sets, common subsequences in the bits of a number."""

from __future__ import annotations

from ..config import DEFAULT
from ..functions.text import NAME_STOPWORDS


def similar(pairs: str, threshold: float) -> str:
    """CTEs from `pairs` (a, b) to `alike` (a, b, similarity) of those that reach the threshold.

    What only one side has must be shorter than 62 characters, as its places are the bits of a BIGINT.
    """
    words = "list_sort(list_distinct(list_filter(string_split({}, ' '), lambda w: w <> '')))"
    return f"""
sets AS (SELECT a, b, {words.format("a")} AS x, {words.format("b")} AS y FROM {pairs}),
parts AS (
  SELECT a, b, len(x) AS nx, len(y) AS ny, length(array_to_string(list_filter(x, lambda w: list_contains(y, w)), ' ')) AS base,
    array_to_string(list_filter(x, lambda w: NOT list_contains(y, w)), ' ') AS sx, array_to_string(list_filter(y, lambda w: NOT list_contains(x, w)), ' ') AS sy
  FROM sets
),
sized AS (
  SELECT *, least(base, 1) AS gap, (1::BIGINT << length(sx)) - 1 AS whole,
    list_transform(string_split(sy, ''), lambda c: coalesce(list_sum(list_transform(generate_series(1, length(sx)),
      lambda k: CASE WHEN substr(sx, k, 1) = c THEN 1::BIGINT << (k - 1) ELSE 0 END)), 0)::BIGINT) AS hits
  FROM parts
),
matched AS (
  SELECT *, length(sx) - bit_count(list_reduce(hits, lambda s, m: ((s + (s & m)) | (s - (s & m))) & whole, whole)) AS common FROM sized
),
rated AS (
  SELECT a, b, CASE WHEN nx = 0 OR ny = 0 THEN 0.0::DOUBLE WHEN base > 0 AND (sx = '' OR sy = '') THEN 1.0::DOUBLE ELSE greatest(
    1 - (length(sx) + length(sy) - 2 * common) / (2 * (base + gap) + length(sx) + length(sy)),
    CASE WHEN base > 0 THEN 1 - (gap + length(sx)) / (2 * base + gap + length(sx)) ELSE 0 END,
    CASE WHEN base > 0 THEN 1 - (gap + length(sy)) / (2 * base + gap + length(sy)) ELSE 0 END) END AS similarity
  FROM matched
),
alike AS (SELECT * FROM rated WHERE similarity >= {threshold}::DOUBLE)"""


def _evidence(claims: str) -> str:
    """CTEs that end in `held`: the evidence of each claim, near repeats of what is kept before left out."""
    return f"""{claims},
said AS (
  SELECT substr(sha256(lower(s) || '|' || relation || '|' || lower(o)), 1, 16) AS claim_id, 'order ' || l_orderkey || ' line ' || l_linenumber AS excerpt,
    'order_' || l_orderkey AS artifact_id, l_orderkey, ts AS "timestamp", lpad(l_orderkey::VARCHAR, 12, '0') || '/' || l_linenumber AS pos
  FROM raw
),
once AS (SELECT * FROM said QUALIFY row_number() OVER (PARTITION BY claim_id, excerpt ORDER BY "timestamp", pos) = 1),
item AS (SELECT *, row_number() OVER (PARTITION BY claim_id ORDER BY "timestamp", pos) AS k FROM once),
prs AS (SELECT DISTINCT j.excerpt AS a, i.excerpt AS b FROM item i JOIN item j ON i.claim_id = j.claim_id AND j.k < i.k),
{similar("prs", DEFAULT.claim_similarity)},
repeats AS (
  SELECT i.claim_id, i.k, list(j.k) AS resembles FROM item i JOIN item j ON i.claim_id = j.claim_id AND j.k < i.k
  JOIN alike ON a = j.excerpt AND b = i.excerpt GROUP BY i.claim_id, i.k
),
steps AS (SELECT i.claim_id, i.k, coalesce(resembles, []) AS resembles FROM item i LEFT JOIN repeats r ON r.claim_id = i.claim_id AND r.k = i.k),
walk AS (
  SELECT claim_id, k, [k] AS kept FROM steps WHERE k = 1
  UNION ALL
  SELECT s.claim_id, s.k, CASE WHEN list_has_any(w.kept, s.resembles) THEN w.kept ELSE list_append(w.kept, s.k) END
  FROM walk w JOIN steps s ON s.claim_id = w.claim_id AND s.k = w.k + 1
),
chosen AS (SELECT claim_id, unnest(arg_max(kept, k)) AS k FROM walk GROUP BY claim_id),
held AS (SELECT i.* FROM item i JOIN chosen c ON c.claim_id = i.claim_id AND c.k = i.k)"""


def evidence_sql(claims: str) -> dict[str, str]:
    held = f"WITH RECURSIVE {_evidence(claims)}"
    of_orders = "SELECT claim_id, count(*) AS n_evidence FROM held JOIN orders ON o_orderkey = l_orderkey WHERE {} GROUP BY claim_id"
    return {
        "evidence_counts": f"{held} SELECT subject, relation, object, count(*) AS n_evidence FROM held JOIN claims USING (claim_id) GROUP BY ALL",
        "api_evidence": f"""{held}, wanted AS (SELECT * FROM claims WHERE NOT superseded ORDER BY claim_id LIMIT 1)
SELECT claim_id AS edge_id, subject || ' --' || relation || '--> ' || object AS statement, excerpt, artifact_id, "timestamp" FROM wanted JOIN held USING (claim_id)""",
        "permitted": f"{held} {of_orders.format("o_orderstatus = 'F'")}",
        "without_orphans": f"{held} {of_orders.format("o_orderstatus <> 'P'")}",
    }


def entity_sql(name_counts: str) -> dict[str, str]:
    """name_counts: SQL of (name, frequency, type)."""
    clusters = rf"""WITH RECURSIVE counted AS ({name_counts}),
plain AS (SELECT *, regexp_replace(trim(lower(regexp_replace(strip_accents(name), '[^\x00-\x7F]', '', 'g'))), '^[`''"]+|[`''"]+$', '', 'g') AS t FROM counted),
names AS (
  SELECT name, frequency, type, array_to_string(list_filter(string_split(trim(regexp_replace(t, '[\s\-_/\\.]+', ' ', 'g')), ' '),
    lambda w: w <> '' AND NOT list_contains({list(NAME_STOPWORDS)!r}, w)), ' ') AS key FROM plain
),
keys AS (SELECT DISTINCT key FROM names WHERE key <> ''),
prs AS (SELECT x.key AS a, y.key AS b FROM keys x JOIN keys y ON x.key < y.key),
{similar("prs", DEFAULT.entity_similarity)},
links AS (SELECT a, b FROM alike UNION ALL SELECT b, a FROM alike),
reach AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b),
component AS (SELECT a AS key, min(least(a, b)) AS root FROM reach GROUP BY a),
member AS (SELECT name, frequency, type, CASE WHEN root IS NULL THEN '=' || name ELSE '~' || root END AS cluster FROM names LEFT JOIN component USING (key)),
best AS (
  SELECT cluster, arg_max(name, (frequency, length(name), name, type)) AS canonical, arg_max(type, (frequency, length(name), name, type)) AS type,
    sum(frequency)::BIGINT AS frequency FROM member GROUP BY cluster
)"""
    return {
        "entity_canonical_map": f"{clusters} SELECT name AS raw_name, canonical FROM member JOIN best USING (cluster)",
        "entity_alias_index": f"""{clusters} SELECT b.canonical, coalesce(string_agg(m.name, ',' ORDER BY m.name) FILTER (m.name <> b.canonical), '') AS aliases,
  any_value(b.type) AS type, any_value(b.frequency) AS frequency FROM member m JOIN best b USING (cluster) GROUP BY b.cluster, b.canonical""",
        "entity_merge_log": f"{clusters} SELECT a AS name_a, b AS name_b, round(similarity, 4) AS similarity, 'fuzzy_token_set' AS reason FROM alike",
    }
