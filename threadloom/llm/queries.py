"""Queries over the tables of a data folder, one for each operator: its contract's columns from its real outputs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat, decontaminate, embed_dedup, near_dup, packing, quality, substring, tokens, toxicity, url_filter


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_read(spark, sf_dir, "documents"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_toxicity(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"))


def op3_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embed_dedup.near_vectors(_read(spark, sf_dir, "embeddings"))


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score_quality(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"))


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(_read(spark, sf_dir, "pages"))


def op7_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    odd = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-1, 0, "user", odd), (-1, 1, "assistant", odd)], "conv_id long, turn long, role string, text string")
    out = chat.format_conversations(rows.unionByName(extra)).withColumn("read", chat.parse(F.col("formatted")))
    out = out.withColumn("learnt", chat.loss_text(F.col("formatted"), F.col("loss")))
    said = F.transform("read", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return out.select(
        "conv_id",
        F.size("read").cast("long").alias("n_turns"),
        F.sha2(F.array_join(said, ""), 256).alias("turns_sha256"),
        F.length("learnt").cast("long").alias("loss_chars"),
        F.sha2("learnt", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text")
    return substring.remove_repeats(docs).select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.count_tokens(_read(spark, sf_dir, "documents"))


def op10_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_duplicates(_read(spark, sf_dir, "documents"), words=4)


QUERIES = {
    f.__name__: f
    for f in (
        op1_best_fit_packing, op2_toxicity, op3_embedding_dedup, op4_decontamination, op5_quality, op6_url_filter,
        op7_chat_format, op8_substring_dedup, op9_token_counts, op10_near_dedup,
    )
}

_WORDS = r"regexp_extract_all(coalesce({}, ''), '[^\x20\x09-\x0D]+')"
_COMPONENTS = """
reach(id, other) AS (
  SELECT a, b FROM links UNION SELECT r.id, l.b FROM reach r JOIN links l ON r.other = l.a
),
least AS (SELECT id, least(id, min(other)) AS component_id FROM reach GROUP BY id)
"""

ORACLE_SQL = {
    "op3_embedding_dedup": f"""
WITH RECURSIVE v AS (
  SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
),
links AS (
  SELECT x.vec_id AS a, y.vec_id AS b FROM v x JOIN v y ON x.vec_id <> y.vec_id
  WHERE list_cosine_similarity(x.e, y.e) >= 0.95
),
{_COMPONENTS}
SELECT t.vec_id, (SELECT count(*) FROM links WHERE a = t.vec_id) AS n_links,
  coalesce(l.component_id, t.vec_id) AS component_id, coalesce(l.component_id, t.vec_id) = t.vec_id AS kept
FROM embeddings t LEFT JOIN least l ON l.id = t.vec_id
""",
    "op6_url_filter": """
WITH u AS (
  SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages
),
p AS (
  SELECT page_id, regexp_extract(rest, '^[^/?#]*') AS raw, rest FROM u
),
h AS (
  SELECT page_id, translate(coalesce(raw, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    coalesce(regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*'), '') AS path
  FROM p
),
j AS (
  SELECT *, '.' || host AS dotted, CASE
    WHEN ('.' || host) LIKE '%.www.example.com' AND starts_with(path, '/en/') THEN 'www.example.com/en/'
    WHEN ('.' || host) LIKE '%.example.com' AND starts_with(path, '/en/') THEN 'example.com/en/'
    WHEN ('.' || host) LIKE '%.net' AND starts_with(path, '/es/') THEN 'net/es/'
    WHEN ('.' || host) LIKE '%.net' AND starts_with(path, '/fr/') THEN 'net/fr/'
    WHEN ('.' || host) LIKE '%.com' AND starts_with(path, '/') THEN 'com/' END AS rule
  FROM h
)
SELECT page_id, host, path, rule, CASE
    WHEN rule IN ('com/', 'www.example.com/en/') THEN 'allow'
    WHEN rule IS NOT NULL THEN 'block'
    WHEN dotted LIKE '%.adult-x.example.com' OR dotted LIKE '%.casino-win.example.net'
      OR dotted LIKE '%.cheap-pills.example.net' OR dotted LIKE '%.free-bets.example.net'
      OR dotted LIKE '%.spam-farm.example.org' THEN 'block'
    ELSE 'allow' END AS verdict
FROM j
""",
    "op7_chat_format": r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
),
e AS (
  SELECT *, contains(text, '</s>') OR contains(role, '</s>') OR contains(role, '[/INST]') AS odd,
    replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '[', '&lsqb;') AS text2,
    replace(replace(replace(role, '&', '&amp;'), '<', '&lt;'), '[', '&lsqb;') AS role2
  FROM c
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(20 + CASE WHEN odd THEN 1 + length(text2) + length(role2) ELSE length(text) + length(role) END)::BIGINT AS formatted_chars
FROM e GROUP BY conv_id
""",
    "op8_substring_dedup": f"""
WITH d AS (SELECT doc_id, {_WORDS.format("text")} AS w FROM documents),
k AS (SELECT doc_id, len(w) AS n, w, unnest(generate_series(1, len(w) - 49)) AS i FROM d WHERE len(w) >= 50),
x AS (SELECT doc_id, i, md5(array_to_string(w[i:i + 49], ' ')) AS h FROM k),
m AS (SELECT h, min(doc_id) AS lo FROM x GROUP BY h),
r AS (SELECT x.doc_id, x.i FROM x JOIN m USING (h) WHERE x.doc_id > m.lo),
c AS (SELECT DISTINCT doc_id, unnest(generate_series(i, i + 49)) AS p FROM r),
g AS (SELECT doc_id, list(p) AS gone FROM c GROUP BY doc_id),
o AS (
  SELECT d.doc_id, len(w) AS n, coalesce(len(gone), 0) AS n_gone,
    CASE WHEN gone IS NULL THEN w
      ELSE list_transform(list_filter(list_zip(w, generate_series(1, len(w)), list_transform(generate_series(1, len(w)), lambda q: list_contains(gone, q))), lambda z: NOT z[3]), lambda z: z[1]) END AS kept
  FROM d LEFT JOIN g USING (doc_id)
)
SELECT doc_id, n::BIGINT AS n_words, n_gone::BIGINT AS n_removed, sha256(array_to_string(kept, ' ')) AS kept_sha256 FROM o
""",
    "op10_near_dedup": f"""
WITH RECURSIVE d AS (
  SELECT doc_id, {_WORDS.format("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} AS w FROM documents
),
s AS (
  SELECT DISTINCT doc_id, md5(array_to_string(w[i:i + 3], ' ')) AS g
  FROM (SELECT doc_id, w, unnest(generate_series(1, greatest(len(w) - 3, 1))) AS i FROM d WHERE len(w) > 0)
),
n AS (SELECT doc_id, count(*) AS c FROM s GROUP BY doc_id),
few AS (SELECT g FROM s GROUP BY g HAVING count(*) > 1),
t AS (SELECT s.* FROM s JOIN few USING (g)),
pair AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS i FROM t x JOIN t y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY 1, 2),
links AS (
  SELECT pair.a, pair.b FROM pair JOIN n p ON p.doc_id = a JOIN n q ON q.doc_id = b WHERE 100 * i >= 80 * (p.c + q.c - i)
),
{_COMPONENTS}
SELECT d.doc_id, coalesce(n.c, 0) AS n_shingles, coalesce(l.component_id, d.doc_id) AS component_id,
  coalesce(l.component_id, d.doc_id) = d.doc_id AS kept
FROM d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN least l ON l.id = d.doc_id
""",
}
