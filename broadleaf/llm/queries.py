"""Thin queries over the operators of this subpackage, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import click_windows, conversation_trie, decontaminate, importance, langid, near_dup, pii, quality_rules, sentencepiece_sa, simhash, token_store, url_filter, warc
from . import pipeline as corpus
from .common import table, tokenizer_path
from .pipeline import PII_KEY


#: (host, path prefix, verdict)
URL_RULES = [
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]


def listed_urls(pages: DataFrame) -> DataFrame:
    """A made-up list for op1: the URLs whose canonical form has an MD5 that starts with 0 or 1, and below all others one that no page has."""
    c = url_filter.canonical(F.col("url"))
    rows = pages.where(c.isNotNull()).select("url", c.alias("c"), F.substring(F.md5(c), 1, 1).alias("m"))
    return rows.select(F.when(F.col("m").isin("0", "1"), F.col("url")).otherwise(F.concat(F.lit("https://"), "c", F.lit("/unlisted"))).alias("url"))


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return url_filter.judge(pages, listed_urls(pages), URL_RULES)


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pseudonyms(table(spark, sf_dir, "documents"), PII_KEY)


def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepiece_sa.digests(table(spark, sf_dir, "documents"), tokenizer_path("piece_bpe_32k.model"))


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"))


def op5_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_store.encode_to_store(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"))


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "documents"))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(table(spark, sf_dir, "documents"))


def op9_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.groups(table(spark, sf_dir, "documents"))


def op11_click_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return click_windows.deduplicate(table(spark, sf_dir, "clicks"))


def op12_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie.digest(*conversation_trie.trie(table(spark, sf_dir, "conversations")))


def op13_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.groups(table(spark, sf_dir, "documents"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus.run(spark, sf_dir)


QUERIES = {
    "op1_url_filter": op1_url_filter,
    "op2_pii": op2_pii,
    "op3_sentencepiece": op3_sentencepiece,
    "op4_warc": op4_warc,
    "op5_token_store": op5_token_store,
    "op6_decontamination": op6_decontamination,
    "op7_langid": op7_langid,
    "op8_quality_rules": op8_quality_rules,
    "op9_importance": op9_importance,
    "op10_near_dup": op10_near_dup,
    "op11_click_windows": op11_click_windows,
    "op12_conversation_trie": op12_conversation_trie,
    "op13_simhash": op13_simhash,
    "pipeline": pipeline,
}

#: CRC-32 by its table of bytes, in a column t, of the characters of an ASCII text.
CRC_TABLE = "SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]), lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t"
CRC = "xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split({0}, ''), lambda x: ascii(x)::BIGINT)), lambda a, x: xor(t[(xor(a, x) & 255) + 1], a >> 8)), 4294967295)"

SQL: dict[str, str] = {
    "op11_click_windows": f"""
WITH RECURSIVE crc AS ({CRC_TABLE}),
j AS (SELECT *, epoch_us(arrived_at) // 3600000000 AS h, unnest(range(click_id % 3 + 1)) AS j FROM clicks WHERE click_id IS NOT NULL AND arrived_at IS NOT NULL),
c AS (SELECT *, {CRC.format("click_id || ':' || j")} AS c FROM j, crc),
l AS (SELECT *, h + 6 * j * (c % 10) AS hour, h + 6 * j * (c % 10) + c // 10 % 200 AS l,
        sha256(coalesce(client_id::VARCHAR, '') || '|' || coalesce(kind, '') || '|' || coalesce(floor(100 * value + 0.5)::BIGINT::VARCHAR, '') || '|' || coalesce(epoch_us(ts)::VARCHAR, '') || '|' || coalesce(props, '') || '|' || c % 3) AS hash FROM c),
b AS (SELECT click_id, hour, hash, {CRC.format("hash")} AS crc, (l - min(l) OVER ()) * 8 // (max(l) OVER () - min(l) OVER () + 1) AS batch FROM l),
m AS (SELECT b.b AS batch, max(hour) FILTER (batch < b.b) AS before, max(hour) FILTER (batch <= b.b) AS upto FROM b, (SELECT unnest(range(8)) AS b) b GROUP BY b.b),
k AS (SELECT b.*, before, row_number() OVER (PARTITION BY click_id ORDER BY b.batch, hour, hash) AS rn FROM b JOIN m ON m.batch = b.batch WHERE before IS NULL OR hour >= before - 96),
w AS (
  SELECT click_id, rn, rn AS opener, hour AS start_hour FROM k WHERE rn = 1
  UNION ALL
  SELECT k.click_id, k.rn, CASE WHEN k.hour > start_hour + 24 OR start_hour + 24 < before - 96 THEN k.rn ELSE opener END, CASE WHEN k.hour > start_hour + 24 OR start_hour + 24 < before - 96 THEN k.hour ELSE start_hour END
  FROM w JOIN k ON k.click_id = w.click_id AND k.rn = w.rn + 1),
g AS (
  SELECT w.click_id, w.opener, any_value(w.start_hour) AS start_hour, any_value(o.batch) AS batch, any_value(o.hash) AS hash, count(*) - 1 AS n_repeats,
         count(*) FILTER (k.hash <> o.hash) AS n_conflicts, coalesce(sum(k.crc) FILTER (k.hash <> o.hash), 0)::BIGINT AS conflict_crc
  FROM w JOIN k ON k.click_id = w.click_id AND k.rn = w.rn JOIN k o ON o.click_id = w.click_id AND o.rn = w.opener GROUP BY w.click_id, w.opener),
n AS (SELECT *, lead(batch) OVER (PARTITION BY click_id ORDER BY opener) AS next_batch FROM g)
SELECT click_id, start_hour, least(7, next_batch, (SELECT min(m.batch) FROM m WHERE m.batch >= n.batch AND n.start_hour + 24 < m.upto - 96))::BIGINT AS closed_batch, n_repeats, n_conflicts, conflict_crc, hash FROM n
""",
    "op12_conversation_trie": f"""
WITH crc AS ({CRC_TABLE}),
t AS (SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) - 1 AS i FROM conversations WHERE conv_id IS NOT NULL),
c AS (SELECT conv_id, conv_id - conv_id % 5 AS lead, {CRC.format("conv_id::VARCHAR")} % 9 AS h FROM (SELECT DISTINCT conv_id FROM t), crc),
r AS (
  SELECT c.conv_id, 0 AS part, i, role, text FROM c JOIN t ON t.conv_id = c.lead AND i < h
  UNION ALL SELECT c.conv_id, 1, i, role, text FROM c JOIN t ON t.conv_id = c.conv_id AND i >= h),
p AS (SELECT c.conv_id, coalesce(list(struct_pack(role := role, text := text) ORDER BY part, i) FILTER (i IS NOT NULL), []) AS path FROM c LEFT JOIN r ON r.conv_id = c.conv_id GROUP BY c.conv_id),
e AS (SELECT conv_id, path, unnest(range(len(path) + 1)) AS depth FROM p),
n AS (
  SELECT path[1:depth] AS node, depth, min(conv_id) AS conv_id, count(*) AS n_convs, sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (len(path) = depth), '')) AS ends_sha256
  FROM e GROUP BY path[1:depth], depth),
k AS (SELECT node[1:depth - 1] AS parent, depth - 1 AS depth, count(*) AS n_children FROM n WHERE depth > 0 GROUP BY node[1:depth - 1], depth - 1),
own AS (
  SELECT n.*, coalesce(n_children, 0) AS n_children, CASE WHEN n.depth > 0 THEN (n_convs - 1) * octet_length(encode(node[n.depth].text)) ELSE 0 END AS saved
  FROM n LEFT JOIN k ON k.parent = n.node AND k.depth = n.depth),
up AS (SELECT node, unnest(range(depth + 1)) AS d, saved, n_children FROM own),
s AS (SELECT node[1:d] AS node, d AS depth, sum(saved)::BIGINT AS saved_tokens, count(*) FILTER (n_children = 0) AS n_leaves FROM up GROUP BY node[1:d], d)
SELECT own.conv_id, own.depth, above.conv_id AS parent_conv_id, own.n_convs, own.n_children, n_leaves, saved_tokens, own.ends_sha256
FROM own JOIN s ON s.node = own.node AND s.depth = own.depth LEFT JOIN n above ON own.depth > 0 AND above.depth = own.depth - 1 AND above.node = own.node[1:own.depth - 1]
""",
    "op1_url_filter": r"""
WITH p AS (
  SELECT page_id, url,
         translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path,
         coalesce(regexp_extract(url, '(?s)^.*?://[^?#]*\?([^#]*)', 1), '') AS query
  FROM pages),
q AS (
  SELECT *, array_to_string(list_sort(list_filter(string_split(query, '&'), lambda x: x <> '' AND NOT starts_with(x, 'utm_'))), '&') AS kept FROM p),
c AS (
  SELECT *, CASE WHEN contains(url, '://') THEN regexp_replace(regexp_replace(host, '^www\.', ''), ':(80|443)$', '') || regexp_replace(path, '/$', '')
         || CASE WHEN kept <> '' THEN '?' || kept ELSE '' END END AS canonical FROM q),
listed AS (SELECT DISTINCT CASE WHEN substr(md5(canonical), 1, 1) IN ('0', '1') THEN canonical ELSE canonical || '/unlisted' END AS canonical FROM c),
r AS (
  SELECT *, CASE
    WHEN (host = 'example.org' OR host LIKE '%.example.org') AND starts_with(path, '/en/1') THEN 'example.org/en/1'
    WHEN (host = 'example.org' OR host LIKE '%.example.org') AND starts_with(path, '/es/') THEN 'example.org/es/'
    WHEN (host = 'com' OR host LIKE '%.com') AND starts_with(path, '/fr/') THEN 'com/fr/'
    WHEN (host = 'com' OR host LIKE '%.com') AND starts_with(path, '/de/') THEN 'com/de/'
    WHEN (host = 'org' OR host LIKE '%.org') AND starts_with(path, '/') THEN 'org/' END AS rule
  FROM c)
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('org/', 'com/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
            WHEN canonical IN (SELECT canonical FROM listed WHERE canonical IS NOT NULL) THEN 'block' ELSE 'allow' END AS verdict
FROM r
""".replace("\\\\", "\\"),
    "op4_warc": """
WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS n, sha256(coalesce(html, '')) AS d FROM pages),
g AS (SELECT d, min(page_id) AS first FROM p WHERE n >= 100 GROUP BY d HAVING count(*) > 1)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, p.d AS payload_digest,
       CASE WHEN page_id > first OR page_id IS NULL AND first IS NOT NULL THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id > first OR page_id IS NULL THEN first END AS refers_to
FROM p LEFT JOIN g ON p.d = g.d
""",
}
