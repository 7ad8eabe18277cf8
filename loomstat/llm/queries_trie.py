"""The query of the conversation prefix trie, with its SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from loomstat.llm import prefix_trie
from loomstat.llm.registry import query

_CRC32 = """xor(list_reduce([CAST(4294967295 AS BIGINT)] || [CAST(ascii(c) AS BIGINT) FOR c IN string_split(CAST(conv_id AS VARCHAR), '')],
  lambda a, b: list_reduce([xor(a, b)] || [CAST(0 AS BIGINT) FOR i IN range(8)], lambda u, v: CASE WHEN u & 1 = 1 THEN xor(u >> 1, 3988292384) ELSE u >> 1 END)), 4294967295)"""

SQL_TRIE = f"""
WITH t AS (SELECT conv_id, sha256(length(r) || ':' || r || x) AS k, length(x) AS chars,
  row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, sha256(length(r) || ':' || r || x)) AS p
  FROM (SELECT conv_id, turn, coalesce(role, '') AS r, coalesce(text, '') AS x FROM conversations WHERE conv_id IS NOT NULL)),
c AS (SELECT conv_id, {_CRC32} % 6 AS h FROM (SELECT DISTINCT conv_id FROM t)),
s AS (SELECT c.conv_id, t.p, t.k, t.chars FROM c JOIN t ON t.conv_id = c.conv_id - c.conv_id % 100 AND t.p <= h
  UNION ALL SELECT c.conv_id, t.p, t.k, t.chars FROM c JOIN t ON t.conv_id = c.conv_id WHERE t.p > h),
q AS (SELECT conv_id, row_number() OVER w AS d, string_agg(k, '') OVER w AS path, chars FROM s WINDOW w AS (PARTITION BY conv_id ORDER BY p)),
l AS (SELECT c.conv_id, coalesce(max(d), 0) AS n FROM c LEFT JOIN q USING (conv_id) GROUP BY 1),
m AS (SELECT conv_id, d, path, chars FROM q UNION ALL SELECT conv_id, 0, '', 0 FROM c),
node AS (SELECT d, path, min(conv_id) AS conv_id, count(*) AS n_convs, max(chars) AS chars,
  sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (n = d), '')) AS ends FROM m JOIN l USING (conv_id) GROUP BY d, path),
kid AS (SELECT left(path, 64 * (d - 1)) AS path, count(*) AS n FROM node WHERE d > 0 GROUP BY 1),
own AS (SELECT node.*, coalesce(kid.n, 0) AS n_children, (n_convs - 1) * chars AS saved FROM node LEFT JOIN kid USING (path)),
up AS (SELECT left(path, 64 * a) AS path, sum(CASE WHEN n_children = 0 THEN 1 ELSE 0 END) AS leaves, sum(saved) AS saved
  FROM (SELECT path, n_children, saved, unnest(range(0, d + 1)) AS a FROM own) GROUP BY 1)
SELECT own.conv_id, CAST(own.d AS BIGINT) AS depth, parent.conv_id AS parent_conv_id, own.n_convs, own.n_children, CAST(leaves AS BIGINT) AS n_leaves,
  CAST(up.saved AS BIGINT) AS saved_tokens, own.ends AS ends_sha256
FROM own JOIN up USING (path) LEFT JOIN own AS parent ON own.d > 0 AND parent.path = left(own.path, 64 * (own.d - 1))"""


@query("op13_prefix_trie", SQL_TRIE)
def op13(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir.rstrip('/')}/conversations.parquet")
    return prefix_trie.prefix_trie(prefix_trie.grafted(rows, F.col("conv_id") - F.col("conv_id") % 100, F.crc32(F.col("conv_id").cast("string").cast("binary")) % 6, most=5))
