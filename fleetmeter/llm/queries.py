"""Registered queries of this subpackage and their DuckDB counterparts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, collocations, exact_dedup, language, licenses, masked_lm, minhash, packing, pii, prefix_trie, substring, suffix_dedup, topk
from .support import table


def op1_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), words=3, percent=85)


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents"), keep="largest").drop("row")


def op3_masked_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return masked_lm.score(table(spark, sf_dir, "documents"))


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.substring_dedup(table(spark, sf_dir, "documents"), window=50)


def op5_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(table(spark, sf_dir, "documents"))


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find_pii(table(spark, sf_dir, "documents"))

    def count(kind: int):
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")

    counts = [count(k).alias(f"n_{name}") for k, name in enumerate(pii.KINDS)]
    return found.select("doc_id", *counts, F.sha2(pii.listed("base"), 256).alias("base_sha256"), pii.listed("spans").alias("spans"))


def op7_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.exact_top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_decode(table(spark, sf_dir, "documents"))


def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(table(spark, sf_dir, "documents")).drop("row", "letters", "grams")


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_trie(table(spark, sf_dir, "conversations"))


def op12_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.suffix_dedup(table(spark, sf_dir, "documents"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


def queries() -> dict:
    return {name: f for name, f in globals().items() if name.startswith("op") and callable(f)}


_OP1_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'),
    lambda x: x <> '') AS w FROM documents
), s AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) END) AS s FROM w
), e AS (SELECT doc_id, len(s) AS n, unnest(s) AS t FROM s),
p AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM e AS a JOIN e AS b ON a.t = b.t AND a.doc_id < b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))
), l AS (SELECT a, b FROM p UNION ALL SELECT b, a FROM p),
r AS (SELECT a AS node, b AS other FROM l UNION SELECT r.node, l.b FROM r JOIN l ON l.a = r.other),
c AS (SELECT node, min(other) AS least_id FROM r GROUP BY node)
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, least(doc_id, coalesce(least_id, doc_id)) AS component_id,
       doc_id = least(doc_id, coalesce(least_id, doc_id)) AS kept
FROM s LEFT JOIN c ON node = doc_id
"""

_OP2_SQL = """
WITH t AS (SELECT doc_id, sha256(coalesce(text, '')) AS text_sha256, coalesce(text, '') AS text FROM documents),
     g AS (SELECT text, max(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY text)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM t JOIN g USING (text)
"""

_OP4_SQL = r"""
WITH w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents
), s AS (
  SELECT doc_id, unnest(range(1, len(w) - 48)) AS p, w FROM w WHERE len(w) >= 50
), h AS (
  SELECT doc_id, p, md5(array_to_string(w[p : p + 49], ' ')) AS h FROM s
), m AS (
  SELECT h, min(doc_id) AS least_id FROM h GROUP BY h
), g AS (
  SELECT doc_id, list_distinct(flatten(list(range(p, p + 50)))) AS gone FROM h JOIN m USING (h) WHERE doc_id > least_id GROUP BY doc_id
), k AS (
  SELECT w.doc_id, len(w) AS n, len(coalesce(gone, [])) AS removed,
         CASE WHEN gone IS NULL THEN w ELSE list_filter(w, lambda x, i: NOT list_contains(gone, i)) END AS kept
  FROM w LEFT JOIN g ON w.doc_id = g.doc_id
)
SELECT doc_id, n AS n_words, CAST(removed AS BIGINT) AS n_removed, sha256(coalesce(array_to_string(kept, ' '), '')) AS kept_sha256 FROM k
"""

def _sql_map(table: dict[str, str]) -> str:
    return "MAP {" + ", ".join(f"'{k}': '{v}'" for k, v in table.items()) + "}"


def _op5_sql() -> str:
    def normal(x: str) -> str:
        return f"trim(regexp_replace(lower({x}), '[^a-z0-9]+', ' ', 'g'))"

    return f"""
WITH s AS (
  SELECT doc_id, list_transform(regexp_split_to_array(coalesce(text, '') || ' ', '{licenses.SENTENCE_END}'),
    lambda x: coalesce(k[{normal('x')}], k[{normal("split_part(x, chr(10), -1)")}])) AS ids
  FROM documents, (SELECT {_sql_map(licenses.known_sentences())} AS k)
), i AS (
  SELECT doc_id, list_filter(ids, lambda x: x IS NOT NULL) AS ids FROM s
), r AS (
  SELECT doc_id, ids, list_transform(regexp_extract_all(array_to_string(ids, ''), '{licenses.rule_pattern()}'), lambda x: n[x]) AS names
  FROM i, (SELECT {_sql_map(licenses.rule_names())} AS n)
)
SELECT doc_id, CAST(len(ids) AS BIGINT) AS n_sentences, coalesce(array_to_string(ids, ' '), '') AS sentence_ids,
       coalesce(array_to_string(list_filter(names, lambda x, j: list_position(names, x) = j), ','), '') AS licenses
FROM r
"""


_OP7_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v AS q JOIN v AS c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0
), r AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS n FROM s
)
SELECT query_id, CAST(n AS INTEGER) AS rank, vec_id, score FROM r WHERE n <= 5
"""


_OP11_SQL = """
WITH t AS (
  SELECT conv_id, turn, coalesce("role", '') AS speaker, coalesce("text", '') AS said FROM conversations WHERE conv_id IS NOT NULL
), e AS (
  SELECT conv_id, turn, sha256(CAST(strlen(speaker) AS VARCHAR) || ':' || speaker || said) AS k, length(said) AS points FROM t
), o AS (
  SELECT conv_id, list(k || ':' || CAST(points AS VARCHAR) ORDER BY turn NULLS FIRST, k) AS seq FROM e GROUP BY conv_id
), c AS (
  SELECT conv_id, seq, xor(list_reduce(list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT)),
    lambda crc, x: list_reduce(CAST(range(8) AS BIGINT[]), lambda b, i: xor(b >> 1, (b & 1) * 3988292384), xor(crc, x)),
    4294967295), 4294967295) % 6 AS h FROM o
), r AS (
  SELECT c.conv_id, list_concat(CASE WHEN o.seq IS NULL THEN [] ELSE o.seq[1 : h] END, c.seq[h + 1 :]) AS seq
  FROM c LEFT JOIN o ON o.conv_id = c.conv_id - c.conv_id % 100
), p AS (SELECT conv_id, seq, unnest(range(0, len(seq) + 1)) AS d FROM r),
n AS (
  SELECT seq[1 : d] AS node, d, min(conv_id) AS conv_id, count(*) AS n_convs,
         sha256(coalesce(string_agg(CASE WHEN len(seq) = d THEN CAST(conv_id AS VARCHAR) END, ',' ORDER BY conv_id), '')) AS ends
  FROM p GROUP BY ALL
), k AS (SELECT node[1 : d - 1] AS node, count(*) AS n_children FROM n WHERE d > 0 GROUP BY ALL),
x AS (
  SELECT n.*, coalesce(n_children, 0) AS n_children,
         CASE WHEN d > 0 THEN (n_convs - 1) * CAST(split_part(node[d], ':', 2) AS BIGINT) ELSE 0 END AS own
  FROM n LEFT JOIN k USING (node)
), u AS (SELECT node, own, n_children, unnest(range(0, d + 1)) AS up FROM x),
s AS (SELECT node[1 : up] AS node, sum(own) AS saved, count(*) FILTER (n_children = 0) AS leaves FROM u GROUP BY ALL)
SELECT x.conv_id, CAST(x.d AS BIGINT) AS depth, a.conv_id AS parent_conv_id, x.n_convs, CAST(x.n_children AS BIGINT) AS n_children,
       leaves AS n_leaves, CAST(saved AS BIGINT) AS saved_tokens, x.ends AS ends_sha256
FROM x JOIN s USING (node) LEFT JOIN n AS a ON x.d > 0 AND a.node = x.node[1 : x.d - 1]
"""


_OP12_SQL = """
WITH d AS (SELECT row_number() OVER () AS i, doc_id, hex(encode(coalesce("text", ''))) AS h FROM documents),
w AS (SELECT i, unnest(range(0, strlen(h) // 2 - 399)) AS p, h FROM d WHERE strlen(h) >= 800),
m AS (SELECT i, p, md5(substring(h, 2 * p + 1, 800)) AS k FROM w),
r AS (SELECT i, p FROM m JOIN (SELECT k FROM m GROUP BY k HAVING count(*) > 1) USING (k)),
g AS (SELECT i, p, CASE WHEN p - lag(p) OVER (PARTITION BY i ORDER BY p) <= 400 THEN 0 ELSE 1 END AS new FROM r),
s AS (SELECT i, p, sum(new) OVER (PARTITION BY i ORDER BY p) AS span FROM g),
t AS (SELECT i, min(p) AS low, max(p) + 400 AS high FROM s GROUP BY i, span),
b AS (SELECT *, coalesce(lag(high) OVER (PARTITION BY i ORDER BY low), 0) AS after FROM t),
k AS (
  SELECT i, sum(high - low) AS n_removed, count(*) AS n_spans, max(high) AS last_high,
         string_agg(substring(h, 2 * after + 1, 2 * (low - after)), '' ORDER BY low) AS kept
  FROM b JOIN d USING (i) GROUP BY i
)
SELECT doc_id, CAST(strlen(h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       coalesce(n_spans, 0) AS n_spans,
       sha256(unhex(CASE WHEN n_spans IS NULL THEN h ELSE kept || substring(h, 2 * last_high + 1) END)) AS kept_sha256
FROM d LEFT JOIN k USING (i)
"""

_OP13_SQL = r"""
WITH p AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
    translate(coalesce("text", ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents
), w AS (
  SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS w FROM p
), g AS (
  SELECT lang, m, unnest(list_transform(range(1, len(w) - m + 2), lambda i: array_to_string(w[i : i + m - 1], ' '))) AS phrase
  FROM w, (SELECT unnest([1, 2, 3, 4]) AS m) WHERE len(w) >= m
), f AS (SELECT lang, m, phrase, count(*) AS f FROM g GROUP BY ALL),
n AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f WHERE m = 1 GROUP BY lang),
c AS (SELECT lang, m, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE m > 1 AND f >= 30),
k AS (SELECT *, unnest(range(1, m)) AS k FROM c),
s AS (
  SELECT k.lang, k.phrase, a, x.f AS l, y.f AS r, CAST((CAST(a AS HUGEINT) * 2000000) // (x.f + y.f) AS BIGINT) AS score, k
  FROM k JOIN f AS x ON x.lang = k.lang AND x.phrase = array_to_string(w[1 : k], ' ')
  JOIN f AS y ON y.lang = k.lang AND y.phrase = array_to_string(w[k + 1 :], ' ')
), b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
i AS (
  SELECT lang, a, unnest(flatten(list_transform(range(2, m), lambda z:
    list_transform(range(1, m - z + 2), lambda j: array_to_string(w[j : j + z - 1], ' '))))) AS phrase FROM c WHERE m > 2
), o AS (SELECT lang, phrase, max(a) AS longer FROM i GROUP BY ALL)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM b JOIN n USING (lang) LEFT JOIN o USING (lang, phrase) WHERE longer IS NULL OR 100 * longer < 80 * a
QUALIFY rank <= 2000
"""


def oracle_sql() -> dict[str, str]:
    return {"op1_minhash": _OP1_SQL, "op2_exact_dedup": _OP2_SQL, "op4_substring_dedup": _OP4_SQL, "op5_licenses": _op5_sql(), "op7_exact_top_k": _OP7_SQL,
            "op11_prefix_trie": _OP11_SQL, "op12_suffix_dedup": _OP12_SQL, "op13_collocations": _OP13_SQL}
