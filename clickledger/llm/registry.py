"""The queries of the training-data operators, each over its whole table, and their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickledger.llm import embedding_join, html_text, line_dedup, mixing, ngram_join, packing, pii, quality, sharding, tokens
from clickledger.llm.common import read

TOKENIZER, RANKS = "byte_bpe_50k.json", "byte_bpe_50k.tiktoken"


def op1_vector_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read(spark, sf_dir, "documents"), tokens.public_path(TOKENIZER), tokens.public_path(RANKS))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.dedup_lines(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.count_tokens(read(spark, sf_dir, "documents"), tokens.public_path(TOKENIZER))


def op4_poisson_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = mixing.mix(read(spark, sf_dir, "documents").select("doc_id", "source", "text"))
    return out.select("doc_id", "source", "copy", "shuffle_key", F.md5(F.coalesce("text", F.lit(""))).alias("text_md5"))


def op5_embedding_grid_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_join.near_vectors(read(spark, sf_dir, "embeddings"), cosine=0.93)


def op6_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(read(spark, sf_dir, "pages"))


def op7_virtual_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign_shards(read(spark, sf_dir, "documents"))


def op8_quality_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality.judge(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op9_pii_semi_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find_personal(read(spark, sf_dir, "documents"))


def op10_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_duplicates(read(spark, sf_dir, "documents"), n=3, percent=90)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        f.__name__: f
        for f in (op1_vector_packing, op2_line_dedup, op3_token_counts, op4_poisson_mixing, op5_embedding_grid_join, op6_html_extraction, op7_virtual_slots, op8_quality_cascade, op9_pii_semi_crf, op10_ngram_jaccard)
    }


_WS = "\\x20\\x09-\\x0D"

_OP2 = f"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i FROM documents
), keyed AS (
  SELECT doc_id, i, line, translate(regexp_replace(regexp_replace(line, '^[{_WS}]+', ''), '[{_WS}]+$', ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k FROM lines
), repeated AS (
  SELECT k, min(doc_id) AS keeper FROM keyed WHERE length(k) >= 10 GROUP BY k HAVING count(DISTINCT doc_id) >= 2
), marked AS (
  SELECT a.doc_id, a.i, a.line, r.k IS NOT NULL AND a.doc_id <> r.keeper AS gone FROM keyed a LEFT JOIN repeated r ON a.k = r.k
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped, sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""

_OP4 = """
WITH sized AS (SELECT source, CAST(sum(coalesce(strlen(text), 0)) AS DOUBLE) AS s FROM documents GROUP BY source),
rates AS (
  SELECT source, CASE WHEN s > 0 THEN 1.0 / (SELECT count(*) FROM sized WHERE s > 0) * (SELECT sum(s) FROM sized) / s ELSE 0.0 END AS rate FROM sized
), steps AS (SELECT source, rate, CAST(floor(rate / 32) AS INTEGER) AS whole FROM rates WHERE rate > 0),
means AS (
  SELECT source, 0 AS j, rate - 32 * whole AS mean FROM steps UNION ALL SELECT source, unnest(generate_series(1, whole)) AS j, 32.0 AS mean FROM steps
), terms AS (
  SELECT source, j, k, CASE WHEN mean = 0 THEN CASE WHEN k = 0 THEN 1.0 ELSE 0.0 END ELSE exp(-mean + k * ln(mean) - lgamma(k + 1)) END AS p FROM means, generate_series(0, 160) AS g(k)
), cdf AS (SELECT source, j, sum(p) OVER (PARTITION BY source, j ORDER BY k ROWS UNBOUNDED PRECEDING) AS c, k FROM terms),
lists AS (SELECT source, j, list(c ORDER BY k) AS cs FROM cdf GROUP BY source, j),
drawn AS (
  SELECT d.doc_id, d.source, d.text, sum(len(list_filter(l.cs, lambda c: c <= CAST('0x' || substr(md5('mix-1:' || d.doc_id || ':' || l.j), 1, 13) AS BIGINT) / 4503599627370496.0))) AS n
  FROM documents d JOIN lists l ON d.source IS NOT DISTINCT FROM l.source GROUP BY ALL
), copies AS (SELECT doc_id, source, text, unnest(generate_series(0, CAST(n AS BIGINT) - 1)) AS copy FROM drawn WHERE n > 0)
SELECT doc_id, source, copy, CAST('0x' || substr(md5('mix-1:order:' || doc_id || ':' || copy), 1, 15) AS BIGINT) AS shuffle_key, md5(coalesce(text, '')) AS text_md5 FROM copies
"""

_OP8 = f"""
WITH w AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^{_WS}]+') AS ws, list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '[^{_WS}]')) AS ls FROM documents
), windows AS (
  SELECT doc_id, i, [ws[i], ws[i + 1], ws[i + 2]] AS g FROM (SELECT doc_id, ws, unnest(generate_series(1, len(ws) - 2)) AS i FROM w WHERE len(ws) >= 3)
), twice AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS c FROM windows),
covered AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM twice WHERE c >= 2) GROUP BY doc_id),
counts AS (
  SELECT w.doc_id, len(ws) AS n_words, CAST(coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0) AS BIGINT) AS word_chars, len(regexp_extract_all(text, '[#*$%&|<>]')) AS n_symbols,
         len(ls) - len(list_distinct(ls)) AS n_dup_lines, coalesce(c.n, 0) AS n_repeat_words, ws, ls
  FROM w LEFT JOIN covered c USING (doc_id)
), judged AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
    n_symbols > 0.1 * n_words OR word_chars < 3 * n_words OR word_chars > 10 * n_words OR n_dup_lines > 0.4 * len(ls)
    OR len(list_filter(ws, lambda x: regexp_matches(x, '\\p{{L}}'))) < 0.7 * n_words
    OR len(list_filter(ws, lambda x: x = upper(x) AND x <> lower(x))) > 0.5 * n_words
    OR len(list_filter(ws, lambda x: ends_with(x, '!!'))) > 0.5 * n_words
    OR len(list_filter(ls, lambda l: regexp_matches(rtrim(l, ' '), '(\\.\\.\\.|…)$'))) > 0.3 * len(ls)
    OR len(list_filter(ls, lambda l: regexp_matches(ltrim(l, ' '), '^[-*•]'))) > 0.9 * len(ls) AS rejected
  FROM counts
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND NOT rejected AS kept FROM judged
"""


#: Components of links(a, b) over nodes(node): (node, root).
_COMPONENTS = """both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach(a, b) AS (SELECT a, b FROM both_ways UNION SELECT r.a, s.b FROM reach r JOIN both_ways s ON r.b = s.a),
rooted AS (SELECT node, least(node, coalesce(min(b), node)) AS root FROM nodes LEFT JOIN reach ON node = a GROUP BY node)"""

_OP5 = f"""
WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS (
  SELECT x.vec_id AS a, y.vec_id AS b FROM v x JOIN v y ON x.label = y.label AND x.vec_id < y.vec_id AND len(x.e) = len(y.e) WHERE list_dot_product(x.e, y.e) / sqrt(list_dot_product(x.e, x.e)) / sqrt(list_dot_product(y.e, y.e)) >= 0.93
), nodes AS (SELECT vec_id AS node FROM embeddings), {_COMPONENTS},
degree AS (SELECT a, count(*) AS n FROM both_ways GROUP BY a)
SELECT vec_id, CAST(coalesce(n, 0) AS BIGINT) AS n_links, root AS component_id, vec_id = root AS kept FROM embeddings JOIN rooted ON vec_id = node LEFT JOIN degree ON vec_id = a
"""

#: The checksum byte by byte, over a table of its 256 remainders.
_OP7 = """
WITH crc AS (SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(CAST(i AS BIGINT), CAST(range(8) AS BIGINT[])), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END)) AS tab),
maps AS (SELECT [{now}] AS now, [{grown}] AS grown),
slots AS (
  SELECT doc_id, CAST(strlen(coalesce(text, '')) + 1 AS BIGINT) AS size, CAST(CAST('0x' || substr(md5(CAST(doc_id AS VARCHAR)), 1, 8) AS BIGINT) % 4096 AS INTEGER) AS virtual_slot,
    xor(list_reduce(list_prepend(4294967295, list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda h: CAST('0x' || h AS BIGINT))), lambda c, b: xor(c // 256, tab[xor(c % 256, b) + 1])), 4294967295) AS text_crc32
  FROM documents, crc
), placed AS (SELECT *, CAST(now[virtual_slot + 1] AS INTEGER) AS shard, CAST(grown[virtual_slot + 1] AS INTEGER) AS grown_shard FROM slots, maps)
SELECT doc_id, size, text_crc32, 'key' AS law, shard, row_number() OVER (PARTITION BY shard ORDER BY virtual_slot, doc_id, text_crc32, size) - 1 AS slot, grown_shard, virtual_slot FROM placed
"""

_OP10 = f"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^{_WS}]+') AS ws FROM documents
), s AS (
  SELECT doc_id, CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 3 THEN [array_to_string(ws, ' ')] ELSE list_distinct(list_transform(range(1, len(ws) - 1), lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2])) END AS g FROM w
), x AS (SELECT doc_id, unnest(g) AS t FROM s), n AS (SELECT doc_id, CAST(len(g) AS BIGINT) AS n FROM s),
pairs AS (SELECT p.doc_id AS a, q.doc_id AS b, count(*) AS o FROM x p JOIN x q ON p.t = q.t AND p.doc_id < q.doc_id GROUP BY 1, 2),
links AS (SELECT a, b FROM pairs JOIN n p ON p.doc_id = a JOIN n q ON q.doc_id = b WHERE 100 * o >= 90 * (p.n + q.n - o)),
nodes AS (SELECT doc_id AS node FROM documents), {_COMPONENTS}
SELECT doc_id, n AS n_shingles, root AS component_id FROM n JOIN rooted ON doc_id = node
"""


def oracle_sql() -> dict[str, str]:
    maps = {name: ", ".join(map(str, sharding.slot_map(n))) for name, n in (("now", 16), ("grown", 17))}
    op7 = _OP7.replace("{now}", maps["now"]).replace("{grown}", maps["grown"])
    return {"op2_line_dedup": _OP2, "op4_poisson_mixing": _OP4, "op5_embedding_grid_join": _OP5, "op7_virtual_slots": op7, "op8_quality_cascade": _OP8, "op10_ngram_jaccard": _OP10}
