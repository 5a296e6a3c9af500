"""The registered queries: each operator over its whole table, with production parameters."""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import alignment, chat, decontaminate, lexical, neardup, neighbours, packing, quality, sharding, substrings, tokencount, urlfilter, warc
from .common import shared_dir, table

# The rules of the url query.
URL_RULES = [("org/", "allow"), ("example.org/es/", "block"), ("example.org/en/1", "block"), ("com/fr/", "allow"), ("com/de/", "block")]


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = packing.pieces(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), capacity=2048, end_id=0)
    return packing.pack(cut.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32")), capacity=2048)


def op2_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents"), k=5, percent=75)


def op3_preference_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each conversation against itself with another last reply: the table holds no preferences."""
    pairs = chat.with_last_reply_replaced(chat.conversations(table(spark, sf_dir, "conversations")))
    mask = lambda c: F.array_join(F.transform(c, lambda s: F.concat(s["start"].cast("string"), F.lit("-"), s["stop"].cast("string"))), " ")
    rows = chat.format_preferences(pairs).withColumns({c: mask(c) for c in ("chosen_mask", "rejected_mask")})
    return rows.select("conv_id", "prompt_turns", "prompt", "chosen_text", "chosen_mask", "rejected_text", "rejected_mask")


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substrings.remove_repeats(table(spark, sf_dir, "documents"), window=20)
    return found.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.find_contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), window=13, share=20)
    joined = F.sha2(F.array_join("items", ",").cast("binary"), 256)
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), joined.alias("items_sha256"), "contaminated")


def op6_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(table(spark, sf_dir, "embeddings"), count=20, every=20)


def op7_stratified_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.interleave(table(spark, sf_dir, "documents"), 16, strata="source")


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urlfilter.judge_urls(table(spark, sf_dir, "pages"), URL_RULES, default="allow")


def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    net = quality.train(documents, table(spark, sf_dir, "labels"), label_col="quality")
    return quality.score(documents, net, threshold=0.7)


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokencount.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), limit=1024)


def op11_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = f"{shared_dir(spark)}/warc-{uuid.uuid4().hex[:12]}"
    records = warc.read_archives(warc.write_archives(table(spark, sf_dir, "pages"), folder), folder)
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.rank_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), count=10)


QUERIES = {f.__name__: f for f in (op1_best_fit_packing, op2_minhash_near_dedup, op3_preference_formatting, op4_substring_dedup, op5_decontamination, op6_nearest_neighbours, op7_stratified_sharding, op8_url_filter, op9_quality_classifier, op10_token_counts, op11_warc, op12_token_alignment, op13_lexical_search)}

ORACLE_SQL = {
    "op3_preference_formatting": """
WITH t AS (SELECT conv_id, list({'role': coalesce(role, 'user'), 'text': coalesce(text, '')} ORDER BY turn NULLS FIRST, coalesce(role, 'user'), coalesce(text, '')) AS c
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
p AS (SELECT *, list_filter(range(1, len(c) + 1), lambda i: c[i].role = 'assistant') AS a FROM t),
r AS (SELECT conv_id, c, list_transform(range(1, len(c) + 1), lambda i: {'role': c[i].role, 'text': CASE WHEN i = a[-1] THEN CASE WHEN len(a) > 1 THEN c[a[1]].text ELSE '' END ELSE c[i].text END}) AS r FROM p),
n AS (SELECT *, coalesce(list_min(list_filter(range(1, len(c) + 1), lambda i: c[i] <> r[i])) - 1, len(c)) AS n FROM r),
x AS (SELECT conv_id, n, c[1:n] AS p, c[n + 1:] AS c, r[n + 1:] AS r FROM n),
s AS (SELECT conv_id, n, list_transform(p, lambda y: '<|' || y.role || '|>' || chr(10) || y.text || '<|end|>' || chr(10)) AS ps, c, r,
  list_transform(c, lambda y: '<|' || y.role || '|>' || chr(10) || y.text || '<|end|>' || chr(10)) AS cs, list_transform(r, lambda y: '<|' || y.role || '|>' || chr(10) || y.text || '<|end|>' || chr(10)) AS rs FROM x)
SELECT conv_id, cast(n AS INTEGER) AS prompt_turns, array_to_string(ps, '') AS prompt, array_to_string(cs, '') AS chosen_text, array_to_string(rs, '') AS rejected_text,
  array_to_string(list_transform(list_filter(range(1, len(c) + 1), lambda i: c[i].role = 'assistant'), lambda i: (length(array_to_string(cs[1:i - 1], '')) + length(c[i].role) + 5) || '-' || length(array_to_string(cs[1:i], ''))), ' ') AS chosen_mask,
  array_to_string(list_transform(list_filter(range(1, len(r) + 1), lambda i: r[i].role = 'assistant'), lambda i: (length(array_to_string(rs[1:i - 1], '')) + length(r[i].role) + 5) || '-' || length(array_to_string(rs[1:i], ''))), ' ') AS rejected_mask
FROM s
""",
    "op11_warc": """
WITH p AS (SELECT page_id, coalesce(html, '') AS body, sha1(coalesce(html, '')) AS hex, row_number() OVER (PARTITION BY coalesce(html, '') ORDER BY page_id DESC NULLS LAST) AS k,
  max(page_id) OVER (PARTITION BY coalesce(html, '')) AS first FROM pages),
d AS (SELECT *, list_transform(range(0, 8), lambda i: cast('0x' || substr(hex, cast(5 * i + 1 AS INTEGER), 5) AS BIGINT)) AS five FROM p)
SELECT page_id, cast(octet_length(encode(body)) AS BIGINT) AS payload_bytes,
  array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', cast(((five[i // 4 + 1] >> cast(15 - 5 * (i % 4) AS BIGINT)) & 31) + 1 AS INTEGER), 1)), '') AS payload_digest,
  CASE WHEN k = 1 THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN k > 1 THEN first END AS refers_to FROM d
""",
    "op13_lexical_search": r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS words FROM documents),
h AS (SELECT * FROM d WHERE len(words) > 0),
total AS (SELECT count(*) AS n, cast(sum(len(words)) AS BIGINT) AS l FROM h),
q AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark WHERE item_id IS NOT NULL),
w AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(words) AS term FROM h) WHERE term IN (SELECT term FROM q) GROUP BY r, term),
f AS (SELECT term, cast(floor(1000 * ln((2 * any_value(total.n) + 2) / (2 * count(*) + 1))) AS BIGINT) AS weight FROM w, total GROUP BY term),
m AS (SELECT r, doc_id, 10 + (90 * len(words) * total.n) // total.l AS m FROM h, total),
s AS (SELECT q.item_id, m.r, m.doc_id, cast(sum(f.weight * ((1000000000 * w.tf) // (1000 * w.tf + 8 * m.m))) AS BIGINT) AS score
  FROM q JOIN w USING (term) JOIN f USING (term) JOIN m ON m.r = w.r GROUP BY q.item_id, m.r, m.doc_id),
k AS (SELECT item_id, doc_id, score, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM s WHERE score > 0)
SELECT item_id, cast(rank AS INTEGER) AS rank, doc_id, score FROM k WHERE rank <= 10
""",
    "op8_url_filter": """
WITH rules(host, path, rule, verdict) AS (VALUES ('org', '/', 'org/', 'allow'), ('example.org', '/es/', 'example.org/es/', 'block'),
  ('example.org', '/en/1', 'example.org/en/1', 'block'), ('com', '/fr/', 'com/fr/', 'allow'), ('com', '/de/', 'com/de/', 'block')),
u AS (SELECT page_id, coalesce(CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) END, '') AS rest FROM pages),
h AS (SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
  regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path, row_number() OVER () AS n FROM u),
m AS (SELECT h.n, r.rule, r.verdict, row_number() OVER (PARTITION BY h.n ORDER BY length(r.rule) DESC) AS k
  FROM h JOIN rules r ON (h.host = r.host OR ends_with(h.host, '.' || r.host)) AND starts_with(h.path, r.path))
SELECT h.page_id, h.host, h.path, m.rule, coalesce(m.verdict, 'allow') AS verdict FROM h LEFT JOIN m ON m.n = h.n AND m.k = 1
""",
}
