"""Registered queries of the text operators, over whole tables, and their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.llm import (
    bpe, lexical_search, packing, pii, prefix_trie, quality_classifier, quality_rules, simhash, sketches, substring_dedup,
    token_files, url_filter, warc,
)
from basketry.llm.common import stored

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(function):
        QUERIES[name] = function
        if sql:
            ORACLES[name] = sql
        return function

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op1_packing")
def op1(spark, sf_dir):
    import public_tokenizers

    packed = packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return packing.with_checksum(packed).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


@query("op2_url_filter", """
WITH u AS (
  SELECT page_id, coalesce(url, '') AS url, strpos(coalesce(url, ''), '://') AS p FROM pages),
r AS (SELECT page_id, CASE WHEN p > 0 THEN substr(url, p + 3) ELSE '' END AS rest FROM u),
h AS (SELECT page_id, regexp_extract(rest, '^([^/?#]*)', 1) AS raw, rest FROM r),
k AS (
  SELECT page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(substr(rest, length(raw) + 1), '^([^?#]*)', 1) AS path FROM h),
rules(rhost, rpath, rule, verdict) AS (
  VALUES ('net', '/', 'net/', 'block'), ('example.net', '/en/', 'example.net/en/', 'allow'),
         ('example.com', '/de/', 'example.com/de/', 'block'), ('org', '/fr/', 'org/fr/', 'allow')),
j AS (
  SELECT k.page_id, k.host, k.path, rule, verdict,
         row_number() OVER (PARTITION BY k.page_id ORDER BY length(rule) DESC NULLS LAST) AS place
  FROM k LEFT JOIN rules ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath))
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM j WHERE place = 1
""")
def op2(spark, sf_dir):
    rules = spark.sql(
        "SELECT * FROM VALUES ('net', '', 'block'), ('example.net', 'en/', 'allow'), ('example.com', 'de/', 'block'),"
        " ('org', 'fr/', 'allow') AS rules(host, path, verdict)")
    return url_filter.judge(table(spark, sf_dir, "pages"), rules)


OP3_SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
win AS (
  SELECT doc_id, i, md5(array_to_string(w[i:i + 49], ' ')) AS h
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM d WHERE len(w) >= 50)),
late AS (
  SELECT doc_id, i FROM (SELECT *, min(doc_id) OVER (PARTITION BY h) AS least FROM win) WHERE doc_id > least),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS j FROM late),
word AS (SELECT doc_id, unnest(w) AS x, generate_subscripts(w, 1) AS j FROM d),
kept AS (
  SELECT doc_id, string_agg(x, ' ' ORDER BY j) AS text, count(*) AS n
  FROM word ANTI JOIN gone USING (doc_id, j) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(text, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)"""


@query("op3_substring_dedup", OP3_SQL)
def op3(spark, sf_dir):
    rows = substring_dedup.remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return rows.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@query("op4_pii")
def op4(spark, sf_dir):
    documents = table(spark, sf_dir, "documents")
    return pii.scan(documents, pii.train(documents)).withColumn("base_sha256", F.sha2("base_spans", 256)).drop("base_spans")


@query("op5_quality_classifier")
def op5(spark, sf_dir):
    return quality_classifier.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op6_simhash")
def op6(spark, sf_dir):
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


@query("op7_bpe")
def op7(spark, sf_dir):
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.json")
    tokens = bpe.decode(bpe.encode(table(spark, sf_dir, "documents"), path), path)
    return tokens.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


@query("op8_warc", """
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS n, sha1(coalesce(html, '')) AS digest FROM pages),
t AS (SELECT *, CASE WHEN n >= 1000 THEN max(page_id) OVER (PARTITION BY digest) ELSE page_id END AS target FROM p)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, digest AS payload_digest,
       CASE WHEN target = page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN target <> page_id THEN target END AS refers_to
FROM t""")
def op8(spark, sf_dir):
    rows = warc.round_trip(table(spark, sf_dir, "pages"))
    return rows.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query("op9_sketches")
def op9(spark, sf_dir):
    return sketches.compare_edits(table(spark, sf_dir, "documents"))


WORDS = r"[^\x20\x09-\x0D]+"
OP10_BITS = f"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, row_number() OVER () AS r FROM documents),
w AS (
  SELECT r, unnest(regexp_extract_all(t, '{WORDS}')) AS word,
         generate_subscripts(regexp_extract_all(t, '{WORDS}'), 1) AS i FROM d),
tri AS (
  SELECT r, i, word AS a, lead(word) OVER (PARTITION BY r ORDER BY i) AS b,
         lead(word, 2) OVER (PARTITION BY r ORDER BY i) AS c FROM w),
many AS (
  SELECT r, i FROM (SELECT r, i, c, count(*) OVER (PARTITION BY r, a, b, c) AS n FROM tri) WHERE c IS NOT NULL AND n > 1),
inside AS (
  SELECT r, count(DISTINCT j) AS n_repeat_words
  FROM (SELECT r, unnest([i, i + 1, i + 2]) AS j FROM many) GROUP BY r),
lines AS (
  SELECT r, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines
  FROM (SELECT r, unnest(string_split(t, chr(10))) AS line FROM d)
  WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]') GROUP BY r),
m AS (
  SELECT doc_id, len(regexp_extract_all(t, '{WORDS}')) AS n_words,
         length(regexp_replace(t, '[\\x20\\x09-\\x0D]', '', 'g')) AS word_chars,
         length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
         coalesce(n_lines, 0) AS n_lines, coalesce(n_dup_lines, 0) AS n_dup_lines,
         coalesce(n_repeat_words, 0) AS n_repeat_words,
         length(regexp_replace(t, '[^A-Z]', '', 'g')) AS n_upper,
         length(regexp_replace(t, '[^A-Za-z]', '', 'g')) AS n_letters,
         length(regexp_replace(t, '[^!]', '', 'g')) AS n_marks
  FROM d LEFT JOIN inside USING (r) LEFT JOIN lines USING (r)),
b AS (
  SELECT *,
         CASE WHEN n_words < 50 THEN 1 ELSE 0 END
         + CASE WHEN 100 * n_repeat_words > 50 * n_words THEN 2 ELSE 0 END
         + CASE WHEN 10 * n_symbols > n_words THEN 4 ELSE 0 END
         + CASE WHEN 2 * n_dup_lines > n_lines THEN 8 ELSE 0 END
         + CASE WHEN 2 * n_upper > n_letters THEN 16 ELSE 0 END
         + CASE WHEN 2 * n_marks > n_words THEN 32 ELSE 0 END
         + CASE WHEN word_chars > 15 * n_words THEN 64 ELSE 0 END AS bits
  FROM m)
"""
OP10_SQL = f"""{OP10_BITS}
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars,
       CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines,
       CAST(n_repeat_words AS BIGINT) AS n_repeat_words, CAST(bits AS BIGINT) AS failed,
       bits & 3 <> 0 AS base_failed, bits = 0 AS kept
FROM b"""


@query("op10_quality_rules", OP10_SQL)
def op10(spark, sf_dir):
    ledger = stored(quality_rules.ledger(table(spark, sf_dir, "documents")), "quality-ledger")
    rows = quality_rules.verdicts(ledger)
    return rows.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "failed", "base_failed", "kept")


@query("quality_rule_ablations", f"""{OP10_BITS}
SELECT rule, count(*) FILTER (bits & flag <> 0) AS n_failed, count(*) FILTER (bits = flag) AS n_only
FROM b, (VALUES {", ".join(f"('{name}', {1 << k})" for k, (name, _) in enumerate(quality_rules.RULES))}) AS r(rule, flag)
GROUP BY rule""")
def quality_rule_ablations(spark, sf_dir):
    return quality_rules.ablations(stored(quality_rules.ledger(table(spark, sf_dir, "documents")), "quality-ledger"))


@query("op11_token_files")
def op11(spark, sf_dir):
    import public_tokenizers

    return token_files.round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


TERMS = "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), " \
    r"'[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"


@query("op12_lexical_search", f"""
WITH t AS (SELECT doc_id, unnest({TERMS}) AS term FROM documents),
tf AS (SELECT doc_id, term, count(*) AS tf FROM t GROUP BY doc_id, term),
n AS (SELECT doc_id, count(*) AS n FROM t GROUP BY doc_id),
s AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS words FROM n),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
q AS (SELECT DISTINCT item_id, unnest({TERMS}) AS term FROM benchmark),
sc AS (
  SELECT item_id, doc_id,
         CAST(sum(CAST(floor(1000 * ln((2 * docs + 2) / (2 * df + 1))) AS BIGINT)
                  * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * n * docs) // words)))) AS BIGINT) AS score
  FROM q JOIN tf USING (term) JOIN df USING (term) JOIN n USING (doc_id), s GROUP BY item_id, doc_id),
r AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank
  FROM sc WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM r WHERE rank <= 10""")
def op12(spark, sf_dir):
    return lexical_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op13_prefix_trie", """
WITH RECURSIVE ids AS (SELECT DISTINCT conv_id FROM conversations WHERE conv_id IS NOT NULL),
crc AS (
  SELECT conv_id, CAST(conv_id AS VARCHAR) AS s, 0 AS k, 4294967295::BIGINT AS v FROM ids
  UNION ALL
  SELECT conv_id, s, k + 1, xor(x >> 1, CASE WHEN x & 1 = 1 THEN 3988292384 ELSE 0 END)
  FROM (SELECT *, CASE WHEN k % 8 = 0 THEN xor(v, ascii(substr(s, k // 8 + 1, 1))::BIGINT) ELSE v END AS x FROM crc)
  WHERE k < 8 * length(s)),
c AS (SELECT conv_id, xor(v, 4294967295) % 9 AS h, conv_id - conv_id % 5 AS base FROM crc WHERE k = 8 * length(s)),
t AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS i,
         coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations),
heads AS (SELECT c.conv_id, t.i, role, text FROM c JOIN t ON t.conv_id = base AND i <= h),
n AS (SELECT conv_id, count(*) AS n FROM heads GROUP BY conv_id),
r AS (
  SELECT conv_id, i AS d, role, text FROM heads
  UNION ALL
  SELECT c.conv_id, coalesce(n.n, 0) + i - h, role, text
  FROM c JOIN t ON t.conv_id = c.conv_id AND i > h LEFT JOIN n ON n.conv_id = c.conv_id),
p AS (
  SELECT conv_id, d, octet_length(encode(text)) AS size,
         sha256(string_agg(sha256(concat(strlen(role), ':', role, text)), '' ORDER BY d)
                OVER (PARTITION BY conv_id ORDER BY d)) AS key FROM r
  UNION ALL SELECT conv_id, 0, 0, '' FROM ids),
ended AS (SELECT conv_id, max(d) AS d FROM p GROUP BY conv_id),
ends AS (
  SELECT d, key, string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) AS ids
  FROM ended JOIN p USING (conv_id, d) GROUP BY d, key),
node AS (SELECT d, key, min(conv_id) AS conv_id, count(*) AS n, any_value(size) AS size FROM p GROUP BY d, key),
up AS (
  SELECT node.d, node.key, node.conv_id, node.n, node.size, above.key AS pkey FROM node
  LEFT JOIN p AS above ON above.conv_id = node.conv_id AND above.d = node.d - 1),
kids AS (SELECT d - 1 AS d, pkey AS key, count(*) AS n_children FROM up WHERE d > 0 GROUP BY 1, 2),
whole AS (SELECT up.*, coalesce(n_children, 0) AS n_children FROM up LEFT JOIN kids USING (d, key)),
below AS (
  SELECT p.d, p.key, count(*) FILTER (n_children = 0) AS n_leaves, sum((n - 1) * w.size) AS saved
  FROM whole w JOIN p ON p.conv_id = w.conv_id AND p.d <= w.d GROUP BY p.d, p.key)
SELECT w.conv_id, w.d AS depth, parent.conv_id AS parent_conv_id, w.n AS n_convs, w.n_children, n_leaves,
       CAST(saved AS BIGINT) AS saved_tokens, sha256(coalesce(ids, '')) AS ends_sha256
FROM whole w JOIN below USING (d, key) LEFT JOIN node AS parent ON parent.d = w.d - 1 AND parent.key = w.pkey
LEFT JOIN ends ON ends.d = w.d AND ends.key = w.key""")
def op13(spark, sf_dir):
    return prefix_trie.nodes(table(spark, sf_dir, "conversations"))
