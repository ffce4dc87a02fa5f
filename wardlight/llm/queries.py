"""The queries of the corpus operators over the given tables, and the SQL for those that SQL can express."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardlight.llm import (decontaminate, embedding_dedup, html_text, line_dedup, merkle, mixing, periodic, quality_rules, secrets,
                           simhash, tokens, url_rules, warc)
from wardlight.llm.common import read
from wardlight.workspace import stage_path


def op1_secrets(spark: SparkSession, folder: str) -> DataFrame:
    """Secrets in every document, as they stand and in decoded layers."""
    return secrets.secrets(read(spark, folder, "documents"))


def op2_token_ids(spark: SparkSession, folder: str) -> DataFrame:
    """Token ids of all documents are written as wavelet-matrix shards and read back; a row per document."""
    path = stage_path(spark, "token-shards")
    tokens.write_shards(read(spark, folder, "documents"), path, public_tokenizers.path(tokens.TOKENIZER))
    return (tokens.documents(tokens.read_shards(spark, path))
            .select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32")))


def op3_url_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Host, path, deciding rule and verdict of every page's url."""
    pages = read(spark, folder, "pages").select("page_id", "url")
    return url_rules.judge(pages, url_rules.rule_table(spark, url_rules.RULES)).drop("url")


OP3_SQL = r"""
WITH rules(verdict, host, path) AS (VALUES
  ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'),
  ('allow', 'com', '/fr/'), ('block', 'com', '/de/')),
keyed AS (
  SELECT page_id,
    translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''),
              'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages),
fitting AS (
  SELECT k.page_id, k.host, k.path, r.host || r.path AS rule, r.verdict,
    row_number() OVER (PARTITION BY k.page_id ORDER BY length(r.host || r.path) DESC NULLS LAST) AS n
  FROM keyed k LEFT JOIN rules r
    ON (k.host = r.host OR ends_with(k.host, '.' || r.host)) AND starts_with(k.path, r.path))
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM fitting WHERE n = 1
"""

def op4_warc(spark: SparkSession, folder: str) -> DataFrame:
    """Archives of all pages are written and read back; a row per record, its digest verified while reading."""
    path = stage_path(spark, "warc")
    warc.write_archives(read(spark, folder, "pages"), path)
    records = warc.read_records(spark.read.schema("archive string, content binary").parquet(path))
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "digest_ok")


OP4_SQL = """
WITH sealed AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest
  FROM pages),
firsts AS (
  SELECT *, CASE WHEN payload_bytes >= 100 THEN min(page_id) OVER (PARTITION BY payload_digest) END AS first FROM sealed)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
  CASE WHEN first <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN first <> page_id THEN first END AS refers_to, true AS digest_ok
FROM firsts
"""

def op5_simhash(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprint of every document over three-word shingles, and its component of links of at most three bits."""
    found = simhash.components(read(spark, folder, "documents"), shingle=3)
    return found.select("doc_id", simhash.hexadecimal(F.col("bits")).alias("fingerprint"), "component_id")


def op6_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    """Words of every document that lie in a window of a benchmark item, and the items found."""
    found = decontaminate.contamination(read(spark, folder, "documents"), read(spark, folder, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items",
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


def op7_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Counts of every document, the base verdict, and the verdict of the learned decision list."""
    docs = read(spark, folder, "documents")
    rules = quality_rules.learn_rules(docs, read(spark, folder, "labels"))
    return quality_rules.judge(docs, rules).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op8_html_text(spark: SparkSession, folder: str) -> DataFrame:
    """Main text of every page."""
    found = html_text.main_text(read(spark, folder, "pages"))
    return found.select("page_id", "url", "text", F.length("text").cast("bigint").alias("n_chars"))


#: Target weights of the registered mixing query and of the pipeline; all other sources have weight 1.
WEIGHTS = {"src0": 5, "src1": 3, "src2": 2}


def op9_mixing(spark: SparkSession, folder: str) -> DataFrame:
    """Place of every document in the mix of the sources to their target weights."""
    docs = read(spark, folder, "documents").select("doc_id", "source")
    return mixing.mix(docs, WEIGHTS)


OP9_SQL = """
WITH RECURSIVE sources AS (
  SELECT source, count(*) AS n, CASE source WHEN 'src0' THEN 5 WHEN 'src1' THEN 3 WHEN 'src2' THEN 2 ELSE 1 END AS w,
    row_number() OVER (ORDER BY source NULLS FIRST) AS i
  FROM documents GROUP BY source),
fixed AS (SELECT list(w ORDER BY i) AS w, list(n ORDER BY i) AS n, sum(w)::BIGINT AS period FROM sources),
edf AS (
  SELECT -1::BIGINT AS slot, 0::BIGINT AS i, list_transform(w, lambda x: 0::BIGINT) AS before, list_transform(w, lambda x: 0::BIGINT) AS done FROM fixed
  UNION ALL
  SELECT slot + 1, pick, done, list_transform(done, lambda x, j: CASE WHEN j = pick THEN x + 1 ELSE x END)
  FROM (
    SELECT e.slot, e.done, list_min(list_transform(generate_series(1, len(f.w)), lambda j:
      CASE WHEN e.done[j] < f.w[j] AND e.done[j] * f.period < (e.slot + 2) * f.w[j]
        THEN ((e.done[j] + 1) * f.period + f.w[j] - 1) // f.w[j] * 100000 + j END)) % 100000 AS pick
    FROM edf e, fixed f WHERE e.slot + 1 < f.period)),
numbered AS (
  SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY md5(coalesce(doc_id::VARCHAR, '') || ':0'), doc_id) - 1 AS nth
  FROM documents),
blocks AS (SELECT n.*, nth // 64 AS block, s.i, s.w FROM numbered n JOIN sources s ON n.source IS NOT DISTINCT FROM s.source)
SELECT b.doc_id, b.source, b.block, (b.block // b.w) * f.period + e.slot AS slot,
  list_sum(list_transform(generate_series(1, len(f.w)), lambda j: least(f.n[j], ((b.block // b.w) * f.w[j] + e.before[j]) * 64)))::BIGINT
    + b.nth % 64 AS position
FROM blocks b, fixed f, edf e
WHERE e.slot >= 0 AND e.i = b.i AND e.before[b.i] = b.block % b.w
"""

def op10_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Group and links of every line of every document, and whether it is removed for a match before it."""
    return line_dedup.line_groups(read(spark, folder, "documents"))


def op11_embedding_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Links of every vector with others of its label, and its component."""
    return embedding_dedup.near_duplicates(read(spark, folder, "embeddings"))


def op12_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    """Periodic runs of every document, one in ten of which goes round in a circle from some word on."""
    return periodic.report(periodic.runs(read(spark, folder, "documents"), cycle=True))


OP11_SQL = """
WITH RECURSIVE pairs AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM embeddings a JOIN embeddings b ON a.label = b.label AND a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]) >= 0.93),
reach AS (SELECT vec_id AS a, vec_id AS b FROM embeddings UNION SELECT r.a, p.b FROM reach r JOIN pairs p ON r.b = p.a)
SELECT r.a AS vec_id, (SELECT count(*) FROM pairs p WHERE p.a = r.a) AS n_links, min(r.b) AS component_id, r.a = min(r.b) AS kept
FROM reach r GROUP BY r.a
"""


def op13_merkle(spark: SparkSession, folder: str) -> DataFrame:
    """Leaf, roots and proof of every document, and whether what is there now still leads to the root."""
    found = merkle.verified(merkle.manifest(read(spark, folder, "documents")))
    return found.select("doc_id", "leaf", "subroot", "root", F.sha2(merkle.proof(F.col("path")), 256).alias("proof_sha256"),
                        "folded_root", "verified")


def _path_sql(name: str, first: str, tree: str, match: str) -> str:
    """Siblings on the way up a tree of lists, and what the changed leaf leads to, level by level."""
    return f"""
{name} AS (
  {first}
  UNION ALL
  SELECT w.doc_id, w.source, w.level + 1, w.place // 3, w.proof || b.before || b.after, sha256(b.before || w.folded || b.after), w.leaf
  FROM {name} w JOIN {tree} t ON {match} AND t.level = w.level AND len(t.nodes) > 1,
  LATERAL (SELECT array_to_string(t.nodes[w.place // 3 * 3 + 1 : w.place], '') AS before,
                  array_to_string(t.nodes[w.place + 2 : w.place // 3 * 3 + 3], '') AS after) b)"""


_UP = "list_transform(range(0, len(nodes), 3), lambda i: sha256(array_to_string(nodes[i + 1 : i + 3], '')))"
_FIELD = "coalesce(octet_length(encode({0}::VARCHAR)) || ':' || {0}::VARCHAR, '-')"
OP13_SQL = f"""
WITH RECURSIVE
named AS (
  SELECT *, {' || '.join(_FIELD.format(c) for c in ('doc_id', 'source', 'lang', 'n_chars'))} AS head,
    list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
      lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
        lambda x, y: xor(x >> 1, (x & 1) * 3988292384))) & 1 AS odd
  FROM documents),
hashed AS (
  SELECT doc_id, source, sha256(head || {_FIELD.format('text')}) AS leaf,
    sha256(head || {_FIELD.format("CASE WHEN odd = 1 THEN replace(text, chr(10), '') ELSE text END")}) AS leaf_now
  FROM named),
placed AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS place FROM hashed),
tree AS (
  SELECT source, 0 AS level, list(leaf ORDER BY place) AS nodes FROM placed GROUP BY source
  UNION ALL SELECT source, level + 1, {_UP} FROM tree WHERE len(nodes) > 1),
subroots AS (SELECT source, nodes[1] AS subroot, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS place FROM tree WHERE len(nodes) = 1),
top AS (
  SELECT 0 AS level, list(subroot ORDER BY place) AS nodes FROM subroots
  UNION ALL SELECT level + 1, {_UP} FROM top WHERE len(nodes) > 1),
{_path_sql('walk', "SELECT doc_id, source, 0 AS level, place, '' AS proof, leaf_now AS folded, leaf FROM placed", 'tree',
           't.source IS NOT DISTINCT FROM w.source')},
below AS (SELECT * FROM walk QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY level DESC) = 1),
{_path_sql('onwards', "SELECT b.doc_id, b.source, 0 AS level, s.place, b.proof, b.folded, b.leaf FROM below b JOIN subroots s ON "
           "b.source IS NOT DISTINCT FROM s.source", 'top', 'true')},
above AS (SELECT * FROM onwards QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY level DESC) = 1)
SELECT a.doc_id, a.leaf, s.subroot, t.nodes[1] AS root, sha256(a.proof) AS proof_sha256, a.folded AS folded_root,
  a.folded = t.nodes[1] AS verified
FROM above a JOIN subroots s ON a.source IS NOT DISTINCT FROM s.source JOIN top t ON len(t.nodes) = 1
"""


QUERIES = {
    "op1_secrets": op1_secrets,
    "op2_token_ids": op2_token_ids,
    "op3_url_rules": op3_url_rules,
    "op4_warc": op4_warc,
    "op5_simhash": op5_simhash,
    "op6_decontamination": op6_decontamination,
    "op7_quality_rules": op7_quality_rules,
    "op8_html_text": op8_html_text,
    "op9_mixing": op9_mixing,
    "op10_line_dedup": op10_line_dedup,
    "op11_embedding_dedup": op11_embedding_dedup,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_merkle": op13_merkle,
}

ORACLE_SQL = {
    "op3_url_rules": OP3_SQL,
    "op4_warc": OP4_SQL,
    "op9_mixing": OP9_SQL,
    "op11_embedding_dedup": OP11_SQL,
    "op13_merkle": OP13_SQL,
}
