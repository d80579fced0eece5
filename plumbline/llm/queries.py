"""The queries over the test tables, and SQL where SQL can express the operator."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import byte_bpe, exact_dedup, language_id, merkle, mixing, ngram_lm, quality, repeats, simhash, token_alignment, token_counts, url_rules, vectors
from .common import read

RULES = (("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"), ("com", "/de/", "block"))


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = exact_dedup.assign(read(spark, sf_dir, "documents"))
    return rows.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest_")).alias("text_sha256"))


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(read(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op4_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = read(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return vectors.nearest(table.filter("vec_id % 100 = 0"), table)


def op5_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_lm.score(read(spark, sf_dir, "documents"))


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(read(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(read(spark, sf_dir, "documents"))


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = simhash.near_duplicates(read(spark, sf_dir, "documents"))
    return rows.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op9_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.sql(f"SELECT * FROM VALUES {', '.join(str(r) for r in RULES)} AS r(host, path, action)")
    return url_rules.judge(read(spark, sf_dir, "pages"), rules)


def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.digests(read(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.tiktoken"), pattern())


def repeat_digests(rows: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of texts without their repeats."""
    return rows.select(
        "doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"), F.size("spans").cast("bigint").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"))


def op11_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeat_digests(repeats.without_repeats(read(spark, sf_dir, "documents")))


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_alignment.align(read(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"), pattern(), vocabulary("piece_bpe_32k.model"))


def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.manifest(read(spark, sf_dir, "documents"))


A_TO_Z = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"

OP2_SQL = f"""
WITH d AS (SELECT doc_id, sha256(translate(coalesce(text, ''), {A_TO_Z})) AS text_sha256 FROM documents),
g AS (SELECT text_sha256, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY 1)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM d JOIN g USING (text_sha256)
"""

OP9_SQL = f"""
WITH u AS (
  SELECT page_id, coalesce(translate(regexp_extract(url, '^(?s:.*?)://([^/?#]*)', 1), {A_TO_Z}), '') AS host,
         coalesce(regexp_extract(url, '^(?s:.*?)://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
r(rhost, rpath, action) AS (VALUES {", ".join(str(r) for r in RULES)}),
f AS (
  SELECT page_id, max({{'size': length(rhost || rpath), 'host_size': length(rhost), 'rule': rhost || rpath, 'action': action}}) AS best
  FROM u JOIN r ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath) GROUP BY page_id)
SELECT page_id, host, path, best.rule AS rule, coalesce(best.action, 'allow') AS verdict FROM u LEFT JOIN f USING (page_id)
"""

_FIELD = "coalesce(strlen({0}::VARCHAR) || ':' || {0}::VARCHAR, '-')"
_LEAF = " || ".join(_FIELD.format(c) for c in ("doc_id", "source", "lang", "n_chars"))
# a checksum bit by bit: 3988292384 is the reversed polynomial of crc32
_CRC = """list_reduce([4294967295::BIGINT] || flatten(list_transform(range(length(doc_id::VARCHAR)), lambda i:
  list_transform(range(8), lambda k: (ascii(substr(doc_id::VARCHAR, i + 1, 1)) >> k::INT)::BIGINT & 1))), lambda c, b: xor(c >> 1, (xor(c, b) & 1) * 3988292384))"""
_TREE = """{0}(level, tree, pos, digest, n) AS (
  SELECT 0, tree, pos, digest, n FROM {1}
  UNION ALL SELECT level + 1, tree, pos // 3, sha256(string_agg(digest, '' ORDER BY pos)), (any_value(n) + 2) // 3 FROM {0} WHERE n > 1 GROUP BY level, tree, pos // 3),
{0}_near AS (
  SELECT *, coalesce(lag(digest, 2) OVER w, '') || coalesce(lag(digest) OVER w, '') AS before, coalesce(lead(digest) OVER w, '') || coalesce(lead(digest, 2) OVER w, '') AS after
  FROM {0} WINDOW w AS (PARTITION BY level, tree, pos // 3 ORDER BY pos))"""
_CLIMB = """{0}_climb(r, level, tree, pos, h, proof) AS (
  SELECT r, 0, tree, pos, h, proof FROM {1}
  UNION ALL SELECT r, c.level + 1, tree, pos // 3, sha256(before || h || after), proof || before || after FROM {0}_climb c JOIN {0}_near USING (level, tree, pos) WHERE n > 1)"""
OP13_SQL = f"""
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS r, doc_id, source, sha256({_LEAF} || {_FIELD.format("text")}) AS digest,
         sha256({_LEAF} || {_FIELD.format("(CASE WHEN " + _CRC + " & 1 = 1 THEN replace(text, chr(10), '') ELSE text END)")}) AS h FROM documents),
p AS (
  SELECT r, doc_id, digest, h, '' AS proof, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS tree,
         row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, digest) - 1 AS pos, count(*) OVER (PARTITION BY source) AS n FROM d),
{_TREE.format("low", "p")}, {_CLIMB.format("low", "p")},
s AS (SELECT -1 AS tree, tree AS pos, digest, count(*) OVER () AS n FROM low WHERE n = 1),
{_TREE.format("top", "s")},
u AS (SELECT r, -1 AS tree, c.tree AS pos, h, proof, digest AS subroot FROM low_climb c JOIN low USING (level, tree, pos) WHERE n = 1), {_CLIMB.format("top", "u")},
root AS (SELECT digest AS root FROM top WHERE n = 1)
SELECT doc_id, p.digest AS leaf, subroot, root, sha256(c.proof) AS proof_sha256, c.h AS folded_root, c.h = root AS verified
FROM top_climb c JOIN top ON c.level = top.level AND c.pos = top.pos AND top.n = 1 JOIN p USING (r) JOIN u USING (r), root
"""

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_quality, op2_exact_dedup, op3_mixing, op4_nearest, op5_lm_scores, op6_token_counts, op7_language_id, op8_simhash, op9_url_rules,
        op10_byte_bpe, op11_repeats, op12_alignment, op13_merkle)}
ORACLES: dict[str, str] = {"op2_exact_dedup": OP2_SQL, "op9_url_rules": OP9_SQL, "op13_merkle": OP13_SQL}
