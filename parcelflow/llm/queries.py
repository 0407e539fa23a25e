"""Registered queries of the subpackage: each operator over its whole table with
production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from parcelflow.llm import divergence, fm_dedup, license_templates, line_crf, lz_fingerprint, partition_join, pseudonyms, secret_scan, simhash_cover, spelling, tiling, vector_packing, window_packing
from parcelflow.llm.frames import documents

PII_KEY_SETTING = "spark.parcelflow.pii.key"
#: For the registered query alone, whose output is a test: whoever knows the key can reverse it.
TEST_KEY = "parcelflow public test key"


def pii_key(spark: SparkSession) -> bytes:
    """The secret key of pseudonyms; a session that doesn't name one raises."""
    key = spark.conf.get(PII_KEY_SETTING, None)
    if not key:
        raise ValueError(f"set {PII_KEY_SETTING} to a secret key")
    return key.encode()


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_license_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_templates.scan_licenses(documents(spark, sf_dir))


def op2_benchmark_tiling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tiling.find_leaks(documents(spark, sf_dir), _table(spark, sf_dir, "benchmark"))


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan_secrets(documents(spark, sf_dir))


def op4_fm_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fm_dedup.dedup_windows(documents(spark, sf_dir))


def op5_vector_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_packing.assign_shards(documents(spark, sf_dir))


def op6_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = pii_key(spark) if spark.conf.get(PII_KEY_SETTING, None) else TEST_KEY.encode()
    return pseudonyms.pseudonymise(documents(spark, sf_dir), key)


def op7_partition_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = partition_join.similarity_components(documents(spark, sf_dir), shingle=3, percent=90)
    return rows.select("doc_id", "n_shingles", "component_id")


def op8_window_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return window_packing.pack(documents(spark, sf_dir))


def op9_lz_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lz_fingerprint.compare_edited(documents(spark, sf_dir))


def op10_line_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = line_crf.train(docs, _table(spark, sf_dir, "labels"))
    return line_crf.score_documents(docs, model)


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.group_variants(documents(spark, sf_dir))


def op12_simhash_cover(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_cover.near_duplicates(documents(spark, sf_dir))


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.source_divergence(documents(spark, sf_dir))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_license_templates, op2_benchmark_tiling, op3_secret_scan, op4_fm_dedup, op5_vector_packing,
                            op6_pseudonyms, op7_partition_join, op8_window_packing, op9_lz_fingerprint, op10_line_crf, op11_spelling_variants, op12_simhash_cover, op13_source_divergence)
}

_OP4_SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
win AS (SELECT doc_id, i, md5(array_to_string(w[i:i + 49], ' ')) AS h FROM d, unnest(range(1, len(w) - 48)) AS t(i) WHERE len(w) >= 50),
lo AS (SELECT h, min(doc_id) AS m FROM win GROUP BY h),
hit AS (SELECT doc_id, i FROM win JOIN lo USING (h) WHERE m < doc_id),
gone AS (SELECT DISTINCT doc_id, i + k AS p FROM hit, unnest(range(0, 50)) AS t(k)),
word AS (SELECT doc_id, p, w[p] AS x FROM d, unnest(range(1, len(w) + 1)) AS t(p)),
kept AS (SELECT doc_id, string_agg(x, ' ' ORDER BY p) AS s, count(*) AS c FROM word ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(c, 0))::BIGINT AS n_removed, sha256(coalesce(s, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""

_OP7_SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
sh AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 2], ' ') AS s FROM d, unnest(range(1, greatest(len(w) - 1, 2))) AS t(i) WHERE len(w) > 0),
n AS (SELECT doc_id, count(*) AS c FROM sh GROUP BY doc_id),
link AS (
  SELECT a.doc_id AS x, b.doc_id AS y FROM sh a JOIN sh b ON a.s = b.s AND a.doc_id < b.doc_id
  GROUP BY a.doc_id, b.doc_id
  HAVING 100 * count(*) >= 90 * ((SELECT c FROM n WHERE doc_id = a.doc_id) + (SELECT c FROM n WHERE doc_id = b.doc_id) - count(*))),
edge AS (SELECT x, y FROM link UNION ALL SELECT y, x FROM link),
reach AS (SELECT doc_id, doc_id AS r FROM d UNION SELECT reach.doc_id, edge.y FROM reach JOIN edge ON reach.r = edge.x)
SELECT d.doc_id, coalesce(n.c, 0)::BIGINT AS n_shingles, m.component_id
FROM d LEFT JOIN n USING (doc_id) JOIN (SELECT doc_id, min(r) AS component_id FROM reach GROUP BY doc_id) m USING (doc_id)
"""

_OP13_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
occ AS (SELECT r, lang, source, unnest(w) AS term FROM d),
kept AS (SELECT lang, term, count(*)::HUGEINT AS c FROM occ GROUP BY lang, term HAVING count(DISTINCT r) >= 10),
v AS (SELECT lang, count(*)::HUGEINT AS v, sum(c)::HUGEINT AS n FROM kept GROUP BY lang),
have AS (SELECT lang, source, term, count(*)::HUGEINT AS c FROM occ SEMI JOIN kept USING (lang, term) GROUP BY lang, source, term),
grp AS (SELECT g.lang, g.source, coalesce(s.n, 0)::HUGEINT AS n FROM (SELECT DISTINCT lang, source FROM d) g
  LEFT JOIN (SELECT lang, source, sum(c) AS n FROM have GROUP BY lang, source) s USING (lang, source)),
p AS (SELECT grp.lang, grp.source, kept.term, coalesce(have.c, 0) AS c, 1 + (1000000000::HUGEINT * (coalesce(have.c, 0) + 2)) // (grp.n + 2 * v.v) AS p,
    1 + (1000000000::HUGEINT * (kept.c + 2)) // (v.n + 2 * v.v) AS q
  FROM grp JOIN kept USING (lang) JOIN v USING (lang) LEFT JOIN have ON have.lang = grp.lang AND have.source = grp.source AND have.term = kept.term),
dist AS (SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY a.lang, a.source, b.source),
pair AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(dist.value, 0)::BIGINT AS value
  FROM grp a JOIN grp b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN dist ON dist.lang = a.lang AND dist.source = a.source AND dist.item = b.source),
term AS (SELECT lang, source, 'term' AS part, term AS item, (((p - q) * (p - q)) // (p + q))::BIGINT AS value FROM p WHERE c > 0 AND p > q),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM (SELECT * FROM pair UNION ALL SELECT * FROM term))
SELECT lang, source, part, item, value, rank::INTEGER AS rank FROM ranked WHERE part = 'pair' OR rank <= 10
"""

#: The other operators are beyond SQL (automata, checksums, order-dependent
#: packing, tokenizer, phrase dictionary, trained model): tests hold them against
#: brute force, exact round trips and held-out labels.
ORACLE: dict[str, str] = {"op4_fm_dedup": _OP4_SQL, "op7_partition_join": _OP7_SQL, "op13_source_divergence": _OP13_SQL}
