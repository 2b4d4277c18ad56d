"""One query per operator, with its parameters and column contract, and SQL where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.decontaminate import decontaminate
from tessera.llm.hard_negatives import hard_negatives
from tessera.llm.host_rules import host_rules
from tessera.llm.licence_scan import licence_scan
from tessera.llm.mixing import mix_sources
from tessera.llm.near_dedup import near_duplicates
from tessera.llm.ppm import ppm_scores
from tessera.llm.substring_dedup import repeat_report
from tessera.llm.suffix_dedup import byte_repeat_report
from tessera.llm.token_align import alignment_report
from tessera.llm.toxicity import toxicity
from tessera.llm.url_rules import judge_urls
from tessera.llm.zstd_quality import zstd_quality

URL_RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold_of(n: int):
    """crc32 of the id as text, modulo ``n``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % n


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeat_report(_table(spark, sf_dir, "documents"))


def op2_ppm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ppm_scores(_table(spark, sf_dir, "documents"), fold_of(10) != 0)


def op3_zstd_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return zstd_quality(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"), fold_of(3) != 1)


def op4_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(_table(spark, sf_dir, "pages"), URL_RULES)


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"), fold_of(4) != 2)


def op6_host_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return host_rules(_table(spark, sf_dir, "documents")).drop("host_rate")


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(_table(spark, sf_dir, "documents"))


def op8_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licence_scan(_table(spark, sf_dir, "documents"))


def op9_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_table(spark, sf_dir, "documents"), shingle=3, percent=85, bands=20, rows=5)


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = decontaminate(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return out.withColumn("items_sha256", F.sha2(F.array_join("items", ","), 256)).drop("items")


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, label)


def op12_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_repeat_report(_table(spark, sf_dir, "documents"))


def op13_token_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment_report(_table(spark, sf_dir, "documents")).withColumnRenamed("groups", "groups_sha256")


QUERIES = {f.__name__: f for f in (
    op1_substring_dedup, op2_ppm, op3_zstd_quality, op4_url_rules, op5_toxicity, op6_host_rules, op7_mixing, op8_licence_scan, op9_near_dedup, op10_decontaminate,
    op11_hard_negatives, op12_suffix_dedup, op13_token_align)}

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
_ALNUM = (r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),"
          r" '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')")

#: SQL for the operators whose whole result it can say. The others (learnt scores, components, hashed
#: digests of cut texts, licence scores) are tested against brute-force versions.
ORACLE: dict[str, str] = {
    "op4_url_rules": r"""
WITH u AS (SELECT page_id, coalesce(url, '') AS url FROM pages),
t AS (SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS tail FROM u),
h AS (SELECT page_id, regexp_extract(tail, '^[^/?#]*') AS raw, tail FROM t),
p AS (SELECT page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
             regexp_extract(substr(tail, length(raw) + 1), '^[^?#]*') AS path FROM h),
r AS (SELECT *, CASE
    WHEN (host = 'www.example.com' OR ends_with(host, '.www.example.com')) AND starts_with(path, '/en/') THEN 'www.example.com/en/'
    WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/en/') THEN 'example.com/en/'
    WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/es/') THEN 'net/es/'
    WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/fr/') THEN 'net/fr/'
    WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/') THEN 'com/' END AS rule FROM p)
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('example.com/en/', 'net/es/', 'net/fr/') THEN 'block' ELSE 'allow' END AS verdict FROM r""",
    "op7_mixing": rf"""
WITH d AS (SELECT doc_id, source, len({_WORDS})::BIGINT AS size, md5('42:' || coalesce(doc_id::VARCHAR, '')) AS place FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS ss FROM d GROUP BY source),
n AS (SELECT source, ss, [5, 2, 1][(row_number() OVER (ORDER BY source COLLATE "binary" NULLS LAST) - 1) % 3 + 1] AS w FROM s),
o AS (SELECT *, row_number() OVER (ORDER BY 2.0 * ss / w, source NULLS LAST) AS k FROM n),
l AS (SELECT *, coalesce(sum(2 * ss) OVER (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE AS used,
             (sum(w) OVER (ORDER BY k ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE AS open,
             (sum(ss) OVER ())::DOUBLE * 150 / 100 AS budget FROM o),
f AS (SELECT min_by((budget - used) / open, k) AS level FROM l WHERE (budget - used) / open * w <= 2 * ss),
t AS (SELECT source, ss, CASE WHEN w * level > 2 * ss THEN (2 * ss)::DOUBLE ELSE w * level END AS target FROM n, f),
q AS (SELECT source, ss, target, CASE WHEN ss = 0 THEN 0 ELSE floor(target)::BIGINT // ss END AS whole FROM t),
x AS (SELECT d.*, q.ss, q.target, q.whole, floor(q.target)::BIGINT - q.whole * q.ss AS rest,
             coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY place, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS seen
      FROM d JOIN q ON d.source IS NOT DISTINCT FROM q.source)
SELECT doc_id, size, ss AS source_size, target, (whole * size + greatest(0, least(size, rest - seen)))::BIGINT AS taken FROM x""",
    "op10_decontaminate": rf"""
WITH i AS (SELECT item_id, {_ALNUM} AS w FROM benchmark),
g AS (SELECT DISTINCT item_id, array_to_string(w[a:a + 9], ' ') AS body, len(w[a:a + 9]) AS n
      FROM (SELECT item_id, w, unnest(range(1, greatest(1, len(w) - 9) + 1)) AS a FROM i WHERE len(w) > 0)),
d AS (SELECT doc_id, {_ALNUM} AS w FROM documents),
c AS (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS a FROM d),
z AS (SELECT DISTINCT n FROM g),
m AS (SELECT c.doc_id, c.a, z.n, array_to_string(c.w[c.a:c.a + z.n - 1], ' ') AS body FROM c, z WHERE c.a + z.n - 1 <= len(c.w)),
f AS (SELECT m.doc_id, m.a, m.n, g.item_id FROM m JOIN g USING (body, n)),
h AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(a, a + n)) AS p FROM f) GROUP BY doc_id),
t AS (SELECT doc_id, count(DISTINCT item_id) AS n_items,
             array_to_string(list_sort(list(DISTINCT coalesce(item_id::VARCHAR, ''))), ',') AS items FROM f GROUP BY doc_id)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN h USING (doc_id) LEFT JOIN t USING (doc_id)""",
    "op1_substring_dedup": rf"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
s AS (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS a FROM d WHERE len(w) >= 50),
k AS (SELECT doc_id, a, md5(array_to_string(w[a:a + 49], ' ')) AS h FROM s),
f AS (SELECT h, min(doc_id) AS lo FROM k GROUP BY h),
r AS (SELECT DISTINCT doc_id, unnest(range(a, a + 50)) AS p FROM k JOIN f USING (h) WHERE lo < doc_id),
g AS (SELECT doc_id, list(p) AS gone FROM r GROUP BY doc_id),
v AS (SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(len(gone), 0)::BIGINT AS n_removed,
             list_filter(w, lambda x, i: NOT list_contains(coalesce(gone, []), i)) AS kept FROM d LEFT JOIN g USING (doc_id))
SELECT doc_id, n_words, n_removed, sha256(array_to_string(kept, ' ')) AS kept_sha256 FROM v""",
    "op11_hard_negatives": r"""
WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
             list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q FROM embeddings
      WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same, list_dot_product(a.q, b.q)::BIGINT AS score
      FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0),
p AS (SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT p.anchor_id, positive_id, (row_number() OVER w)::INT AS rank, s.id AS negative_id, positive_score, s.score AS negative_score
FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same
WHERE 50 * positive_score <= 100 * s.score AND 100 * s.score <= 95 * positive_score
WINDOW w AS (PARTITION BY p.anchor_id, positive_id ORDER BY s.score DESC, s.id)
QUALIFY row_number() OVER w <= 3""",
}
