"""Queries of the training-data operators, with their SQL where SQL can say it."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm import (alignment, langid, licenses, minhash, mixing, neighbours, pieces, sharding, spelling,
                        suffix_dedup, token_count, url_filter, vector_dedup)
from strata.sources.tables import table

# The rules the URL query is asked to apply.
URL_RULES = (("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"),
             ("allow", "com/fr/"), ("block", "com/de/"))

# The phrases the license query counts, with their labels.
LICENSE_PHRASES = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What remains of all documents without repeated 100-byte strings."""
    return suffix_dedup.remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "_cut.*")


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words taken from every document so that sources reach their targets."""
    return mixing.mix(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken")


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 8 shards, equal texts together as far as counts stay even."""
    return sharding.shard(table(spark, sf_dir, "documents"))


def op5_token_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of all documents."""
    return token_count.count_tokens(table(spark, sf_dir, "documents"),
                                    public_tokenizers.path("word_bpe_49k.json"))


def op6_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of all documents' ids and decoded texts."""
    return pieces.encode(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op7_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents."""
    return minhash.near_duplicates(table(spark, sf_dir, "documents")).drop("text_key", "root")


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdicts on all pages.  A page shows the document whose number its url
    carries; that document's labels are the page's outcome: good when of
    quality and not toxic."""
    pages = table(spark, sf_dir, "pages")
    labels = table(spark, sf_dir, "labels")
    shown = pages.select("url", F.expr("try_cast(regexp_extract(url, '/([0-9]+)', 1) as bigint)").alias("shown"))
    good = F.when((F.col("quality") == 1) & (F.coalesce("toxic", F.lit(0)) == 0), 1).when(
        F.col("quality").isNotNull(), 0)
    outcomes = shown.join(labels.select(F.col("doc_id").alias("shown"), good.alias("good")), "shown").select("url", "good")
    return url_filter.filter_urls(pages, outcomes, URL_RULES).select(
        "page_id", "host", "path", "rule", "verdict", F.round("good_upper", 6).alias("good_upper"))


def op10_vector_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all embeddings."""
    return vector_dedup.near_vectors(table(spark, sf_dir, "embeddings"))


def op3_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest of every row whose vec_id is divisible by 20."""
    return neighbours.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of all documents; a quarter of them is held out."""
    docs = table(spark, sf_dir, "documents")
    model = langid.train(docs, langid.learnable(F.col("doc_id")))
    return langid.identify(docs, model).select(
        "doc_id", langid.held_out(F.col("doc_id")).alias("held_out"),
        F.col("_language.lang_pred").alias("lang_pred"), F.col("_language.score").alias("score"))


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near words of all documents' words, with one slip in 199 runs."""
    runs = spelling.word_runs(table(spark, sf_dir, "documents"), slip_every=199)
    return spelling.group_variants(spelling.count_words(runs, min_length=6, min_count=5))


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents' tokens under two tokenizers, linked by overlapping bytes."""
    return alignment.align(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
                           public_tokenizers.path("piece_bpe_32k.model"))


def op13_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License detections of all documents."""
    return licenses.scan(table(spark, sf_dir, "documents"), LICENSE_PHRASES)


QUERIES = {f.__name__: f for f in (op1_suffix_dedup, op2_mixing, op3_neighbours, op4_sharding, op5_token_count, op6_sentencepiece, op7_minhash, op8_language, op9_url_filter,
                                 op10_vector_dedup, op11_spelling, op12_alignment, op13_licenses)}

# Components in SQL: everything reachable from a row over the links of ``e``.
REACH = """, sides AS (SELECT x, y FROM e UNION ALL SELECT y, x FROM e),
r(x, y) AS (SELECT x, y FROM sides UNION SELECT r.x, sides.y FROM r JOIN sides ON r.y = sides.x),
c AS (SELECT x, min(y) AS y FROM r GROUP BY x)"""

ORACLE_SQL: dict[str, str] = {
    "op7_minhash": r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(ws[i:i + 4], ' ') AS g
      FROM (SELECT doc_id, ws, unnest(generate_series(1, greatest(1, len(ws) - 4))) AS i FROM w WHERE len(ws) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS both_n FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id
      GROUP BY 1, 2),
e AS (SELECT x, y FROM p JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y
      WHERE 100 * both_n >= 75 * (a.n + b.n - both_n))""" + REACH + """
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, least(d.doc_id, coalesce(c.y, d.doc_id)) AS component_id,
       d.doc_id = least(d.doc_id, coalesce(c.y, d.doc_id)) AS kept
FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN c ON c.x = d.doc_id""",
    "op9_url_filter": r"""
WITH p AS (
  SELECT page_id, coalesce(translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1),
                                     'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
         coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path,
         TRY_CAST(regexp_extract(url, '/([0-9]+)', 1) AS BIGINT) AS shown FROM pages),
l AS (SELECT doc_id, CASE WHEN quality = 1 AND coalesce(toxic, 0) = 0 THEN 1 WHEN quality IS NOT NULL THEN 0 END AS good
      FROM labels),
b AS (SELECT DISTINCT host, regexp_replace(host, '^.*@|:[0-9]*$', '', 'g') AS bare FROM p),
b2 AS (SELECT host, bare, regexp_matches(bare, '""" + url_filter.ADDRESS + r"""') AS address, array_to_string(string_split(bare, '.')[-2:], '.') AS two,
              array_to_string(string_split(bare, '.')[-3:], '.') AS three FROM b),
names AS (SELECT host, CASE WHEN address THEN bare WHEN two IN (""" + ", ".join(f"'{x}'" for x in url_filter.SUFFIXES) + r""") THEN three ELSE two END AS domain,
                 CASE WHEN address THEN '(address)' WHEN three <> two AND two IN (""" + ", ".join(f"'{x}'" for x in url_filter.SUFFIXES) + r""") THEN two
                      ELSE string_split(bare, '.')[-1] END AS suffix FROM b2),
h AS (SELECT host, any_value(domain) AS domain, any_value(suffix) AS suffix, count(good)::DOUBLE AS n, coalesce(sum(good), 0)::DOUBLE AS k
      FROM p JOIN names USING (host) LEFT JOIN l ON l.doc_id = shown GROUP BY host),
d AS (SELECT domain, suffix, sum(n) AS n, sum(k) AS k FROM h GROUP BY 1, 2),
s AS (SELECT suffix, sum(n) AS n, sum(k) AS k FROM d GROUP BY 1),
s1 AS (SELECT s.*, (SELECT (sum(k) + 1) / (sum(n) + 2) FROM h) AS m FROM s),
sf AS (SELECT sum(n * (k / n - m) ** 2) / sum(n) AS t, sum(m * (1 - m)) / sum(n) AS z,
              sum(n * m * (1 - m)) / sum(n) AS b FROM s1 WHERE n >= 2),
s2 AS (SELECT *, CASE WHEN t IS NULL THEN 1 WHEN t > z THEN least(1000, greatest(1, b / (t - z) - 1)) ELSE 1000 END AS c
       FROM s1, sf),
sr AS (SELECT suffix, (c * m + k) / (c + n) AS rate FROM s2),
d1 AS (SELECT d.*, sr.rate AS m FROM d JOIN sr USING (suffix)),
df AS (SELECT sum(n * (k / n - m) ** 2) / sum(n) AS t, sum(m * (1 - m)) / sum(n) AS z,
              sum(n * m * (1 - m)) / sum(n) AS b FROM d1 WHERE n >= 2),
d2 AS (SELECT *, CASE WHEN t IS NULL THEN 1 WHEN t > z THEN least(1000, greatest(1, b / (t - z) - 1)) ELSE 1000 END AS c
       FROM d1, df),
dr AS (SELECT domain, (c * m + k) / (c + n) AS rate FROM d2),
h1 AS (SELECT h.*, dr.rate AS m FROM h JOIN dr USING (domain)),
hf AS (SELECT sum(n * (k / n - m) ** 2) / sum(n) AS t, sum(m * (1 - m)) / sum(n) AS z,
              sum(n * m * (1 - m)) / sum(n) AS b FROM h1 WHERE n >= 2),
h2 AS (SELECT *, CASE WHEN t IS NULL THEN 1 WHEN t > z THEN least(1000, greatest(1, b / (t - z) - 1)) ELSE 1000 END AS c
       FROM h1, hf),
h3 AS (SELECT host, c * m + k AS a, c * (1 - m) + n - k AS b FROM h2),
hr AS (SELECT host, a / (a + b) + 1.645 * sqrt(a * b / ((a + b) ** 2 * (a + b + 1))) AS upper FROM h3),
j AS (SELECT page_id, p.host, path, upper, CASE
  WHEN (p.host = 'example.org' OR p.host LIKE '%.example.org') AND starts_with(path, '/en/1') THEN 'block example.org/en/1'
  WHEN (p.host = 'example.org' OR p.host LIKE '%.example.org') AND starts_with(path, '/es/') THEN 'block example.org/es/'
  WHEN (p.host = 'com' OR p.host LIKE '%.com') AND starts_with(path, '/fr/') THEN 'allow com/fr/'
  WHEN (p.host = 'com' OR p.host LIKE '%.com') AND starts_with(path, '/de/') THEN 'block com/de/'
  WHEN (p.host = 'org' OR p.host LIKE '%.org') AND starts_with(path, '/') THEN 'allow org/' END AS hit
  FROM p JOIN hr ON hr.host = p.host)
SELECT page_id, host, path, string_split(hit, ' ')[2] AS rule,
       coalesce(string_split(hit, ' ')[1], CASE WHEN upper < 0.5 THEN 'block' ELSE 'allow' END) AS verdict,
       round(upper, 6) AS good_upper
FROM j""",
    "op10_vector_dedup": """
WITH RECURSIVE v AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS x, sqrt(list_sum(list_transform(embedding::DOUBLE[], lambda u: u * u))) AS len
  FROM embeddings WHERE embedding IS NOT NULL AND label IS NOT NULL
    AND len(list_filter(embedding, lambda u: u IS NULL OR NOT isfinite(u))) = 0),
e AS (SELECT a.vec_id AS x, b.vec_id AS y FROM v a JOIN v b ON a.label = b.label AND a.vec_id < b.vec_id
      AND len(a.x) = len(b.x) WHERE a.len > 0 AND b.len > 0
      AND list_inner_product(a.x, b.x) / (a.len * b.len) >= 0.98)""" + REACH + """,
l AS (SELECT x, count(*) AS n FROM sides GROUP BY x)
SELECT vec_id, coalesce(l.n, 0) AS n_links, least(vec_id, coalesce(c.y, vec_id)) AS component_id,
       vec_id = least(vec_id, coalesce(c.y, vec_id)) AS kept
FROM embeddings LEFT JOIN l ON l.x = vec_id LEFT JOIN c ON c.x = vec_id""",
    "op11_spelling": spelling.ORACLE_SQL,
    "op13_licenses": licenses.oracle(LICENSE_PHRASES),
}
