"""The operators of this package over the given tables.

``QUERIES`` maps each name to ``(spark, sf_dir) -> DataFrame``; ``SQL`` holds
the DuckDB SQL of those it can express.  Each query is a thin reading of its
operator's result.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelsight.llm import (bpe, html_extract, infill, line_quality, mixing, prefix_forest, secret_scan, sharding, shingle_join, simhash,
                           spelling, toxicity, url_reputation)
from reelsight.llm.tables import read

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """4-word shingles, links at 4 or fewer differing bits."""
    near = simhash.near_duplicates(read(spark, sf_dir, "documents"), shingle=4, max_bits=4)
    return near.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@query
def op2_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return html_extract.extract(read(spark, sf_dir, "pages"))


@query
def op3_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every candidate in whole texts with the forest's verdict."""
    forest = secret_scan.train(secret_scan.labelled_findings(spark))
    return secret_scan.findings(read(spark, sf_dir, "documents"), forest)


@query
def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts, and cross-document line frequency with sources as hosts."""
    return line_quality.judge(read(spark, sf_dir, "documents"))


SQL["op4_quality"] = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, source, coalesce(text, '') AS t, text IS NULL AS no_text
           FROM documents),
w AS (SELECT rid, unnest(ws) AS word, generate_subscripts(ws, 1) AS i
      FROM (SELECT rid, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws FROM d)),
nxt AS (SELECT rid, i, word, lead(word, 1) OVER o AS word2, lead(word, 2) OVER o AS word3
        FROM w WINDOW o AS (PARTITION BY rid ORDER BY i)),
win AS (SELECT rid, i, count(*) OVER (PARTITION BY rid, word, word2, word3) AS n FROM nxt WHERE word3 IS NOT NULL),
rep AS (SELECT rid, count(DISTINCT i + k) AS n_repeat_words FROM win, (VALUES (0), (1), (2)) AS o(k)
        WHERE n >= 2 GROUP BY rid),
wc AS (SELECT rid, count(*) AS n_words, sum(length(word)) AS word_chars FROM w GROUP BY rid),
l AS (SELECT rid, unnest(string_split(t, chr(10))) AS line FROM d),
ln AS (SELECT rid, line, trim(regexp_replace(lower(line), '[\t-\r\p{Z}]+', ' ', 'g')) AS norm FROM l WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
lh AS (SELECT rid, line, length(norm) AS lw, ('0x' || substr(md5(norm), 1, 15))::BIGINT AS h FROM ln),
dup AS (SELECT rid, count(*) - count(DISTINCT line) AS n_dup_lines FROM lh GROUP BY rid),
f AS (SELECT d.rid, d.doc_id, d.source, ('0x' || substr(md5(t), 1, 15))::BIGINT AS th, coalesce(n_words, 0) AS n_words,
             coalesce(word_chars, 0)::BIGINT AS word_chars,
             length(t) - length(translate(t, '#*$%&|<>', '')) AS n_symbols,
             coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
             coalesce(n_words, 0) < 50 OR 100 * coalesce(n_repeat_words, 0) > 50 * coalesce(n_words, 0) AS base_failed
      FROM d LEFT JOIN wc USING (rid) LEFT JOIN rep USING (rid) LEFT JOIN dup USING (rid)),
-- a line counts once for each distinct document, whose family is the set of its lines
one AS (SELECT min(rid) AS rid FROM d GROUP BY doc_id, source, t, no_text),
dl AS (SELECT DISTINCT rid, h FROM lh WHERE lw > 0 AND rid IN (SELECT rid FROM one)),
fam AS (SELECT rid, md5(string_agg(h::VARCHAR, ',' ORDER BY h)) AS family FROM dl GROUP BY rid),
cnt AS (SELECT source, h, family, count(*) AS n FROM dl JOIN fam USING (rid) JOIN d USING (rid) GROUP BY source, h, family),
bad AS (SELECT source, h FROM cnt GROUP BY source, h HAVING sum(n) > 20 AND max(n) < 0.5::DOUBLE * sum(n)),
whole AS (SELECT rid, sum(lw) AS whole FROM lh GROUP BY rid),
hit AS (SELECT lh.rid, d.source, lh.h, lh.lw FROM lh JOIN d USING (rid)
        JOIN bad ON bad.h = lh.h AND bad.source IS NOT DISTINCT FROM d.source),
cut AS (SELECT rid, sum(lw) AS n_cut, max(lw) AS longest FROM hit GROUP BY rid),
-- near copies that deplete one another: the first that holds a removed line stays whole
copies AS (SELECT cut.rid, f.source, row_number() OVER (ORDER BY f.doc_id IS NULL, f.doc_id, f.th) AS place,
                  f.doc_id, f.th, f.source AS host
           FROM cut JOIN whole USING (rid) JOIN f USING (rid)
           WHERE NOT base_failed AND whole - n_cut < 0.3::DOUBLE * whole AND n_cut > longest
             AND n_cut - longest >= 0.5::DOUBLE * (whole - longest)),
firsts AS (SELECT min(c.place) AS place FROM (SELECT DISTINCT rid, h FROM hit) x JOIN copies c USING (rid) GROUP BY c.source, x.h),
spared AS (SELECT DISTINCT c.doc_id, c.th, c.host FROM copies c JOIN firsts USING (place)),
lost AS (SELECT f.rid, n_cut FROM cut JOIN f USING (rid) WHERE NOT EXISTS (
           SELECT 1 FROM spared s WHERE s.doc_id IS NOT DISTINCT FROM f.doc_id AND s.th = f.th AND s.host IS NOT DISTINCT FROM f.source))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, coalesce(n_cut, 0)::BIGINT AS n_cut_chars, base_failed,
       NOT base_failed AND coalesce(whole, 0) - coalesce(n_cut, 0) >= 0.3::DOUBLE * coalesce(whole, 0) AS kept
FROM f LEFT JOIN lost USING (rid) LEFT JOIN whole USING (rid)
"""


@query
def op5_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest rows of every vector whose id is divisible by 20."""
    vectors = read(spark, sf_dir, "embeddings")
    return prefix_forest.search(vectors, vectors.where(F.col("vec_id") % 20 == 0), k=20)


@query
def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole text encoded and decoded again."""
    return bpe.digests(read(spark, sf_dir, "documents"),
                       public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


@query
def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents mixed to 150 % of their words, weights 5, 2, 1."""
    return mixing.plan(read(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


SQL["op7_mixing"] = r"""
WITH RECURSIVE d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
                            md5(coalesce(doc_id::VARCHAR, 'null') || '|mix') AS h FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size, 2 * sum(size)::BIGINT AS cap,
             row_number() OVER (ORDER BY source NULLS LAST) - 1 AS idx FROM d GROUP BY source),
w AS (SELECT *, CASE idx % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight FROM s),
lv AS (SELECT 0 AS round, sum(source_size)::DOUBLE * 1.5::DOUBLE / sum(weight)::DOUBLE AS level, -1::BIGINT AS capped FROM w
       UNION ALL
       SELECT round + 1, (SELECT (sum(source_size)::DOUBLE * 1.5::DOUBLE - coalesce(sum(cap) FILTER (cap <= lv.level * weight), 0)::DOUBLE)
                          / sum(weight) FILTER (cap > lv.level * weight)::DOUBLE FROM w),
              (SELECT count(*) FILTER (cap <= lv.level * weight) FROM w)
       FROM lv WHERE round < 100 AND capped <> (SELECT count(*) FILTER (cap <= lv.level * weight) FROM w)),
g AS (SELECT source, source_size, idx, least(cap::DOUBLE, (SELECT arg_max(level, round) FROM lv) * weight) AS target FROM w),
q AS (SELECT d.doc_id, d.size, g.source_size, g.target, g.idx, row_number() OVER () AS rid,
             sum(d.size) OVER (PARTITION BY d.source ORDER BY h, d.doc_id, d.size ROWS UNBOUNDED PRECEDING) AS cum
      FROM d JOIN g ON d.source IS NOT DISTINCT FROM g.source),
c AS (SELECT rid, size, idx, source_size * k + cum AS c, (source_size * k + cum)::DOUBLE / target AS finish
      FROM q, (VALUES (0), (1)) AS t(k) WHERE size > 0 AND target > 0),
t AS (SELECT rid, size, sum(size) OVER (ORDER BY finish, idx, c ROWS UNBOUNDED PRECEDING) AS upto FROM c),
k AS (SELECT rid, sum(size) AS taken FROM t WHERE upto <= (SELECT 1.5::DOUBLE * sum(source_size)::DOUBLE FROM g) GROUP BY rid)
SELECT doc_id, size, source_size, target, coalesce(taken, 0)::BIGINT AS taken FROM q LEFT JOIN k USING (rid)
"""


@query
def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents on 16 shards; slack 0, so that the row counts differ by
    one at most."""
    text = F.coalesce(F.col("text"), F.lit(""))
    keep = [F.col("doc_id").cast("long").alias("doc_id"), (F.octet_length(text) + 1).cast("long").alias("size"),
            F.crc32(F.encode(text, "UTF-8")).alias("text_crc32")]
    placed = sharding.assign(read(spark, sf_dir, "documents"), sharding.Ring(shards=16), keep=keep)
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"))


@query
def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expected severity of every document; grades from the toxic labels."""
    docs = read(spark, sf_dir, "documents")
    labels = read(spark, sf_dir, "labels").select("doc_id", F.col("toxic").alias("grade"))
    return toxicity.score(docs, toxicity.model(docs, labels))


URL_RULES = {"com/": "allow", "example.com/en/": "block", "www.example.com/en/": "allow", "net/es/": "block",
             "net/fr/": "block"}


@query
def op9_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's url by the rules, else by its host's reputation from the
    labels of the documents that the pages show."""
    pages = read(spark, sf_dir, "pages")
    outcomes = url_reputation.labelled(pages, read(spark, sf_dir, "labels"))
    return url_reputation.judge(pages, outcomes, URL_RULES).select("page_id", "host", "path", "rule", "verdict")


SQL["op9_urls"] = r"""
WITH p AS (SELECT page_id, translate(regexp_extract(coalesce(url, ''), '://([^/?#]*)', 1),
                                     'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                  regexp_extract(coalesce(url, ''), '://[^/?#]*([^?#]*)', 1) AS path FROM pages),
known AS (SELECT doc_id, max(coalesce(quality = 0, false) OR coalesce(toxic = 1, false)) AS bad FROM labels
          WHERE doc_id IS NOT NULL GROUP BY doc_id),
o AS (SELECT host, bad FROM p LEFT JOIN known
      ON known.doc_id = try_cast(nullif(regexp_extract(path, '/([0-9]{1,18})', 1), '') AS BIGINT)),
hn AS (SELECT host, regexp_replace(regexp_replace(host, '^[^@]*@', ''), ':[0-9]*$', '') AS name,
              count(bad)::DOUBLE AS n, (count(*) FILTER (bad))::DOUBLE AS y FROM o GROUP BY host),
h0 AS (SELECT *, regexp_extract(name, '([^.]*\.)?[^.]*$') AS two FROM hn),
h AS (SELECT host, n, y,
             CASE WHEN regexp_matches(name, '^[0-9.]+$|^\[') THEN name
                  WHEN regexp_matches(two, '^(ac|co|com|edu|gob|gov|go|gv|ltd|mil|ne|net|nhs|nom|or|org|plc|sch)\.[a-z]{2}$')
                    OR two IN ('github.io', 'gitlab.io', 'blogspot.com', 'wordpress.com', 'herokuapp.com', 'netlify.app', 'pages.dev')
                  THEN regexp_extract(name, '([^.]*\.)?([^.]*\.)?[^.]*$') ELSE two END AS domain,
             CASE WHEN regexp_matches(name, '^[0-9.]+$|^\[') THEN '[address]'
                  WHEN regexp_matches(two, '^(ac|co|com|edu|gob|gov|go|gv|ltd|mil|ne|net|nhs|nom|or|org|plc|sch)\.[a-z]{2}$')
                    OR two IN ('github.io', 'gitlab.io', 'blogspot.com', 'wordpress.com', 'herokuapp.com', 'netlify.app', 'pages.dev')
                  THEN two ELSE regexp_extract(name, '[^.]*$') END AS suffix FROM h0),
d AS (SELECT domain, suffix, sum(n) AS n, sum(y) AS y FROM h GROUP BY ALL),
s AS (SELECT suffix, sum(n) AS n, sum(y) AS y FROM d GROUP BY ALL),
g AS (SELECT sum(n) AS gn, sum(y) AS gy FROM s),
s1 AS (SELECT s.*, CASE WHEN gn > n THEN (gy - y) / (gn - n) WHEN gn > 0 THEN gy / gn ELSE 0 END AS m FROM s, g),
ks AS (SELECT CASE WHEN count(*) > 1 AND sum(n) - sum(n * n) / sum(n) > 0
                    AND sum(n * (y / n - m) ** 2) > (count(*) - 1) * (sum(y) / sum(n)) * (1 - sum(y) / sum(n))
               THEN least(200, greatest(2, (sum(y) / sum(n)) * (1 - sum(y) / sum(n)) * (sum(n) - sum(n * n) / sum(n))
                    / (sum(n * (y / n - m) ** 2) - (count(*) - 1) * (sum(y) / sum(n)) * (1 - sum(y) / sum(n))) - 1))
               ELSE 200 END AS k FROM s1 WHERE n > 0),
d1 AS (SELECT d.*, (s1.y - d.y + ks.k * s1.m) / (s1.n - d.n + ks.k) AS m FROM d JOIN s1 USING (suffix), ks),
kd AS (SELECT CASE WHEN count(*) > 1 AND sum(n) - sum(n * n) / sum(n) > 0
                    AND sum(n * (y / n - m) ** 2) > (count(*) - 1) * (sum(y) / sum(n)) * (1 - sum(y) / sum(n))
               THEN least(200, greatest(2, (sum(y) / sum(n)) * (1 - sum(y) / sum(n)) * (sum(n) - sum(n * n) / sum(n))
                    / (sum(n * (y / n - m) ** 2) - (count(*) - 1) * (sum(y) / sum(n)) * (1 - sum(y) / sum(n))) - 1))
               ELSE 200 END AS k FROM d1 WHERE n > 0),
h1 AS (SELECT h.*, (d1.y - h.y + kd.k * d1.m) / (d1.n - h.n + kd.k) AS m FROM h JOIN d1 USING (domain), kd),
kh AS (SELECT CASE WHEN count(*) > 1 AND sum(n) - sum(n * n) / sum(n) > 0
                    AND sum(n * (y / n - m) ** 2) > (count(*) - 1) * (sum(y) / sum(n)) * (1 - sum(y) / sum(n))
               THEN least(200, greatest(2, (sum(y) / sum(n)) * (1 - sum(y) / sum(n)) * (sum(n) - sum(n * n) / sum(n))
                    / (sum(n * (y / n - m) ** 2) - (count(*) - 1) * (sum(y) / sum(n)) * (1 - sum(y) / sum(n))) - 1))
               ELSE 200 END AS k FROM h1 WHERE n > 0),
h2 AS (SELECT host, (y + k * m) / (n + k) AS mean, n + k AS total FROM h1, kh),
b AS (SELECT host, mean - 2 * sqrt(mean * (1 - mean) / (total + 1)) AS bound FROM h2),
r AS (SELECT p.*, CASE
        WHEN (host = 'www.example.com' OR suffix(host, '.www.example.com')) AND starts_with(path, '/en/') THEN 'www.example.com/en/'
        WHEN (host = 'example.com' OR suffix(host, '.example.com')) AND starts_with(path, '/en/') THEN 'example.com/en/'
        WHEN (host = 'net' OR suffix(host, '.net')) AND starts_with(path, '/es/') THEN 'net/es/'
        WHEN (host = 'net' OR suffix(host, '.net')) AND starts_with(path, '/fr/') THEN 'net/fr/'
        WHEN (host = 'com' OR suffix(host, '.com')) AND starts_with(path, '/') THEN 'com/' END AS rule FROM p)
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('com/', 'www.example.com/en/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
            WHEN bound > 0.5 THEN 'block' ELSE 'allow' END AS verdict
FROM r LEFT JOIN b USING (host)
"""


@query
def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every word of all documents with its near words and its form."""
    return spelling.variants(read(spark, sf_dir, "documents"))


@query
def op12_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents linked at a Jaccard similarity of 0.9 of their 3-word
    shingles."""
    return shingle_join.near_duplicates(read(spark, sf_dir, "documents"))


@query
def op13_infill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole text cut, arranged and restored."""
    return infill.digests(read(spark, sf_dir, "documents"))


SQL["op13_infill"] = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256('1:' || coalesce(doc_id::VARCHAR, 'null')) AS k FROM documents),
h AS (SELECT doc_id, t, length(t) AS n, ('0x' || substr(k, 1, 8))::BIGINT AS h1, ('0x' || substr(k, 9, 8))::BIGINT AS h2,
             ('0x' || substr(k, 17, 8))::BIGINT AS h3, ('0x' || substr(k, 25, 8))::BIGINT AS h4 FROM d),
c AS (SELECT doc_id, t, n, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
             CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain'
                  WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM h),
p AS (SELECT *, substr(t, 1, a) AS pre, substr(t, a + 1, b - a) AS mid, substr(t, b + 1, n - b) AS suf FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid
                        ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256,
       sha256(t) AS restored_sha256 FROM p
"""
