"""The operators' queries over the supplied tables, and their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartlane.llm import (
    bpe,
    decontaminate,
    divergence,
    jaccard,
    lines,
    quality,
    ranked,
    secrets,
    sharding,
    tokens,
    toxicity,
    urls,
    vectors,
)
from cartlane.llm.shared import read

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(make: Query) -> Query:
    QUERIES[make.__name__] = make
    return make


@query
def op2_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    return secrets.scan_secrets(read(spark, folder, "documents"))


@query
def op3_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return bpe.token_digests(read(spark, folder, "documents"), path, public_tokenizers.PATTERN)


@query
def op6_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    found = decontaminate.find_items(read(spark, folder, "documents").select("doc_id", "text"), read(spark, folder, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


ORACLES["op6_decontaminate"] = """
WITH doc_words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
item_words AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS win
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM item_words WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM windows),
places AS (
  SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS win
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM doc_words, sizes)),
hits AS (SELECT doc_id, item_id, p.n, i FROM places p JOIN windows q ON p.win = q.win AND p.n = q.n),
hit_words AS (SELECT doc_id, count(DISTINCT k) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS k FROM hits) GROUP BY 1),
hit_items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM hits) GROUP BY 1)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc_words LEFT JOIN hit_words USING (doc_id) LEFT JOIN hit_items USING (doc_id)
"""


@query
def op9_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return lines.line_digests(read(spark, folder, "documents"))


ORACLES["op9_line_dedup"] = """
WITH cut AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
    generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i FROM documents),
keyed AS (
  SELECT doc_id, line, i, translate(regexp_replace(line, '^[ \\t\\n\\x0B\\f\\r]+|[ \\t\\n\\x0B\\f\\r]+$', '', 'g'),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM cut),
repeated AS (
  SELECT key, max(doc_id) AS stays FROM keyed WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
marked AS (SELECT doc_id, line, i, stays IS NOT NULL AND stays <> doc_id AS gone FROM keyed LEFT JOIN repeated USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""


@query
def op1_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    documents = read(spark, folder, "documents").select("doc_id", "text", "lang")
    model = toxicity.train(documents, read(spark, folder, "labels"))
    scored = toxicity.score_documents(documents, model)
    return scored.select(
        "doc_id",
        toxicity.held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
        "toxic",
    )


@query
def op5_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    """The tables hold no outcomes of pages; the label of the same number stands for one."""
    bad = ((F.col("quality") == 0) | (F.col("toxic") == 1)).cast("int")
    outcomes = read(spark, folder, "labels").select(F.col("doc_id").alias("id"), bad.alias("bad"))
    return urls.judge_pages(read(spark, folder, "pages"), outcomes)


_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_TWO = "('co.uk', 'org.uk', 'ac.uk', 'com.au', 'co.jp', 'com.br', 'co.in', 'co.nz')"
_STRENGTH = """(SELECT coalesce(least(greatest(CASE WHEN spread - noise > 0 THEN (chance - spread) / (spread - noise)
    ELSE 1000.0 END, 1.0), 1000.0), 1.0) FROM (
    SELECT sum((bad / n - m) * (bad / n - m)) AS spread, sum(m * (1 - m)) AS chance, sum(m * (1 - m) / n) AS noise
    FROM {0} WHERE n >= 2))"""

ORACLES["op5_url_filter"] = f"""
WITH parts AS (
  SELECT page_id, {_LOWER.format("coalesce(regexp_extract(url, '^(?s).*?://([^/?#]*)([^?#]*)', 1), '')")} AS host,
    coalesce(regexp_extract(url, '^(?s).*?://([^/?#]*)([^?#]*)', 2), '') AS path FROM pages),
known AS (
  SELECT doc_id AS page_id, max((quality = 0 OR toxic = 1)::INT) AS bad FROM labels
  WHERE (quality = 0 OR toxic = 1) IS NOT NULL GROUP BY 1),
host_counts AS (SELECT host, count(*) AS n, sum(bad) AS bad FROM parts JOIN known USING (page_id) GROUP BY 1),
hosts AS (
  SELECT host, coalesce(n, 0)::DOUBLE AS n, coalesce(bad, 0)::DOUBLE AS bad,
    regexp_extract(host, '([^.]+\\.[^.]+)$', 1) AS two, regexp_extract(host, '([^.]+\\.[^.]+\\.[^.]+)$', 1) AS three
  FROM (SELECT DISTINCT host FROM parts) LEFT JOIN host_counts USING (host)),
counted AS (
  SELECT host, n, bad, CASE WHEN two IN {_TWO} THEN two ELSE regexp_extract(host, '([^.]*)$', 1) END AS suffix,
    CASE WHEN two IN {_TWO} AND three <> '' THEN three WHEN two = '' THEN host ELSE two END AS domain FROM hosts),
d0 AS (SELECT suffix, domain, sum(n) AS n, sum(bad) AS bad FROM counted GROUP BY 1, 2),
s0 AS (SELECT suffix, sum(n) AS n, sum(bad) AS bad FROM d0 GROUP BY 1),
s1 AS (SELECT s0.*, (SELECT (sum(bad) + 1) / (sum(n) + 2) FROM s0) AS m FROM s0),
s2 AS (SELECT suffix, (bad + k * m) / (n + k) AS mean FROM (SELECT *, {_STRENGTH.format("s1")} AS k FROM s1)),
d1 AS (SELECT d0.*, s2.mean AS m FROM d0 JOIN s2 USING (suffix)),
d2 AS (SELECT domain, (bad + k * m) / (n + k) AS mean FROM (SELECT *, {_STRENGTH.format("d1")} AS k FROM d1)),
h1 AS (SELECT counted.*, d2.mean AS m FROM counted JOIN d2 USING (domain)),
h2 AS (SELECT host, bad + k * m AS a, n + k AS t FROM (SELECT *, {_STRENGTH.format("h1")} AS k FROM h1)),
judged AS (
  SELECT host, CASE WHEN a / t - 1.645 * sqrt(a * (t - a) / (t * t * (t + 1))) >= 0.5 THEN 'block' ELSE 'allow' END AS learned
  FROM h2),
ruled AS (
  SELECT *, CASE
    WHEN (host = 'example.net' OR host LIKE '%.example.net') AND starts_with(path, '/en/') THEN 'example.net/en/'
    WHEN (host = 'example.com' OR host LIKE '%.example.com') AND starts_with(path, '/de/') THEN 'example.com/de/'
    WHEN (host = 'org' OR host LIKE '%.org') AND starts_with(path, '/fr/') THEN 'org/fr/'
    WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/') THEN 'net/' END AS rule FROM parts)
SELECT page_id, ruled.host, path, rule, CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block'
  WHEN rule IS NOT NULL THEN 'allow' ELSE learned END AS verdict
FROM ruled LEFT JOIN judged USING (host)
"""


@query
def op10_sharding(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.shard_documents(read(spark, folder, "documents"))


@query
def op8_quality(spark: SparkSession, folder: str) -> DataFrame:
    return quality.classify(read(spark, folder, "documents"), read(spark, folder, "labels"))


@query
def op7_ngram_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard.components(read(spark, folder, "documents"))


ORACLES["op7_ngram_join"] = """
WITH RECURSIVE doc_words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 2], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, 1) + 1)) AS i FROM doc_words WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY 1),
shared_counts AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS common FROM shingles x JOIN shingles y ON x.s = y.s AND x.doc_id <> y.doc_id
  GROUP BY 1, 2),
links AS (
  SELECT a, b FROM shared_counts JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b
  WHERE 100 * common >= 90 * (p.n + q.n - common)),
reach(doc_id, other) AS (
  SELECT doc_id, doc_id FROM documents UNION SELECT r.doc_id, l.b FROM reach r JOIN links l ON r.other = l.a)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, min(other) AS component_id
FROM reach LEFT JOIN sizes USING (doc_id) GROUP BY doc_id, n
"""


@query
def op4_vector_search(spark: SparkSession, folder: str) -> DataFrame:
    return vectors.search_every(read(spark, folder, "embeddings"))


@query
def op11_source_divergence(spark: SparkSession, folder: str) -> DataFrame:
    return divergence.source_divergence(read(spark, folder, "documents"))


_DIVERGENCE = "({0}.p - {1}) * ({0}.p - {1}) // ({0}.p + {1})"

ORACLES["op11_source_divergence"] = f"""
WITH docs AS (
  SELECT row_number() OVER () AS k, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    {_LOWER.format("coalesce(text, '')")} AS text FROM documents),
words AS (
  SELECT k, lang, source, unnest(regexp_extract_all(text, '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM docs),
kept AS (SELECT lang, term, count(*) AS total FROM words GROUP BY 1, 2 HAVING count(DISTINCT k) >= 10),
langs AS (SELECT lang, sum(total) AS n, count(*) AS v FROM kept GROUP BY 1),
own AS (SELECT lang, source, term, count(*) AS n FROM words JOIN kept USING (lang, term) GROUP BY 1, 2, 3),
sizes AS (
  SELECT lang, source, coalesce(sum(n), 0) AS n FROM (SELECT DISTINCT lang, source FROM docs)
  LEFT JOIN own USING (lang, source) GROUP BY 1, 2),
shares AS (
  SELECT lang, s.source, term, coalesce(o.n, 0) AS n,
    1 + 1000000000::HUGEINT * (coalesce(o.n, 0) + 2)::HUGEINT // (s.n + 2 * l.v)::HUGEINT AS p,
    1 + 1000000000::HUGEINT * (k.total + 2)::HUGEINT // (l.n + 2 * l.v)::HUGEINT AS q
  FROM sizes s JOIN langs l USING (lang) JOIN kept k USING (lang) LEFT JOIN own o USING (lang, source, term)),
sums AS (
  SELECT x.lang, x.source, y.source AS item, sum({_DIVERGENCE.format("x", "y.p")}) AS value
  FROM shares x JOIN shares y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source GROUP BY 1, 2, 3),
pairs AS (
  SELECT x.lang, x.source, y.source AS item, coalesce(value, 0) AS value
  FROM sizes x JOIN sizes y ON x.lang = y.lang AND x.source <> y.source
  LEFT JOIN sums ON sums.lang = x.lang AND sums.source = x.source AND sums.item = y.source),
parts AS (
  SELECT lang, source, 'pair' AS part, item, value FROM pairs
  UNION ALL
  SELECT lang, source, 'term', term, {_DIVERGENCE.format("shares", "q")} FROM shares WHERE n > 0 AND p > q),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM parts)
SELECT lang, source, part, item, value::BIGINT AS value, rank::INT AS rank FROM ranked WHERE part = 'pair' OR rank <= 10
"""


@query
def op12_ranked_search(spark: SparkSession, folder: str) -> DataFrame:
    return ranked.best_documents(read(spark, folder, "documents"), read(spark, folder, "benchmark"))


_TERMS = f"unnest(regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+'))"

ORACLES["op12_ranked_search"] = f"""
WITH words AS (SELECT k, doc_id, {_TERMS} AS term FROM (SELECT row_number() OVER () AS k, doc_id, text FROM documents)),
asked AS (SELECT DISTINCT k, item_id, {_TERMS} AS term FROM (SELECT row_number() OVER () AS k, item_id, text FROM benchmark)),
lengths AS (SELECT k, doc_id, count(*) AS n FROM words GROUP BY 1, 2),
total AS (SELECT count(*) AS docs, sum(n)::BIGINT AS words FROM lengths),
tfs AS (SELECT k, doc_id, term, count(*) AS tf FROM words WHERE term IN (SELECT term FROM asked) GROUP BY 1, 2, 3),
weights AS (
  SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT AS w
  FROM (SELECT term, count(*) AS df FROM tfs GROUP BY 1), total),
norms AS (SELECT k, 10 + (90 * n * docs) // words AS m FROM lengths, total),
scores AS (
  SELECT asked.k, item_id, doc_id, tfs.k AS row, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score
  FROM asked JOIN tfs USING (term) JOIN weights USING (term) JOIN norms ON norms.k = tfs.k GROUP BY 1, 2, 3, 4),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY k ORDER BY score DESC, doc_id NULLS FIRST) AS rank FROM scores WHERE score > 0)
SELECT item_id, rank::INT AS rank, doc_id, score FROM ranked WHERE rank <= 10
"""


@query
def op13_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return tokens.count_tokens(read(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"))


QUERIES["pipeline"] = corpus_pipeline.run
