"""Registered queries of the package and the SQL that DuckDB can run for them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curatio.llm import ann, audit, centroids, mtree
from curatio.llm import decontaminate as dc
from curatio.llm import langid as li
from curatio.llm import mixing as mx
from curatio.llm import neardup as nd
from curatio.llm import quality as ql
from curatio.llm import substrings as ss
from curatio.llm import toolcalls as tc
from curatio.llm import toxicity as tx
from curatio.llm import urlfilter as uf
from curatio.llm.common import remainder
from curatio.sources.testtables import table


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of each document inside a 13-word window of a benchmark item."""
    d = dc.decontaminate(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    r = F.col("contamination")
    return d.select(
        "doc_id", r["n_words"].alias("n_words"), r["n_hit"].alias("n_hit"),
        F.size(r["item_ids"]).cast("long").alias("n_items"),
        F.sha2(F.array_join(r["item_ids"], ",").cast("binary"), 256).alias("items_sha256"),
        dc.contaminated(r).alias("contaminated"),
    )


OP2_SQL = r"""
WITH w AS (SELECT CAST(item_id AS VARCHAR) AS id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws
           FROM benchmark WHERE text IS NOT NULL AND item_id IS NOT NULL),
pat AS MATERIALIZED (SELECT DISTINCT id, least(len(ws), 13) AS n, array_to_string(ws[p:p + least(len(ws), 13) - 1], ' ') AS win
        FROM w, range(1, 100000) r(p) WHERE len(ws) > 0 AND p <= greatest(1, len(ws) - 12)),
d AS MATERIALIZED (SELECT row_number() OVER () AS h, doc_id,
        regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
pos AS (SELECT h, ws, unnest(range(1, len(ws) + 1)) AS p FROM d),
hit AS MATERIALIZED (SELECT a.h, a.p, n.n, pat.id FROM pos a, (SELECT DISTINCT n FROM pat) n, pat
        WHERE a.p + n.n - 1 <= len(a.ws) AND pat.n = n.n AND pat.win = array_to_string(a.ws[a.p:a.p + n.n - 1], ' ')),
c AS (SELECT h, count(DISTINCT k) AS n_hit FROM (SELECT h, unnest(range(p, p + n)) AS k FROM hit) GROUP BY h),
i AS (SELECT h, count(*) AS n, string_agg(id, ',' ORDER BY id) AS ids FROM (SELECT DISTINCT h, id FROM hit) GROUP BY h)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(i.n, 0) AS BIGINT) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(ws) AS contaminated
FROM d LEFT JOIN c USING (h) LEFT JOIN i USING (h)"""

# Fixed values of the contract.
URL_RULES = [
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]


def op4_urlfilter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict of the URL rules on every page."""
    rules = spark.createDataFrame(URL_RULES, uf.RULE_DDL)
    d = uf.judge(table(spark, sf_dir, "pages").select("page_id", "url"), rules, "r")
    return d.select("page_id", "r.host", "r.path", "r.rule", "r.verdict")


OP4_SQL = f"""
WITH r(host, path, verdict) AS (VALUES {', '.join(map(str, URL_RULES))}),
u AS (SELECT row_number() OVER () AS h, page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
v AS (SELECT h, page_id, translate(regexp_extract(coalesce(rest, ''), '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
             regexp_extract(substr(coalesce(rest, ''), length(regexp_extract(coalesce(rest, ''), '^[^/?#]*')) + 1), '^[^?#]*') AS path FROM u),
m AS (SELECT v.h, r.host || r.path AS rule, r.verdict FROM v JOIN r ON (v.host = r.host OR v.host LIKE '%.' || r.host) AND starts_with(v.path, r.path)
      QUALIFY row_number() OVER (PARTITION BY v.h ORDER BY length(r.host || r.path) DESC) = 1)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM v LEFT JOIN m USING (h)"""


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes of each document."""
    d = mx.taken(mx.mix(table(spark, sf_dir, "documents").select("doc_id", "text", "source")))
    return d.select("doc_id", "size", "source_size", "target", "taken")


def op7_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate component of each document."""
    return nd.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))


OP7_SQL = r"""
WITH RECURSIVE d AS MATERIALIZED (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS MATERIALIZED (SELECT DISTINCT doc_id, array_to_string(ws[p:p + 4], ' ') AS g FROM (SELECT doc_id, ws, unnest(range(1, greatest(1, len(ws) - 4) + 1)) AS p FROM d WHERE len(ws) > 0)),
n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
e AS MATERIALIZED (
  SELECT a.doc_id AS a, b.doc_id AS b, any_value(x.n) AS na, any_value(y.n) AS nb, count(*) AS both
  FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id JOIN n x ON x.doc_id = a.doc_id JOIN n y ON y.doc_id = b.doc_id
  GROUP BY a.doc_id, b.doc_id HAVING 100 * count(*) >= 75 * (any_value(x.n) + any_value(y.n) - count(*))),
l AS MATERIALIZED (SELECT a, b FROM e UNION ALL SELECT b, a FROM e),
reach(doc_id, other) AS (SELECT a, b FROM l UNION SELECT reach.doc_id, l.b FROM reach JOIN l ON reach.other = l.a)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, least(d.doc_id, coalesce(m, d.doc_id)) AS component_id, d.doc_id = least(d.doc_id, coalesce(m, d.doc_id)) AS kept
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN (SELECT doc_id, min(other) AS m FROM reach GROUP BY doc_id) USING (doc_id)"""

OP6_SQL = r"""
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS h, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
w AS (SELECT h, p, hash(array_to_string(ws[p:p + 34], ' ')) AS a, md5(array_to_string(ws[p:p + 34], ' ')) AS b
      FROM (SELECT h, ws, unnest(range(1, len(ws) - 33)) AS p FROM d WHERE len(ws) >= 35)),
r AS (SELECT h, p FROM w QUALIFY count(*) OVER (PARTITION BY a, b) > 1),
c AS MATERIALIZED (SELECT DISTINCT h, unnest(range(p, p + 35)) AS k FROM r),
t AS (SELECT h, list(k) AS gone FROM c GROUP BY h)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(len(gone), 0) AS BIGINT) AS n_removed,
  sha256(coalesce(CASE WHEN gone IS NULL THEN array_to_string(ws, ' ') ELSE k.kept END, '')) AS kept_sha256
FROM d LEFT JOIN t USING (h) LEFT JOIN (
  SELECT h, string_agg(ws[p], ' ' ORDER BY p) AS kept FROM (SELECT h, ws, unnest(range(1, len(ws) + 1)) AS p FROM d) x
  WHERE NOT EXISTS (SELECT 1 FROM c WHERE c.h = x.h AND c.k = x.p) GROUP BY h) k USING (h)"""


def op6_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of each document outside repeated 35-word windows."""
    d = ss.remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"), "r")
    kept = F.regexp_replace(F.coalesce("r.kept", F.lit("")), r"[\x20\x09-\x0D]+", " ")
    digest = F.sha2(F.trim(kept).cast("binary"), 256)
    return d.select("doc_id", "r.n_words", "r.n_removed", digest.alias("kept_sha256"))


def op5_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of each document."""
    d = li.identify(table(spark, sf_dir, "documents").select("doc_id", "text", "lang"), "r")
    return d.select("doc_id", (remainder("doc_id", 4) == 2).alias("held_out"), "r.lang_pred", "r.score", "r.rejected")


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of each document."""
    d = tx.toxicity(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels"), "r")
    predicted = F.when(F.col("r.score") >= 0.7, 1).otherwise(0)
    return d.select("doc_id", (remainder("doc_id", 3) == 1).alias("held_out"), "r.score", predicted.alias("predicted"))


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score of each document and whether it is kept."""
    d = ql.classify(table(spark, sf_dir, "documents").select("doc_id", "text"), "r")
    return d.select("doc_id", "r.score", "r.keep")


def op3_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five nearest rows of every fiftieth vector."""
    return ann.neighbours(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


# Stand-in: assistant turns call a tool, the next turn answers, and a call uses the one two turns before.
CALLS_SQL = """
SELECT conv_id, turn, concat('call-', turn) AS call_id,
       element_at(array('search', 'compose', 'count'), CAST(turn DIV 2 % 3 + 1 AS INT)) AS name,
       CASE WHEN turn % 4 = 1 THEN to_json(named_struct('query', text, 'limit', length(text)))
            ELSE to_json(named_struct('limit', role, 'text', text)) END AS arguments,
       concat('call-', turn - 2) AS parent
FROM conversations WHERE role = 'assistant'
"""
RESULTS_SQL = "SELECT conv_id, turn, concat('call-', turn - 1) AS call_id, text AS content FROM conversations WHERE role = 'user'"
SCHEMAS = [
    ("search", "query", "string", True), ("search", "limit", "integer", False), ("compose", "text", "string", True),
    ("compose", "limit", "number", False), ("count", "text", "string", True),
]


def op8_toolcalls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Linked, ordered and checked tool calls and results."""
    c = table(spark, sf_dir, "conversations")
    calls, results = spark.sql(CALLS_SQL.replace("FROM conversations", "FROM {c}"), c=c), spark.sql(RESULTS_SQL.replace("FROM conversations", "FROM {c}"), c=c)
    schemas = spark.createDataFrame(SCHEMAS, "name string, param string, type string, required boolean")
    return tc.link(calls, results, schemas).withColumn("problems", F.array_join("problems", "; "))


def op11_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each filter removes in every order of the five."""
    return audit.audit(table(spark, sf_dir, "documents").select("doc_id", "text", "lang"), table(spark, sf_dir, "labels"))


OP11_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text FROM documents),
w AS (SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words, min(doc_id) OVER (PARTITION BY text) AS first_id FROM d),
m AS (SELECT doc_id, bool_or(coalesce(quality = 1, FALSE)) AS good, bool_or(coalesce(toxic = 1, FALSE)) AS toxic FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
f AS (
  SELECT part, coalesce(good, FALSE) AS good, coalesce(toxic, FALSE) AS toxic,
    CASE WHEN len(words) < 100 THEN 1 ELSE 0 END + CASE WHEN 100 * len(list_distinct(words)) < 80 * len(words) THEN 2 ELSE 0 END
    + CASE WHEN 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 10 * length(text) THEN 4 ELSE 0 END
    + CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 8 ELSE 0 END + CASE WHEN coalesce(w.doc_id > first_id, FALSE) THEN 16 ELSE 0 END AS mask
  FROM w LEFT JOIN m ON w.doc_id = m.doc_id),
c AS (SELECT part, mask, count(*) AS n, count(*) FILTER (WHERE good) AS g, count(*) FILTER (WHERE toxic) AS t FROM f GROUP BY ALL),
l AS (SELECT i, substr('ABCDE', CAST(i AS INT) + 1, 1) AS letter, CAST(1 << i AS INT) AS bit FROM range(5) r(i)),
o AS (
  SELECT a.letter || b.letter || c.letter || d.letter || e.letter AS filter_order,
    [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits
  FROM l a, l b, l c, l d, l e WHERE a.bit + b.bit + c.bit + d.bit + e.bit = 31 AND a.bit | b.bit | c.bit | d.bit | e.bit = 31),
s AS (SELECT filter_order, CAST(step AS INT) AS step, bits[step] AS bit, coalesce(list_sum(bits[1:step - 1]), 0) AS before FROM o, range(1, 6) r(step)),
x AS (
  SELECT part, filter_order, step, bit,
    sum(CASE WHEN mask & (before | bit) = 0 THEN n ELSE 0 END) AS kept,
    sum(CASE WHEN mask & bit <> 0 AND mask & before = 0 THEN n ELSE 0 END) AS removed,
    sum(CASE WHEN mask & bit <> 0 AND mask & before <> 0 THEN n ELSE 0 END) AS redundant,
    sum(CASE WHEN mask = bit THEN n ELSE 0 END) AS unique_fails,
    sum(CASE WHEN mask & bit <> 0 AND mask & before = 0 THEN g ELSE 0 END) AS good_lost,
    sum(CASE WHEN mask & bit <> 0 AND mask & before = 0 THEN t ELSE 0 END) AS toxic_lost
  FROM c, (SELECT filter_order, step, bit, CAST(before AS INT) AS before FROM s) GROUP BY ALL)
SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
  CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
  CAST(sum(removed) OVER (PARTITION BY part, bit) AS BIGINT) AS shapley
FROM x"""


def op12_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cluster of each vector after five rounds."""
    return centroids.cluster(table(spark, sf_dir, "embeddings")).drop("computed")


def _rounds(rounds: int) -> str:
    """SQL of an assignment to ``c{r}`` and of the next centroids, ``rounds`` times, and of a last assignment."""
    near = """d{r} AS MATERIALIZED (
  SELECT v.h, c.k, CAST(list_sum(list_transform(list_zip(v.x, c.x), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS BIGINT) AS dist FROM v, c{r} c),
a{r} AS MATERIALIZED (SELECT h, k, dist FROM d{r} QUALIFY row_number() OVER (PARTITION BY h ORDER BY dist, k) = 1),"""
    step = """m{r} AS (
  SELECT k, i, CAST((s - ((s % n) + n) % n) // n AS BIGINT) AS x FROM (
    SELECT a.k, u.i, CAST(sum(v.x[u.i]) AS BIGINT) AS s, count(*) AS n FROM a{r} a JOIN v USING (h), range(1, 65) u(i) GROUP BY ALL)),
c{n} AS MATERIALIZED (SELECT c.k, coalesce(w.x, c.x) AS x FROM c{r} c LEFT JOIN (SELECT k, list(x ORDER BY i) AS x FROM m{r} GROUP BY k) w USING (k)),"""
    return "\n".join(near.format(r=r) + "\n" + step.format(r=r, n=r + 1) for r in range(rounds)) + "\n" + near.format(r=rounds)


OP12_SQL = f"""
WITH v AS MATERIALIZED (
  SELECT row_number() OVER () AS h, vec_id, list_transform(embedding, lambda y: CAST(floor(CAST(y AS DOUBLE) * 256) AS BIGINT)) AS x
  FROM embeddings WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda y: isfinite(y))) = 64),
c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY g, x) - 1 AS k, x FROM (
    SELECT sha256('2:' || coalesce(CAST(vec_id AS VARCHAR), '')) AS g, x FROM v ORDER BY g, x LIMIT 40)),
{_rounds(5)}
z AS (SELECT k, sha256(array_to_string(x, ',')) AS centroid_sha256 FROM c5)
SELECT vec_id, CAST(k AS INT) AS cluster, dist AS distance, CAST(sum(dist) OVER (PARTITION BY k) AS BIGINT) AS cluster_inertia,
  CAST(sum(dist) OVER () AS BIGINT) AS inertia, centroid_sha256
FROM a5 JOIN v USING (h) JOIN z USING (k)"""


def op13_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The twenty largest inner products of every twentieth vector."""
    return mtree.top_products(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


OP13_SQL = """
WITH v AS MATERIALIZED (
  SELECT row_number() OVER () AS h, vec_id, list_transform(embedding, lambda y: CAST(floor(CAST(y AS DOUBLE) * 64) AS BIGINT)) AS x
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda y: isfinite(y))) = len(embedding)),
p AS (
  SELECT q.h, q.vec_id AS query_id, v.vec_id, CAST(coalesce(list_sum(list_transform(list_zip(q.x, v.x), lambda p: coalesce(p[1] * p[2], 0))), 0) AS BIGINT) AS score
  FROM v q, v WHERE q.vec_id % 20 = 0 AND q.h <> v.h)
SELECT query_id, CAST(rank AS INT) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY h ORDER BY score DESC, vec_id) AS rank FROM p) WHERE rank <= 20"""


QUERIES = {"op11_audit": op11_audit, "op12_centroids": op12_centroids, "op13_products": op13_products, "op8_toolcalls": op8_toolcalls, "op3_neighbours": op3_neighbours, "op1_quality": op1_quality, "op5_langid": op5_langid, "op10_toxicity": op10_toxicity, "op6_substrings": op6_substrings, "op7_neardup": op7_neardup, "op9_mixing": op9_mixing, "op4_urlfilter": op4_urlfilter, "op2_decontaminate": op2_decontaminate}
ORACLE: dict[str, str] = {"op2_decontaminate": OP2_SQL, "op4_urlfilter": OP4_SQL, "op6_substrings": OP6_SQL, "op7_neardup": OP7_SQL, "op11_audit": OP11_SQL, "op12_centroids": OP12_SQL, "op13_products": OP13_SQL}
