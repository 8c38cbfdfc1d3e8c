"""URL filters: host-suffix and path-prefix expressions, hash-prefix join, full digests, precedence.

Each distinct URL is split into host and path and expanded into every pair
of a host suffix (cut at dots) and a path prefix whose lengths some rule has.
The expressions meet the rules in an equi-join on a short prefix of their
SHA-256; the full digest then confirms.  The longest fitting rule (host and
path together) wins; among equally long ones the longer host, then the
smaller rule text, then ``block``.  Without a rule the verdict is ``default``.

Work is per distinct URL, so repeated URLs cost one expansion; the verdict is
joined back to every row.  Distinct URLs grow with the input and are shuffled;
the rules are a given list.

Defined results: a null URL, or one without ``://``, has an empty host and
path and no rule; rules with a null or empty host, or an unknown action, are
ignored; repeated rows and extra columns stay; empty inputs give empty results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curatio.llm.common import fresh, put

PREFIX_HEX = 8  # 32 bits of the digest
ALLOW, BLOCK = "allow", "block"
RULE_DDL = "host string, path string, action string"


def host_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL; both empty without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    low = F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return low, path


def expressions(host: Column, path: Column, labels: list[int], lengths: list[int]) -> Column:
    """Host suffixes of the given label counts, each with path prefixes of the given lengths."""
    parts = F.split(host, r"\.", -1)
    n = F.size(parts)
    hosts = F.filter(
        F.array(*[F.when(n >= k, F.array_join(F.slice(parts, F.greatest(n - F.lit(k) + 1, F.lit(1)), k), ".")) for k in labels]),
        lambda x: x.isNotNull() & (x != ""),
    )
    paths = F.filter(
        F.array(*[F.when(F.length(path) >= k, F.substring(path, 1, k)) for k in lengths]), lambda x: x.isNotNull()
    )
    return F.flatten(F.transform(hosts, lambda h: F.transform(paths, lambda p: F.struct(h.alias("h"), p.alias("p")))))


def digest(host: Column, path: Column) -> Column:
    return F.sha2(F.concat_ws("\n", host, path).cast("binary"), 256)


def judge(pages: DataFrame, rules: DataFrame, out: str = "url", *, url: str = "url", default: str = ALLOW) -> DataFrame:
    """``pages`` with the struct ``out``: host, path, rule (null without one), verdict."""
    r = rules.select("host", "path", "action").where(
        (F.coalesce("host", F.lit("")) != "") & F.col("action").isin(ALLOW, BLOCK)
    )
    r = r.select(
        F.lower("host").alias("rh"), F.coalesce("path", F.lit("")).alias("rp"), "action",
        F.concat("host", F.coalesce("path", F.lit(""))).alias("rule"),
    )
    # the label counts and path lengths that occur in the rules: small sets
    shape = r.agg(
        F.sort_array(F.collect_set(F.size(F.split("rh", r"\.", -1)))), F.sort_array(F.collect_set(F.length("rp")))
    ).first()
    r = r.withColumn("full", digest(F.col("rh"), F.col("rp"))).withColumn("short", F.left("full", F.lit(PREFIX_HEX)))
    host, path = host_path(F.col("__u"))
    urls = pages.select(F.col(url).alias("__u")).where(F.col(url).isNotNull()).distinct()
    cut = urls.select("__u", F.explode(expressions(host, path, list(shape[0]), list(shape[1]))).alias("e"))
    cut = cut.select("__u", digest(F.col("e.h"), F.col("e.p")).alias("full"))
    cut = cut.withColumn("short", F.left("full", F.lit(PREFIX_HEX)))
    met = cut.join(r, "short").where(cut["full"] == r["full"])
    # smallest first: longer rule, longer host, smaller rule text, block before allow
    order = F.struct(
        (-F.length("rule")).alias("n"), (-F.length("rh")).alias("h"), F.col("rule"),
        F.when(F.col("action") == BLOCK, 0).otherwise(1).alias("a"),
    )
    best = met.groupBy("__u").agg(F.min(order).alias("__best"))
    flat = fresh(pages, "__u")
    best = best.withColumnRenamed("__u", flat).withColumnRenamed("__best", fresh(pages, "__best"))
    b = F.col(fresh(pages, "__best"))
    joined = pages.join(best, pages[url] == best[flat], "left")
    host, path = host_path(pages[url])
    value = F.struct(
        host.alias("host"), path.alias("path"), b["rule"].alias("rule"),
        F.when(b.isNull(), F.lit(default)).when(b["a"] == 0, BLOCK).otherwise(ALLOW).alias("verdict"),
    )
    kept = [c for c in pages.columns]
    return put(joined, out, value).select(*[f"`{c}`" for c in kept if c.lower() != out.lower()], f"`{out}`")
