"""URL filters: host-suffix and path-prefix expressions, hash-prefix equi-join, full-digest check."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: (host, path, verdict)
RULES = (("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"),
         ("com", "/fr/", "allow"), ("com", "/de/", "block"))
#: Hex digits of a digest that the join is on; the rest is compared afterwards.
PREFIX_DIGITS = 8
RULE_SCHEMA = "rule_host string, rule_path string, rule_verdict string"


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    found = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(found, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def url_path(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; else empty."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def _digest(host: Column, path: Column) -> Column:
    return F.sha2(F.concat(host, F.lit("\n"), path), 256)


def filter_urls(pages: DataFrame, rules: DataFrame | Sequence[tuple[str, str, str]] = RULES,
                default: str = "allow", id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """Judge every url by the longest rule that fits its host (or a parent domain) and starts its path.

    ``rules`` has ``RULE_SCHEMA``; a rule with a null part is ignored. Each row is expanded into the suffixes of
    its host times those prefixes of its path that have a length some rule has, so the expansion is bounded by
    the rules. Expansions meet rules on a short digest prefix, then the whole digest must agree. Precedence: the
    longer host plus path, then the longer host, then block before allow.

    Returns id, host, path, rule (host and path joined, or null) and verdict, one row per input row, repeated ids
    included. Null urls and urls without ``://`` have an empty host and path, fit no rule and get ``default``.
    Other columns of ``pages`` are not carried, so their names cannot clash.
    """
    spark = pages.sparkSession
    if not isinstance(rules, DataFrame):
        rules = spark.createDataFrame(list(rules), RULE_SCHEMA)
    known = rules.dropna().select(
        "rule_host", "rule_path", "rule_verdict", _digest(F.col("rule_host"), F.col("rule_path")).alias("full"))
    known = known.withColumn("short", F.substring("full", 1, PREFIX_DIGITS))
    # one value: the distinct path lengths of the rules, at most as many as the longest rule has characters
    lengths = known.agg(F.collect_set(F.length("rule_path")).alias("lengths")).scalar()

    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"))
    # the distinct urls are judged once each, so a repeated url is neither expanded nor joined twice
    urls = rows.select("url").distinct().select(
        "url", url_host(F.col("url")).alias("host"), url_path(F.col("url")).alias("path"))
    labels = F.split("host", r"\.")
    suffixes = F.when(F.col("host") == "", F.array().cast("array<string>")).otherwise(
        F.transform(F.sequence(F.lit(1), F.size(labels)),
                    lambda k: F.array_join(F.slice(labels, k, F.size(labels)), ".")))
    prefixes = F.transform(F.filter("lengths", lambda n: n <= F.length("path")),
                           lambda n: F.substring(F.col("path"), F.lit(1), n))
    tried = (urls.withColumn("lengths", lengths)
             .select("url", F.explode(suffixes).alias("try_host"), prefixes.alias("prefixes"))
             .select("url", "try_host", F.explode("prefixes").alias("try_path"))
             .select("url", _digest(F.col("try_host"), F.col("try_path")).alias("try_full"))
             .withColumn("short", F.substring("try_full", 1, PREFIX_DIGITS)))
    fits = tried.join(known, "short").where(F.col("try_full") == F.col("full"))
    rank = F.struct(F.length(F.concat("rule_host", "rule_path")).alias("size"),
                    F.length("rule_host").alias("host_size"),
                    (F.col("rule_verdict") == "block").alias("block"),
                    F.concat("rule_host", "rule_path").alias("rule"), F.col("rule_verdict").alias("verdict"))
    best = fits.groupBy("url").agg(F.max(rank).alias("best"))
    return (rows.join(best, "url", "left")
            .select(F.col("id").alias(id_col), url_host(F.col("url")).alias("host"),
                    url_path(F.col("url")).alias("path"), F.col("best.rule").alias("rule"),
                    F.coalesce("best.verdict", F.lit(default)).alias("verdict")))


def op9_url_filters(spark, sf_dir):
    from medcohort.llm.common import read_table

    return filter_urls(read_table(spark, sf_dir, "pages"))


ORACLE = r"""
WITH u AS (
  SELECT page_id,
         translate(regexp_extract(coalesce(url, ''), '^.*?://([^/?#]*)', 1, 's'),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(coalesce(url, ''), '^.*?://[^/?#]*([^?#]*)', 1, 's') AS path
  FROM pages),
r(rule_host, rule_path, v) AS (VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'),
  ('example.org', '/en/1', 'block'), ('com', '/fr/', 'allow'), ('com', '/de/', 'block'))
SELECT page_id, host, path,
       arg_max(rule_host || rule_path, length(rule_host || rule_path)) AS rule,
       coalesce(arg_max(v, length(rule_host || rule_path)), 'allow') AS verdict
FROM u LEFT JOIN r ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
GROUP BY page_id, host, path
"""
