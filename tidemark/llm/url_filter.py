"""URL filtering by hashed host-suffix and path-prefix expressions.

Every URL is expanded into the expressions (suffix of its host with as
many labels as some rule's host) x (prefix of its path as long as some rule's).  The first
four bytes of an expression's SHA-256 are the join key to the rules; the full
digests then confirm a hit, and of the confirmed rules the longest wins.

Edge cases: a null URL or one without ``://`` has empty host and path; an empty
host matches no rule; of two rules with the same expression ``block`` wins;
repeated rows are judged each for itself; an empty table gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import ascii_lower, broadcast_small, row_of, save, stable

#: (action, host, path)
RULES = (
    ("block", "com", "/en/"),
    ("allow", "example.com", "/en/7"),
    ("allow", "net", "/de/"),
    ("block", "example.net", "/de/8"),
    ("block", "org", "/es/"),
)


def host_of(url: Column) -> Column:
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return ascii_lower(rest)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def _digest(expression: Column) -> Column:
    return F.unhex(F.sha2(expression.cast("binary"), 256))


def rule_table(spark: SparkSession, rules=RULES) -> DataFrame:
    rows = spark.createDataFrame(list(rules), "action string, rule_host string, rule_path string")
    rule = F.concat("rule_host", "rule_path")
    return (
        rows.withColumn("rule", rule)
        .withColumn("full", _digest(F.concat_ws("\n", "rule_host", "rule_path")))
        .withColumn("short", F.substring("full", 1, 4))
    )


def url_filter(pages: DataFrame, rules: DataFrame, default: str = "allow") -> DataFrame:
    """One row per row of ``pages``: page_id, host, path, rule, verdict."""
    # Distinct path lengths and label counts of the rules: at most as many as a URL has characters.
    lengths = [r[0] for r in rules.select(F.length("rule_path")).distinct().collect()]
    depths = [r[0] for r in rules.select(F.size(F.split("rule_host", r"\."))).distinct().collect()]
    pages = stable(pages)
    url = pages["url"].cast("string")
    rows = pages.select(
        row_of(pages).alias("row"), pages["page_id"].alias("page_id"), host_of(url).alias("host"), path_of(url).alias("path")
    )
    suffixes = F.array_distinct(F.array(*[F.substring_index("host", ".", -n) for n in depths] or [F.lit("")]))
    prefixes = F.filter(
        F.array(*[F.substring("path", 1, n) for n in sorted(lengths)] or [F.lit("")]),
        lambda p: F.array_contains(F.array(*[F.lit(n) for n in lengths] or [F.lit(-1)]), F.length(p)),
    )
    expressions = F.array_distinct(
        F.flatten(F.transform(suffixes, lambda s: F.transform(prefixes, lambda p: F.concat(s, F.lit("\n"), p))))
    )
    expanded = rows.where("host <> ''").select("row", F.explode(expressions).alias("expression")).withColumn(
        "mine", _digest(F.col("expression"))
    )
    strength = F.struct(
        F.length("rule").alias("length"), F.length("rule_host").alias("host_length"),
        (F.col("action") == "block").alias("blocks"), "rule", "action",
    )
    hit = (
        (F.substring("mine", 1, 4) == F.col("short"))
        & (F.col("mine") == F.col("full"))
    )
    # Only rows that a rule fits are aggregated and kept.
    best = save(expanded.join(broadcast_small(rules), hit).groupBy("row").agg(F.max(strength).alias("best")), "fitting-rules")
    return rows.join(broadcast_small(best), "row", "left").select(
        "page_id", "host", "path", F.col("best.rule").alias("rule"),
        F.coalesce("best.action", F.lit(default)).alias("verdict"),
    )


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter(spark.read.parquet(f"{sf_dir}/pages.parquet"), rule_table(spark))


OP9_SQL = r"""
WITH u AS (
  SELECT page_id,
    translate(regexp_extract(coalesce(url, ''), '^.*?://([^/?#]*)', 1, 's'),
              'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(coalesce(url, ''), '^.*?://[^/?#]*([^?#]*)', 1, 's') AS path
  FROM pages),
r(action, h, p) AS (VALUES ('block', 'com', '/en/'), ('allow', 'example.com', '/en/7'),
  ('allow', 'net', '/de/'), ('block', 'example.net', '/de/8'), ('block', 'org', '/es/')),
v AS (
  SELECT page_id, host, path,
    (SELECT max_by(h || p || ' ' || action, length(h || p)) FROM r
     WHERE (host = h OR host LIKE '%.' || h) AND starts_with(path, p)) AS best
  FROM u)
SELECT page_id, host, path, split_part(best, ' ', 1) AS rule,
       coalesce(split_part(best, ' ', 2), 'allow') AS verdict
FROM v
"""
