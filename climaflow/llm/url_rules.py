"""Allow and block rules for URLs by a sort-merge range join.

A host is written backwards by labels (``org.example.www.``). A rule's host then is a prefix of all hosts that it
covers, that is an interval of the sorted keys, and such intervals are nested or apart. One sweep over the sorted keys
meets the rules' hosts and the URLs. Each rule host brings the stack of rules that are open at its place (its own
and those of the hosts around it); a URL takes the stack of the last rule host before it. An interval that holds the
URL also holds that host, so every rule that can fit is in the stack, and the longest that does fit wins.

The sweep is a window over parts that are dealt by a random salt: a host with a third of all URLs is spread over all
parts, and each part gets all rule hosts, whose number does not depend on the URLs.

Defined results: a null URL or one without ``://`` has an empty host and path and fits no rule; equally long rules:
the longer host, then block before allow, then the smaller text; repeated rows stay; columns beside the named ones are
ignored; without rules or rows every verdict is the default or the result is empty.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

# Host, path, verdict. An empty path is "/".
RULES = [
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]
DEFAULT_VERDICT = "allow"
# Parts of the sweep: at least MIN_PARTS, and one per so many URLs.
MIN_PARTS, URLS_PER_PART = 64, 500_000

_URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def url_host(url: str = "url") -> Column:
    host = F.regexp_extract(F.coalesce(F.col(url), F.lit("")), _URL, 1)
    return F.translate(host, string.ascii_uppercase, string.ascii_lowercase)


def url_path(url: str = "url") -> Column:
    return F.regexp_extract(F.coalesce(F.col(url), F.lit("")), _URL, 2)


def reversed_host(host: Column) -> Column:
    """Labels backwards, each closed by a dot, so that a prefix ends between labels."""
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), "."), F.lit("."))


def rule_table(spark: SparkSession, rules=RULES) -> DataFrame:
    return spark.createDataFrame(list(rules), "host string, path string, verdict string")


def rule_stacks(rules: DataFrame) -> DataFrame:
    """Per rule host the rules open there, best first: ``key`` and ``stack`` of (key, path, rule, verdict)."""
    keyed = rules.select(
        reversed_host(F.lower("host")).alias("key"), "path", "verdict",
        F.concat(F.lower("host"), "path").alias("rule"),
    ).distinct()
    # A host is nested in those that its leading labels spell: an equality join over the labels finds them.
    labels = F.split(F.expr("substr(key, 1, length(key) - 1)"), r"\.")
    depth = F.explode(F.sequence(F.lit(1), F.size(labels)))
    inner = keyed.select("key").distinct().withColumn("labels", labels).withColumn("depth", F.explode(
        F.sequence(F.lit(1), F.size("labels"))))
    around = inner.select(
        F.col("key").alias("inner_key"),
        F.concat(F.array_join(F.slice("labels", F.lit(1), F.col("depth")), "."), F.lit(".")).alias("key"),
    )
    best_first = F.struct(
        (-F.length("rule")).alias("rank"), (-F.length("key")).alias("host_rank"),
        F.when(F.col("verdict") == "block", 0).otherwise(1).alias("soft"), "rule", "key", "path", "verdict",
    )
    return around.join(keyed, "key").groupBy(F.col("inner_key").alias("key")).agg(
        F.sort_array(F.collect_list(best_first)).alias("stack")
    )


def judge(pages: DataFrame, rules: DataFrame, url: str = "url", keep: tuple[str, ...] = ("page_id",),
          default: str = DEFAULT_VERDICT) -> DataFrame:
    """``keep`` columns, host, path, the longest rule that fits (or null) and the verdict of every row."""
    parts = max(MIN_PARTS, pages.count() // URLS_PER_PART)
    probes = pages.select(
        F.struct(*keep).alias("kept"), url_host(url).alias("host"), url_path(url).alias("path"),
    ).withColumns({
        "key": reversed_host(F.col("host")), "part": F.pmod(F.xxhash64("kept", "host", "path"), F.lit(parts)).cast("int"),
    })
    stacks = rule_stacks(rules)
    events = stacks.select(
        F.lit(None).cast(probes.schema["kept"].dataType).alias("kept"), F.lit(None).cast("string").alias("host"),
        F.lit(None).cast("string").alias("path"), "key",
        F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part"), "stack", F.lit(0).alias("turn"),
    )
    swept = events.unionByName(probes.withColumn("turn", F.lit(1)), allowMissingColumns=True)
    sweep = W.partitionBy("part").orderBy("key", "turn").rowsBetween(W.unboundedPreceding, 0)
    open_rules = F.last("stack", ignorenulls=True).over(sweep)
    judged = swept.withColumn("open", open_rules).where("turn = 1")
    fit = F.filter("open", lambda r: F.col("key").startswith(r["key"]) & F.col("path").startswith(r["path"]))
    judged = judged.withColumn("winner", F.get(fit, F.lit(0)))
    return judged.select(
        *[F.col(f"kept.{k}").alias(k) for k in keep], "host", "path", F.col("winner.rule").alias("rule"),
        F.coalesce("winner.verdict", F.lit(default)).alias("verdict"),
    )


def op10_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(spark.read.parquet(f"{sf_dir}/pages.parquet"), rule_table(spark))


OP10_SQL = r"""
WITH rules(rule_host, rule_path, verdict) AS (VALUES
  ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'),
  ('com', '/fr/', 'allow'), ('com', '/de/', 'block')),
parsed AS (
  SELECT row_number() OVER () AS rid, page_id,
    translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 1),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 2) AS path
  FROM pages),
fits AS (
  SELECT rid, rule_host || rule_path AS rule, verdict,
    row_number() OVER (PARTITION BY rid ORDER BY length(rule_host || rule_path) DESC, length(rule_host) DESC,
      verdict DESC, rule_host || rule_path) AS place
  FROM parsed JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path))
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict
FROM parsed LEFT JOIN (SELECT * FROM fits WHERE place = 1) USING (rid)
"""
