"""URL filter: nested host and path rules, found by a sorted sweep over reversed-host keys. DataFrame functions only.

A rule names a host and the beginning of a path; it fits its host, every subdomain and every path that begins so.
The canonical key of a host is its labels in reverse (``org.example.www``). A URL asks once for each of its
reversed-host prefixes (``org``, ``org.example``, ...), so under each prefix a rule is one interval of the sorted
paths: all that begin with its path. Intervals of prefixes nest or are apart. The sweep sorts rules and asked paths
together and hands every asked path the stack of rules open at the last rule before it; those of the stack that
begin the path fit, and the longest over all prefixes decides.

No interval crosses a host prefix, so the sweep is dealt by host prefix. A prefix with many asked paths is dealt on
over as many parts as its count needs, with its rules in each, so a host with a third of all pages is no hot group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Verdict, host and path of the rules that the registered query applies (fixed values).
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)
PATHS_PER_PART = 50_000


def host(url: Column) -> Column:
    """What stands after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case; empty without ``://``."""
    return F.translate(F.coalesce(F.regexp_extract(url, "://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def path(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; empty without ``://``."""
    return F.coalesce(F.regexp_extract(url, "://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_table(spark, rules: Sequence[tuple[str, str, str]]) -> DataFrame:
    return spark.createDataFrame(list(rules), "verdict string, host string, path string")


def _reversed(name: Column) -> Column:
    return F.reverse(F.split(name, r"\."))


def _stacks(rules: DataFrame) -> DataFrame:
    """Each rule with the rules of its host whose paths begin its own path, itself last. One rule for a host and path."""
    rules = (rules.where("host is not null")
             .select(F.array_join(_reversed(F.translate("host", UPPER, LOWER)), ".").alias("prefix"),
                     F.coalesce("path", F.lit("")).alias("path"),
                     F.concat(F.translate("host", UPPER, LOWER), F.coalesce("path", F.lit(""))).alias("rule"), "verdict")
             .groupBy("prefix", "path", "rule").agg(F.max("verdict").alias("verdict")))
    parts = rules.select("prefix", "path", F.explode(F.transform(
        F.sequence(F.lit(0), F.length("path")), lambda n: F.substring("path", F.lit(1), n))).alias("begin"))
    outer = rules.select("prefix", F.col("path").alias("begin"), "rule", "verdict")
    return (parts.join(outer, ["prefix", "begin"])
            .groupBy("prefix", "path")
            .agg(F.array_sort(F.collect_list(F.struct(
                F.length("begin").alias("depth"), F.col("begin"), "rule", "verdict"))).alias("stack")))


def judge(pages: DataFrame, rules: DataFrame, default: str = "allow", url: str = "url",
          paths_per_part: int = PATHS_PER_PART) -> DataFrame:
    """`pages` with host, path, rule and verdict; columns of these names that it already had are replaced.

    The longest fitting rule decides (host and path together); with none, `rule` is NULL and `verdict` is `default`.
    NULL urls and urls without ``://`` have an empty host and path, which no rule fits. Repeated urls are judged once
    and all their rows get the verdict. Of equal rules with different verdicts, block is taken. An empty table of
    pages gives no rows, an empty table of rules the default for all. Host labels are compared whole.
    """
    keep = [c for c in pages.columns if c.lower() not in ("host", "path", "rule", "verdict")]
    keyed = pages.select(*keep, host(F.col(url)).alias("host"), path(F.col(url)).alias("path"))
    stacks = _stacks(rules)
    asked = (keyed.select("host", "path").distinct()
             .withColumn("labels", _reversed(F.col("host")))
             .withColumn("prefix", F.explode(F.transform(
                 F.sequence(F.lit(1), F.size("labels")), lambda n: F.array_join(F.slice("labels", F.lit(1), n), "."))))
             .join(stacks.select("prefix").distinct(), "prefix", "left_semi")
             .select("prefix", "path", "host"))
    parts = asked.groupBy("prefix").agg(F.ceil(F.count("*") / paths_per_part).cast("int").alias("parts"))
    asked = asked.join(parts, "prefix").select(
        "prefix", F.pmod(F.xxhash64("path", "host"), "parts").cast("int").alias("part"), "path", "host",
        F.lit(None).cast(stacks.schema["stack"].dataType).alias("opened"))
    opening = stacks.join(parts, "prefix").select(
        "prefix", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), "path",
        F.lit(None).cast("string").alias("host"), F.col("stack").alias("opened"))
    sweep = W.partitionBy("prefix", "part").orderBy("path", F.col("host").isNotNull())
    fitting = (opening.unionByName(asked).repartition("prefix", "part")  # else the join's dealing by prefix would do
               .withColumn("stack", F.last("opened", ignorenulls=True).over(
                   sweep.rowsBetween(W.unboundedPreceding, W.currentRow)))
               .where("host is not null")
               .select("host", "path", F.try_element_at(F.filter(
                   "stack", lambda r: F.col("path").startswith(r["begin"])), F.lit(-1)).alias("r"))
               .where("r is not null"))
    best = fitting.groupBy("host", "path").agg(
        F.max(F.struct(F.length("r.rule").alias("n"), F.col("r.rule").alias("rule"), F.col("r.verdict").alias("verdict"))).alias("best"))
    return keyed.join(best, ["host", "path"], "left").select(
        *keep, "host", "path", F.col("best.rule").alias("rule"),
        F.coalesce("best.verdict", F.lit(default)).alias("verdict"))
