"""URL filters as a sort-merge range join on reversed hosts.

A host becomes the key of its labels in reverse, each ended by a dot, so a
rule's host and all its subdomains are one interval of keys. A sorted sweep
over rules and urls carries, with the last rule host passed, the stack of the
rule hosts nested around it; every rule that holds a url's key is on that
stack. Hot hosts are dealt over salts; the rules, a configuration table, are
repeated for each salt. DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from hebdo.llm.common import ascii_lower


def url_host(url: Column) -> Column:
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substr(url, at + 3))
    return ascii_lower(F.coalesce(F.regexp_extract(rest, "^[^/?#]*", 0), F.lit("")))


def url_path(url: Column) -> Column:
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substr(url, at + 3))
    return F.coalesce(F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1), F.lit(""))


def host_key(host: Column) -> Column:
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), "."), F.lit("."))


def rule_table(spark: SparkSession, rules: list[tuple[str, str]]) -> DataFrame:
    """(verdict, 'host/path') pairs as a table."""
    return spark.createDataFrame(rules, "verdict string, rule string")


def _stacks(rules: DataFrame) -> DataFrame:
    """(key, stack): for each rule host the rules of all rule hosts around it, itself included."""
    r = (rules.filter(F.col("rule").isNotNull() & F.col("verdict").isNotNull())
         .groupBy("rule").agg(F.max("verdict").alias("verdict"))
         .withColumn("key", host_key(ascii_lower(F.regexp_extract("rule", "^[^/]*", 0))))
         .withColumn("path", F.regexp_extract("rule", "^[^/]*(.*)", 1)))
    entry = F.struct(F.length("rule").alias("size"), "verdict", "rule", "key", "path")
    own = r.groupBy("key").agg(F.collect_list(entry).alias("own"))
    labels = F.split(F.expr("substr(key, 1, length(key) - 1)"), r"\.")
    around = F.transform(F.sequence(F.lit(1), F.size(labels)),
                         lambda d: F.concat(F.array_join(F.slice(labels, F.lit(1), d), "."), F.lit(".")))
    nested = own.select("key", F.explode(around).alias("outer"))
    return (nested.join(own.select(F.col("key").alias("outer"), "own"), "outer")
            .groupBy("key").agg(F.flatten(F.collect_list("own")).alias("stack")))


def judge_urls(pages: DataFrame, rules: DataFrame, default: str = "allow", salts: int = 64,
               id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """(id_col, host, path, rule, verdict), one row per row of ``pages``.

    The longest fitting rule decides; of equally long ones and of repeated rules
    with different verdicts the greater verdict string ('block'). Null urls and
    urls without '://' have an empty host and path, fit no rule and get
    ``default``. Null rules are ignored; an empty rule table decides nothing.
    """
    url = F.col(url_col)
    seen = (pages.select(F.col(id_col).alias("id"), url_host(url).alias("host"), url_path(url).alias("path"))
            .withColumn("key", host_key(F.col("host")))
            .withColumn("salt", F.pmod(F.xxhash64("id", "path"), F.lit(salts)).cast("int")))
    stacks = _stacks(rules)
    swept = seen.select("id", "host", "path", "key", "salt", F.lit(1).alias("kind")).unionByName(
        stacks.select("key", "stack", F.lit(0).alias("kind"),
                      F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt")), allowMissingColumns=True)
    swept = swept.withColumn("top", F.regexp_extract("key", r"^[^.]*", 0))
    sweep = (Window.partitionBy("top", "salt").orderBy("key", "kind")
             .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    active = F.filter("stack", lambda s: F.col("key").startswith(s["key"]) & F.col("path").startswith(s["path"]))
    best = F.array_max(F.transform(active, lambda s: F.struct(s["size"], s["verdict"], s["rule"])))
    return (swept.withColumn("stack", F.last("stack", ignorenulls=True).over(sweep)).filter("kind = 1")
            .withColumn("best", best)
            .select(F.col("id").alias(id_col), "host", "path", F.col("best.rule").alias("rule"),
                    F.coalesce("best.verdict", F.lit(default)).alias("verdict")))
