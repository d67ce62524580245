"""Allow and block lists of hosts and path prefixes, judged by a sort-merge range join.

A host's labels in reverse order, each followed by a dot, make a key under which a host and all its subdomains are one
interval. Rules with the same path prefix therefore are nested intervals; path prefixes are nested intervals of paths.
One sorted sweep over interval ends and points answers each: the stack of active rules is kept as the innermost one
and its ancestors.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tablewright.session import cut_lineage, small_frame

#: Host and path prefix per rule, as the contract of the query gives them.
RULES = [("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"),
         ("block", "net", "/es/"), ("block", "net", "/fr/")]


def rule_frame(spark: SparkSession, rules: list[tuple[str, str, str]] = RULES) -> DataFrame:
    return small_frame(spark, rules, "verdict string, host string, path string")


def host_of(url: Column) -> Column:
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def host_key(host: Column) -> Column:
    """com.example.www. for www.example.com; a rule's key is a prefix of the keys of its host and subdomains."""
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), "."), F.lit("."))


def innermost(points: DataFrame, prefixes: DataFrame) -> DataFrame:
    """For each distinct point (g, key), the longest prefix (g, key) of it: columns g, key and found (null if none).

    Prefixes of strings are intervals, and two of them are nested or apart. A point's innermost interval is told by the
    last interval end before it in sorted order: at its start an interval becomes the innermost, at its end its parent
    does again. Points and ends are dealt by key ranges; what is active where a range begins comes from the last end
    of the ranges before it (one row per range). No range depends on how often a group or a key occurs, for points
    are distinct.
    """
    spark = points.sparkSession
    rules = prefixes.select("g", F.col("key").alias("r")).distinct()
    # each prefix's chain of shorter prefixes that are rules too; lengths are bounded by the rule itself
    shorter = rules.withColumn("a", F.explode(F.transform(F.sequence(F.lit(0), F.length("r")), lambda i: F.substring("r", F.lit(1), i))))
    parent = shorter.where("a <> r").join(rules.withColumnRenamed("r", "a"), ["g", "a"]).groupBy("g", "r").agg(F.max_by("a", F.length("a")).alias("parent"))
    ends = rules.join(parent, ["g", "r"], "left")
    # kind orders what falls on one key: an end's hand-back, then starts, then points
    opens = ends.select("g", F.col("r").alias("key"), F.lit(1).alias("kind"), F.struct(F.col("r").alias("rule")).alias("now"))
    last = F.concat(F.col("r"), F.lit("\U0010FFFF"))
    closes = ends.select("g", last.alias("key"), F.lit(0).alias("kind"), F.struct(F.col("parent").alias("rule")).alias("now"), F.length("r").alias("depth"))
    nothing = F.lit(None).cast("struct<rule: string>")
    rows = opens.withColumn("depth", F.lit(0)).unionByName(closes).unionByName(
        points.select("g", "key", F.lit(2).alias("kind"), nothing.alias("now"), F.lit(0).alias("depth")))
    # among ends on one key the outermost rule's comes last, for its parent is what remains
    order = ["g", "key", "kind", F.col("depth").desc()]
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = cut_lineage(rows.repartitionByRange(parts, "g", "key").withColumn("range", F.spark_partition_id()), "ranges")
    place = F.struct("g", "key", "kind", (-F.col("depth")).alias("depth"))
    tails = dealt.groupBy("range").agg(F.max_by("now", F.when(F.col("now").isNotNull(), place)).alias("tail"))
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    carry = cut_lineage(tails.select("range", F.last("tail", True).over(before).alias("carry")), "carry")
    within = Window.partitionBy("range").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    swept = dealt.withColumn("here", F.last("now", True).over(within)).join(carry, "range")
    rule = F.coalesce("here", "carry")["rule"]
    return swept.where("kind = 2").select("g", "key", F.when(F.startswith("key", rule), rule).alias("found"))


def judge(pages: DataFrame, rules: DataFrame, otherwise: str = "allow", page_id: str = "page_id", url: str = "url") -> DataFrame:
    """page_id, host, path, rule, verdict: one row per row of ``pages``; other columns are not returned.

    A rule fits its host and all subdomains, if the path starts with the rule's path. The longest rule (host and path
    together, then the host) wins; ``otherwise`` is the verdict where none fits, with a null rule. A null url or one
    without :// has an empty host and path. A rule given twice with both verdicts blocks. An empty rule table leaves
    every page to ``otherwise``.
    """
    rules = rules.select(F.lower("host").alias("h"), "path", "verdict").groupBy("h", "path").agg(F.max("verdict").alias("verdict"))
    rules = rules.select("path", host_key(F.col("h")).alias("hkey"), F.concat("h", "path").alias("rule"), "verdict")
    parts = pages.select(F.col(page_id).alias("page_id"), host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"))
    seen = cut_lineage(parts.select("host", "path").distinct(), "urls")
    # paths first: the innermost rule path, then all rule paths it starts with
    paths = rules.select(F.lit("").alias("g"), F.col("path").alias("key")).distinct()
    of_path = innermost(seen.select(F.lit("").alias("g"), F.col("path").alias("key")).distinct(), paths)
    starts = F.transform(F.sequence(F.lit(0), F.length("key")), lambda i: F.substring("key", F.lit(1), i))
    chains = paths.select("key", F.explode(starts).alias("part")).join(paths.select(F.col("key").alias("part")), "part").select(F.col("key").alias("found"), "part")
    chained = of_path.where("found is not null").select(F.col("key").alias("path"), "found").join(chains, "found").select("path", "part")
    # then hosts, among the rules of each path prefix
    asked = seen.join(chained, "path").select("host", "path", "part", host_key(F.col("host")).alias("hkey"))
    asked = cut_lineage(asked, "asked")
    of_host = innermost(asked.select(F.col("part").alias("g"), F.col("hkey").alias("key")).distinct(),
                        rules.select(F.col("path").alias("g"), F.col("hkey").alias("key")))
    hit = asked.join(of_host.where("found is not null").select(F.col("g").alias("part"), F.col("key").alias("hkey"), "found"), ["part", "hkey"])
    best = hit.groupBy("host", "path").agg(F.max(F.struct((F.length("found") + F.length("part")).alias("n"), F.length("found").alias("m"), "found", "part")).alias("w"))
    best = best.select("host", "path", F.col("w.found").alias("found"), F.col("w.part").alias("part"))
    named = best.join(rules.withColumnsRenamed({"path": "part", "hkey": "found"}), ["part", "found"]).select("host", "path", "rule", "verdict")
    out = parts.join(named, ["host", "path"], "left")
    return out.select(F.col("page_id").alias(page_id), "host", "path", "rule", F.coalesce("verdict", F.lit(otherwise)).alias("verdict"))
