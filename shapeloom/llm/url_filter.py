"""URL filters by a sort-merge range join.

A host's labels reversed, each closed by ``/``, make its key, so that a host
and all its subdomains are one interval of keys: those that start with the
rule's key. A rule's path does the same below its host. Rules of such
intervals nest, and every rule carries the stack of the rules around it.
Points and rules are sorted together; a sweep hands each point the last rule
before it, and the members of that rule's stack that the point starts with are
the active ones. A first sweep finds the rule hosts around every distinct
host, a second the path rules of each. Only DataFrame functions run.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .storage import fresh, run_dir, written


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty without ``://``."""
    pattern = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    host = F.translate(F.regexp_extract(url, pattern, 1), string.ascii_uppercase, string.ascii_lowercase)
    return F.coalesce(host, F.lit("")), F.coalesce(F.regexp_extract(url, pattern, 2), F.lit(""))


def host_key(host: Column) -> Column:
    """``www.example.com`` to ``com/example/www/``."""
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), "/"), F.lit("/"))


def stacks(keys: DataFrame) -> DataFrame:
    """(key, stack): the keys that each distinct key starts with, itself last.

    Every prefix of a key is looked up among the keys: work in proportion to
    the rules' own length.
    """
    keys = keys.select("key").distinct()
    prefixes = keys.select(F.col("key").alias("whole"), F.explode(F.sequence(F.lit(1), F.length("key"))).alias("n"))
    prefixes = prefixes.select("whole", F.expr("left(whole, n)").alias("key"))
    found = prefixes.join(keys, "key").groupBy("whole").agg(F.sort_array(F.collect_list(
        F.struct(F.length("key").alias("n"), "key"))).alias("parts"))
    return found.select(F.col("whole").alias("key"), F.transform("parts", lambda p: p["key"]).alias("stack"))


def sweep(points: DataFrame, rules: DataFrame, folder: str, name: str) -> DataFrame:
    """(key, active): for each distinct point the stack of rule keys that it starts with.

    Points and rules are range-partitioned by key; a window runs inside each
    range, and the last rule of the ranges before (one row a range) is carried
    into it. The ranges are a written table, so both readers see the same ones.
    """
    spark = points.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    empty = F.lit(None).cast("array<string>")
    events = points.select("key").distinct().select("key", F.lit(1).alias("kind"), empty.alias("stack")).unionByName(
        stacks(rules).select("key", F.lit(0).alias("kind"), "stack"))
    ranged = written(events.repartitionByRange(n, "key", "kind").withColumn("range", F.spark_partition_id()), folder, name)
    last = ranged.groupBy("range").agg(F.max_by("stack", F.when(F.col("kind") == 0, F.col("key"))).alias("_last"))
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    carried = last.select("range", F.last("_last", ignorenulls=True).over(before).alias("_carried"))
    upto = Window.partitionBy("range").orderBy("key", "kind").rowsBetween(Window.unboundedPreceding, 0)
    swept = ranged.withColumn("_near", F.last("stack", ignorenulls=True).over(upto)).join(carried, "range").where("kind = 1")
    active = F.filter(F.coalesce("_near", "_carried"), lambda p: F.startswith(F.col("key"), p))
    return swept.select("key", active.alias("active")).where(F.size("active") > 0)


def judge(urls: DataFrame, rules: DataFrame, default: str = "allow") -> DataFrame:
    """(url, host, path, rule, verdict): one row per distinct url.

    ``rules`` has host, path and verdict. A rule fits its host and all its
    subdomains if the url's path starts with the rule's; of those that fit the
    longest (host and path together, then host) wins, and without one the
    verdict is ``default``. A null path is empty; a rule without host fits
    nothing; of two rules alike the greater verdict (block) counts. A null url
    and one without ``://`` have empty host and path and the default verdict;
    urls of any length count whole, repeated ones once.
    Empty tables are allowed on either side; other columns are not read.
    """
    folder = run_dir(urls.sparkSession, "urls")
    host, path = host_and_path(F.col("url"))
    parsed = written(urls.select("url").distinct().select("url", host.alias("host"), path.alias("path")), folder, "parsed")
    lowered = F.translate("host", string.ascii_uppercase, string.ascii_lowercase)
    given = rules.select(lowered.alias("host"), F.coalesce("path", F.lit("")).alias("path"), "verdict").where(
        "host is not null and host != '' and verdict is not null")
    given = given.groupBy("host", "path").agg(F.max("verdict").alias("verdict"))
    given = written(given.withColumn("hosts", host_key(F.col("host"))), folder, "rules")
    hosts = sweep(parsed.where("host != ''").select(host_key(F.col("host")).alias("key")),
                  given.select(F.col("hosts").alias("key")), folder, "hosts")
    around = hosts.select(F.col("key").alias("_host"), F.explode("active").alias("hosts"))
    near = parsed.where("host != ''").withColumn("_host", host_key(F.col("host"))).join(around, "_host").select(
        "host", "path", F.concat("hosts", F.lit("?"), "path").alias("key")).distinct()
    near = written(near, folder, "near")
    keyed = given.withColumn("key", F.concat("hosts", F.lit("?"), "path"))
    found = sweep(near, keyed.select("key"), folder, "paths").select(
        F.col("key").alias("_point"), F.try_element_at("active", F.lit(-1)).alias("key"))
    fitting = near.withColumnRenamed("key", "_point").join(found, "_point").join(
        keyed.select("key", F.concat("host", "path").alias("rule"), F.length("host").alias("n"), "verdict"), "key")
    best = fitting.groupBy("host", "path").agg(F.max(F.struct(F.length("rule").alias("size"), "n", "rule", "verdict")).alias("b"))
    return parsed.join(best, ["host", "path"], "left").select(
        "url", "host", "path", F.col("b.rule").alias("rule"), F.coalesce("b.verdict", F.lit(default)).alias("verdict"))


def filter_pages(pages: DataFrame, rules: DataFrame, default: str = "allow", url_col: str = "url") -> DataFrame:
    """``pages`` with host, path, rule and verdict of ``url_col`` as columns _host, _path, _rule, _verdict.

    A name that the table has already gets more underscores in front.
    """
    own = fresh(pages, "_url")
    judged = judge(pages.select(F.col(url_col).cast("string").alias("url")), rules, default).select(
        F.col("url").alias(own), *[F.col(c).alias(fresh(pages, f"_{c}")) for c in ("host", "path", "rule", "verdict")])
    return pages.join(judged, F.col(url_col).eqNullSafe(F.col(own)), "left").drop(own)
