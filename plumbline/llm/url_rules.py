"""URL allow and block rules by a sort-merge range join.

A rule is a host and a path. It fits a url when the url's host is the rule's host or a
subdomain of it and the url's path starts with the rule's path. The canonical key of a rule
is its host with the labels reversed, a zero byte and the path; the keys a rule fits are the
interval from its key to its key followed by 0xFF, a byte no UTF-8 text holds. A url has one
key per host suffix that is some rule's host, so no interval is missed by a subdomain.

Rule starts, rule ends and url keys are sorted together and swept; every start and end
carries the stack of rules active after it, innermost first, and a url takes the top of the
last one before it. Over the suffixes of a url the longest rule wins (host and path together,
then the longer host). A host with many urls is spread over numbered parts, each with its own
copy of that host's rules, so no host has to fit one task.

Null urls and urls without ``://`` have an empty host and path, which no rule fits. Rules with
a null host or path are ignored; of rules alike in host and path a block wins. Urls that repeat
are judged one by one. Empty tables of pages or rules are accepted; further columns are not read.
Only DataFrame functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import settle

KEYS_PER_PART = 200_000
DEFAULT = "allow"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(url, r"^(?s:.*?)://([^/?#]*)", 1), UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"^(?s:.*?)://[^/?#]*([^?#]*)", 1), F.lit(""))


def canonical_key(host: Column, path: Column) -> Column:
    reversed_host = F.array_join(F.reverse(F.split(host, r"\.", -1)), ".")
    return F.concat(reversed_host.cast("binary"), F.lit(b"\x00"), path.cast("binary"))


def _events(rules: DataFrame) -> DataFrame:
    """Starts and ends of the rules' intervals with the stack of active rules after each."""
    entry = F.struct((F.length("host") + F.length("path")).alias("size"), F.length("host").alias("host_size"),
                     F.concat("host", "path").alias("rule"), "action")
    # the rules around a rule have a shorter path of the same host: one probe per length
    probes = rules.select("host", F.col("path").alias("inner"), F.explode(F.sequence(F.lit(0), F.length("path"))).alias("n"))
    probes = probes.select("host", "inner", F.substring("inner", F.lit(1), F.col("n")).alias("path"))
    stacks = probes.join(rules.select("host", "path", entry.alias("entry")), ["host", "path"]).groupBy("host", F.col("inner").alias("path")).agg(
        F.sort_array(F.collect_list("entry"), asc=False).alias("stack"))
    keyed = stacks.withColumn("key", canonical_key(F.col("host"), F.col("path")))
    ends = keyed.select("host", F.concat("key", F.lit(b"\xff")).alias("key"), F.slice("stack", F.lit(2), F.size("stack")).alias("stack"))
    return keyed.select("host", "key", "stack").unionByName(ends)


def judge(pages: DataFrame, rules: DataFrame, default: str = DEFAULT, keys_per_part: int = KEYS_PER_PART) -> DataFrame:
    """One row per page: page_id, host, path, rule (null if none fits), verdict.

    ``pages`` has page_id and url; ``rules`` has host, path and action (allow or block).
    """
    rules = rules.filter("host is not null and path is not null").select(F.translate("host", UPPER, LOWER).alias("host"), "path", "action")
    rules = rules.groupBy("host", "path").agg(F.max("action").alias("action"))  # 'block' sorts after 'allow'
    events = settle(_events(rules), "rules")
    depth = events.agg(F.max(F.size(F.split("host", r"\.", -1)))).first()[0] or 0
    urls = pages.select("page_id", "url", F.monotonically_increasing_id().alias("row_"))
    urls = settle(urls.withColumn("host", host_of(F.col("url"))).withColumn("path", path_of(F.col("url"))).drop("url"), "urls")
    labels = F.split("host", r"\.", -1)
    suffix = F.transform(F.sequence(F.lit(1), F.least(F.size(labels), F.lit(depth))), lambda n: F.array_join(F.slice(labels, -n, n), "."))
    levels = urls.select("row_", "path", F.explode(suffix if depth else F.array().cast("array<string>")).alias("host"))
    hosts = events.select("host").distinct()
    levels = levels.join(hosts, "host", "left_semi")
    parts = levels.groupBy("host").agg(F.ceil(F.count(F.lit(1)) / keys_per_part).cast("int").alias("parts"))
    parts = settle(parts, "parts")
    keys = levels.join(parts, "host").select(
        "host", F.pmod(F.xxhash64("row_"), F.col("parts")).cast("int").alias("part"), canonical_key(F.col("host"), F.col("path")).alias("key"), "row_")
    copies = events.join(parts, "host").select("host", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), "key", "stack")
    order = Window.partitionBy("host", "part").orderBy("key", F.col("row_").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, 0)
    swept = copies.unionByName(keys, allowMissingColumns=True).withColumn("active", F.last("stack", ignorenulls=True).over(order))
    best = swept.filter("row_ is not null and size(active) > 0").groupBy("row_").agg(F.max(F.col("active")[0]).alias("best"))
    return urls.join(best, "row_", "left").select(
        "page_id", "host", "path", F.col("best.rule").alias("rule"), F.coalesce("best.action", F.lit(default)).alias("verdict"))
