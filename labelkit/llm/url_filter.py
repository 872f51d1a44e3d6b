"""URL rules by a sort-merge range join, with DataFrame expressions only.

A host is keyed by its labels in reverse, each followed by a dot
(``www.example.net`` is ``net.example.www.``), so a rule's host and all its
subdomains are the keys with one prefix: an interval in sort order.  Such
intervals nest or are disjoint.  A sweep over the sorted keys therefore needs
a stack only: at a key, the rules that are open are among the last rule that
began and the rules around it.

Each rule carries its stack (the prefixes around it, itself included), found
by the same sweep over the rules.  Points and rules are range-partitioned on
the key, the last rule before each partition is carried in, and a window per
partition hands every point the last rule that began at or before it; the
open ones are those on its stack that are a prefix of the point's key.  Equal
keys may be spread over partitions (a random second sort key), so a host with
a third of all rows is no hot spot.

Two sweeps are made: over hosts, then over host key + path for the rules of
the open hosts.  The rule with the longest host wins, then the longest path.

Defined cases: a null url, or one without ``://``, has an empty host and path
and meets no rule; ties (a rule given twice with different actions) go to
block; null rule hosts or paths never match; empty tables are fine.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from labelkit.llm.common import LOWER, UPPER, named, written

#: The standing rules (action, host, path).
RULES = (
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
)


def rule_table(spark: SparkSession, rules: Sequence[tuple[str, str, str]] = RULES) -> DataFrame:
    def quote(s: str) -> str:
        return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"

    if not rules:
        return spark.sql("select '' as action, '' as host, '' as path where false")
    rows = ", ".join("(" + ", ".join(map(quote, r)) + ")" for r in rules)
    return spark.sql(f"select * from values {rows} as rules(action, host, path)")


def host_and_path(url: Column) -> tuple[Column, Column]:
    """The text after the first ``://`` up to ``/ ? #`` (A-Z lower-cased), and from there up to ``? #``."""
    text = F.coalesce(url, F.lit(""))
    at = F.instr(text, "://")
    rest = F.when(at > 0, F.substr(text, at + F.lit(3))).otherwise(F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), UPPER, LOWER)
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def host_key(host: Column) -> Column:
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.", -1)), "."), F.lit("."))


def with_stacks(keyed: DataFrame) -> DataFrame:
    """key, stack: per distinct key the rows (key, ...) whose key is a prefix of it, shortest first."""
    entry = F.struct(*[F.col(c) for c in keyed.columns])
    entries = keyed.select(F.col("key").alias("prefix"), entry.alias("entry"))
    lengths = F.explode(F.sequence(F.lit(1), F.length("key")))
    prefixes = keyed.select("key", lengths.alias("n")).select("key", F.substring("key", F.lit(1), F.col("n")).alias("prefix"))
    open_at = prefixes.join(entries, "prefix").groupBy("key")
    return open_at.agg(F.array_sort(F.collect_list("entry")).alias("stack"))  # a prefix sorts first


def sweep(points: DataFrame, rules: DataFrame, name: str) -> DataFrame:
    """``points`` (id, key, ...) with ``open``: the entries of ``rules`` (key, ...; distinct keys)
    whose key is a prefix of the point's key, shortest first; null where no rule began before it."""
    begins = with_stacks(rules).select("key", F.lit(0).alias("kind"), F.lit(0).cast("bigint").alias("salt"), "stack")
    seen = points.withColumns({"kind": F.lit(1), "salt": F.xxhash64("id")})
    events = begins.unionByName(seen, allowMissingColumns=True)
    n = int(points.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    tiles = events.repartitionByRange(n, "key", "kind", "salt").withColumn("tile", F.spark_partition_id())
    tiles = written(tiles, f"sweep-{name}")
    # the last rule that began in each tile is carried into the tiles after it: one row per tile
    is_rule = F.col("kind") == 0
    closing = tiles.groupBy("tile").agg(F.max_by(F.when(is_rule, F.col("stack")), F.when(is_rule, F.col("key"))).alias("closing"))
    earlier = Window.orderBy("tile").rowsBetween(Window.unboundedPreceding, -1)
    carried = closing.select("tile", F.last("closing", ignorenulls=True).over(earlier).alias("carried"))
    inside = Window.partitionBy("tile").orderBy("key", "kind").rowsBetween(Window.unboundedPreceding, 0)
    swept = tiles.withColumn("began", F.last("stack", ignorenulls=True).over(inside)).where("kind = 1")
    swept = swept.join(F.broadcast(carried), "tile")  # as many rows as partitions
    swept = swept.withColumn("stack", F.coalesce("began", "carried"))
    swept = swept.withColumn("open", F.expr("filter(stack, e -> startswith(key, e.key))"))
    return swept.select(*points.columns, "open")


def judge_urls(
    pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url", default: str = "allow"
) -> DataFrame:
    """One row per row of ``pages``: id, host, path, rule (host + path of the winning rule), verdict."""
    host, path = host_and_path(F.col("url"))
    base = named(pages, id=id_col, url=url_col).select("id", host.alias("host"), path.alias("path"))
    rules = rules.where("host is not null and path is not null").select(
        host_key(F.translate("host", UPPER, LOWER)).alias("host_key"), "host", "path", "action"
    )
    rules = rules.groupBy("host_key", "path").agg(F.max_by(F.struct("host", "action"), F.struct("action", "host")).alias("r"))
    rules = rules.select("host_key", "path", F.concat("r.host", "path").alias("rule"), F.col("r.action").alias("action"))
    hosts = rules.select(F.col("host_key").alias("key")).distinct()
    found = sweep(base.withColumn("key", host_key(F.col("host"))), hosts, "hosts")
    found = written(
        found.select("id", "host", "path", "open", F.monotonically_increasing_id().alias("row")), "open-hosts"
    )
    # a host key ends with a dot and a path cannot hold the next host's labels, so the joint key is unambiguous
    joint = found.select(F.col("row").alias("id"), F.explode("open.key").alias("host_key"), "path")
    joint = joint.withColumn("key", F.concat("host_key", "path")).drop("path")
    keyed = rules.select(F.concat("host_key", "path").alias("key"), "rule", "action")
    met = sweep(joint, keyed, "paths").where("size(open) > 0")
    best = met.groupBy("id").agg(F.max_by(F.expr("element_at(open, -1)"), F.length("host_key")).alias("best"))
    best = best.select(F.col("id").alias("row"), F.col("best.rule").alias("rule"), F.col("best.action").alias("action"))
    return found.join(best, "row", "left").select(
        "id", "host", "path", "rule", F.coalesce("action", F.lit(default)).alias("verdict")
    )
