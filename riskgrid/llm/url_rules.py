"""URL filters by a sort-merge range join (operator 7).

A host's canonical key is its labels reversed, each closed by "/", which no
host can contain: ``a.example.org`` is ``org/example/a/``.  A rule's host and
all its subdomains are then the keys that start with the rule's key: one
interval of the sorted order, and two intervals nest or are apart.

Distinct hosts are range-partitioned in key order and written with their
partition number, so the partitions stay put when a task is repeated.  Rules go
to the partition their key falls into, and each partition also gets the last
rule that opens before it.  The sweep is a window over the sorted partition:
the last rule opened brings its chain (itself and the rules around it, the
stack at its opening), and the rules of the chain whose interval the host has
already left are popped.  That leaves the active rules of every host; the pages
join them on the host, and the longest rule whose path starts the url's path
wins.

Work per url is the number of rules nested around its host.  Pages are never
sorted or grouped: a hot host is one row in the sweep, and in the join back its
pages can be split over tasks.

Null urls and urls without ``://`` have an empty host and path.  Null ids and
repeated rows each get their row.  Rules may be empty; then the default verdict
holds.  Only DataFrame functions are used, and only the id and url columns read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut_lineage, shuffle_partitions

# fixed values: the rules of the result contract (host, path, verdict)
RULES = (
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
)
_RULE = "struct<key:string,path:string,name:string,verdict:string>"
_LOWER = ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def host_and_path(url: Column) -> tuple[Column, Column]:
    rest = F.coalesce(F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1), F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), *_LOWER)
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def host_key(host: Column) -> Column:
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.", -1)), "/"), F.lit("/"))


def _with_chains(rules: DataFrame) -> DataFrame:
    """(key, chain): per rule host, the rules of that host and of all hosts
    around it.  Every rule host looks up its own suffixes, an equi-join."""
    own = rules.groupBy("key").agg(F.collect_set(F.struct("key", "path", "name", "verdict")).alias("own"))
    n = F.size(F.split("key", "/")) - 1
    around = (own.select("key", F.explode(F.transform(
        F.sequence(F.lit(1), n), lambda i: F.concat(F.call_function("substring_index", F.col("key"), F.lit("/"), i), F.lit("/")))).alias("outer")))
    return (around.join(own.select(F.col("key").alias("outer"), "own"), "outer")
            .groupBy("key").agg(F.flatten(F.collect_list("own")).alias("chain")))


def active_rules(hosts: DataFrame, rules: DataFrame) -> DataFrame:
    """(host, active): the rules whose interval holds the host's key.

    ``hosts`` has distinct ``host`` values; ``rules`` has key, path, name and
    verdict.
    """
    parts = shuffle_partitions(hosts.sparkSession)
    placed = cut_lineage(hosts.withColumn("key", host_key(F.col("host"))).repartitionByRange(parts, "key")
                         .withColumn("part", F.spark_partition_id()))
    # the smallest key of each range partition: one short string per partition
    bounds = [(r["key"], r["part"]) for r in placed.groupBy("part").agg(F.min("key").alias("key")).sort("key").collect()]
    chains = cut_lineage(_with_chains(rules))
    if not bounds:
        return hosts.select("host", F.array().cast(f"array<{_RULE}>").alias("active"))
    lows, ids = (F.array(*[F.lit(x) for x in col]) for col in zip(*bounds))
    spot = F.greatest(F.size(F.filter(lows, lambda x: x <= F.col("key"))), F.lit(1))
    opening = chains.select(F.element_at(ids, spot).alias("part"), "key", "chain", F.lit(None).cast("string").alias("host"))
    # each partition starts with the last rule that opens before it: a window
    # over one row per partition
    last = chains.select(spot.alias("spot"), "key", "chain").groupBy("spot").agg(F.max_by("chain", "key").alias("chain"))
    earlier = Window.orderBy("spot").rowsBetween(Window.unboundedPreceding, -1)
    carried = (hosts.sparkSession.createDataFrame([(i + 1, p) for i, (_, p) in enumerate(bounds)], "spot int, part int")
               .join(last, "spot", "left").withColumn("chain", F.last("chain", ignorenulls=True).over(earlier))
               .filter("chain is not null")
               .select("part", F.lit("").alias("key"), "chain", F.lit(None).cast("string").alias("host")))
    events = (placed.select("part", "key", F.lit(None).cast(f"array<{_RULE}>").alias("chain"), "host")
              .unionByName(opening).unionByName(carried))
    sweep = Window.partitionBy("part").orderBy("key", F.col("host").isNotNull())
    stack = F.last("chain", ignorenulls=True).over(sweep.rowsBetween(Window.unboundedPreceding, 0))
    return (events.withColumn("stack", stack).filter("host is not null")
            .select("host", F.coalesce(F.filter("stack", lambda r: F.startswith(F.col("key"), r["key"])),
                                       F.array().cast(f"array<{_RULE}>")).alias("active")))


def rule_table(spark, rules: Sequence[tuple[str, str, str]]) -> DataFrame:
    table = spark.createDataFrame(list(rules), "host string, path string, verdict string")
    host = F.translate("host", *_LOWER)
    return table.select(host_key(host).alias("key"), "path", F.concat(host, F.col("path")).alias("name"), "verdict")


def judge_urls(pages: DataFrame, rules: Sequence[tuple[str, str, str]] | DataFrame = RULES, id_col: str = "page_id",
               url_col: str = "url", default: str = "allow") -> DataFrame:
    """(id, host, path, rule, verdict) for every row of ``pages``."""
    spark = pages.sparkSession
    rules = rules if isinstance(rules, DataFrame) else rule_table(spark, rules)
    host, path = host_and_path(F.col(url_col))
    rows = pages.select(F.col(id_col).alias("id"), host.alias("host"), path.alias("path"))
    active = cut_lineage(active_rules(rows.select("host").distinct(), rules))
    fits = F.filter("active", lambda r: F.startswith(F.col("path"), r["path"]))
    best = F.array_max(F.transform(fits, lambda r: F.struct(
        F.length(r["name"]).alias("n"), F.length(r["key"]).alias("k"), r["name"].alias("name"), r["verdict"].alias("verdict"))))
    return (rows.join(active, "host").withColumn("best", best)
            .select(F.col("id").alias(id_col), "host", "path", F.col("best.name").alias("rule"),
                    F.coalesce("best.verdict", F.lit(default)).alias("verdict")))


ORACLE = r"""
WITH rules(rhost, rpath, rverdict) AS (VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'),
  ('example.org', '/en/1', 'block'), ('com', '/fr/', 'allow'), ('com', '/de/', 'block')),
rest AS (SELECT page_id, CASE WHEN position('://' IN url) > 0 THEN substr(url, position('://' IN url) + 3) ELSE '' END AS r
         FROM pages),
parts AS (SELECT page_id, row_number() OVER () AS rid,
    translate(regexp_extract(coalesce(r, ''), '^[^/?#]*', 0), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(coalesce(r, ''), '^[^/?#]*([^?#]*)', 1) AS path FROM rest),
hit AS (SELECT rid, arg_max(rhost || rpath, length(rhost || rpath)) AS rule, arg_max(rverdict, length(rhost || rpath)) AS verdict
  FROM parts JOIN rules ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath) GROUP BY rid)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM parts LEFT JOIN hit USING (rid)
"""
