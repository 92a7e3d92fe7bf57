"""URL rules as a sort-merge range join with a stack of nested active rules.

The key of a host is its labels in reverse order, each closed by a space, so a rule's host
covers exactly the keys that start with its own key: an interval of the sort order.  Urls
are range-partitioned by key, a busy host over several partitions; each rule goes to the
partitions whose keys meet its interval.  One sorted sweep per partition keeps the stack
of rules whose interval holds the current key, and the longest rule on it (host, then
path) whose path the url's path starts with decides.

Null urls and urls without ``://`` have an empty host and path and fit no rule.  Urls that
no rule fits get the default verdict.  Of rules with equal host and path, the first verdict
in text order holds.  Repeated urls are each judged; an empty rule table decides nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import add_columns
from tessera.session import stage

HOST_RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Follows the space that closes a label and precedes every character of a label.
_AFTER = "!"


def host_and_path(url: Column) -> tuple[Column, Column]:
    rest = F.when(F.instr(url, "://") > 0, F.expr("substring(__url, instr(__url, '://') + 3)")).otherwise("")
    host = F.translate(F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1), _UPPER, _LOWER)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def host_key(host: Column) -> Column:
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), " "), F.lit(" "))


def judge(pages: DataFrame, rules: DataFrame, url: str = "url", default: str = "allow") -> DataFrame:
    """Add ``host``, ``path``, ``rule`` and ``verdict``; ``rules`` has host, path and verdict."""
    spark = pages.sparkSession
    added = ("host", "path", "rule", "verdict")
    kept = pages.select(F.col(url).alias("__url"), F.struct(*[c for c in pages.columns if c not in added]).alias("__row"))
    host, path = host_and_path(F.col("__url"))
    keyed = kept.select("__row", host.alias("__host"), path.alias("__path"))
    keyed = keyed.withColumn("__key", host_key(F.col("__host"))).withColumn("__salt", F.xxhash64("__row"))
    placed = keyed.repartitionByRange("__key", "__salt").withColumn("__part", F.spark_partition_id())
    placed = stage(placed, "urls")
    # one row per partition: the first and the last key
    ends = placed.groupBy("__part").agg(F.min("__key").alias("first"), F.max("__key").alias("last")).collect()
    ends.sort(key=lambda r: r["__part"])
    spans = F.array(*[F.struct(F.lit(r[0]).alias("part"), F.lit(r[1]).alias("first"), F.lit(r[2]).alias("last")) for r in ends])
    rule_key = host_key(F.translate("host", _UPPER, _LOWER))
    rules = rules.where("host is not null and path is not null and verdict is not null")
    opened = rules.groupBy("host", "path").agg(F.min("verdict").alias("verdict")).withColumn("__key", rule_key)
    if ends:
        opened = opened.withColumn("__span", F.explode(spans)).where(
            (F.col("__key") <= F.col("__span.last")) & (F.col("__span.first") < F.concat(F.expr("rtrim(__key)"), F.lit(_AFTER)))
        )
    else:
        opened = opened.withColumn("__span", F.lit(None).cast("struct<part:int,first:string,last:string>")).where("false")
    events = opened.select(
        F.col("__span.part").alias("part"),
        F.col("__key").alias("key"),
        F.lit(0).alias("kind"),
        "host",
        "path",
        "verdict",
        F.monotonically_increasing_id().alias("n"),
    )
    numbered = placed.withColumn("n", F.monotonically_increasing_id())
    urls = numbered.select(
        F.col("__part").alias("part"), F.col("__key").alias("key"), F.lit(1).alias("kind"),
        F.col("__host").alias("host"), F.col("__path").alias("path"), F.lit(None).cast("string").alias("verdict"), "n", "__row",
    )
    events = events.withColumn("__row", F.lit(None).cast(urls.schema["__row"].dataType))
    both = events.unionByName(urls).repartition(max(1, len(ends)), "part").sortWithinPartitions("part", "key", "kind")

    def make():
        state = {"part": None, "stack": []}

        def sweep(parts, keys, kinds, hosts, paths, verdicts):
            out = []
            for part, key, kind, h, p, v in zip(parts, keys, kinds, hosts, paths, verdicts):
                stack = state["stack"]
                if part != state["part"]:
                    state["part"] = part
                    stack.clear()
                while stack and not key.startswith(stack[-1][0]):
                    stack.pop()  # the interval of this rule has ended
                if kind == 0:
                    if not stack or stack[-1][0] != key:
                        stack.append((key, []))
                    stack[-1][1].append((len(p), p, h + p, v))
                    out.append((None, None))
                    continue
                best = None
                for _, entries in reversed(stack):  # the innermost host first
                    fitting = [e for e in entries if p.startswith(e[1])]
                    if fitting:
                        best = max(fitting)
                        break
                out.append((best[2], best[3]) if best else (None, default))
            return out

        return sweep

    judged = add_columns(both.withColumnRenamed("verdict", "given"), "rule string, verdict string", make, "part", "key", "kind", "host", "path", "given")
    return judged.where("kind = 1").select("__row.*", "host", "path", "rule", "verdict")


def default_rules(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(HOST_RULES, "host string, path string, verdict string")


def op9_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    return judge(pages, default_rules(spark)).drop("url")


OP9_SQL = r"""
WITH p AS (
  SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
), s AS (
  SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM p
), r(h, q, v) AS (
  VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')
), f AS (
  SELECT page_id, arg_max(h || q, length(h) * 1000 + length(q)) AS rule, arg_max(v, length(h) * 1000 + length(q)) AS verdict
  FROM s JOIN r ON (host = h OR host LIKE '%.' || h) AND starts_with(path, q) GROUP BY page_id
)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM s LEFT JOIN f USING (page_id)
"""
