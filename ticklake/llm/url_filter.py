"""URL filters as a sort-merge range join, in DataFrame operations.

Canonical keys turn prefixes into intervals. A rule (host, path) becomes
``reversed labels # path``, labels joined by ``?``: example.com/en/ is
``com?example#/en/`` (no host or path can hold either mark), and every key that begins so lies between that string and the same string with the last
code point of all appended. A URL has one key for each suffix of its host
(www.example.com, example.com, com), each with its path, so that a host rule
reaches subdomains; the labels of a host bound their number. Rules of one key
space nest or are disjoint. Rule openings, rule closings and URL keys are
sorted together, and a sweep keeps the stack of the rules that are open: the
top of the stack at a URL key is its longest rule for that host suffix. The
longest rule over a URL's keys wins (longer host first, then longer path).

The sort is a range partitioning with the page as its last key, so one URL
that a third of all pages share is still spread over tasks. The sweep runs
within each partition; what is open where a partition begins comes from the
partitions before it, through one row per partition.

A null URL, or one without ``://``, has an empty host and path and matches no
rule. A URL without a rule gets ``DEFAULT_VERDICT``. An empty path fits no rule
whose path is ``/``. Of rules given twice the first by verdict counts. Repeated
and null page ids are judged like others. An empty table gives an empty
result. Only the id and the URL are read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ticklake.llm.common import RID, stored

DEFAULT_VERDICT = "allow"
# The rules as given (verdict, host, path).
RULES = (("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"),
         ("block", "net", "/es/"), ("block", "net", "/fr/"))
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Sorts after every string that continues a key; in keys it and the code point before it are written as two.
LAST, BEFORE_LAST = "\U0010ffff", "\U0010fffe"


def split_url(url):
    """(host, path) columns."""
    has = F.coalesce(F.instr(url, "://") > 0, F.lit(False))
    rest = F.substring_index(F.substring_index(F.substr(url, F.instr(url, "://") + F.lit(3)), "#", 1), "?", 1)
    host = F.translate(F.substring_index(rest, "/", 1), UPPER, LOWER)
    path = F.substr(rest, F.length(F.substring_index(rest, "/", 1)) + F.lit(1))
    return F.when(has, host).otherwise(F.lit("")), F.when(has, path).otherwise(F.lit(""))


def interval_key(labels, path):
    """The canonical key of reversed host labels and a path; it does not contain LAST."""
    key = F.concat(F.array_join(labels, "?"), F.lit("#"), path)
    return F.replace(F.replace(key, F.lit(BEFORE_LAST), F.lit(BEFORE_LAST + "0")), F.lit(LAST), F.lit(BEFORE_LAST + "1"))


def rule_intervals(rules: DataFrame) -> DataFrame:
    """(key, close, rule, verdict, host_len, path_len) of (verdict, host, path): a rule is open in [key, close)."""
    key = interval_key(F.reverse(F.split("host", r"\.")), F.col("path"))
    return (rules.select(key.alias("key"), F.concat("host", "path").alias("rule"), "verdict",
                         F.length("host").alias("host_len"), F.length("path").alias("path_len"))
            .groupBy("key").agg(F.min(F.struct("verdict", "rule", "host_len", "path_len")).alias("r"))
            .select("key", F.concat("key", F.lit(LAST)).alias("close"), "r.*"))


def sweep(events: DataFrame, n: int) -> DataFrame:
    """The top of the stack of open rules at each URL key.

    ``events``: key, kind (0 a rule closes, 1 a rule opens, 2 a URL key), rule
    columns as struct ``r``, page row id, and for a rule the struct ``under`` of
    the rule that encloses it. After an opening the top is the rule, after a
    closing it is the rule beneath; a URL key takes the last such event.
    """
    ranged = events.repartitionByRange(n, "key", "kind", F.coalesce(RID, F.lit(-1)))
    ranged = stored(ranged.withColumn("part", F.spark_partition_id()), "url-sweep")
    top = F.when(F.col("kind") == 1, F.struct(F.lit(True).alias("set"), F.col("r"))).when(
        F.col("kind") == 0, F.struct(F.lit(True).alias("set"), F.col("under").alias("r")))
    marks = ranged.filter("kind < 2").withColumn("top", top)
    # One row per partition that has a rule event: what is on top after it.
    last = marks.groupBy("part").agg(F.max(F.struct("key", "kind", "top")).alias("last")).select("part", "last.top")
    parts = ranged.select("part").distinct().join(last, "part", "left")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    carried = parts.select("part", F.last("top", ignorenulls=True).over(before).alias("carried"))
    here = Window.partitionBy("part").orderBy("key", "kind").rowsBetween(Window.unboundedPreceding, 0)
    found = ranged.withColumn("top", F.last(top, ignorenulls=True).over(here)).filter("kind = 2")
    return found.join(carried, "part").select(RID, F.coalesce("top", "carried")["r"].alias("r"))


def url_filter(pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """id, host, path, rule, verdict of every row of ``pages``."""
    spark = pages.sparkSession
    host, path = split_url(F.col(url_col))
    urls = stored(pages.select(F.monotonically_increasing_id().alias(RID), F.col(id_col).alias("id"),
                               host.alias("host"), path.alias("path")), "url-rows")
    boxes = stored(rule_intervals(rules), "url-rules")
    r = F.struct("verdict", "rule", "host_len", "path_len")
    plain = boxes.select("key", "close", r.alias("r"))
    # The rule that encloses each rule, found by the same nesting: its longest proper prefix among the rules.
    lengths = F.transform(F.sequence(F.lit(1), F.length("key") - 1), lambda k: k)
    shorter = plain.select("key", F.explode(F.when(F.length("key") > 1, lengths)).alias("k"))
    shorter = shorter.select(F.col("key").alias("inner"), F.substr("key", F.lit(1), F.col("k")).alias("outer"))
    outer = plain.select(F.col("key").alias("outer"), F.col("r").alias("outer_r"))
    under = shorter.join(outer, "outer").groupBy("inner").agg(
        F.max(F.struct(F.length("outer").alias("n"), F.col("outer_r").alias("r")))["r"].alias("under"))
    plain = plain.join(under, plain["key"] == under["inner"], "left").drop("inner")
    none = F.lit(None).cast(boxes.select(r.alias("r")).schema["r"].dataType)
    no_row = F.lit(None).cast("long").alias(RID)
    opens = plain.select("key", F.lit(1).alias("kind"), "r", "under", no_row)
    closes = plain.select(F.col("close").alias("key"), F.lit(0).alias("kind"), "r", "under", no_row)
    labels = F.reverse(F.split("host", r"\."))
    points = urls.filter("host <> ''").select(RID, "path", labels.alias("labels")).select(
        RID, "path", "labels", F.explode(F.sequence(F.lit(1), F.size("labels"))).alias("n"))
    points = points.select(interval_key(F.slice("labels", 1, F.col("n")), F.col("path")).alias("key"),
                           F.lit(2).alias("kind"), none.alias("r"), none.alias("under"), RID)
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    hits = sweep(opens.unionByName(closes).unionByName(points), n).filter("r is not null")
    best = hits.groupBy(RID).agg(F.max(F.struct("r.host_len", "r.path_len", "r.rule", "r.verdict")).alias("b"))
    return urls.join(best, RID, "left").select(
        F.col("id").alias(id_col), "host", "path", F.col("b.rule").alias("rule"),
        F.coalesce("b.verdict", F.lit(DEFAULT_VERDICT)).alias("verdict"))


def op6_url_filter(spark, sf_dir: str) -> DataFrame:
    from ticklake.llm.common import table
    return url_filter(table(spark, sf_dir, "pages"), spark.createDataFrame(RULES, "verdict string, host string, path string"))


ORACLE = r"""
WITH u AS (SELECT page_id, CASE WHEN contains(url, '://') THEN regexp_extract(substr(url, position('://' IN url) + 3), '^[^?#]*') ELSE '' END AS rest
           FROM pages),
h AS (SELECT page_id, translate(regexp_extract(rest, '^[^/]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
             regexp_extract(rest, '/.*$', 0, 's') AS path FROM u),
r(verdict, rh, rp) AS (VALUES """ + ", ".join(f"('{v}', '{h}', '{p}')" for v, h, p in RULES) + """),
m AS (SELECT page_id, arg_max(rh || rp, length(rh) * 1000 + length(rp)) AS rule, arg_max(verdict, length(rh) * 1000 + length(rp)) AS verdict
      FROM h JOIN r ON (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp) GROUP BY page_id)
SELECT page_id, coalesce(host, '') AS host, coalesce(path, '') AS path, rule, coalesce(verdict, 'allow') AS verdict
FROM h LEFT JOIN m USING (page_id)
"""
