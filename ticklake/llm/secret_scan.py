"""Secret scans with an incremental blob ledger, in DataFrame operations.

Every version of a text is a blob named by its SHA-256. The ledger holds one
row for each scanned pair of blob and rule version, findings included. A run
keeps the blobs that the ledger has not seen under the current rule version,
scans each of them once, appends them to the ledger, and joins the findings
back to every row (path) that has the blob.

Rules (assign, access, hex) are leftmost matches that do not overlap within a
kind; matches that are too short are dropped after matching. Positions are
code points, end exclusive: the pieces between matches and the matches
themselves are measured, so no Python is needed.

A null text counts as empty and has no findings. Repeated rows share a blob and
get its findings each; rows without an id are scanned like others. An empty
table gives an empty result. Only the id and the text are read.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ticklake.llm.common import scratch, stored

#: Bump when a rule changes: blobs are scanned again under the new version.
RULE_VERSION = "base-1"


def either_case(word: str) -> str:
    return "".join(f"[{c.lower()}{c.upper()}]" if c.isalpha() else c for c in word)


# The rules as given (kind, pattern, group that is measured, least characters).
ASSIGN = ("(" + "|".join(map(either_case, ("password", "passwd", "secret", "token", "api_?key")))
          + r""")["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
RULES = (("assign", ASSIGN, 2, 12), ("access", "AKIA[A-Z0-9]+", 0, 18), ("hex", "[0-9a-f]+", 0, 16))
#: What a text must have somewhere for a rule to find something: plain, and quick to refute.
NEEDS = {"assign": "[:=]", "access": "AKIA", "hex": "[0-9a-f]{16}"}
FOUND = "array<struct<start:int,rank:int,kind:string,end:int>>"


def _spans(text: Column, rank: int, kind: str, pattern: str, group: int, least: int) -> Column:
    """The rule's spans in one text, as FOUND."""
    gaps = F.transform(F.split(text, pattern, -1), F.length)
    whole = F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.length)
    size = F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(group)), F.length) if group else whole
    # Walk over (gap, match, measured) with the position and the spans so far.
    steps = F.arrays_zip(gaps.alias("gap"), whole.alias("len"), size.alias("size"))
    start = F.struct(F.lit(0).alias("at"), F.array().cast(FOUND).alias("found"))

    def step(acc, x):
        begin = acc["at"] + x["gap"]
        end = begin + F.coalesce(x["len"], F.lit(0))
        span = F.struct(begin.alias("start"), F.lit(rank).alias("rank"), F.lit(kind).alias("kind"), end.alias("end"))
        return F.struct(end.alias("at"), F.when(x["size"] >= least, F.concat(acc["found"], F.array(span)))
                        .otherwise(acc["found"]).alias("found"))

    spans = F.aggregate(steps, start, step, lambda acc: acc["found"])
    return F.when(text.rlike(NEEDS[kind]), spans).otherwise(F.array().cast(FOUND))


def scan(blobs: DataFrame) -> DataFrame:
    """(blob, spans) of (blob, text); spans sorted by start, then kind as listed."""
    spans = F.array_sort(F.concat(*[_spans(F.col("text"), k, *r) for k, r in enumerate(RULES)]))
    return blobs.select("blob", spans.alias("spans"))


def read_ledger(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e) or "UNABLE_TO_INFER_SCHEMA" in str(e):
            return None
        raise


def scan_incremental(docs: DataFrame, ledger: str, id_col: str = "doc_id", text_col: str = "text",
                     version: str = RULE_VERSION) -> DataFrame:
    """(id, blob, spans) of every row, after scanning what the ledger at path ``ledger`` lacks."""
    spark = docs.sparkSession
    blob = F.sha2(F.coalesce(F.col(text_col), F.lit("")), 256).alias("blob")
    paths = stored(docs.select(F.col(id_col).alias("id"), blob), "secret-paths")
    # One carrier row for each blob: its text is scanned, copies are not.
    carriers = paths.groupBy("blob").agg(F.min("id").alias("id"))
    known = read_ledger(spark, ledger)
    if known is not None:
        carriers = carriers.join(known.filter(F.col("version") == version).select("blob"), "blob", "left_anti")
    texts = docs.select(F.col(id_col).alias("id"), blob, F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    same = (texts["blob"] == carriers["blob"]) & texts["id"].eqNullSafe(carriers["id"])
    found = scan(texts.join(carriers, same, "left_semi"))
    # Rows repeated under one id carry one blob: spans are equal, any of them will do.
    found = found.groupBy("blob").agg(F.first("spans").alias("spans")).withColumn("version", F.lit(version))
    found.write.mode("append").parquet(ledger)
    ledger_rows = spark.read.parquet(ledger).filter(F.col("version") == version)
    # Two runs at once may both have scanned a blob.
    hits = ledger_rows.filter(F.size("spans") > 0).groupBy("blob").agg(F.first("spans").alias("spans"))
    return paths.join(hits, "blob", "left").select(
        F.col("id").alias(id_col), "blob", F.coalesce("spans", F.array().cast(FOUND)).alias("spans"))


def secret_scan(docs: DataFrame, ledger: str) -> DataFrame:
    """The findings of each row as counts and joined spans."""
    rows = scan_incremental(docs, ledger)

    def number(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    joined = F.array_join(F.transform("spans", lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    return rows.select("doc_id", *[number(kind) for kind, *_ in RULES],
                       F.sha2(joined, 256).alias("base_sha256"), joined.alias("spans"))


def op1_secret_scan(spark, sf_dir: str) -> DataFrame:
    from ticklake.llm.common import table
    return secret_scan(table(spark, sf_dir, "documents"), scratch(spark, "secret-ledger"))


def _sql_spans(k: int, kind: str, pattern: str, group: int, least: int) -> str:
    """SELECT of doc_id, start, rank, kind, end by positions of split pieces."""
    p = pattern.replace("'", "''")
    return f"""
SELECT doc_id, s AS start, {k} AS rank, '{kind}' AS kind, s + m AS stop FROM (
  SELECT doc_id, list_sum(gaps[:i])::BIGINT + coalesce(list_sum(lens[:i-1]), 0)::BIGINT AS s, lens[i] AS m, sizes[i] AS z
  FROM (SELECT doc_id,
          list_transform(string_split_regex(t, '{p}'), lambda x: length(x)) AS gaps,
          list_transform(regexp_extract_all(t, '{p}', 0), lambda x: length(x)) AS lens,
          list_transform(regexp_extract_all(t, '{p}', {group}), lambda x: length(x)) AS sizes
        FROM d), range(1, len(lens) + 1) r(i)
) WHERE z >= {least}"""


ORACLE = ("WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents), f AS ("
          + " UNION ALL ".join(_sql_spans(k, *r) for k, r in enumerate(RULES)) + """),
g AS (SELECT doc_id, count(*) FILTER (rank = 0) AS n_assign, count(*) FILTER (rank = 1) AS n_access,
        count(*) FILTER (rank = 2) AS n_hex,
        string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, rank) AS spans FROM f GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(spans, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN g USING (doc_id)""")
