"""Exact dedup by distributed MSD radix partitioning.

Texts are compared after white space is deleted. Round k looks at the next
bytes only (the radix digit): rows of one class with the same digit form a
class of the next round. A class of one row leaves, and so does a class whose
texts have ended: its rows are equal. Digits grow eightfold, so the rounds are
the logarithm of the longest text, and a unique text leaves after its first
bytes. Equality is decided on the bytes; no digest is compared. A class is a
grouped count (combined before the shuffle) joined back to its rows, so a
group with a third of all rows is never gathered into one task.

Null texts count as empty; empty texts are equal to each other. Rows without an
id are handled like others and stay behind rows with an id. Columns besides the
id and the text are not read, so their names cannot clash. An empty table gives
an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticklake.llm.common import RID, drop_space, stored

#: Bytes of the first digit; each further digit takes the text to eight times the length.
FIRST_DIGIT = 16
GROWTH = 8
#: Bytes that the first rounds read from a column of their own.
HEAD = FIRST_DIGIT * GROWTH**2


def radix_classes(rows: DataFrame) -> DataFrame:
    """(row id, class) of every row that shares its bytes with another row.

    ``rows`` has RID, head (first HEAD bytes) and tail (the rest), as stored. The
    class is the smallest row id in it.
    """
    done = []
    lo, hi = 0, FIRST_DIGIT
    alive = rows.select(RID, F.lit(0).cast("long").alias("cls"))
    first = True
    while True:
        if lo < HEAD:
            digit = F.substring("head", lo + 1, hi - lo)
            ended = F.length("head") < hi
        else:
            digit = F.substring("tail", lo - HEAD + 1, hi - lo)
            ended = F.length("tail") < hi - HEAD
        here = rows.select(RID, digit.alias("digit"), ended.alias("ended"))
        # Merged at every size: the shuffle of the digits then grows in proportion.
        here = here.withColumn("cls", F.lit(0).cast("long")) if first else alive.hint("merge").join(here, RID)
        groups = (here.groupBy("cls", "digit", "ended")
                  .agg(F.min(RID).alias("new"), F.count(F.lit(1)).alias("n"))
                  .filter("n > 1").drop("n"))
        split = here.join(groups.hint("merge"), ["cls", "digit", "ended"]).select(
            RID, F.col("new").alias("cls"), "ended")
        split = stored(split, "radix-round")
        done.append(split.filter("ended").drop("ended"))
        alive = split.filter("not ended").drop("ended")
        if alive.isEmpty():
            break
        lo, hi, first = hi, hi * GROWTH, False
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    return out


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                row_id: str | None = None) -> DataFrame:
    """One row per input row: id, keep_id, group_size, kept, text_sha256 (and RID).

    Of equal texts the one with the most code points stays, then the smallest
    id, then the first row. ``row_id`` names a stored unique column, if any.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    norm = drop_space(text).cast("binary")
    rows = docs.select(
        (F.col(row_id) if row_id else F.monotonically_increasing_id()).alias(RID),
        F.col(id_col).alias("doc_id"), F.length(text).cast("long").alias("points"), norm.alias("norm"))
    rows = stored(rows.select(
        RID, "doc_id", "points", F.sha2("norm", 256).alias("text_sha256"),
        F.substring("norm", 1, HEAD).alias("head"),
        F.substring("norm", HEAD + 1, 2**31 - 1 - HEAD).alias("tail")), "radix-rows")
    classes = radix_classes(rows)
    small = rows.select(RID, "doc_id", "points", "text_sha256").join(classes, RID, "left")
    small = small.withColumn("cls", F.coalesce("cls", RID))
    first = F.struct((-F.col("points")).alias("p"), F.col("doc_id").isNull().alias("none"),
                     F.col("doc_id"), F.col(RID))
    groups = small.groupBy("cls").agg(F.min(first).alias("first"), F.count(F.lit(1)).alias("group_size"))
    return small.join(groups, "cls").select(
        RID, F.col("doc_id").alias(id_col), F.col("first.doc_id").alias("keep_id"), "group_size",
        (F.col(RID) == F.col(f"first.{RID}")).alias("kept"), "text_sha256")


def op4_exact_dedup(spark, sf_dir: str) -> DataFrame:
    from ticklake.llm.common import table
    return exact_dedup(table(spark, sf_dir, "documents")).drop(RID)


ORACLE = r"""
WITH n AS (SELECT doc_id, length(coalesce(text, '')) AS points,
                  regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS k FROM documents),
g AS (SELECT k, count(*) AS group_size, max(points) AS points FROM n GROUP BY k),
f AS (SELECT n.k, min(doc_id) AS keep_id FROM n JOIN g USING (k, points) GROUP BY n.k)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(k) AS text_sha256
FROM n JOIN g USING (k) JOIN f USING (k)
"""
