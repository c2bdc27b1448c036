"""Benchmark decontamination by spaced-seed hashing, in DataFrame operations.

Texts are lower-cased and cut into tokens (runs of letters and digits). A mask
selects positions of a window of tokens and ignores the others; the selected
tokens are hashed. Seeds of the documents are joined with seeds of the
benchmark items under the same mask, so a substituted token at an ignored
position does not hide a hit; the masks leave a seed whole whichever places
differ, as long as they are few enough. A hit fixes how the document and the
item are aligned; the aligned tokens are then compared, and the document is
contaminated by the item if some WINDOW aligned tokens (the whole item, if it
is shorter) differ in at most a MISMATCH_PERCENT share of places.

Seeds are looked up where the documents are scanned if the benchmark's seeds
are few enough to broadcast (Spark measures them), and by a shuffle otherwise.
Only documents with a hit have their text read again. The hits of a pair are
combined before the shuffle, so an item that a third of all documents contain
makes one row for each document.

Items of fewer tokens than SPAN have masks of their own, which are only used if
the benchmark has such items. Null and empty texts contain nothing and are not
found. Items given twice are reported under each id. Rows without an id and
repeated rows are searched like others. Empty tables give an empty result. Only
ids and texts are read.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticklake.llm.common import RID, stored, with_row_id

# Two masks of eight of eleven positions; where one ignores a
# position the other uses it, at the ends excepted.
MASKS = ("11011011011", "11101110101")
SPAN = len(MASKS[0])
# More masks of eight. With MASKS, some seed is left whole by every
# choice of differing places that the share allows, for items of SPAN tokens and more.
MORE_MASKS = ("1110100100111", "111110111", "11110001111")
# The mask for items of fewer tokens, by their number; shorter ones
# than these may not differ at all and are looked up by all their tokens.
SHORT_MASKS = {10: "111011", 9: "111011", 8: "11011", 7: "11011"}
#: Aligned tokens that are verified, and the share of them that may differ.
WINDOW = 20
MISMATCH_PERCENT = 15


def tokens(text: Column) -> Column:
    cut = F.split(F.lower(text), r"[^\p{L}\p{N}]+")
    return F.filter(cut, lambda t: t != "")


def hashed(toks: Column) -> Column:
    return F.transform(toks, lambda t: F.xxhash64(t))


def seeds(rows: DataFrame, masks: list[str], *ids: str) -> DataFrame:
    """(ids, at, seed) of every window of rows (ids, h), h hashed tokens; a seed stands for its mask too."""
    ahead = [F.slice("h", k + 1, F.size("h")).alias(f"t{k}") for k in range(max(map(len, masks)))]
    each = rows.select(*ids, F.posexplode(F.arrays_zip(*ahead)).alias("at", "s"))

    def of(mask):
        places = [k for k, c in enumerate(mask) if c == "1"]
        return F.when(F.col(f"s.t{places[-1]}").isNotNull(), F.xxhash64(F.lit(mask), *[F.col(f"s.t{k}") for k in places]))

    return each.select(*ids, "at", F.explode(F.array(*[of(m) for m in masks])).alias("seed")).filter(F.col("seed").isNotNull())


def alignments(docs: DataFrame, items: DataFrame) -> DataFrame:
    """(RID, item, shift): item token j meets document token shift + j in some seed."""
    n = F.size("h")
    short = [r.n for r in items.filter(n < SPAN).select(n.alias("n")).distinct().collect()]
    # An item has seeds under its own masks only, a document under all that are in use.
    own = [(n >= SPAN, [*MASKS, *MORE_MASKS]), *[(n == k, [SHORT_MASKS.get(k, "1" * k)]) for k in short]]
    theirs = reduce(DataFrame.unionByName, [seeds(items.filter(which).select("item", "h"), masks, "item") for which, masks in own])
    theirs = theirs.withColumnRenamed("at", "item_at")
    used = list(dict.fromkeys(m for _, masks in own for m in masks))
    ours = seeds(docs.select(RID, hashed(tokens(F.col("text"))).alias("h")), used, RID)
    hits = ours.join(theirs, "seed")
    return hits.groupBy(RID, "item", (F.col("at") - F.col("item_at")).alias("shift")).agg(F.count(F.lit(1)).alias("n_seeds"))


def verify(hits: DataFrame, docs: DataFrame, items: DataFrame) -> DataFrame:
    """Alignments whose best window has few enough differences."""
    at = F.col("shift")
    n = F.size("h")
    sides = hits.join(docs.select(RID, hashed(tokens(F.col("text"))).alias("d")), RID).join(items.select("item", "h"), "item")
    same = F.transform("h", lambda t, j: F.when((at + j >= 0) & (F.get("d", F.greatest(at + j, F.lit(0))) == t), 1).otherwise(0))
    size = F.least(n, F.lit(WINDOW))
    sums = F.transform(F.sequence(F.lit(0), n - F.col("size")), lambda i: F.struct(
        F.aggregate(F.slice("same", i + 1, F.col("size")), F.lit(0), lambda a, x: a + x).alias("matched"), (-i).alias("back")))
    best = sides.select(RID, "item", "shift", "n_seeds", "h", same.alias("same"), size.alias("size"))
    best = best.select(RID, "item", "shift", "n_seeds", "size", F.array_max(sums).alias("best"))
    return best.filter((F.col("size") - F.col("best.matched")) * 100 <= F.col("size") * MISMATCH_PERCENT).select(
        RID, "item", "n_seeds", F.col("size").alias("n_tokens"), F.col("best.matched").alias("n_matched"),
        (F.col("shift") - F.col("best.back")).alias("token_at"))


def contaminated(docs: DataFrame, bench: DataFrame, text_col: str = "text", item_col: str = "item_id") -> DataFrame:
    """(RID, item, n_seeds, n_tokens, n_matched, token_at): the best alignment of each pair.

    ``docs`` has RID and is stored. ``token_at`` is the document token at which
    the verified window starts.
    """
    docs = docs.select(RID, F.col(text_col).alias("text")).filter(F.col("text").isNotNull())
    items = bench.select(F.col(item_col).alias("item"), hashed(tokens(F.col("text"))).alias("h")).filter(F.size("h") > 0)
    hits = stored(alignments(docs, items), "spaced-hits")
    found = verify(hits, docs, items)
    first = F.max(F.struct("n_matched", "n_tokens", "n_seeds", (-F.col("token_at")).alias("back"))).alias("best")
    return found.groupBy(RID, "item").agg(first).select(
        RID, "item", "best.n_seeds", "best.n_tokens", "best.n_matched", (-F.col("best.back")).alias("token_at"))


def op3_decontaminate(spark, sf_dir: str) -> DataFrame:
    """One row for each pair of a contaminated document and a benchmark item in it."""
    from ticklake.llm.common import table
    docs = with_row_id(table(spark, sf_dir, "documents").select("doc_id", "text"), "decontaminate-docs")
    found = contaminated(docs, table(spark, sf_dir, "benchmark"))
    return found.join(docs.select(RID, "doc_id"), RID).select(
        "doc_id", F.col("item").alias("item_id"), "n_seeds", "n_tokens", "n_matched", "token_at")
