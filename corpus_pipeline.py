"""A training corpus from raw documents: five stages, each written and read by the next.

Each stage takes (spark, docs, sf_dir), works on every row that its predecessor
kept, and returns the columns of documents; the last one adds those of the mix.
A stage's result must be written before the next stage is called: that call
removes the scratch tables of the stages before it. ``run`` writes its result
outside of these, so it stays readable whatever runs later.
"""

from __future__ import annotations

from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticklake.llm import decontaminate, exact_dedup, jaccard_join, language_id, mixing
from ticklake.llm.common import RID, keep_rows, noted, remove, stored, table, with_row_id

#: A document whose language is less certain than this is rejected, as is one without letters.
MIN_SCORE = 0.5
#: Scratch tables of the latest stage.
_LEFT: list[str] = []


def stage(run):
    """A stage that first removes what the stages before left in scratch."""
    @wraps(run)
    def tidy(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        remove(spark, _LEFT)
        with noted(_LEFT):
            return run(spark, docs, sf_dir)
    return tidy


@stage
def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told apart: not ``und``, and with a calibrated score of MIN_SCORE at least."""
    rows = with_row_id(docs, "pipeline-language")
    found = language_id.language_id(rows, row_id=RID)
    return keep_rows(rows, found.filter((F.col("lang_pred") != "und") & (F.col("score") >= MIN_SCORE)))


@stage
def no_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the one that exact dedup keeps."""
    rows = with_row_id(docs, "pipeline-exact")
    return keep_rows(rows, exact_dedup.exact_dedup(rows, row_id=RID).filter("kept"))


@stage
def no_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest id."""
    rows = with_row_id(docs, "pipeline-near")
    groups = jaccard_join.jaccard_join(rows, id_col=RID).join(rows.select(RID, "doc_id"), RID)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", RID)).alias("first")
    return keep_rows(rows, groups.groupBy("component_id").agg(first).select(f"first.{RID}"))


@stage
def no_benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item."""
    rows = with_row_id(docs, "pipeline-benchmark")
    found = decontaminate.contaminated(rows, table(spark, sf_dir, "benchmark"))
    return rows.join(found.select(RID).distinct(), RID, "left_anti").drop(RID)


@stage
def target_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The taken copies of the documents, with domain, n_tokens, epoch and the budget of their leaf."""
    rows = with_row_id(docs, "pipeline-mix")
    taken = mixing.mix(rows, row_id=RID).select(RID, "domain", "n_tokens", "epoch", "budget")
    return rows.join(taken, RID).drop(RID)


STAGES = [
    ("language_id", known_language),
    ("exact_dedup", no_exact_copies),
    ("jaccard_join", no_near_copies),
    ("decontaminate", no_benchmark_passages),
    ("mixing", target_mix),
]

#: Language ID is a trained model, which SQL cannot express; the test compares every later stage with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pipeline over documents."""
    docs = table(spark, sf_dir, "documents")
    between: list[str] = []
    for name, step in STAGES:
        out = step(spark, docs, sf_dir)
        with noted(between if name != STAGES[-1][0] else []):
            docs = stored(out, f"pipeline-{name}-out")
    remove(spark, _LEFT)
    remove(spark, between)
    return docs
