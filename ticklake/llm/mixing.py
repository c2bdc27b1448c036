"""Mixing sources to target weights: hierarchical budgeting, in DataFrame operations.

Weights run down a tree domain - language - source. A node's capacity is the
tokens of its leaves times ``max_epochs``. From the root down, a parent's
budget is shared among its children by weight; a child that cannot use its
share is filled up and what it leaves goes to its siblings by weight. Since a
parent never gets more than its own capacity, a shortage reaches the parent's
siblings only after the children's siblings are full. Budgets are whole
tokens (rounded down), so each node loses less than one token per child.

A leaf takes its documents whole, once for each full epoch that its budget
covers, and then a token-prefix of one more epoch: documents in the order of
SHA-256 of (seed, epoch, id) while their running sum stays within the budget.
The running sum is taken over 4,096 equal ranges of the digest; only the range
in which the budget ends is summed document by document, so a source with a
third of all rows is spread over tasks. Tokens are the words between white
space.

A null language or source is the leaf value ``unknown``. A value without a
weight has ``DEFAULT_WEIGHT``. Documents without words cost nothing and are
kept as often as their leaf has epochs, the last prefix included. A null id is
ordered as an empty one; repeated rows have one place in the order and are
taken together or not at all. An empty table gives an empty result. Other
columns are not read.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ticklake.llm.common import RID, drop_space, stored

SEED = "mix-1"
MAX_EPOCHS = 3
#: Target tokens as a share of all tokens of the table.
BUDGET_PERCENT = 60
DEFAULT_WEIGHT = 5
LEVELS = ("domain", "lang", "source")
# Whole-number weights of the production mix.
WEIGHTS = {
    "domain": {"web": 35, "books": 40, "forum": 25},
    "lang": {"en": 50, "de": 20, "fr": 15, "es": 15},
    "source": {"src1": 20, "src10": 20},
}
DOMAINS = {"web": ["src0"], "books": [f"src{k}" for k in range(1, 10)]}
OTHER_DOMAIN = "forum"
#: Hexadecimal digits that name a range of the digest.
RANGE_DIGITS = 3


def words(text: Column) -> Column:
    """Number of words: each starts where white space (or the beginning) is followed by something else."""
    text = F.coalesce(text, F.lit(""))
    pieces = F.size(F.split(text, r"[\x20\x09-\x0D]+", -1))
    led = F.when(text.rlike(r"^[\x20\x09-\x0D]"), 1).otherwise(0) + F.when(text.rlike(r"[\x20\x09-\x0D]\z"), 1).otherwise(0)
    return F.when(drop_space(text) == "", 0).otherwise(pieces - led).cast("long")


def domain_of(source: Column) -> Column:
    return reduce(lambda c, kv: F.when(source.isin(kv[1]), kv[0]).otherwise(c), DOMAINS.items(), F.lit(OTHER_DOMAIN))


def weight_of(level: str, value: Column, weights: dict) -> Column:
    return reduce(lambda c, kv: F.when(value == kv[0], kv[1]).otherwise(c), weights[level].items(),
                  F.lit(DEFAULT_WEIGHT)).cast("decimal(38,0)")


def budgets(leaves: DataFrame, total: Column | int, weights: dict = WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """(domain, lang, source, tokens, budget) from (domain, lang, source, tokens).

    Children sorted by capacity over weight: those whose capacity is below their
    share of what is left are full, and they come first; the rest share by weight.
    """
    big, part = "decimal(38,0)", "decimal(18,0)"
    nodes = leaves.select("*", F.lit(0).alias("root"), (F.col("tokens") * max_epochs).cast(big).alias("cap"))
    want = total if isinstance(total, Column) else F.lit(total)
    parents = nodes.groupBy("root").agg(F.sum("cap").alias("cap"), F.sum("tokens").alias("tokens"))
    parents = parents.select("root", F.least("cap", want.cast(big)).cast(part).alias("budget"))
    for depth, level in enumerate(LEVELS):
        above = ["root", *LEVELS[:depth]]
        kids = nodes.groupBy(*above, level).agg(F.sum("cap").cast(part).alias("cap"))
        kids = kids.withColumn("w", weight_of(level, F.col(level), weights).cast(part)).filter("w > 0")
        kids = kids.withColumn("ratio", F.col("cap").cast("double") / F.col("w").cast("double")).join(parents, above)
        order = Window.partitionBy(*above).orderBy("ratio", level)
        before, after = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(0, Window.unboundedFollowing)
        taken = F.coalesce(F.sum("cap").over(before), F.lit(0))
        kids = kids.select("*", F.row_number().over(order).alias("place"), (F.col("budget") - taken).cast(part).alias("left"),
                           F.sum("w").over(after).cast(part).alias("rest"))
        # Those before the first child that is not full are full; what is left then is shared.
        is_open = F.col("cap") * F.col("rest") > F.col("left") * F.col("w")
        first = F.min(F.when(is_open, F.struct("place", "left", "rest"))).over(Window.partitionBy(*above))
        kids = kids.withColumn("first", first)
        share = F.expr("cast((first.left * w) div first.rest as decimal(18,0))")
        kids = kids.withColumn("budget", F.when(F.col("place") >= F.col("first.place"), F.least("cap", share)).otherwise(F.col("cap")))
        parents = kids.select(*above, level, "budget")
    return leaves.join(parents.drop("root"), list(LEVELS)).withColumn("budget", F.col("budget").cast("long"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: str = SEED,
        budget_percent: int = BUDGET_PERCENT, weights: dict = WEIGHTS, max_epochs: int = MAX_EPOCHS,
        row_id: str | None = None) -> DataFrame:
    """One row per taken copy: (RID), id, domain, lang, source, n_tokens, epoch, budget of the leaf."""
    lang, source = (F.coalesce(F.col(c), F.lit("unknown")) for c in ("lang", "source"))
    rows = stored(docs.select(
        (F.col(row_id) if row_id else F.monotonically_increasing_id()).alias(RID), F.col(id_col).alias("doc_id"),
        domain_of(source).alias("domain"), lang.alias("lang"), source.alias("source"),
        words(F.col(text_col)).alias("n_tokens")), "mix-rows")
    leaf = list(LEVELS)
    leaves = rows.groupBy(*leaf).agg(F.sum("n_tokens").alias("tokens"))
    wanted = F.floor(F.col("tokens") * F.lit(budget_percent).cast("long") / 100)
    plan = budgets(leaves, wanted, weights, max_epochs)
    full = F.when(F.col("tokens") > 0, F.expr("budget div tokens")).otherwise(F.lit(max_epochs)).cast("int")
    plan = plan.withColumn("full", F.least(full, F.lit(max_epochs)))
    plan = stored(plan.withColumn("left", F.col("budget") - F.col("tokens") * F.col("full")), "mix-plan")
    digest = F.sha2(F.concat_ws(":", F.lit(seed), F.col("full"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    rows = rows.join(plan.select(*leaf, "budget", "full", "left"), leaf)
    last = rows.filter(F.col("full") < max_epochs).withColumn("digest", digest)
    last = last.withColumn("range", F.substring("digest", 1, RANGE_DIGITS))
    # Running sums over ranges: at most 16 ** RANGE_DIGITS rows a leaf.
    sums = last.groupBy(*leaf, "left", "range").agg(F.sum("n_tokens").alias("t"))
    upto = Window.partitionBy(*leaf).orderBy("range").rowsBetween(Window.unboundedPreceding, 0)
    sums = sums.withColumn("before", F.sum("t").over(upto) - F.col("t")).filter("before <= left")
    last = last.join(sums.select(*leaf, "range", "before", (F.col("before") + F.col("t") <= F.col("left")).alias("inside")), [*leaf, "range"])
    run = Window.partitionBy(*leaf).orderBy("digest").rangeBetween(Window.unboundedPreceding, 0)
    edge = last.filter(~F.col("inside")).withColumn("upto", F.col("before") + F.sum("n_tokens").over(run)).filter(F.col("upto") <= F.col("left"))
    cols = [RID, "doc_id", *leaf, "n_tokens", "budget"]
    partial = last.filter("inside").select(*cols, F.col("full").alias("epoch")).unionByName(
        edge.select(*cols, F.col("full").alias("epoch")))
    whole = rows.filter("full > 0").select(*cols, F.explode(F.sequence(F.lit(0), F.col("full") - 1)).alias("epoch"))
    return whole.unionByName(partial).withColumnRenamed("doc_id", id_col)


def op8_mix_sources(spark, sf_dir: str) -> DataFrame:
    from ticklake.llm.common import table
    return mix(table(spark, sf_dir, "documents")).drop(RID)


def _case(value: str, options: dict, other) -> str:
    return "CASE " + " ".join(f"WHEN {value} = '{k}' THEN {v}" for k, v in options.items()) + f" ELSE {other} END"


def _level(depth: int) -> str:
    here = ", ".join(LEVELS[:depth + 1])
    above = ", ".join(LEVELS[:depth])
    part = f"PARTITION BY {above}" if above else ""
    level = LEVELS[depth]
    parent = f"JOIN b{depth} USING ({above})" if above else "CROSS JOIN b0"
    return f"""
k{depth} AS (SELECT {here}, sum(tokens) * {MAX_EPOCHS} AS cap, {_case(level, WEIGHTS[level], DEFAULT_WEIGHT)}::HUGEINT AS w
  FROM leaves GROUP BY {here}),
o{depth} AS (SELECT {here}, cap, w, budget,
    budget - coalesce(sum(cap) OVER ({part} ORDER BY cap::DOUBLE / w, {level} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS remaining,
    sum(w) OVER ({part} ORDER BY cap::DOUBLE / w, {level} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rest,
    row_number() OVER ({part} ORDER BY cap::DOUBLE / w, {level}) AS place
  FROM k{depth} {parent}),
p{depth} AS (SELECT *, min(CASE WHEN cap * rest > remaining * w THEN place END) OVER ({part}) AS first_open FROM o{depth}),
q{depth} AS (SELECT *, max(CASE WHEN place = first_open THEN remaining END) OVER ({part}) AS r0,
    max(CASE WHEN place = first_open THEN rest END) OVER ({part}) AS w0 FROM p{depth}),
b{depth + 1} AS (SELECT {here}, CASE WHEN place >= first_open THEN least(cap, (r0::HUGEINT * w) // w0::HUGEINT) ELSE cap END AS budget FROM q{depth})"""


ORACLE = f"""
WITH rows AS (SELECT doc_id, CASE {' '.join(f"WHEN source IN ({', '.join(repr(s) for s in v)}) THEN '{k}'" for k, v in DOMAINS.items())}
    ELSE '{OTHER_DOMAIN}' END AS domain, coalesce(lang, 'unknown') AS lang, coalesce(source, 'unknown') AS source,
    len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS n_tokens FROM documents),
leaves AS (SELECT domain, lang, source, sum(n_tokens) AS tokens FROM rows GROUP BY ALL),
b0 AS (SELECT sum(tokens)::HUGEINT * {BUDGET_PERCENT} // 100 AS budget FROM leaves),
{','.join(_level(d) for d in range(3))},
plan AS (SELECT *, CASE WHEN tokens > 0 THEN least(budget // tokens, {MAX_EPOCHS}) ELSE {MAX_EPOCHS} END AS whole
    FROM leaves JOIN b3 USING (domain, lang, source)),
placed AS (SELECT rows.*, budget, whole, budget - whole * tokens AS remaining,
    sum(n_tokens) OVER (PARTITION BY domain, lang, source ORDER BY sha256('{SEED}:' || whole::INT || ':' || doc_id)) AS upto
    FROM rows JOIN plan USING (domain, lang, source))
SELECT doc_id, domain, lang, source, n_tokens, budget::BIGINT AS budget, epoch::INT AS epoch
FROM placed, range(0, {MAX_EPOCHS}) e(epoch) WHERE epoch < whole OR epoch = whole AND upto <= remaining
"""
