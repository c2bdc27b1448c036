from collections import Counter, defaultdict

from pyspark.sql import functions as F

from ticklake.llm import mixing as mx


def fill(kids, budget):
    """Water filling: {name: (cap, weight)} -> {name: budget}, by repeated sharing among those that are not full."""
    out, rest = {}, dict(kids)
    while rest:
        w = sum(x[1] for x in rest.values())
        full = {k for k, (cap, own) in rest.items() if cap * w <= budget * own}
        if not full:
            return out | {k: min(cap, budget * own // w) for k, (cap, own) in rest.items()}
        out |= {k: rest[k][0] for k in full}
        budget -= sum(rest.pop(k)[0] for k in full)
    return out


def test_budgets(spark):
    rows = [("web", "en", "src0", 9000), ("web", "de", "src0", 10), ("books", "en", "src1", 50), ("books", "en", "src2", 500),
            ("books", "fr", "src3", 900), ("forum", "en", "src11", 4000), ("forum", "es", "src12", 0), ("forum", "unknown", "src13", 70)]
    df = spark.createDataFrame(rows, "domain string, lang string, source string, tokens long")
    for total in (0, 500, 5000, 20_000, 10**9):
        cap = {r[:3]: 3 * r[3] for r in rows}

        def down(prefix, budget):
            if len(prefix) == 3:
                return {prefix: budget}
            kids = defaultdict(int)
            for leaf, c in cap.items():
                if leaf[:len(prefix)] == prefix:
                    kids[leaf[len(prefix)]] += c
            level = mx.LEVELS[len(prefix)]
            got = fill({k: (c, mx.WEIGHTS[level].get(k, mx.DEFAULT_WEIGHT)) for k, c in kids.items()}, budget)
            return {k: v for name, b in got.items() for k, v in down((*prefix, name), b).items()}
        got = {(r.domain, r.lang, r.source): r.budget for r in mx.budgets(df, total).collect()}
        assert got == down((), min(total, sum(cap.values()))), total


def test_selection(spark):
    rows = [(i, "word " * (i % 9), ["en", "de", None][i % 3], f"src{i % 5}", 7) for i in range(3000)]
    rows += [(None, "a b", None, None, 7), (5000, None, "en", "src0", 7), (1, "x " * 60_000, "en", "src1", 7), (2, "w w", "en", "src2", 7), (2, "w w", "en", "src2", 7)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, budget int")
    got = mx.mix(df, budget_percent=70).collect()
    leaf = lambda r: (r.domain, r.lang, r.source)
    used, budget = Counter(), {}
    for r in got:
        used[leaf(r)] += r.n_tokens
        budget[leaf(r)] = r.budget
    assert all(used[k] <= budget[k] for k in used)
    # A prefix: the next document would not have fitted, so each leaf is within its longest document of its budget.
    longest = {k: max(r.n_tokens for r in got if leaf(r) == k) for k in budget if k != ("books", "en", "src1")}
    assert all(budget[k] - used[k] <= max(longest[k], 9) for k in longest)
    copies = Counter((r["__rid"], r.epoch) for r in got)
    assert max(copies.values()) == 1 and {r.epoch for r in got} <= {0, 1, 2}
    assert mx.mix(df.limit(0)).count() == 0
    again = mx.mix(df.repartition(7), budget_percent=70).groupBy("doc_id", "epoch").count().collect()
    assert Counter({(r.doc_id, r.epoch): r["count"] for r in again}) == Counter((r.doc_id, r.epoch) for r in got)


def test_words(spark):
    texts = ["", None, " ", "a", " a", "a ", "\ta\x0b b\n", "a\u00a0b", "  x  y  "]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [r[0] for r in df.select(mx.words(F.col("t"))).collect()] == [0, 0, 0, 1, 1, 1, 2, 1, 2]
