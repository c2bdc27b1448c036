import itertools
import random
import re

from ticklake.llm import decontaminate as dc
from ticklake.llm.common import RID, with_row_id

RND = random.Random(3)
VOCAB = [f"w{k}" for k in range(400)]


def words(n):
    return [RND.choice(VOCAB) for _ in range(n)]


def toks(t):
    return re.findall(r"[^\W_]+", (t or "").lower())


def brute(docs, items):
    """Pairs with a seed hit on a diagonal whose best window has few enough differences."""
    places = [[k for k, c in enumerate(m) if c == "1"] for m in dc.MASKS]
    out = {}
    for d, t in docs:
        w = toks(t)
        for i, u in items:
            v = toks(u)
            if len(v) < dc.SPAN:
                continue
            for shift in range(-len(v) + dc.SPAN, len(w) - dc.SPAN + 1):
                same = [0 <= shift + j < len(w) and w[shift + j] == x for j, x in enumerate(v)]
                hit = any(all(same[q + k] for k in p) for q in range(len(v) - dc.SPAN + 1) for p in places)
                size = min(len(v), dc.WINDOW)
                best = max(sum(same[q:q + size]) for q in range(len(v) - size + 1))
                if hit and (size - best) * 100 <= size * dc.MISMATCH_PERCENT:
                    out[d, i] = max(out.get((d, i), 0), best)
    return out


def run(spark, docs, items):
    d = with_row_id(spark.createDataFrame([(i, t, "x", 1) for i, t in docs], "doc_id long, text string, item_id string, seed int"), "t")
    b = spark.createDataFrame([(i, t, 2) for i, t in items], "item_id long, text string, doc_id int")
    ids = {r[RID]: r.doc_id for r in d.collect()}
    got = dc.contaminated(d, b).collect()
    assert len({(r[RID], r.item) for r in got}) == len(got)
    return {(ids[r[RID]], r.item): r.n_matched for r in got}


def test_against_brute_force(spark):
    items = [(k, " ".join(words(n))) for k, n in enumerate((11, 14, 20, 35, 60, 5))]
    items += [(90, items[3][1]), (91, None), (92, "")]
    docs = [(100 + k, " ".join(words(60))) for k in range(10)]
    for k in range(40):
        w = items[k % 5][1].split()
        cut = w[RND.randrange(0, max(1, len(w) - 10)):]
        for _ in range(k % 6):
            cut[RND.randrange(len(cut))] = "other"
        docs.append((200 + k, (" ".join(words(15)) + ". " + ", ".join(cut).upper() + "! " + " ".join(words(15)))))
    docs += [(300, None), (301, ""), (302, " ".join(words(5))), (303, items[4][1] * 3), (304, " ".join(words(60_000)) + " " + items[3][1])]
    short = [d for d in docs if d[0] != 304]
    want = brute(short, items)
    got = run(spark, docs, items)
    assert got.pop((304, 3)) == 20 and got.pop((304, 90)) == 20
    assert got == want and len(want) > 20


def test_masks_cover_each_other(spark):
    inner = range(1, dc.SPAN - 1)
    assert all(any(m[k] == "0" for m in dc.MASKS) for k in (2, 3, 5, 7, 8, 9)) and all(m.count("1") == 8 for m in dc.MASKS) and inner
    item = " ".join(words(13))
    doc = item.split()
    doc[5] = "other"
    assert run(spark, [(1, " ".join(doc)), (1, " ".join(doc)), (None, item)], [(7, item)]) == {(1, 7): 12, (None, 7): 13}


def test_empty_tables(spark):
    assert run(spark, [(1, "a")], [(1, "b")]) == {}
    d = with_row_id(spark.createDataFrame([], "doc_id long, text string"), "t")
    b = spark.createDataFrame([], "item_id long, text string")
    assert dc.contaminated(d, b).count() == 0


def allowed(n):
    """Every choice of places at which n aligned tokens may differ."""
    return itertools.combinations(range(n), n * dc.MISMATCH_PERCENT // 100)


def test_masks_find_every_allowed_pattern():
    for n in range(dc.SPAN, dc.WINDOW + 1):
        seeds = [{q + k for k, c in enumerate(m) if c == "1"} for m in dc.MASKS + dc.MORE_MASKS for q in range(n - len(m) + 1)]
        assert all(any(s.isdisjoint(p) for s in seeds) for p in allowed(n))


def test_every_allowed_substitution_is_found(spark):
    """No seed is asked for: every copy with as many differing tokens as the rule allows."""
    items = [(n, " ".join(f"i{n}t{k}" for k in range(n))) for n in (11, 12, 14, 15, 16, 19, 20)]
    docs, want = [], {}
    for n, text in items:
        for p in allowed(n):
            d = len(docs)
            docs.append((d, " ".join(["before", *("other" if k in p else w for k, w in enumerate(text.split())), "after"])))
            want[d, n] = n - len(p)
        over = range(0, n, n // (len(p) + 1))[:len(p) + 1]
        docs.append((len(docs), " ".join("other" if k in over else w for k, w in enumerate(text.split()))))
    assert run(spark, docs, items) == want and len(want) > 1_500


def test_short_items_are_found(spark):
    items = [(n, " ".join(f"i{n}t{k}" for k in range(n))) for n in range(1, dc.SPAN)]
    docs, want = [], {}
    for n, text in items:
        for p in [(), *allowed(n)]:
            d = len(docs)
            docs.append((d, " ".join(["before", *("other" if k in p else w for k, w in enumerate(text.split())), "after"])))
            want[d, n] = n - len(p)
        over = range(n * dc.MISMATCH_PERCENT // 100 + 1)
        docs.append((len(docs), " ".join("other" if k in over else w for k, w in enumerate(text.split()))))
    assert run(spark, docs, items) == want and run(spark, docs[:5], [(1, ""), (2, None)]) == {}
