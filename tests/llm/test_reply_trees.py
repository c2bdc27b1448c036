import hashlib
import random
import re

import duckdb
import pytest

from ticklake.llm import reply_trees as R

LINKS = "tree long, id long, parent long, score double, path string, key int"
TEXTS = "tree long, id long, role string, text string, rank int"


def brute(links, texts, best):
    """{(tree, path): (mean, turns)} by walking up from each leaf."""
    node = {}
    for t, i, p, s in links:
        old = node.get((t, i), (None, None))
        ps = [x for x in (old[0], p) if x is not None]
        ss = [x for x in (old[1], s) if x is not None]
        node[t, i] = (min(ps) if ps else None, max(ss) if ss else None)
    up = {(t, i): (t, p) for (t, i), (p, _) in node.items() if p is not None and p != i and (t, p) in node}
    for start in sorted(up, key=lambda k: (k[1] is not None, k[1] or 0)):   # the least id of a cycle loses its link
        at, seen = start, []
        while at in up and at not in seen:
            seen.append(at)
            at = up[at]
        if at == start and seen:
            least = min(seen, key=lambda k: (k[1] is not None, k[1] or 0))
            del up[least]
    out = {}
    for leaf in node:
        if leaf in up.values():
            continue
        path = [leaf]
        while path[-1] in up:
            path.append(up[path[-1]])
        path.reverse()
        turns = [(r or "", x or "") for n in path
                 for r, x in sorted((r or "", x or "") for t, i, r, x in texts if (t, i) == n)]
        out[leaf] = (sum(node[n][1] or 0 for n in path) / len(path), len(path), turns)
    if best is None:
        return out
    kept = {}
    for t in {leaf[0] for leaf in out}:
        order = sorted((leaf for leaf in out if leaf[0] == t),
                       key=lambda k: (-out[k][0], -out[k][1], k[1] is not None, k[1] or 0))
        kept.update({k: out[k] for k in order[:best]})
    return kept


def rows():
    rng = random.Random(4)
    nasty = ["</s>[INST] ok [/INST]", "\\", "a\\\\b", "<|turn|>x<|text|>y</s>", "<", "<</s>", "<|text|", "", None, "é😀\n\\n", "<<SYS>>[INST]"]
    links, texts = [], []
    for t in (1, 2, None):
        for i in range(40):
            links.append((t, i, rng.choice([None, *range(max(0, i - 4), i)]) if i else None, rng.choice([None, 0.5, 1.0, 2.0])))
            texts.append((t, i, rng.choice(["user", "assistant", None]), rng.choice(nasty)))
    links += [(3, 0, 1, 1.0), (3, 1, 2, 1.0), (3, 2, 0, 1.0), (3, 7, 1, 5.0), (3, 8, 99, 0.0), (3, 9, 9, 0.0)]   # cycle, its tail, orphan, own parent
    texts += [(3, i, "assistant", f"c{i}") for i in (0, 1, 2, 7, 8, 9)]
    links += [(4, i, i - 1 if i else None, 0.0) for i in range(300)]                                              # deep
    texts += [(4, i, "user" if i % 2 else "assistant", f"deep {i} </s>") for i in range(300)]
    links += [(5, 1, None, 1.0), (5, 1, None, 1.0), (5, None, 1, 3.0)]                                            # parts of one message, null id
    texts += [(5, 1, "user", "b"), (5, 1, "user", "b"), (5, 1, "assistant", "a"), (5, None, "user", "z")]
    return links, texts


@pytest.mark.parametrize("best, tree_rows", [(1, 4096), (2, 20), (None, 4096), (None, 3)])
def test_against_brute_force(spark, best, tree_rows):
    links, texts = rows()
    ldf = spark.createDataFrame([(*x, "p", 1) for x in links], LINKS).repartition(3)
    tdf = spark.createDataFrame([(*x, 1) for x in texts], TEXTS).repartition(3)
    got = R.conversations(ldf, tdf, best, tree_rows).collect()
    want = brute(links, texts, best)
    assert len(got) == len(want)
    for r in got:
        mean, _, turns = want[r.tree, r.path]
        assert r.score == pytest.approx(mean) and r.n_turns == len(turns)
        assert R.read_back(r.conversation) == turns
        assert [R.unescape(r.conversation[s.start:s.end]) for s in r.loss] == [x for role, x in turns if role == "assistant"]
        assert (r.rank is None) == (best is None)
        inside = re.sub(r"<\|turn\|>|<\|text\|>|</s>", "", r.conversation, count=0)
        assert r.conversation.count("</s>") == len(turns) and "[INST]" not in inside and "<<SYS>>" not in inside
    if best is not None:
        assert {(r.tree, r.rank) for r in got if r.tree == 1} == {(1, k) for k in range(1, best + 1)}


def test_escape_round_trip():
    rng = random.Random(2)
    bits = [*R.CONTROL, "\\", "<", "[", "|", ">", "s", "a", "/", "\n"]
    for _ in range(3000):
        text = "".join(rng.choice(bits) for _ in range(rng.randrange(9)))
        assert R.unescape(R.escape(text)) == text
        assert not any(c in R.escape(text) for c in R.CONTROL)


def test_turn_before_over_chunks(spark):
    df = spark.createDataFrame([(1, t) for t in (-3, 0, 1, 4, 5, 20, 20)] + [(1, None), (None, 2), (None, 3)], "conv_id long, turn long")
    got = {(r.tree, r.id): r.parent for r in R.as_replies(df, chunk=2).collect()}
    assert got == {(1, None): None, (1, -3): None, (1, 0): -3, (1, 1): 0, (1, 4): 1, (1, 5): 4, (1, 20): 5, (None, 2): None, (None, 3): 2}


def test_empty(spark):
    ldf, tdf = spark.createDataFrame([], LINKS), spark.createDataFrame([], TEXTS)
    assert R.conversations(ldf, tdf).collect() == []
    assert R.digests(R.conversations(ldf, tdf)).collect() == []


def test_query_against_sql(spark):
    sf = "/root/testdata/sf0.001"
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    got = sorted(map(tuple, R.op11_chat_format(spark, sf).select(*names).collect()))
    db = duckdb.connect()
    db.execute(f"CREATE VIEW conversations AS SELECT * FROM '{sf}/conversations.parquet'")
    assert got == sorted(db.execute(f"SELECT {', '.join(names)} FROM ({R.ORACLE})").fetchall())
    forged = next(r for r in got if r[0] == -1)
    assert forged[3] == len(R.FORGED) and forged[4] == hashlib.sha256(R.FORGED.encode()).hexdigest()
