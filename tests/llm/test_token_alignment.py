import hashlib
from collections import Counter

import numpy as np
import pytest

from ticklake.llm import csr
from ticklake.llm import token_alignment as T

TEXTS = ["Hello world, naïve café.", "", None, "a  b   c ", " lead", "tail ", "line\n\nnext\n indented", "\t", "  ",
         "<|endoftext|> <s> </s> <unk>", "under▁score", "日本語 😀😀 emoji", "x" * 5000, "word " * 400 + "word", "Hello world, naïve café.",
         "don't I'll we've", "a b  c", "123 4567 89", "\x00\x01", "A" * 300 + " " + "b" * 300, " " * 50 + "end"]


def brute(texts):
    """(n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of each text by plain loops."""
    p, docs = T.pair(T.BYTE_BPE, T.PIECE_BPE), []
    for t in texts:
        a = p.a.encode(" " + t, add_special_tokens=False).ids if t else []
        b = p.b.encode(t) if t else []
        raw = b" " + (t or "").encode()
        if b"".join(p.bytes_a[i] for i in a) != raw or b"".join(p.bytes_b[i] for i in b) != raw:
            docs.append(None)
            continue
        owner_a = [k for k, i in enumerate(a) for _ in p.bytes_a[i]]
        owner_b = [k for k, i in enumerate(b) for _ in p.bytes_b[i]]
        links = sorted(set(zip(owner_a, owner_b)))
        groups, x, y = [], [a[0]], [b[0]]
        for at in range(1, len(raw)):
            new_a, new_b = owner_a[at] != owner_a[at - 1], owner_b[at] != owner_b[at - 1]
            if new_a and new_b:
                groups.append((x, y))
                x, y = [], []
            x = x + [a[owner_a[at]]] if new_a else x
            y = y + [b[owner_b[at]]] if new_b else y
        groups.append((x, y))
        docs.append((len(a), len(b), len(groups), [(a[i], b[j]) for i, j in links],
                     ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)))
    count = Counter(link for d in docs if d for link in d[3])
    best = Counter()
    for (_, j), n in count.items():
        best[j] = max(best[j], n)
    return [(0, 0, 0, 0, 0, 0, "") if d is None else
            (*d[:3], len(d[3]), sum(count[x] == best[x[1]] for x in d[3]), sum(count[x] for x in d[3]),
             hashlib.sha256(d[4].encode()).hexdigest()) for d in docs]


@pytest.mark.parametrize("block_bytes", [16 << 20, 300])
def test_against_brute_force(spark, block_bytes):
    rows = [(None if i == 3 else i // 2, t, "x", 1) for i, t in enumerate(TEXTS)]
    df = spark.createDataFrame(rows, "doc_id long, text string, block string, pairs int").repartition(3)
    got = Counter(map(tuple, T.token_alignment(df, block_bytes=block_bytes).collect()))
    assert got == Counter((r[0], *x) for r, x in zip(rows, brute(TEXTS)))
    assert T.token_alignment(df.limit(0)).count() == 0


def test_query_equals_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    assert sorted(map(tuple, T.op13_token_alignment(spark, sf).collect())) == sorted(
        (d.doc_id, *x) for d, x in zip(docs, brute([d.text for d in docs])))


def test_real_outputs(spark):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    p = T.pair(T.BYTE_BPE, T.PIECE_BPE)
    want = brute(TEXTS)
    for r in T.alignments(df).collect():
        n_a, n_b, n_groups, n_links = want[r.doc_id][:4]
        assert (r.n_a, r.n_b, len(r.links)) == (n_a, n_b, n_links)
        assert sum(x.bytes for x in r.links) == (len(TEXTS[r.doc_id].encode()) + 1 if n_a else 0)
        groups = [tuple(s.split(",") for s in g.split("|")) for g in r.groups.split(";")] if r.groups else []
        assert len(groups) == n_groups and r.group_links == sum(len(a) * len(b) for a, b in groups)
        assert b"".join(p.bytes_a[i] for i in r.a_ids) == b"".join(p.bytes_b[i] for i in r.b_ids)


def test_words_learnt_apart_give_the_ids_of_whole_texts():
    p = T.Pair(T.BYTE_BPE, T.PIECE_BPE)
    assert p.by_rank is not None and p.by_word
    texts = [t for t in TEXTS if t]
    for _ in range(2):
        kept, a, b = p.encode(texts)
        whole = [(p.a.encode(" " + texts[i], add_special_tokens=False).ids, p.b.encode(texts[i])) for i in kept]
        assert a.ids.tolist() == sum((x for x, _ in whole), []) and b.ids.tolist() == sum((y for _, y in whole), [])
        assert a.ends.tolist() == np.cumsum([len(x) for x, _ in whole]).tolist()


@pytest.mark.parametrize("most", [1, 7, 1 << 20])
def test_row_products_equal_dense(most):
    rng = np.random.default_rng(7)
    for _ in range(20):
        n, k, m = rng.integers(1, 12, 3)
        x, y = rng.integers(0, 3, (n, k)), rng.integers(0, 3, (k, m))
        parts = list(csr.row_products(sparse(x), sparse(y), most))
        got = np.zeros((n, m), int)
        for r, c, v in parts:
            assert len(set(zip(r.tolist(), c.tolist()))) == len(r)
            got[r, c] = v
        assert (got == x @ y).all()
        t = csr.transposed(sparse(x))
        assert t.height == k and (dense(t) == x.T).all()


def sparse(x):
    r, c = np.nonzero(x)
    return csr.Csr(np.concatenate(([0], np.cumsum(np.bincount(r, minlength=len(x))))), c, x[r, c], x.shape[1])


def dense(m):
    out = np.zeros((m.height, m.width), int)
    out[np.repeat(np.arange(m.height), np.diff(m.start)), m.cols] = m.values
    return out
