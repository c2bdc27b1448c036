import random

import numpy as np
import pytest

from ticklake.llm import jaccard_join as jj
from ticklake.llm.components import components


def sets_of(t):
    w = (t or "").encode().lower().split()
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def brute(rows):
    s = [sets_of(t) for _, t in rows]
    ids = [float("inf") if i is None else i for i, _ in rows]
    up = list(range(len(rows)))

    def root(k):
        while up[k] != k:
            k = up[k]
        return k
    for a in range(len(rows)):
        for b in range(a):
            if s[a] and s[b] and 100 * len(s[a] & s[b]) >= 80 * len(s[a] | s[b]):
                up[root(a)] = root(b)
    least = {}
    for k in range(len(rows)):
        least[root(k)] = min(least.get(root(k), float("inf")), ids[k])
    clean = lambda x: -1 if x == float("inf") else x
    return sorted((clean(ids[k]), len(s[k]), clean(least[root(k)])) for k in range(len(rows)))


def corpus(seed, groups=14):
    rnd = random.Random(seed)
    vocab = [f"w{k}" for k in range(3000)]
    boiler = [rnd.choice(vocab) for _ in range(60)]
    rows, i = [], 0
    for g in range(groups):
        base = [rnd.choice(vocab) for _ in range(rnd.choice([1, 3, 5, 8, 12, 30, 60, 150]))]
        for _ in range(rnd.choice([1, 2, 5, 12])):
            w = list(base)
            for _ in range(rnd.choice([0, 0, 1, 1, 2, 3, 5])):
                w[rnd.randrange(len(w))] = rnd.choice(vocab)
            if rnd.random() < 0.3:
                w = w[:-1 - rnd.randrange(5)] or w
            if rnd.random() < 0.2:
                w += boiler
            rows.append((i := i + rnd.randrange(1, 9), " ".join(w)))
    rnd.shuffle(rows)
    return rows


def run(spark, rows, **kw):
    df = spark.createDataFrame([(i, t, "x", 5) for i, t in rows], "doc_id long, text string, owner string, n int")
    got = jj.jaccard_join(df, **kw).collect()
    return sorted((-1 if r.doc_id is None else r.doc_id, r.n_shingles, -1 if r.component_id is None else r.component_id) for r in got)


@pytest.mark.parametrize("seed, crowd", [(1, jj.CROWD), (2, 150)])
def test_against_brute_force(spark, monkeypatch, seed, crowd):
    rows = corpus(seed)
    chain = [f"c{k}" for k in range(60)]  # a chain of links whose ends are not similar
    rows += [(1000 + k, " ".join(chain[2 * k:2 * k + 30])) for k in range(14)]
    rows += [(2000, None), (2001, ""), (2002, " \t"), (2003, "ONE two"), (2004, "one  TWO"), (2005, "É a"), (2006, "é a"),
             (2007, "x " * 30_000), (2008, "x " * 9), rows[0], (None, rows[1][1]), (None, "quite alone here"), (3, rows[2][1]), (3, "other text of it")]
    assert run(spark, rows, crowd=crowd) == brute(rows)


@pytest.mark.parametrize("crowd", [jj.CROWD, 150])
def test_sets_of_shared_names_are_named_anew(spark, crowd):
    """As if every other set shared its name with a different one."""
    rows = corpus(5)
    prefix = jj.sk.Prefix()
    names = sorted({jj._name(jj.shingles(t, prefix), frozenset()) for _, t in rows})
    assert run(spark, rows, crowd=crowd, clash=frozenset(names[::2])) == brute(rows)


def test_a_name_is_half_of_the_digest():
    d = bytes(range(16))
    first, second = (int.from_bytes(x, "little", signed=True) for x in (d[:8], d[8:]))
    assert jj.named(d, frozenset()) == first and jj.named(d, frozenset([second])) == first and jj.named(d, frozenset([first])) == second


def test_empty_table(spark):
    assert jj.jaccard_join(spark.createDataFrame([], "doc_id long, text string")).count() == 0


@pytest.mark.parametrize("leaf", [4, 16, 10_000])
def test_region_join_is_exact(monkeypatch, leaf):
    monkeypatch.setattr(jj, "LEAF", leaf)
    monkeypatch.setattr(jj, "PIVOTS", 3)
    for seed in range(6):
        rnd = np.random.default_rng(seed)
        sets = []
        for _ in range(12):
            base = rnd.choice(200, rnd.integers(5, 60), replace=False)
            for _ in range(rnd.integers(1, 14)):
                own = np.setdiff1d(base, rnd.choice(base, rnd.integers(0, 6)))
                sets.append(np.unique(np.append(own, rnd.integers(0, 200, rnd.integers(1, 5)))).astype(np.uint64))
        links = jj.Links(len(sets))
        jj.region_join(sets, links)
        want = jj.Links(len(sets))
        for a in range(len(sets)):
            for b in range(a):
                both = len(np.intersect1d(sets[a], sets[b]))
                if 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
                    want.join(a, b)
        parts = lambda u: {frozenset(k for k in range(len(sets)) if u.root(k) == r) for r in {u.root(k) for k in range(len(sets))}}
        assert parts(links) == parts(want)


def test_components(spark):
    rnd = random.Random(1)
    edges = [(k, k + 1) for k in range(60)] + [(100 + rnd.randrange(80), 100 + rnd.randrange(80)) for _ in range(60)] + [(500, k) for k in range(501, 700)] + [(5, 5)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    up = {}
    for a, b in edges:
        up.setdefault(a, {a}), up.setdefault(b, {b})
        if up[a] is not up[b]:
            both = up[a] | up[b]
            for k in both:
                up[k] = both
    assert got == {k: min(v) for k, v in up.items() if len(v) > 1}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def families(spark, monkeypatch, rows, **kw):
    """Sizes of the families of ``rows``, the largest last, and the result."""
    tables, stored = {}, jj.stored
    monkeypatch.setattr(jj, "stored", lambda df, name, *a: tables.setdefault(name, stored(df, name, *a)))
    got = run(spark, rows, **kw)
    return sorted(r["count"] for r in tables["jaccard-families"].groupBy("cluster").count().collect()), got


def test_common_lines_do_not_chain_documents(spark, monkeypatch):
    """Two thirds of each text is one of a few lines: over a fifth of it is its own, so it has no partner."""
    rnd = random.Random(3)
    lines = [" ".join(f"l{k}w{j}" for j in range(20)) for k in range(3)]
    rows = [(k, rnd.choice(lines) + "".join(f" d{k}w{j}" for j in range(8))) for k in range(150)]
    rows.append((200, rows[0][1] + " more"))
    sizes, got = families(spark, monkeypatch, rows)
    assert sizes == [2]
    assert got == brute(rows)


def test_texts_within_others_do_not_chain(spark, monkeypatch):
    """Each text is the start of one twice as long: they share all their shingles, but their sizes differ too much."""
    words = [f"w{k}" for k in range(1300)]
    rows = [(k, " ".join(words[:40 * 2**k])) for k in range(6)]
    rows.append((10, " ".join(words[:350])))
    sizes, got = families(spark, monkeypatch, rows)
    assert sizes == [2]
    assert got == brute(rows)


def test_similar_sets_share_a_key_of_their_sizes():
    """Over all pairs of sizes, and nested sets and sets that differ both ways."""
    lo, rnd, order = jj.bands(10_000), random.Random(4), np.arange(3000, dtype=np.uint64)
    assert all(b * jj.THRESHOLD > 100 * a for a, b in zip(lo, lo[1:]))
    for _ in range(1500):
        m = rnd.randrange(1, 300)
        n = rnd.randrange(m, m * 5 // 4 + 1)
        c = -(-80 * (n + m) // 180)
        if c > m:
            continue
        places = rnd.sample(range(n + m - c), n + m - c)  # of the rarest first
        if rnd.random() < 0.5:
            places.sort(reverse=True)  # what differs comes first
        common, own, other = places[:c], places[c:n], places[n:]
        keys = [np.sort(order[common + own]), np.sort(order[common + other])]
        kept = []
        for s, alone in zip(keys, (own, other)):  # those that no other set has take places
            first = s[:jj.slack(len(s)) + 1]
            kept.append(first[~np.isin(first, order[alone])])
        at, k = jj.sized_keys(np.array([n, m]), np.concatenate(kept), np.array([len(x) for x in kept]))
        assert np.intersect1d(k[at == 0], k[at == 1]).size, (n, m, c)
