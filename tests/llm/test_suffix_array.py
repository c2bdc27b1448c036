import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from ticklake.llm import shared_keys as sk
from ticklake.llm import suffix_array as sa

W = sa.WINDOW


def brute(rows):
    data = [(t or "").encode() for _, t in rows]
    seen = Counter(d[i:i + W] for d in data for i in range(len(d) - W + 1))
    out = []
    for (i, _), d in zip(rows, data):
        gone = np.zeros(len(d) + 1, bool)
        for at in range(len(d) - W + 1):
            if seen[d[at:at + W]] > 1:
                gone[at:at + W] = True
        gone = gone[:-1] if len(d) else np.zeros(0, bool)
        kept = bytes(np.frombuffer(d, np.uint8)[~gone])
        runs = int((np.diff(np.concatenate([[0], gone.astype(int), [0]])) == 1).sum())
        out.append((-1 if i is None else i, len(d), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def corpus(seed):
    rnd = random.Random(seed)
    text = lambda n: "".join(rnd.choice("abcdefghij é") for _ in range(n))
    passages = [text(n) for n in (380, 399, 400, 401, 430, 600, 1500)]
    rows = []
    for i in range(90):
        t = ""
        for _ in range(rnd.randrange(4)):
            p = rnd.choice(passages)
            lo = rnd.randrange(60)
            t += text(rnd.randrange(300)) + p[lo:len(p) - rnd.randrange(1, 60)]
        rows.append((i, t + text(rnd.randrange(200))))
    # Overlapping pieces of one text: repeats that begin and end at many places.
    rows += [(100 + k, passages[6][37 * k:37 * k + 700]) for k in range(20)]
    rows += [(200, "ab" * 900), (201, "ab" * 250), (202, "c" * 401), (203, "d" * 400), (204, "é" * 300), (205, "é" * 199),
             (206, None), (207, ""), (208, rows[3][1]), (209, rows[4][1] + rows[4][1]), (None, rows[5][1]), (None, rows[5][1]), (None, text(900)),
             (3, rows[3][1]), (3, text(500)), (210, "Ononnt " * 400)]
    return rows


def run(spark, rows, **kw):
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, owner string, data int")
    got = sa.suffix_array_dedup(df, **kw).collect()
    return sorted((-1 if r.doc_id is None else r.doc_id, r.n_bytes, r.n_removed, len(r.spans), hashlib.sha256(r.kept).hexdigest()) for r in got)


@pytest.mark.parametrize("seed, crowd", [(1, sa.CROWD), (2, 3)])
def test_against_brute_force(spark, seed, crowd):
    rows = corpus(seed)
    assert run(spark, rows, crowd=crowd) == brute(rows)


def test_empty_table(spark):
    assert sa.suffix_array_dedup(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_anchors_cover_all_windows(monkeypatch):
    monkeypatch.setattr(sk, "PIECE", 300)
    rnd = np.random.default_rng(4)
    for n in (0, 399, 400, 401, 699, 700, 3000):
        data = rnd.integers(97, 100, n, np.uint8).tobytes()
        found = [lo + w for lo, a in sa.anchors(data, sk.Prefix()) for f, g in zip(a.first, a.last) for w in range(f, g + 1)]
        assert found == list(range(max(0, n - W + 1)))
        for _, a in sa.anchors(data, sk.Prefix()):
            assert (a.at >= a.last).all() and (a.at - a.first < sa.SPREAD).all()


def test_leftmost_least():
    rnd = np.random.default_rng(4)
    for n, w in ((10, 3), (25, 7), (7, 7), (64, 8)):
        v = rnd.integers(0, 4, n).astype(np.uint64)
        assert list(sa.leftmost_least(v, w)) == [i + int(v[i:i + w].argmin()) for i in range(n - w + 1)]


def test_intervals():
    words = sorted(["banana", "banal", "band", "bee", "can", "candle"])
    lcp = [sa.common(a.encode(), b.encode()) for a, b in zip(words, words[1:])]
    found = {(words[f][:d], l - f + 1) for d, f, l in sa.intervals(lcp) if d}
    assert found == {("bana", 2), ("ban", 3), ("b", 4), ("can", 2)}
