import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from ticklake.llm import shared_keys as sk
from ticklake.llm import substring_dedup as sd


def brute(rows):
    split = {k: (t or "").encode().split() for k, (_, t) in enumerate(rows)}
    least = {}
    big = 1 << 63
    ids = [big if i is None else i for i, _ in rows]
    for k in split:
        for i in range(len(split[k]) - 12):
            w = tuple(split[k][i:i + 13])
            least[w] = min(least.get(w, big), ids[k])
    out = []
    for k, (i, _) in enumerate(rows):
        w, gone = split[k], set()
        for at in range(len(w) - 12):
            if least[tuple(w[at:at + 13])] < ids[k]:
                gone |= set(range(at, at + 13))
        kept = b" ".join(x for j, x in enumerate(w) if j not in gone)
        out.append((-1 if i is None else i, len(w), len(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def run(spark, rows):
    df = spark.createDataFrame([(i, t, "x", [1]) for i, t in rows], "doc_id long, text string, owner string, keys array<int>")
    got = sd.substring_dedup(df).select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("h"), "spans", "text").collect()
    assert all(sum(s.end - s.start for s in r.spans) == r.n_removed for r in got)
    assert all(s.end - s.start >= 13 for r in got for s in r.spans)
    return sorted((-1 if r.doc_id is None else r.doc_id, r.n_words, r.n_removed, r.h) for r in got)


def corpus(seed):
    rnd = random.Random(seed)
    vocab = [f"w{k}" for k in range(60)]
    passages = [[rnd.choice(vocab) for _ in range(rnd.choice([11, 12, 13, 14, 20, 40]))] for _ in range(12)]
    rows = []
    for i in range(150):
        w = []
        for _ in range(rnd.randrange(6)):
            w += [rnd.choice(vocab) for _ in range(rnd.randrange(20))]
            p = list(rnd.choice(passages))
            if rnd.random() < 0.3:
                p[rnd.randrange(len(p))] = "z"
            w += p[rnd.randrange(3):]
        rows.append((rnd.randrange(10_000), " ".join(w)))
    return rows


@pytest.mark.parametrize("seed, piece", [(1, sk.PIECE), (2, 17)])
def test_against_brute_force(spark, monkeypatch, seed, piece):
    rows = corpus(seed)
    rows += [(20_000 + k, rows[5][1]) for k in range(40)] + [(30_000, "same " * 300), (30_001, "same " * 40), (30_002, "Same " * 40)]
    rows += [(40_000, None), (40_001, ""), (40_002, " \t\n"), (40_003, "é x " * 30), (40_004, "é x " * 14)]
    rows += [rows[7], (None, rows[7][1]), (None, rows[9][1]), (None, rows[9][1])]
    if piece < 100:  # in this process only: the functions run on a local list
        monkeypatch.setattr(sk, "PIECE", piece)
        monkeypatch.setattr(sk, "STRETCH", 5)
        prefix = sk.Prefix()
        for _, t in rows[:40]:
            data = sd.encoded(t)
            starts = [lo + s for lo, a in sd.anchors(data, prefix) for s in a.windows(np.arange(len(a.first)))[0]]
            assert sorted(starts) == list(range(max(0, len(data.split()) - 12)))
            assert len(set(data.split())) == len(set(sk.word_hashes(data, prefix)))
        return
    assert run(spark, rows) == brute(rows)


def test_long_words_of_close_structure_differ(spark):
    """Thue-Morse words and their complements: sums of powers modulo 2^64 are equal for them."""
    word = "a"
    while len(word) < 1024:
        word += word.translate({97: 98, 98: 97})
    other = word.translate({97: 98, 98: 97})
    tail = " " + " ".join(f"w{i}" for i in range(12))
    rows = [(1, word + tail), (2, other + tail), (3, word + tail), (4, other[:65] + tail), (5, word[:65] + tail)]
    assert run(spark, rows) == brute(rows)
    assert [r[2] for r in run(spark, rows)] == [0, 0, 13, 0, 0]


def test_empty_table(spark):
    assert sd.substring_dedup(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_settle_answers_what_it_sees():
    keys, owners = np.array([5, 5, 5, 7, 7, 9], np.uint64), np.array([3, 1, 1, 2, 2, 4])
    k, o, a = sk.settle(keys, owners, sk.SMALLER)
    assert list(zip(k, o, a)) == [(5, 1, False), (5, 3, True), (7, 2, False), (9, 4, False)]
    assert list(sk.settle(keys, owners, sk.SHARED)[2]) == [True, True, False, False]
