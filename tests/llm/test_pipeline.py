import re

import corpus_pipeline as cp
from ticklake.llm import decontaminate as dc

SF = "/root/testdata/sf0.001"


def toks(t):
    return re.findall(r"[^\W_]+", t.lower())


def test_stages_against_brute_force(spark, tmp_path):
    """Each stage on its predecessor's rows; the plain versions share no code with the operators."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    base = docs.collect()
    extra = [(90_000, None, "en", "src1", 0), (90_001, "", None, None, 0), (90_002, "123 456", "en", "src1", 7), (90_003, base[0].text, "en", "src2", 1),
             (None, "the and of to in " * 30, None, None, 2)]
    docs = docs.unionByName(spark.createDataFrame(extra, docs.schema))
    docs.write.parquet(str(tmp_path / "docs"))
    docs = spark.read.parquet(str(tmp_path / "docs"))
    columns = docs.columns
    kept = {}
    for name, stage in cp.STAGES:
        before = docs.collect()
        out = stage(spark, docs, SF)
        out.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        kept[name] = (before, docs.collect())
        assert docs.columns[:len(columns)] == columns and (docs.columns == columns or name == "mixing")

    before, after = kept["language_id"]
    left = {r.doc_id for r in after}
    assert not left & {90_000, 90_001, 90_002} and len(after) >= 0.9 * len(before)

    before, after = kept["exact_dedup"]
    best = {}
    for r in before:
        k = re.sub(r"[\x20\x09-\x0D]", "", r.text)
        best[k] = min(best.get(k, (1, 0, 0)), (-len(r.text), r.doc_id is None, r.doc_id or 0))
    assert sorted((-len(r.text), r.doc_id is None, r.doc_id or 0) for r in after) == sorted(best.values())

    before, after = kept["jaccard_join"]
    sets = {}
    for r in before:
        w = r.text.encode().lower().split()
        sets[r.doc_id] = {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) > 4 else {tuple(w)} if w else set()
    up = {i: i for i in sets}

    def root(i):
        while up[i] != i:
            i = up[i]
        return i
    order = sorted(sets, key=lambda i: (i is None, i or 0))
    for k, a in enumerate(order):
        for b in order[:k]:
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = sorted((root(a), root(b)), key=order.index)
                up[y] = x
    assert {r.doc_id for r in after} == {i for i in sets if root(i) == i} and len(after) == len({r.doc_id for r in after})

    before, after = kept["decontaminate"]
    items = [toks(r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    grams = {tuple(v[i:i + dc.SPAN]) for v in items for i in range(len(v) - dc.SPAN + 1)}
    gone = {r.doc_id for r in before} - {r.doc_id for r in after}
    for r in before:
        w = toks(r.text)
        runs = [any(w[i:i + len(v)] == v for i in range(len(w) - len(v) + 1)) for v in items if len(v) >= dc.SPAN and set(v) <= set(w)]
        if any(runs):
            assert r.doc_id in gone
        elif not any(tuple(w[i:i + 8]) in {g[:8] for g in grams} for i in range(len(w) - 7)):
            assert r.doc_id not in gone

    before, after = kept["mixing"]
    assert {r.doc_id for r in after} <= {r.doc_id for r in before}
    used = {}
    for r in after:
        k = (r.domain, r.lang, r.source)
        used.setdefault(k, [0, r.budget])[0] += r.n_tokens
    assert after and all(n <= budget for n, budget in used.values())


def test_run_gives_the_mix(spark):
    rows = cp.run(spark, SF)
    assert rows.columns[:5] == ["doc_id", "text", "lang", "source", "n_chars"] and rows.count() > 20
    assert [name for name, _ in cp.STAGES] == ["language_id", "exact_dedup", "jaccard_join", "decontaminate", "mixing"]


def test_empty_documents(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for name, stage in cp.STAGES:
        stage(spark, docs, SF).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        assert docs.count() == 0


def test_results_of_two_runs_are_both_readable(spark):
    sf = "/root/testdata/sf0.001"
    first = cp.run(spark, sf)
    second = cp.run(spark, sf)
    assert sorted(r.doc_id for r in first.collect()) == sorted(r.doc_id for r in second.collect())
