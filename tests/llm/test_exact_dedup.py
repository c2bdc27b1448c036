import hashlib
import re

from ticklake.llm.exact_dedup import exact_dedup


def brute(rows):
    norm = {i: re.sub(r"[\x20\x09-\x0D]", "", t or "") for i, t in rows}
    out = set()
    for i, t in rows:
        same = [(-len(u or ""), j) for j, u in rows if norm[j] == norm[i]]
        out.add((i, min(same)[1], len(same), min(same)[1] == i,
                 hashlib.sha256(norm[i].encode()).hexdigest()))
    return out


def test_against_brute_force(spark):
    long = "wört " * 9000
    rows = [(1, "a b"), (2, "ab"), (3, " a b "), (4, None), (5, ""), (6, "\t"), (7, long), (8, long + "x"),
            (9, long.replace(" ", "")), (10, "x" * 15), (11, "x" * 16), (12, "x" * 17), (13, "x " * 16),
            (14, " "), (15, "x" * 1024), (16, "x" * 1023 + "y"), (17, "x" * 1024 + " "), (18, "\x00"), (19, "\x00\x00")]
    df = spark.createDataFrame([(i, t, "c", 1) for i, t in rows], "doc_id long, text string, cls string, __rid int")
    got = exact_dedup(df).select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()
    assert {tuple(r) for r in got} == brute(rows) and len(got) == len(rows)


def test_repeated_rows_null_ids_and_empty(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (None, "a"), (None, "b")], "doc_id long, text string")
    got = exact_dedup(df).collect()
    assert sorted((r.doc_id or 0, r.keep_id or 0, r.group_size, r.kept) for r in got) == [
        (0, 0, 1, True), (0, 1, 3, False), (1, 1, 3, False), (1, 1, 3, True)]
    assert exact_dedup(df.limit(0)).count() == 0
