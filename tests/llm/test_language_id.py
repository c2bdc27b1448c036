import zlib

from pyspark.sql import functions as F

from ticklake.llm import language_id as li

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    got = li.op9_language_id(spark, SF)
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang")
    rows = got.join(docs, "doc_id").filter("held_out and lang is not null and lang_pred <> 'und'").collect()
    assert len(rows) > 100
    assert sum(r.lang == r.lang_pred for r in rows) >= 0.95 * len(rows)
    assert all(0 <= r.score <= 1 for r in rows)


def test_edge_rows(spark):
    rows = [(i, ("the cat and the dog " if i % 2 else "der hund und die katze ") * 5, "en" if i % 2 else "de", "x")
            for i in range(60)]
    rows += [(100, None, "en", "x"), (101, "", "en", "x"), (102, "12 + 3 !", "de", "x"), (None, "der hund", None, "x"),
             (103, "the dog " * 100_000, None, "x"), (103, "the dog " * 100_000, None, "x"), (104, "a", None, "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, held_out string")
    got = li.language_id(df).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got}
    assert [by[i].lang_pred for i in (100, 101, 102)] == ["und"] * 3 and by[100].score == 0
    assert by[None].lang_pred == "de" and by[None].held_out and by[103].lang_pred == "en"
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got if r.doc_id is not None)
    assert {r.lang_pred for r in got} <= {"en", "de", "und"}
    none = li.language_id(df.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert {r.lang_pred for r in none} == {"und"}
    assert li.language_id(df.limit(0)).count() == 0


def test_counts_do_not_depend_on_steps():
    text = "abç déf " * 3000
    whole = li.counts(text)
    li.STEP, kept = 1000, li.STEP
    assert (li.counts(text) == whole).all()
    li.STEP = kept
