"""Batch ids of any characters, and what counts as a header."""

import os

import pytest

from ticklake import schemas as S
from ticklake.sinks.tables import read_or_empty, with_batch, write_batch
from ticklake.sources.tsv import HEADER, read_staging


@pytest.mark.parametrize("batch_id", ["a=b", "x%y", "2026-12-03", "007", "a/b", "c:d", "50%25", "ñ ü", "[x]{y}", 'q"\'*?#'])
def test_a_re_run_replaces_its_rows(spark, tmp_path, batch_id):
    path = str(tmp_path / "t")
    other = spark.range(2).select("id")
    write_batch(with_batch(other, "other"), path, "other")
    for n in (3, 3, 1):
        write_batch(with_batch(spark.range(n), batch_id), path, batch_id)
    rows = read_or_empty(spark, path, S.T.StructType.fromDDL("id long, id_lote string")).collect()
    assert sorted((r.id_lote, r.id) for r in rows) == sorted([("other", 0), ("other", 1), (batch_id, 0)])


def test_a_batch_needs_an_id(spark, tmp_path):
    with pytest.raises(ValueError):
        write_batch(with_batch(spark.range(1), ""), str(tmp_path / "t"), "")


def test_only_the_header_of_a_file_is_dropped(spark, tmp_path):
    line = "\t".join(["id_partida"] + ["1"] * 14)
    (tmp_path / "a.tsv").write_text("\n".join([HEADER, line, "\t".join(["5"] * 15)]) + "\n")
    (tmp_path / "b.tsv").write_text("\n".join([line, line]) + "\n")
    got = read_staging(spark, str(tmp_path)).collect()
    assert sorted((os.path.basename(r.archivo_origen), r.raw_id_partida) for r in got) == [
        ("a.tsv", "5"), ("a.tsv", "id_partida"), ("b.tsv", "id_partida"), ("b.tsv", "id_partida")]
    assert read_staging(spark, str(tmp_path / "a.tsv"), header=None).count() == 3


def test_field_escapes(spark, tmp_path):
    fields = [r"a\tb", r"a\\nb", r"\b\f\v", r"\N", r"\q\.", r"\101", r"\x41"] + ["1"] * 8
    (tmp_path / "a.tsv").write_text("\t".join(fields) + "\n")
    r = read_staging(spark, str(tmp_path)).first()
    assert list(r)[:7] == ["a\tb", "a\\nb", "\b\f\v", None, "q.", "\\101", "\\x41"]
