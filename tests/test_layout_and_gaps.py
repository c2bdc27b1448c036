"""Z-order layout, gap intervals, foreign keys in one pass, cascading reload."""

import glob
import random
import re

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from ticklake import schemas as S
from ticklake.functions.geometry import MORTON_BITS, morton_key
from ticklake.operators import audit as AU
from ticklake.operators.series import series
from ticklake.operators.trajectory import gap_intervals
from ticklake.plans import analytics as an
from ticklake.sinks import tables as SK

import seed


def skipped(path, box):
    """(row groups, row groups whose statistics rule the box out)."""
    n = out = 0
    for f in glob.glob(f"{path}/*.parquet"):
        meta = pq.ParquetFile(f).metadata
        names = [meta.schema.column(i).name for i in range(meta.num_columns)]
        for g in range(meta.num_row_groups):
            stats = {c: meta.row_group(g).column(names.index(c)).statistics for c in box}
            n += 1
            out += any(s.max < lo or s.min > hi for (lo, hi), s in ((box[c], stats[c]) for c in box))
    return n, out


def test_a_box_skips_most_of_a_plane_layout(spark, tmp_path):
    rng = random.Random(6)
    rows = [(i, rng.uniform(-500, 500), rng.uniform(0, 90)) for i in range(20000)]
    df = spark.createDataFrame(rows, "id long, x double, y double")
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        SK.clustered_layout(df, str(tmp_path / "by_x"), cluster_by=("x", "y", "id"), sort_by=("x", "y", "id"))
        SK.plane_layout(df, str(tmp_path / "plane"), "x", "y", "id")
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    box, strip = {"x": (0.0, 100.0), "y": (10.0, 20.0)}, {"y": (10.0, 20.0)}
    share = {(k, b): skipped(str(tmp_path / k), q)[1] / skipped(str(tmp_path / k), q)[0]
             for k in ("by_x", "plane") for b, q in (("box", box), ("strip", strip))}
    assert share["by_x", "strip"] == 0 and share["plane", "strip"] > 0.6      # y alone: nothing before
    assert share["plane", "box"] > 0.9 > share["by_x", "box"]
    inside = "x BETWEEN 0 AND 100 AND y BETWEEN 10 AND 20"
    assert spark.read.parquet(str(tmp_path / "plane")).filter(inside).count() == df.filter(inside).count()


def test_morton_key_interleaves_bits(spark):
    top = (1 << MORTON_BITS) - 1
    pairs = [(0, 0), (1, 0), (0, 1), (5, 9), (top, top), (top, 0), (123456789, 987654321)]
    df = spark.createDataFrame(pairs + [(None, 3)], "x long, y long")
    bounds = (F.lit(0.0), F.lit(float(1 << MORTON_BITS)))
    got = [r.k for r in df.select(morton_key(F.col("x"), F.col("y"), bounds, bounds).alias("k")).collect()]
    want = [sum(((x or 0) >> i & 1) << 2 * i | (y >> i & 1) << 2 * i + 1 for i in range(MORTON_BITS)) for x, y in pairs + [(None, 3)]]
    assert got == want
    one = df.select(morton_key(F.col("x"), F.col("y"), (F.lit(2.0), F.lit(2.0)), (F.lit(None), F.lit(None))).alias("k")).distinct().collect()
    assert [r.k for r in one] == [0]


@pytest.mark.parametrize("chunk", [3, 7, 1 << 16])
def test_gaps_are_the_missing_ticks(spark, chunk):
    rng = random.Random(chunk)
    rows = [(p, 1, t) for p in range(4) for t in rng.sample(range(-40, 120), 60)] + [(9, 1, 5), (8, 1, 0), (8, 1, 10**6), (0, 1, 3), (7, 1, None)]
    df = spark.createDataFrame(rows, "id_partida int, id_jugador long, tic int")
    gaps = gap_intervals(df, chunk=chunk)
    have = {(p, t) for p, _, t in rows if t is not None}
    want = sorted((p, t) for p in {p for p, _ in have} for t in range(min(x for q, x in have if q == p), max(x for q, x in have if q == p))
                  if (p, t) not in have)
    got = sorted((r.id_partida, r.tic) for r in series(gaps, ["id_partida", "id_jugador"], "lo", "hi").collect())
    assert got == want
    intervals = sorted((r.id_partida, r.lo, r.hi) for r in gaps.collect())
    assert all(lo <= hi for _, lo, hi in intervals) and sum(hi - lo + 1 for _, lo, hi in intervals) == len(want)


def test_only_gaps_are_expanded(spark):
    w = seed.build(spark, 2000)
    w.tick_event = w.tick_event.filter("tic % 1000 != 500")
    plan = an.tick_grid_gaps(w)
    assert plan.count() == 6 * 2
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftAnti" not in text and len(re.findall("LogicalRDD|LocalRelation|Range ", text)) <= 4


def test_foreign_keys_scan_each_child_once(spark, tmp_path):
    w = seed.build(spark, 12)
    tables = {n: w.table(n) for n in S.KEYS}
    tables["tick_event"] = tables["tick_event"].unionByName(
        tables["tick_event"].limit(3).withColumn("id_jugador", F.lit(77).cast("long")).withColumn("id_sector", F.lit(None).cast("long")))
    for n, df in tables.items():
        df.write.parquet(str(tmp_path / n))
    stored = {n: spark.read.parquet(str(tmp_path / n)) for n in tables}
    found = AU.foreign_key_violations(stored, S.KEYS)
    assert [tuple(r) for r in found.collect()] == [("tick_event", "fk_tick_event_id_jugador", "77", 3)]
    plan = found._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    children = sum(bool(k.foreign) for k in S.KEYS.values())
    parents = len({(parent, cols) for k in S.KEYS.values() for _, parent, cols in k.foreign})
    assert plan.count("FileScan parquet") == children + parents
    assert plan.count("LeftOuter") == 1 and "LeftAnti" not in plan


def test_reload_cascades_and_numbers_anew(spark, tmp_path):
    w = seed.build(spark, 4)
    for n in S.KEYS:
        SK.reload(w.table(n), str(tmp_path / n))
    rows = w.map.filter("id_mapa < 3").select("id_mapa", "id_episodio", "codigo_mapa", "nombre_mapa")
    emptied = SK.reload_cascade(rows.withColumn("id_mapa", F.col("id_mapa") + 40), str(tmp_path), "map", S.KEYS, "id_mapa", ["codigo_mapa"])
    assert emptied == ["participation", "survey_response", "tick_event", "sector", "session"]
    stored = {n: spark.read.parquet(str(tmp_path / n)) for n in S.KEYS}
    assert sorted(r.id_mapa for r in stored["map"].collect()) == [1, 2]
    assert all(stored[n].count() == 0 for n in emptied) and stored["player"].count() == 6
    assert stored["tick_event"].schema.simpleString() == w.tick_event.select(*stored["tick_event"].columns).schema.simpleString()
    assert AU.foreign_key_violations(stored, S.KEYS).count() == 0
    # Reloading a leaf empties nothing.
    assert SK.reload_cascade(w.tick_event, str(tmp_path), "tick_event", S.KEYS) == []


def test_dependents_of_a_cycle_are_refused():
    keys = {"a": S.TableKeys("a", ("i",), (), ((("j",), "b", ("i",)),)), "b": S.TableKeys("b", ("i",), (), ((("j",), "a", ("i",)),)),
            "c": S.TableKeys("c", ("i",), (), ((("j",), "d", ("i",)), (("k",), "c", ("i",)))), "d": S.TableKeys("d", ("i",), (), ((("j",), "c", ("i",)),)),
            "e": S.TableKeys("e", ("i",))}
    keys["c"] = S.TableKeys("c", ("i",), (), ((("j",), "d", ("i",)), (("k",), "e", ("i",))))
    with pytest.raises(ValueError):
        SK.dependents("e", keys)
