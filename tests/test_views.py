"""SQL runs through Spark SQL on views named like the reference's tables."""

from ticklake.sources.views import register_reference_views

import seed


def test_sql_on_reference_named_views(spark):
    w = seed.build(spark, 12)
    names = register_reference_views(spark, w)
    assert "evento_telemetria" in names
    rows = spark.sql("""
        SELECT codigo_mapa, COUNT(*) AS filas, MAX(tic) AS ultimo
        FROM mapa JOIN partida USING (id_mapa) JOIN evento_telemetria USING (id_partida)
        GROUP BY codigo_mapa""").collect()
    assert {(r.codigo_mapa, r.filas, r.ultimo) for r in rows} == {("M1", 24, 12), ("M2", 24, 12), ("M3", 24, 12)}
