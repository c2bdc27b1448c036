"""Register a warehouse's tables as SQL views under the reference's table names,
so existing SQL can run through Spark SQL (Catalyst plans it like the DataFrame
jobs). Dialect differences still apply: no ``::`` casts, ``DISTINCT ON`` or
``EXTRACT(EPOCH ...)`` in Spark SQL (use CAST, a window, ``unix_micros``)."""

from __future__ import annotations

from pyspark.sql import SparkSession

# The reference's table names for each star table.
REFERENCE_NAMES = {
    "episode": "episodio",
    "map": "mapa",
    "sector": "sector",
    "volunteer": "usuario",
    "player": "jugador",
    "session": "partida",
    "participation": "participante_partida",
    "tick_event": "evento_telemetria",
    "instrument": "instrumento_ux",
    "survey_item": "item_ux",
    "survey_response": "respuesta_ux",
}


def register_reference_views(spark: SparkSession, w) -> list[str]:
    """Create or replace one temp view per star table; returns the view names."""
    for table, view in REFERENCE_NAMES.items():
        w.table(table).createOrReplaceTempView(view)
    return list(REFERENCE_NAMES.values())
