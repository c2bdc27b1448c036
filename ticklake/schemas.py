"""Schemas of the telemetry/survey warehouse and its key metadata.

Ids that come from 64-bit source keys stay ``LongType`` so the engine does not
overflow at cluster scale; the session id (a day number) and the tick are ints.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

I, L, S, B = T.IntegerType(), T.LongType(), T.StringType(), T.BooleanType()
TS = T.TimestampNTZType()
POS = T.DecimalType(12, 4)
ANGLE = T.DecimalType(8, 4)
MOMENTUM = T.DecimalType(10, 4)
FOV = T.DecimalType(6, 2)
COORD = T.DecimalType(10, 2)
SCORE = T.DecimalType(5, 2)


def _st(*fields):
    return T.StructType([T.StructField(n, t, nullable) for n, t, nullable in fields])


EPISODE = _st(("id_episodio", I, False), ("nombre_episodio", S, False))
MAP = _st(("id_mapa", I, False), ("id_episodio", I, False), ("codigo_mapa", S, False),
          ("nombre_mapa", S, True))
SECTOR = _st(("id_sector", L, False), ("id_mapa", I, False), ("codigo_sector", S, False),
             ("coordenada_x", COORD, True), ("coordenada_y", COORD, True))
VOLUNTEER = _st(("id_usuario", L, False), ("codigo_anonimo", S, False), ("edad", I, True),
                ("genero", S, True), ("experiencia", S, True), ("consentimiento", B, False),
                ("fecha_registro", TS, False))
PLAYER = _st(("id_jugador", L, False), ("alias", S, False), ("id_usuario", L, False))
SESSION = _st(("id_partida", I, False), ("id_mapa", I, True), ("fecha_inicio", TS, False),
              ("fecha_fin", TS, True), ("configuracion", S, True))
PARTICIPATION = _st(("id_participante", L, False), ("id_partida", I, False),
                    ("id_jugador", L, False), ("rol", S, True))
TICK_EVENT = _st(("id_evento", L, False), ("id_partida", I, False), ("id_jugador", L, False),
                 ("id_sector", L, True), ("tic", I, False),
                 ("pos_x", POS, True), ("pos_y", POS, True), ("pos_z", POS, True),
                 ("angulo", ANGLE, True), ("momentum_x", MOMENTUM, True),
                 ("momentum_y", MOMENTUM, True), ("momentum_z", MOMENTUM, True),
                 ("fov", FOV, True), ("salud", I, True), ("armadura", I, True),
                 ("municion", I, True))
INSTRUMENT = _st(("id_instrumento", I, False), ("nombre", S, False), ("descripcion", S, True))
SURVEY_ITEM = _st(("id_item", L, False), ("texto_pregunta", S, False), ("dimension", S, True),
                  ("id_instrumento", I, False))
SURVEY_RESPONSE = _st(("id_respuesta", L, False), ("fecha_respuesta", TS, False),
                      ("id_usuario", L, False), ("id_item", L, False),
                      ("id_instrumento", I, False), ("id_partida", I, True),
                      ("valor_respuesta", SCORE, True))

# The 15 raw text fields of a telemetry line, in file order.
RAW_FIELDS = [
    "raw_id_partida", "raw_id_jugador", "raw_tic",
    "raw_pos_x", "raw_pos_y", "raw_pos_z", "raw_angulo",
    "raw_momentum_x", "raw_momentum_y", "raw_momentum_z",
    "raw_fov", "raw_salud", "raw_armadura", "raw_municion", "raw_id_sector",
]
STAGING = _st(*[(f, S, True) for f in RAW_FIELDS],
              ("archivo_origen", S, False), ("cargado_en", TS, False))
REJECT_LOG = _st(("id_log", L, False), ("origen", S, False), ("linea_raw", S, False), ("motivo", S, False),
                 ("registrado_en", TS, False), ("id_lote", S, False))


@dataclass(frozen=True)
class TableKeys:
    """Declared keys and checks of one table (enforced as audits, not by storage)."""
    name: str
    primary: tuple[str, ...]
    unique: tuple[tuple[str, ...], ...] = ()
    foreign: tuple[tuple[tuple[str, ...], str, tuple[str, ...]], ...] = ()
    checks: tuple[tuple[str, str], ...] = ()          # (name, SQL boolean expression)
    max_length: dict = field(default_factory=dict)    # VARCHAR(n) limits


KEYS = {
    "episode": TableKeys("episode", ("id_episodio",), (("nombre_episodio",),),
                         max_length={"nombre_episodio": 80}),
    "map": TableKeys("map", ("id_mapa",), (("id_episodio", "codigo_mapa"),),
                     ((("id_episodio",), "episode", ("id_episodio",)),),
                     max_length={"codigo_mapa": 10, "nombre_mapa": 80}),
    "sector": TableKeys("sector", ("id_sector",), (("id_mapa", "codigo_sector"),),
                        ((("id_mapa",), "map", ("id_mapa",)),),
                        max_length={"codigo_sector": 20}),
    "volunteer": TableKeys("volunteer", ("id_usuario",), (("codigo_anonimo",),),
                           checks=(("edad_rango", "edad BETWEEN 10 AND 99"),),
                           max_length={"codigo_anonimo": 32, "genero": 20, "experiencia": 20}),
    "player": TableKeys("player", ("id_jugador",), (("id_usuario", "alias"),),
                        ((("id_usuario",), "volunteer", ("id_usuario",)),),
                        max_length={"alias": 50}),
    "session": TableKeys("session", ("id_partida",), (),
                         ((("id_mapa",), "map", ("id_mapa",)),),
                         checks=(("fin_despues_inicio",
                                  "fecha_fin IS NULL OR fecha_fin >= fecha_inicio"),)),
    "participation": TableKeys("participation", ("id_participante",), (("id_partida", "id_jugador"),),
                               ((("id_partida",), "session", ("id_partida",)),
                                (("id_jugador",), "player", ("id_jugador",))),
                               max_length={"rol": 30}),
    "tick_event": TableKeys("tick_event", ("id_evento",), (("id_partida", "id_jugador", "tic"),),
                            ((("id_partida",), "session", ("id_partida",)),
                             (("id_jugador",), "player", ("id_jugador",)),
                             (("id_sector",), "sector", ("id_sector",))),
                            checks=(("tic_no_negativo", "tic >= 0"),
                                    ("salud_no_negativa", "salud >= 0"),
                                    ("armadura_no_negativa", "armadura >= 0"),
                                    ("municion_no_negativa", "municion >= 0"))),
    "instrument": TableKeys("instrument", ("id_instrumento",), (("nombre",),),
                            max_length={"nombre": 50}),
    "survey_item": TableKeys("survey_item", ("id_item",), (),
                             ((("id_instrumento",), "instrument", ("id_instrumento",)),),
                             max_length={"texto_pregunta": 255, "dimension": 40}),
    "survey_response": TableKeys("survey_response", ("id_respuesta",), (),
                                 ((("id_usuario",), "volunteer", ("id_usuario",)),
                                  (("id_item",), "survey_item", ("id_item",)),
                                  (("id_instrumento",), "instrument", ("id_instrumento",)),
                                  (("id_partida",), "session", ("id_partida",)))),
}

NOT_NULL = {name: [f.name for f in st.fields if not f.nullable] for name, st in {
    "episode": EPISODE, "map": MAP, "sector": SECTOR, "volunteer": VOLUNTEER,
    "player": PLAYER, "session": SESSION, "participation": PARTICIPATION,
    "tick_event": TICK_EVENT, "instrument": INSTRUMENT, "survey_item": SURVEY_ITEM,
    "survey_response": SURVEY_RESPONSE}.items()}
