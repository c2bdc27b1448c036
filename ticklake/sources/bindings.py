"""Binding of the driver's parquet tables to the telemetry/survey star schema.

Every star table is a lazy DataFrame derived from the driver tables, so all
work grows with them and Catalyst prunes/pushes through the derivation. The
DuckDB oracle (``ticklake.oracle``) derives the same tables in SQL.

    episode          <- region
    map              <- nation
    sector           <- supplier (acctbal as x, 0 as y)
    volunteer/player <- customer (consent = acctbal >= 0)
    session          <- events by day and group of 100 users (a bounded room);
                        map = nation of the session's supplier, in turn over all;
                        sessions of the last day are open
    tick_event       <- events: player = user, tick = ten minutes of the day, first
                        event_id per (session, player, tick); other copies of a
                        key are in the staging and end in the reject log
    survey_item      <- nation, whole
    survey_response  <- every event
    staging          <- every event as text, with faults injected by event_id
    preloaded_fact   <- sessions of the first half of the days: the fact before
                        a load
"""

from __future__ import annotations

import hashlib
import threading
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticklake import schemas as S
from ticklake.operators.joins import scalar
from ticklake.session import scratch_path

# Fixed values of the binding.
EPOCH_DAY = "2024-01-01"          # day 0 of the session numbering
ROOM = 100                        # users that share a session on a day
DAYS = 366                        # session id = room * DAYS + day: days of one year
ITEMS = 25                        # rows of nation at every scale factor
# Faults that no real key can ever equal: the largest values of the key types.
NO_PLAYER = "9000000000000000000"
NO_SESSION = "2147483647"


def _str(c):
    return c.cast("string")


# Derived tables already written in this application: (app id, sf_dir, stamp, table).
_STORED: set[tuple[str, str, str, str]] = set()
_LOCK = threading.Lock()
SOURCES = ("region", "nation", "customer", "supplier", "events")


def source_stamp(spark: SparkSession, sf_dir: str) -> str:
    """Digest of path, size and modification time of the source files: tables
    stored from other files are not taken for tables of these."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    seen = []
    for name in SOURCES:
        path = jvm.org.apache.hadoop.fs.Path(f"{sf_dir.rstrip('/')}/{name}.parquet")
        fs = path.getFileSystem(conf)
        files = fs.listFiles(path, True) if fs.exists(path) else None
        while files is not None and files.hasNext():
            f = files.next()
            seen.append((f.getPath().toString(), f.getLen(), f.getModificationTime()))
    return hashlib.sha1(repr(sorted(seen)).encode()).hexdigest()[:16]


class Warehouse:
    """Lazily bound star schema over one scale-factor directory."""

    def __init__(self, spark: SparkSession, sf_dir: str, materialize: bool = True):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self.materialize = materialize
        self.stamp = source_stamp(spark, self.sf_dir)

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def _stored(self, name: str, df: DataFrame, sort_by: tuple[str, ...] = (),
                range_by: tuple[str, ...] = ()) -> DataFrame:
        """Write a derived table once per application under the shared checkpoint
        folder and scan it from there (the loaded warehouse): later queries get
        real size statistics, pushdown into the stored files, and no lineage
        back to the raw tables (an executor loss recomputes from the files)."""
        if not self.materialize:
            return df
        app = self.spark.sparkContext.applicationId
        tag = hashlib.sha1(f"{app}|{self.sf_dir}|{self.stamp}".encode()).hexdigest()[:16]
        path = scratch_path(self.spark, f"star/{tag}/{name}")
        key = (app, self.sf_dir, self.stamp, name)
        with _LOCK:
            if key not in _STORED:
                out = df.repartitionByRange(*range_by) if range_by else df
                out = out.sortWithinPartitions(*sort_by) if sort_by else out
                out.write.mode("overwrite").parquet(path)
                _STORED.add(key)
        return self.spark.read.parquet(path)

    # ---------------------------------------------------------------- events
    @cached_property
    def events(self) -> DataFrame:
        ev = self.read("events")
        day = F.datediff(F.to_date("ts"), F.to_date(F.lit(EPOCH_DAY))).cast("int")
        # A later day would be numbered into the next room's sessions: better no table than a wrong one.
        numbered = F.when(day.between(0, DAYS - 1), day).otherwise(
            F.raise_error(F.lit(f"events outside of {DAYS} days from {EPOCH_DAY}")).cast("int"))
        return ev.select(
            "event_id", "ts", "user_id", "event_type", "value", day.alias("day"),
            (F.floor(F.col("user_id") / ROOM) * DAYS + numbered).cast("int").alias("partida"),
            (F.hour("ts") * 6 + F.floor(F.minute("ts") / 10)).cast("int").alias("tic"),
            F.get_json_object("props", "$.k").cast("int").alias("k"),
        )

    @property
    def _sectors(self):
        """Number of sector ids, as a scalar subquery (supplier keys start at 0)."""
        return scalar(self.read("supplier").agg((F.max("s_suppkey") + 1).alias("n")), "n")

    @property
    def _last_day(self):
        return scalar(self.events.agg(F.max("day").alias("d")), "d")

    def _sector_of(self, kind, partida):
        """Of an event kind (0 view, 1 error, 2 other): none, one off the session's map, the session's."""
        return (F.when(kind == 0, F.lit(None))
                .when(kind == 1, (partida + 3) % self._sectors)
                .otherwise(partida % self._sectors)).cast("long")

    @staticmethod
    def _kind(event_type):
        return F.when(event_type == "view", 0).when(event_type == "error", 1).otherwise(2)

    # ------------------------------------------------------------ dimensions
    @cached_property
    def episode(self) -> DataFrame:
        return self.read("region").select(
            F.col("r_regionkey").cast("int").alias("id_episodio"),
            F.col("r_name").alias("nombre_episodio"))

    @cached_property
    def map(self) -> DataFrame:
        return self.read("nation").select(
            F.col("n_nationkey").cast("int").alias("id_mapa"),
            F.col("n_regionkey").cast("int").alias("id_episodio"),
            F.col("n_name").alias("codigo_mapa"),
            F.col("n_name").alias("nombre_mapa"))

    @cached_property
    def sector(self) -> DataFrame:
        return self.read("supplier").select(
            F.col("s_suppkey").cast("long").alias("id_sector"),
            F.col("s_nationkey").cast("int").alias("id_mapa"),
            F.col("s_name").alias("codigo_sector"),
            F.col("s_acctbal").cast(S.COORD).alias("coordenada_x"),
            F.lit(0).cast(S.COORD).alias("coordenada_y"))

    @cached_property
    def volunteer(self) -> DataFrame:
        return self.read("customer").select(
            F.col("c_custkey").cast("long").alias("id_usuario"),
            F.col("c_name").alias("codigo_anonimo"),
            (F.col("c_custkey") % 100).cast("int").alias("edad"),
            F.lit(None).cast("string").alias("genero"),
            F.col("c_mktsegment").alias("experiencia"),
            (F.col("c_acctbal") >= 0).alias("consentimiento"),
            F.to_timestamp_ntz(F.lit(f"{EPOCH_DAY} 00:00:00")).alias("fecha_registro"))

    @cached_property
    def player(self) -> DataFrame:
        return self.read("customer").select(
            F.col("c_custkey").cast("long").alias("id_jugador"),
            F.col("c_name").alias("alias"),
            F.col("c_custkey").cast("long").alias("id_usuario"))

    @cached_property
    def session(self) -> DataFrame:
        return self._stored("session", self._derive_session())

    def _derive_session(self) -> DataFrame:
        rooms = self.events.groupBy("partida").agg(F.min("ts").alias("fecha_inicio"),
                                                   F.max("ts").alias("fecha_fin"))
        rooms = rooms.withColumn("base", (F.col("partida") % self._sectors).cast("long"))
        sup = self.read("supplier").select(F.col("s_suppkey").cast("long").alias("base"), "s_nationkey")
        return (rooms.join(sup, "base", "left")
                .select(F.col("partida").alias("id_partida"),
                        F.col("s_nationkey").cast("int").alias("id_mapa"),
                        "fecha_inicio",
                        F.when(F.col("partida") % DAYS == self._last_day, F.lit(None))
                        .otherwise(F.col("fecha_fin")).cast(S.TS).alias("fecha_fin"),
                        F.lit(None).cast("string").alias("configuracion")))

    @cached_property
    def instrument(self) -> DataFrame:
        return self.spark.createDataFrame([(1, "UX_SURVEY", None)], S.INSTRUMENT)

    @cached_property
    def survey_item(self) -> DataFrame:
        return self.read("nation").select(
            F.col("n_nationkey").cast("long").alias("id_item"),
            F.col("n_name").alias("texto_pregunta"),
            F.concat(F.lit("region_"), F.col("n_regionkey").cast("string")).alias("dimension"),
            F.lit(1).alias("id_instrumento"))

    # ----------------------------------------------------------------- facts
    @cached_property
    def tick_event(self) -> DataFrame:
        # Clustered layout (the re-aimed (session, player, tick) index): files
        # hold session ranges, sorted inside, so min/max statistics prune scans.
        return self._stored("tick_event", self._derive_tick_event(),
                            sort_by=("id_partida", "id_jugador", "tic"),
                            range_by=("id_partida", "id_jugador"))

    def _derive_tick_event(self) -> DataFrame:
        """One row per (session, player, tick): the lowest event_id wins.

        A grouped aggregate (partial aggregation map-side) rather than a
        window, so a hot key is combined before the shuffle.
        """
        ev = self.events
        # Fixed-width aggregation buffers (min_by over numbers) keep this a
        # hash aggregate with map-side combine; the event type is only needed
        # as its sector rule: 0 = view, 1 = error, 2 = other.
        kind = self._kind(F.col("event_type"))
        eid = F.col("event_id")
        first = (ev.groupBy("partida", "user_id", "tic")
                 .agg(F.min(eid).alias("event_id"), F.min_by(kind, eid).alias("kind"),
                      F.min_by("value", eid).alias("value"), F.min_by("k", eid).alias("k")))
        return first.select(
            F.col("event_id").cast("long").alias("id_evento"),
            F.col("partida").alias("id_partida"),
            F.col("user_id").cast("long").alias("id_jugador"),
            self._sector_of(F.col("kind"), F.col("partida")).alias("id_sector"),
            "tic",
            F.col("value").cast(S.POS).alias("pos_x"),
            F.col("k").cast(S.POS).alias("pos_y"),
            F.floor(F.col("tic") / 6).cast(S.POS).alias("pos_z"),
            F.lit(0).cast(S.ANGLE).alias("angulo"),
            F.lit(0).cast(S.MOMENTUM).alias("momentum_x"),
            F.lit(0).cast(S.MOMENTUM).alias("momentum_y"),
            F.lit(0).cast(S.MOMENTUM).alias("momentum_z"),
            F.lit(90).cast(S.FOV).alias("fov"),
            F.col("k").alias("salud"),
            F.lit(100).alias("armadura"),
            (F.col("event_id") % 50).cast("int").alias("municion"))

    @cached_property
    def participation(self) -> DataFrame:
        te = self.tick_event.select("id_partida", "id_jugador").distinct()
        return self._stored("participation", te.select(
            ((F.col("id_partida").cast("long") * F.lit(1 << 32)) + F.col("id_jugador"))
            .alias("id_participante"),
            "id_partida", "id_jugador", F.lit(None).cast("string").alias("rol")))

    @cached_property
    def survey_response(self) -> DataFrame:
        ev = self.events
        return ev.select(F.col("event_id").cast("long").alias("id_respuesta"),
                         F.col("ts").alias("fecha_respuesta"),
                         F.col("user_id").cast("long").alias("id_usuario"),
                         (F.col("k") % ITEMS).cast("long").alias("id_item"),
                         F.lit(1).alias("id_instrumento"),
                         F.col("partida").alias("id_partida"),
                         F.col("value").try_cast(S.SCORE).alias("valor_respuesta"))

    @cached_property
    def preloaded_fact(self) -> DataFrame:
        """The fact as it stands before a load: the sessions of the first half of the days."""
        return self.tick_event.filter(F.col("id_partida") % DAYS * 2 < self._last_day)

    # --------------------------------------------------------------- staging
    @cached_property
    def staging(self) -> DataFrame:
        """Every event rendered as the 15 text fields of a telemetry line, with faults."""
        ev = self.events
        eid, partida, tic, k = F.col("event_id"), F.col("partida"), F.col("tic"), F.col("k")
        null = F.lit(None).cast("string")
        session = (F.when(eid % 31 == 0, null)
                   .when(eid % 31 == 1, F.lit("  "))
                   .when(eid % 31 == 2, F.concat(F.lit("0"), _str(partida)))
                   .when(eid % 61 == 7, F.lit(NO_SESSION))
                   .otherwise(_str(partida)))
        player = (F.when(eid % 37 == 0, F.lit("12x"))
                  .when(eid % 41 == 0, F.lit(NO_PLAYER))
                  .otherwise(_str(F.col("user_id"))))
        tick = F.when(eid % 43 == 0, _str(-tic)).otherwise(_str(tic))
        health = (F.when(eid % 47 == 0, null)
                  .when(eid % 47 == 1, F.lit(""))
                  .when(eid % 71 == 0, F.lit("99999999999"))
                  .otherwise(_str(k)))
        sector = _str(self._sector_of(self._kind(F.col("event_type")), partida))
        return ev.select(
            session.alias("raw_id_partida"), player.alias("raw_id_jugador"),
            tick.alias("raw_tic"),
            _str(F.col("value").cast(S.POS)).alias("raw_pos_x"),
            _str(k).alias("raw_pos_y"), _str(F.floor(tic / 6)).alias("raw_pos_z"),
            F.lit("0.0000").alias("raw_angulo"),
            F.lit("0.0000").alias("raw_momentum_x"), F.lit("0.0000").alias("raw_momentum_y"),
            F.lit("0.0000").alias("raw_momentum_z"),
            F.lit("90.00").alias("raw_fov"), health.alias("raw_salud"),
            F.lit("100").alias("raw_armadura"), _str(eid % 50).alias("raw_municion"),
            sector.alias("raw_id_sector"),
            F.lit("events").alias("archivo_origen"),
            F.col("ts").alias("cargado_en"),
            F.col("event_id").alias("_row_id"))

    def table(self, name: str) -> DataFrame:
        return getattr(self, name)


STAR_TABLES = ("episode", "map", "sector", "volunteer", "player", "session", "participation",
               "tick_event", "instrument", "survey_item", "survey_response")
