"""The validating load: staging -> (reject log, accepted facts), plus its report.

``IngestJob`` is the production path. The batch is classified once and written
to shared storage as rejects and candidates; the candidates are checked for
duplicates and written once more as what becomes log and what becomes fact. So
the fact it appends to is never re-read by the same classification (lazy
evaluation would otherwise turn accepted rows into DUP_CORE). Each output
replaces the batch's partition as a whole, so a crash or a corrected re-run
leaves no rows behind. Ids are the rows' places in the written files, and the
counts of the load are observed while it writes: neither costs a job over rows.

The fact is partitioned by batch and by range of sessions and bucketed by its
key. A batch's ranges have ``RANGE`` ids each, doubled until they hold
``RANGE_ROWS`` rows on average: its files follow its rows, not the spread of its
ids. The duplicate check reads only the ranges that the batch has candidates
in, and reads them where they lie: the candidates are shuffled to the fact's
buckets, not the fact.

The ``etl_*`` functions expose each step over the bound driver tables.
"""

from __future__ import annotations

import datetime
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ticklake import schemas as S
from ticklake.operators import classify as C
from ticklake.operators.audit import row_numbers
from ticklake.session import scratch_path
from ticklake.sinks.bucketed import BucketedTable
from ticklake.sinks.tables import BATCH_COL, delete_path, path_exists, read_or_empty, with_batch, write_batch
from ticklake.sources.bindings import Warehouse

LOG_COLUMNS = ["origen", "linea_raw", "motivo"]
# Partition column of the fact: ranges of RANGE session ids, or of RANGE doubled some times.
RANGE_COL = "rango"
RANGE = 1024
# Rows that a range of a batch holds on average at least, where the batch has so many.
RANGE_ROWS = 1 << 20
# Binary digits of a session id.
ID_BITS = 31
# So many ranges are named one by one in the partition filter; more are joined.
MOST_RANGES = 16384
# Partition of the load's scratch tables: goes to the log, is a candidate, is accepted.
KIND = "clase"
TO_LOG, CANDIDATES, ACCEPTED = "L", "C", "A"


def session_range(session, doubled: int = 0):
    """The range of a session id, with RANGE doubled so many times: a number of its own for each width."""
    narrow = F.floor(F.col(session) / RANGE).cast("int")
    return narrow if not doubled else widened(narrow, doubled)


def widened(narrow, doubled: int):
    """The wider range that holds a narrow one: below zero, numbered through as nodes of a binary tree."""
    return (F.lit(-(1 << (ID_BITS - doubled))) - F.shiftright(narrow, doubled)).cast("int") if doubled else narrow


def classified(w: Warehouse) -> DataFrame:
    """The bound staging classified against the pre-loaded fact (built once per warehouse)."""
    cls = getattr(w, "_classified", None)
    if cls is None:
        primary = w._stored("classified_primary", C.classify_primary(
            w.staging, w.player, w.volunteer, w.session, w.sector))
        cls = C.mark_duplicates(primary, w.preloaded_fact)
        w._classified = cls
    return cls


def reject_log(w: Warehouse) -> DataFrame:
    return C.reject_log(classified(w))


def _by_reason(reason: str):
    def fn(w: Warehouse) -> DataFrame:
        return reject_log(w).filter(F.col("motivo") == reason).select(*LOG_COLUMNS)
    fn.__name__ = f"etl_{reason.lower()}"
    return fn


etl_missing_key = _by_reason(C.MISSING_KEY)
etl_bad_type = _by_reason(C.BAD_TYPE)
etl_overflow = _by_reason(C.OVERFLOW)
etl_out_of_range = _by_reason(C.OUT_OF_RANGE)
etl_fk_player = _by_reason(C.FK_PLAYER)
etl_fk_session = _by_reason(C.FK_SESSION)
etl_fk_sector = _by_reason(C.FK_SECTOR)
etl_no_consent = _by_reason(C.NO_CONSENT)
etl_dup_batch = _by_reason(C.DUP_BATCH)
etl_dup_core = _by_reason(C.DUP_CORE)
etl_unclassified = _by_reason(C.UNCLASSIFIED)


def etl_reject_log(w: Warehouse) -> DataFrame:
    return reject_log(w).select(*LOG_COLUMNS)


def etl_accept(w: Warehouse) -> DataFrame:
    return C.accepted(classified(w))


def etl_summary(w: Warehouse) -> DataFrame:
    """Post-load report: staging count, fact count after the load, rejects by reason."""
    cls = classified(w)
    log = C.reject_log(cls)
    staging_n = w.staging.agg(F.count(F.lit(1)).alias("cantidad")).select(
        F.lit("total_staging").alias("metrica"), "cantidad")
    core_n = (w.preloaded_fact.select(F.lit(1).alias("x"))
              .unionByName(C.accepted(cls).select(F.lit(1).alias("x")))
              .agg(F.count(F.lit(1)).alias("cantidad"))
              .select(F.lit("total_core_acumulado").alias("metrica"), "cantidad"))
    reasons = log.groupBy(F.col("motivo").alias("metrica")).agg(F.count(F.lit(1)).alias("cantidad"))
    return staging_n.unionByName(core_n).unionByName(reasons).orderBy(F.desc("cantidad"), "metrica")


def numbered_log(w: Warehouse) -> DataFrame:
    """The bound log with its ids, stored: it is registered as its lines were loaded, and log ids
    number it in the order of (load time, origin, line, reason)."""
    order = ("registrado_en", "origen", "linea_raw", "motivo")
    log = reject_log(w).select(F.col("cargado_en").alias("registrado_en"), "origen", "linea_raw", "motivo")
    return w._stored("numbered_log", row_numbers(w._stored("ordered_log", log, sort_by=order, range_by=order), "id_log"))


def recent_rejects(log: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` rejects registered last (LIM-1): a top-k over the stored ids."""
    return log.orderBy(F.desc("registrado_en"), F.desc("id_log")).limit(k).select("id_log", "origen", "motivo", "registrado_en")


def topk_recent_rejects(w: Warehouse, k: int = 10) -> DataFrame:
    return recent_rejects(numbered_log(w), k)


def accounting(w: Warehouse) -> DataFrame:
    """Every staging row is accepted or carries a primary reason (property check)."""
    cls = classified(w)
    return cls.groupBy(F.col("_reason").alias("motivo")).agg(F.count(F.lit(1)).alias("filas"))


# --------------------------------------------------------------------- job
@dataclass
class IngestPaths:
    fact: str         # tick_event fact, partitioned by id_lote and session range, bucketed by its key
    log: str          # reject log, partitioned by id_lote
    buckets: int = 16  # of a new fact: keys of the ranges that a load touches, divided by it, fit a task


class IngestJob:
    """Run one validated load of a staging batch into the fact table."""

    def __init__(self, spark: SparkSession, paths: IngestPaths, player: DataFrame,
                 volunteer: DataFrame, session: DataFrame, sector: DataFrame,
                 seed_fact: DataFrame | None = None):
        self.spark, self.paths = spark, paths
        self.player, self.volunteer, self.session, self.sector = player, volunteer, session, sector
        self.seed_fact = seed_fact
        self.fact = BucketedTable(spark, paths.fact, S.TICK_EVENT, C.FACT_KEY,
                                  [S.T.StructField(RANGE_COL, S.I, False)], paths.buckets)

    def stored_fact(self, exclude_batch: str) -> DataFrame:
        return self.fact.read().filter(F.col(BATCH_COL) != F.lit(exclude_batch))

    def current_fact(self, exclude_batch: str, candidates: DataFrame) -> DataFrame:
        """Keys of the fact in the session ranges of the candidates.

        Up to MOST_RANGES ranges are named one by one in the partition filter:
        a bounded number of values reaches the driver. More are joined.
        """
        fact = self.stored_fact(exclude_batch)
        ranges = candidates.select(session_range("id_partida").alias(RANGE_COL)).distinct()
        narrow = ranges.limit(MOST_RANGES + 1)
        # The batches' ranges of each width that hold the narrow ones.
        widths = [widened(F.col(RANGE_COL), k) for k in sorted({0, *self._widths()})]
        if narrow.count() > MOST_RANGES:
            fact = fact.join(ranges.select(F.explode(F.array(*widths)).alias(RANGE_COL)).distinct(), RANGE_COL, "left_semi")
        else:
            named = narrow.select(F.explode(F.array(*widths)).alias(RANGE_COL)).distinct()
            fact = fact.filter(F.col(RANGE_COL).isin([x[0] for x in named.collect()]))
        return fact.select(*C.FACT_KEY)

    def _widths(self) -> list[int]:
        """How often RANGE was doubled, of all batches so far: from the list beside the fact."""
        noted = read_or_empty(self.spark, f"{self.paths.fact}/_anchos", S.T.StructType.fromDDL("doblado int"))
        return [x[0] for x in noted.distinct().collect()]

    def _width(self, accepted: DataFrame, n: int) -> int:
        """How often to double RANGE for ``n`` accepted rows, noted beside the fact."""
        widest = ID_BITS - (RANGE.bit_length() - 1)
        narrow = accepted.select(session_range("id_partida").alias(RANGE_COL)).distinct()
        ranges = narrow.agg(*[F.approx_count_distinct(F.shiftright(RANGE_COL, k)) for k in range(widest)]).head()
        doubled = next((k for k, m in enumerate(ranges) if m <= 1 or n >= m * RANGE_ROWS), widest)
        if doubled not in self._widths():
            self.spark.range(1).select(F.lit(doubled).alias("doblado")).coalesce(1).write.mode("append").parquet(f"{self.paths.fact}/_anchos")
        return doubled

    def _largest(self, path: str, table: DataFrame, name: str, batch_id: str) -> int:
        """The largest id given to other batches: from the list beside the table, or from a table without one."""
        if path_exists(self.spark, f"{path}/_ultimos"):
            last = read_or_empty(self.spark, f"{path}/_ultimos", S.T.StructType.fromDDL(f"ultimo long, {BATCH_COL} string"))
            return last.filter(F.col(BATCH_COL) != F.lit(batch_id)).agg(F.max("ultimo")).head()[0] or 0
        return table.filter(F.col(BATCH_COL) != F.lit(batch_id)).agg(F.max(name)).head()[0] or 0

    def _note_largest(self, path: str, last: int, batch_id: str) -> None:
        write_batch(with_batch(self.spark.range(1).select(F.lit(last).cast("long").alias("ultimo")).coalesce(1), batch_id),
                    f"{path}/_ultimos", batch_id)

    def run(self, staging: DataFrame, batch_id: str, stats: bool = True) -> dict:
        """Load a batch in place of what it loaded before; returns its counts (``stats``: or its id alone)."""
        if "_row_id" not in staging.columns:
            staging = staging.withColumn("_row_id", F.monotonically_increasing_id())
        # The folder is this run's alone: jobs into other tables may use the same batch id.
        root = scratch_path(self.spark, f"ingest/{uuid.uuid4().hex}")
        seen, checked = Observation(), Observation()
        is_candidate = F.coalesce(F.col("_reason") == F.lit(C.CANDIDATE), F.lit(False))
        primary = (C.classify_primary(staging, self.player, self.volunteer, self.session, self.sector)
                   .select(*C.ACCEPTED_COLUMNS, "archivo_origen", "linea_raw", "cargado_en", "_row_id", "_reason",
                           F.when(is_candidate, CANDIDATES).otherwise(TO_LOG).alias(KIND)))
        classified_rows = self._written(primary.observe(seen, F.count(F.lit(1)).alias("rows"),
                                                        F.count_if(F.col(KIND) == TO_LOG).alias("rejects")), f"{root}/classified")
        candidates = classified_rows.filter(F.col(KIND) == CANDIDATES).drop(KIND)
        # The fact as read here excludes this batch's own partition, so writing the
        # accepted rows cannot change what the duplicate check sees.
        facts = [self.current_fact(batch_id, candidates)]
        if self.seed_fact is not None:
            facts.append(self.seed_fact)
        outputs = (C.flag_duplicates(candidates, facts, self.fact.stored_buckets())
                   .select(*C.ACCEPTED_COLUMNS, "archivo_origen", "linea_raw", F.explode_outer(C.duplicate_reasons()).alias("motivo"))
                   .withColumn(KIND, F.when(F.col("motivo").isNull(), ACCEPTED).otherwise(TO_LOG)))
        checked_rows = self._written(outputs.observe(checked, F.count_if(F.col(KIND) == ACCEPTED).alias("accepted"),
                                                     F.count_if(F.col(KIND) == TO_LOG).alias("rejects")), f"{root}/checked")
        found, kept = seen.get, checked.get
        self._write_log([classified_rows.withColumnRenamed("_reason", "motivo"), checked_rows], [found["rejects"], kept["rejects"]], batch_id)
        top = self._largest(self.paths.fact, self.fact.read(), "id_evento", batch_id)
        if self.seed_fact is not None and "id_evento" in self.seed_fact.columns:
            top = max(top, self.seed_fact.agg(F.max("id_evento")).head()[0] or 0)
        self._note_largest(self.paths.fact, top + kept["accepted"], batch_id)
        accepted_rows = checked_rows.filter(F.col(KIND) == ACCEPTED)
        in_range = session_range("id_partida", self._width(accepted_rows, kept["accepted"]))
        accepted = row_numbers(accepted_rows, "id_evento", top)
        self.fact.write_batch(with_batch(accepted.withColumn(RANGE_COL, in_range), batch_id), batch_id)
        delete_path(self.spark, root)
        out = {"batch": batch_id}
        return out | {"staging": found["rows"], "accepted": kept["accepted"],
                      "rejects": found["rejects"] + kept["rejects"]} if stats else out

    def _written(self, rows: DataFrame, path: str) -> DataFrame:
        rows.write.partitionBy(KIND).parquet(path)
        return self.spark.read.schema(rows.schema).parquet(path)

    def _write_log(self, sources: Sequence[DataFrame], counts: Sequence[int], batch_id: str) -> None:
        """Number the rows that go to the log on from its largest id, and write them."""
        registered = F.lit(datetime.datetime.now(datetime.timezone.utc).replace(tzinfo=None)).cast(S.TS)
        log = read_or_empty(self.spark, self.paths.log, S.T.StructType([*S.REJECT_LOG.fields]))
        last = self._largest(self.paths.log, log, "id_log", batch_id)
        parts = []
        for rows, n in zip(sources, counts):
            parts.append(row_numbers(rows.filter(F.col(KIND) == TO_LOG), "id_log", last)
                         .select("id_log", F.col("archivo_origen").alias("origen"), "linea_raw", "motivo",
                                 registered.alias("registrado_en"), F.lit(batch_id).alias(BATCH_COL)))
            last += n
        self._note_largest(self.paths.log, last, batch_id)
        write_batch(parts[0].unionByName(parts[1]), self.paths.log, batch_id)
