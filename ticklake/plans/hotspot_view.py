"""The materialized hotspot view, kept up to date by the loads (MV, SNK-5).

Two tables under one folder: ``state`` holds the presence state of every batch
in a partition of its own, ``view`` the versions of the view. A refresh reads
the batch and the state of the touched maps' sectors, never the fact. A
corrected batch replaces its partition of the state, so players and sessions
that it no longer brings are no longer counted.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ticklake.operators.presence import STATE_SCHEMA, merged, presence_state
from ticklake.plans.analytics import hotspots_of_state
from ticklake.session import scratch_path
from ticklake.sinks.tables import (BATCH_COL, current_version, delete_path, drop_versions, materialize, read_materialized,
                                   read_or_empty, with_batch, write_batch)


class HotspotView:
    """The stored view under ``path``, over the given dimensions."""

    def __init__(self, spark: SparkSession, path: str, sector: DataFrame, map_: DataFrame, episode: DataFrame):
        self.spark, self.sector, self.map, self.episode = spark, sector, map_, episode
        self.state_path, self.view_path = f"{path}/state", f"{path}/view"

    def state(self) -> DataFrame:
        """State rows of all batches."""
        schema = T.StructType.fromDDL(f"{STATE_SCHEMA}, {BATCH_COL} string")
        return read_or_empty(self.spark, self.state_path, schema)

    def read(self) -> DataFrame:
        return read_materialized(self.spark, self.view_path)

    def refreshed(self, touched: DataFrame) -> DataFrame:
        """The view with the maps of the ``touched`` sectors made anew from the state."""
        maps = self.sector.join(touched, "id_sector").select("id_mapa").distinct()
        sectors = self.sector.join(maps, "id_mapa", "left_semi")
        of_maps = self.state().drop(BATCH_COL).join(sectors.select("id_sector"), "id_sector", "left_semi")
        fresh = hotspots_of_state(merged(of_maps), sectors, self.map, self.episode)
        if current_version(self.spark, self.view_path) is None:
            return fresh
        stored = self.read()
        return stored.join(maps, "id_mapa", "left_anti").select(*fresh.columns).unionByName(fresh)

    def load(self, rows: DataFrame, batch_id: str, keep_versions: int = 2) -> DataFrame:
        """Bring the view up to date with the fact rows of a batch, in place of what it brought before.

        The newest ``keep_versions`` versions stay for readers that still hold them.
        """
        scratch = scratch_path(self.spark, f"hotspots/{uuid.uuid4().hex}")
        presence_state(rows).write.parquet(f"{scratch}/state")
        added = self.spark.read.schema(STATE_SCHEMA).parquet(f"{scratch}/state")
        before = self.state().filter(F.col(BATCH_COL) == F.lit(batch_id))
        (added.select("id_sector").union(before.select("id_sector")).distinct()
         .write.parquet(f"{scratch}/touched"))
        touched = self.spark.read.schema("id_sector long").parquet(f"{scratch}/touched")
        # Sorted by sector: the touched sectors' rows are found by file statistics.
        write_batch(with_batch(added.repartitionByRange("id_sector", "id").sortWithinPartitions("id_sector"), batch_id),
                    self.state_path, batch_id)
        # The view's (map, events desc) index, re-aimed: order inside its files.
        out = materialize(self.refreshed(touched), self.view_path, ("id_mapa", F.desc("total_eventos")))
        drop_versions(self.spark, self.view_path, keep_versions)
        delete_path(self.spark, scratch)
        return out
