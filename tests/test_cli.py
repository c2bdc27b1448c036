"""The rebuild flow writes a star warehouse; every analytical query runs on it."""

import json
import os

import pytest

from ticklake import registry
from ticklake.__main__ import main
from ticklake.sources.tables import StarTables

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")


def test_rebuild_then_query_stored_warehouse(spark, tmp_path, capsys):
    out = str(tmp_path / "wh")
    main(["--master", "local[4]", "--partitions", "4", "rebuild", "--sf", SF, "--out", out])
    report = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    w = StarTables(spark, out)
    bound = registry.warehouse(spark, SF)
    assert w.tick_event.count() == bound.preloaded_fact.count() + report["load"]["accepted"]
    from ticklake.plans import catalog  # noqa: F401
    for name in ("q1_session_duration_by_map", "q2_pair_proximity", "q3_shortest_longest_path",
                 "q5_sector_hotspots", "q6_copresence_pct", "q7_survey_of_shortest",
                 "q8_distance_speed", "v_player_trajectory", "v_sector_copresence",
                 "mv_sector_hotspots", "audit_unique", "audit_foreign_key"):
        df = registry._BUILDERS[name](w)
        df.write.format("noop").mode("overwrite").save()
    assert registry._BUILDERS["audit_unique"](w).count() == 0
