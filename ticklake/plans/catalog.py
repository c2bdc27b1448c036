"""Registration of all queries with their oracle SQL (see ``ticklake.registry``)."""

from __future__ import annotations

from ticklake.oracle.analytics import SQL as A
from ticklake.plans import analytics as an
from ticklake.registry import register

# ---------------------------------------------------------------- analytical jobs (§2.12)
for _name in ("q1_session_duration_by_map", "q2_pair_proximity", "q2b_pair_distance_sample",
              "q3a_session_path_length", "q3_shortest_longest_path", "q4_survey_above_avg",
              "q5_sector_hotspots", "q6_copresence_pct", "q7_survey_of_shortest",
              "q8_distance_speed", "v_player_trajectory", "v_sector_copresence"):
    register(_name, A[_name])(getattr(an, _name))

register("tick_grid", A["tick_grid"])(an.tick_grid_gaps)
register("mv_sector_hotspots", A["mv_sector_hotspots"])(an.mv_sector_hotspots)

# ---------------------------------------------------------------- validating load (ING-*)
from ticklake.oracle.ingest import SQL as G  # noqa: E402
from ticklake.plans import ingest as ing  # noqa: E402

for _name in ("etl_missing_key", "etl_bad_type", "etl_overflow", "etl_out_of_range",
              "etl_fk_player", "etl_fk_session", "etl_fk_sector", "etl_no_consent",
              "etl_dup_batch", "etl_dup_core", "etl_unclassified", "etl_reject_log",
              "etl_accept", "etl_summary"):
    register(_name, G[_name])(getattr(ing, _name))
register("topk_recent", G["topk_recent_rejects"])(ing.topk_recent_rejects)

# ---------------------------------------------------------------- primitives and audits (§2.1-2.9, §2.11)
from ticklake.oracle.primitives import Q as PQ  # noqa: E402
from ticklake.plans.primitives import P  # noqa: E402

for _name, _fn in P.items():
    register(_name, PQ.get(_name))(_fn)
