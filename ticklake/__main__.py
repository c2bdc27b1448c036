"""Command line: list, run or explain a registered query; rebuild a warehouse.

    python -m ticklake list
    python -m ticklake run q5_sector_hotspots --sf /root/testdata/sf0.01 [--out DIR] [--show 20]
    python -m ticklake run q5_sector_hotspots --warehouse DIR      # a stored star schema
    python -m ticklake explain q2_pair_proximity --sf /root/testdata/sf0.01
    python -m ticklake rebuild --sf /root/testdata/sf0.01 --out DIR

``rebuild`` is the load -> ingest -> counts flow: it writes the bound star
tables (the fact clustered by session and sorted by session, player, tick),
runs the validated load of the bound staging as one batch, and prints the
table counts.
"""

from __future__ import annotations

import argparse
import json


def _spark(args):
    from ticklake.session import build
    return build(master=args.master, shuffle_partitions=args.partitions)


def main(argv=None):
    ap = argparse.ArgumentParser(prog="ticklake")
    ap.add_argument("--master", default="local[8]")
    ap.add_argument("--partitions", type=int, default=16)
    sub = ap.add_subparsers(dest="cmd", required=True)
    sub.add_parser("list")
    for name in ("run", "explain"):
        p = sub.add_parser(name)
        p.add_argument("query")
        src = p.add_mutually_exclusive_group(required=True)
        src.add_argument("--sf", help="driver tables, bound to the star schema")
        src.add_argument("--warehouse", help="folder of stored star tables")
        if name == "run":
            p.add_argument("--out")
            p.add_argument("--show", type=int, default=20)
    p = sub.add_parser("rebuild")
    p.add_argument("--sf", required=True)
    p.add_argument("--out", required=True)
    p.add_argument("--batch", default="b1")
    args = ap.parse_args(argv)

    from ticklake import registry
    if args.cmd == "list":
        oracle = registry.oracle_sql()
        for k in sorted(registry.queries()):
            print(k, "" if k in oracle else "(no oracle)")
        return
    spark = _spark(args)
    if args.cmd in ("run", "explain"):
        if args.warehouse:
            from ticklake.plans import catalog  # noqa: F401  (registers the builders)
            from ticklake.session import configure
            from ticklake.sources.tables import StarTables
            configure(spark)
            df = registry._BUILDERS[args.query](StarTables(spark, args.warehouse))
        else:
            df = registry.queries()[args.query](spark, args.sf)
        if args.cmd == "explain":
            df.explain("formatted")
        elif args.out:
            df.write.mode("overwrite").parquet(args.out)
        else:
            df.show(args.show, truncate=False)
        return
    if args.cmd == "rebuild":
        from pyspark.sql import functions as F

        from ticklake.plans import analytics as an
        from ticklake.plans.ingest import RANGE_COL, IngestJob, IngestPaths, session_range
        from ticklake.sinks import tables as SK
        w = registry.warehouse(spark, args.sf)
        out = args.out.rstrip("/")
        for name in ("episode", "map", "sector", "volunteer", "player", "session",
                     "participation", "instrument", "survey_item", "survey_response"):
            SK.reload(w.table(name), f"{out}/{name}")
        SK.clustered_layout(w.preloaded_fact.withColumn(SK.BATCH_COL, F.lit("seed"))
                            .withColumn(RANGE_COL, session_range("id_partida")),
                            f"{out}/tick_event", partition_by=[SK.BATCH_COL, RANGE_COL],
                            cluster_by=["id_partida", "id_jugador", "tic"], sort_by=["id_partida", "id_jugador", "tic"])
        job = IngestJob(spark, IngestPaths(fact=f"{out}/tick_event", log=f"{out}/log_errores_carga"),
                        w.player, w.volunteer, w.session, w.sector)
        stats = job.run(w.staging, args.batch)
        log = spark.read.parquet(f"{out}/log_errores_carga")
        counts = {r.tabla: r.filas for r in an.rpt_table_counts(w, log).collect()}
        counts["evento_telemetria"] = spark.read.parquet(f"{out}/tick_event").count()
        print(json.dumps({"load": stats, "counts": counts}))


if __name__ == "__main__":
    main()
