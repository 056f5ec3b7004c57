"""Command line: ``python -m skyledger <command> ...``.

    land   --sf-dir DIR --landing DIR          land the derived feeds as envelope files
    run    --landing DIR --base DIR [--export DIR] [--snapshot-date D]
                                               bronze -> silver -> gold (-> JSON export)
    check  [--sf-dir DIR]                      print row counts of every registered query

The session comes from ``SparkSession.builder`` (spark-submit settings apply);
``spark.checkpoint.dir`` is honoured for scratch folders.
"""

from __future__ import annotations

import argparse
import json
import sys


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="skyledger")
    sub = ap.add_subparsers(dest="cmd", required=True)
    p_land = sub.add_parser("land")
    p_land.add_argument("--sf-dir", required=True)
    p_land.add_argument("--landing", required=True)
    p_run = sub.add_parser("run")
    p_run.add_argument("--landing", required=True)
    p_run.add_argument("--base", required=True)
    p_run.add_argument("--export")
    p_run.add_argument("--snapshot-date")
    p_run.add_argument("--max-files-per-trigger", type=int)
    p_check = sub.add_parser("check")
    p_check.add_argument("--sf-dir", default="/root/testdata/sf0.001")
    args = ap.parse_args(argv)

    from .session import get_session
    spark = get_session()

    if args.cmd == "land":
        from .sources.adapters import GP_FIELDS, SATCAT_FIELDS, land_feed, load_feeds
        satcat_raw, gp_raw = load_feeds(spark, args.sf_dir)
        land_feed(satcat_raw, f"{args.landing}/satcat", "satcat", SATCAT_FIELDS)
        land_feed(gp_raw, f"{args.landing}/gp", "gp", GP_FIELDS)
        print(json.dumps({"landed": args.landing}))
    elif args.cmd == "run":
        from .plans.pipeline import run_full
        res = run_full(spark, args.landing, args.base, args.export, args.snapshot_date,
                       args.max_files_per_trigger)
        print(json.dumps({"envelopes": res.envelopes, "tables": res.batch.tables,
                          "quality": res.batch.quality,
                          "exported": {r.table: r.rows for r in res.export}}))
    else:
        from .registry import QUERIES
        for name, fn in QUERIES.items():
            print(f"{name}\t{fn(spark, args.sf_dir).count()}")
    return 0


if __name__ == "__main__":
    sys.exit(main())
