"""Command line: ``python -m fieldkpi <command> ...`` (or spark-submit this module).

Commands:
  weekly     newest landed report -> raw batch -> incremental clean history
  dashboard  indicator and evolution JSON documents from the clean history
  reports    sheet-style summary CSV and per-zone boards
  views      register the clean history as a table and create the two views
  check      list required catalog objects that are missing
"""

from __future__ import annotations

import argparse
import json
import sys

from . import constants as K
from .session import get_spark


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="fieldkpi")
    ap.add_argument("--master", default=None, help="Spark master (leave unset under spark-submit)")
    sub = ap.add_subparsers(dest="cmd", required=True)
    w = sub.add_parser("weekly")
    w.add_argument("--landing", required=True)
    w.add_argument("--raw", required=True)
    w.add_argument("--clean", required=True)
    w.add_argument("--zones", required=True, action="append", metavar="LAYER",
                   help="GeoJSON layer, repeatable: PATH (codes in property zone), PATH@PROPERTY or PATH=CODE")
    w.add_argument("--lenient-coordinates", action="store_true", help="bad coordinate text gives no zone instead of an error")
    w.add_argument("--table", default=None)
    w.add_argument("--glob", default="*.csv")
    w.add_argument("--person-buckets", type=int, default=None, help="buckets of the stored person days (default: shuffle partitions)")
    d = sub.add_parser("dashboard")
    d.add_argument("--clean", required=True)
    d.add_argument("--out", required=True)
    r = sub.add_parser("reports")
    r.add_argument("--clean", required=True)
    r.add_argument("--out", required=True)
    r.add_argument("--start", default=K.ACCUMULATION_START)
    v = sub.add_parser("views")
    v.add_argument("--clean", required=True)
    sub.add_parser("check")
    args = ap.parse_args(argv)

    from .sources.snapshots import read_snapshot
    spark = get_spark(args.master)
    if args.cmd == "weekly":
        from .operators.geo import zone_layers
        from .plans.weekly import weekly_run
        res = weekly_run(spark, args.landing, args.raw, args.clean, zone_layers(spark, args.zones), args.table,
                         args.glob, strict_coordinates=not args.lenient_coordinates, person_buckets=args.person_buckets)
        print(json.dumps({"report": res.report, "appended": res.appended, "raw_batch": res.raw_batch,
                          "rebuilt": res.rebuilt, "from_week": str(res.from_week) if res.from_week else None}))
    elif args.cmd == "dashboard":
        from .plans.aggregates import read_persons
        from .plans.dashboard import write_dashboard
        from .sources.snapshots import snapshots
        persons = read_persons(spark, args.clean) if snapshots(spark, args.clean) else None
        write_dashboard(read_snapshot(spark, args.clean), args.out, persons=persons)
    elif args.cmd == "reports":
        from .plans.reports import write_reports
        from .plans.aggregates import read_daily
        from .sources.snapshots import snapshots
        rows = read_daily(spark, args.clean) if snapshots(spark, args.clean) else read_snapshot(spark, args.clean)
        write_reports(rows, args.out, args.start)
    elif args.cmd == "views":
        from .sources.catalog import CLEAN_TABLE, create_views
        from .sources.writers import replace_table
        replace_table(read_snapshot(spark, args.clean), CLEAN_TABLE)
        create_views(spark, CLEAN_TABLE)
    elif args.cmd == "check":
        from .sources.catalog import missing_objects
        missing = [r.name for r in missing_objects(spark).collect()]
        print(json.dumps({"missing": missing}))
        return 1 if missing else 0
    return 0


if __name__ == "__main__":
    sys.exit(main())
