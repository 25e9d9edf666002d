"""Command-line job: read the metric tables, write every report.

    python -m fleetscope --cpu PATH --mem PATH --disk PATH --out DIR
        [--format parquet|csv|json|...] [--option KEY=VALUE ...] [--ingest TABLES]
        [--match contains|position] [--exact-scale 2] [--no-force] [--dedupe]
        [--since DAY] [--until DAY]

Equivalent of running the CPU, memory and disk report scripts and the overall
report, for the whole fleet in one Spark application: one rollup per metric
family, client reports written partitioned by client, one overall report.
``--option`` goes to the reader, for connectors or CSV dialects.  With ``--ingest`` the three paths are
landed files: they are first added to the metric tables TABLES/cpu, TABLES/mem
and TABLES/disk, and the reports are made from all that these hold.  ``--since`` and ``--until`` (ISO
dates, the latter exclusive) bound the reports' period; of metric tables only the folders of these days are read.
"""

from __future__ import annotations

import argparse
import datetime
import json

from fleetscope import schema as S
from fleetscope.plans.reports import write_reports
from fleetscope.session import get_session
from fleetscope.sources.ingest import ingest_append, read_table
from fleetscope.sources.readers import in_period, read_metrics


def _day(text: str) -> str:
    return datetime.date.fromisoformat(text).isoformat()


def main(argv: list[str] | None = None) -> dict[str, str]:
    ap = argparse.ArgumentParser(prog="fleetscope", description=__doc__.splitlines()[0])
    ap.add_argument("--cpu", required=True)
    ap.add_argument("--mem", required=True)
    ap.add_argument("--disk", required=True)
    ap.add_argument("--out", required=True)
    ap.add_argument("--format", default="parquet")
    ap.add_argument("--option", action="append", default=[], metavar="KEY=VALUE",
                    help="reader option, may be repeated")
    ap.add_argument("--ingest", default=None, metavar="TABLES",
                    help="add the files to the metric tables below this folder first")
    ap.add_argument("--match", default="contains", choices=["contains", "position"])
    ap.add_argument("--exact-scale", type=int, default=None)
    ap.add_argument("--no-force", action="store_true", help="write only charts that are not there yet")
    ap.add_argument("--dedupe", action="store_true", help="drop exact duplicate rows on read")
    ap.add_argument("--report-date", default=None, help="date shown on the reports")
    ap.add_argument("--since", default=None, metavar="DAY", type=_day, help="first day of the reports' period")
    ap.add_argument("--until", default=None, metavar="DAY", type=_day, help="day after the period's last")
    ap.add_argument("--master", default=None)
    args = ap.parse_args(argv)

    spark = get_session(args.master)
    options = dict(o.split("=", 1) for o in args.option)
    tables = {}
    for fam in (S.CPU_FAMILY, S.MEM_FAMILY, S.DISK_FAMILY):
        path = getattr(args, fam.name)
        if args.ingest:
            table = f"{args.ingest.rstrip('/')}/{fam.name}"
            ingest_append(spark, path, table, fam, fmt=args.format, options=options)
            tables[fam.name] = read_table(spark, table, fam, dedupe=args.dedupe, since=args.since, until=args.until)
        else:
            rows = read_metrics(spark, path, fam, fmt=args.format, options=options, dedupe=args.dedupe)
            tables[fam.name] = in_period(rows, args.since, args.until)
    paths = write_reports(tables["cpu"], tables["mem"], tables["disk"], args.out,
                          match=args.match, exact_scale=args.exact_scale,
                          force=not args.no_force, report_date=args.report_date)
    print(json.dumps(paths))
    return paths


if __name__ == "__main__":
    main()
